"""Change-event queries: S1, S3, S12, P1-P8, P10, P16, J4, J9, J10, K2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.time import to_millis
from tideline.operators import cdc, facts
from tideline.operators.routing import latest_rules, route
from tideline.plans.inputs import money, table
from tideline.plans.registry import query
from tideline.session import scratch
from tideline.sinks.writers import write_by_destination

text = lambda c: F.col(c).cast("string")


def order_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order change events as text: op by key, with unreadable, null and image-less messages among them."""
    key = F.col("o_orderkey")
    fields = {"id": text("o_orderkey"), "user_id": text("o_custkey"), "total_amount": money("o_totalprice").cast("string")}
    ms = to_millis("o_orderdate")
    ops = F.element_at(F.array(*map(F.lit, "rcu")), ((key % 3) + 1).cast("int"))
    change = cdc.envelope("order_info", fields, {"id": text("o_orderkey"), "user_id": F.lit("0")}, ops, ms)
    delete = cdc.envelope("order_info", None, fields, "d", ms)
    broken = F.concat(F.lit('{"after": {"id": '), text("o_orderkey"))
    message = F.when(key % 10 == 0, broken).when(key % 10 == 1, None).when(key % 10 == 2, delete).otherwise(change)
    return table(spark, sf_dir, "orders").select(message.alias("value"))


@query(
    "cdc_valid_rows",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
      CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total_amount,
      ['r', 'c', 'u'][o_orderkey % 3 + 1] AS op, epoch_us(o_orderdate) // 1000 AS ts_ms
    FROM orders WHERE o_orderkey % 10 > 2
    """,
)
def cdc_valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = cdc.valid_changes(cdc.parse_cdc(order_messages(spark, sf_dir)))
    return changes.select(*[F.col("after")[c].alias(c) for c in ("id", "user_id", "total_amount")], "op", "ts_ms")


@query(
    "cdc_dirty_rows",
    """SELECT '{"after": {"id": ' || o_orderkey AS value FROM orders WHERE o_orderkey % 10 = 0""",
)
def cdc_dirty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.split_dirty(cdc.parse_cdc(order_messages(spark, sf_dir)))[1]


@query(
    "cdc_image",
    """
    SELECT CASE WHEN o_orderkey % 10 = 2 THEN 'd' ELSE ['r', 'c', 'u'][o_orderkey % 3 + 1] END AS op,
      epoch_us(o_orderdate) // 1000 AS tm_ms, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id,
      CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total_amount
    FROM orders WHERE o_orderkey % 10 > 1
    """,
)
def cdc_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = cdc.split_dirty(cdc.parse_cdc(order_messages(spark, sf_dir)))
    return cdc.flatten_image(good, ["id", "user_id", "total_amount"])


def shop_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One topic with the change events of five tables."""
    order = cdc.envelope("order_info", {"id": text("o_orderkey"), "user_id": text("o_custkey"), "status": text("o_orderstatus")},
                         None, F.when(F.col("o_orderkey") % 4 == 0, "u").otherwise("c"), to_millis("o_orderdate"))
    user = cdc.envelope("user_info", {"id": text("c_custkey"), "name": text("c_name"), "segment": text("c_mktsegment")},
                        None, F.when(F.col("c_custkey") % 2 == 0, "u").otherwise("r"), F.col("c_custkey"))
    sku = cdc.envelope("sku_info", {"id": text("p_partkey"), "sku_name": text("p_name"), "tm_id": text("p_brand")}, None, "r", F.col("p_partkey"))
    shop = cdc.envelope("supplier_info", None, {"id": text("s_suppkey"), "name": text("s_name")}, "d", F.col("s_suppkey"))
    province = cdc.envelope("base_province", {"id": text("n_nationkey"), "name": text("n_name")}, None, "r", F.col("n_nationkey"))
    parts = [("orders", order), ("customer", user), ("part", sku), ("supplier", shop), ("nation", province)]
    frames = [table(spark, sf_dir, name).select(body.alias("value")) for name, body in parts]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


@query(
    "cdc_by_table",
    """
    SELECT * FROM (
      SELECT 'order_info' AS source_table, count(*) AS change_ct, count(DISTINCT o_orderkey) AS id_ct, max(epoch_us(o_orderdate) // 1000) AS last_ms FROM orders
      UNION ALL SELECT 'user_info', count(*), count(DISTINCT c_custkey), max(c_custkey) FROM customer
      UNION ALL SELECT 'sku_info', count(*), count(DISTINCT p_partkey), max(p_partkey) FROM part
      UNION ALL SELECT 'supplier_info', count(*), count(DISTINCT s_suppkey), max(s_suppkey) FROM supplier
      UNION ALL SELECT 'base_province', count(*), count(DISTINCT n_nationkey), max(n_nationkey) FROM nation)
    """,
)
def cdc_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = cdc.parse_cdc(shop_messages(spark, sf_dir))
    return changes.groupBy(F.col("source")["table"].alias("source_table")).agg(
        F.count("*").alias("change_ct"), F.count_distinct(cdc.image()["id"]).alias("id_ct"), F.max("ts_ms").alias("last_ms")
    )


# --- rules ------------------------------------------------------------------------------------------

RULE_COLUMNS = ["source_table", "source_type", "sink_table", "sink_columns"]
# Rule of each region key; the rule of key 2 is deleted and the one of key 0 changed later.
RULES = [
    ("order_info", "insert", "dwd_order", "id,status"),
    ("user_info", "update", "dwd_user", "id,name"),
    ("sku_info", "insert", "dwd_sku", "id,sku_name"),
    ("supplier_info", "delete", "dwd_supplier", "id"),
    ("unused_info", "insert", "dwd_unused", "id"),
]


def rule_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    key = F.col("r_regionkey")
    values = {
        name: F.element_at(F.array(*[F.lit(r[i]) for r in RULES]), key + 1) for i, name in enumerate(RULE_COLUMNS)
    }
    first = cdc.envelope("table_process_dwd", {**values, "sink_columns": F.lit("id")}, None, "r", F.lit(1))
    second = F.when(key == 2, cdc.envelope("table_process_dwd", None, values, "d", F.lit(2))).otherwise(
        cdc.envelope("table_process_dwd", values, values, "u", F.lit(2))
    )
    return cdc.parse_cdc(region.select(F.explode(F.array(first, second)).alias("value")))


def rules_in_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_rules(rule_changes(spark, sf_dir), ["source_table", "source_type"], RULE_COLUMNS)


@query(
    "latest_rules",
    f"""
    SELECT source_table, source_type, sink_table, sink_columns FROM region JOIN (VALUES
      {', '.join(f"({i}, '{a}', '{b}', '{c}', '{d}')" for i, (a, b, c, d) in enumerate(RULES))})
      r(k, source_table, source_type, sink_table, sink_columns) ON k = r_regionkey WHERE k <> 2
    """,
)
def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules_in_force(spark, sf_dir)


ROUTED = """
SELECT 'dwd_order' AS sink_table, 'order_info' AS source_table, CASE WHEN o_orderkey % 4 = 0 THEN 'u' ELSE 'c' END AS op,
  CAST(o_orderkey AS VARCHAR) AS id, NULL AS name, o_orderstatus AS status, epoch_us(o_orderdate) // 1000 AS ts_ms FROM orders
UNION ALL SELECT 'dwd_user', 'user_info', CASE WHEN c_custkey % 2 = 0 THEN 'u' ELSE 'r' END, CAST(c_custkey AS VARCHAR),
  c_name, NULL, c_custkey FROM customer
UNION ALL SELECT 'dwd_supplier', 'supplier_info', 'd', CAST(s_suppkey AS VARCHAR), NULL, NULL, s_suppkey FROM supplier
"""


def _flat(routed: DataFrame) -> DataFrame:
    return routed.select(
        "sink_table", "source_table", "op", *[F.col("data")[c].alias(c) for c in ("id", "name", "status")],
        F.size("data").cast("bigint").alias("field_ct"), "ts_ms",
    )


FIELD_CT = "CAST(CASE sink_table WHEN 'dwd_supplier' THEN 1 ELSE 2 END AS BIGINT) AS field_ct"


@query("route_by_table", f"SELECT *, {FIELD_CT} FROM ({ROUTED})")
def route_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules keyed by table."""
    changes = cdc.parse_cdc(shop_messages(spark, sf_dir))
    return _flat(route(changes, rules_in_force(spark, sf_dir))[0])


@query(
    "route_rules",
    f"""SELECT *, {FIELD_CT} FROM ({ROUTED})
    WHERE op IN ('c', 'r') AND sink_table = 'dwd_order' OR op = 'u' AND sink_table = 'dwd_user' OR op = 'd'""",
)
def route_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J10 + K2: rules keyed by table and op; rows are written per destination and read back."""
    changes = cdc.parse_cdc(shop_messages(spark, sf_dir))
    matched, _ = route(changes, rules_in_force(spark, sf_dir), by_op=True)
    path = scratch(spark, "routed")
    write_by_destination(matched, path)
    return _flat(spark.read.parquet(path))


@query(
    "route_unmatched",
    """
    SELECT 'sku_info' AS source_table, 'r' AS op, p_partkey AS ts_ms FROM part
    UNION ALL SELECT 'base_province', 'r', n_nationkey FROM nation
    """,
)
def route_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = cdc.parse_cdc(shop_messages(spark, sf_dir))
    _, rest = route(changes, rules_in_force(spark, sf_dir))
    return rest.select(F.col("source")["table"].alias("source_table"), "op", "ts_ms")


# --- cart and comments ------------------------------------------------------------------------------


@query(
    "cart_add",
    """
    SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, CAST(k AS VARCHAR) AS sku_id,
      CAST(CASE WHEN o = 0 THEN a ELSE a - b END AS BIGINT) AS sku_num, event_id AS ts_ms
    FROM (SELECT *, event_id % 4 AS o, k % 9 AS a, CASE WHEN event_id % 11 <> 0 THEN event_id % 7 END AS b
      FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events))
    WHERE o = 0 OR o IN (1, 2) AND b IS NOT NULL AND a > b
    """,
)
def cart_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    number = F.col("event_id")
    op = F.element_at(F.array(*map(F.lit, ["r", "u", "update", "d"])), (number % 4 + 1).cast("int"))
    after = {"id": text("event_id"), "user_id": text("user_id"), "sku_id": text("k"), "sku_num": (F.col("k") % 9).cast("string")}
    before = {"sku_num": F.when(number % 11 != 0, (number % 7).cast("string"))}
    messages = events.select(cdc.envelope("cart_info", after, before, op, number).alias("value"))
    added = cdc.cart_additions(cdc.parse_cdc(messages))
    return added.withColumn("sku_num", F.col("sku_num").cast("bigint"))


def comment_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("doc_id")
    fields = {
        "id": text("doc_id"), "user_id": (number % 100).cast("string"), "sku_id": (number % 50).cast("string"),
        "spu_id": (number % 10).cast("string"), "order_id": (number * 3).cast("string"), "appraise": text("source"),
        "comment_txt": text("text"), "nick_name": F.concat(F.lit("nick "), text("lang")),
        "create_time": (number * 60000).cast("string"),
    }
    return table(spark, sf_dir, "documents").select(cdc.envelope("comment_info", fields, ts_ms=number).alias("value"))


@query(
    "comment_rows",
    """
    SELECT doc_id AS ts_ms, 'shop' AS db, 'comment_info' AS "table", '0' AS server_id, source AS appraise,
      text AS comment_txt, 'r' AS op, 'nick ' || lang AS nick_name, doc_id * 60000 AS create_time,
      doc_id % 100 AS user_id, doc_id % 50 AS sku_id, doc_id AS id, doc_id % 10 AS spu_id, doc_id * 3 AS order_id
    FROM documents
    """,
)
def comment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.comment_rows(cdc.parse_cdc(comment_messages(spark, sf_dir)))


@query(
    "comment_fact",
    """
    WITH c AS (SELECT *, CASE WHEN doc_id % 6 = 1 THEN 'no ' ELSE '' END || source AS appraise FROM documents)
    SELECT CAST(doc_id AS VARCHAR) AS id, CAST(doc_id % 100 AS VARCHAR) AS user_id, CAST(doc_id % 50 AS VARCHAR) AS sku_id,
      appraise, dic_name AS appraise_name, text AS comment_txt, doc_id AS ts_ms
    FROM c JOIN (SELECT DISTINCT source AS dic_code, 'label ' || source AS dic_name FROM documents) ON appraise = dic_code
    """,
)
def comment_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sixth comment has a grade that the dictionary lacks."""
    comments = cdc.rows_of(cdc.parse_cdc(comment_messages(spark, sf_dir)), "comment_info")
    unknown = F.col("id").cast("bigint") % 6 == 1
    comments = comments.withColumn("appraise", F.concat(F.when(unknown, "no ").otherwise(""), "appraise"))
    codes = table(spark, sf_dir, "documents").select("source").distinct()
    dictionary = codes.select(F.col("source").alias("dic_code"), F.concat(F.lit("label "), "source").alias("dic_name"))
    return facts.comment_fact(comments, dictionary)
