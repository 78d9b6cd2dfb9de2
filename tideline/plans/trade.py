"""Order queries: A1, A2, A10, A11, J1-J8, T1, T2, P14, P15, P18, S8, W2-W5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.time import to_millis
from tideline.operators import cdc, facts, metrics
from tideline.operators.dedup import retract_versions
from tideline.operators.dims import Step, category_tree, enrich_chain, flat_dictionary, sku_dimension
from tideline.operators.joins import enrich
from tideline.plans.inputs import (
    DAY, LATEST_LINES, LINE_ID, LINE_KEY, LINE_VERSION, as_double, latest_lines, line_id, money, table, window_sql,
)
from tideline.plans.registry import query
from tideline.session import scratch
from tideline.sinks.writers import land_by_table, to_json_text
from tideline.sources.readers import camel_columns

MONTH = "30 days"
MONTH_S = 30 * DAY


# --- A2, J8 -----------------------------------------------------------------------------------------


def _orders_with_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", money("o_totalprice").alias("amount"), "o_orderdate")
    users = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("province_id"))
    return orders.join(users, F.col("o_custkey") == F.col("c_custkey"))


@query(
    "province_order_window",
    f"""
    SELECT stt, edt, cur_date, province_id, n_name AS province_name, order_amount, order_ct FROM (
      SELECT {window_sql('o_orderdate', MONTH_S)}, c_nationkey AS province_id,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS order_amount,
        count(DISTINCT o_orderkey) AS order_ct
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL) w
    LEFT JOIN nation ON province_id = n_nationkey
    """,
)
def province_order_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders_with_province(spark, sf_dir)
    windows = metrics.province_orders(orders, "o_orderdate", MONTH, "province_id", "o_orderkey", "amount")
    named = metrics.with_name(windows, table(spark, sf_dir, "nation"), "province_id", "n_nationkey", "n_name", "province_name")
    return as_double(named, "order_amount").select(
        "stt", "edt", "cur_date", "province_id", "province_name", "order_amount", "order_ct"
    )


# --- A1, J6 -----------------------------------------------------------------------------------------

AMOUNTS = ["original_amount", "activity_reduce_amount", "coupon_reduce_amount", "order_amount"]


def _with_amounts(lines: DataFrame) -> DataFrame:
    # Narrow decimals: every product fits 18 digits, so it stays a long inside generated code.
    price, disc, tax = [F.col(c).cast(t) for c, t in (("l_extendedprice", "decimal(12,2)"), ("l_discount", "decimal(4,2)"), ("l_tax", "decimal(4,2)"))]
    return lines.withColumns(
        {
            "original_amount": price,
            "activity_reduce_amount": price * disc,
            "coupon_reduce_amount": price * tax,
            "order_amount": price * (F.lit(1).cast("decimal(1,0)") - disc),
        }
    )


AMOUNTS_SQL = """
  CAST(l_extendedprice AS DECIMAL(18,2)) AS original_amount,
  CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)) AS activity_reduce_amount,
  CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS coupon_reduce_amount,
  CAST(l_extendedprice AS DECIMAL(18,2)) * (1.00 - CAST(l_discount AS DECIMAL(4,2))) AS order_amount
"""
CHAIN_COLUMNS = [
    "sku_name", "spu_id", "spu_name", "tm_id", "tm_name", "category3_id", "category3_name", "category2_id", "category2_name",
    "category1_id", "category1_name",
]
CHAIN_SQL = ", ".join(CHAIN_COLUMNS)
SUMS_SQL = ", ".join(f"CAST(sum({a}) AS DOUBLE) AS {a}" for a in AMOUNTS)


@query(
    "sku_order_window",
    f"""
    WITH sku AS (SELECT p_partkey AS id, p_name AS sku_name, p_type AS spu_id, CASE WHEN p_partkey % 10 = 3 THEN 'no ' ELSE '' END || p_brand AS tm_id,
        CASE WHEN p_partkey % 9 <> 5 THEN p_size END AS category3_id FROM part),
      spu AS (SELECT DISTINCT p_type AS id, 'spu ' || p_type AS spu_name FROM part),
      tm AS (SELECT DISTINCT p_brand AS id, 'brand ' || p_brand AS tm_name FROM part),
      c3 AS (SELECT DISTINCT p_size AS id, 'c3 ' || p_size AS category3_name, p_size % 12 AS category2_id FROM part),
      c2 AS (SELECT DISTINCT p_size % 12 AS id, 'c2 ' || p_size % 12 AS category2_name, p_size % 12 % 4 AS category1_id FROM part),
      c1 AS (SELECT DISTINCT p_size % 12 % 4 AS id, 'c1 ' || p_size % 12 % 4 AS category1_name FROM part)
    SELECT stt, edt, cur_date, sku_id, {CHAIN_SQL}, {', '.join(AMOUNTS)} FROM (
      SELECT {window_sql('l_shipdate', MONTH_S)}, CASE WHEN l_partkey % 14 = 9 THEN -l_partkey ELSE l_partkey END AS sku_id, {SUMS_SQL}
      FROM (SELECT l_shipdate, l_partkey, {AMOUNTS_SQL} FROM ({LATEST_LINES})) GROUP BY ALL) w
    LEFT JOIN sku ON sku_id = sku.id LEFT JOIN spu ON spu_id = spu.id LEFT JOIN tm ON tm_id = tm.id
    LEFT JOIN c3 ON category3_id = c3.id LEFT JOIN c2 ON category2_id = c2.id LEFT JOIN c1 ON category1_id = c1.id
    """,
)
def sku_order_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows by sku, then the chain of dimensions; some skus, trademarks and categories are unknown."""
    key = F.col("l_partkey")
    lines = _with_amounts(latest_lines(spark, sf_dir)).withColumn("sku_id", F.when(key % 14 == 9, -key).otherwise(key))
    windows = metrics.sku_orders(lines, "l_shipdate", MONTH, "sku_id", AMOUNTS)
    return as_double(enrich_chain(windows, sku_chain(spark, sf_dir)), *AMOUNTS).select(
        "stt", "edt", "cur_date", "sku_id", *CHAIN_COLUMNS, *AMOUNTS
    )


def sku_chain(spark: SparkSession, sf_dir: str) -> list[Step]:
    """sku -> spu, trademark, category 3 -> 2 -> 1."""
    part = table(spark, sf_dir, "part")
    size = F.col("p_size")
    named = lambda key, prefix, **more: part.select(
        key.alias("id"), F.concat(F.lit(f"{prefix} "), key.cast("string")).alias("name"), *[c.alias(n) for n, c in more.items()]
    ).distinct()
    sku = part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("sku_name"), F.col("p_type").alias("spu_id"),
        F.concat(F.when(F.col("p_partkey") % 10 == 3, "no ").otherwise(""), "p_brand").alias("tm_id"),
        F.when(F.col("p_partkey") % 9 != 5, size).alias("category3_id"),
    )
    ids = ["spu_id", "tm_id", "category3_id"]
    return [
        Step("sku_id", sku, "id", {n: n for n in ["sku_name", *ids]}),
        Step("spu_id", named(F.col("p_type"), "spu"), "id", {"name": "spu_name"}),
        Step("tm_id", named(F.col("p_brand"), "brand"), "id", {"name": "tm_name"}),
        Step("category3_id", named(size, "c3", category2_id=size % 12), "id", {"name": "category3_name", "category2_id": "category2_id"}),
        Step("category2_id", named(size % 12, "c2", category1_id=size % 12 % 4), "id", {"name": "category2_name", "category1_id": "category1_id"}),
        Step("category1_id", named(size % 12 % 4, "c1"), "id", {"name": "category1_name"}),
    ]


# --- T1, T2 -----------------------------------------------------------------------------------------


@query(
    "order_detail_retract",
    f"""
    WITH v AS (
      SELECT *, row_number() OVER k AS rn, count(*) OVER (PARTITION BY {', '.join(LINE_KEY)}) AS n FROM lineitem
      WINDOW k AS (PARTITION BY {', '.join(LINE_KEY)} ORDER BY {', '.join(LINE_VERSION)}))
    SELECT {LINE_ID} AS id, l_partkey AS sku_id, strftime(l_shipdate, '%Y-%m-%d') AS ship_date,
      sign * l_quantity AS quantity, sign * l_extendedprice AS amount, CAST(sign AS BIGINT) AS sign
    FROM (SELECT *, 1 AS sign FROM v UNION ALL SELECT *, -1 AS sign FROM v WHERE rn < n)
    """,
)
def order_detail_retract(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The position in the source file stands for the arrival position of a change stream.
    lines = table(spark, sf_dir, "lineitem").select(
        "*", line_id().alias("id"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    order = [*LINE_VERSION, "file", "row"]
    signed = retract_versions(lines, "id", order, ["l_quantity", "l_extendedprice"], "sign", ["file", "row"])
    return signed.select(
        "id", F.col("l_partkey").alias("sku_id"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("amount"),
        F.col("sign").cast("bigint").alias("sign"),
    )


@query(
    "province_order_retracted",
    f"""
    SELECT {window_sql('l_shipdate', MONTH_S)}, l_suppkey % 25 AS province_id,
      CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS order_amount, count(DISTINCT l_orderkey) AS order_ct
    FROM ({LATEST_LINES}) GROUP BY ALL
    """,
)
def province_order_retracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals over every version and every version taken back are those of the newest versions."""
    lines = table(spark, sf_dir, "lineitem").select(
        "*", line_id().alias("id"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
        money("l_extendedprice").alias("amount"), (F.col("l_suppkey") % 25).alias("province_id"),
    )
    signed = retract_versions(lines, "id", [*LINE_VERSION, "file", "row"], ["amount"], "sign", ["file", "row"])
    totals = metrics.province_orders_signed(signed, "l_shipdate", MONTH, "province_id", "l_orderkey", "amount")
    return as_double(totals, "order_amount")


LINE_COLUMNS = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query(
    "order_detail_latest",
    f"""
    SELECT {LINE_ID} AS id, {', '.join(LINE_COLUMNS)}, strftime(l_shipdate, '%Y-%m-%d') AS ship_date
    FROM ({LATEST_LINES})
    """,
)
def order_detail_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_lines(spark, sf_dir).select(
        line_id().alias("id"), *LINE_COLUMNS, F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_date")
    )


# --- change events of orders and lines --------------------------------------------------------------


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed change events (JSON text) of orders, lines, activities and coupons."""
    text = lambda c: F.col(c).cast("string")
    orders = table(spark, sf_dir, "orders").select(
        cdc.envelope(
            "order_info",
            {
                "id": text("o_orderkey"),
                "user_id": text("o_custkey"),
                "province_id": (F.col("o_custkey") % 25).cast("string"),
                "total_amount": money("o_totalprice").cast("string"),
                "order_status": text("o_orderstatus"),
                "payment_way": F.left("o_orderpriority", F.lit(1)),
                "create_time": to_millis("o_orderdate").cast("string"),
            },
            ts_ms=to_millis("o_orderdate"),
        ).alias("value")
    )
    lines = latest_lines(spark, sf_dir).withColumn("id", line_id())
    price, disc, tax = money("l_extendedprice"), money("l_discount"), money("l_tax")
    shipped = to_millis("l_shipdate")
    details = cdc.envelope(
        "order_detail",
        {
            "id": F.col("id"),
            "order_id": text("l_orderkey"),
            "sku_id": text("l_partkey"),
            "sku_name": F.concat(F.lit("sku "), text("l_partkey")),
            "order_price": price.cast("string"),
            "sku_num": F.col("l_quantity").cast("int").cast("string"),
            "create_time": shipped.cast("string"),
            "split_total_amount": price.cast("string"),
            "split_activity_amount": (price * disc).cast("string"),
            "split_coupon_amount": (price * tax).cast("string"),
        },
        ts_ms=shipped,
    )
    percent = lambda c: (c * 100).cast("int").cast("string")
    activity = cdc.envelope(
        "order_detail_activity",
        {
            "order_detail_id": F.col("id"),
            "activity_id": percent(disc),
            "activity_rule_id": (F.col("l_suppkey") % 10).cast("string"),
        },
        ts_ms=shipped,
    )
    coupon = cdc.envelope(
        "order_detail_coupon", {"order_detail_id": F.col("id"), "coupon_id": percent(tax)}, ts_ms=shipped
    )
    # One pass over the lines gives all three events of a line.
    events = F.array_compact(F.array(details, F.when(disc >= 0.05, activity), F.when(tax >= 0.06, coupon)))
    return orders.unionByName(lines.select(F.explode(events).alias("value")))


def land_changes(spark: SparkSession, messages: DataFrame) -> DataFrame:
    """Parse once and write by source table, so each table is read by partition pruning afterwards."""
    path = scratch(spark, "ods")
    land_by_table(cdc.valid_changes(cdc.parse_cdc(messages)), path)
    return spark.read.parquet(path)


ORDER_DETAIL_SQL = f"""
SELECT {LINE_ID} AS id, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS user_id,
  CAST(l_partkey AS VARCHAR) AS sku_id, 'sku ' || l_partkey AS sku_name, CAST(o_custkey % 25 AS VARCHAR) AS province_id,
  CASE WHEN d >= 0.05 THEN CAST(CAST(d * 100 AS INT) AS VARCHAR) END AS activity_id,
  CASE WHEN d >= 0.05 THEN CAST(l_suppkey % 10 AS VARCHAR) END AS activity_rule_id,
  CASE WHEN t >= 0.06 THEN CAST(CAST(t * 100 AS INT) AS VARCHAR) END AS coupon_id,
  strftime(l_shipdate, '%Y-%m-%d') AS date_id, CAST(epoch_us(l_shipdate) // 1000 AS VARCHAR) AS create_time,
  CAST(CAST(l_quantity AS INT) AS VARCHAR) AS sku_num,
  CAST(CAST(CAST(l_quantity AS INT) AS DECIMAL(16,2)) * CAST(p AS DECIMAL(16,2)) AS VARCHAR) AS split_original_amount,
  CAST(CAST(p * d AS DECIMAL(20,4)) AS VARCHAR) AS split_activity_amount,
  CAST(CAST(p * t AS DECIMAL(20,4)) AS VARCHAR) AS split_coupon_amount,
  CAST(p AS VARCHAR) AS split_total_amount, epoch_us(l_shipdate) // 1000 AS ts_ms, o_orderdate, o_orderpriority
FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS p, CAST(l_discount AS DECIMAL(4,2)) AS d,
        CAST(l_tax AS DECIMAL(4,2)) AS t FROM ({LATEST_LINES}))
JOIN orders ON l_orderkey = o_orderkey
"""


@query("order_detail_fact", f"SELECT * EXCLUDE (o_orderdate, o_orderpriority) FROM ({ORDER_DETAIL_SQL})")
def order_detail_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = land_changes(spark, order_events(spark, sf_dir))
    return facts.order_detail_fact(
        *[cdc.rows_of(landed, t) for t in ("order_detail", "order_info", "order_detail_activity", "order_detail_coupon")]
    )


def _lines_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order-detail fact straight from the tables, with the order time as event time."""
    price, disc, tax = money("l_extendedprice"), money("l_discount"), money("l_tax")
    text = lambda c: F.col(c).cast("string")
    percent = lambda c: (c * 100).cast("int").cast("string")
    lines = latest_lines(spark, sf_dir).join(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"),
        F.col("l_orderkey") == F.col("o_orderkey"),
    )
    return lines.select(
        line_id().alias("id"), text("l_orderkey").alias("order_id"), text("o_custkey").alias("user_id"),
        text("l_partkey").alias("sku_id"), F.concat(F.lit("sku "), text("l_partkey")).alias("sku_name"),
        (F.col("o_custkey") % 25).cast("string").alias("province_id"),
        F.when(disc >= 0.05, percent(disc)).alias("activity_id"),
        F.when(disc >= 0.05, (F.col("l_suppkey") % 10).cast("string")).alias("activity_rule_id"),
        F.when(tax >= 0.06, percent(tax)).alias("coupon_id"),
        F.col("l_quantity").cast("int").cast("string").alias("sku_num"),
        (F.col("l_quantity").cast("int").cast("decimal(16,2)") * price.cast("decimal(16,2)")).cast("string").alias("split_original_amount"),
        (price * disc).cast("string").alias("split_activity_amount"),
        (price * tax).cast("string").alias("split_coupon_amount"),
        price.cast("string").alias("split_total_amount"),
        to_millis("l_shipdate").alias("ts_ms"),
        F.col("o_orderdate").cast("timestamp").alias("order_ts"),
    )


def priority_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """base_dic as nested rows: priority digit -> priority name."""
    codes = table(spark, sf_dir, "orders").select("o_orderpriority").distinct()
    return codes.select(
        F.left("o_orderpriority", F.lit(1)).alias("dic_code"),
        F.struct(F.substr("o_orderpriority", F.lit(3)).alias("dic_name")).alias("info"),
    )


@query(
    "payment_fact",
    f"""
    SELECT d.id AS order_detail_id, order_id, user_id, sku_id, sku_name, province_id, activity_id, activity_rule_id,
      coupon_id, payment_type_code, dic_name AS payment_type_name,
      CAST(pay_ms AS VARCHAR) AS callback_time, sku_num, split_original_amount, split_activity_amount,
      split_coupon_amount, split_total_amount AS split_payment_amount, pay_ms AS ts_ms
    FROM (SELECT *, CASE WHEN o % 8 = 5 THEN 'x' ELSE '' END || substr(o_orderpriority, 1, 1) AS payment_type_code
      FROM (SELECT *, CAST(order_id AS BIGINT) AS o FROM ({ORDER_DETAIL_SQL}))) d
    JOIN (SELECT DISTINCT substr(o_orderpriority, 1, 1) AS dic_code, substr(o_orderpriority, 3) AS dic_name FROM orders) dic
      ON payment_type_code = dic_code,
      LATERAL (SELECT epoch_us(o_orderdate) // 1000 + (o % 60) * 60000 - (o % 7) * 1000 AS pay_ms) p
    WHERE epoch_us(o_orderdate) // 1000 BETWEEN pay_ms - 30 * 60000 AND pay_ms + 5000
    """,
)
def payment_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    paid_ms = to_millis("o_orderdate") + (F.col("o_orderkey") % 60) * 60000 - (F.col("o_orderkey") % 7) * 1000
    payments = orders.select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.concat(F.when(F.col("o_orderkey") % 8 == 5, "x").otherwise(""), F.left("o_orderpriority", F.lit(1))).alias("payment_type"),
        paid_ms.cast("string").alias("callback_time"),
        paid_ms.alias("ts_ms"),
        F.timestamp_millis(paid_ms).alias("pay_ts"),
    )
    dictionary = flat_dictionary(priority_dictionary(spark, sf_dir))
    return facts.payment_fact(payments, _lines_fact(spark, sf_dir), dictionary, "pay_ts", "order_ts")


@query(
    "refund_fact",
    f"""
    WITH dic AS (
      SELECT DISTINCT l_linestatus AS dic_code, 'status ' || l_linestatus AS dic_name FROM lineitem
      UNION ALL
      SELECT DISTINCT substr(o_orderpriority, 1, 1), substr(o_orderpriority, 3) FROM orders)
    SELECT {LINE_ID} AS id, CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_orderkey AS VARCHAR) AS order_id,
      CAST(l_partkey AS VARCHAR) AS sku_id, CAST(o_custkey % 25 AS VARCHAR) AS province_id,
      strftime(l_shipdate, '%Y-%m-%d') AS date_id, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS create_time,
      l_linestatus AS refund_type_code, a.dic_name AS refund_type_name,
      CAST(l_linenumber AS VARCHAR) AS refund_reason_type_code, b.dic_name AS refund_reason_type_name,
      'line ' || l_linenumber AS refund_reason_txt, CAST(CAST(l_quantity AS INT) AS VARCHAR) AS refund_num,
      CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS refund_amount, epoch_us(l_shipdate) // 1000 AS ts_ms
    FROM ({LATEST_LINES}) l JOIN orders ON l_orderkey = o_orderkey
    JOIN dic a ON l_linestatus = a.dic_code JOIN dic b ON CAST(l_linenumber AS VARCHAR) = b.dic_code
    WHERE l_returnflag = 'R'
    """,
)
def refund_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    orders = table(spark, sf_dir, "orders").select(
        text("o_orderkey").alias("id"), text("o_custkey").alias("user_id"),
        (F.col("o_custkey") % 25).cast("string").alias("province_id"),
    )
    refunds = latest_lines(spark, sf_dir).filter(F.col("l_returnflag") == "R").select(
        line_id().alias("id"), text("l_orderkey").alias("order_id"), text("l_partkey").alias("sku_id"),
        F.col("l_linestatus").alias("refund_type"), F.col("l_quantity").cast("int").cast("string").alias("refund_num"),
        money("l_extendedprice").cast("string").alias("refund_amount"),
        text("l_linenumber").alias("refund_reason_type"),
        F.concat(F.lit("line "), text("l_linenumber")).alias("refund_reason_txt"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("create_time"), to_millis("l_shipdate").alias("ts_ms"),
    )
    users = orders.select(F.col("id").alias("order_id"), "user_id")
    statuses = table(spark, sf_dir, "lineitem").select("l_linestatus").distinct().select(
        F.col("l_linestatus").alias("dic_code"), F.concat(F.lit("status "), "l_linestatus").alias("dic_name")
    )
    dictionary = statuses.unionByName(flat_dictionary(priority_dictionary(spark, sf_dir)))
    return facts.refund_fact(refunds.join(users, "order_id"), orders.drop("user_id"), dictionary)


# --- projections ------------------------------------------------------------------------------------

SLOT_SQL = """CASE WHEN h < 6 THEN '凌晨' WHEN h < 9 THEN '早晨' WHEN h < 12 THEN '上午' WHEN h < 14 THEN '中午'
  WHEN h < 18 THEN '下午' WHEN h < 22 THEN '晚上' ELSE '夜间' END"""


def _header(spark: SparkSession, sf_dir: str) -> DataFrame:
    created = to_millis("o_orderdate") + (F.col("o_orderkey") % 24) * 3_600_000
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"), F.col("o_totalprice").alias("total_amount"),
        created.cast("string").alias("create_time"), created.alias("ts_ms"),
    )


@query(
    "order_header",
    f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS user_id, o_orderstatus AS order_status,
      o_totalprice AS total_amount, CAST(ms AS VARCHAR) AS create_time, ms AS ts_ms,
      strftime(make_timestamp(ms * 1000), '%Y-%m-%d') AS date_id, {SLOT_SQL} AS pay_time_slot
    FROM (SELECT *, epoch_us(o_orderdate) // 1000 + (o_orderkey % 24) * 3600000 AS ms, o_orderkey % 24 AS h FROM orders)
    """,
)
def order_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.order_header(_header(spark, sf_dir))


@query(
    "order_line",
    f"""
    SELECT {LINE_ID} AS id, CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS sku_id,
      p_name AS sku_name, CAST(l_quantity AS BIGINT) AS sku_num, p_retailprice AS order_price,
      l_extendedprice AS split_total_amount, epoch_us(l_shipdate) // 1000 AS ts_ms
    FROM lineitem JOIN part ON l_partkey = p_partkey
    """,
)
def order_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("id", line_id())
    sold = enrich(lines, table(spark, sf_dir, "part"), "l_partkey", "p_partkey",
                  {"p_name": "sku_name", "p_retailprice": "order_price"}, "inner")
    return facts.order_line(
        sold.withColumns(
            {
                "order_id": F.col("l_orderkey").cast("string"),
                "sku_id": F.col("l_partkey").cast("string"),
                "sku_num": F.col("l_quantity").cast("bigint"),
                "split_total_amount": F.col("l_extendedprice"),
                "ts_ms": to_millis("l_shipdate"),
            }
        )
    )


@query(
    "order_profile_row",
    f"""
    SELECT CAST(o_custkey AS VARCHAR) AS uid, CAST(ms AS VARCHAR) AS create_time, p_type AS category1_name,
      p_brand AS tm_name, l_extendedprice AS split_total_amount, {SLOT_SQL} AS time_type,
      CASE WHEN l_extendedprice <= 1000 THEN '低价商品' WHEN l_extendedprice <= 3000 THEN '中价商品' ELSE '高价商品' END
        AS price_level, ms AS ts_ms
    FROM (SELECT *, epoch_us(o_orderdate) // 1000 + (o_orderkey % 24) * 3600000 AS ms, o_orderkey % 24 AS h FROM orders)
    JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    """,
)
def order_profile_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.order_profile(profile_lines(spark, sf_dir))


def profile_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice")
    header = _header(spark, sf_dir).select(F.col("id").alias("_oid"), "user_id", "create_time", "ts_ms")
    joined = lines.join(header, F.col("l_orderkey") == F.col("_oid").cast("bigint"))
    sold = enrich(joined, table(spark, sf_dir, "part"), "l_partkey", "p_partkey",
                  {"p_type": "category1_name", "p_brand": "tm_name"}, "inner")
    return sold.withColumnRenamed("l_extendedprice", "split_total_amount")


# --- reports ----------------------------------------------------------------------------------------


@query(
    "report_province",
    """
    SELECT n_name AS province_name, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS order_amount,
      count(*) AS order_ct FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name
    """,
)
def report_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per user first, so a busy user meets the user table as one row."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", money("o_totalprice").alias("amount"))
    per_user = metrics.preaggregated(orders, ["o_custkey"], {"amount": F.col("amount"), "order_ct": F.lit(1)})
    users = enrich(per_user, table(spark, sf_dir, "customer"), "o_custkey", "c_custkey", {"c_nationkey": "province_id"}, "inner")
    totals = metrics.preaggregated(users, ["province_id"], {"order_amount": F.col("amount"), "order_ct": F.col("order_ct")})
    named = enrich(totals, table(spark, sf_dir, "nation"), "province_id", "n_nationkey", {"n_name": "province_name"}, "inner")
    return as_double(named, "order_amount").select("province_name", "order_amount", "order_ct")


def _sku_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals per sku first: at most one row per sku meets the dimension."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", money("l_extendedprice").alias("amount"))
    totals = metrics.report(lines, ["l_partkey"], "amount", "amount")
    return enrich(totals, table(spark, sf_dir, "part"), "l_partkey", "p_partkey", {"p_name": "sku_name", "p_brand": "tm_name"}, "inner")


@query(
    "report_brand",
    """
    SELECT p_brand AS tm_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS order_amount
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand
    """,
)
def report_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_double(metrics.report(_sku_totals(spark, sf_dir), ["tm_name"], "amount", "order_amount"), "order_amount")


@query(
    "report_product",
    """
    SELECT p_name AS sku_name, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS order_amount
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_name
    """,
)
def report_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_double(metrics.report(_sku_totals(spark, sf_dir), ["sku_name"], "amount", "order_amount"), "order_amount")


@query(
    "preaggregate",
    """
    SELECT strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS month, l_returnflag AS flag,
      CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount, count(*) AS line_ct
    FROM lineitem GROUP BY ALL
    """,
)
def preaggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A written daily table, and the monthly totals built from it."""
    lines = table(spark, sf_dir, "lineitem").select("l_shipdate", F.col("l_returnflag").alias("flag"), money("l_extendedprice").alias("amount"))
    path = scratch(spark, "daily")
    daily = metrics.preaggregate(lines, "l_shipdate", "day", ["flag"], {"amount": F.col("amount"), "line_ct": F.lit(1)})
    daily.write.parquet(path)
    monthly = metrics.preaggregate(
        spark.read.parquet(path), "grain", "month", ["flag"], {"amount": F.col("amount"), "line_ct": F.col("line_ct")}
    )
    return as_double(monthly, "amount").select(F.date_format("grain", "yyyy-MM-dd").alias("month"), "flag", "amount", "line_ct")


@query(
    "window_bounds",
    f"""
    SELECT {window_sql('l_shipdate', 7 * DAY)}, count(*) AS line_ct,
      CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity FROM lineitem GROUP BY ALL
    """,
)
def window_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_shipdate", money("l_quantity").alias("q"))
    out = metrics.tumbling(lines, "l_shipdate", "7 days", [], [F.count("*").alias("line_ct"), F.sum("q").alias("quantity")])
    return as_double(out, "quantity")


@query(
    "window_sql",
    f"""
    SELECT {window_sql('ts', 3600)}, event_type, count(*) AS event_ct FROM events GROUP BY ALL
    """,
)
def window_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The window function in SQL text."""
    table(spark, sf_dir, "events").createOrReplaceTempView("tideline_events")
    return spark.sql(
        """
        SELECT date_format(window.start, 'yyyy-MM-dd HH:mm:ss') AS stt, date_format(window.end, 'yyyy-MM-dd HH:mm:ss') AS edt,
          date_format(window.start, 'yyyy-MM-dd') AS cur_date, event_type, event_ct
        FROM (SELECT window(ts, '1 hour') AS window, event_type, count(*) AS event_ct
              FROM tideline_events GROUP BY window(ts, '1 hour'), event_type)
        """
    )


@query(
    "metric_json",
    f"""
    SELECT stt, province_id, '{{"stt":"' || stt || '","edt":"' || edt || '","province_id":' || province_id
      || ',"order_ct":' || order_ct || '}}' AS value
    FROM (SELECT {window_sql('o_orderdate', MONTH_S)}, c_nationkey AS province_id, count(DISTINCT o_orderkey) AS order_ct
      FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
    """,
)
def metric_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders_with_province(spark, sf_dir)
    windows = metrics.province_orders(orders, "o_orderdate", MONTH, "province_id", "o_orderkey", "amount")
    shown = ["stt", "edt", "province_id", "order_ct"]
    return windows.select("stt", "province_id", to_json_text(*shown, "order_amount", "cur_date", hide=("order_amount", "cur_date")).alias("value"))


# --- dimensions -------------------------------------------------------------------------------------


@query(
    "category_tree",
    """
    SELECT n_nationkey AS id, n_name AS b3name, r_name AS b2name,
      CASE WHEN r_regionkey % 2 = 0 THEN 'even' ELSE 'odd' END AS b1name
    FROM nation JOIN region ON n_regionkey = r_regionkey
    """,
)
def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    level3 = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("category2_id")
    )
    region = table(spark, sf_dir, "region")
    parity = F.col("r_regionkey") % 2
    level2 = region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"), parity.alias("category1_id"))
    level1 = region.select(parity.alias("id"), F.when(parity == 0, "even").otherwise("odd").alias("name")).distinct()
    return category_tree(level3, level2, level1)


@query(
    "sku_dim",
    """
    WITH sku AS (SELECT *, CASE WHEN p_partkey % 10 = 3 THEN 'no ' ELSE '' END || p_brand AS tm_id FROM part)
    SELECT p_partkey AS id, p_name AS sku_name, p_retailprice AS price, p_type AS spu_id, tm_id,
      'spu ' || p_type AS spu_name, tm_name
    FROM sku JOIN (SELECT DISTINCT p_brand AS brand, 'brand ' || p_brand AS tm_name FROM part) ON tm_id = brand
    """,
)
def sku_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    sku = part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("sku_name"), F.col("p_retailprice").alias("price"),
                      F.col("p_type").alias("spu_id"), F.concat(F.when(F.col("p_partkey") % 10 == 3, "no ").otherwise(""), "p_brand").alias("tm_id"))
    spu = part.select(F.col("p_type").alias("id"), F.concat(F.lit("spu "), "p_type").alias("spu_name")).distinct()
    brand = part.select(
        F.col("p_brand").alias("id"), F.concat(F.lit("brand "), "p_brand").alias("tm_name")
    ).distinct()
    return sku_dimension(sku, spu, brand).select("id", "sku_name", "price", "spu_id", "tm_id", "spu_name", "tm_name")


def _users_with_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh user has a province that nobody knows."""
    shift = F.when(F.col("c_custkey") % 7 == 2, 1000).otherwise(0)
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name", (F.col("c_nationkey") + shift).alias("province_id"))


@query(
    "enrich_dim_left",
    """
    SELECT c_custkey, c_name, n_name AS province_name, coalesce(n_name, 'unknown') AS shown_name
    FROM (SELECT *, CASE WHEN c_custkey % 7 = 2 THEN 1000 ELSE 0 END + c_nationkey AS province_id FROM customer)
    LEFT JOIN nation ON province_id = n_nationkey
    """,
)
def enrich_dim_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, users = table(spark, sf_dir, "nation"), _users_with_province(spark, sf_dir)
    named = enrich(users, nation, "province_id", "n_nationkey", {"n_name": "province_name"})
    shown = enrich(named, nation, "province_id", "n_nationkey", {"n_name": "shown_name"}, defaults={"shown_name": "unknown"})
    return shown.drop("province_id")


@query(
    "enrich_dim_inner",
    """
    SELECT c_custkey, c_name, n_name AS province_name
    FROM (SELECT *, CASE WHEN c_custkey % 7 = 2 THEN 1000 ELSE 0 END + c_nationkey AS province_id FROM customer)
    JOIN nation ON province_id = n_nationkey
    """,
)
def enrich_dim_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, users = table(spark, sf_dir, "nation"), _users_with_province(spark, sf_dir)
    return enrich(users, nation, "province_id", "n_nationkey", {"n_name": "province_name"}, "inner").drop("province_id")


@query(
    "dim_lookup",
    """
    SELECT s_suppkey, s_name, n_name AS nation_name, r_name AS region_name FROM supplier
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
)
def dim_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point reads by key as equi-joins."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    first = enrich(table(spark, sf_dir, "supplier"), nation, "s_nationkey", "n_nationkey",
                   {"n_name": "nation_name", "n_regionkey": "region_id"}, "inner")
    second = enrich(first, region, "region_id", "r_regionkey", {"r_name": "region_name"}, "inner")
    return second.select("s_suppkey", "s_name", "nation_name", "region_name")


@query(
    "jdbc_snapshot_rename",
    'SELECT n_nationkey AS "nNationkey", n_name AS "nName", n_regionkey AS "nRegionkey" FROM nation',
)
def jdbc_snapshot_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The renaming of a snapshot; the database read itself needs a driver jar."""
    return camel_columns(table(spark, sf_dir, "nation"))

