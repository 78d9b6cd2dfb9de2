"""Scalar and reshape queries: F1, F22-F29, A12, A13, T8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions import text as tx
from tideline.functions import time as tm
from tideline.functions.values import half_up
from tideline.operators.reshape import pivot, unpivot
from tideline.plans.inputs import as_double, money, table, with_k
from tideline.plans.registry import query

# --- keys and codecs --------------------------------------------------------------------------------

HOT = {f"customer#{i:09d}": f"{9001 + i}" for i in range(7)}
BUCKET_SQL = "lpad(CAST(CAST('0x' || right(md5({c}), 3) AS INT) % {n} AS VARCHAR), 4, '0')"


@query(
    "hash_bucket",
    f"""
    SELECT c_custkey, {BUCKET_SQL.format(c='c_name', n=128)} AS bucket, CASE WHEN c_custkey < 7
      THEN CAST(9001 + c_custkey AS VARCHAR) ELSE {BUCKET_SQL.format(c='c_name', n=64)} END AS hot_bucket FROM customer
    """,
)
def hash_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", tx.hash_bucket("c_name").alias("bucket"), tx.hash_bucket("c_name", 64, HOT).alias("hot_bucket")
    )


@query(
    "row_key",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_orderkey || '_' || md5(CAST(l_linenumber AS VARCHAR)) AS field_key,
      md5(l_orderkey || '' || l_partkey) AS whole_key FROM lineitem
    """,
)
def row_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        tx.row_key(["l_orderkey", ("l_linenumber", True)], "_").alias("field_key"),
        tx.row_key(["l_orderkey", "l_partkey"], whole_md5=True).alias("whole_key"),
    )


@query(
    "plain_decimal",
    """
    SELECT o_orderkey, CAST(h AS VARCHAR) AS whole, CAST(o_orderkey * 4096 + 15 AS VARCHAR) AS narrow,
      CAST(o_orderkey // 1000 AS VARCHAR) || '.' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') || '5' AS ether
    FROM (SELECT *, CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 31) AS HUGEINT) AS h FROM orders)
    """,
)
def plain_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    digest = F.concat(F.lit("0x"), F.left(F.md5(key.cast("string")), F.lit(31)))
    narrow = F.concat(F.lit("0x"), F.hex(key), F.lit("00F"))
    wei = F.concat((key * 10 + 5).cast("string"), F.lit("0" * 14))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", tx.plain_decimal(digest).alias("whole"), tx.plain_decimal(narrow).alias("narrow"),
        tx.plain_decimal(wei, divide=True).alias("ether"),
    )


@query(
    "hex_chunks",
    """
    SELECT c_custkey, i AS pos, '0x' || substr(h, 64 * i + 1, 64) AS chunk
    FROM (SELECT c_custkey, repeat(md5(c_name), CAST(c_custkey % 7 AS INT)) || 'ab' AS h FROM customer),
      LATERAL (SELECT unnest(range(length(h) // 64)) AS i)
    """,
)
def hex_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = F.concat(F.lit("0x"), F.repeat(F.md5("c_name"), (F.col("c_custkey") % 7).cast("int")), F.lit("ab"))
    users = table(spark, sf_dir, "customer").select("c_custkey", payload.alias("payload"))
    return users.select("c_custkey", F.posexplode(tx.hex_chunks("payload")).alias("pos", "chunk"))


@query(
    "json_append",
    """
    SELECT event_id, CASE WHEN k % 3 = 0 THEN '["' || event_type || '"]' ELSE '["a","' || k || '","' || event_type || '"]' END AS items
    FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)
    """,
)
def json_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    items = F.when(k % 3 != 0, F.concat(F.lit('["a","'), k.cast("string"), F.lit('"]')))
    return with_k(table(spark, sf_dir, "events")).select("event_id", tx.json_list_append(items, "event_type").alias("items"))


@query(
    "day_range",
    """
    SELECT c_custkey, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS day FROM (
      SELECT c_custkey, unnest(generate_series(f, f + to_days(CAST(c_custkey % 9 AS INT)), INTERVAL 1 DAY)) AS d
      FROM (SELECT c_custkey, TIMESTAMP '2023-12-28' + to_days(CAST(c_custkey % 70 AS INT)) AS f FROM customer))
    """,
)
def day_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    first = F.date_add(F.lit("2023-12-28").cast("date"), (key % 70).cast("int"))
    days = tm.day_partitions(first, F.date_add(first, (key % 9).cast("int")))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.explode(days.cast("array<bigint>")).alias("day")
    )


# --- text -------------------------------------------------------------------------------------------


@query(
    "text_valid",
    """
    SELECT p_partkey, p_brand, p_name, regexp_full_match(p_brand, '[一-龥a-zA-Z0-9#]+') AS brand_ok,
      regexp_full_match(p_name, '[一-龥a-zA-Z0-9#]+') AS name_ok FROM part
    """,
)
def text_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", "p_name", tx.is_valid_text("p_brand").alias("brand_ok"), tx.is_valid_text("p_name").alias("name_ok")
    )


@query(
    "text_helpers",
    """
    SELECT p_partkey, upper(p_name[1]) || p_name[2:] AS capital, lower(p_type[1]) || p_type[2:] AS small,
      replace(p_name, ' ', ', ') AS csv, repeat('0', p_size % 4) AS zeros, p_size % 4 = 0 AS empty, true AS blank FROM part
    """,
)
def text_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    zeros = tx.zeros(F.col("p_size") % 4)
    return table(spark, sf_dir, "part").select(
        "p_partkey", tx.first_upper("p_name").alias("capital"), tx.first_lower("p_type").alias("small"),
        tx.join_list(F.split("p_name", " ")).alias("csv"), zeros.alias("zeros"), tx.is_empty(zeros).alias("empty"),
        tx.is_blank(F.repeat(F.lit(" "), F.col("p_size") % 4)).alias("blank"),
    )


@query(
    "date_strings",
    """
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, strftime(ts, '%Y%m%d') AS compact,
      epoch_us(date_trunc('second', ts)) // 1000 AS back, epoch_us(date_trunc('day', ts)) // 1000 AS day_ms,
      strftime(ts, '%Y-%m-%d') AS tolerant FROM events
    """,
)
def date_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ms = table(spark, sf_dir, "events").select("event_id", tm.to_millis("ts").alias("ms"))
    out = ms.select(
        "event_id", "ms", tm.millis_text("ms", tm.DATE).alias("day"), tm.millis_text("ms").alias("at"),
        tm.millis_text("ms", tm.COMPACT_DATE).alias("compact"),
    )
    # Half of the times reach the tolerant parser as epoch text, half as date text.
    mixed = F.when(F.col("event_id") % 2 == 0, F.col("ms").cast("string")).otherwise(F.col("at"))
    return out.select(
        "event_id", "day", "at", "compact", tm.text_millis("at").alias("back"), tm.text_millis("day", tm.DATE).alias("day_ms"),
        tm.day_text(mixed).alias("tolerant"),
    )


@query(
    "event_time_fallback",
    """
    SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS event_time FROM events
    """,
)
def event_time_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block time where present, else the record's own time, in seconds."""
    seconds = F.floor(tm.to_millis("ts") / 1000)
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 3 == 0, seconds).alias("block_timestamp"), seconds.alias("timestamp")
    )
    timed = tm.event_time(rows, ["block_timestamp", "timestamp"])
    return timed.select("event_id", F.date_format("event_time", tm.DATE_TIME).alias("event_time"))


@query(
    "round_half_up",
    "SELECT l_orderkey, l_linenumber, l_partkey, CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.0125, 3) AS DOUBLE) AS score FROM lineitem",
)
def round_half_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = half_up(F.col("l_extendedprice").cast("decimal(12,2)") * F.lit("0.0125").cast("decimal(5,4)"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", score.cast("double").alias("score"))


# --- reshape ----------------------------------------------------------------------------------------

STATUS = {"O": "open", "F": "filled", "P": "partial"}


@query(
    "pivot_status",
    f"""
    SELECT o_orderpriority, {', '.join(
      f"CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = '{s}') AS DOUBLE) AS {a}_amount, "
      f"max(o_orderkey) FILTER (o_orderstatus = '{s}') AS {a}_last" for s, a in STATUS.items())}
    FROM orders GROUP BY o_orderpriority
    """,
)
def pivot_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("amount", money("o_totalprice"))
    wide = pivot(orders, ["o_orderpriority"], "o_orderstatus", STATUS, {"amount": F.sum("amount"), "last": F.max("o_orderkey")})
    return as_double(wide, *[f"{a}_amount" for a in STATUS.values()])


MEASURES = {"l_quantity": "10", "l_extendedprice": "20", "l_tax": "30"}


@query(
    "unpivot_amounts",
    " UNION ALL ".join(
        f"SELECT l_orderkey, l_linenumber, '{label}' AS measure, {c} AS value FROM lineitem"
        + (" WHERE l_tax > 0" if c == "l_tax" else "")
        for c, label in MEASURES.items()
    ),
)
def unpivot_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A13; a zero tax is read as missing, and missing values give no row."""
    lines = table(spark, sf_dir, "lineitem").withColumn("l_tax", F.when(F.col("l_tax") > 0, F.col("l_tax")))
    return unpivot(lines, ["l_orderkey", "l_linenumber"], MEASURES, "measure", "value")
