"""Warehouse inputs derived from the given tables, in Spark and as SQL fragments for the oracle.

lineitem = order lines with versions, orders = order headers, customer = users, nation = provinces,
part = skus, events = page logs, documents = comments and search text, benchmark = word list.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.text import words
from tideline.functions.time import to_millis
from tideline.operators.dedup import latest_per_key
from tideline.session import pin_time_zone

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_VERSION = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_time_zone(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def money(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def as_double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def day_minutes(number: Column, start: str = "2024-01-01") -> Column:
    """A time that many minutes after a date."""
    return (F.lit(start).cast("timestamp").cast("bigint") + number * 60).cast("timestamp")


# --- page views from events -------------------------------------------------------------------------

VIEWS = """
SELECT event_id, ts AS event_time, epoch_us(ts) // 1000 AS ts,
  'mid_' || user_id AS mid,
  CASE WHEN user_id % 50 <> 7 THEN CAST(user_id AS VARCHAR) END AS uid,
  'v' || (user_id % 3) AS vc, 'ch' || (user_id % 4) AS ch, CAST(user_id % 25 AS VARCHAR) AS ar,
  CASE WHEN event_type = 'signup' OR k % 6 = 0 THEN '1' ELSE '0' END AS is_new,
  'ba' || (user_id % 5) AS ba, 'md' || (event_id % 3) AS md,
  CASE WHEN user_id % 2 = 0 THEN 'iOS 13.3' ELSE 'Android 11' END AS os,
  'sid_' || (event_id // 8) AS sid,
  CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail' WHEN 'purchase' THEN 'trade'
    WHEN 'signup' THEN 'register' ELSE 'error' END AS page_id,
  CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN 'search' ELSE 'home' END AS last_page_id,
  CASE WHEN k % 10 <> 3 THEN 'red Word' || (k % 20) END AS item,
  CASE WHEN k % 2 = 1 THEN 'keyword' ELSE 'sku_id' END AS item_type,
  CAST(value AS DECIMAL(18,2)) AS during_time, k
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)
"""


def with_k(events: DataFrame) -> DataFrame:
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))


def page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat page views; the same columns as VIEWS."""
    e = with_k(table(spark, sf_dir, "events"))
    user, k, kind = F.col("user_id"), F.col("k"), F.col("event_type")
    text = lambda prefix, number: F.concat(F.lit(prefix), number.cast("string"))
    return e.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("event_time"),
        to_millis("ts").alias("ts"),
        text("mid_", user).alias("mid"),
        F.when(user % 50 != 7, user.cast("string")).alias("uid"),
        text("v", user % 3).alias("vc"),
        text("ch", user % 4).alias("ch"),
        (user % 25).cast("string").alias("ar"),
        F.when((kind == "signup") | (k % 6 == 0), "1").otherwise("0").alias("is_new"),
        text("ba", user % 5).alias("ba"),
        text("md", F.col("event_id") % 3).alias("md"),
        F.when(user % 2 == 0, "iOS 13.3").otherwise("Android 11").alias("os"),
        text("sid_", F.floor(F.col("event_id") / 8)).alias("sid"),
        F.when(kind == "view", "home").when(kind == "click", "good_detail").when(kind == "purchase", "trade")
        .when(kind == "signup", "register").otherwise("error").alias("page_id"),
        F.when(k % 4 == 0, None).when(k % 4 == 1, "search").otherwise("home").alias("last_page_id"),
        F.when(k % 10 != 3, text("red Word", k % 20)).alias("item"),
        F.when(k % 2 == 1, "keyword").otherwise("sku_id").alias("item_type"),
        money("value").alias("during_time"),
        "k",
    )


# --- order lines ------------------------------------------------------------------------------------

LATEST_LINES = f"""
SELECT * FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY {', '.join(LINE_KEY)} ORDER BY {', '.join(c + ' DESC' for c in LINE_VERSION)}) = 1
"""


def latest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 on lineitem: one row per line key."""
    return latest_per_key(table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_VERSION)


def line_id() -> Column:
    return F.concat_ws("-", *[F.col(c).cast("string") for c in LINE_KEY])


LINE_ID = "l_orderkey || '-' || l_linenumber"

# --- words ------------------------------------------------------------------------------------------

WORD_LIST = """
SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS word FROM benchmark
"""


def listed_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The moderation list: distinct words of benchmark."""
    return table(spark, sf_dir, "benchmark").select(F.explode(words("text")).alias("word")).distinct()


# --- window helpers for the oracle ------------------------------------------------------------------


def window_sql(ts: str, seconds: int) -> str:
    """stt, edt and cur_date of an epoch-aligned tumbling window."""
    start = f"make_timestamp((epoch_us({ts}) // {seconds * 1_000_000}) * {seconds * 1_000_000})"
    end = f"make_timestamp((epoch_us({ts}) // {seconds * 1_000_000} + 1) * {seconds * 1_000_000})"
    return (
        f"strftime({start}, '%Y-%m-%d %H:%M:%S') AS stt, strftime({end}, '%Y-%m-%d %H:%M:%S') AS edt, "
        f"strftime({start}, '%Y-%m-%d') AS cur_date"
    )


DAY = 86_400
