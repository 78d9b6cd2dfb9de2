"""Page-log queries: A3-A9, T3-T7, P9, P11-P13, P19, U1, J11-J15."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.text import words
from tideline.functions.time import to_millis
from tideline.operators import logs, metrics
from tideline.operators.cdc import parse_json
from tideline.operators.dedup import distinct_rows, first_per_key, last_per_window
from tideline.operators.joins import interval_join
from tideline.operators.visitors import first_visits, login_days, repair_visitor_flag
from tideline.plans.inputs import DAY, VIEWS, as_double, day_minutes, page_views, table, window_sql, with_k
from tideline.plans.registry import query
from tideline.schemas import COMMON

HOUR_S = 3600
DAY_TEXT = "yyyy-MM-dd"


# --- visits -----------------------------------------------------------------------------------------

FIRST_MID = """
SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY mid, CAST(event_time AS DATE) ORDER BY event_time) = 1
"""


@query(
    "traffic_window",
    f"""
    WITH v AS ({VIEWS}), u AS ({FIRST_MID})
    SELECT stt, edt, cur_date, vc, ch, ar, is_new, CAST(sum(pv) AS BIGINT) AS pv_ct, CAST(sum(uv) AS BIGINT) AS uv_ct,
      CAST(sum(sv) AS BIGINT) AS sv_ct, CAST(sum(dur) AS DOUBLE) AS dur_sum
    FROM (
      SELECT {window_sql('event_time', HOUR_S)}, vc, ch, ar, is_new, 1 AS pv, 0 AS uv,
        CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END AS sv, during_time AS dur FROM v
      UNION ALL
      SELECT {window_sql('event_time', HOUR_S)}, vc, ch, ar, is_new, 0, 1, 0, NULL FROM u)
    GROUP BY stt, edt, cur_date, vc, ch, ar, is_new
    """,
)
def traffic_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_double(metrics.traffic(page_views(spark, sf_dir), "event_time", "1 hour"), "dur_sum")


@query(
    "first_visit",
    f"""
    WITH v AS ({VIEWS}), u AS ({FIRST_MID})
    SELECT mid, strftime(event_time, '%Y-%m-%d') AS visit_date, ts, vc, page_id FROM u
    """,
)
def first_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    firsts = first_visits(page_views(spark, sf_dir), ["mid"], "event_time", ["ts", "vc", "page_id"])
    return firsts.select("mid", F.date_format("visit_date", DAY_TEXT).alias("visit_date"), "ts", "vc", "page_id")


@query(
    "home_detail_uv",
    f"""
    WITH v AS (SELECT * FROM ({VIEWS}) WHERE page_id IN ('home', 'good_detail')), u AS (
      SELECT * FROM v QUALIFY row_number() OVER (
        PARTITION BY mid, page_id, CAST(event_time AS DATE) ORDER BY event_time) = 1)
    SELECT {window_sql('event_time', HOUR_S)}, count(*) FILTER (page_id = 'home') AS home_uv_ct,
      count(*) FILTER (page_id = 'good_detail') AS detail_uv_ct FROM u GROUP BY ALL
    """,
)
def home_detail_uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = logs.on_pages(page_views(spark, sf_dir), "home", "good_detail")
    return metrics.home_detail_visitors(views, "event_time", "1 hour")


LOGINS = f"""
SELECT uid, CAST(event_time AS DATE) AS d, min(event_time) AS t FROM ({VIEWS}) WHERE uid IS NOT NULL
  AND last_page_id IS NOT NULL GROUP BY ALL
"""
BACK = "CASE WHEN date_diff('day', lag(d) OVER (PARTITION BY uid ORDER BY d), d) >= {n} THEN 1 ELSE 0 END"


@query(
    "login_uu_back",
    f"""
    SELECT {window_sql('t', DAY)}, count(*) AS uu_ct, CAST(sum(b) AS BIGINT) AS back_ct
    FROM (SELECT *, {BACK.format(n=3)} AS b FROM ({LOGINS})) GROUP BY ALL
    """,
)
def login_uu_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 with an absence of 3 days: the given log covers 30 days."""
    views = logs.with_user_and_last_page(page_views(spark, sf_dir))
    return metrics.logins(views, "event_time", "1 day", return_days=3)


@query(
    "returning_users",
    f"""
    SELECT uid, strftime(d, '%Y-%m-%d') AS visit_date, CAST({BACK.format(n=8)} AS BIGINT) AS back_ct FROM (
      SELECT user_id AS uid, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'purchase' GROUP BY ALL)
    """,
)
def returning_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T6 on purchases, with the documented 8 days."""
    bought = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase").withColumnRenamed("user_id", "uid")
    days = login_days(bought, "uid", "ts")
    return days.select("uid", F.date_format("visit_date", DAY_TEXT).alias("visit_date"), "back_ct")


@query(
    "cart_uu",
    f"""
    SELECT {window_sql('t', HOUR_S)}, count(*) AS cart_add_uu_ct FROM (
      SELECT user_id, CAST(ts AS DATE) AS d, min(ts) AS t FROM events WHERE event_type = 'purchase' GROUP BY ALL)
    GROUP BY ALL
    """,
)
def cart_uu(spark: SparkSession, sf_dir: str) -> DataFrame:
    carts = table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return metrics.cart_users(carts, "ts", "1 hour")


@query(
    "visitor_flag_repair",
    f"""
    WITH v AS ({VIEWS}), s AS (
      SELECT mid, CASE WHEN is_new = '1' THEN CAST(event_time AS DATE) ELSE CAST(event_time AS DATE) - 1 END AS first_day
      FROM v QUALIFY row_number() OVER (PARTITION BY mid ORDER BY event_time, event_id) = 1)
    SELECT event_id, v.mid, CASE WHEN is_new = '1' AND CAST(event_time AS DATE) <> first_day THEN '0' ELSE is_new END
      AS is_new FROM v JOIN s ON v.mid = s.mid
    """,
)
def visitor_flag_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = page_views(spark, sf_dir).select("event_id", "mid", "event_time", "is_new")
    return repair_visitor_flag(views, "mid", "event_time", "is_new", ["event_id"]).drop("event_time")


# --- filters and projections ------------------------------------------------------------------------


@query(
    "page_filter",
    f"""
    SELECT event_id, uid, mid, page_id, last_page_id FROM ({VIEWS})
    WHERE uid IS NOT NULL AND last_page_id IS NOT NULL AND mid <> '' AND page_id IN ('home', 'good_detail')
    """,
)
def page_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = logs.on_pages(logs.with_user_and_last_page(page_views(spark, sf_dir)), "home", "good_detail")
    return logs.with_device(views).select("event_id", "uid", "mid", "page_id", "last_page_id")


@query(
    "device_keyword_rows",
    f"""
    SELECT uid, ar, ba, ch, md, split_part(os, ' ', 1) AS os, vc, ts, item AS keyword FROM ({VIEWS})
    WHERE item_type = 'keyword' AND uid IS NOT NULL
    """,
)
def device_keyword_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.device_keywords(page_views(spark, sf_dir))


@query(
    "drop_struct_fields",
    f"SELECT event_id, to_json({{ba: ba, ch: ch, os: os, vc: vc}}) AS common FROM ({VIEWS})",
)
def drop_struct_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = page_views(spark, sf_dir).select("event_id", F.struct("ba", "ch", "is_new", "mid", "os", "sid", "vc").alias("common"))
    return logs.drop_common_fields(nested).select("event_id", F.to_json("common").alias("common"))


def log_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """App logs as JSON text: start, page, displays, actions and err parts by event."""
    events = with_k(table(spark, sf_dir, "events"))
    kind, k = F.col("event_type"), F.col("k")
    part = lambda cond, name: F.when(cond, F.create_map(F.lit("n"), k.cast("string"))).alias(name)
    many = lambda cond, name: F.when(cond, F.array(F.create_map(F.lit("n"), k.cast("string")))).alias(name)
    body = F.to_json(
        F.struct(
            F.struct(F.concat(F.lit("mid_"), F.col("user_id").cast("string")).alias("mid")).alias("common"),
            part(kind == "signup", "start"),
            F.when(kind != "signup", F.struct(kind.alias("page_id"))).alias("page"),
            many(k % 2 == 0, "displays"),
            many(k % 3 == 0, "actions"),
            part(kind == "error", "err"),
            to_millis("ts").alias("ts"),
        )
    )
    return events.select("event_id", body.alias("value"))


@query(
    "log_split",
    """
    SELECT tag, count(*) AS log_ct, CAST(sum(event_id) AS BIGINT) AS id_sum FROM (
      SELECT event_id, unnest(list_filter([
        CASE WHEN event_type = 'signup' THEN 'start' END, CASE WHEN event_type <> 'signup' THEN 'page' END,
        CASE WHEN k % 2 = 0 THEN 'displays' END, CASE WHEN k % 3 = 0 THEN 'actions' END,
        CASE WHEN event_type = 'error' THEN 'err' END], lambda x: x IS NOT NULL)) AS tag
      FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM events)) GROUP BY tag
    """,
)
def log_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    split = logs.split_logs(log_messages(spark, sf_dir))
    return split.groupBy("tag").agg(F.count("*").alias("log_ct"), F.sum("event_id").alias("id_sum"))


# --- keywords ---------------------------------------------------------------------------------------

KEYWORD_KEYS = ["keyword", "ba", "uid", "os", "vc", "md"]


@query(
    "keyword_window",
    f"""
    SELECT {window_sql('event_time', DAY)}, {', '.join(KEYWORD_KEYS)}, count(*) AS keyword_count FROM (
      SELECT *, unnest(regexp_extract_all(lower(item), '[\\p{{L}}\\p{{N}}]+')) AS keyword FROM ({VIEWS})
      WHERE last_page_id = 'search' AND item_type = 'keyword' AND item IS NOT NULL) GROUP BY ALL
    """,
)
def keyword_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = logs.searches(page_views(spark, sf_dir))
    exploded = found.withColumn("keyword", F.explode(words("full_word")))
    return metrics.keyword_counts(exploded, "event_time", "1 day", KEYWORD_KEYS)


@query(
    "keyword_window_documents",
    f"""
    SELECT {window_sql('t', DAY)}, lang, keyword, count(*) AS keyword_count FROM (
      SELECT lang, TIMESTAMP '2024-01-01' + to_minutes(CAST(doc_id AS BIGINT)) AS t,
        unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS keyword FROM documents) GROUP BY ALL
    """,
)
def keyword_window_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A7 over whole documents as search texts."""
    docs = table(spark, sf_dir, "documents").select(
        day_minutes(F.col("doc_id")).alias("t"), "lang", F.explode(words("text")).alias("keyword")
    )
    return metrics.keyword_counts(docs, "t", "1 day", ["lang", "keyword"])


@query(
    "keyword_freq",
    """
    SELECT keyword, count(*) AS keyword_count FROM (
      SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS keyword FROM documents) GROUP BY keyword
    """,
)
def keyword_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.explode(words("text")).alias("keyword"))
    return metrics.report(docs, ["keyword"], count="keyword_count")


# --- duplicates -------------------------------------------------------------------------------------


@query(
    "dedup_user_ts",
    """
    SELECT user_id, epoch_us(ts) // 1000 AS ts_ms, min(event_id) AS event_id FROM events
    GROUP BY user_id, epoch_us(ts) // 1000
    """,
)
def dedup_user_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", to_millis("ts").alias("ts_ms"), "event_id")
    replayed = events.unionByName(events.withColumn("event_id", F.col("event_id") + 1_000_000_000))
    return first_per_key(replayed, ["user_id", "ts_ms"], ["event_id"])


@query(
    "dedup_full_row",
    "SELECT event_id, user_id, event_type, value, props, epoch_us(ts) // 1000 AS ts_ms FROM events",
)
def dedup_full_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "props", to_millis("ts").alias("ts_ms"))
    return distinct_rows(events.unionByName(events))


@query(
    "last_per_window",
    f"""
    SELECT {window_sql('ts', DAY)}, user_id, event_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def last_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value", "ts")
    kept = last_per_window(events, ["user_id"], "ts", "1 day", ["ts", "event_id"])
    return kept.select(*metrics.window_bounds(), "user_id", "event_id", "event_type", "value")


# --- interval joins ---------------------------------------------------------------------------------


@query(
    "interval_join_view_purchase",
    """
    SELECT l.event_id, l.user_id, r.event_id AS info_event_id, r.value AS info_value
    FROM events l JOIN events r ON l.user_id = r.user_id AND r.ts BETWEEN l.ts - INTERVAL 6 HOUR AND l.ts + INTERVAL 1 DAY
    WHERE l.event_type = 'view' AND r.event_type = 'purchase'
    """,
)
def interval_join_view_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    views = events.filter(F.col("event_type") == "view").select("event_id", "user_id", "ts")
    bought = events.filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts", "value")
    joined = interval_join(
        views, bought, "user_id", "ts", "ts", -timedelta(hours=6), timedelta(days=1), ["event_id", "value"], "info_"
    )
    return joined.drop("ts")


@query(
    "interval_join_left",
    """
    SELECT l.event_id, l.user_id, r.event_id AS info_event_id
    FROM (SELECT * FROM events WHERE event_type = 'view') l
    LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') r
      ON l.user_id = r.user_id AND r.ts BETWEEN l.ts - INTERVAL 1 MINUTE AND l.ts + INTERVAL 1 HOUR
    """,
)
def interval_join_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    views = events.filter(F.col("event_type") == "view").drop("event_type")
    clicks = events.filter(F.col("event_type") == "click")
    joined = interval_join(
        views, clicks, "user_id", "ts", "ts", -timedelta(minutes=1), timedelta(hours=1), ["event_id"], "info_", how="left"
    )
    return joined.drop("ts")


# --- user sets --------------------------------------------------------------------------------------

SET_FIELDS = ["os", "ch", "md", "ba", "keyword"]
SETS = f"(SELECT *, CASE WHEN item_type = 'keyword' THEN item END AS keyword FROM ({VIEWS}) WHERE uid IS NOT NULL)"


def _set_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = page_views(spark, sf_dir).filter(F.col("uid").isNotNull())
    return views.withColumn("keyword", F.when(F.col("item_type") == "keyword", F.col("item")))


@query(
    "user_value_sets",
    f"""
    SELECT uid, count(*) AS pv, {', '.join(
        f"coalesce(array_to_string(list_sort(list_distinct(list({f}))), ','), '') AS {f}" for f in SET_FIELDS)}
    FROM {SETS} GROUP BY uid
    """,
)
def user_value_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.user_value_sets(_set_rows(spark, sf_dir), "uid", SET_FIELDS)


@query(
    "user_cumulative_pv",
    f"""
    SELECT uid, event_id, count(*) OVER w AS pv, {', '.join(
        f"coalesce(array_to_string(list_sort(list_distinct(list({f}) OVER w)), ','), '') AS {f}" for f in SET_FIELDS)}
    FROM {SETS} WINDOW w AS (PARTITION BY uid ORDER BY event_time, event_id ROWS UNBOUNDED PRECEDING)
    """,
)
def user_cumulative_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _set_rows(spark, sf_dir).select("uid", "event_id", "event_time", *SET_FIELDS)
    return metrics.user_running_sets(rows, "uid", "event_time", ["event_id"], SET_FIELDS).drop("event_time")


@query(
    "app_log_table",
    f"""
    SELECT event_id, mid, page_id, epoch_us(event_time) // 1000 AS ts FROM ({VIEWS}) WHERE page_id <> 'register'
    """,
)
def app_log_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: JSON logs as a typed table."""
    schema = T.StructType(
        [
            T.StructField("common", COMMON),
            T.StructField("page", T.StructType([T.StructField("page_id", T.StringType())])),
            T.StructField("ts", T.LongType()),
        ]
    )
    parsed = parse_json(log_messages(spark, sf_dir), schema, keep=["event_id"]).filter(F.col("page").isNotNull())
    kinds = {"view": "home", "click": "good_detail", "purchase": "trade"}
    page = F.col("page.page_id")
    named = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for p in kinds.items() for x in p]), page), page)
    return parsed.select("event_id", "common.mid", named.alias("page_id"), "ts")
