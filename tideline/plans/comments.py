"""Moderation queries: J11, J19, F19-F21."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators import moderation
from tideline.operators.joins import members, membership
from tideline.plans.inputs import WORD_LIST, listed_words, money, table
from tideline.plans.registry import query


def _hash_sql(text: str, start: int = 1) -> str:
    return f"CAST('0x' || substr(md5({text}), {start}, 7) AS BIGINT)"


DOC = "CAST(doc_id AS VARCHAR)"
INJECTED = f"""
SELECT doc_id, CASE WHEN {_hash_sql(DOC)} % 100 < 20 THEN text || ',' || coalesce(s.words[{_hash_sql(DOC, 15)} % len(s.words) + 1], (SELECT min(word) FROM words))
  ELSE text END AS text
FROM documents LEFT JOIN (
  SELECT {_hash_sql('word')} % n AS slot, list(word ORDER BY word) AS words
  FROM words, (SELECT greatest(1, count(*) // 4) AS n FROM words) GROUP BY ALL) s
  ON {_hash_sql(DOC, 8)} % (SELECT greatest(1, count(*) // 4) FROM words) = s.slot
"""


def injected(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return moderation.inject_words(docs, listed_words(spark, sf_dir), "doc_id", "text")


@query("inject_words", f"WITH words AS ({WORD_LIST}) {INJECTED}")
def inject_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return injected(spark, sf_dir)


@query(
    "moderate_comments",
    f"""
    WITH words AS ({WORD_LIST}), d AS ({INJECTED}),
    t AS (SELECT *, split_part(rtrim(text, ','), ',', -1) AS token FROM d),
    p AS (SELECT t.*, token IN (SELECT word FROM words) AS hit FROM t),
    f AS (SELECT doc_id, string_agg(word, ', ' ORDER BY strpos(text, word), word) AS found
      FROM p JOIN words ON contains(text, word) WHERE NOT hit GROUP BY doc_id)
    SELECT p.doc_id, text AS msg, CAST(CASE WHEN hit THEN 1 ELSE 0 END AS BIGINT) AS is_violation,
      CASE WHEN hit THEN 'P0' WHEN found IS NOT NULL THEN 'P1' ELSE '' END AS violation_grade,
      CASE WHEN hit THEN token ELSE coalesce(found, '') END AS violation_msg
    FROM p LEFT JOIN f ON p.doc_id = f.doc_id
    """,
)
def moderate_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = listed_words(spark, sf_dir)
    checked = moderation.moderate(injected(spark, sf_dir), words, words, "text")
    return checked.select("doc_id", F.col("text").alias("msg"), F.col("is_violation").cast("bigint").alias("is_violation"),
                          "violation_grade", "violation_msg")


@query(
    "membership",
    """
    SELECT doc_id, label, label IN (SELECT 'src' || (item_id % 13) FROM benchmark) AS is_member
    FROM (SELECT *, CASE WHEN doc_id % 4 = 1 THEN 'no ' ELSE '' END || source AS label FROM documents)
    """,
)
def member_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return membership(_labelled(spark, sf_dir), "label", _sources(spark, sf_dir))


@query(
    "membership_filter",
    """
    SELECT doc_id, label FROM (SELECT *, CASE WHEN doc_id % 4 = 1 THEN 'no ' ELSE '' END || source AS label FROM documents)
    WHERE label IN (SELECT 'src' || (item_id % 13) FROM benchmark)
    """,
)
def member_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return members(_labelled(spark, sf_dir), "label", _sources(spark, sf_dir))


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("item_id") % 13
    return table(spark, sf_dir, "benchmark").select(F.concat(F.lit("src"), number.cast("string")).alias("word"))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by their source; every fourth has a source that is in no list."""
    label = F.concat(F.when(F.col("doc_id") % 4 == 1, "no ").otherwise(""), "source").alias("label")
    return table(spark, sf_dir, "documents").select("doc_id", label)


@query(
    "comment_order_join",
    """
    SELECT doc_id AS id, o_orderkey AS order_id, o_orderkey AS info_id, o_custkey AS info_user_id, o_orderstatus AS info_order_status,
      CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS info_total_amount
    FROM documents JOIN orders ON doc_id * 7 = o_orderkey WHERE abs(doc_id % 9 - 4) * 30 <= 60
    """,
)
def comment_order_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment and order at most a minute apart; a comment is up to two minutes from its order."""
    half_minutes = lambda number, shift: F.timestamp_seconds((number % 240 + shift) * 30 + 1_704_067_200)
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), (F.col("doc_id") * 7).alias("order_id"))
    comments = docs.withColumn("comment_ts", half_minutes(F.col("order_id"), F.col("id") % 9 - 4))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), F.col("o_orderstatus").alias("order_status"),
        money("o_totalprice").cast("double").alias("total_amount"),
    ).withColumn("order_ts", half_minutes(F.col("id"), F.lit(0)))
    return moderation.comments_with_orders(comments, orders, "comment_ts", "order_ts").drop("comment_ts")
