"""Source and sink queries: S6, S7, S9, S10, K1-K9. Each writes to a folder of its own and reads it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.time import to_millis
from tideline.operators.dims import row_count, scan
from tideline.plans.inputs import WORD_LIST, listed_words, table
from tideline.plans.registry import query
from tideline.session import scratch
from tideline.sinks.writers import (
    read_snapshot, topic_frame, upsert_batch, write_batch, write_by_day, write_csv,
)
from tideline.sources.readers import json_records, word_list


@query(
    "day_partition_sink",
    """
    SELECT CASE WHEN event_id % 10 = 0 THEN 'error_bucket' ELSE strftime(ts, '%Y%m%d') END AS day, count(*) AS row_ct,
      CAST(sum(event_id) AS BIGINT) AS id_sum FROM events GROUP BY ALL
    """,
)
def day_partition_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: times in milliseconds, in seconds and unreadable."""
    number, ms = F.col("event_id"), to_millis("ts")
    at = F.when(number % 10 == 0, F.lit('"x"')).when(number % 2 == 0, F.floor(ms / 1000).cast("string")).otherwise(ms.cast("string"))
    value = F.concat(F.lit('{"id":'), number.cast("string"), F.lit(',"ts":'), at, F.lit("}"))
    path = scratch(spark, "days")
    write_by_day(table(spark, sf_dir, "events").select(value.alias("value")), path, "ts")
    back = spark.read.option("inferSchema", False).text(path)
    return back.groupBy(F.col("day").cast("string").alias("day")).agg(
        F.count("*").alias("row_ct"), F.sum(F.get_json_object("value", "$.id").cast("bigint")).alias("id_sum")
    )


@query(
    "csv_nested",
    """
    SELECT event_id, event_type, CASE WHEN event_id % 5 <> 0 THEN 'say "' || event_type || '", ok' END AS note,
      '{"k":"' || event_type || '"}' AS tags FROM events
    """,
)
def csv_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: quotes, commas, nulls and a nested map."""
    kind = F.col("event_type")
    rows = table(spark, sf_dir, "events").select(
        "event_id", "event_type",
        F.when(F.col("event_id") % 5 != 0, F.concat(F.lit('say "'), kind, F.lit('", ok'))).alias("note"),
        F.create_map(F.lit("k"), kind).alias("tags"),
    )
    path = scratch(spark, "csv")
    write_csv(rows, path)
    back = spark.read.schema("event_id bigint, event_type string, note string, tags string").options(
        header="true", enforceSchema="true", quote='"', escape='"'
    ).csv(path)
    return back


USER_COLUMNS = ["c_custkey", "c_name", "c_mktsegment", "c_acctbal", "version"]


def _user_versions(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Two micro-batches: all users with an older copy, then renamed and deleted ones."""
    users = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    first = users.withColumns({"version": F.lit(1), "op": F.lit("r")})
    older = users.withColumns({"version": F.lit(0), "op": F.lit("r"), "c_name": F.lit("old")})
    key = F.col("c_custkey")
    renamed = users.filter(key % 3 == 0).withColumns({"version": F.lit(2), "op": F.lit("u"), "c_name": F.concat("c_name", F.lit("+"))})
    deleted = users.filter(key % 5 == 0).withColumns({"version": F.lit(3), "op": F.lit("d")})
    return [older.unionByName(first), renamed.unionByName(deleted)]


SNAPSHOT_SQL = """
SELECT c_custkey, c_name || CASE WHEN c_custkey % 3 = 0 THEN '+' ELSE '' END AS c_name, c_mktsegment, c_acctbal,
  CAST(CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS version FROM customer WHERE c_custkey % 5 <> 0
"""


def user_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "dim_user")
    for number, batch in enumerate(_user_versions(spark, sf_dir)):
        for _ in range(2):  # a replayed batch must not change the result
            upsert_batch(batch, number, path, ["c_custkey"], ["version"], F.col("op") == "d")
    return read_snapshot(spark, path, ["c_custkey"], ["version"]).select(*USER_COLUMNS).withColumn("version", F.col("version").cast("bigint"))


@query("dim_upsert", SNAPSHOT_SQL)
def dim_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_snapshot(spark, sf_dir)


@query("dim_count", "SELECT count(*) AS row_count FROM customer WHERE c_custkey % 5 <> 0")
def dim_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_count(user_snapshot(spark, sf_dir))


@query(
    "dim_scan",
    "SELECT p_partkey, p_name, p_brand, CAST(p_partkey AS VARCHAR) AS row_key FROM part",
)
def dim_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 without a limit; the limited form is covered by a test, as its choice of rows is free."""
    return scan(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand"), "p_partkey")


@query(
    "olap_batches",
    """
    SELECT o_orderstatus AS status, count(*) AS order_ct, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders GROUP BY ALL
    """,
)
def olap_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: batches written twice count once."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    path = scratch(spark, "olap")
    for number, status in enumerate(["O", "F", "P", "O"]):
        write_batch(orders.filter(F.col("status") == status), number % 3, path)
    back = spark.read.parquet(path)
    return back.groupBy("status").agg(F.count("*").alias("order_ct"), F.sum("o_orderkey").alias("key_sum"))


@query(
    "topic_frame",
    """
    SELECT 'dwd_' || lower(o_orderstatus) AS topic, CAST(o_orderkey AS VARCHAR) AS key,
      '{"o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority || '"}' AS value FROM orders
    """,
)
def topic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1-K3: destination, key and JSON value of each row; internal fields are hidden."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return topic_frame(orders, F.concat(F.lit("dwd_"), F.lower("o_orderstatus")), "o_orderkey", hide=("o_orderstatus",))


@query("read_json_lines", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def read_json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "json")
    table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice").write.json(path)
    return json_records(spark, path, "o_orderkey bigint, o_orderstatus string, o_totalprice double")


@query("read_word_list", WORD_LIST)
def read_word_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "words")
    words = listed_words(spark, sf_dir)
    words.select(F.concat(F.lit(" "), "word").alias("value")).write.text(path)
    return word_list(spark, path)
