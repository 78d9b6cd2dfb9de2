"""Sources (S1-S11). Topic sources read files where no broker is at hand; options come from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.text import camel_name
from tideline.operators.cdc import parse_cdc, parse_json

BAND_MAPS = "map<string,map<string,double>>"


def topic(spark: SparkSession, servers: str, name: str, streaming: bool = True, **options: str) -> DataFrame:
    """Message values of a topic as text, from the earliest offset unless told otherwise."""
    reader = spark.readStream if streaming else spark.read
    settings = {"startingOffsets": "earliest", **options, "kafka.bootstrap.servers": servers, "subscribe": name}
    return reader.format("kafka").options(**settings).load().select(F.col("value").cast("string").alias("value"))


def message_files(spark: SparkSession, path: str, streaming: bool = False, **options: str) -> DataFrame:
    """Landed messages, one JSON text per line."""
    reader = spark.readStream if streaming else spark.read
    return reader.options(**options).text(path)


def change_events(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Landed change events as envelope columns."""
    return parse_cdc(message_files(spark, path, streaming))


def json_table(
    df: DataFrame, schema: T.StructType, view: str | None = None, computed: dict[str, object] | None = None,
    event_time: str | None = None, delay: str | None = None,
) -> DataFrame:
    """S3: typed, computed and watermarked columns of a JSON topic, optionally under a view name."""
    table = parse_json(df, schema)
    for name, column in (computed or {}).items():
        table = table.withColumn(name, column)
    if event_time and delay:
        table = table.withWatermark(event_time, delay)
    if view:
        table.createOrReplaceTempView(view)
    return table


def dimension(spark: SparkSession, path: str) -> DataFrame:
    """Dimension snapshot; lookups are equi-joins against it."""
    return spark.read.parquet(path)


def jdbc_snapshot(spark: SparkSession, url: str, query: str, camel: bool = False, **options: str) -> DataFrame:
    """Result of a database query; give partitionColumn, bounds and numPartitions to read in parallel."""
    rows = spark.read.format("jdbc").options(**{"url": url, "query": query, **options}).load()
    return camel_columns(rows) if camel else rows


def camel_columns(df: DataFrame) -> DataFrame:
    """snake_case column names as camelCase."""
    return df.toDF(*[camel_name(c) for c in df.columns])


def json_records(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON-lines records with a given schema (no inference pass)."""
    return spark.read.schema(schema).json(path)


def word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word per line; blank lines are not words."""
    return spark.read.text(path).select(F.trim("value").alias("word")).filter(F.col("word") != "")


def weight_table(spark: SparkSession, path: str) -> DataFrame:
    """Label -> band map rows of a weight file."""
    rows = spark.read.text(path).select(F.explode(F.from_json("value", BAND_MAPS)).alias("label", "bands"))
    return rows
