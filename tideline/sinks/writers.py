"""Sinks (K1-K10).

Streaming sinks run in ``foreachBatch`` and are safe to replay: a batch writes under its own id and
replaces what an earlier attempt of the same batch left. Batch ids start at 0 again with a new checkpoint, so they
stand below the id of the run, which a restart from the same checkpoint keeps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.utils import AnalysisException

from tideline.functions.time import COMPACT_DATE, from_epoch
from tideline.operators.dedup import latest_per_key
from tideline.operators.metrics import preaggregated

ERROR_BUCKET = "error_bucket"
FILE_ROWS = 5_000_000
# Folders that a task writes to at the same time; with more of them Spark sorts the rest.
OPEN_FOLDERS = 16
BOM = "﻿"


def to_json_text(*columns: str, hide: tuple[str, ...] = (), keep_nulls: bool = False) -> Column:
    """K8: named columns as JSON text, without the hidden ones."""
    shown = [c for c in columns if c not in hide]
    return F.to_json(F.struct(*shown), {"ignoreNullFields": str(not keep_nulls).lower()})


def topic_frame(df: DataFrame, topic: Column | str, key: str | None = None, hide: tuple[str, ...] = ()) -> DataFrame:
    """K1-K3: the (topic, key, value) frame a topic sink takes; ``topic`` may differ per row (K2)."""
    destination = topic if isinstance(topic, Column) else F.lit(topic)
    body = to_json_text(*[c for c in df.columns], hide=hide)
    return df.select(
        destination.alias("topic"),
        (F.col(key).cast("string") if key else F.lit(None).cast("string")).alias("key"),
        body.alias("value"),
    )


def stream_to_topic(frame: DataFrame, servers: str, checkpoint: str, **options: str) -> DataStreamWriter:
    """K1: at-least-once topic sink (``kafka.acks=all`` for the idempotent variant)."""
    settings = {"kafka.bootstrap.servers": servers, "checkpointLocation": checkpoint, **options}
    return frame.writeStream.format("kafka").options(**settings)


def write_topic(frame: DataFrame, servers: str, **options: str) -> None:
    """K3: batch write to a topic."""
    frame.write.format("kafka").options(**{"kafka.bootstrap.servers": servers, **options}).save()


def balanced(df: DataFrame, column: str) -> DataFrame:
    """Rows of a folder together, so that not every task writes a small file per folder; AQE cuts folders
    that are large into several tasks and joins small ones."""
    return df.hint("rebalance", column)


@contextmanager
def open_folders(spark: SparkSession, most: int = OPEN_FOLDERS) -> Iterator[None]:
    """While it lasts, a task writes to several folders at a time instead of sorting its rows by folder, which would hold
    them all. A session's own setting wins."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    if int(before):
        yield
        return
    spark.conf.set(key, most)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def run_id(spark: SparkSession) -> str:
    """Inside ``foreachBatch`` the id of the streaming query, which its checkpoint keeps; elsewhere ``batch``."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def _batch_folder(df: DataFrame, path: str, batch_id: int, run: str | None = None) -> str:
    """``run`` names the run where a batch may be written again from outside of its streaming query."""
    return f"{path}/run={run or run_id(df.sparkSession)}/batch_id={batch_id}"


def write_by_destination(
    frame: DataFrame, path: str, column: str = "sink_table", mode: str = "append", batch_id: int | None = None
) -> None:
    """K2 on files: one folder per destination; with ``batch_id`` below a folder that a replay replaces."""
    target, mode = (path, mode) if batch_id is None else (_batch_folder(frame, path, batch_id), "overwrite")
    with open_folders(frame.sparkSession):
        balanced(frame, column).write.mode(mode).option("maxRecordsPerFile", FILE_ROWS).partitionBy(column).parquet(target)


def destination_writer(path: str, column: str = "sink_table") -> Callable[[DataFrame, int], None]:
    """K2 for ``foreachBatch``."""
    return lambda df, batch_id: write_by_destination(df, path, column, batch_id=batch_id)


def day_bucket(value: Column | str, field: str) -> Column:
    """K7: yyyyMMdd of a seconds-or-milliseconds field of a JSON text, or the error bucket."""
    raw = F.get_json_object(value, f"$.{field}")
    number = F.when(raw.rlike("^-?[0-9]+$"), raw.try_cast("bigint"))
    return F.coalesce(F.date_format(from_epoch(number), COMPACT_DATE), F.lit(ERROR_BUCKET))


def write_by_day(
    df: DataFrame, path: str, field: str, value: str = "value", mode: str = "append", batch_id: int | None = None
) -> None:
    """K7: text files in ``day=yyyyMMdd`` folders; with ``batch_id`` below a folder that a replay replaces."""
    rows = df.select(F.col(value).alias("value"), day_bucket(value, field).alias("day"))
    target, mode = (path, mode) if batch_id is None else (_batch_folder(df, path, batch_id), "overwrite")
    with open_folders(df.sparkSession):
        balanced(rows, "day").write.mode(mode).option("maxRecordsPerFile", FILE_ROWS).partitionBy("day").text(target)


def day_writer(path: str, field: str, value: str = "value") -> Callable[[DataFrame, int], None]:
    """K7 for ``foreachBatch``."""
    return lambda df, batch_id: write_by_day(df, path, field, value, batch_id=batch_id)


def write_csv(df: DataFrame, path: str, bom: bool = True, mode: str = "errorifexists") -> None:
    """K9: CSV with header and byte order mark; nulls are empty, nested values are JSON text."""
    flat = [
        F.to_json(F.col(f.name)).alias(f.name) if f.dataType.typeName() in ("map", "array", "struct") else F.col(f.name)
        for f in df.schema.fields
    ]
    rows = df.select(*flat)
    if bom:
        rows = rows.toDF(BOM + rows.columns[0], *rows.columns[1:])
    rows.write.mode(mode).options(header="true", quote='"', escape='"', nullValue="", emptyValue="").csv(path)


def write_batch(df: DataFrame, batch_id: int, path: str, run: str | None = None) -> None:
    """K5: rows of one micro-batch under their run and batch id; a replay replaces them."""
    df.write.mode("overwrite").parquet(_batch_folder(df, path, batch_id, run))


def batch_writer(path: str, run: str | None = None) -> Callable[[DataFrame, int], None]:
    return lambda df, batch_id: write_batch(df, batch_id, path, run)


def totals_writer(path: str, keys: list[str], sums: dict[str, Column], run: str | None = None) -> Callable[[DataFrame, int], None]:
    """Adds each micro-batch to a table of totals, as one row per key and batch."""
    return lambda df, batch_id: write_batch(preaggregated(df, keys, sums), batch_id, path, run)


def read_totals(spark: SparkSession, path: str, keys: list[str], names: list[str]) -> DataFrame:
    """Current totals of a table kept by ``totals_writer``."""
    return preaggregated(spark.read.parquet(path), keys, {n: F.col(n) for n in names})


def land_by_table(changes: DataFrame, path: str, mode: str = "append") -> None:
    """Parsed change events in a folder per source table, so that one table is read by partition pruning.

    The events are the widest rows there are, so they are written where they are parsed, a file per task and table.
    """
    named = changes.withColumn("table", F.col("source")["table"])
    with open_folders(changes.sparkSession):
        named.write.mode(mode).option("compression", "zstd").partitionBy("table").parquet(path)


DELETED = "_deleted"
# When a row came to the target: orders batches over runs. Only the last batch is ever replayed, so it stays last.
WRITTEN = "_written"


def upsert_batch(
    df: DataFrame, batch_id: int, path: str, keys: list[str], order: list[str], deleted: Column | None = None,
    skip_empty: bool = False,
) -> None:
    """K4/K6: newest row per key of a micro-batch, appended to the change log of the target.

    Cost follows the batch, not the target. ``deleted`` marks rows that remove their key; ``skip_empty``
    leaves rows without any value out.
    """
    rows = df.dropna(subset=keys).withColumn(DELETED, F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False))
    if skip_empty:
        values = [c for c in df.columns if c not in (*keys, *order)]
        rows = rows.filter(F.col(DELETED) | F.coalesce(*[F.col(c).cast("string") for c in values]).isNotNull())
    write_batch(latest_per_key(rows, keys, order).withColumn(WRITTEN, F.current_timestamp()), batch_id, path)


def upserter(path: str, keys: list[str], order: list[str], deleted: Column | None = None, skip_empty: bool = False):
    """K4/K6 for ``foreachBatch``."""
    return lambda df, batch_id: upsert_batch(df, batch_id, path, keys, order, deleted, skip_empty)


def _newest(spark: SparkSession, path: str, keys: list[str], order: list[str], by_batch: bool) -> DataFrame:
    """Newest row per key of a change log, delete marks included."""
    came = [WRITTEN, "batch_id"]
    ranking = [*came, *order] if by_batch else [*order, *came]
    return latest_per_key(spark.read.parquet(path), keys, ranking).drop("run", "batch_id")


def read_snapshot(spark: SparkSession, path: str, keys: list[str], order: list[str], by_batch: bool = False) -> DataFrame:
    """Current rows of an upsert target: newest per key over all batches, without deleted keys.

    ``order`` decides across batches, the later batch breaks ties; with ``by_batch`` the later batch always wins.
    """
    return _newest(spark, path, keys, order, by_batch).filter(~F.col(DELETED)).drop(DELETED, WRITTEN)


def compact(
    spark: SparkSession, path: str, target: str, keys: list[str], order: list[str], batch_id: int, by_batch: bool = False
) -> None:
    """The newest row of every key as one batch of a new target, to which later batches can be appended.

    Deleted keys keep their marks, with their order, so that an older change that comes later doesn't bring them back.
    """
    write_batch(_newest(spark, path, keys, order, by_batch), batch_id, target)


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
        return True
    except AnalysisException:
        return False


def console(df: DataFrame, **options: str) -> DataStreamWriter:
    """K10."""
    return df.writeStream.format("console").options(**options)
