"""Sharding (operator 13): jump consistent hashing, which needs no table of the shards.

A key walks through ever larger shard counts, jumping from the count at which it last changed its shard to the next
one, both drawn from a generator seeded by the key; its shard is the last stop below the count. A larger count only
adds stops, so a key either stays or goes to a new shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import IntegerType, StructField, StructType

from tideline.llm.registry import query, table
from tideline.operators.joins import small_side
from tideline.session import scratch

SHARDS = 16

# Fixed values of the published algorithm: the multiplier of its generator, and its 31-bit range.
MULTIPLIER = 2862933555777941757
RANGE = float(1 << 31)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each 64-bit key, 0 to ``shards`` - 1."""
    if shards < 1:
        raise ValueError(f"there must be one shard at least, not {shards}")
    state = keys.astype(np.int64).view(np.uint64).copy()
    stop, ahead = np.zeros(len(state), dtype=np.int64), np.zeros(len(state), dtype=np.int64)
    going = np.arange(len(state))
    while len(going):
        stop[going] = ahead[going]
        with np.errstate(over="ignore"):  # the generator works modulo 2 ** 64
            state[going] = state[going] * np.uint64(MULTIPLIER) + np.uint64(1)
        drawn = (state[going] >> np.uint64(33)).astype(np.float64) + 1.0
        ahead[going] = ((stop[going] + 1) * (RANGE / drawn)).astype(np.int64)
        going = going[ahead[going] < shards]
    return stop


def shard_of(key: Column, shards: int) -> Column:
    """Shard of a key of any plain type, by its 64-bit hash; a null key has a shard like any other."""

    @pandas_udf("int")
    def jump(hashed: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(hashed.to_numpy(), shards).astype(np.int32))

    return jump(F.xxhash64(key))


def write_shards(docs: DataFrame, folder: str, key: str = "doc_id", shards: int = SHARDS) -> None:
    """Writes each row to the folder ``shard=<n>`` of its key, as one column ``document`` that holds all of its columns.

    Every column of ``docs`` stays as it is, whatever its name and value; null keys share a shard, and repeated rows are
    all written. Rows go to a shard by their key alone, so one busy key makes its shard large (the law of the key), but
    not a task or a file: the shuffle before the write cuts whatever is large. No rows: no files.
    """
    placed = docs.select(F.struct("*").alias("document"), shard_of(F.col(key), shards).alias("shard"))
    # As many parts over all shards as there are partitions: one holds about one shard, so files stay few.
    parts = -(-int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // shards)
    part = F.pmod(F.xxhash64(F.col("document").getField(key)), F.lit(parts)).alias("part")
    balanced = placed.select("document", "shard", part).hint("rebalance", "shard", "part")
    ordered = balanced.sortWithinPartitions("shard", F.col("document").getField(key)).drop("part")
    ordered.write.partitionBy("shard").parquet(folder)


def read_shards(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    """document, shard, slot: the rows in ``folder``, numbered without gaps from 0 in each shard.

    A file belongs to one shard, so a slot is the rows in the shard's files before, plus the place in the file: rows are
    counted by file, never sorted. ``like`` has the columns of the documents, for an empty folder.
    """
    schema = StructType([StructField("document", like.schema), StructField("shard", IntegerType())])
    rows = spark.read.schema(schema).parquet(folder).select(
        "document", "shard", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    counted = rows.groupBy("shard", "file").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select("file", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    return rows.join(small_side(starts), "file").select("document", "shard", (F.col("start") + F.col("row")).alias("slot"))


@query("op13_jump_shards")
def op13_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards by doc_id, read back from the shards' files."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch(spark, "shards")
    write_shards(docs, folder)
    # Sums are taken from the stored texts, before rows meet the files' starts.
    text = F.coalesce("document.text", F.lit(""))
    return read_shards(spark, folder, docs).select(
        F.col("document.doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text).cast("bigint") + 1).alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        shard_of(F.col("document.doc_id"), SHARDS + 1).alias("grown_shard"),
    )
