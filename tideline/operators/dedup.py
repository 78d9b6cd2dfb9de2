"""Duplicate and version handling: T1, T2, T3, T7, A9."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _version(order: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def _one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key. Spark limits the group inside each task before the shuffle, so one row per
    key leaves a task however often the key occurs."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest version of each key."""
    return _one_per_key(df, keys, [F.desc(c) for c in order])


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The oldest row of each key; exact, where a bloom filter may drop rows that were never seen."""
    if df.isStreaming:
        return df.dropDuplicatesWithinWatermark(keys)
    return _one_per_key(df, keys, [F.asc(c) for c in order])


def distinct_rows(df: DataFrame) -> DataFrame:
    """One copy of each full record (streaming: within the watermark)."""
    return df.dropDuplicatesWithinWatermark() if df.isStreaming else df.distinct()


def retract_versions(
    df: DataFrame, key: str, order: list[str], measures: list[str], sign: str | None = None,
    row_id: list[str] | None = None,
) -> DataFrame:
    """Every version as it arrives, and each replaced version again with its measures negated.

    A version is replaced unless it is the newest of its key, so no ordered pass over the key is needed. The
    newest rows are found by ``row_id`` (or else key and version), which no two rows share, so the join has no
    busy key. ``order`` must be total within a key: end it with the arrival position. Null measures stay null (Q2).
    """
    found = row_id or [key, *order]
    newest = latest_per_key(df.select(*dict.fromkeys([key, *order, *found])), [key], order)
    newest = newest.select(*[F.col(c).alias(f"_n_{c}") for c in found], F.lit(True).alias("_is_newest"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_n_{c}")) for c in found])
    signs = F.when(F.col("_is_newest"), F.array(F.lit(1))).otherwise(F.array(F.lit(1), F.lit(-1)))
    out = df.join(newest, same, "left").withColumn("_sign", F.explode(signs))
    columns = [
        (F.col(c) * F.col("_sign")).cast(df.schema[c].dataType).alias(c) if c in measures else F.col(c)
        for c in df.columns
    ]
    return out.select(*columns, *([F.col("_sign").alias(sign)] if sign else []))


def last_per_window(df: DataFrame, keys: list[str], ts: str, width: str, order: list[str]) -> DataFrame:
    """The last row of each key and window; earlier rows of the window are dropped."""
    framed = df.withColumn("window", F.window(ts, width))
    if df.isStreaming:
        rest = [c for c in df.columns if c not in keys]
        picked = framed.groupBy("window", *keys).agg(F.max_by(F.struct(*rest), _version(order)).alias("_row"))
        return picked.select(
            "window", *[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns]
        )
    return latest_per_key(framed, ["window", *keys], order)
