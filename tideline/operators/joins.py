"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys outside the HOT_KEYS largest hold at most 1/(HOT_KEYS + 1) of the rows each, so they need no care.
HOT_KEYS = 512
SALTS = 1 << 10
# Largest side that is sent to every executor, in rows; anything larger is joined by shuffle.
BROADCAST_ROWS = 100_000


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Counts at most ``max_rows + 1`` rows."""
    return not df.isStreaming and df.limit(max_rows + 1).count() <= max_rows


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only behind a check of the size; else the choice is left to AQE.

    For sides whose size the optimizer cannot know, such as a dictionary that is itself an aggregate: the big
    side would be shuffled before AQE sees how small the other one is.
    """
    return F.broadcast(df) if is_small(df, max_rows) else df


def _spread(df: DataFrame) -> Column:
    """Salt from row content, so a retried task sends each row to the same place again."""
    plain = [f.name for f in df.schema.fields if "map" not in f.dataType.simpleString()]
    return F.pmod(F.xxhash64(*[F.col(c) for c in plain]), F.lit(SALTS)) + 1


def _present(names: list[str]) -> Column:
    return reduce(and_, [F.col(n).isNotNull() for n in names])


def skew_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "left", weight: str | None = None
) -> DataFrame:
    """Left or inner equi-join to a side that is unique per key, safe for busy keys on the left.

    ``weight`` names a column of ``right`` with the number of left rows per key; without it they are counted.
    The HOT_KEYS busiest keys are joined from a broadcast of at most HOT_KEYS rows; their left rows are
    spread over salts in the shuffle of the remaining join, where they match nothing; so are null keys. A busy key that
    ``right`` repeats fails the job.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be left or inner, not {how!r}")
    if left.isStreaming:
        return left.join(right.drop(weight) if weight else right, on, how)
    values = [c for c in right.columns if c not in on and c != weight]
    packed = right.filter(_present(on)).select(
        *on, *([weight] if weight else []), F.struct(*[F.col(c) for c in right.columns]).alias("_side")
    )
    rows = left.groupBy(*on).agg(F.count("*").alias("_rows")) if weight is None else packed.groupBy(*on).agg(F.max(weight).alias("_rows"))
    busy = rows.orderBy(F.desc("_rows"), *on).limit(HOT_KEYS).select(*on)
    once = F.when(F.count("*") == 1, F.first("_side")).otherwise(F.raise_error(F.lit("the right side of a skew_join repeats a key")))
    hot = packed.join(F.broadcast(busy), on, "left_semi").groupBy(*on).agg(once.alias("_hot"))
    columns = left.columns
    marked = left.join(F.broadcast(hot), on, "left")
    apart = F.col("_hot").isNotNull() | ~_present(on)
    salted = marked.withColumn("_salt", F.when(apart, _spread(left)).otherwise(F.lit(0).cast("bigint")))
    # Always 0, but not a constant: a constant would be folded out of the join keys, and with it the spread.
    zero = F.coalesce(F.pmod(F.xxhash64(*on), F.lit(1)), F.lit(0))
    cold = packed.select(*on, F.col("_side").alias("_cold"), zero.alias("_salt"))
    joined = salted.join(cold, [*on, "_salt"], "left").withColumn("_side", F.coalesce("_hot", "_cold"))
    if how == "inner":
        joined = joined.filter(F.col("_side").isNotNull())
    return joined.select(*columns, *[F.col("_side")[c].alias(c) for c in values])


def enrich(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    dim_key: str,
    columns: dict[str, str],
    how: str = "left",
    defaults: dict[str, object] | None = None,
) -> DataFrame:
    """Add dimension columns by key; ``columns`` maps dimension name -> output name.

    J18: ``defaults`` replaces the value of rows without a match.
    The dimension is unique per key. Catalyst broadcasts it when its size allows, and AQE splits busy keys.
    """
    side = dim.select(F.col(dim_key).alias("_dim_key"), *[F.col(c).alias(n) for c, n in columns.items()])
    out = df.join(side, df[key] == side["_dim_key"], how).drop("_dim_key")
    for name, value in (defaults or {}).items():
        out = out.withColumn(name, F.coalesce(F.col(name), value if isinstance(value, Column) else F.lit(value)))
    return out


def prefixed(df: DataFrame, prefix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[F.col(c).alias(c if c in keep else prefix + c) for c in df.columns])


def _micros(span: timedelta) -> int:
    return round(span.total_seconds() * 1_000_000)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    lower: timedelta,
    upper: timedelta,
    right_cols: list[str] | None = None,
    prefix: str = "",
    right_key: str | None = None,
    how: str = "inner",
) -> DataFrame:
    """Right rows with ``left_ts + lower <= right_ts <= left_ts + upper`` on an equal key.

    Batch: the key is joined together with a time bucket as wide as the interval, and each right row is
    placed in the one or two buckets it can match, so a busy key is cut along time.
    Streaming: both sides carry a watermark and the bound lets Spark expire join state.
    """
    right_key = right_key or key
    wanted = right_cols if right_cols is not None else [c for c in right.columns if c != right_key]
    side = right.select(
        F.col(right_key).alias("_rk"),
        F.col(right_ts).alias("_rts"),
        *[F.col(c).alias(prefix + c) for c in wanted],
    )
    bound = (F.col("_rts") >= F.col(left_ts) + F.lit(lower)) & (F.col("_rts") <= F.col(left_ts) + F.lit(upper))
    if left.isStreaming or right.isStreaming:
        return left.join(side, (F.col(key) == F.col("_rk")) & bound, how).drop("_rk", "_rts")
    lo, hi = _micros(lower), _micros(upper)
    width = max(hi - lo, 1_000_000)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    slot = lambda at: at - F.pmod(at, F.lit(width))  # start of the bucket, in integers
    lefts = left.withColumn("_slot", slot(micros(left_ts)))
    reach = F.sequence(slot(micros("_rts") - hi), slot(micros("_rts") - lo), F.lit(width))
    rights = side.withColumn("_rslot", F.explode(reach))
    on = (F.col(key) == F.col("_rk")) & (F.col("_slot") == F.col("_rslot")) & bound
    return lefts.join(rights, on, how).drop("_rk", "_rts", "_slot", "_rslot")


def membership(df: DataFrame, value: str, words: DataFrame, word: str = "word", flag: str = "is_member") -> DataFrame:
    """True where the value is in the word set: by broadcast within the checked size, else skew-safe."""
    known = words.select(F.col(word).alias(value)).filter(F.col(value).isNotNull()).distinct()
    known = known.withColumn(flag, F.lit(True))
    if df.isStreaming or is_small(known):
        out = df.join(small_side(known), value, "left")
    else:
        out = skew_join(df, known, [value], "left")
    return out.withColumn(flag, F.coalesce(flag, F.lit(False)))


def members(df: DataFrame, value: str, words: DataFrame, word: str = "word") -> DataFrame:
    """J19 as a filter: rows whose value is in the word set."""
    return df.join(words.select(F.col(word).alias(value)), value, "left_semi")
