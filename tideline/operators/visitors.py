"""Visit state per user and day: T4, T5, T6.

The streaming forms see events in arrival order; the batch forms use event time, which is the same for
in-order input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.joins import skew_join

RETURN_DAYS = 8
# Parts that the visits of one visitor are spread over on a stream, before its state sees one of each.
STREAM_SALTS = 16


def first_visits(df: DataFrame, keys: list[str], ts: str, carry: list[str] = (), salts: int = STREAM_SALTS) -> DataFrame:
    """T4: one row per key and day, the day's first visit, with the carried columns of that visit.

    Batch: an aggregate that combines before the shuffle. Streaming: keyed state of the days seen; with
    ``salts`` a first round, spread over that many parts of a key, drops most repeats inside the JVM.
    """
    dated = df.dropna(subset=keys).withColumn("visit_date", F.to_date(ts))
    if df.isStreaming:
        from tideline.streaming.state import first_visits_stream

        out = dated.select(*keys, "visit_date", ts, *carry)
        if salts:
            spread = out.withColumn("_salt", F.pmod(F.xxhash64(*keys, ts), F.lit(salts)))
            out = spread.dropDuplicatesWithinWatermark([*keys, "visit_date", "_salt"]).drop("_salt")
        return first_visits_stream(out, keys, "visit_date", ts)
    if not carry:  # a plain minimum aggregates by hash, without a sort
        return dated.groupBy(*keys, "visit_date").agg(F.min(ts).alias(ts))
    first = dated.groupBy(*keys, "visit_date").agg(F.min(F.struct(ts, *carry)).alias("_first"))
    return first.select(*keys, "visit_date", *[F.col("_first")[c].alias(c) for c in (ts, *carry)])


def login_days(df: DataFrame, key: str, ts: str, return_days: int = RETURN_DAYS) -> DataFrame:
    """First login of each user and day, with ``back_ct`` = 1 after an absence of ``return_days``.

    The ordered pass runs over days, not events: its size per user is bounded by the days covered.
    """
    if df.isStreaming:
        from tideline.streaming.state import login_days_stream

        return login_days_stream(df, key, ts, return_days)
    days = first_visits(df, [key], ts)
    previous = F.lag("visit_date").over(Window.partitionBy(key).orderBy("visit_date"))
    gap = F.datediff("visit_date", previous)
    return days.withColumn("uu_ct", F.lit(1).cast("bigint")).withColumn(
        "back_ct", F.when(gap >= return_days, 1).otherwise(0).cast("bigint")
    )


def repair_visitor_flag(df: DataFrame, key: str, ts: str, flag: str, order: list[str] = ()) -> DataFrame:
    """T5: a visitor who claims to be new on a later day than the first one is not new.

    State per visitor is set by the first event (its day if it claims new, else the day before) and kept (Q10).
    """
    day = F.to_date(ts)
    claimed = F.when(F.col(flag) == "1", day).otherwise(F.date_sub(day, 1))
    state = df.groupBy(key).agg(
        F.min_by(claimed, F.struct(ts, *order) if order else F.col(ts)).alias("_first_day"),
        F.count("*").alias("_rows"),
    )
    joined = skew_join(df, state, [key], "left", weight="_rows")
    stale = (F.col(flag) == "1") & (day != F.col("_first_day"))
    return joined.withColumn(flag, F.when(stale, "0").otherwise(F.col(flag))).select(*df.columns)
