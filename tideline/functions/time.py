"""Time functions: F1, F2, F3, F5, F7, F9, F27 and the window columns of W1-W5."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DATE = "yyyy-MM-dd"
DATE_TIME = "yyyy-MM-dd HH:mm:ss"
COMPACT_DATE = "yyyyMMdd"

# Upper hour (exclusive) and name of each time slot; the last slot is open.
TIME_SLOTS = [(6, "凌晨"), (9, "早晨"), (12, "上午"), (14, "中午"), (18, "下午"), (22, "晚上"), (24, "夜间")]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Largest epoch milliseconds that a timestamp (64-bit microseconds) holds.
MAX_MILLIS = (1 << 63) // 1000 - 1
# Numbers below this, with either sign, are seconds; others are milliseconds.
SECONDS_BELOW = 10_000_000_000


def from_millis(ms: Column | str) -> Column:
    """Null where the number is none or beyond what a timestamp holds."""
    number = col(ms).try_cast("bigint")
    return F.timestamp_millis(F.when(number.between(-MAX_MILLIS, MAX_MILLIS), number))


def from_epoch(number: Column) -> Column:
    """Seconds or milliseconds, by their size."""
    seconds = number.between(1 - SECONDS_BELOW, SECONDS_BELOW - 1)
    return from_millis(F.when(seconds, number * 1000).otherwise(number))


def to_millis(ts: Column | str) -> Column:
    return F.unix_millis(col(ts).cast("timestamp"))


def millis_text(ms: Column | str, pattern: str = DATE_TIME) -> Column:
    """epoch milliseconds as text."""
    return F.date_format(from_millis(ms), pattern)


def text_millis(text: Column | str, pattern: str = DATE_TIME) -> Column:
    """F1 inverse; text that does not parse gives null."""
    return F.unix_millis(F.try_to_timestamp(col(text), F.lit(pattern)))


def tolerant_timestamp(value: Column | str) -> Column:
    """Epoch milliseconds or date text as a timestamp (Q12); values below 10^10, with either sign, are seconds."""
    text = F.trim(col(value).cast("string"))
    number = F.when(text.rlike("^-?[0-9]+$"), text.try_cast("bigint"))
    return F.coalesce(from_epoch(number), F.try_to_timestamp(text))


def day_text(value: Column | str, pattern: str = DATE) -> Column:
    """the day of an epoch or text time."""
    return F.date_format(tolerant_timestamp(value), pattern)


def time_slot(ts: Column | str) -> Column:
    """the named part of the day."""
    hour = F.hour(col(ts))
    slot = None
    for upper, name in TIME_SLOTS[:-1]:
        slot = F.when(hour < upper, name) if slot is None else slot.when(hour < upper, name)
    return slot.when(hour.isNotNull(), TIME_SLOTS[-1][1])


def age_years(birthday: Column | str, as_of: Column | str) -> Column:
    """completed years; a 29 February birthday counts from 1 March in common years."""
    born, now = col(birthday).cast("date"), col(as_of).cast("date")
    month_day = lambda d: F.month(d) * 100 + F.dayofmonth(d)
    return F.year(now) - F.year(born) - F.when(month_day(now) < month_day(born), 1).otherwise(0)


def decade(birthday: Column | str) -> Column:
    """1987 -> 1980."""
    return (F.floor(F.year(col(birthday)) / 10) * 10).cast("int")


def epoch_day(days: Column | str) -> Column:
    """day number of the change event as a date."""
    return F.date_from_unix_date(col(days).try_cast("int"))


def day_partitions(first: Column | str, last: Column | str) -> Column:
    """array of yyyyMMdd integers, both ends included; empty when first is after last."""
    lo, hi = col(first).cast("date"), col(last).cast("date")
    days = F.when(lo <= hi, F.sequence(lo, hi, F.expr("interval 1 day"))).otherwise(
        F.array().cast("array<date>")
    )
    return F.transform(days, lambda d: F.date_format(d, COMPACT_DATE).cast("int"))


def window_bounds(window: Column | str = "window") -> list[Column]:
    """Stt, edt and cur_date text of a left-closed, right-open window."""
    w = col(window)
    return [
        F.date_format(w["start"], DATE_TIME).alias("stt"),
        F.date_format(w["end"], DATE_TIME).alias("edt"),
        F.date_format(w["start"], DATE).alias("cur_date"),
    ]


def list_event_time(df: DataFrame, items: str, field: str = "window_start_time", name: str = "event_time") -> DataFrame:
    """T8 for rows that hold a list of records: the time (milliseconds) of the first record."""
    return df.withColumn(name, F.timestamp_millis(F.get(F.col(items), 0)[field].try_cast("bigint")))


def event_time(df: DataFrame, fields: list[str], seconds: bool = True, name: str = "event_time") -> DataFrame:
    """The first present field, seconds or milliseconds, as the event time column."""
    value = F.coalesce(*[F.col(f).try_cast("bigint") for f in fields])
    return df.withColumn(name, F.timestamp_millis(value * 1000 if seconds else value))
