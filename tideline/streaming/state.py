"""Keyed state that SQL cannot express: T1, T2, T5, T6, A8 on streams.

Rows arrive in Arrow batches; a processor sees one bounded chunk of a key at a time and never gathers a
key. Everything that has a built-in form (first visits, duplicates, windows, interval joins) does not pass
through here.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tideline.operators.visitors import RETURN_DAYS, STREAM_SALTS, first_visits


EPOCH = pd.Timestamp("1970-01-01").toordinal()


def _python(value):
    """A pandas cell as a plain value that a state column takes."""
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    return value.item() if hasattr(value, "item") else value


def _row(frame: pd.DataFrame, index: int) -> tuple:
    return tuple(_python(v) for v in frame.iloc[index])


def _millis(ts) -> int:
    return int(pd.Timestamp(ts).timestamp() * 1000)


class _Retract(StatefulProcessor):
    def __init__(self, schema: T.StructType, key: str, ts: str, measures: list[str], ttl: timedelta):
        self.schema, self.key, self.ts, self.measures, self.ttl = schema, key, ts, measures, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.previous = handle.getValueState("previous", self.schema)
        self.expires = handle.getValueState("expires", T.StructType([T.StructField("at", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for chunk in rows:
            chunk = chunk[self.schema.names]
            before = chunk.shift(1)
            has_before = pd.Series(True, index=chunk.index)
            if self.previous.exists():
                before.iloc[0] = list(self.previous.get())
            else:
                has_before.iloc[0] = False
            age = chunk[self.ts] - pd.to_datetime(before[self.ts])
            replaced = before[has_before & (age <= self.ttl)]
            replaced = replaced.astype(chunk.dtypes.to_dict())
            for name in self.measures:
                replaced[name] = -replaced[name]
            out = pd.concat([replaced, chunk]).sort_index(kind="stable")
            self.previous.update(_row(chunk, -1))
            at = _millis(chunk[self.ts].iloc[-1] + self.ttl)
            if not self.expires.exists() or at > self.expires.get()[0]:
                if self.expires.exists():
                    self.handle.deleteTimer(self.expires.get()[0])
                self.expires.update((at,))
                self.handle.registerTimer(at)
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.previous.clear()
        self.expires.clear()
        return iter(())

    def close(self) -> None:
        pass


class _NewestAfterDelay(StatefulProcessor):
    def __init__(self, schema: T.StructType, ts: str, order: list[str], delay_ms: int):
        self.schema, self.ts, self.order, self.delay_ms = schema, ts, order, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", self.schema)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for chunk in rows:
            chunk = chunk[self.schema.names]
            top = _row(chunk.sort_values(self.order, kind="stable"), -1)
            places = [self.schema.names.index(c) for c in self.order]
            if not self.newest.exists():
                self.handle.registerTimer(_millis(chunk[self.ts].min()) + self.delay_ms)
                self.newest.update(top)
            else:
                held = tuple(self.newest.get())
                if tuple(top[p] for p in places) >= tuple(held[p] for p in places):
                    self.newest.update(top)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.newest.exists():
            row = tuple(self.newest.get())
            self.newest.clear()
            yield pd.DataFrame([row], columns=self.schema.names)

    def close(self) -> None:
        pass


class _FirstVisit(StatefulProcessor):
    def __init__(self, schema: T.StructType, day: str, ts: str, keep_days: int):
        self.schema, self.day, self.ts, self.keep_days = schema, day, ts, keep_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        number = T.StructType([T.StructField("day", T.IntegerType())])
        self.seen = handle.getMapState("seen", number, number)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for chunk in rows:
            firsts = chunk[self.schema.names].sort_values(self.ts, kind="stable").drop_duplicates(self.day)
            numbers = [pd.Timestamp(d).toordinal() for d in firsts[self.day]]
            fresh = [not self.seen.containsKey((n,)) for n in numbers]
            for n, new in zip(numbers, fresh):
                if new:
                    self.seen.updateValue((n,), (n,))
                    self.handle.registerTimer((n - EPOCH + 1 + self.keep_days) * 86_400_000)
            yield firsts[fresh]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        past = expiredTimerInfo.getExpiryTimeInMs() // 86_400_000 + EPOCH - 1 - self.keep_days
        for (n,) in list(self.seen.keys()):
            if n <= past:
                self.seen.removeKey((n,))
        return iter(())

    def close(self) -> None:
        pass


class _VisitorFlag(StatefulProcessor):
    def __init__(self, schema: T.StructType, ts: str, flag: str):
        self.schema, self.ts, self.flag = schema, ts, flag

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first_day", T.StructType([T.StructField("day", T.IntegerType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for chunk in rows:
            chunk = chunk[self.schema.names].copy()
            days = chunk[self.ts].map(lambda t: int(pd.Timestamp(t).timestamp() // 86_400))
            claims = chunk[self.flag] == "1"
            if not self.first.exists():
                self.first.update((int(days.iloc[0]) - (0 if claims.iloc[0] else 1),))
            chunk.loc[claims & (days != self.first.get()[0]), self.flag] = "0"
            yield chunk

    def close(self) -> None:
        pass


class _LastDay(StatefulProcessor):
    def __init__(self, key: str, ts: str, return_days: int):
        self.key, self.ts, self.return_days = key, ts, return_days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_day", T.StructType([T.StructField("day", T.IntegerType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for chunk in rows:
            ordered = chunk.sort_values(self.ts, kind="stable")
            days = ordered[self.ts].map(lambda t: int(pd.Timestamp(t).timestamp() // 86_400))
            before = days.shift(1)
            if self.last.exists():
                before.iloc[0] = self.last.get()[0]
            self.last.update((int(days.iloc[-1]),))
            yield pd.DataFrame(
                {
                    self.key: key[0],
                    self.ts: ordered[self.ts],
                    "uu_ct": 1,
                    "back_ct": ((days - before) >= self.return_days).astype("int64"),
                }
            )

    def close(self) -> None:
        pass


class _ValueSets(StatefulProcessor):
    def __init__(self, key: str, carry: list[str], fields: list[str]):
        self.key, self.carry, self.fields = key, carry, fields

    def init(self, handle: StatefulProcessorHandle) -> None:
        pair = T.StructType([T.StructField("field", T.StringType()), T.StructField("value", T.StringType())])
        self.seen = handle.getMapState("seen", pair, T.StructType([T.StructField("n", T.IntegerType())]))
        self.count = handle.getValueState("pv", T.StructType([T.StructField("n", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        sets: dict[str, set[str]] = {f: set() for f in self.fields}
        for field, value in list(self.seen.keys()):
            sets[field].add(value)
        total = self.count.get()[0] if self.count.exists() else 0
        texts = {f: ",".join(sorted(sets[f])) for f in self.fields}
        for chunk in rows:
            out = []
            for record in chunk.to_dict("records"):
                total += 1
                for f in self.fields:
                    value = _python(record[f])
                    if value is not None and str(value) not in sets[f]:
                        sets[f].add(str(value))
                        self.seen.updateValue((f, str(value)), (1,))
                        texts[f] = ",".join(sorted(sets[f]))
                out.append([key[0], *[record[c] for c in self.carry], total, *[texts[f] for f in self.fields]])
            yield pd.DataFrame(out, columns=[self.key, *self.carry, "pv", *self.fields])
        self.count.update((total,))

    def close(self) -> None:
        pass


def _event_time(df: DataFrame, key: str, processor, schema: T.StructType, ts: str) -> DataFrame:
    return df.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime",
        eventTimeColumnName=ts,
    )


def _plain(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def retract_stream(df: DataFrame, key: str, ts: str, measures: list[str], ttl: timedelta) -> DataFrame:
    """T1 + T10: as ``retract_versions`` in arrival order; a version older than ``ttl`` is forgotten."""
    schema = _plain(df.schema)
    return _event_time(df.filter(F.col(key).isNotNull()), key, _Retract(schema, key, ts, measures, ttl), schema, ts)


def newest_after_delay(df: DataFrame, key: str, ts: str, order: list[str], delay: timedelta) -> DataFrame:
    """The newest version of a key, emitted once ``delay`` after its first version."""
    schema = _plain(df.schema)
    processor = _NewestAfterDelay(schema, ts, order, int(delay.total_seconds() * 1000))
    return df.filter(F.col(key).isNotNull()).groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime"
    )


def first_visits_stream(df: DataFrame, keys: list[str], day: str, ts: str, keep_days: int = 1) -> DataFrame:
    """T4: the first row of each key and day in arrival order; a day is forgotten ``keep_days`` after its end."""
    schema = _plain(df.schema)
    return df.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=_FirstVisit(schema, day, ts, keep_days), outputStructType=schema, outputMode="Append",
        timeMode="EventTime", eventTimeColumnName=ts,
    )


def repair_flag_stream(df: DataFrame, key: str, ts: str, flag: str) -> DataFrame:
    """T5 in arrival order; rows without a key pass as they are, as in the batch form."""
    schema = _plain(df.schema)
    repaired = _event_time(df.filter(F.col(key).isNotNull()), key, _VisitorFlag(schema, ts, flag), schema, ts)
    return repaired.unionByName(df.filter(F.col(key).isNull()))


def login_days_stream(df: DataFrame, key: str, ts: str, return_days: int = RETURN_DAYS, salts: int = STREAM_SALTS) -> DataFrame:
    """Days are made distinct first, so the state sees one row per user and day."""
    days = first_visits(df, [key], ts, salts=salts).select(key, ts)
    schema = T.StructType(
        [
            T.StructField(key, df.schema[key].dataType),
            T.StructField(ts, T.TimestampType()),
            T.StructField("uu_ct", T.LongType()),
            T.StructField("back_ct", T.LongType()),
        ]
    )
    return _event_time(days, key, _LastDay(key, ts, return_days), schema, ts)


def value_sets_stream(df: DataFrame, key: str, carry: list[str], fields: list[str]) -> DataFrame:
    """A8, running form: count and value sets so far, on every row. Output grows with the sets: opt-in."""
    named = df.filter(F.col(key).isNotNull()).select(key, *carry, *fields)
    schema = T.StructType(
        [T.StructField(c, df.schema[c].dataType) for c in (key, *carry)]
        + [T.StructField("pv", T.LongType())]
        + [T.StructField(f, T.StringType()) for f in fields]
    )
    return named.groupBy(key).transformWithStateInPandas(
        statefulProcessor=_ValueSets(key, carry, fields), outputStructType=schema, outputMode="Append", timeMode="None"
    )
