"""Outer joins of streams that correct themselves.

A left row is put out at once, with nulls for what has not come yet. When a match comes, the row with nulls is taken
back and the full row follows, as a changelog of signed rows. Nothing waits for a watermark.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta
from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tideline.functions.time import day_text
from tideline.functions.values import amount_product
from tideline.schemas import ORDER_DETAIL_FACT

SIGN = "sign"
# Rows are held as JSON text: one state layout for any columns, and no number passes through pandas.
JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
ROW = T.StructType([T.StructField("row", T.StringType())])


class _OuterJoin(StatefulProcessor):
    """State of one key: its left rows, and the rows of each right side. A row that is not renewed within ``ttl_ms`` goes."""

    def __init__(self, sides: int, ttl_ms: int | None):
        self.sides, self.ttl_ms = sides, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.states = [handle.getListState(f"side_{i}", ROW, self.ttl_ms) for i in range(self.sides + 1)]

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = [[r[0] for r in s.get()] if s.exists() else [] for s in self.states]
        known = [list(h) for h in held]
        for chunk in rows:
            out = []
            for side, text, sign in zip(chunk["side"], chunk["row"], chunk[SIGN], strict=True):
                out += self._change(held, int(side), text, int(sign))
            yield pd.DataFrame(out, columns=[SIGN, *(f"row_{i}" for i in range(self.sides + 1))])
        for state, before, now in zip(self.states, known, held, strict=True):
            if now[: len(before)] == before:
                if len(now) > len(before):
                    state.appendList([(text,) for text in now[len(before) :]])
            elif now:
                state.put([(text,) for text in now])
            else:
                state.clear()

    def _change(self, held: list[list[str]], side: int, text: str, sign: int) -> list[tuple]:
        there = [rows or [None] for rows in held]
        there[side] = [text]
        full = [(sign, *rows) for rows in product(*there)]
        if sign > 0:
            alone = not held[side]
            held[side].append(text)
        else:
            if text not in held[side]:
                return []  # it has left the state already
            held[side].remove(text)
            alone = not held[side]
        if side == 0 or not held[0]:
            return full if held[0] or side == 0 else []
        if not alone:
            return full
        there[side] = [None]
        nulls = [(-sign, *rows) for rows in product(*there)]
        return nulls + full if sign > 0 else full + nulls

    def close(self) -> None:
        pass


def _tagged(df: DataFrame, side: int, key: Column | str, columns: list[str]) -> DataFrame:
    sign = F.col(SIGN).cast("int") if SIGN in df.columns else F.lit(1)
    return df.select(F.lit(side).alias("side"), (F.col(key) if isinstance(key, str) else key).cast("string").alias("_key"),
                     F.to_json(F.struct(*columns), JSON).alias("row"), sign.alias(SIGN))


def outer_join_changes(left: DataFrame, key: str, rights: list[tuple[DataFrame, str, list[str]]], ttl: timedelta | None = None) -> DataFrame:
    """J2 on streams: left outer joins of ``left`` with each right side (frame, key, columns), as signed rows.

    Gives the left columns, the right columns and ``sign``: 1 puts a row out, -1 takes one back. Inputs may be such
    changelogs themselves; without a ``sign`` column all of their rows are new. Left rows without a key are put out
    with nulls, right ones never match. A row's state is dropped ``ttl`` of processing time after it came (T10), in a
    query with an interval, since a clock has no end of the available input; without ``ttl``, state stays. Added up by ``replayed``, the changes give the rows of the batch join, in whatever order they came.
    """
    own = [c for c in left.columns if c != SIGN]
    frames = [_tagged(left.filter(F.col(key).isNotNull()), 0, key, own)]
    frames += [_tagged(df.filter(F.col(k).isNotNull()), i, k, columns) for i, (df, k, columns) in enumerate(rights, 1)]
    tagged = frames[0]
    for frame in frames[1:]:
        tagged = tagged.unionByName(frame)
    schema = T.StructType([T.StructField(SIGN, T.IntegerType())] + [T.StructField(f"row_{i}", T.StringType()) for i in range(len(rights) + 1)])
    changes = tagged.groupBy("_key").transformWithStateInPandas(
        statefulProcessor=_OuterJoin(len(rights), int(ttl.total_seconds() * 1000) if ttl else None), outputStructType=schema,
        outputMode="Append", timeMode="ProcessingTime" if ttl else "None",
    )
    parts = [(left, own), *[(df, columns) for df, _, columns in rights]]
    unpack = lambda i, df, columns: F.from_json(f"row_{i}", T.StructType([df.schema[c] for c in columns]), JSON)
    rows = changes.select(SIGN, *[unpack(i, df, columns).alias(f"_{i}") for i, (df, columns) in enumerate(parts)])
    joined = rows.select(*[F.col(f"_{i}")[c].alias(c) for i, (_, columns) in enumerate(parts) for c in columns], SIGN)
    nothing = [F.lit(None).cast(df.schema[c].dataType).alias(c) for df, _, columns in rights for c in columns]
    sign = F.col(SIGN).cast("int") if SIGN in left.columns else F.lit(1)
    return joined.unionByName(left.filter(F.col(key).isNull()).select(*own, *nothing, sign.alias(SIGN)))


def order_detail_changes(
    details: DataFrame, orders: DataFrame, activities: DataFrame, coupons: DataFrame, ttl: timedelta | None = None
) -> DataFrame:
    """J1 + J2 + F16 on streams: the order-detail fact as signed rows, the same columns as the batch form and ``sign``."""
    lines = details.withColumn("split_original_amount", amount_product("sku_num", "order_price")).withColumn("date_id", day_text("create_time"))
    headers = orders.select(F.col("id").alias("_oid"), "user_id", "province_id")
    placed = lines.join(headers, F.col("order_id") == F.col("_oid")).drop("_oid")
    rights = [(activities, "order_detail_id", ["activity_id", "activity_rule_id"]), (coupons, "order_detail_id", ["coupon_id"])]
    return outer_join_changes(placed, "id", rights, ttl).select(*ORDER_DETAIL_FACT, SIGN)


def replayed(changes: DataFrame) -> DataFrame:
    """The rows that a finished changelog leaves, each as often as it was put out more than taken back."""
    columns = [c for c in changes.columns if c != SIGN]
    left = changes.groupBy(*columns).agg(F.sum(SIGN).alias("_n")).filter("_n > 0")
    return left.withColumn("_n", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).select(*columns)


def upsert_messages(changes: DataFrame, key: str) -> DataFrame:
    """K4 on a topic: (key, value), where a row that is taken back is a message without a value, which P3 leaves out."""
    columns = [c for c in changes.columns if c != SIGN]
    value = F.when(F.col(SIGN) > 0, F.to_json(F.struct(*columns), JSON))
    return changes.select(F.col(key).cast("string").alias("key"), value.alias("value"))
