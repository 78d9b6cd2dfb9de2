"""Pivot and unpivot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pivot(df: DataFrame, keys: list[str], on: str, values: dict[object, str], aggs: dict[str, Column]) -> DataFrame:
    """One column per listed value and aggregate, named ``<value alias>_<aggregate>``.

    The values are given, so the planner needs no extra pass to find them.
    """
    grouped = df.groupBy(*keys).pivot(on, list(values)).agg(*[c.alias(n) for n, c in aggs.items()])
    single = len(aggs) == 1
    name = lambda v, n: str(v) if single else f"{v}_{n}"
    return grouped.select(
        *keys, *[F.col(f"`{name(v, n)}`").alias(f"{alias}_{n}") for v, alias in values.items() for n in aggs]
    )


def unpivot(df: DataFrame, keys: list[str], labels: dict[str, str], name: str, value: str, drop_nulls: bool = True) -> DataFrame:
    """Wide columns as (label, value) rows with literal labels; null values give no row."""
    pairs = [x for column, label in labels.items() for x in (F.lit(label), F.col(f"`{column}`"))]
    rows = df.select(*keys, F.stack(F.lit(len(labels)), *pairs).alias(name, value))
    return rows.filter(F.col(value).isNotNull()) if drop_nulls else rows
