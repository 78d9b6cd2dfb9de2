"""Dimension tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators.joins import enrich


def flat_dictionary(base_dic: DataFrame) -> DataFrame:
    """(dic_code, info.dic_name) as flat columns (Q5)."""
    return base_dic.select("dic_code", F.col("info.dic_name").alias("dic_name"))


def category_tree(level3: DataFrame, level2: DataFrame, level1: DataFrame) -> DataFrame:
    """(id, name) of each third-level category with its two parents."""
    c3 = level3.select(F.col("id").alias("id"), F.col("name").alias("b3name"), "category2_id")
    c2 = level2.select(F.col("id").alias("category2_id"), F.col("name").alias("b2name"), "category1_id")
    c1 = level1.select(F.col("id").alias("category1_id"), F.col("name").alias("b1name"))
    return c3.join(c2, "category2_id").join(c1, "category1_id").select("id", "b3name", "b2name", "b1name")


def sku_dimension(sku: DataFrame, spu: DataFrame, trademark: DataFrame) -> DataFrame:
    """Sku x spu x trademark."""
    s = spu.select(F.col("id").alias("spu_id"), "spu_name")
    t = trademark.select(F.col("id").alias("tm_id"), "tm_name")
    return sku.join(s, "spu_id").join(t, "tm_id")


@dataclass(frozen=True)
class Step:
    """One dimension of a chain: where its ``dim_key`` is the value of ``key``, it gives ``columns`` (its name -> output name)."""

    key: str
    dim: DataFrame
    dim_key: str
    columns: dict[str, str]


def fold(steps: Sequence[Step], given: Sequence[str]) -> list[Step]:
    """Steps whose keys are ``given``, each with the steps below it joined to its dimension.

    A step below looks up a column that a step before it puts out. Dimensions meet only dimensions here, so that the
    big side is joined once for each given key, however long the chain.
    """
    roots: list[Step] = []
    for step in steps:
        if step.key in given:
            renamed = step.dim.select(F.col(step.dim_key), *[F.col(c).alias(n) for c, n in step.columns.items() if n != step.dim_key])
            roots.append(replace(step, dim=renamed, columns={n: n for n in step.columns.values()}))
            continue
        at = next((i for i, r in enumerate(roots) if step.key in r.columns), None)
        if at is None:
            raise ValueError(f"{step.key} is no column of the rows and no output of a step before")
        wider = enrich(roots[at].dim, step.dim, step.key, step.dim_key, step.columns)
        roots[at] = replace(roots[at], dim=wider, columns={**roots[at].columns, **{n: n for n in step.columns.values()}})
    return roots


def enrich_chain(df: DataFrame, steps: Sequence[Step], how: str = "left") -> DataFrame:
    """Columns of a chain of dimensions, such as sku, spu, trademark and three category levels.

    For late binding, give it the rows of a finished window: there is one for each window and key. A miss leaves the
    step's columns null, and those of the steps below; ``how="inner"`` drops rows whose given key misses. A step that is
    not wanted, such as a user's birthday, is left out of ``steps`` (Q18). Dimensions are unique per key.
    """
    given = df.columns
    for root in fold(steps, given):
        df = enrich(df, root.dim, root.key, root.dim_key, root.columns, how)
    return df


def scan(dim: DataFrame, row_key: str, limit: int | None = None) -> DataFrame:
    """Dimension rows with their key as ``row_key``; the limit is the feature of this scan."""
    rows = dim.withColumn("row_key", F.col(row_key).cast("string"))
    return rows.limit(limit) if limit is not None else rows


def row_count(dim: DataFrame) -> DataFrame:
    """S7."""
    return dim.agg(F.count("*").alias("row_count"))
