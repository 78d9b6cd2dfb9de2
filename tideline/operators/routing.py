"""Rule-driven routing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators.cdc import image, keep_fields
from tideline.operators.dedup import latest_per_key

# The change ops that a rule's source type stands for (Q8).
SOURCE_TYPE_OPS = {"insert": ["c", "r"], "update": ["u"], "delete": ["d"]}


def latest_rules(rule_changes: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """The rules in force: newest change per key, without keys whose newest change is a delete."""
    rows = rule_changes.withColumn("_row", image()).select(
        F.col("op").alias("_op"), "ts_ms", *[F.col("_row")[c].alias(c) for c in columns]
    )
    return latest_per_key(rows, keys, ["ts_ms", "_op"]).filter(F.col("_op") != "d").drop("_op", "ts_ms")


def with_ops(rules: DataFrame) -> DataFrame:
    """One rule row per change op; a rule without a source type applies to every op."""
    table = F.create_map(
        *[x for k, ops in SOURCE_TYPE_OPS.items() for x in (F.lit(k), F.array(*map(F.lit, ops)))]
    )
    every = F.array(*[F.lit(op) for ops in SOURCE_TYPE_OPS.values() for op in ops])
    ops = F.coalesce(F.element_at(table, F.col("source_type")), every)
    return rules.withColumn("rule_op", F.explode(ops))


def router(
    read_rules: Callable[[], DataFrame], write: Callable[[DataFrame, int], None],
    write_rest: Callable[[DataFrame, int], None] | None = None, by_op: bool = False,
) -> Callable[[DataFrame, int], None]:
    """J9/J10 for ``foreachBatch``: rules are read anew for each micro-batch, so a changed rule applies from
    the next batch on. Both outputs come from one pass over the batch and one reading of the rules."""

    def handle(changes: DataFrame, batch_id: int) -> None:
        tagged = with_rules(changes, read_rules(), by_op).persist()
        try:
            write(matched_rows(tagged), batch_id)
            if write_rest is not None:
                write_rest(unmatched_rows(tagged, changes.columns), batch_id)
        finally:
            tagged.unpersist()

    return handle


def with_rules(changes: DataFrame, rules: DataFrame, by_op: bool = False) -> DataFrame:
    """Changes with the rule of their table (and op) in ``_rule``, null where there is none.

    A table has one rule (with ``by_op`` one for each op): of several, the last by sink and columns. Catalyst broadcasts
    the rules where their size allows.
    """
    side = with_ops(rules) if by_op else rules
    on = ["_table", *(["_rule_op"] if by_op else [])]
    side = side.select(
        F.col("source_table").alias("_table"),
        *([F.col("rule_op").alias("_rule_op")] if by_op else []),
        F.struct("sink_table", F.transform(F.split("sink_columns", ","), lambda c: F.trim(c)).alias("columns")).alias("_rule"),
    )
    side = side.filter(F.col("_table").isNotNull()).groupBy(*on).agg(F.max("_rule").alias("_rule"))
    match = F.col("source")["table"] == F.col("_table")
    if by_op:
        match = match & (F.col("op") == F.col("_rule_op"))
    return changes.withColumn("_row", image()).join(side, match, "left").drop(*on)


def matched_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("_rule").isNotNull()).select(
        "_rule.sink_table", F.col("source")["table"].alias("source_table"), "op",
        keep_fields("_row", F.col("_rule.columns")).alias("data"), "ts_ms",
    )


def unmatched_rows(tagged: DataFrame, columns: list[str]) -> DataFrame:
    return tagged.filter(F.col("_rule").isNull()).select(*columns)


def route(changes: DataFrame, rules: DataFrame, by_op: bool = False) -> tuple[DataFrame, DataFrame]:
    """J9 (by table) / J10 (by table and op): matched rows with their sink and pruned columns; unmatched rows."""
    tagged = with_rules(changes, rules, by_op)
    return matched_rows(tagged), unmatched_rows(tagged, changes.columns)
