"""The corpus pipeline: documents in, packed training sequences out. Every stage is written as Parquet and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import ORACLE_SQL as QUERY_SQL
from tideline.llm import QUERIES as OPERATOR_QUERIES
from tideline.llm.decontaminate import decontaminate
from tideline.llm.jaccard import jaccard_components
from tideline.llm.langid import UNKNOWN, fit_languages, label_languages, training_rows
from tideline.llm.packing import byte_length, pack
from tideline.llm.registry import table
from tideline.llm.toxicity import fit_toxicity, score_toxicity
from tideline.session import scratch, ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# A document is rejected if less than this share of its letters is in one language.
LANGUAGE_SHARE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents mainly in one language; a missing ``lang`` becomes the predicted one. Null texts and texts without
    letters go. The model is learned from the documents table, without its held-out quarter."""
    model = fit_languages(training_rows(table(spark, sf_dir, "documents")))
    # Apart from the documents' own columns, whatever their names.
    labelled = label_languages(docs.select(F.struct("*").alias("doc"), "text"), model)
    kept = labelled.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LANGUAGE_SHARE))
    filled = F.col("doc").withField("lang", F.coalesce("doc.lang", "lang_pred"))
    return kept.select(filled.alias("doc")).select("doc.*")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the model doesn't predict to be toxic; null and empty texts stay as their score says."""
    model = fit_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return score_toxicity(docs.select(F.struct("*").alias("doc"), "text"), model).filter("predicted = 0").select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each group of near copies (five words, similarity 0.8), and one row
    of it. Documents without shingles are no copies of each other; rows with a null doc_id stay."""
    first = jaccard_components(docs, words=5, percent=80).filter("doc_id = component_id").select("doc_id").distinct()
    one = docs.filter("doc_id is not null").join(first, "doc_id").dropDuplicates(["doc_id"]).select(*docs.columns)
    return one.unionByName(docs.filter("doc_id is null"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes; see ``tideline.llm.packing.pack``."""
    return pack(docs, byte_length(F.col("text")))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Learned models and best-fit packing have no SQL form; tests/llm/test_pipeline.py checks each stage by brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ship(spark), sf_dir, "documents")
    for name, stage in STAGES:
        folder = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs


QUERIES = {**OPERATOR_QUERIES, "pipeline": run}
