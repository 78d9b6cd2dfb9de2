"""Tables that Python workers keep."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tideline.llm import jaccard, langid, toxicity, workers


def test_release_empties_every_cache():
    assert any(c is langid._SCORES for c in workers.HELD) and any(c is toxicity._KNOWN for c in workers.HELD)
    langid._SCORES["m"], toxicity._KNOWN["k"] = object(), object()
    workers.release()
    assert not langid._SCORES and not toxicity._KNOWN
    workers.release()  # nothing held: nothing to do


def test_a_new_model_frees_the_other_stage():
    langid._SCORES["m"] = object()
    first = toxicity._similarities("a", ["bad", "worse"])
    assert not langid._SCORES and toxicity._similarities("a", ["bad", "worse"]) is first
    assert toxicity._similarities("b", ["bad"]) is not first and list(toxicity._KNOWN) == ["b"]
    workers.release()


def test_text_blocks_hold_all_texts_in_order():
    texts = ["", None, *["word " * k for k in range(300)], None]
    blocks = list(workers.text_blocks(pa.array(["skipped", *texts], pa.string()).slice(1), 500))
    assert [t for b in blocks for t in b] == texts and all(sum(len(t or "") // 6 for t in b[:-1]) < 500 for b in blocks)
    assert list(workers.text_blocks(pa.array([], pa.string()), 500)) == []


@pytest.mark.parametrize("stage", ["langid", "toxicity"])
def test_a_task_leaves_no_table_in_its_worker(spark, stage):
    docs = spark.createDataFrame([(f"some words {k}",) for k in range(8)], "text string")
    if stage == "langid":
        model = langid.LanguageModel("left", ["a", "b"], {}, np.zeros((1, 2), dtype=np.float32), {})
        labelled = langid.label_languages(docs, model)
    else:
        labelled = toxicity.score_toxicity(docs, toxicity.ToxicityModel("left", ["bad"], np.ones(1), 0.0, 1.0, 0.0))
    assert labelled.collect()

    @F.arrow_udf("int")
    def held(rows: pa.Array) -> pa.Array:
        return pa.array([sum(map(len, workers.HELD))] * len(rows), pa.int32())

    # Of the workers that Spark uses again, none holds a table.
    assert {r[0] for r in spark.range(0, 64, 1, 8).select(held("id")).collect()} == {0}


LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.mark.parametrize("stage", ["langid", "toxicity", "jaccard"])
def test_batches_end_by_bytes(spark, stage):
    """Long texts: no batch holds all rows that Spark would put into it, and no row is lost."""
    spark.conf.unset(LIMIT)
    docs = spark.range(2000).selectExpr("id as doc_id", "repeat(concat('word', id, ' '), 1200) as text").coalesce(1)
    few = docs.limit(4)
    if stage == "langid":
        langid.label_languages(few, langid.LanguageModel("few", ["a"], {}, np.zeros((1, 1), dtype=np.float32), {}))
    elif stage == "toxicity":
        toxicity.score_toxicity(few, toxicity.ToxicityModel("few", ["bad"], np.ones(1), 0.0, 1.0, 0.0))
    else:
        jaccard.jaccard_components(few)

    def sizes(batches):
        for b in batches:
            yield pa.record_batch([pa.array([b.num_rows]), pa.array([b.nbytes])], ["n", "bytes"])

    found = docs.mapInArrow(sizes, "n long, bytes long").collect()
    assert sum(r.n for r in found) == 2000 and sum(r.bytes for r in found) > 3 * workers.BATCH_BYTES
    assert max(r.bytes for r in found) < 1.1 * workers.BATCH_BYTES


def test_a_limit_of_the_session_stays(spark):
    spark.conf.set(LIMIT, "12345")
    workers.bound_batches(spark)
    assert spark.conf.get(LIMIT) == "12345"
    spark.conf.unset(LIMIT)


def test_a_released_task_starts_and_ends_without_tables():
    seen = []

    def task(batches):
        seen.append(dict(langid._SCORES))
        langid._SCORES["own"] = object()
        yield from batches

    langid._SCORES["left"] = object()
    assert list(workers.released(task)(iter([1, 2]))) == [1, 2] and seen == [{}] and not langid._SCORES
    early = workers.released(task)(iter([1, 2]))
    assert next(early) == 1 and langid._SCORES
    early.close()
    assert not langid._SCORES
