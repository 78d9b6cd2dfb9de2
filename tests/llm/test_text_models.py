"""Language identification and toxicity: their algorithms against brute force, and accuracy on held-out documents."""

from __future__ import annotations

from itertools import combinations, product

import numpy as np
import pytest

import corpus_pipeline
from tideline.llm import langid, toxicity
from tideline.llm.registry import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def test_best_path_is_the_best_of_all():
    rng = np.random.default_rng(3)
    for chunk in (2, 3, 128):
        lengths = np.array([1, 5, 7, 2, 6])
        scores = rng.integers(-4, 5, (lengths.sum(), 3)).astype(np.float32)
        got = langid.best_path(scores, lengths, 3.0, chunk)
        at = 0
        for n in lengths:
            part = scores[at : at + n]
            value = lambda p, part=part: sum(part[i, s] for i, s in enumerate(p)) - 3.0 * sum(a != b for a, b in zip(p, p[1:], strict=False))
            best = max(value(p) for p in product(range(3), repeat=int(n)))
            assert value(list(got[at : at + n])) == pytest.approx(best)
            at += n


def test_words_are_scored_together_as_one_by_one(monkeypatch):
    words = ["Straße", "ΟΔΟΣ", "İ", "a1b2", "x²", "_", "12", "^a$", "e\u0301", "漢字かな", "abбв", "бвa", "\U0001d400\U00010400", "Ǆ", "ꬰ", "ab", "AB", "\x00a", "слово", "a" * 9000]
    rng = np.random.default_rng(5)
    words += ["".join(rng.choice(list("abcäßбΣ漢-_7'"), rng.integers(1, 9))) for _ in range(400)]
    words = list(dict.fromkeys(words))
    letters = [langid.letters_of(w) for w in words]
    grams = sorted({g for word in letters if word for g in langid.grams_of(word)})[::2]
    scripts = {"latin": np.array([True, True, False]), "cyrillic": np.array([False, False, True]), "han": np.zeros(3, dtype=bool)}
    model = langid.LanguageModel("m", ["a", "b", "c"], {g: k for k, g in enumerate(grams)}, -rng.random((len(grams) + 1, 3)).astype(np.float32), scripts)
    want = np.zeros((len(words), 3), dtype=np.float32)
    for k, word in enumerate(letters):
        if word:
            sums = np.add.reduceat(model.scores[[model.grams.get(g, len(grams)) for g in langid.grams_of(word)]], [0], axis=0)[0]
            users = scripts.get(langid.script_of(word), np.ones(3, dtype=bool))
            want[k] = np.where(users if users.any() else True, sums - sums.max(), -200.0)

    def one_by_one(word):
        raise AssertionError("a step in Python for each word")

    monkeypatch.setattr(langid, "script_of", one_by_one)
    monkeypatch.setattr(langid, "grams_of", one_by_one)
    monkeypatch.setattr(langid, "letters_of", one_by_one)
    monkeypatch.setattr(langid, "WORDS_LEARNED", 50, raising=False)
    scored = langid.WordScores(model)
    at = scored.look_up(words + words[::-1])
    assert scored.letters[at[: len(words)]].tolist() == [len(w) for w in letters]
    assert (scored.rows[at[: len(words)]] == want).all() and (at[len(words) :] == at[: len(words)][::-1]).all()


@pytest.fixture(scope="module")
def languages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return langid.fit_languages(langid.training_rows(docs))


def test_spans_of_mixed_and_odd_texts(spark, languages):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    one = {r.lang: r.text for r in docs.filter("length(text) between 300 and 600").collect()}
    mixed = one["en"] + " " + one["de"]
    rows = [(1, mixed), (2, None), (3, ""), (4, "12 34 !?"), (5, "слово ещё слово"), (5, "слово ещё слово"), (6, one["fr"] * 300)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, score string")
    got = {r.doc_id: r for r in langid.label_languages(frame, languages).collect()}
    spans = [s.lang for s in got[1].lang_spans]
    assert spans[0] == "en" and spans[-1] == "de" and len(spans) <= 4
    assert sum(s.n_words for s in got[1].lang_spans) == len(mixed.split())
    assert [(got[i].lang_pred, got[i].score, got[i].lang_spans) for i in (2, 3, 4)] == [("und", 0.0, [])] * 3
    assert got[5].lang_pred in languages.languages and got[6].lang_pred == "fr"
    assert langid.label_languages(frame.limit(0), languages).count() == 0


def test_a_filter_on_the_language_labels_once(spark, languages, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "table", lambda spark, sf_dir, name: None)
    monkeypatch.setattr(corpus_pipeline, "training_rows", lambda docs: None)
    monkeypatch.setattr(corpus_pipeline, "fit_languages", lambda rows: languages)
    docs = spark.createDataFrame([(1, "the thing and the other thing", None, "s"), (2, "12", "en", "s")], "doc_id long, text string, lang string, source string")
    kept = corpus_pipeline.language_id(spark, docs, "")
    assert kept._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [tuple(r) for r in kept.collect()] == [(1, "the thing and the other thing", "en", "s")]


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = langid.fit_languages(langid.training_rows(none))
    frame = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    assert [r.lang_pred for r in langid.label_languages(frame, model).collect()] == ["und"]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scored = toxicity.score_toxicity(frame, toxicity.fit_toxicity(frame, labels)).collect()
    assert 0 <= scored[0].score <= 1


def test_language_accuracy_on_held_out_documents(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op3_language_id"](spark, SF_DIR).collect() if r.held_out]
    assert len(rows) > 150 and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in rows) >= 0.97 * len(rows)


def gapped(text):
    out = {}
    for places in combinations(range(len(text)), toxicity.ORDER):
        key = "".join(text[i] for i in places)
        out[key] = out.get(key, 0) + toxicity.DECAY ** (places[-1] - places[0] + 1)
    return out


def test_kernel_is_the_sum_over_subsequences():
    for a, b in [("idiot", "idxiot"), ("abcabc", "bcabca"), ("trash", "tr.a.sh"), ("abcd", "dcba"), ("aaaaaa", "aaaa")]:
        x, y = gapped(a), gapped(b)
        want = sum(v * y.get(k, 0) for k, v in x.items())
        got = toxicity.subsequence_kernel(toxicity.codes([a], 9), toxicity.codes([b], 26))
        assert got[0] == pytest.approx(want, rel=1e-5)


def test_insults_with_inserted_and_spaced_letters():
    words = toxicity.Similarities(["^idiot$", "^stupid$"])
    like = words.of_texts(["you idiot", "you id-iot!", "you i d i o t", "you stuupid", "an edition", None, "", "x" * 5000 + "idiot"])
    assert like[0, 0] == 1 and like[1, 0] > 0.6 and like[2, 0] == 1 and like[3, 1] > 0.6
    assert like[4].max() < 0.5 and like[5].max() == 0 and like[6].max() == 0 and like[7, 0] > 0.5


def test_toxicity_on_held_out_documents(spark):
    rng = np.random.default_rng(4)
    syllables = ["an", "er", "the", "ion", "st", "ha", "ou", "re", "in", "ed"]
    word = lambda: "".join(rng.choice(syllables, rng.integers(1, 4)))
    rows, labels = [], []
    for i in range(900):
        words = [word() for _ in range(rng.integers(20, 60))]
        toxic = i % 6 == 0
        if toxic:
            words[int(rng.integers(len(words)))] = str(rng.choice(["blorgu", "vexnik", "blo-rgu", "vexxnik"]))
        rows.append((i, " ".join(words), "x"))
        labels.append((i, 0, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    model = toxicity.fit_toxicity(docs, spark.createDataFrame([*labels, (1, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int"))
    scored = toxicity.score_toxicity(docs.withColumn("held_out", langid.held_out()), model).collect()
    held = [r for r in scored if r.held_out]
    assert sum(r.predicted == (r.doc_id % 6 == 0) for r in held) >= 0.97 * len(held)
    odd = spark.createDataFrame([(1, None), (2, ""), (2, ""), (3, "blorgu " * 20000)], "doc_id long, text string")
    got = sorted((r.doc_id, r.predicted) for r in toxicity.score_toxicity(odd, model).collect())
    assert got == [(1, 0), (2, 0), (2, 0), (3, 1)]
    assert toxicity.score_toxicity(odd.limit(0), model).count() == 0
