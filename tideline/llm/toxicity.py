"""Toxicity (operator 9): a support vector machine over a gap-weighted subsequence kernel with Nyström landmarks.

The kernel of two strings sums over their common subsequences of ORDER letters, each weighted by DECAY for every letter
it spans in either, so an insult with letters put in, left out or drawn apart is still much like itself. Landmarks are
strings that training tells toxic documents by. A document is compared with a landmark by its most similar word. The
landmarks' own kernel matrix makes those similarities Nyström features; a linear machine with a squared hinge is fitted
on them and its output turned into a probability.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.langid import held_out
from tideline.llm.registry import query, table
from tideline.llm.workers import bound_batches, release, released, shared, text_blocks
from tideline.session import scratch

ORDER = 4
DECAY = 0.8
TRAIN_ROWS = 10_000
MAX_LANDMARKS = 128
LANDMARK_LETTERS = range(4, 9)
MAX_CANDIDATES = 50_000
PIECE = 26
# Similarities below this count as none: most words are like no landmark.
FLOOR = 0.3
MEMO_WORDS = 1 << 17
THRESHOLD = 0.3
WORDS_AT_ONCE = 1 << 17

_APART = re.compile(r"(?<!\S)\w(?:[ ._*-]\w){3,}(?!\S)")
_MARKS = re.compile(r"[\W_]+")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def words_of(text: str) -> list[str]:
    """Words by white space, and each run of at least four letters that stand apart as one more word."""
    words = text.split()
    if min(map(len, words), default=0) == 1:
        words += [_MARKS.sub("", run) for run in _APART.findall(text)]
    return words


def unit(word: str) -> str:
    """A word as it is compared: in lower case, without marks around it, with its ends marked; empty if it has no letter."""
    word = word.lower()
    if not word.isalnum():
        word = _EDGES.sub("", word)
        if _APART.fullmatch(word):
            word = _MARKS.sub("", word)
    return f"^{word}$" if word else ""


def codes(strings: list[str], width: int) -> np.ndarray:
    """Code points, zeros behind."""
    return np.array(strings, dtype=f"U{width}").view(np.uint32).reshape(len(strings), width)


def letter_masks(points: np.ndarray) -> np.ndarray:
    """Sets of letters, the marks of a word's ends left out."""
    letters = (points > 0) & (points != ord("^")) & (points != ord("$"))
    bits = np.uint64(1) << (points & np.uint32(63)).astype(np.uint64)
    return np.bitwise_or.reduce(np.where(letters, bits, np.uint64(0)), axis=1)


def subsequence_kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Kernel of the strings in rows of ``a`` with those in rows of ``b``, pair by pair."""
    n, width = a.shape
    steps = np.arange(width)[None, :] - np.arange(width)[:, None]
    later = np.where(steps >= 0, DECAY ** np.maximum(0, steps).astype(float), 0.0).astype(np.float32)
    # ends[q]: of common subsequences of q letters, up to each letter of a, with a column before the first
    ends = np.zeros((ORDER, n, width + 1), dtype=np.float32)
    ends[0] = 1
    runs = np.zeros((ORDER, n, width), dtype=np.float32)
    total = np.zeros(n, dtype=np.float32)
    for j in range(b.shape[1]):
        letter = b[:, j : j + 1]
        match = ((a == letter) & (letter > 0)) * np.float32(DECAY * DECAY)
        total += (match * ends[ORDER - 1, :, :-1]).sum(axis=1)
        for q in range(ORDER - 1, 0, -1):
            runs[q] *= np.float32(DECAY)
            runs[q] += match * ends[q - 1, :, :-1]
            ends[q, :, 1:] = runs[q] @ later
    return total


@dataclass
class ToxicityModel:
    key: str
    landmarks: list[str]
    weights: np.ndarray  # of the similarities, the Nyström map taken in
    bias: float
    slope: float  # of the probability
    shift: float

    def scores(self, similarities: np.ndarray) -> np.ndarray:
        out = similarities @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * out + self.shift, -60, 60)))


class Similarities:
    """Of words with the landmarks, as a share of each landmark's kernel with itself, 1 at most. Keeps the last words."""

    def __init__(self, landmarks: list[str], limit: int = MEMO_WORDS):
        self.limit, self.m = limit, len(landmarks)
        self.points = codes(landmarks or [""], max(map(len, landmarks), default=1))
        self.own = subsequence_kernel(self.points, self.points) + 1e-30
        self.masks = letter_masks(self.points)
        letters = np.bitwise_count(self.masks)
        # A word that lacks more than one of a landmark's letters (any, if it has few) is taken to be unlike it.
        self.needs = np.where(letters > ORDER, letters - 1, letters)
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.rows = [np.zeros((1, self.m), dtype=np.float32)]
        self.n = 1

    def of_units(self, units: list[str]) -> np.ndarray:
        out = np.zeros((len(units), self.m), dtype=np.float32)
        if not units or not self.m:
            return out
        # Long words go in pieces that overlap by half.
        pieces, owner = [], []
        for k, u in enumerate(units):
            for start in range(0, max(1, len(u) - PIECE // 2), PIECE // 2) if len(u) > PIECE else (0,):
                pieces.append(u[start : start + PIECE])
                owner.append(k)
        points, owner = codes(pieces, PIECE), np.array(owner)
        masks, sizes = letter_masks(points), (points > 0).sum(axis=1)
        for landmark in range(self.m):
            common = np.bitwise_count(masks & self.masks[landmark])
            which = np.flatnonzero(common >= self.needs[landmark])
            which = which[np.argsort(sizes[which], kind="stable")]  # words of like length together
            own = self.points[landmark][self.points[landmark] > 0]
            for at in range(0, len(which), 4096):
                part = which[at : at + 4096]
                a = np.broadcast_to(own, (len(part), len(own)))
                like = np.minimum(1, subsequence_kernel(a, points[part, : sizes[part[-1]]]) / self.own[landmark])
                np.maximum.at(out[:, landmark], owner[part], like)
        out[out < FLOOR] = 0
        return out

    def of_texts(self, texts: list[str | None]) -> np.ndarray:
        """Of each text's most similar words; zeros for null and empty texts."""
        split = [words_of(t) if t else [] for t in texts]
        every = set().union(*split)
        new = list(every - self.at.keys())
        if len(self.at) + len(new) > self.limit:
            self._clear()
            new = list(every)
        units = {w: unit(w) for w in new}
        distinct = list(set(units.values()) - {""})
        found = self.of_units(distinct)
        some = np.flatnonzero(found.any(axis=1))
        place = dict(zip([distinct[k] for k in some], range(self.n, self.n + len(some)), strict=True))
        self.at.update((w, place.get(u, 0)) for w, u in units.items())
        self.rows.append(found[some])
        self.n += len(some)
        if len(self.rows) > 64:
            self.rows = [np.concatenate(self.rows)]
        lengths = np.array([len(s) for s in split], dtype=np.int64)
        ids = np.fromiter((self.at[w] for s in split for w in s), dtype=np.int64, count=int(lengths.sum()))
        text = np.repeat(np.arange(len(texts)), lengths)[ids > 0]
        ids = ids[ids > 0]
        out = np.zeros((len(texts), self.m), dtype=np.float32)
        if len(ids):
            starts = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
            if len(self.rows) > 1:
                self.rows = [np.concatenate(self.rows)]
            out[text[starts]] = np.maximum.reduceat(self.rows[0][ids], starts, axis=0)
        return out


def _grams(text: str | None) -> set[str]:
    found = set()
    for word in set(words_of(text or "")):
        u = unit(word)
        for n in LANDMARK_LETTERS:
            found.update(u[i : i + n] for i in range(len(u) - n + 1))
        if ORDER <= len(u) <= PIECE // 2 + 3:
            found.add(u)
    return found


def _counts(rows: DataFrame, only: frozenset[str] | None) -> DataFrame:
    """gram, toxic: in how many documents each string of letters stands."""
    sent = rows.sparkSession.sparkContext.broadcast(only)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                grams = _grams(text)
                found[toxic].update(grams if sent.value is None else grams & sent.value)
        for toxic, own in enumerate(found):
            yield pa.record_batch([pa.array(list(own), pa.string()), pa.array([toxic] * len(own), pa.int32()), pa.array(list(own.values()), pa.int64())], ["gram", "toxic", "n"])

    found = rows.select("text", "toxic").mapInArrow(released(count), "gram string, toxic int, n bigint")
    return found.groupBy("gram", "toxic").agg(F.sum("n").alias("n"))


def choose_landmarks(rows: DataFrame, n_toxic: int, n_clean: int, most: int = MAX_LANDMARKS) -> list[str]:
    """Strings that between them stand in as many toxic and as few other documents as can be, each picked for those still left."""
    common = _counts(rows.filter("toxic = 1"), None).filter(F.col("n") >= min(3, max(1, n_toxic // 50)))
    toxic = {r.gram: r.n for r in common.orderBy(F.desc("n"), "gram").limit(MAX_CANDIDATES).collect()}
    clean = {r.gram: r.n for r in _counts(rows.filter("toxic = 0"), frozenset(toxic)).collect()}
    # By how far the two shares lie apart, in standard errors.
    rate = {}
    for gram, n in toxic.items():
        p, q = n / n_toxic, clean.get(gram, 0) / max(1, n_clean)
        both = (n + clean.get(gram, 0) + 1) / (n_toxic + n_clean + 2)
        rate[gram] = (p - q) / np.sqrt(both * (1 - both))
    # Of strings that stand in equally many documents, the longest says most.
    top = sorted((g for g in rate if rate[g] > 0), key=lambda g: (-round(rate[g], 6), -len(g), g))[:2000]
    at = rows.sparkSession.sparkContext.broadcast({g: k for k, g in enumerate(top)})

    @F.pandas_udf("array<int>")
    def held(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sorted(at.value[g] for g in _grams(t) if g in at.value))

    inside = [r.held for r in rows.filter("toxic = 1").select(held("text").alias("held")).collect()]
    left = np.full(len(inside), 3.0)  # each document is to have some landmarks, the first matter most
    has = np.zeros((len(top), len(inside)), dtype=bool)
    for doc, grams in enumerate(inside):
        has[grams, doc] = True
    cost = np.array([5.0 * n_toxic / max(1, n_clean) * clean.get(g, 0) for g in top])
    chosen: list[int] = []
    while top and len(chosen) < most:
        gain = has @ left - 3 * cost
        gain[chosen] = -1
        best = int(gain.argmax())
        if gain[best] < 0.005 * n_toxic:
            break
        chosen.append(best)
        left[has[best]] /= 2
    return [top[k] for k in chosen]


def fit_machine(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> tuple[np.ndarray, float]:
    """Linear machine with a squared hinge, classes weighted alike, by Newton steps on its support vectors."""
    x1 = np.c_[x, np.ones(len(x))]
    sign = np.where(y == 1, 1.0, -1.0)
    cost = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    ridge = penalty * np.eye(x1.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x1.shape[1])
    for _ in range(50):
        inside = sign * (x1 @ w) < 1
        part = x1[inside] * cost[inside][:, None]
        new = np.linalg.solve(ridge + part.T @ x1[inside], part.T @ sign[inside])
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w[:-1], float(w[-1])


def fit_probability(out: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through the machine's outputs, with Platt's targets."""
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x, w = np.c_[out, np.ones(len(out))], np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2), x.T @ (target - p) - 1e-3 * w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = TRAIN_ROWS) -> ToxicityModel:
    """A model from about ``max_rows`` labelled documents outside of the held-out quarter, chosen by a hash of doc_id.

    Labels other than 0 and 1 are left out; of several labels of a document, 1 wins. Whole texts are used. What reaches
    the driver is bounded by ``max_rows``, MAX_CANDIDATES and MAX_LANDMARKS. Without toxic or without other documents
    the model gives their share as every score.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    marked = labels.filter("toxic in (0, 1) and doc_id is not null").filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = marked.count()
    if n > max_rows:
        marked = marked.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * max_rows / n))
    # Some max_rows ids and labels: the documents themselves aren't shuffled.
    folder = scratch(spark, "labelled")
    docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id").repartition(64, "doc_id").select("text", "toxic").write.parquet(folder)
    rows = spark.read.parquet(folder)
    n_toxic, n_all = rows.filter("toxic = 1").count(), rows.count()
    share = (n_toxic + 1) / (n_all + 2)
    nothing = ToxicityModel(uuid.uuid4().hex, [], np.zeros(0), 0.0, 1.0, float(np.log(share / (1 - share))))
    if not 0 < n_toxic < n_all:
        return nothing
    landmarks = choose_landmarks(rows, n_toxic, n_all - n_toxic)
    if not landmarks:
        return nothing
    found = with_similarities(rows, landmarks).select("toxic", "like").collect()
    x, y = np.array([r.like for r in found]), np.array([r.toxic for r in found])
    # Nyström: features whose inner products are the kernel, as the landmarks see it.
    points = Similarities(landmarks)
    m = len(landmarks)
    left, right = np.repeat(np.arange(m), m), np.tile(np.arange(m), m)
    kernel = subsequence_kernel(points.points[left], points.points[right]).reshape(m, m) / np.sqrt(np.outer(points.own, points.own))
    values, vectors = np.linalg.eigh((kernel + kernel.T) / 2)
    root = vectors @ np.diag(1 / np.sqrt(np.maximum(values, 0.05))) @ vectors.T
    weights, bias = fit_machine(x @ root, y)
    slope, shift = fit_probability(x @ root @ weights + bias, y)
    return ToxicityModel(uuid.uuid4().hex, landmarks, root @ weights, bias, slope, shift)


_KNOWN: dict[str, Similarities] = shared({})


def _similarities(key: str, landmarks: list[str]) -> Similarities:
    """One for each worker: that of the last landmarks used there."""
    if key not in _KNOWN:
        release()
        _KNOWN[key] = Similarities(landmarks)
    return _KNOWN[key]


def with_similarities(rows: DataFrame, landmarks: list[str]) -> DataFrame:
    key = uuid.uuid4().hex

    @F.arrow_udf("array<float>")
    def like(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = _similarities(key, landmarks)
        try:
            for batch in batches:
                yield pa.array([row for block in text_blocks(batch, WORDS_AT_ONCE) for row in known.of_texts(block)], pa.list_(pa.float32()))
        finally:
            release()

    return rows.withColumn("like", like("text"))


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Adds score (0 to 1) and predicted (1 if score >= ``threshold``); other columns and repeated rows stay, columns of
    these names are replaced. Null and empty texts are like no landmark and get the score of that. No rows: no rows."""
    bound_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = _similarities(sent.value.key, sent.value.landmarks)
        try:
            for batch in batches:
                parts = [sent.value.scores(known.of_texts(block)) for block in text_blocks(batch, WORDS_AT_ONCE)]
                yield pa.array(np.concatenate([*parts, np.zeros(0)]), pa.float64())
        finally:
            release()  # Spark keeps workers that wait, more of them than it runs at a time

    scored = docs.withColumn("score", score(F.col(text)))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


@query("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")
