"""Language identification (operator 3): script ranges narrow the candidates, Viterbi over word scores labels spans.

A word's score in a language is the log probability of its letter trigrams there. A text's words are labelled by the
best path, where every change of language costs a penalty, so a borrowed word doesn't cut a span and a quoted sentence
does. The text's language is the one with most letters on the path.
"""

from __future__ import annotations

import re
import uuid
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.llm.registry import query, table
from tideline.llm.workers import bound_batches, release, released, shared, text_blocks

UNKNOWN = "und"
TRAIN_ROWS = 20_000
MAX_GRAMS = 200_000
SWITCH_PENALTY = 12.0
MEMO_WORDS = 1 << 17
WORDS_AT_ONCE = 1 << 17
# New words that are scored together.
WORDS_LEARNED = 1 << 13
# Texts whose words are counted together.
COUNT_ROWS = 1024

# First code points of script blocks, by the Unicode block list; letters before the first are Latin.
SCRIPTS = [
    (0x0041, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
    (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0E00, "thai"),
    (0x10A0, "georgian"), (0x1100, "hangul"), (0x1E00, "latin"), (0x1F00, "greek"), (0x3040, "kana"),
    (0x3100, "han"), (0xAC00, "hangul"), (0xD800, "other"), (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"),
]
_STARTS = [start for start, _ in SCRIPTS]
_LETTERS = re.compile(r"[^\W\d_]+")
_NO_LETTERS = re.compile(r"(?:[^\w\n]|[\d_])+")
_BEGIN, _END = ord("^"), ord("$")
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_LATIN = SCRIPT_NAMES.index("latin")
_FIRST_POINTS = np.array(_STARTS, dtype=np.uint32)
_SCRIPT_AT = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])


def script_of(letters: str) -> str:
    """Script of most letters of a word; of equally many, the first by name."""
    if letters.isascii():
        return "latin"
    found = Counter(SCRIPTS[max(0, bisect_right(_STARTS, ord(c)) - 1)][1] for c in letters)
    return min(found, key=lambda s: (-found[s], s))


def letters_of(word: str) -> str:
    return word.lower() if word.isalpha() else "".join(_LETTERS.findall(word)).lower()


def grams_of(letters: str) -> list[str]:
    padded = f"^{letters}$"
    return [padded[i : i + 3] for i in range(len(padded) - 2)]


def points_of(words: list[str]) -> np.ndarray:
    """Code points of the letters (as of ``letters_of``) of words without white space, each word between ``^`` and ``$``."""
    letters = _NO_LETTERS.sub("", "\n".join(words)).lower()
    padded = "^" + letters.replace("\n", "$^") + "$"
    return np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def gram_keys(points: np.ndarray) -> np.ndarray:
    """One number for each three code points that follow one another; a code point has 21 bits."""
    wide = points.astype(np.int64)
    return wide[:-2] << 42 | wide[1:-1] << 21 | wide[2:]


def scripts_of(points: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``script_of`` for each word of ``points_of`` and of ``lengths`` letters, as a place in ``SCRIPT_NAMES``."""
    found = np.full(len(lengths), _LATIN)
    owner = np.repeat(np.arange(len(lengths)), lengths + 2)
    other = np.zeros(len(lengths), dtype=bool)
    other[owner[points >= 128]] = True
    if other.any():
        at = np.flatnonzero(other[owner] & (points != _BEGIN) & (points != _END))
        script = _SCRIPT_AT[np.maximum(0, np.searchsorted(_FIRST_POINTS, points[at], side="right") - 1)]
        kinds = len(SCRIPT_NAMES)
        counts = np.bincount(owner[at] * kinds + script, minlength=len(lengths) * kinds).reshape(-1, kinds)
        found[other] = counts[other].argmax(axis=1)
    return found


@dataclass
class LanguageModel:
    key: str  # unlike that of any other model
    languages: list[str]
    grams: dict[str, int]  # row of ``scores``
    scores: np.ndarray  # (grams + 1, languages) log probabilities; the last row is that of a gram never seen
    scripts: dict[str, np.ndarray]  # which languages use a script


def training_rows(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Labelled rows outside of the held-out quarter."""
    return docs.filter(~held_out(id_column) & F.col("lang").isNotNull() & F.col("text").isNotNull())


def held_out(id_column: str = "doc_id"):
    return F.coalesce(F.pmod(F.crc32(F.col(id_column).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit_languages(rows: DataFrame, max_rows: int = TRAIN_ROWS, max_grams: int = MAX_GRAMS) -> LanguageModel:
    """Trigram scores and scripts by language, from about ``max_rows`` rows (text, lang), chosen by a hash of the text.

    Whole texts are counted. What reaches the driver is bounded: counts of the ``max_grams`` commonest trigrams and of
    scripts. No rows: a model without languages, which predicts ``und`` for every text.
    """
    bound_batches(rows.sparkSession)
    rows = rows.select("text", "lang")
    n = rows.count()
    if n > max_rows:
        rows = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int((1 << 20) * max_rows / n))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[str, Counter] = {}
        for batch in (b.slice(at, COUNT_ROWS) for b in batches for at in range(0, b.num_rows, COUNT_ROWS)):
            words: dict[str, Counter] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words.setdefault(lang, Counter()).update(text.split())
            for lang, found in words.items():
                own = grams.setdefault(lang, Counter())
                for word, k in found.items():
                    letters = letters_of(word)
                    if letters:
                        own[f"script {script_of(letters)}"] += k
                        for gram in grams_of(letters):
                            own[gram] += k
        for lang, own in grams.items():
            yield pa.record_batch([pa.array([lang] * len(own)), pa.array(list(own)), pa.array(list(own.values()), pa.int64())], ["lang", "gram", "n"])

    found = rows.mapInArrow(released(count), "lang string, gram string, n bigint").groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    by_gram = found.groupBy("gram").agg(F.sum("n").alias("total"), F.collect_list(F.struct("lang", "n")).alias("by"))
    is_script = F.col("gram").startswith("script ")
    top = by_gram.orderBy(F.desc(is_script), F.desc("total"), "gram").limit(max_grams + len(SCRIPTS)).collect()
    languages = sorted({b.lang for r in top for b in r.by})
    at = {lang: k for k, lang in enumerate(languages)}
    scripts: dict[str, np.ndarray] = {}
    grams: dict[str, int] = {}
    counts = np.zeros((len(top) + 1, len(languages)))
    for r in top:
        row = np.zeros(len(languages))
        for b in r.by:
            row[at[b.lang]] = b.n
        if r.gram.startswith("script "):
            scripts[r.gram[7:]] = row
        else:
            counts[len(grams)] = row
            grams[r.gram] = len(grams)
    counts = counts[: len(grams) + 1] + 0.5
    scores = np.log(counts / counts.sum(axis=0, keepdims=True)).astype(np.float32)
    # A language uses a script that holds at least a hundredth of its words.
    words = sum(scripts.values()) if scripts else np.zeros(0)
    return LanguageModel(uuid.uuid4().hex, languages, grams, scores, {s: row >= 0.01 * words for s, row in scripts.items()})


class WordScores:
    """Scores and letters of words; a table of the last words of at most ``limit`` entries."""

    def __init__(self, model: LanguageModel, limit: int = MEMO_WORDS):
        self.model, self.limit = model, max(1024, limit * 4 // max(4, len(model.languages)))
        grams = [g for g in model.grams if len(g) == 3]
        self.grams = pd.Index(gram_keys(np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), dtype=np.uint32))[::3] if grams else np.zeros(0, dtype=np.int64))
        self.gram_rows = np.array([model.grams[g] for g in grams] + [len(model.grams)])  # the last: of a gram never seen
        everyone = np.ones(len(model.languages), dtype=bool)
        users = [model.scripts.get(name, everyone) for name in SCRIPT_NAMES]
        self.allowed = np.array([u if u.any() else everyone for u in users])
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.rows = np.zeros((4096, len(self.model.languages)), dtype=np.float32)
        self.letters = np.zeros(4096, dtype=np.int64)

    def look_up(self, words: list[str]) -> np.ndarray:
        new = list(set(words) - self.at.keys())
        if len(self.at) + len(new) > self.limit:
            self._clear()
            new = list(set(words))
        if new:
            self._learn(new)
        return np.fromiter(map(self.at.__getitem__, words), dtype=np.int64, count=len(words))

    def _learn(self, new: list[str]) -> None:
        n = len(self.at)
        while n + len(new) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
        self.at.update(zip(new, range(n, n + len(new)), strict=True))
        for at in range(0, len(new), WORDS_LEARNED):
            part = new[at : at + WORDS_LEARNED]
            own = slice(n + at, n + at + len(part))
            self.rows[own], self.letters[own] = self._score(part)

    def _score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        model, points = self.model, points_of(words)
        lengths = np.diff(np.flatnonzero(points == _BEGIN), append=len(points)) - 2
        rows = np.zeros((len(words), len(model.languages)), dtype=np.float32)
        some = np.flatnonzero(lengths)
        if len(some) and model.languages:
            inside = (points[:-2] != _END) & (points[1:-1] != _END)
            ids = self.gram_rows[self.grams.get_indexer(gram_keys(points)[inside])]
            starts = (np.cumsum(lengths) - lengths)[some]
            scores = np.add.reduceat(model.scores[ids], starts, axis=0)
            # Languages without the word's script are out, by more than any trigram could make good.
            allowed = self.allowed[scripts_of(points, lengths)[some]]
            rows[some] = np.where(allowed, scores - scores.max(axis=1, keepdims=True), -200.0)
        return rows, lengths


def best_path(scores: np.ndarray, lengths: np.ndarray, penalty: float, chunk: int = 128) -> np.ndarray:
    """Viterbi labels of words: ``scores`` (words, states), texts of ``lengths`` words one after another.

    Texts are cut into chunks, all chunks go forward at once for every state before their first word; the chunks of a
    text are then put together. The result is the exact best path; of equally good ones, it stays where it can.
    """
    n, k = scores.shape
    if not n or not k:
        return np.zeros(n, dtype=np.int64)
    chunks = -(-lengths // chunk)
    total = int(chunks.sum())
    text_first = np.cumsum(chunks) - chunks
    text = np.repeat(np.arange(len(lengths)), chunks)
    order = np.arange(total) - text_first[text]
    word_start = (np.cumsum(lengths) - lengths)[text] + order * chunk
    size = np.minimum(chunk, lengths[text] - order * chunk)
    steps = int(size.max())
    padded = np.zeros((steps, total, k), dtype=np.float32)
    in_chunk = np.arange(n) - np.repeat(word_start, size)
    owner = np.repeat(np.arange(total), size)
    padded[in_chunk, owner] = scores

    state = np.full((total, k, k), -np.inf, dtype=np.float32)
    state[:, np.arange(k), np.arange(k)] = 0
    stay = np.empty((steps, total, k, k), dtype=bool)
    best = np.empty((steps, total, k), dtype=np.int16)
    for t in range(steps):
        best[t] = state.argmax(axis=2)
        change = state.max(axis=2, keepdims=True) - penalty
        np.greater_equal(state, change, out=stay[t])
        state = np.maximum(state, change) + padded[t][:, None, :]

    # Chunk after chunk of all texts at once.
    came = np.empty((total, k), dtype=np.int64)
    value = np.zeros((len(lengths), k))
    for i in range(int(chunks.max())):
        texts = np.flatnonzero(chunks > i)
        at = text_first[texts] + i
        sums = value[texts][:, :, None] + state[at]
        came[at] = sums.argmax(axis=1)
        value[texts] = sums.max(axis=1)
    end = np.empty(total, dtype=np.int64)
    start = np.empty(total, dtype=np.int64)
    now = value.argmax(axis=1)
    for i in range(int(chunks.max()) - 1, -1, -1):
        texts = np.flatnonzero(chunks > i)
        at = text_first[texts] + i
        end[at] = now[texts]
        start[at] = came[at, now[texts]]
        now[texts] = start[at]

    labels = np.empty((steps, total), dtype=np.int64)
    now, all_ = end, np.arange(total)
    for t in range(steps - 1, -1, -1):
        labels[t] = now
        now = np.where(stay[t, all_, start, now], now, best[t, all_, start])
    return labels[in_chunk, owner]


def label_batch(texts: list[str | None], words: WordScores, penalty: float) -> Iterator[tuple[str, float, list[dict]]]:
    """For each text its language, that language's share of the letters, and its spans of words."""
    languages = words.model.languages
    k = len(languages)
    split = [t.split() if t else [] for t in texts]
    lengths = np.array([len(s) for s in split], dtype=np.int64)
    ids = words.look_up([w for s in split for w in s])
    letters = words.letters[ids]
    used = np.flatnonzero(lengths)
    labels = best_path(words.rows[ids], lengths[used], penalty)
    text = np.repeat(np.arange(len(texts)), lengths)
    if k:
        shares = np.bincount(text * k + labels, weights=letters, minlength=len(texts) * k).reshape(-1, k)
    else:
        shares = np.zeros((len(texts), 1))
    sums, tops = shares.sum(axis=1), shares.argmax(axis=1)
    first = np.cumsum(lengths) - lengths
    turns = np.flatnonzero(np.r_[True, (labels[1:] != labels[:-1]) | (text[1:] != text[:-1])]) if len(ids) else np.zeros(0, dtype=np.int64)
    ends = np.r_[turns[1:], len(ids)]
    span_at = np.searchsorted(turns, np.r_[first, len(ids)])
    for i in range(len(texts)):
        if not k or not sums[i]:
            yield UNKNOWN, 0.0, []
            continue
        spans = [
            {"first_word": int(turns[j] - first[i]), "n_words": int(ends[j] - turns[j]), "lang": languages[labels[turns[j]]]}
            for j in range(span_at[i], span_at[i + 1])
        ]
        yield languages[tops[i]], float(shares[i, tops[i]] / sums[i]), spans


SPANS = T.ArrayType(T.StructType([T.StructField("first_word", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("lang", T.StringType())]))
FOUND = pa.struct([
    ("lang_pred", pa.string()), ("score", pa.float64()),
    ("lang_spans", pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()), ("lang", pa.string())]))),
])
_SCORES: dict[str, WordScores] = shared({})


def _word_scores(model: LanguageModel) -> WordScores:
    """One for each worker: that of the last model used there."""
    if model.key not in _SCORES:
        release()
        _SCORES[model.key] = WordScores(model)
    return _SCORES[model.key]


def label_languages(docs: DataFrame, model: LanguageModel, text: str = "text", penalty: float = SWITCH_PENALTY) -> DataFrame:
    """Adds lang_pred, score and lang_spans; other columns and repeated rows stay, columns of these names are replaced.

    ``lang_pred``: a learned language, or ``und`` with score 0 and no spans if the text is null or has no letter.
    ``score``: share of the letters in spans of that language. Of equally good languages, the first by name. Texts of
    any length are labelled whole.
    """
    bound_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("lang_spans", SPANS)])

    @F.arrow_udf(kind)
    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = _word_scores(sent.value)
        try:
            for batch in batches:
                parts = [pa.array([], FOUND)]
                for block in text_blocks(batch, WORDS_AT_ONCE):
                    parts.append(pa.array([dict(zip(FOUND.names, row, strict=True)) for row in label_batch(block, words, penalty)], FOUND))
                yield pa.concat_arrays(parts)
        finally:
            release()  # Spark keeps workers that wait, more of them than it runs at a time

    # Else Spark would label once for a filter on the result and once more for the result.
    found = docs.withColumn("_found", label.asNondeterministic()(F.col(text)))
    return found.withColumns({c: F.col("_found")[c] for c in ("lang_pred", "score", "lang_spans")}).drop("_found")


@query("op3_language_id")
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_languages(training_rows(docs))
    labelled = label_languages(docs.select("doc_id", "text"), model)
    return labelled.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "lang_spans")
