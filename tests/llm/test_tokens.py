"""Token counts and files against the library itself, and files read back."""

from __future__ import annotations

import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from tideline.llm import tokens  # noqa: E402
from tideline.llm.registry import QUERIES  # noqa: E402

PATH = tokens.vocabulary_path()
PARTS = ["the", " ", "  ", "\n", "\n\n", "\t", "word", "'s", " it's", "Été", "12", " 3.5", "<|endoftext|>", ".", " ", "漢字", "\x1c", "\r\n", "😀", "x\n y", "..", " "]


def awkward() -> list[str]:
    rng = random.Random(7)
    texts = ["", " ", "\n", " a", "a ", "a\n", "\na", "a\nb", "a \nb", "a\n b", "a  b", "<|endoftext|>", "a <|endoftext|> b", "a" * 5000]
    return texts + ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 30))) for _ in range(800)]


def library(texts: list[str]) -> list[list[int]]:
    return [e.ids for e in tokens._tokenizer(PATH).encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("limit", [1 << 20, 60])
def test_ids_are_the_librarys(limit):
    words, kind = tokens._encoder(PATH)
    words = tokens.Words(words.encode, {}, limit)
    texts = awkward()
    got = [np.frombuffer(b"".join(v), dtype=kind).tolist() for at in range(0, len(texts), 40) for v in words.values(texts[at : at + 40])]
    assert got == library(texts)


def test_counts_are_the_librarys():
    singles = frozenset(tokens.single_token_strings(PATH))
    assert " the" in singles and len(singles) > 40_000
    words = tokens.Words(tokens.PieceCounter(PATH, singles), dict.fromkeys(singles, 1))
    texts = awkward()
    assert [sum(v) for v in words.values(texts)] == [len(x) for x in library(texts)]


def test_every_character_counts_as_in_the_library():
    """The pattern's letter and digit classes must be those of the library, character by character."""
    singles = frozenset(tokens.single_token_strings(PATH))
    counter = tokens.PieceCounter(PATH, singles)
    chars = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    words = ["a" + c + "1." + c + "b" for c in chars if not c.isspace()]
    assert counter(words) == counter.merge(words)


# Characters beside which a cut could go wrong: all white space, marks without width, and neighbours of theirs in UTF-8.
BESIDE = [*range(1, 0x250), *range(0x1660, 0x16A0), *range(0x1800, 0x1812), *range(0x1EA0, 0x1EB0), *range(0x1FF0, 0x2080), *range(0x2FF0, 0x3020), 0x558, 0x88F, 0xFEFF, 0xFB01, 0x1F600]


def test_texts_are_cut_where_the_library_cuts():
    words, kind = tokens._encoder(PATH)
    words = tokens.Words(words.encode, {})
    forms = ["a{} b", "a {}b", "a\n{}b", "a{}\nb", "a {} b", " {}", "{} ", "'{}s", "{}'s", "1{}.", ".{}\t \n", "{}<|endoftext|> {}"]
    texts = [f.replace("{}", chr(c)) for c in BESIDE for f in forms]
    rng = random.Random(3)
    loose = [*PARTS, "'", "'ll", "don't", "l'été,", "\u00a0", "\u2003", "\u3000", "\u0085", "\u200b", "\x0b", "“", "—", "a", "B7"]
    texts += ["".join(rng.choice(loose) for _ in range(rng.randint(0, 12))) for _ in range(4000)]
    got = [np.frombuffer(b"".join(v), dtype=kind).tolist() for at in range(0, len(texts), 500) for v in words.values(texts[at : at + 500])]
    assert got == library(texts)


def test_marks_beside_words_are_no_new_words():
    """what goes to the library grows with the different pre-tokens, not with the marks that stand beside them."""
    asked = []

    class Asked(tokens.Pieces):
        def __call__(self, words):
            asked.extend(words)
            return super().__call__(words)

    some = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    texts = [" ".join(w + mark for w in some) for mark in ("", ",", ".", ";", ":", "!", "?", ")", "...")]
    words = tokens.Words(Asked(PATH, list, lambda parts: [i for p in parts for i in p]), {})
    assert [[i for v in values for i in v] for values in words.values(texts)] == library(texts)
    assert len(asked) < 2 * len(some)


def test_blocks_hold_every_text():
    texts = pa.array(["", "a" * 50, "b", "", "cc" * 4, "d", ""])
    blocks = list(tokens.text_blocks(texts, 10))
    assert [t for b in blocks for t in b.to_pylist()] == texts.to_pylist() and len(blocks) > 2
    assert list(tokens.text_blocks(texts.slice(0, 0), 10)) == []


def test_ids_with_ends():
    words, kind = tokens._encoder(PATH)
    for texts in ([], [""], ["", "the word", "", "été, x", ""]):
        ids, n = tokens.ended_ids(words, kind, pa.array(["x", *texts], pa.string()).slice(1), 2)
        want = [[*x, 2] for x in library(texts)]
        assert ids.tolist() == [i for x in want for i in x] and n.tolist() == [len(x) for x in want]
        assert tokens.counts(tokens.Words(tokens.PieceCounter(PATH, frozenset()), {}), pa.array(texts, pa.string())).tolist() == [len(x) - 1 for x in want]


def test_count_tokens_keeps_rows_and_columns(spark):
    rows = [(1, "the word", 5), (1, "the word", 5), (None, None, 1), (2, "", None), (3, "é" * 10, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_bytes int")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in tokens.count_tokens(docs, PATH).collect())
    want = sorted((i or 0, len((t or "").encode()), len(library([t or ""])[0])) for i, t, _ in rows)
    assert got == want
    assert tokens.count_tokens(docs.limit(0), PATH).count() == 0


def test_files_round_trip(spark, tmp_path):
    texts = ["the word", None, "", "x" * 9000, "a\nb  c", "the word"] * 40
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    index = tokens.write_sequences(docs, f"file://{tmp_path}/t", PATH, length=16)
    got = {r.doc_id: r for r in tokens.read_sequences(tokens.global_starts(index, block=1), f"file://{tmp_path}/t").collect()}
    start = 0
    for doc_id, text in sorted(rows):
        ids = [*library([text or ""])[0], 2]
        r = got[doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == len(rows)
    held = 0
    for name in (tmp_path / "t/files").iterdir():
        whole = pa.ipc.open_file(pa.memory_map(str(name))).read_all()
        assert whole.schema.field("tokens").type == pa.list_(pa.uint16(), 16)
        held += int(np.concatenate([[0], *[np.asarray(x) for x in whole["mask"].to_pylist()]]).sum())
    assert held == start


def test_empty_files(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    index = tokens.write_sequences(docs, f"{tmp_path}/t", PATH)
    assert tokens.read_sequences(tokens.global_starts(index), f"{tmp_path}/t").count() == 0


def test_queries(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    ids = library([t or "" for _, t in docs])
    got = {r.doc_id: r for r in QUERIES["op6_token_counts"](spark, sf_dir).collect()}
    assert [got[d].n_tokens for d, _ in docs] == [len(x) for x in ids]
    files = {r.doc_id: r for r in QUERIES["op5_token_files"](spark, sf_dir).collect()}
    assert [files[d].ids_crc32 for d, _ in docs] == [zlib.crc32(np.array([*x, 2], "<u4").tobytes()) for x in ids]
