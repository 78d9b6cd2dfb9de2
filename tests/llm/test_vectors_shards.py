"""Whitening, hard negatives and sharding against brute force."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from oracle import connect
from oracle import rows as as_rows

from tideline.llm import negatives, sharding, whitening
from tideline.llm.registry import ORACLE_SQL, QUERIES
from tideline.session import scratch

SF_DIR = "/root/testdata/sf0.01"


# --- 11 ---------------------------------------------------------------------------------------------


def integers(vector):
    return tuple(int(np.floor(64.0 * float(c))) + 1_000_000 for c in vector)


def check_whitening(got, rows):
    """Holds results against whole-number sums of every pair, and against the identity."""
    usable = [(i, integers(v)) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({x for _, x in usable})
    n, dims = len(fit), len(fit[0])
    sums = [sum(x[d] for x in fit) for d in range(dims)]
    k = min(16, dims)
    assert Counter((r.vec_id, r.component) for r in got) == Counter((i, c) for i, _ in usable for c in range(1, k + 1))
    assert {r.n for r in got} == {n}
    want = Counter((i, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in usable for _ in range(k))
    assert Counter((r.vec_id, int(r.deviation)) for r in got) == want
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(x, sums)] for _, x in usable])
    exact = np.array([[float(Fraction(sum((n * x[a] - sums[a]) * (n * x[b] - sums[b]) for x in fit), n**3)) for b in range(dims)] for a in range(dims)])
    values, vectors = np.linalg.eigh(exact)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    by_row = defaultdict(dict)
    for r in got:
        by_row[r.vec_id][r.component] = r
    for c in range(k):
        w = centred @ vectors[:, c] / np.sqrt(values[c])
        found = np.array([by_row[i][c + 1].whitened for i, _ in usable])
        assert min(np.abs(found - w).max(), np.abs(found + w).max()) < 1e-6
        assert [by_row[i][c + 1].explained for i, _ in usable] == pytest.approx([values[c] / exact.trace()] * len(usable), rel=1e-9)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-6


def test_whitening_of_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    check_whitening(QUERIES["op11_bit_sliced_whitening"](spark, SF_DIR).collect(), rows)


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(0, 30, (300, 5)) * [1, 1, 0.1, 1000, 1])]
    rows += [(300 + i, rows[7][1]) for i in range(50)] + [(350, None), (351, []), (352, [1.0, None, 1.0, 1.0, 1.0])]
    rows += [(353, [float("nan")] * 5), (354, [float("inf")] + [0.0] * 4), (355, [-5e3, 3e4, 0.0, 0.0, 1e-300])]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, component string, x int")
    check_whitening(whitening.whiten(frame.repartition(7)).collect(), rows)


def test_whitening_without_variance(spark):
    frame = spark.createDataFrame([(None, [0.5, 1.0]), (1, [0.5, 1.0]), (2, [1.5, 1.0]), (3, [4.0, 4.0, 4.0])], "vec_id long, embedding array<float>")
    got = {(r.vec_id, r.component): r for r in whitening.whiten(frame).collect()}
    assert len(got) == 9 and got[(1, 1)].n == 2 and got[(3, 1)].n == 1
    assert {abs(got[(i, 1)].whitened) for i in (None, 1, 2)} == {1.0} and got[(1, 2)].whitened == got[(3, 3)].whitened == 0.0
    assert got[(1, 1)].explained == 1.0 and got[(3, 1)].explained == 0.0 and got[(3, 1)].identity_error < 1e-12
    assert whitening.whiten(frame.limit(0)).count() == 0
    wide = spark.createDataFrame([(1, [1e300]), (2, [-1e300])], "vec_id long, embedding array<double>")
    assert {r.deviation for r in whitening.whiten(wide).collect()} == {(2 * whitening.LIMIT) ** 2}


@pytest.mark.parametrize("span", [1, 2, 1000, 1 << 45])
def test_bit_planes_give_exact_sums(span):
    x = np.random.default_rng(5).integers(-span, span, (130, 6))
    sums, products = whitening.block_sums(x)
    want = x.astype(object)
    assert (sums == want.sum(axis=0)).all() and (products == want.T @ want).all()


# --- 12 ---------------------------------------------------------------------------------------------


def brute_negatives(rows, anchors, k=5):
    usable = [(i, l, [int(np.floor(256.0 * c)) for c in v]) for i, l, v in rows if i is not None and l is not None and v and all(c is not None and np.isfinite(c) for c in v)]
    out = Counter()
    for i, label, q in {(i, l, tuple(q)) for i, l, q in usable if i in anchors}:
        scored = [(-sum(a * b for a, b in zip(q, w)), j, m) for j, m, w in usable if j != i and len(w) == len(q)]
        positives = sorted((s, j) for s, j, m in scored if m == label)[:k]
        for p, j in positives:
            fitting = sorted((s, h) for s, h, m in scored if m != label and 80 * -p <= 100 * -s <= 100 * -p)[:k]
            out.update((i, j, rank, h, -p, -s) for rank, (s, h) in enumerate(fitting, 1))
    return out


def mined(df):
    return Counter((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def test_negatives_of_the_table(spark):
    name = "op12_packed_negatives"
    df = QUERIES[name](spark, SF_DIR)
    result = connect(SF_DIR).execute(ORACLE_SQL[name])
    want = as_rows([d[0] for d in result.description], result.fetchall())
    assert sum(want.values()) > 50 and as_rows(df.columns, df.collect()) == want


@pytest.mark.parametrize("shard_rows", [40, 10_000])
def test_negatives_of_odd_rows(spark, shard_rows):
    rng = np.random.default_rng(2)
    rows = [(i, int(rng.integers(0, 4)), [float(c) / 4 for c in rng.integers(-3, 8, 3)]) for i in range(300)]  # many ties
    rows += [(300 + i, 1, [0.5, 0.5, 0.5]) for i in range(40)] + [rows[10], rows[11], (13, 2, [9.0, -9.0, 0.0])]
    rows += [(400, None, [1.0] * 3), (401, 1, None), (402, 1, [1.0, None, 1.0]), (403, 2, [float("nan")] * 3), (404, 1, []), (405, 2, [1.0, 2.0]), (406, 1, [2.0, 2.0]),
             (407, 1, [0.1, 0.1]), (408, 0, [-1000.0, 60_000.0, 3.0]), (None, 1, [1.0] * 3)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<double>, score string").repartition(3)
    asked = {*range(0, 300, 10), 11, 13, 400, 401, 402, 404, 405, 406, 408}
    got = mined(negatives.mine(frame, frame.filter(frame.vec_id.isin(*asked)), shard_rows=shard_rows))
    assert got == brute_negatives(rows, asked) and len(got) > 200
    assert not mined(negatives.mine(frame.limit(0), frame)) and not mined(negatives.mine(frame, frame.limit(0)))


@pytest.mark.parametrize("span", [3, 300, 1 << 16, 1 << 24])
def test_packed_products_are_exact(span):
    rng = np.random.default_rng(1)
    vectors, anchor = rng.integers(-span, span + 1, (37, 70)), rng.integers(-span, span + 1, 70)
    pack = negatives.Pack.of(np.arange(37), np.zeros(37, int), vectors, span)
    assert (pack.scores(anchor) == vectors @ anchor).all()


# --- 13 ---------------------------------------------------------------------------------------------


def jump(key: int, shards: int) -> int:
    stop, ahead, state = -1, 0, key % 2**64
    while ahead < shards:
        stop, state = ahead, (state * 2862933555777941757 + 1) % 2**64
        ahead = int((stop + 1) * (float(1 << 31) / float((state >> 33) + 1)))
    return stop


def test_jump_hash():
    keys = np.concatenate([np.arange(-50, 3000), np.random.default_rng(0).integers(-(2**63), 2**63 - 1, 3000)])
    for shards in (1, 2, 16, 17, 1000):
        assert sharding.jump_hash(keys, shards).tolist() == [jump(int(k), shards) for k in keys]
    assert sharding.jump_hash(np.empty(0, np.int64), 16).tolist() == []
    before, after = sharding.jump_hash(keys, 16), sharding.jump_hash(keys, 17)
    assert set(after[before != after]) == {16} and abs((before != after).mean() - 1 / 17) < 0.02


def test_shards_of_the_table(spark):
    got = QUERIES["op13_jump_shards"](spark, SF_DIR).collect()
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    size = lambda t: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((d.doc_id, *size(d.text)) for d in docs)
    check_shards(got)


def check_shards(got):
    slots = defaultdict(list)
    for r in got:
        assert r.law == "key" and 0 <= r.shard < 16 and r.grown_shard in (r.shard, 16)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len({r.shard for r in got if r.doc_id == i}) == 1 for i in {r.doc_id for r in got})


def test_shards_keep_rows_whole(spark):
    rows = [(i, "x" * (i % 50), i) for i in range(500)] + [(None, None, 1)] * 30 + [(7, "same", 2)] * 400 + [(8, "", None), (9, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int").withColumnRenamed("shard", "slot")
    for frame in (docs, docs.limit(0), docs.selectExpr("doc_id", "text", "slot as shard", "1 as document", "2 as file", "3 as part")):
        folder = scratch(spark, "test-shards")
        sharding.write_shards(frame, folder)
        back = sharding.read_shards(spark, folder, frame)
        assert Counter(r.document for r in back.collect()) == Counter(frame.collect())
        numbered = defaultdict(list)
        for r in back.collect():
            numbered[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in numbered.values())
    by_key = docs.select("doc_id", sharding.shard_of(docs.doc_id.cast("string"), 5).alias("s")).distinct()
    assert by_key.count() == docs.select("doc_id").distinct().count()
