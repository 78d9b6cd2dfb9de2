"""Vantage-point search against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from tideline.llm import neighbours
from tideline.llm.registry import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def brute(rows, queries, k):
    out = {}
    for q, v in queries:
        away = sorted((math.dist(v, w), i) for i, w in rows if i != q)
        out[q] = away[:k]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
    return out


@pytest.mark.parametrize("shard_rows", [150, 10_000])
def test_factor_one_is_exact(spark, shard_rows):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.integers(0, 5, 6)]) for i in range(500)] + [(500 + i, [1.0] * 6) for i in range(200)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(neighbours.nearest(vectors, vectors.filter("vec_id % 10 = 0"), k=7, factor=1.0, shard_rows=shard_rows))
    want = brute(rows, [r for r in rows if r[0] % 10 == 0], 7)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]]
        assert np.allclose([d for d, _ in got[q]], [d for d, _ in want[q]], rtol=0, atol=1e-12)


def test_recall_of_the_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    got = found(QUERIES["op7_vantage_neighbours"](spark, SF_DIR))
    want = brute(rows, [r for r in rows if r[0] % 100 == 0], 10)
    assert got.keys() == want.keys()
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.95 * 10 * len(want)
    away = {q: {i: d for d, i in v} for q, v in brute(rows, [r for r in rows if r[0] % 100 == 0], len(rows)).items()}
    assert all(abs(d - away[q][i]) < 1e-12 for q in got for d, i in got[q])


def test_unusable_vectors_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [1.0, 1.0]),
            (7, [1.0, 1.0]), (8, []), (9, [1.0]), (None, [1.0, 0.0])]
    vectors = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    got = found(neighbours.nearest(vectors, vectors, k=10))
    assert {q: [i for _, i in v] for q, v in got.items()} == {0: [6, 7], 6: [7, 0], 7: [6, 0]}
    assert neighbours.nearest(vectors.limit(0), vectors).count() == 0
    assert neighbours.nearest(vectors, vectors.limit(0)).count() == 0
