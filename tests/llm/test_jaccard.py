"""Groups of near copies against brute force over all pairs."""

from __future__ import annotations

import random
import re

import pytest

from tideline.llm import jaccard


def brute(rows, words, percent):
    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())

    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        smallest[root(i)] = min(smallest.get(root(i), doc_id), doc_id)
    return sorted((doc_id, len(sets[i]), smallest[root(i)]) for i, (doc_id, _) in enumerate(rows))


def corpus(seed, n=160):
    """Copies, chains of edits, a passage that many unlike texts share, and texts of every short length."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") + rng.choice("xyz") + str(rng.randint(0, 60))
    text = lambda k: [word() for _ in range(k)]
    passage, out = text(40), []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.2 or len(out) < 5:
            out.append(text(rng.choice([1, 2, 3, 4, 5, 6, 9, 14, 30, 80, 200, 500])))
        elif kind < 0.35:
            at = rng.randint(0, 30)
            own = text(rng.choice([25, 45, 60]))
            out.append(own[:at] + passage + own[at:])
        else:
            copy = list(rng.choice(out))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, max(1, len(copy) // 60)])):
                at = rng.randrange(len(copy))
                copy[at : at + rng.choice([0, 1])] = [word()]
            out.append(copy)
    rows = [(1000 - 3 * i, " ".join(w).replace(" a", "\tA")) for i, w in enumerate(out)]
    return rows + [(2001, ""), (2002, None), (2003, "  \n"), (2004, " ")]


@pytest.mark.parametrize("words,percent,seed", [(4, 85, 1), (5, 80, 2), (4, 85, 3), (2, 60, 4)])
def test_as_brute_force(spark, words, percent, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, component int")
    got = sorted(tuple(r) for r in jaccard.jaccard_components(docs, words, percent).collect())
    want = brute(rows, words, percent)
    assert [g for g, w in zip(got, want, strict=True) if g != w] == []
    assert any(c != d for d, _, c in want)


def test_nulls_repeats_and_no_rows(spark):
    docs = spark.createDataFrame([(5, "a b c d e"), (5, "a b c d e"), (None, "a b c d e"), (None, None), (7, "A B C D E")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, 4, 85).collect())
    assert got == [(0, 0, None), (0, 2, None), (5, 2, 5), (5, 2, 5), (7, 2, 5)]
    assert jaccard.jaccard_components(docs.limit(0), 4, 85).count() == 0


def test_components_of_long_paths(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 120)] + [(500, 501), (501, 502)], "a long, b long")
    got = {r.node: r.component for r in jaccard.components(links).collect()}
    assert got == {**{i: 0 for i in range(121)}, 500: 500, 501: 500, 502: 500}


def test_rare_shingles_keep_all_links_and_rule_out_the_rest(spark):
    """Near copies of one text, most of them with more edits than a link allows: few are left, and every link is."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(140)]
    rows = []
    for i in range(400):
        copy = list(base)
        for _ in range(rng.choice([2, 3, 4, 4, 5, 5, 6])):
            copy[rng.randrange(len(copy))] += rng.choice("abcdefgh")
        rows.append((i, " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    nodes = spark.createDataFrame([(i, i) for i, _ in rows], "node long, component long")
    marks = {r.node: r for r in jaccard.rarest(nodes, docs, 4, 85).collect()}
    sets = [jaccard.shingle_set(t, 4) for _, t in rows]

    def candidates(a, b):
        if a not in marks or b not in marks:
            return False
        a, b = marks[a], marks[b]
        least = -(-85 * (a.size + b.size) // 185)
        heads = [set(m.rare[: max(m.common - least + 1, 0)]) for m in (a, b)]
        return min(a.common, b.common) >= least and bool(heads[0] & heads[1])

    pairs = [(i, j) for i in range(400) for j in range(i)]
    links = [p for p in pairs if jaccard.linked(sets[p[0]], sets[p[1]], 85)]
    assert links and all(candidates(*p) for p in links)
    assert sum(candidates(*p) for p in pairs) < len(pairs) // 8
    assert sorted(tuple(r) for r in jaccard.jaccard_components(docs, 4, 85).collect()) == brute(rows, 4, 85)


def test_signatures_shared_by_all_links():
    """What the join rests on: two sets at the threshold share as many signatures as their band asks for."""
    import numpy as np

    rng = np.random.default_rng(5)
    for _ in range(1500):
        size = int(rng.integers(1, 400))
        base = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        keep = np.ones(size, dtype=bool)
        keep[rng.permutation(size)[: rng.integers(0, size * 8 // 100 + 2)]] = False
        other = np.unique(np.concatenate([base[keep], rng.integers(0, 1 << 63, int(rng.integers(0, size * 8 // 100 + 2)), dtype=np.uint64)]))
        base = np.unique(base)
        if jaccard.linked(base, other, 85) and not np.array_equal(base, other):
            shared = np.intersect1d(jaccard.signatures(base, 85), jaccard.signatures(other, 85))
            least = jaccard.shared_by_band(85)
            counts = np.bincount((shared & np.uint64(jaccard.BAND_BITS - 1)).astype(int), minlength=len(least))
            assert (counts >= least)[counts > 0].any()


def test_sketches_rule_out_no_link():
    import numpy as np

    rng = np.random.default_rng(8)
    links = far = ruled_out = 0
    for k in range(3000):
        base = np.unique(rng.integers(0, 1 << 63, int(rng.integers(1, 900)), dtype=np.uint64))
        share = 0 if k % 3 == 0 else rng.random() * 0.3
        own = rng.integers(0, 1 << 63, int(rng.integers(1, 900) if k % 3 == 0 else len(base) * share), dtype=np.uint64)
        other = np.unique(np.concatenate([base[rng.random(len(base)) >= (1 if k % 3 == 0 else share)], own]))
        if not len(other):
            continue
        may = jaccard.may_link(len(base), jaccard.sketch(base), len(other), jaccard.sketch(other), 80)
        if jaccard.linked(base, other, 80):
            links += 1
            assert may
        elif k % 3 == 0:
            far += 1
            ruled_out += not may
    assert links > 300 and ruled_out > 0.95 * far
    assert not jaccard.may_link(0, b"", 5, jaccard.sketch(np.arange(5, dtype=np.uint64)), 80)


def test_texts_that_share_a_passage_only_do_not_move(spark, monkeypatch):
    """Pairs go on to the comparison of their texts only if their sizes and sketches leave a link open."""
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(90)]
    rows = [(i, " ".join([f"w{rng.randrange(10**9)}" for _ in range(100)] + passage)) for i in range(60)]
    rows += [(100 + i, t + " more") for i, t in rows[:3]]
    seen, old = [], jaccard.compare

    def compare(pairs, *rest):
        seen.extend((r.a, r.b) for r in pairs.collect())
        return old(pairs, *rest)

    monkeypatch.setattr(jaccard, "compare", compare)
    got = sorted(tuple(r) for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect())
    assert got == brute(rows, 5, 80)
    assert sorted(seen) == [(0, 100), (1, 101), (2, 102)]


def test_shuffles_of_a_kept_table_go_at_once(spark):
    """They would stay until the driver happens to collect its garbage."""
    import time

    def shuffles():
        names = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
        return {n for n in names if "/shuffle_" in n}

    before = shuffles()
    rows = jaccard.kept(spark, spark.range(1000).repartition(4, "id"), "test")
    until = time.time() + 10
    while shuffles() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffles() - before and rows.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None


def test_parts_hold_every_signature_once(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randint(1, 300)))) for i in range(50)]
    docs = spark.createDataFrame([*rows, (70, rows[9][1]), (None, rows[8][1]), (None, "only here " * 9), (71, None)], "doc_id long, text string")
    signed = jaccard.signed_sets(docs, 5, 80)
    parts = [[tuple(r) for r in jaccard.signature_rows(signed, k).collect()] for k in range(jaccard.PARTS)]
    want = sorted((i, int(s)) for i, t in rows for s in jaccard.signatures(jaccard.shingle_set(t, 5), 80).astype("<i8"))
    assert sorted(r for p in parts for r in p) == want
    assert all(len(p) < len(want) / 3 for p in parts)
