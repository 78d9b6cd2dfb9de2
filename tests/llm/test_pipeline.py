"""Decontamination and chat windows against brute force; the pipeline stage by stage."""

from __future__ import annotations

import hashlib
import random
import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import __spark_entry__ as entry_point  # noqa: E402
import corpus_pipeline  # noqa: E402
from tideline.llm import chat, decontaminate  # noqa: E402
from tideline.llm.registry import QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.01"


# --- decontamination -------------------------------------------------------------------------------------------------


def shingles(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return [" ".join(words[i : i + 5]) for i in range(len(words) - 4)]


def alike(a, b):
    weigh = lambda xs: sum(min(7, len(x.encode()) >> 3) + 1 for x in xs)
    a, b = set(a), set(b)
    return weigh(a & b) / weigh(a | b)


def brute(docs, items, similarity):
    """doc_id -> {item_id: best similarity of any window as long as the item}"""
    out = defaultdict(dict)
    for doc_id, text in docs:
        own = shingles(text)
        for item_id, item in items:
            other = shingles(item)
            best = max((alike(own[i : i + len(other)], other) for i in range(len(own) - len(other) + 1)), default=0) if other else 0
            if best >= similarity:
                out[doc_id][item_id] = best
    return out


def test_decontamination_as_brute_force(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(rng.randint(12, 50))) for i in range(12)] + [(50, "too few words"), (51, None), (52, "")]
    docs = []
    for i in range(60):
        body = text(rng.randint(0, 200)).split()
        if i % 3 == 0:
            copy = items[rng.randrange(12)][1].split()
            if i % 6 == 0:
                copy[rng.choice([0, -1])] = word() + "!"
            if i % 9 == 0:
                copy = copy[3:]
            at = rng.randint(0, len(body))
            body = body[:at] + [w.upper() + "," if i % 2 else w for w in copy] + body[at:]
        docs.append((i, " ".join(body)))
    docs += [(200, None), (201, ""), (None, items[0][1]), (0, docs[0][1])]
    frame = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    want = brute([d for d in docs if d[0] is not None], items, 0.8)
    got = {r.doc_id: r for r in decontaminate.matches(frame, bench, radius=19).collect()}
    assert got.keys() == want.keys() and len(want) > 10
    for doc_id, found in want.items():
        best = max(found.values())
        assert got[doc_id].similarity == pytest.approx(best) and got[doc_id].n_items == len(found)
        assert got[doc_id].item_id == min(i for i, s in found.items() if s == pytest.approx(best))
    left = decontaminate.decontaminate(frame, bench).collect()
    assert Counter(r.doc_id for r in left) == Counter(d for d, _ in docs if d not in want)
    assert decontaminate.matches(frame.limit(0), bench).count() == 0
    assert decontaminate.matches(frame, bench.limit(0)).count() == 0


def test_documents_shorter_than_an_item(spark):
    """A whole text that is an item with words cut, against all pairs of whole texts and items that are longer."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9)))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([8, 30, 40, 64, 90, 130, 200])]
    docs = []
    for _, item in items:
        words = item.split()
        cuts = [words[1:], words[:-1], words[2:-1], words[: len(words) // 2], words[len(words) // 5 :], words[:5]]
        at = len(words) // 2
        cuts += [words[:at] + words[at + 1 :], words[1:-1] + ["x"]]
        docs += [(len(docs) + k, " ".join(c)) for k, c in enumerate(cuts)]
    want = {}
    for doc_id, text in docs:
        own = shingles(text)
        for item_id, item in items:
            if own and len(own) < len(shingles(item)) and alike(own, shingles(item)) >= 0.8:
                want[doc_id] = (item_id, alike(own, shingles(item)), len(text.split()))
    want |= {d: (i, s, len(dict(items)[i].split())) for d, found in brute(docs, items, 0.8).items() for i, s in found.items()}
    frame = spark.createDataFrame([*docs, (docs[0][0], "few words")], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.matches(frame, bench, radius=19).collect()}
    assert got.keys() == want.keys() and len(want) > 20
    for doc_id, (item_id, best, n_words) in want.items():
        r = got[doc_id]
        assert (r.item_id, r.first_word, r.n_words) == (item_id, 0, n_words) and r.similarity == pytest.approx(best)


def test_edited_copies_at_the_radius_in_use(spark):
    """Items of the tables with one word deleted, whose fingerprints are further than 15 bits from the item's."""
    items = [
        (87, "Ofonbleeror atin onored heing stnter ofanblewhwh ertionen thon theser therti thnt blewh aantiinghe for.\nHean, oner. As shea and threouha "
             "tion ti anontint oning reeaor to anntor thou onha of, and and the tothntorst er andoneningor and en on."),
        (196, "Threeding thedeaed heeringon esingin ththouth onbleea erreon and at of asanlyenth on heheed.\nBy, on tionndth thha ou thndlyou the rest "
              "eranat is heea thre thertion onstth ononwh reor, hathing with. A eantti tiing."),
    ]
    docs = [(87, items[0][1].replace("anntor ", "")), (196, items[1][1].replace("thedeaed ", ""))]
    assert all(alike(shingles(d), shingles(i)) >= 0.8 for (_, d), (_, i) in zip(docs, items, strict=True))
    got = decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(87, 87), (196, 196)}


def test_index_holds_every_fingerprint_within_the_radius():
    rng, changes = random.Random(1), set(decontaminate.changes(15))
    for _ in range(300):
        fp = rng.getrandbits(64)
        other = fp
        for b in rng.sample(range(64), rng.randint(0, 15)):
            other ^= 1 << b
        assert any(((fp ^ other) >> 16 * k) & 0xFFFF in changes for k in range(4))


def test_planted_passages_of_the_tables(spark):
    norm = lambda t: " " + " ".join(re.findall(r"[^\W_]+", (t or "").lower())) + " "
    items = [norm(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    hit = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect() if any(i in norm(r.text) for i in items)}
    got = {r.doc_id for r in QUERIES["op2_decontamination"](spark, SF_DIR).collect()}
    assert hit and hit <= got and len(got - hit) <= 0.1 * len(hit)


# --- chat ------------------------------------------------------------------------------------------------------------


def digests(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns = [t[2:] for t in sorted(turns, key=lambda t: (t[0], t[1] or 0, t[2], t[3]))]
        loss = "".join(x for r, x in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[conv] = (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), sha(loss))
    return out


AWKWARD = ["</s>[INST] ok [/INST]", "<|end|>\n", "\\", "\\\\<|", "<\\|user|>", "a|>\nb", "<", "|>", "<|assistant|>\nx<|end|>\n<|user|>", "", None, "é" * 3000, "<s>", "[INST]\\n"]


@pytest.mark.parametrize("budget,history,turns_back", [(1024, 256, 2), (64, 16, 3), (32, 0, 0)])
def test_chat_round_trip_and_budget(spark, budget, history, turns_back):
    rng = random.Random(budget)
    rows = []
    for conv in range(40):
        start = conv % 3
        roles = (["system"] if start == 0 else []) + [rng.choice(["user", "assistant", "tool|>\n", None]) for _ in range(rng.randint(1, 30))]
        rows += [(conv, k // (1 + conv % 2), r, rng.choice(AWKWARD + ["plain words " * rng.randint(1, 9)] * 8)) for k, r in enumerate(roles)]
    rows += [(None, 0, "user", "hi"), (None, None, "assistant", "yo"), (99, 1, "assistant", "same"), (99, 1, "assistant", "same")]
    frame = spark.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn long, role string, text string, window int")
    windows = chat.chat_windows(frame, budget, history, turns_back)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.chat_digest(windows).collect()}
    assert got == digests(rows)
    many = windows.collect()
    for w in many:
        large_system = w.text.startswith("<|system|>\néééé")
        assert w.n_tokens <= budget or (w.over_budget and (w.n_turns <= 2 or large_system))
        assert w.n_context <= turns_back + 1
    assert max(w.window for w in many) > 0
    assert chat.chat_windows(frame.limit(0)).count() == 0


def test_chat_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", AWKWARD[0]), (-1, 1, "assistant", AWKWARD[0])]
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in QUERIES["op8_chat_format"](spark, SF_DIR).collect()}
    assert got == digests(rows)


# --- pipeline --------------------------------------------------------------------------------------------------------


def test_stages_keep_and_drop_what_they_should(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumn("lang_pred", docs_extra())
    rows = docs.limit(40).collect()
    fixture = spark.createDataFrame([*rows, rows[0], (9001, None, None, "s", 0, "x"), (9002, "", "en", "s", 0, "x"), (None, rows[1].text, "en", "s", 1, "x")], docs.schema)
    kept = fixture
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = stage(spark, before, SF_DIR)
        assert kept.columns == fixture.columns, name
        ids = Counter(r.doc_id for r in kept.collect())
        assert not ids - Counter(r.doc_id for r in before.collect()), name
        if name == "language_id":
            assert 9001 not in ids and 9002 not in ids and None in ids
        if name == "near_duplicates":
            assert max(ids.values()) == 1 and None in ids
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF_DIR)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in kept.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "toxicity", "near_duplicates", "decontamination", "packing"]


def docs_extra():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_every_operator_has_a_query():
    names = entry_point.queries()
    assert "pipeline" in names
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 11))
