"""Operators against brute force and on the awkward cases: nulls, ties, busy keys, empty inputs."""

from __future__ import annotations

import random
import re
from collections import Counter
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tideline.functions import search
from tideline.functions import time as tm
from tideline.operators import cdc, facts, joins, logs, metrics, moderation, routing, scoring
from tideline.operators.dedup import distinct_rows, first_per_key, latest_per_key, retract_versions
from tideline.operators.dims import Step, enrich_chain, flat_dictionary, fold, row_count, scan
from tideline.operators.reshape import pivot, unpivot
from tideline.operators.scoring import DEFAULT_BRAND, brand_weight_lookup, weight_lookup
from tideline.operators.visitors import login_days, repair_visitor_flag
from tideline.session import scratch, scratch_root
from tideline.sinks.writers import (
    OPEN_FOLDERS, batch_writer, compact, day_writer, destination_writer, exists, land_by_table, read_snapshot, upsert_batch, write_by_day,
    write_by_destination, write_csv,
)

BASE = datetime(2024, 1, 1)


def bag(df, columns=None):
    return Counter(map(tuple, df.select(*(columns or df.columns)).collect()))


def test_retract_nulls_negatives_and_ties(spark):
    rows = [("a", 1, 5.0), ("a", 2, None), ("a", 3, -2.0), ("b", 1, 7.0), (None, 1, 1.0), (None, 2, 2.0)]
    df = spark.createDataFrame(rows, "id string, v int, amount double")
    out = retract_versions(df, "id", ["v"], ["amount"], "sign")
    assert bag(out) == Counter(
        [("a", 1, 5.0, 1), ("a", 1, -5.0, -1), ("a", 2, None, 1), ("a", 2, None, -1), ("a", 3, -2.0, 1), ("b", 1, 7.0, 1),
         (None, 1, 1.0, 1), (None, 1, -1.0, -1), (None, 2, 2.0, 1)]
    )
    net = out.groupBy("id").agg(F.sum("amount").alias("net")).collect()
    assert {r.id: r.net for r in net} == {"a": -2.0, "b": 7.0, None: 2.0}


def test_latest_and_first(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", None, "z"), ("b", None, "w")], "id string, v int, t string")
    assert bag(latest_per_key(df, ["id"], ["v"])) == Counter([("a", 3, "y"), ("b", None, "w")])
    assert bag(first_per_key(df.dropna(), ["id"], ["v"])) == Counter([("a", 1, "x")])
    assert distinct_rows(df.union(df)).count() == 4
    plan = latest_per_key(df, ["id"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan.split("Exchange")[-1]  # limited before the shuffle


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("weighted", [True, False])
@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_skew_join(spark, how, weighted, broadcast):
    rng = random.Random(3)
    rows = [(rng.choice([0, 0, 0, 0, rng.randrange(900), None]), i) for i in range(3000)]
    left = spark.createDataFrame(rows, "k int, n int")
    keys = Counter(k for k, _ in rows)
    side = [(k, f"v{k}", c) for k, c in keys.items() if k is not None and k % 3 != 1]
    right = spark.createDataFrame(side, "k int, v string, w int")
    expected = left.join(right.select("k", "v"), "k", how).select("k", "n", "v")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
        out = joins.skew_join(left, right if weighted else right.drop("w"), ["k"], how, "w" if weighted else None)
        assert bag(out) == bag(expected)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("lower, upper", [(-60, 60), (-1800, 5), (0, 0), (10, 90), (-90, -10)])
def test_interval_join_brute_force(spark, how, lower, upper):
    rng = random.Random(lower * 7 + upper)
    side = lambda n: [(i, f"k{rng.choice([0, 0, 1, 2])}", BASE + timedelta(seconds=rng.randrange(4000))) for i in range(n)]
    left, right = side(120), side(90)
    edge = (900, "k0", left[0][2] + timedelta(seconds=upper))
    right += [edge, (901, left[0][1], left[0][2] + timedelta(seconds=lower)), (902, left[0][1], left[0][2] + timedelta(seconds=upper, microseconds=1))]
    expected = Counter()
    for i, k, t in left:
        hits = [j for j, rk, rt in right if rk == k and t + timedelta(seconds=lower) <= rt <= t + timedelta(seconds=upper)]
        expected.update((i, j) for j in (hits or ([None] if how == "left" else [])))
    frame = lambda rows: spark.createDataFrame(rows, "id int, key string, ts timestamp")
    out = joins.interval_join(
        frame(left), frame(right), "key", "ts", "ts", timedelta(seconds=lower), timedelta(seconds=upper), ["id"], "r_", how=how
    )
    assert bag(out, ["id", "r_id"]) == expected


def test_small_side_is_checked(spark):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    big, small = spark.range(50), spark.range(5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hinted = spark.range(9).join(joins.small_side(small, 10), "id")
        plain = spark.range(9).join(joins.small_side(big, 10), "id")
        assert "broadcast" in plan(hinted).lower() and "broadcast" not in plan(plain).lower()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_running_sets_with_equal_times_and_slots(spark):
    rng = random.Random(1)
    rows = [(f"u{i % 3}", i, BASE + timedelta(minutes=rng.randrange(200)), rng.choice(["a", "b", "c", None])) for i in range(150)]
    df = spark.createDataFrame(rows, "uid string, n int, ts timestamp, f string")
    out = {(r.uid, r.n): (r.pv, r.f) for r in metrics.user_running_sets(df, "uid", "ts", ["n"], ["f"]).collect()}
    for uid in ("u0", "u1", "u2"):
        seen, count = set(), 0
        for r in sorted((r for r in rows if r[0] == uid), key=lambda r: (r[2], r[1])):
            count += 1
            seen |= {r[3]} - {None}
            assert out[(uid, r[1])] == (count, ",".join(sorted(seen)))


def test_login_days_around_the_return_limit(spark):
    days = lambda *gaps: [BASE + timedelta(days=d, hours=23) for d in gaps]
    rows = [("a", t) for t in days(0, 7)] + [("b", t) for t in days(0, 8)] + [("c", t) for t in days(0, 9, 9)] + [(None, BASE)]
    out = login_days(spark.createDataFrame(rows, "uid string, ts timestamp"), "uid", "ts")
    assert {(r.uid, r.visit_date.day): r.back_ct for r in out.collect()} == {
        ("a", 1): 0, ("a", 8): 0, ("b", 1): 0, ("b", 9): 1, ("c", 1): 0, ("c", 10): 1
    }


def test_visitor_flag_cases(spark):
    day = lambda d: BASE + timedelta(days=d)
    rows = [("new", day(0), "1"), ("new", day(0), "1"), ("new", day(2), "1"), ("old", day(0), "0"), ("old", day(0), "1"), (None, day(0), "1")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "mid string, ts timestamp, is_new string, n int")
    out = {r.n: r.is_new for r in repair_visitor_flag(df, "mid", "ts", "is_new", ["n"]).collect()}
    assert out == {0: "1", 1: "1", 2: "0", 3: "0", 4: "0", 5: "1"}


def test_messages(spark):
    texts = ['{"after":{"id":1},"op":"r","ts_ms":5}', "{bad", None, '{"after":null,"before":{"id":"2"},"op":"d"}', '{"after":{},"op":"u","before":{"id":"3"}}']
    parsed = cdc.parse_cdc(spark.createDataFrame([(t,) for t in texts], "value string"))
    good, bad = cdc.split_dirty(parsed)
    assert [r.value for r in bad.collect()] == ["{bad"]
    assert bag(cdc.flatten_image(good, ["id"]), ["op", "id"]) == Counter([("r", "1"), ("d", "2"), ("u", "3")])
    assert cdc.valid_changes(parsed).count() == 2
    plan = cdc.valid_changes(parsed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1  # parsed once


def test_cart_rows(spark):
    def text(op, after, before):
        return f'{{"op":"{op}","source":{{"table":"cart_info"}},"after":{{"id":"1","sku_num":"{after}"}},"before":{before},"ts_ms":1}}'

    before = lambda n: f'{{"sku_num":"{n}"}}'
    rows = [text("r", 4, "null"), text("u", 5, before(2)), text("update", 7, before(1)), text("u", 2, before(2)), text("u", 1, before(3)),
            text("u", 3, "{}"), text("d", 9, before(1)), text("u", "x", before(1))]
    out = cdc.cart_additions(cdc.parse_cdc(spark.createDataFrame([(r,) for r in rows], "value string")))
    assert sorted(r.sku_num for r in out.collect()) == [3, 4, 6]


def test_log_tags(spark):
    text = '{"common":{"mid":"1"},"page":{"page_id":"restart"},"displays":[1],"err":null}'
    df = spark.createDataFrame([(text,)], "value string")
    tags = lambda mode: df.select(logs.log_tags(mode=mode)).first()[0]
    assert tags("key") == ["page", "displays"]
    assert tags("substring") == ["start", "page", "displays", "err"]


def test_rules_change_and_leave(spark):
    def rule(ts, op, columns="id"):
        row = {"source_table": "t", "source_type": "insert", "sink_table": "s", "sink_columns": columns}
        body = "{" + ",".join(f'"{k}":"{v}"' for k, v in row.items()) + "}"
        image = f'"before":{body},"after":null' if op == "d" else f'"after":{body}'
        return f'{{{image},"op":"{op}","ts_ms":{ts}}}'

    def rules(*changes):
        parsed = cdc.parse_cdc(spark.createDataFrame([(c,) for c in changes], "value string"))
        return routing.latest_rules(parsed, ["source_table", "source_type"], ["source_table", "source_type", "sink_table", "sink_columns"])

    change = cdc.parse_cdc(spark.createDataFrame([('{"after":{"id":"1","x":"2"},"source":{"table":"t"},"op":"c","ts_ms":1}',)], "value string"))
    matched, rest = routing.route(change, rules(rule(1, "c"), rule(2, "u", "id, x")), by_op=True)
    assert matched.first().data == {"id": "1", "x": "2"} and rest.count() == 0
    matched, rest = routing.route(change, rules(rule(1, "c"), rule(2, "d")), by_op=True)
    assert matched.count() == 0 and rest.count() == 1


def test_last_token(spark):
    texts = ["a,b", "a,b,,", ",", "", "a", "a, b", "x,\n", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(moderation.last_token("t")).collect()] == ["b", "b", "", "", "a", " b", "\n", None]


def test_moderation(spark):
    rng = random.Random(5)
    letters = lambda n: "".join(rng.choice("abc ") for _ in range(n))
    rows = [(i // 2 if i % 9 else None, letters(rng.randrange(40))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "ok,abc"), (103, "x,abc,"), (104, "bb bb"), (104, "bb bb")]
    comments = spark.createDataFrame(rows, "id int, t string")
    for listed in (["abc", "aa", "bcb", "c a", "abc", "cab"], ["a", "bb", "abcab", "b", "abcabcabcabc"], []):
        words = spark.createDataFrame([(w,) for w in listed], "word string")
        checked = moderation.moderate(comments, words, words, "t").collect()
        assert len(checked) == len(rows)
        for r in checked:
            text = r.t or ""
            token = text.rstrip(",").rsplit(",", 1)[-1]
            found = sorted({w for w in listed if w in text}, key=lambda w: (text.find(w), w))
            if token in listed:
                assert (r.is_violation, r.violation_grade, r.violation_msg) == (1, "P0", token)
            else:
                assert (r.is_violation, r.violation_grade, r.violation_msg) == (0, "P1" if found else "", ", ".join(found))


def test_contained_words_of_rows_without_ids(spark):
    docs = spark.createDataFrame([(1, "alpha beta"), (1, "gamma"), (None, "beta")], "id int, t string")
    words = spark.createDataFrame([("alpha",), ("beta",), ("gamma",)], "word string")
    found = moderation.contained_words(docs, words, "t", "found").collect()
    assert sorted((r.t, r.found) for r in found) == [("alpha beta", ["alpha", "beta"]), ("beta", ["beta"]), ("gamma", ["gamma"])]


def test_contained_words_over_chunk_ends(spark):
    """Words that cross the ends of chunks, words longer than a chunk, characters of four bytes, and a very long text."""
    rng = random.Random(3)
    texts = ["".join(rng.choice("ab😀é\n") for _ in range(n)) for n in (1, 127, 128, 129, 255, 256, 257, 700)]
    texts += ["x" * 200_000 + "needle" + "y" * 9, "ab" * 300 + "é"]
    listed = ["a", "😀", "é\na", "ab😀", "abab", "aé😀b", "needle", "y", "x" * 130, "ab" * 150 + "é", "\n\n"] + [t[120:132] for t in texts[3:8]]
    words = spark.createDataFrame([(w,) for w in listed], "word string")
    docs = spark.createDataFrame([(t,) for t in texts], "t string")
    found = {r.t: r.found for r in moderation.contained_words(docs, words, "t", "found").collect()}
    assert found == {t: sorted({w for w in listed if w and w in t}, key=lambda w: (t.find(w), w)) for t in texts}


def test_contained_words_move_no_text(spark):
    """A list that is small enough is looked up where the texts are, one that isn't by joins, with the same result."""
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab😀é\n ") for _ in range(rng.randrange(300))) for _ in range(40)] + ["", None]
    listed = ["".join(rng.choice("ab😀é\n ") for _ in range(n % 9)) for n in range(60)] + [None]
    words = spark.createDataFrame([(w,) for w in listed], "word string")
    docs = spark.createDataFrame([(t,) for t in texts * 2], "t string")
    sent = moderation.contained_words(docs, words, "t", "found")
    assert not re.search("Exchange|Join|Generate", sent._jdf.queryExecution().executedPlan().toString())
    want = [(t, sorted({w for w in listed if w and t and w in t}, key=lambda w: (t.find(w), w))) for t in texts * 2]
    by_text = lambda rows: sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1]))
    assert by_text((r.t, r.found) for r in sent.collect()) == by_text(want)
    assert by_text((r.t, r.found) for r in moderation.contained_words(docs, words, "t", "found", max_words=5).collect()) == by_text(want)


def test_word_search_over_segments(monkeypatch):
    rng = random.Random(2)
    for size in (7, 64):
        monkeypatch.setattr(search, "SEGMENT", size)
        for _ in range(40):
            letters = rng.choice(["ab", "abc é", "a😀é\n"])
            draw = lambda most: "".join(rng.choice(letters) for _ in range(rng.randrange(most)))
            texts = ["", *[draw(60) if rng.random() > 0.1 else None for _ in range(rng.randrange(30))]]
            listed = [draw(9) for _ in range(rng.randrange(20))]
            found = search.WordSearch(listed).of_texts(pa.array(["skipped", *texts], pa.string()).slice(1)).to_pylist()
            assert found == [sorted({w for w in listed if w and t and w in t}, key=lambda w: (t.find(w), w)) for t in texts]


def test_dimension_chain(spark):
    """A chain equals its look-ups one by one, misses included; a birthday by a second key of the rows."""
    rows = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (None, 10), (9, None)], "sku int, user int")
    sku = spark.createDataFrame([(1, "s1", 5, 7), (2, "s2", 6, 8), (3, "s3", None, 9)], "id int, name string, tm int, c3 int")
    tm = spark.createDataFrame([(5, "t5")], "id int, name string")
    c3 = spark.createDataFrame([(7, "c7", 70), (8, "c8", 80)], "id int, name string, parent int")
    c2 = spark.createDataFrame([(70, "c70")], "id int, name string")
    user = spark.createDataFrame([(10, "1999-01-01")], "id int, birthday string")
    steps = [
        Step("sku", sku, "id", {"name": "sku_name", "tm": "tm_id", "c3": "c3_id"}), Step("tm_id", tm, "id", {"name": "tm_name"}),
        Step("c3_id", c3, "id", {"name": "c3_name", "parent": "c2_id"}), Step("c2_id", c2, "id", {"name": "c2_name"}),
        Step("user", user, "id", {"birthday": "birthday"}),
    ]
    out = enrich_chain(rows, steps)
    assert out.columns == ["sku", "user", "sku_name", "tm_id", "c3_id", "tm_name", "c3_name", "c2_id", "c2_name", "birthday"]
    assert bag(out.select("sku", "user", "sku_name", "tm_name", "c3_name", "c2_name", "birthday")) == Counter([
        (1, 10, "s1", "t5", "c7", "c70", "1999-01-01"), (2, 20, "s2", None, "c8", None, None), (3, 30, "s3", None, None, None, None),
        (None, 10, None, None, None, None, "1999-01-01"), (9, None, None, None, None, None, None)])
    assert bag(enrich_chain(rows, steps[:2], "inner").select("sku", "tm_name")) == Counter([(1, "t5"), (2, None), (3, None)])
    assert [len(fold(steps, rows.columns)), len(fold(steps[:4], rows.columns))] == [2, 1]
    with pytest.raises(ValueError):
        enrich_chain(rows, steps[1:2])


def test_weight_maps_are_merged_by_band(spark):
    """F14 over maps: spellings of bands (Q16), missing maps, bands and weights, and shares."""
    df = spark.createDataFrame(
        [(1, {"18_24": 0.5, "50以上": 0.25}, {"18-24": 0.1, "25-29": 0.3}), (2, None, {"30-34": None, "40-49": 0.5}), (3, None, None)],
        "id int, a map<string,double>, b map<string,double>",
    )
    merged = scoring.merged_bands({"time": "a", "device": "b"}, scoring.SHARES)
    rows = {r.id: r for r in df.select("id", scoring.band_totals(merged).cast("array<double>").alias("t"), scoring.inferred_band(scoring.band_totals(merged)).alias("band")).collect()}
    assert rows[1].t == [0.175, 0.3, 0, 0, 0, 0.0375] and rows[2].t == [0, 0, 0, 0, 0.5, 0] and rows[3].t == [0] * 6
    assert [rows[i].band for i in (1, 2, 3)] == ["25-29", "40-49", "18-24"]
    plain = scoring.band_totals(scoring.merged_bands({"x": "a", "y": "b"})).cast("array<double>")
    assert df.filter("id = 1").select(plain).first()[0] == [0.6, 0.3, 0, 0, 0, 0.25]
    vector = scoring.vector_bands(scoring.score_vector(["p", "q", "p", "q", "p", "q"]))
    assert spark.createDataFrame([("1", "x")], "p string, q string").select(vector["18-24"].cast("int"), vector["50"].cast("int")).first() == (1, 0)


def test_inject_words(spark):
    docs = spark.range(20000).select(F.col("id"), F.lit("text").alias("t"))
    words = spark.createDataFrame([(f"w{i}",) for i in range(300)], "word string")
    out = moderation.inject_words(docs, words, "id", "t")
    changed = out.filter("t <> 'text'")
    assert out.count() == 20000 and 3600 < changed.count() < 4400
    assert {r.t for r in changed.collect()} == {f"text,w{i}" for i in range(300)}
    assert bag(out) == bag(moderation.inject_words(docs, words, "id", "t"))
    assert moderation.inject_words(docs, words.limit(0), "id", "t").filter("t <> 'text'").count() == 0


def test_weight_lookup(spark):
    weights = spark.createDataFrame([("x", {"18-24": 0.1}), ("base", {"18-24": 0.9})], "label string, bands map<string,double>")
    df = spark.createDataFrame([("x",), ("y",), (None,)], "l string")
    read = lambda out: {r.l: r.w and r.w["18-24"] for r in out.collect()}
    brands = weights.unionByName(spark.createDataFrame([(DEFAULT_BRAND, {"18-24": 0.5})], weights.schema))
    assert read(brand_weight_lookup(df, "l", brands, "w")) == {"x": 0.1, "y": 0.5, None: 0.5}
    assert read(weight_lookup(df, "l", weights, "w")) == {"x": 0.1, "y": None, None: None}
    assert read(weight_lookup(df, "l", weights, "w", "base")) == {"x": 0.1, "y": 0.9, None: 0.9}


def test_dimension_helpers(spark):
    nested = spark.createDataFrame([("1", ("a",))], "dic_code string, info struct<dic_name:string>")
    assert flat_dictionary(nested).first() == ("1", "a")
    dim = spark.range(20)
    assert scan(dim, "id", 5).count() == 5 and scan(dim, "id").first().row_key == "0"
    assert row_count(dim).first().row_count == 20


def test_pivot_and_unpivot(spark):
    rows = [(1, "John Doe", "IT", 5000), (2, "Jane Smith", "HR", 6000)]
    df = spark.createDataFrame(rows, "emp_id int, emp_name string, department string, salary int")
    wide = pivot(df, [], "emp_name", {"John Doe": "john_doe", "Jane Smith": "jane_smith"}, {"max_salary": F.max("salary"), "dept": F.max("department")})
    assert wide.first().asDict() == {"john_doe_max_salary": 5000, "john_doe_dept": "IT", "jane_smith_max_salary": 6000, "jane_smith_dept": "HR"}
    summary = spark.createDataFrame([(1, 5000, 5500, None)], "emp_id int, dept_10 int, dept_20 int, dept_30 int")
    labels = {"dept_10": "10", "dept_20": "20", "dept_30": "30"}
    assert bag(unpivot(summary, ["emp_id"], labels, "department", "salary")) == Counter([(1, "10", 5000), (1, "20", 5500)])
    assert unpivot(summary, ["emp_id"], labels, "department", "salary", drop_nulls=False).count() == 3


def test_windows_on_the_edge(spark):
    df = spark.createDataFrame([(BASE,), (BASE + timedelta(seconds=9, microseconds=999999),), (BASE + timedelta(seconds=10),)], "ts timestamp")
    out = metrics.tumbling(df, "ts", "10 seconds", [], [F.count("*").alias("n")])
    assert bag(out) == Counter([("2024-01-01 00:00:00", "2024-01-01 00:00:10", "2024-01-01", 2), ("2024-01-01 00:00:10", "2024-01-01 00:00:20", "2024-01-01", 1)])


def test_snapshot_skips_empty_and_compacts(spark, tmp_path):
    path, target = str(tmp_path / "t"), str(tmp_path / "c")
    assert not exists(spark, path)
    rows = spark.createDataFrame([(1, "a", 1), (2, None, 1), (None, "x", 1)], "id int, v string, n int")
    upsert_batch(rows, 0, path, ["id"], ["n"], skip_empty=True)
    assert bag(read_snapshot(spark, path, ["id"], ["n"])) == Counter([(1, "a", 1)])
    upsert_batch(spark.createDataFrame([(1, "b", 2), (3, "c", 2)], "id int, v string, n int"), 1, path, ["id"], ["n"])
    compact(spark, path, target, ["id"], ["n"], 1)
    upsert_batch(spark.createDataFrame([(3, "d", 3)], "id int, v string, n int"), 2, target, ["id"], ["n"])
    assert bag(read_snapshot(spark, target, ["id"], ["n"])) == Counter([(1, "b", 2), (3, "d", 3)])
    assert exists(spark, path)


def test_compacted_target_keeps_deletes_and_batch_order(spark, tmp_path):
    frame = lambda *rows: spark.createDataFrame(rows, "id int, n int, op string")
    path, target, later = str(tmp_path / "t"), str(tmp_path / "c"), str(tmp_path / "l")
    gone = F.col("op") == "d"
    upsert_batch(frame((1, 5, "u"), (2, 1, "u")), 0, path, ["id"], ["n"], gone)
    upsert_batch(frame((1, 9, "d")), 1, path, ["id"], ["n"], gone)
    compact(spark, path, target, ["id"], ["n"], 1)
    upsert_batch(frame((1, 7, "u")), 2, target, ["id"], ["n"], gone)  # older than the delete
    assert bag(read_snapshot(spark, target, ["id"], ["n"]).select("id", "n")) == Counter([(2, 1)])
    for number, n in enumerate((9, 2)):
        upsert_batch(frame((1, n, "u")), number, later, ["id"], ["n"], gone)
    compact(spark, later, later + "2", ["id"], ["n"], 1, by_batch=True)
    assert bag(read_snapshot(spark, later + "2", ["id"], ["n"], by_batch=True).select("id", "n")) == Counter([(1, 2)])


def test_replayed_folder_batches_and_new_checkpoints(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "sink_table string, n int")
    path = str(tmp_path / "k2")
    for _ in range(2):
        destination_writer(path)(rows, 0)
    assert spark.read.parquet(path).count() == 2
    days = str(tmp_path / "k7")
    for _ in range(2):
        day_writer(days, "ts")(spark.createDataFrame([('{"ts":1704067200}',)], "value string"), 0)
    assert spark.read.text(days).count() == 1
    feed, out = str(tmp_path / "feed"), str(tmp_path / "k5")
    rows.write.parquet(feed)
    for checkpoint in ("one", "two", "two"):
        stream = spark.readStream.schema(rows.schema).parquet(feed)
        query = stream.writeStream.foreachBatch(batch_writer(out)).option("checkpointLocation", str(tmp_path / checkpoint)).trigger(availableNow=True).start()
        query.awaitTermination()
    # Two checkpoints: both runs' batch 0 is kept; a restart of the second adds nothing.
    assert spark.read.parquet(out).count() == 4


def test_numbers_beyond_timestamps(spark, tmp_path):
    numbers = ["99999999999999999", "999999999999999999", "99999999999999999999", "-99999999999999999", "-1000", "1704067200000"]
    got = spark.createDataFrame([(n,) for n in numbers], "n string").select(
        tm.tolerant_timestamp("n").cast("string").alias("t"), tm.from_millis("n").isNull().alias("none")
    ).collect()
    assert [r.t for r in got] == [None, None, None, None, "1969-12-31 23:43:20", "2024-01-01 00:00:00"]
    assert [r.none for r in got] == [True, True, True, True, False, False]
    lines = spark.createDataFrame([(f'{{"ts":{n}}}',) for n in numbers], "value string")
    write_by_day(lines, str(tmp_path / "d"), "ts")
    days = {str(r.day): r.n for r in spark.read.text(str(tmp_path / "d")).groupBy("day").agg(F.count("*").alias("n")).collect()}
    assert days == {"error_bucket": 4, "19691231": 1, "20240101": 1}


def test_skew_join_fails_on_a_repeated_busy_key(spark):
    left = spark.createDataFrame([(i % 300,) for i in range(600)], "k int")
    right = spark.createDataFrame([(k % 300, k) for k in range(600)], "k int, v int")
    with pytest.raises(Exception, match="repeats a key"):
        joins.skew_join(left, right, ["k"], "inner").count()


def test_blank_messages_are_dirty(spark):
    messages = spark.createDataFrame([("",), ("  ",), (None,), ('{"op":"r"}',)], "value string")
    good, dirty = cdc.split_dirty(cdc.parse_cdc(messages))
    assert good.count() == 1 and sorted(r.value for r in dirty.collect()) == ["", "  "]


def test_one_rule_for_each_table(spark):
    texts = ['{"before":null,"after":{"id":"1","v":"x"},"source":{"table":"t"},"op":"c","ts_ms":1}']
    changes = cdc.valid_changes(cdc.parse_cdc(spark.createDataFrame([(t,) for t in texts], "value string")))
    rules = spark.createDataFrame([("t", "insert", "s1", "id"), ("t", "update", "s2", "id,v")], "source_table string, source_type string, sink_table string, sink_columns string")
    matched, rest = routing.route(changes, rules)
    assert [r.sink_table for r in matched.collect()] == ["s2"] and rest.count() == 0
    matched, rest = routing.route(changes, rules, by_op=True)
    assert [r.sink_table for r in matched.collect()] == ["s1"] and rest.count() == 0


def test_rows_of_reads_inserts_and_updates(spark):
    texts = [f'{{"after":{{"id":"{i}"}},"source":{{"table":"t"}},"op":"{op}","ts_ms":{i}}}' for i, op in enumerate("rcud")]
    changes = cdc.parse_cdc(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert sorted(r.id for r in cdc.rows_of(changes, "t", ["id"]).collect()) == ["0", "1", "2"]
    assert [r.id for r in cdc.rows_of(changes, "t", ["id"], cdc.SNAPSHOT).collect()] == ["0"]


def test_labels_with_quotes(spark):
    wide = spark.createDataFrame([(1, 2, 3)], "k int, a int, b int")
    assert bag(unpivot(wide, ["k"], {"a": "it's", "b": "b"}, "n", "v")) == Counter([(1, "it's", 2), (1, "b", 3)])


def test_text_files(spark, tmp_path):
    days = str(tmp_path / "d")
    lines = ['{"ts":1704067200}', '{"ts":1704067200000}', "not json", '{"ts":"late"}', '{"x":1}']
    write_by_day(spark.createDataFrame([(v,) for v in lines], "value string"), days, "ts")
    assert {r.day: r.n for r in spark.read.text(days).groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n")).collect()} == {
        "20240101": 2, "error_bucket": 3
    }
    csv = str(tmp_path / "c")
    write_csv(spark.createDataFrame([(1, None, {"a": 1})], "id int, t string, m map<string,int>").coalesce(1), csv)
    text = next((tmp_path / "c").glob("*.csv")).read_bytes().decode("utf-8")
    assert text == '\ufeffid,t,m\n1,,"{""a"":1}"\n'


def test_scratch_folder(spark):
    assert scratch_root(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert scratch(spark, "x") != scratch(spark, "x")


@pytest.fixture
def shuffled(spark):
    """Joins by shuffle into eight fixed parts, so that the share of each part can be read."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)

    def sizes(df):
        # All columns are read, else the optimizer may leave the join out.
        used = F.max(F.xxhash64(*df.columns)).alias("used")
        counted = df.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("size"), used)
        return [r["size"] for r in counted.collect()]

    yield sizes
    for k, v in before.items():
        spark.conf.set(k, v)


def busy_rows(spark, count=20_000):
    """A third of the rows has one key, the rest is spread thin."""
    key = F.when(F.col("id") % 3 == 0, F.lit("busy")).otherwise(F.concat(F.lit("k"), (F.col("id") % 4001).cast("string")))
    return spark.range(count).select(
        key.alias("key"), F.col("id").alias("n"), F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 60).alias("ts"),
        F.when(F.col("id") % 2 == 0, "1").otherwise("0").alias("is_new"), F.lit(1.0).alias("amount"),
    )


def test_busy_key_is_spread_over_parts(spark, shuffled):
    rows = busy_rows(spark)
    fair = 20_000 / 8 * 1.5
    side = rows.groupBy("key").agg(F.count("*").alias("w"), F.min("n").alias("first"))
    plain = rows.join(side.select("key", "first"), "key", "left")
    assert max(shuffled(plain)) > fair  # what the operators below avoid
    assert max(shuffled(joins.skew_join(rows, side, ["key"], "left", "w"))) < fair
    assert max(shuffled(joins.skew_join(rows, side.drop("w"), ["key"], "left"))) < fair
    assert max(shuffled(repair_visitor_flag(rows, "key", "ts", "is_new", ["n"]))) < fair
    assert max(shuffled(retract_versions(rows, "key", ["ts", "n"], ["amount"], row_id=["n"]))) < 2 * fair
    near = joins.interval_join(rows, rows, "key", "ts", "ts", -timedelta(hours=1), timedelta(0), ["n"], "r_")
    counts = shuffled(near)
    assert max(counts) < sum(counts) / 8 * 1.5
    running = metrics.running_counts(rows, "key", "ts", ["n"], {"pv": F.lit(1)})
    assert max(shuffled(running)) < fair
    sets = metrics.user_running_sets(rows, "key", "ts", ["n"], ["is_new"])
    assert sets.count() == 20_000 and max(shuffled(sets)) < fair


def test_busy_key_leaves_a_task_as_one_row(spark, shuffled):
    """What crosses the shuffle is one row per key and task, so the busy key is no bigger than the others."""
    rows = busy_rows(spark).repartition(4)
    for out, where in [(latest_per_key(rows, ["key"], ["ts"]), "WindowGroupLimit"), (metrics.report(rows, ["key"], "amount"), "partial_sum")]:
        plan = out._jdf.queryExecution().executedPlan().toString()
        exchange = plan.index("hashpartitioning(key")
        assert where in plan[exchange:]


OPEN = "spark.sql.maxConcurrentOutputFileWriters"


@pytest.fixture
def written(monkeypatch):
    """Of each Parquet write, the number of folders a task may keep open and the plan of the rows."""
    seen = []
    parquet = DataFrameWriter.parquet

    def watched(self, *args, **kwargs):
        seen.append((int(self._spark.conf.get(OPEN)), self._df._jdf.queryExecution().executedPlan().toString()))
        return parquet(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    return seen


def test_destinations_are_written_without_a_sort(spark, written):
    before = spark.conf.get(OPEN)
    rows = spark.range(600).select(F.concat(F.lit("t"), (F.col("id") % (3 * OPEN_FOLDERS)).cast("string")).alias("sink_table"), "id")
    path = scratch(spark, "folders")
    write_by_destination(rows, path)
    assert [n for n, _ in written] == [OPEN_FOLDERS] and spark.conf.get(OPEN) == before
    assert bag(spark.read.parquet(path).select("sink_table", "id")) == bag(rows)  # more folders than may be open


def test_events_are_landed_where_they_are_parsed(spark, written):
    messages = spark.range(40, numPartitions=3).select(
        cdc.envelope(F.concat(F.lit("t"), (F.col("id") % 5).cast("string")), {"id": F.col("id")}, ts_ms=F.col("id")).alias("value")
    )
    path = scratch(spark, "landed")
    land_by_table(cdc.parse_cdc(messages), path)
    assert [n for n, _ in written] == [OPEN_FOLDERS] and "Exchange" not in written[0][1]
    landed = cdc.of_table(spark.read.parquet(path), "t3").select(F.col("after")["id"], "ts_ms")
    assert set(map(tuple, landed.collect())) == {(str(k), k) for k in range(3, 40, 5)}


def test_joins_of_the_order_detail_move_no_derived_column(spark):
    text = lambda *names: spark.createDataFrame([], ", ".join(f"{n} string" for n in names) + ", ts_ms bigint")
    sides = [text(*cdc.CDC_COLUMNS[t]) for t in ("order_detail", "order_info", "order_detail_activity", "order_detail_coupon")]
    plan = facts.order_detail_fact(*sides)._jdf.queryExecution().analyzed().toString()
    below = plan[plan.index("Join") :]
    assert "date_id" not in below and "split_original_amount" not in below
