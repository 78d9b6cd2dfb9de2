"""Boundary values of the scalar functions."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tideline.functions import text as tx
from tideline.functions import time as tm
from tideline.functions import values as vl
from tideline.operators import scoring


@pytest.fixture
def evaluate(spark):
    def go(values, kind, column):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"n int, v {kind}")
        return [r[0] for r in rows.orderBy("n").select(column.alias("out")).collect()]

    return go


def test_time_slots(evaluate):
    hours = [0, 5, 6, 8, 9, 11, 12, 13, 14, 17, 18, 21, 22, 23]
    names = "凌晨 凌晨 早晨 早晨 上午 上午 中午 中午 下午 下午 晚上 晚上 夜间 夜间".split()
    times = [datetime(2024, 1, 1, h, 59, 59) for h in hours]
    assert evaluate([*times, None], "timestamp", tm.time_slot("v")) == [*names, None]


def test_price_bands_and_amount_labels(evaluate):
    amounts = [Decimal(x) for x in ("999.99", "1000.00", "1000.01", "3000.00", "3000.01", "3999.99", "4000.00")]
    assert evaluate(amounts, "decimal(10,2)", vl.price_band("v")) == ["低价商品"] * 2 + ["中价商品"] * 2 + ["高价商品"] * 3
    assert evaluate(amounts, "decimal(10,2)", scoring.amount_label("v")) == ["low"] + ["middle"] * 5 + ["high"]
    assert evaluate([None], "decimal(10,2)", vl.price_band("v")) == [None]


def test_zodiac_edges(evaluate):
    days = {(1, 19): "摩羯座", (1, 20): "水瓶座", (2, 18): "水瓶座", (2, 19): "双鱼座", (2, 29): "双鱼座", (6, 21): "双子座",
            (6, 22): "巨蟹座", (10, 23): "天秤座", (10, 24): "天蝎座", (12, 21): "射手座", (12, 22): "摩羯座", (12, 31): "摩羯座"}
    assert evaluate([date(2000, *d) for d in days], "date", vl.zodiac("v")) == list(days.values())


def test_age(evaluate):
    born = [date(1996, 2, 29), date(2000, 2, 28), date(2000, 3, 1), date(2023, 2, 28)]
    as_of = lambda text: F.lit(text).cast("date")
    assert evaluate(born, "date", tm.age_years("v", as_of("2023-02-28"))) == [26, 23, 22, 0]
    assert evaluate(born, "date", tm.age_years("v", as_of("2023-03-01"))) == [27, 23, 23, 0]
    assert evaluate(born[:1], "date", tm.decade("v")) == [1990]
    assert evaluate(["10957", None, "x"], "string", F.date_format(tm.epoch_day("v"), "yyyy-MM-dd")) == ["2000-01-01", None, None]


def test_gender(evaluate):
    assert evaluate(["M", None], "string", vl.gender_label("v")) == ["M", "home"]


def test_tolerant_time(evaluate):
    values = ["1704067200000", "1704067200", "2024-01-01 00:00:00", "2024-01-01", "soon", None, "9" * 30]
    assert evaluate(values, "string", tm.day_text("v")) == ["2024-01-01"] * 4 + [None] * 3
    assert evaluate(["2024-01-01 00:00:01", "x"], "string", tm.text_millis("v")) == [1704067201000, None]


def test_event_times(spark):
    rows = spark.createDataFrame([("5", "7"), (None, "7"), ("x", None)], "block_timestamp string, timestamp string")
    assert [r.event_time and r.event_time.second for r in tm.event_time(rows, ["block_timestamp", "timestamp"]).collect()] == [5, 7, None]
    lists = spark.createDataFrame([([("3000",), ("9000",)],), ([],), (None,)], "items array<struct<window_start_time:string>>")
    assert [r.event_time and r.event_time.second for r in tm.list_event_time(lists, "items").collect()] == [3, None, None]


def test_day_partitions(evaluate):
    out = evaluate([date(2023, 12, 30), date(2024, 1, 2), date(2024, 1, 3)], "date", tm.day_partitions("v", F.lit("2024-01-02")))
    assert out == [[20231230, 20231231, 20240101, 20240102], [20240102], []]


def test_half_up(evaluate):
    values = [Decimal("0.0045"), Decimal("0.1045"), Decimal("-0.0005"), Decimal("0.10449")]
    assert evaluate(values, "decimal(10,5)", vl.half_up("v").cast("string")) == ["0.005", "0.105", "-0.001", "0.104"]


def test_amount_product(evaluate):
    assert evaluate(["999", "x", None], "string", vl.amount_product("v", F.lit("3"))) == ["2997.0000", None, None]


def test_hash_bucket(evaluate):
    import hashlib

    values = ["a", "0xdac17f958d2ee523a2206206994597c13d831ec7", "0xDAC17F958D2EE523A2206206994597C13D831EC7"]
    expected = f"{int(hashlib.md5(b'a').hexdigest()[-3:], 16) % 128:04d}"
    assert evaluate(values, "string", tx.hash_bucket("v", 128, tx.HOT_BUCKETS)) == [expected, "9002", "9002"]
    assert all(len(b) == 4 for b in evaluate(values, "string", tx.hash_bucket("v")))


def test_plain_decimal(evaluate):
    wide = "f" * 64
    values = ["0xff", "0x" + wide, "12.50", None, "0x0"]
    assert evaluate(values, "string", tx.plain_decimal("v")) == ["255", str(int(wide, 16)), "12.50", "0", "0"]
    values = ["1000000000000000000", "1500000000000000000", "1", "0x" + wide, "0", "-25", None]
    by_wei = ["1", "1.5", "0.000000000000000001", None, "0", "-0.000000000000000025", "0"]
    digits = str(int(wide, 16))
    by_wei[3] = digits[:-18] + "." + digits[-18:].rstrip("0")
    assert evaluate(values, "string", tx.plain_decimal("v", divide=True)) == by_wei


def test_plain_decimal_of_bad_long_and_exponent_texts(evaluate):
    values = ["0x12zz", "0xgg", "0x", "x", "", "1E3", "1.5e-3", "+7", "007", ".5", "5.", "-0.50", "0x" + "f" * 5000, "9" * 5000, "0x" + "g" * 20]
    want = [None] * 5 + ["1000", "0.0015", "7", "7", "0.5", "5", "-0.50", None, "9" * 5000, None]
    got = evaluate(values, "string", tx.plain_decimal("v"))
    assert got[12] is not None and len(got[12]) == 6021
    assert [g for k, g in enumerate(got) if k != 12] == [w for k, w in enumerate(want) if k != 12]


def test_hex_chunks(evaluate):
    one, two = "a" * 64, "b" * 64
    values = ["0x" + one + two, "0x" + one + "cc", "0x", "", None]
    assert evaluate(values, "string", tx.hex_chunks("v")) == [["0x" + one, "0x" + two], ["0x" + one], [], [], []]


def test_json_list_append(evaluate):
    assert evaluate(['["a"]', None, "[]"], "string", tx.json_list_append("v", F.lit("b"))) == ['["a","b"]', '["b"]', '["b"]']


def test_text_helpers(evaluate):
    values = ["好Word1!", "two words", "", "line\n", "café"]
    assert evaluate(values, "string", tx.is_valid_text("v")) == [True, False, False, False, False]
    assert evaluate(["abc", "", None], "string", tx.first_upper("v")) == ["Abc", "", None]
    assert evaluate(["ABC"], "string", tx.first_lower("v")) == ["aBC"]
    assert evaluate([" \t\n", "a", "", None], "string", tx.is_blank("v")) == [True, False, True, True]
    assert evaluate(["", "a", None], "string", tx.is_empty("v")) == [True, False, True]
    assert tx.camel_name("base_category_id") == "baseCategoryId"


def test_words(evaluate):
    assert evaluate(["Red phone-12, café", "", None], "string", tx.words("v")) == [["red", "phone", "12", "café"], [], None]
    out = evaluate(["小米手机pro 很好", None], "string", tx.dictionary_words("v", ["小米", "手机", "小米手"]))
    # Longest match from the left.
    assert out == [["小米手", "机", "p", "r", "o", "很", "好"], None]


def test_scores(evaluate):
    first = lambda c: F.element_at(c, 1).cast("string")
    assert evaluate(["iOS", "Android,iOS", "HarmonyOS", None], "string", first(scoring.device_scores("v"))) == ["0.070000", "0.080000", None, None]
    assert evaluate(["时尚与潮流", "unknown", None], "string", first(scoring.search_scores("v"))) == ["0.135000", "0.000000", "0.000000"]
    assert evaluate(["TCL", "nobody", "", None], "string", first(scoring.brand_scores("v"))) == ["0.040000", "0.020000", None, None]


def test_inferred_band(spark):
    totals = lambda *v: F.array(*[F.lit(Decimal(x)) for x in v])
    row = spark.range(1).select(
        scoring.inferred_band(totals("0", "0", "0", "0", "0", "0")).alias("none"),
        scoring.inferred_band(totals("1", "3", "3", "0", "0", "0")).alias("tie"),
        scoring.inferred_band(totals("1", "3", "3", "0", "0", "9")).alias("last"),
        F.lit(None).cast(scoring.SCORES).alias("a"), scoring.brand_scores(F.lit("TCL")).alias("b"),
    ).withColumn("missing", scoring.inferred_band(scoring.total_scores({"a": "a", "b": "b"}))).first()
    assert (row.none, row.tie, row.last, row.missing) == ("18-24", "25-29", "50", "50")
    vector = spark.createDataFrame([("0.5", None)], "a string, b string").select(scoring.score_vector(["a", "b"]).cast("array<double>")).first()[0]
    assert vector == [0.5, 0.0]
