"""Streams must give what the batch form gives on in-order input, survive replays and drop late rows."""

from __future__ import annotations

import time
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tideline.operators import cdc, facts, logs, metrics
from tideline.operators.dedup import first_per_key, last_per_window, latest_per_key, retract_versions
from tideline.operators.joins import enrich, interval_join, membership, small_side
from tideline.operators.routing import latest_rules, router
from tideline.operators.visitors import first_visits, login_days, repair_visitor_flag
from tideline.schemas import APP_LOG
from tideline.sinks.writers import batch_writer, read_snapshot, read_totals, topic_frame, totals_writer, upserter
from tideline.sources.readers import change_events, json_table, message_files
from tideline.streaming import changelog
from tideline.streaming.runner import late_rows, run, start, with_fresh_side
from tideline.streaming.state import (
    login_days_stream, newest_after_delay, repair_flag_stream, retract_stream, value_sets_stream,
)

BASE = datetime(2024, 1, 1)
SCHEMA = "id bigint, key string, page_id string, is_new string, amount double, ts timestamp"


def rows(count: int = 240, step: timedelta = timedelta(hours=1)):
    pages = ["home", "good_detail", "trade"]
    return [
        (i, f"u{i * 7 % 5 if i % 3 else 0}", pages[i % 3], "1" if i % 4 else "0", float(i % 11), BASE + i * step)
        for i in range(count)
    ]


@pytest.fixture
def feed(spark, tmp_path):
    """Writes rows as files in order; gives the batch table and a stream that reads one file per batch."""

    def write(data, schema=SCHEMA, files=4, name="in"):
        path = str(tmp_path / name)
        size = -(-len(data) // files)
        for at in range(0, len(data), size):
            spark.createDataFrame(data[at : at + size], schema).coalesce(1).write.mode("append").parquet(path)
        batch = spark.createDataFrame(data, schema)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
        return batch, stream

    return write


@pytest.fixture
def collect(spark, tmp_path):
    count = iter(range(100))

    def go(df, mode="append"):
        number = next(count)
        out = str(tmp_path / f"out{number}")
        query = run(df, str(tmp_path / f"cp{number}"), path=out, mode=mode)
        return spark.read.schema(df.schema).parquet(out), query

    return go


def bag(df, columns=None):
    return Counter(map(tuple, df.select(*(columns or df.columns)).collect()))


# A last row far ahead moves the watermark past everything before it; it is left out of comparisons.
def with_flush(data, days=60):
    last = data[-1]
    return [*data, (*last[:1], "flush", *last[2:-1], last[-1] + timedelta(days=days))]


def closed(df, column="stt"):
    return df.filter(F.col(column) < "2024-02-01")


def test_province_orders(feed, collect):
    batch, stream = feed(with_flush(rows()))
    args = ("ts", "1 day", "key", "id", "amount")
    out, _ = collect(metrics.province_orders(stream.withWatermark("ts", "1 hour"), *args))
    assert bag(closed(out)) == bag(closed(metrics.province_orders(batch, *args)))


def test_tumbling_window_and_late_rows(feed, collect):
    far = [(1000 + i, "end", "home", "1", 1.0, BASE + timedelta(days=30)) for i in range(12)]
    late = (999, "late", "home", "1", 1.0, BASE)
    batch, stream = feed([*rows(36), *far, late, *far[:11]], files=5)
    counts = [F.count("*").alias("n")]
    out, query = collect(metrics.tumbling(stream.withWatermark("ts", "1 hour"), "ts", "1 day", ["key"], counts))
    assert late_rows(query) == 1
    on_time = batch.filter("key not in ('late', 'end')")
    assert bag(out.filter("key <> 'end'")) == bag(metrics.tumbling(on_time, "ts", "1 day", ["key"], counts))


@pytest.mark.parametrize("salts", [0, 4])
def test_first_visits(feed, collect, salts):
    batch, stream = feed(with_flush(rows()))
    out, _ = collect(first_visits(stream.withWatermark("ts", "1 hour"), ["key"], "ts", ["page_id"], salts))
    assert bag(out) == bag(first_visits(batch, ["key"], "ts", ["page_id"]))


def test_traffic(feed, collect):
    batch, stream = feed(with_flush(rows()))
    wide = lambda df: df.withColumn("last_page_id", F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.lit("home")))
    form = lambda df: metrics.traffic(wide(df), "ts", "6 hours", "key", ["page_id", "is_new"], during="amount")
    out, _ = collect(form(stream.withWatermark("ts", "1 hour")))
    assert bag(closed(out)) == bag(closed(form(batch)))


def test_home_detail_and_cart_users(feed, collect):
    batch, stream = feed(with_flush(rows()))
    marked = stream.withWatermark("ts", "1 hour")
    out, _ = collect(metrics.home_detail_visitors(marked, "ts", "6 hours", "key"))
    assert bag(closed(out)) == bag(closed(metrics.home_detail_visitors(batch, "ts", "6 hours", "key")))
    out, _ = collect(metrics.cart_users(marked, "ts", "6 hours", "key"))
    assert bag(closed(out)) == bag(closed(metrics.cart_users(batch, "ts", "6 hours", "key")))


def test_retract(feed, collect):
    data = rows(60)
    batch, stream = feed(with_flush(data))
    live = retract_stream(stream.withWatermark("ts", "1 hour"), "key", "ts", ["amount"], timedelta(days=90))
    out, _ = collect(live)
    assert bag(out) == bag(retract_versions(batch, "key", ["ts", "id"], ["amount"]))


def test_retract_forgets_after_ttl(feed, collect):
    data = rows(4, timedelta(minutes=1)) + [(50 + i, "u0", "home", "1", 5.0, BASE + timedelta(days=3 + i)) for i in range(2)]
    _, stream = feed([(i, "u0", *r[2:]) for i, r in enumerate(data)], files=6)
    out, _ = collect(retract_stream(stream.withWatermark("ts", "1 minute"), "key", "ts", ["amount"], timedelta(hours=1)))
    # Three repeats inside the TTL are taken back; the rows days later find no earlier version.
    assert out.count() == 6 + 3
    assert out.filter("id = 3").count() == 1


def test_newest_after_delay(feed, collect):
    data = [(i, f"k{i % 3}", "home", "1", float(i), BASE + timedelta(seconds=i)) for i in range(30)]
    batch, stream = feed(with_flush(data), files=8)
    live = newest_after_delay(stream.withWatermark("ts", "0 seconds"), "key", "ts", ["ts"], timedelta(minutes=5))
    out, _ = collect(live)
    assert bag(out.filter("key <> 'flush'")) == bag(latest_per_key(batch, ["key"], ["ts"]).filter("key <> 'flush'"))


def test_visitor_flag(feed, collect):
    batch, stream = feed(rows())
    out, _ = collect(repair_flag_stream(stream.withWatermark("ts", "1 hour"), "key", "ts", "is_new"))
    assert bag(out) == bag(repair_visitor_flag(batch, "key", "ts", "is_new", ["id"]))


def test_login_days_and_windows(feed, collect):
    data = rows(400, timedelta(hours=2))
    gap = [(1000 + i, "u1", "home", "1", 1.0, BASE + timedelta(days=33 + 9 * i, hours=5)) for i in range(3)]
    batch, stream = feed([r for r in data if r[1] != "u1" or r[0] < 100] + gap)
    marked = stream.withWatermark("ts", "1 hour")
    columns = ["key", "ts", "uu_ct", "back_ct"]
    out, _ = collect(login_days_stream(marked, "key", "ts", 8, salts=2))
    expected = login_days(batch, "key", "ts", 8)
    assert expected.filter("back_ct = 1").count() >= 3
    assert bag(out, columns) == bag(expected, columns)
    live = metrics.tumbling(login_days_stream(marked, "key", "ts", 8), "ts", "1 day", [], [F.sum("uu_ct").alias("uu"), F.sum("back_ct").alias("back")])
    out, _ = collect(live)
    expected = bag(closed(metrics.logins(batch, "ts", "1 day", "key").select("stt", "edt", "cur_date", "uu_ct", "back_ct")))
    assert bag(closed(out)) == expected
    out, _ = collect(metrics.logins(marked, "ts", "1 day", "key"))
    assert bag(closed(out), ["stt", "edt", "cur_date", "uu_ct", "back_ct"]) == expected


def test_value_sets(feed, collect):
    batch, stream = feed(rows(50))
    out, _ = collect(value_sets_stream(stream, "key", ["ts", "id"], ["page_id", "is_new"]))
    assert bag(out) == bag(metrics.user_running_sets(batch, "key", "ts", ["id"], ["page_id", "is_new"]))


def test_duplicates_and_last_per_window(feed, collect):
    data = rows(60)
    batch, stream = feed([*data, *data[-10:]])
    out, _ = collect(first_per_key(stream.withWatermark("ts", "1 day"), ["key", "ts"], ["id"]))
    assert bag(out) == bag(batch.distinct())
    batch, stream = feed(with_flush(data), name="in2")
    form = lambda df: last_per_window(df, ["key"], "ts", "6 hours", ["ts"]).drop("window")
    out, _ = collect(form(stream.withWatermark("ts", "1 hour")))
    assert bag(out) == bag(form(batch).filter("key <> 'flush'"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join(feed, collect, how):
    data = rows(120)
    batch, stream = feed(with_flush(data), files=3)
    form = lambda df: interval_join(
        df.filter("page_id = 'home'"), df.filter("page_id = 'trade'").withColumnRenamed("ts", "rts"), "key", "ts", "rts",
        -timedelta(hours=5), timedelta(hours=9), ["id", "amount"], "info_", how=how,
    )
    out, _ = collect(form(stream.withWatermark("ts", "1 hour")))
    # The last rows of a left join wait for the watermark.
    seen = lambda df: bag(df.filter("ts < '2024-01-05'"), ["id", "key", "info_id", "info_amount"])
    assert seen(out) == seen(form(batch))


def test_order_detail_fact(spark, feed, collect):
    line = "id string, order_id string, sku_id string, sku_name string, sku_num string, order_price string, create_time string, " \
        "split_total_amount string, split_activity_amount string, split_coupon_amount string, ts_ms bigint, event_time timestamp"
    at = lambda i: BASE + timedelta(minutes=i)
    lines = [(f"d{i}", f"o{i % 20}", "s", "n", "3", "9.50", "1704067200000", "28.5", "1", "0", i, at(i)) for i in range(60)]
    orders = [(f"o{i}", f"u{i}", "p1", i, at(i)) for i in range(20)]
    act = [(f"d{i}", "a", "r", i, at(i)) for i in range(0, 60, 3)]
    cou = [(f"d{i}", "c", i, at(i)) for i in range(0, 60, 4)]
    far = at(60 * 24 * 30)
    flush = lambda data: [*data, *[(*("x" if isinstance(v, str) else v for v in data[0][:-1]), far + timedelta(days=n)) for n in range(2)]]
    sides = [(lines, line), (orders, "id string, user_id string, province_id string, ts_ms bigint, event_time timestamp"),
             (act, "order_detail_id string, activity_id string, activity_rule_id string, ts_ms bigint, event_time timestamp"),
             (cou, "order_detail_id string, coupon_id string, ts_ms bigint, event_time timestamp")]
    pairs = [feed(flush(data), schema, 3, f"s{n}") for n, (data, schema) in enumerate(sides)]
    expected = facts.order_detail_fact(*[p[0] for p in pairs]).filter("order_id <> 'x'")
    live = facts.order_detail_fact(*[p[1].withWatermark("event_time", "1 minute") for p in pairs], bound=timedelta(hours=2))
    out, _ = collect(live)
    out = out.filter("order_id <> 'x'")
    assert expected.count() == 60
    assert bag(out) == bag(expected)


def test_membership(spark, feed, collect):
    batch, stream = feed(rows(40))
    words = spark.createDataFrame([("u0",), ("u3",), ("u3",)], "word string")
    out, _ = collect(membership(stream, "key", words))
    assert bag(out, ["id", "is_member"]) == bag(membership(batch, "key", words), ["id", "is_member"])


def test_messages_to_snapshot_and_restart(spark, tmp_path):
    """Replayed, broken and deleted messages; a restart adds only what is new."""
    messages = str(tmp_path / "messages")
    table, log = str(tmp_path / "table"), str(tmp_path / "log")

    def land(texts):
        spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.mode("append").text(messages)

    def change(key, version, op="r"):
        row = f'{{"id":"{key}","v":"{version}"}}'
        images = f'"before":{row},"after":null' if op == "d" else f'"before":null,"after":{row}'
        return f'{{{images},"source":{{"table":"user_info"}},"op":"{op}","ts_ms":{version}}}'

    def pass_over():
        changes = cdc.split_dirty(change_events(spark, messages, streaming=True))[0]
        flat = changes.select(cdc.image()["id"].alias("id"), cdc.image()["v"].alias("v"), "op", "ts_ms")
        run(flat, str(tmp_path / "cp"), write=upserter(table, ["id"], ["ts_ms"], F.col("op") == "d"))
        run(flat, str(tmp_path / "cp2"), write=batch_writer(log))
        return {r.id: r.v for r in read_snapshot(spark, table, ["id"], ["ts_ms"]).collect()}

    land([change(1, 1), change(2, 1), change(1, 3), "{broken", "null", change(3, 2), change(1, 2)])
    assert pass_over() == {"1": "3", "2": "1", "3": "2"}
    assert pass_over() == {"1": "3", "2": "1", "3": "2"}
    land([change(2, 5, "d"), change(3, 1), change(4, 6)])
    assert pass_over() == {"1": "3", "3": "2", "4": "6"}
    assert spark.read.parquet(log).filter("id is not null").count() == 8
    # The first batch again, as after a lost commit: same id, same rows.
    first = spark.read.parquet(table).filter("batch_id = 0").drop("run", "batch_id", "_deleted", "_written")
    upserter(table, ["id"], ["ts_ms"], F.col("op") == "d")(first, 0)
    assert {r.id: r.v for r in read_snapshot(spark, table, ["id"], ["ts_ms"]).collect()} == {"1": "3", "3": "2", "4": "6"}


def test_topic_frame_and_memory_sink(spark, feed, tmp_path):
    """The frame a topic sink takes, streamed to memory."""
    _, stream = feed(rows(12))
    frame = topic_frame(stream, F.concat(F.lit("dwd_"), "page_id"), "key", hide=("page_id",))
    query = frame.writeStream.format("memory").queryName("topic_rows").trigger(availableNow=True).start()
    query.awaitTermination()
    out = spark.table("topic_rows")
    assert out.columns == ["topic", "key", "value"] and out.count() == 12
    assert out.filter("value like '%page_id%'").count() == 0


def test_routing_with_changing_rules(spark, tmp_path):
    """A rule that is deleted between two micro-batches no longer applies in the second."""
    messages, rule_path = str(tmp_path / "m"), str(tmp_path / "rules")
    names = ["source_table", "source_type", "sink_table", "sink_columns"]

    def land(path, *texts):
        spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1).write.mode("append").text(path)

    def rule(table, op, ts):
        body = f'{{"source_table":"{table}","source_type":"insert","sink_table":"dwd_{table}","sink_columns":"id"}}'
        images = f'"before":{body},"after":null' if op == "d" else f'"after":{body}'
        return f'{{{images},"op":"{op}","ts_ms":{ts}}}'

    change = lambda table, key: f'{{"after":{{"id":"{key}","x":"1"}},"source":{{"table":"{table}"}},"op":"c","ts_ms":{key}}}'
    rules = lambda: latest_rules(change_events(spark, rule_path), names[:2], names)
    routed, rest = str(tmp_path / "routed"), str(tmp_path / "rest")
    handle = router(rules, batch_writer(routed), batch_writer(rest), by_op=True)
    stream = lambda: cdc.split_dirty(change_events(spark, messages, streaming=True))[0]
    land(rule_path, rule("a", "c", 1), rule("b", "c", 1))
    land(messages, change("a", 1), change("b", 2), change("c", 3))
    run(stream(), str(tmp_path / "cp"), write=handle)
    land(rule_path, rule("b", "d", 2))
    land(messages, change("a", 4), change("b", 5))
    run(stream(), str(tmp_path / "cp"), write=handle)
    out = {(r.sink_table, r.ts_ms): r.data for r in spark.read.parquet(routed).collect()}
    assert out == {("dwd_a", 1): {"id": "1"}, ("dwd_b", 2): {"id": "2"}, ("dwd_a", 4): {"id": "4"}}
    assert {r.ts_ms for r in spark.read.parquet(rest).collect()} == {3, 5}


def test_app_logs_as_a_table(spark, tmp_path, collect):
    """Typed logs with a computed, watermarked event time, read as a stream under a view name."""
    def log(uid, item_type, page=True):
        body = f',"page":{{"page_id":"home","last_page_id":"search","item":"w","item_type":"{item_type}","during_time":5}}' if page else ""
        return f'{{"common":{{"mid":"m","uid":"{uid}","os":"iOS 13.3"}}{body},"ts":1704067200000}}'

    path = str(tmp_path / "logs")
    texts = [log("1", "keyword"), log("", "keyword"), log("2", "sku_id"), log("3", "keyword", page=False), "{"]
    spark.createDataFrame([(t,) for t in texts], "value string").write.text(path)
    table = json_table(
        message_files(spark, path, streaming=True), APP_LOG, "app_logs", {"pt": F.current_timestamp(), "at": F.timestamp_millis("ts")}, "at", "5 seconds"
    )
    assert spark.table("app_logs").isStreaming
    out, _ = collect(logs.device_keywords(logs.page_views(table)))
    assert bag(out, ["uid", "os", "keyword"]) == Counter([("1", "iOS", "w")])
    out, _ = collect(logs.searches(logs.page_views(table)).select("uid", "full_word"))
    assert bag(out) == Counter([("1", "w"), ("", "w")])


def test_totals_follow_the_stream(spark, feed, tmp_path):
    """Totals refreshed per micro-batch equal direct totals, also after a batch is replayed."""
    batch, stream = feed(rows(90))
    sums = {"amount": F.col("amount"), "n": F.lit(1)}
    path, write = str(tmp_path / "totals"), totals_writer(str(tmp_path / "totals"), ["key"], sums, run="totals")
    run(stream, str(tmp_path / "cp"), write=write)
    write(batch.filter("id < 23"), 0)
    assert bag(read_totals(spark, path, ["key"], ["amount", "n"])) == bag(metrics.preaggregated(batch, ["key"], sums))


def _details(n):
    return [(f"d{i}", f"o{i % 7}", f"s{i % 5}", "sku", "2", "1.50", str(1704067200000 + i), "3.00", None, "0.10", i) for i in range(n)]


DETAIL = "id string, order_id string, sku_id string, sku_name string, sku_num string, order_price string, create_time string, split_total_amount string, split_activity_amount string, split_coupon_amount string, ts_ms bigint"


@pytest.mark.parametrize("first", ["details", "others"])
def test_outer_join_changes_replay_to_the_batch_fact(spark, feed, collect, tmp_path, first):
    """Rows with nulls, taken back when their match comes; repeated and missing matches; any order of arrival."""
    frames = {
        "details": feed(_details(30), DETAIL, name="details"),
        "orders": feed([(f"o{i}", f"u{i}", str(i)) for i in range(6)], "id string, user_id string, province_id string", name="orders"),
        "activities": feed([(f"d{i}", f"a{i}", f"r{i}") for i in [*range(0, 30, 2), 4, 99]], "order_detail_id string, activity_id string, activity_rule_id string", name="act"),
        "coupons": feed([(f"d{i}", f"c{i}") for i in range(0, 30, 3)] + [(None, "c")], "order_detail_id string, coupon_id string", name="cou"),
    }
    # One file per batch and side: put the details, or all other sides, some batches later.
    late = ["details"] if first == "others" else ["orders", "activities", "coupons"]
    for name in late:
        batch, _ = frames[name]
        path = str(tmp_path / f"late-{name}")
        batch.limit(0).coalesce(1).write.parquet(path)
        for _ in range(3):
            batch.limit(0).coalesce(1).write.mode("append").parquet(path)
        rows = batch.collect()
        for part in (rows[: len(rows) // 2], rows[len(rows) // 2 :]):
            spark.createDataFrame(part, batch.schema).coalesce(1).write.mode("append").parquet(path)
        frames[name] = (batch, spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(path))
    sides = ["details", "orders", "activities", "coupons"]
    out, _ = collect(changelog.order_detail_changes(*[frames[s][1] for s in sides]))
    want = facts.order_detail_fact(*[frames[s][0] for s in sides])
    assert bag(changelog.replayed(out)) == bag(want)
    if first == "details":
        assert out.filter("sign < 0").count() > 0
    messages = changelog.upsert_messages(out, "id")
    assert messages.filter("value is null").count() == out.filter("sign < 0").count()


def test_changelogs_of_changelogs(spark, feed, collect):
    """Rows taken back on either side, nulls as keys, and types beyond text."""
    left = [(1, "a", 1, datetime(2024, 1, 1, 0, 0, 0, 123456)), (2, "b", 1, None), (1, "a", -1, datetime(2024, 1, 1, 0, 0, 0, 123456)), (None, "n", 1, None), (2, "b", 1, None)]
    right = [(1, 10, 1), (2, 20, 1), (2, 21, 1), (2, 20, -1), (2, 21, -1), (3, 30, 1), (None, 0, 1), (2, 9007199254740993, 1)]
    _, ls = feed(left, "k bigint, name string, sign int, at timestamp", files=5, name="l")
    _, rs = feed(right, "rk bigint, v bigint, sign int", files=8, name="r")
    out, _ = collect(changelog.outer_join_changes(ls, "k", [(rs, "rk", ["v"])]))
    assert bag(changelog.replayed(out).select("k", "name", "v", "at")) == Counter({(2, "b", 9007199254740993, None): 2, (None, "n", None, None): 1})
    assert out.filter("k = 1 and sign = 1").first()["at"] == left[0][3]


def test_idle_state_goes(spark, feed, collect, tmp_path):
    """A row that came longer ago than the time to live meets nothing any more."""
    path = {n: str(tmp_path / n) for n in ("l", "r")}
    write = lambda n, rows, schema: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path[n])
    write("l", [("a", 1)], "k string, n int")
    write("r", [("z", 0)], "rk string, v int")
    stream = lambda n, schema: spark.readStream.schema(schema).parquet(path[n])

    def go(ttl, out):
        changes = changelog.outer_join_changes(stream("l", "k string, n int"), "k", [(stream("r", "rk string, v int"), "rk", ["v"])], ttl)
        writer = changes.writeStream.option("checkpointLocation", str(tmp_path / f"cp-{out}")).trigger(once=True)
        assert writer.format("parquet").start(str(tmp_path / out)).awaitTermination(60)
        return spark.read.schema(changes.schema).parquet(str(tmp_path / out))

    for name, ttl in (("short", timedelta(seconds=1)), ("long", timedelta(hours=1))):
        go(ttl, name)
    time.sleep(2)
    write("r", [("a", 5)], "rk string, v int")
    assert bag(go(timedelta(seconds=1), "short")) == Counter([("a", 1, None, 1)])
    assert bag(go(timedelta(hours=1), "long")) == Counter([("a", 1, None, 1), ("a", 1, None, -1), ("a", 1, 5, 1)])


def test_signed_totals_follow_retractions(spark, feed, collect, tmp_path):
    """A2, A11 under T1: in batch and stream, totals of a retracted feed are those of the newest versions."""
    data = [(i, f"k{i % 3}", f"o{i % 4 if i % 5 else 0}", 1, float(i % 7), BASE + timedelta(hours=i)) for i in range(60)]
    data = [(f"id{i % 20}", k, o, s, a, t) for i, k, o, s, a, t in data]
    schema = "id string, key string, order_id string, sign int, amount double, ts timestamp"
    batch, stream = feed(data, schema)
    newest = latest_per_key(batch, ["id"], ["ts"])
    want = bag(metrics.province_orders(newest, "ts", "6 hours", "key", "order_id", "amount"))
    signed = retract_versions(batch, "id", ["ts"], ["amount", "sign"])
    assert bag(metrics.province_orders_signed(signed, "ts", "6 hours", "key", "order_id", "amount")) == want
    changes = retract_stream(stream.withWatermark("ts", "30 days"), "id", "ts", ["amount", "sign"], timedelta(days=99))
    rows, keys = metrics.order_multiplicities(changes, "ts", "6 hours", "key", "order_id")
    path, sums = str(tmp_path / "m"), {"amount": F.col("amount"), "sign": F.col("sign")}
    run(rows, str(tmp_path / "cp"), write=totals_writer(path, keys, sums))
    assert bag(metrics.province_orders_of(read_totals(spark, path, keys, ["amount", "sign"]), "key", "amount")) == want


def test_a_changed_label_shows_from_the_next_batch_on(spark, feed, tmp_path):
    """The dictionary is read anew for every micro-batch."""
    labels, out = str(tmp_path / "labels"), str(tmp_path / "out")
    put = lambda version: spark.createDataFrame([("0", f"zero-{version}"), ("1", f"one-{version}")], "dic_code string, dic_name string").write.mode("overwrite").parquet(labels)
    put(0)
    _, stream = feed([(str(i % 2), i) for i in range(8)], "code string, n int", files=4)
    join = lambda df, side: enrich(df, small_side(side), "code", "dic_code", {"dic_name": "label"}, "inner")
    write = with_fresh_side(lambda session: session.read.parquet(labels), join, batch_writer(out))

    def write_then_change(df, batch_id):
        write(df, batch_id)
        put(batch_id + 1)

    run(stream, str(tmp_path / "cp"), write=write_then_change)
    want = Counter((i, f"{['zero', 'one'][i % 2]}-{i // 2}") for i in range(8))
    assert bag(spark.read.parquet(out).select("n", "label")) == want


def test_processing_time_window(spark, feed, collect):
    """W3."""
    _, stream = feed(rows(10))
    out = metrics.tumbling(stream, None, "10 seconds", [], [F.count("*").alias("n")])
    query = out.writeStream.outputMode("complete").format("memory").queryName("by_clock").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("by_clock").agg(F.sum("n")).first()[0] == 10


def test_file_messages(spark, tmp_path, collect):
    path = str(tmp_path / "text")
    spark.createDataFrame([("a",), ("b",)], "value string").write.text(path)
    out, _ = collect(message_files(spark, path, streaming=True))
    assert bag(out) == Counter([("a",), ("b",)])
    query = start(message_files(spark, path, streaming=True), str(tmp_path / "cp"), path=str(tmp_path / "o"), name="named")
    query.awaitTermination()
    assert query.name == "named"
