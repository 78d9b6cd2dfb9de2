"""Windowed metrics and report totals: A1-A8, A10, A11, W1-W5.

Aggregates combine before the shuffle, so global and single-key windows stay parallel. Dimension names are
added after the aggregate, when there is one row per window and key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.time import window_bounds
from tideline.operators.joins import enrich
from tideline.operators.visitors import first_visits, login_days


def tumbling(df: DataFrame, ts: str | None, width: str, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Tumbling window per key (or global without keys); processing time when ``ts`` is None."""
    source = df if ts else df.withColumn("_now", F.current_timestamp())
    grouped = source.groupBy(F.window(ts or "_now", width), *keys).agg(*aggs)
    rest = [c for c in grouped.columns if c not in ("window", *keys)]
    return grouped.select(*window_bounds(), *keys, *rest)


def sku_orders(
    df: DataFrame, ts: str | None, width: str, key: str, amounts: list[str], carry: list[str] = (),
    order: list[str] = (),
) -> DataFrame:
    """A1: sums of the amounts per window and sku, with the carried columns of the first row.

    ``order`` decides between rows of the same time.
    """
    first = [F.min_by(c, F.struct(ts or "_now", *order)).alias(c) for c in carry]
    return tumbling(df, ts, width, [key], [F.sum(a).alias(a) for a in amounts] + first)


def province_orders(df: DataFrame, ts: str, width: str, key: str, order_id: str, amount: str) -> DataFrame:
    """A2: order amount and exact number of distinct orders per window and province.

    Streaming has no distinct aggregates, so orders are grouped first and counted in a second aggregate;
    the batch planner builds the same two steps from ``count_distinct``.
    """
    if not df.isStreaming:
        totals = [F.sum(amount).alias("order_amount"), F.count_distinct(order_id).alias("order_ct")]
        return tumbling(df, ts, width, [key], totals)
    orders = df.groupBy(F.window(ts, width), key, order_id).agg(F.sum(amount).alias("order_amount"))
    totals = orders.groupBy("window", key).agg(
        F.sum("order_amount").alias("order_amount"), F.count("*").alias("order_ct")
    )
    return totals.select(*window_bounds(), key, "order_amount", "order_ct")


def order_multiplicities(df: DataFrame, ts: str, width: str, key: str, order_id: str) -> tuple[DataFrame, list[str]]:
    """A2 under T1: rows with the bounds of their window, and the keys by which their signs and amounts add up.

    An order stands in a window as long as more of its rows were put out there than taken back.
    """
    keys = ["stt", "edt", "cur_date", key, order_id]
    return df.withColumn("window", F.window(ts, width)).select("*", *window_bounds()).drop("window"), keys


def province_orders_of(multiplicities: DataFrame, key: str, amount: str, sign: str = "sign") -> DataFrame:
    """A2 under T1: order amount and exact distinct orders from sums of signs per window, key and order."""
    standing = multiplicities.filter(F.col(sign) > 0)
    return standing.groupBy("stt", "edt", "cur_date", key).agg(F.sum(amount).alias("order_amount"), F.count("*").alias("order_ct"))


def province_orders_signed(df: DataFrame, ts: str, width: str, key: str, order_id: str, amount: str, sign: str = "sign") -> DataFrame:
    """A2 over the signed rows of ``retract_versions``, with measures negated as well: the totals of the newest versions.

    On streams, keep the sums of ``order_multiplicities`` with ``totals_writer`` and read them by ``province_orders_of``.
    """
    rows, keys = order_multiplicities(df, ts, width, key, order_id)
    return province_orders_of(preaggregated(rows, keys, {amount: F.col(amount), sign: F.col(sign)}), key, amount, sign)


TRAFFIC_DIMS = ["vc", "ch", "ar", "is_new"]


def traffic(
    logs: DataFrame, ts: str, width: str, visitor: str = "mid", dims: list[str] = TRAFFIC_DIMS,
    last_page: str = "last_page_id", during: str = "during_time",
) -> DataFrame:
    """A3: page views, unique visitors, started sessions and duration per window and dimension set.

    A visitor counts in the window of the day's first visit. First visits are reduced to one row per visitor
    and day on their own and added to the same aggregate, so no raw row is ordered by visitor.
    """
    started = F.col(last_page).isNull() | (F.col(last_page) == "")
    views = logs.select(
        ts, *dims, F.lit(1).alias("pv"), F.lit(0).alias("uv"), F.when(started, 1).otherwise(0).alias("sv"),
        F.col(during).alias("dur"),
    )
    firsts = first_visits(logs, [visitor], ts, dims).select(
        ts, *dims, F.lit(0).alias("pv"), F.lit(1).alias("uv"), F.lit(0).alias("sv"),
        F.lit(None).cast(logs.schema[during].dataType).alias("dur"),
    )
    totals = [F.sum("pv").alias("pv_ct"), F.sum("uv").alias("uv_ct"), F.sum("sv").alias("sv_ct"),
              F.sum("dur").alias("dur_sum")]
    return tumbling(views.unionByName(firsts), ts, width, dims, totals)


def home_detail_visitors(
    logs: DataFrame, ts: str, width: str, visitor: str = "mid", page: str = "page_id",
    home: str = "home", detail: str = "good_detail",
) -> DataFrame:
    """A4: daily unique visitors of the home and the detail page per global window."""
    firsts = first_visits(logs.filter(F.col(page).isin(home, detail)), [visitor, page], ts)
    hits = lambda name: F.sum(F.when(F.col(page) == name, 1).otherwise(0))
    return tumbling(firsts, ts, width, [], [hits(home).alias("home_uv_ct"), hits(detail).alias("detail_uv_ct")])


def logins(logs: DataFrame, ts: str, width: str, user: str = "uid", return_days: int = 8) -> DataFrame:
    """A5: unique and returning users per global window."""
    days = login_days(logs, user, ts, return_days)
    return tumbling(days, ts, width, [], [F.sum("uu_ct").alias("uu_ct"), F.sum("back_ct").alias("back_ct")])


def cart_users(carts: DataFrame, ts: str, width: str, user: str = "user_id") -> DataFrame:
    """Users who add to the cart for the first time that day, per global window."""
    return tumbling(first_visits(carts, [user], ts), ts, width, [], [F.count("*").alias("cart_add_uu_ct")])


def keyword_counts(words: DataFrame, ts: str, width: str, keys: list[str]) -> DataFrame:
    """Keyword count per window and keys (Q23: the raw event time is no key unless named)."""
    return tumbling(words, ts, width, keys, [F.count("*").alias("keyword_count")])


def user_value_sets(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """A8, final form: row count and the sorted distinct values of each field as CSV text.

    Values are made distinct per (user, field) before any set is built, so a busy user costs one row per
    distinct value and task. Nulls are left out (Q21).
    """
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    values = df.select(key, F.explode(pairs).alias("p")).select(key, "p.field", "p.value")
    counted = values.groupBy(key, "field", "value").agg(F.count("*").alias("n"))
    sets = [
        F.array_join(
            F.array_sort(F.collect_list(F.when(F.col("field") == f, F.col("value")))), ","
        ).alias(f)
        for f in fields
    ]
    pv = F.sum(F.when(F.col("field") == fields[0], F.col("n"))).alias("pv")
    return counted.groupBy(key).agg(pv, *sets)


def running_counts(
    df: DataFrame, key: str, ts: str, order: list[str], counts: dict[str, Column], slot: str = "hour"
) -> DataFrame:
    """Running sums per key in event order, without an ordered pass over a whole key.

    Each key is cut into time slots: slot totals are accumulated over slots (few rows), rows only within
    their slot, and the two are added.
    """
    slotted = df.withColumn("_slot", F.date_trunc(slot, F.col(ts)))
    totals = slotted.groupBy(key, "_slot").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in counts.items()])
    before = Window.partitionBy(key).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        key, "_slot", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_b_{n}") for n in counts]
    )
    inside = Window.partitionBy(key, "_slot").orderBy(ts, *order).rowsBetween(Window.unboundedPreceding, 0)
    local = slotted.select("*", *[F.sum(c).over(inside).alias(f"_l_{n}") for n, c in counts.items()])
    joined = local.join(offsets, [key, "_slot"], "left")
    return joined.select(
        *df.columns, *[(F.col(f"_l_{n}") + F.col(f"_b_{n}")).cast("bigint").alias(n) for n in counts]
    )


def user_running_sets(
    df: DataFrame, key: str, ts: str, order: list[str], fields: list[str], slot: str = "hour"
) -> DataFrame:
    """A8, running form: on every row the count so far and the sets so far.

    A set only changes at the first appearance of a value, so sets are built once per appearance (rows
    bounded by distinct values) and each row looks its version up by the number of appearances so far. The
    lookup is per time slot, so that the long last version of a busy user is not one group.
    """
    position = F.struct(ts, *order)
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    values = df.select(key, position.alias("_at"), F.explode(pairs).alias("p")).select(key, "_at", "p.*")
    seen = values.filter(F.col("value").isNotNull()).groupBy(key, "field", "value").agg(F.min("_at").alias("_at"))
    changes = seen.groupBy(key, "_at").agg(F.collect_list(F.struct("field", "value")).alias("_new"))
    so_far = Window.partitionBy(key).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    versions = changes.select(
        key, "_at", F.row_number().over(Window.partitionBy(key).orderBy("_at")).cast("bigint").alias("_version"),
        F.flatten(F.collect_list("_new").over(so_far)).alias("_all"),
    )
    text = lambda f: F.array_join(
        F.array_sort(F.transform(F.filter("_all", lambda x: x["field"] == f), lambda x: x["value"])), ","
    )
    texts = versions.select(key, "_version", *[text(f).alias(f"_s_{f}") for f in fields])
    marks = versions.select(key, F.col("_at"), F.lit(1).alias("_change"))
    rows = df.withColumn("_at", position).join(marks, [key, "_at"], "left").drop("_at")
    counted = running_counts(
        rows, key, ts, order, {"pv": F.lit(1), "_version": F.coalesce("_change", F.lit(0))}, slot
    )
    at_slot = lambda c: F.date_trunc(slot, c).alias("_slot")
    before = Window.partitionBy(key).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    entering = rows.groupBy(key, at_slot(F.col(ts))).agg(F.count("_change").alias("_n")).select(
        key, "_slot", F.sum("_n").over(before).alias("_version")
    )
    starting = versions.select(key, at_slot(F.col("_at")[ts]), "_version")
    by_slot = starting.unionByName(entering.filter(F.col("_version") > 0)).join(texts, [key, "_version"])
    out = counted.withColumn("_slot", at_slot(F.col(ts))).join(by_slot, [key, "_slot", "_version"], "left")
    return out.select(key, ts, *order, "pv", *[F.coalesce(f"_s_{f}", F.lit("")).alias(f) for f in fields])


def report(df: DataFrame, keys: list[str], amount: str | None = None, total: str = "total", count: str | None = None) -> DataFrame:
    """A10: amount and/or row totals per key."""
    aggs = ([F.sum(amount).alias(total)] if amount else []) + ([F.count("*").alias(count)] if count else [])
    return df.groupBy(*keys).agg(*aggs)


def preaggregated(df: DataFrame, keys: list[str | Column], sums: dict[str, Column]) -> DataFrame:
    """Additive totals per key; totals of totals are totals, so a join can come after the first round."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])


def preaggregate(df: DataFrame, ts: str, grain: str, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    """Additive totals at a time grain; a coarser table is built by applying it to a finer one."""
    return preaggregated(df, [F.date_trunc(grain, F.col(ts)).alias("grain"), *keys], sums)


def with_name(metric: DataFrame, dim: DataFrame, key: str, dim_key: str, name: str, out: str) -> DataFrame:
    """Add a name after the aggregate; keys without a name stay."""
    return enrich(metric, dim, key, dim_key, {name: out}, "left")
