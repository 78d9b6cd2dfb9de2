"""Fact tables of the DWD layer."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.time import day_text, time_slot, tolerant_timestamp
from tideline.functions.values import amount_product, price_band
from tideline.operators.joins import enrich, interval_join, small_side
from tideline.schemas import COMMENT_FACT, ORDER_DETAIL_FACT, PAYMENT_FACT, REFUND_FACT

PAY_LOWER = timedelta(minutes=-30)
PAY_UPPER = timedelta(seconds=5)


def order_detail_fact(
    details: DataFrame, orders: DataFrame, activities: DataFrame, coupons: DataFrame,
    bound: timedelta | None = None,
) -> DataFrame:
    """J1 + J2 + F16: order lines with order header, activity and coupon; 17 columns.

    Streaming input needs an ``event_time`` column with a watermark on every side and a time ``bound``; an
    unmatched activity or coupon is then emitted as null once the watermark has passed the bound.
    """
    timed = lambda df, name: [F.col("event_time").alias(name)] if bound is not None else []
    oi = orders.select(F.col("id").alias("_oid"), "user_id", "province_id", *timed(orders, "_ot"))
    act = activities.select(F.col("order_detail_id").alias("_aid"), "activity_id", "activity_rule_id", *timed(activities, "_at"))
    cou = coupons.select(F.col("order_detail_id").alias("_cid"), "coupon_id", *timed(coupons, "_ct"))

    def near(name: str):
        if bound is None:
            return F.lit(True)
        return F.col(name).between(F.col("event_time") - F.lit(bound), F.col("event_time") + F.lit(bound))

    joined = (
        details.join(oi, (F.col("order_id") == F.col("_oid")) & near("_ot"))
        .join(act, (F.col("id") == F.col("_aid")) & near("_at"), "left")
        .join(cou, (F.col("id") == F.col("_cid")) & near("_ct"), "left")
    )
    # Derived columns come last, so that the joins don't move them.
    derived = {"split_original_amount": amount_product("sku_num", "order_price"), "date_id": day_text("create_time")}
    return joined.withColumns(derived).select(*ORDER_DETAIL_FACT)


def payment_fact(payments: DataFrame, details: DataFrame, dictionary: DataFrame, pay_ts: str, detail_ts: str) -> DataFrame:
    """J3 + J4: payments with the order lines placed at most 30 minutes before and 5 seconds after."""
    pay = payments.select(
        F.col("order_id"), F.col("payment_type").alias("payment_type_code"), "callback_time",
        F.col("ts_ms").alias("_pay_ms"), F.col(pay_ts).alias("_pay_ts"),
    )
    lines = details.drop("ts_ms").withColumnRenamed("id", "order_detail_id").withColumnRenamed(
        "split_total_amount", "split_payment_amount"
    )
    carried = [c for c in lines.columns if c not in ("order_id", detail_ts)]
    joined = interval_join(
        pay, lines, "order_id", "_pay_ts", detail_ts, PAY_LOWER, PAY_UPPER, carried
    ).withColumn("ts_ms", F.col("_pay_ms"))
    named = enrich(joined, small_side(dictionary), "payment_type_code", "dic_code", {"dic_name": "payment_type_name"}, "inner")
    return named.select(*PAYMENT_FACT)


def refund_fact(refunds: DataFrame, orders: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Refunds with the order's province and two labels of one dictionary (Q5)."""
    oi = orders.select(F.col("id").alias("_oid"), "province_id")
    joined = refunds.join(oi, F.col("order_id") == F.col("_oid")).withColumn("date_id", day_text("create_time"))
    renamed = joined.withColumnRenamed("refund_type", "refund_type_code").withColumnRenamed(
        "refund_reason_type", "refund_reason_type_code"
    )
    dictionary = small_side(dictionary)
    typed = enrich(renamed, dictionary, "refund_type_code", "dic_code", {"dic_name": "refund_type_name"}, "inner")
    reason = {"dic_name": "refund_reason_type_name"}
    return enrich(typed, dictionary, "refund_reason_type_code", "dic_code", reason, "inner").select(*REFUND_FACT)


def comment_fact(comments: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Comments with the label of their grade."""
    return enrich(comments, small_side(dictionary), "appraise", "dic_code", {"dic_name": "appraise_name"}, "inner").select(
        *COMMENT_FACT
    )


def order_header(orders: DataFrame) -> DataFrame:
    """Order header with its day and the slot of its time."""
    at = tolerant_timestamp("create_time")
    return orders.withColumn("date_id", day_text("create_time")).withColumn("pay_time_slot", time_slot(at))


def order_line(details: DataFrame) -> DataFrame:
    """P15."""
    return details.select("id", "order_id", "sku_id", "sku_name", "sku_num", "order_price", "split_total_amount", "ts_ms")


def order_profile(lines: DataFrame) -> DataFrame:
    """Order line for profiling, with time slot and price band."""
    return lines.select(
        F.col("user_id").alias("uid"),
        "create_time",
        "category1_name",
        "tm_name",
        "split_total_amount",
        time_slot(tolerant_timestamp("create_time")).alias("time_type"),
        price_band(F.col("split_total_amount").try_cast("decimal(18,2)")).alias("price_level"),
        "ts_ms",
    )
