"""User profile labels."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.time import age_years, decade, epoch_day
from tideline.functions.values import gender_label, zodiac
from tideline.operators.joins import interval_join

BODY_SPAN = timedelta(minutes=5)
SEARCH_SPAN = timedelta(days=3)
ORDER_SPAN = timedelta(days=10)


def basic_profile(users: DataFrame, as_of: Column) -> DataFrame:
    """P17 + F5-F9: user columns with birthday, age, decade, zodiac sign and gender."""
    born = users.withColumn("birthday", epoch_day("birthday"))
    return born.select(
        F.col("id").alias("uid"),
        F.col("name").alias("uname"),
        "user_level", "login_name", "phone_num", "email",
        gender_label("gender").alias("gender"),
        F.date_format("birthday", "yyyy-MM-dd").alias("birthday"),
        "ts_ms",
        decade("birthday").alias("decade"),
        age_years("birthday", as_of).alias("age"),
        zodiac("birthday").alias("zodiac_sign"),
    )


def body_profile(supplement: DataFrame) -> DataFrame:
    """Height and weight with their units."""
    return supplement.filter(F.col("uid").isNotNull() & (F.col("uid") != "")).select(
        "uid", "unit_height", F.col("create_ts").try_cast("bigint").alias("create_ts"), "weight", "unit_weight",
        "height", "ts_ms",
    )


def _by_uid(left: DataFrame, right: DataFrame, ts: str, span: timedelta, columns: list[str]) -> DataFrame:
    return interval_join(left, right, "uid", ts, ts, -span, span, columns)


def with_body(users: DataFrame, body: DataFrame, ts: str) -> DataFrame:
    """Height and weight recorded within five minutes of the user row."""
    return _by_uid(users, body, ts, BODY_SPAN, ["height", "unit_height", "weight", "unit_weight"])


def with_searches(users: DataFrame, scores: DataFrame, ts: str, columns: list[str]) -> DataFrame:
    """Device and search scores within three days."""
    return _by_uid(users, scores, ts, SEARCH_SPAN, columns)


def with_orders(users: DataFrame, orders: DataFrame, ts: str, columns: list[str]) -> DataFrame:
    """Order scores within ten days."""
    return _by_uid(users, orders, ts, ORDER_SPAN, columns)
