"""App and page logs: split, filter, project."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_TAGS = ("start", "page", "displays", "actions", "err")


def log_tags(value: str = "value", mode: str = "key") -> Column:
    """The outputs a log text belongs to; a log may belong to several.

    ``key`` asks for a non-null top-level key; ``substring`` for the word anywhere in the text (Q7).
    """
    if mode == "key":
        hits = [F.get_json_object(value, f"$.{t}").isNotNull() for t in LOG_TAGS]
    elif mode == "substring":
        hits = [F.contains(F.col(value), F.lit(t)) for t in LOG_TAGS]
    else:
        raise ValueError(f"mode must be key or substring, not {mode!r}")
    return F.array_compact(F.array(*[F.when(hit, t) for t, hit in zip(LOG_TAGS, hits)]))


def split_logs(df: DataFrame, value: str = "value", mode: str = "key") -> DataFrame:
    """One row per log and output, with the output's name in ``tag``; the input is read once."""
    return df.withColumn("tag", F.explode(log_tags(value, mode)))


def page_views(logs: DataFrame) -> DataFrame:
    """Flat page views of parsed logs, with the event time."""
    return logs.filter(F.col("page").isNotNull()).select(
        "common.*", "page.*", F.timestamp_millis("ts").alias("event_time"), "ts"
    )


def with_user_and_last_page(views: DataFrame) -> DataFrame:
    """A known user who came from another page."""
    return views.filter(F.col("uid").isNotNull() & F.col("last_page_id").isNotNull())


def on_pages(views: DataFrame, *pages: str) -> DataFrame:
    """P11."""
    return views.filter(F.col("page_id").isin(*pages))


def with_device(views: DataFrame, column: str = "mid") -> DataFrame:
    """Rows whose device (or user) is known and not empty."""
    return views.filter(F.col(column).isNotNull() & (F.col(column) != ""))


def searches(views: DataFrame) -> DataFrame:
    """Page views that a keyword search led to."""
    hit = (F.col("last_page_id") == "search") & (F.col("item_type") == "keyword") & F.col("item").isNotNull()
    return views.filter(hit).withColumnRenamed("item", "full_word")


def device_keywords(views: DataFrame) -> DataFrame:
    """Device columns and keyword of keyword views; the OS is reduced to its family."""
    return views.filter((F.col("item_type") == "keyword") & F.col("uid").isNotNull() & (F.col("uid") != "")).select(
        "uid", "ar", "ba", "ch", "md", F.split_part("os", F.lit(" "), F.lit(1)).alias("os"), "vc", "ts",
        F.col("item").alias("keyword"),
    )


def drop_common_fields(logs: DataFrame, *fields: str) -> DataFrame:
    """The rest of a nested record after some fields are removed."""
    return logs.withColumn("common", F.col("common").dropFields(*(fields or ("sid", "mid", "is_new"))))
