"""Change events: parse, check, route and flatten."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.schemas import CDC, CDC_COLUMNS, CORRUPT

SNAPSHOT = ("r",)
# Changes whose ``after`` is what the row holds from then on.
ROW_IMAGES = ("r", "c", "u")


def parse_json(df: DataFrame, schema: T.StructType, value: str = "value", keep: list[str] = ()) -> DataFrame:
    """S3: typed columns of a JSON text column; unreadable text, blank text too, is kept in ``_corrupt_record``.

    The parsed row is unpacked by a generator: filters on its columns stay above it, so each text is parsed
    once however many of its fields are tested.
    """
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(value, full, {"columnNameOfCorruptRecord": CORRUPT, "mode": "PERMISSIVE"})
    blank = F.from_json(F.lit("{}"), full).withField(CORRUPT, F.col(value))
    row = F.when(F.col(value).rlike(r"\S"), parsed).otherwise(blank)
    return df.filter(F.col(value).isNotNull()).select(*keep, F.inline(F.array(row)))


def parse_cdc(df: DataFrame, value: str = "value", keep: list[str] = ()) -> DataFrame:
    """The envelope; null messages (tombstones, P3) are dropped."""
    return parse_json(df, CDC, value, keep)


def split_dirty(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable rows and the text of the rows that could not be read."""
    bad = F.col(CORRUPT).isNotNull()
    return parsed.filter(~bad).drop(CORRUPT), parsed.filter(bad).select(F.col(CORRUPT).alias("value"))


def valid_changes(parsed: DataFrame) -> DataFrame:
    """Readable and with an ``after`` image."""
    good, _ = split_dirty(parsed)
    return good.filter(F.col("after").isNotNull())


def of_table(changes: DataFrame, table: str, ops: tuple[str, ...] | None = None) -> DataFrame:
    """The change events of one source table (and ops); on landed events this prunes folders."""
    name = F.col("table") if "table" in changes.columns else F.col("source")["table"]
    wanted = changes.filter(name == table)
    return wanted.filter(F.col("op").isin(*ops)) if ops else wanted


def rows_of(
    changes: DataFrame, table: str, columns: list[str] | None = None, ops: tuple[str, ...] = ROW_IMAGES
) -> DataFrame:
    """P5: the named ``after`` fields of one table, with ``ts_ms``; ``ops=SNAPSHOT`` reads the first load only."""
    names = columns or CDC_COLUMNS[table]
    return of_table(changes, table, ops).select(*[F.col("after")[c].alias(c) for c in names], "ts_ms")


def image(before: str = "before", after: str = "after", op: str = "op") -> Column:
    """The row image of a change; deletes and empty ``after`` read ``before``."""
    gone = (F.col(op) == "d") | F.col(after).isNull() | (F.size(after) == 0)
    return F.when(gone, F.col(before)).otherwise(F.col(after))


def flatten_image(changes: DataFrame, columns: list[str]) -> DataFrame:
    """Named fields of the row image plus ``op`` and ``tm_ms``."""
    return changes.withColumn("_row", image()).select(
        F.col("op"), F.col("ts_ms").alias("tm_ms"), *[F.col("_row")[c].alias(c) for c in columns]
    )


def keep_fields(row: str, allowed: Column) -> Column:
    """Only the allowed keys of a row map."""
    return F.map_filter(row, lambda k, v: F.array_contains(allowed, k))


def cart_additions(changes: DataFrame) -> DataFrame:
    """Quantity added to a cart: all of a new row, the increase of an update; decreases are left out (Q6)."""
    after, before = F.col("after")["sku_num"].try_cast("int"), F.col("before")["sku_num"].try_cast("int")
    fresh = F.col("op").isin("r", "c")
    raised = F.col("op").isin("u", "update") & before.isNotNull() & (after > before)
    return (
        of_table(changes, "cart_info")
        .filter(fresh | raised)
        .select(
            *[F.col("after")[c].alias(c) for c in ("id", "user_id", "sku_id")],
            F.when(fresh, after).otherwise(after - before).alias("sku_num"),
            "ts_ms",
        )
    )


def comment_rows(changes: DataFrame) -> DataFrame:
    """Comments with their source columns; the nick name is read from ``after`` (Q17)."""
    number = lambda c: F.col("after")[c].try_cast("bigint").alias(c)
    return of_table(changes, "comment_info").filter(F.col("after").isNotNull()).select(
        "ts_ms",
        *[F.col("source")[c].alias(c) for c in ("db", "table", "server_id")],
        F.col("after")["appraise"].alias("appraise"),
        F.col("after")["comment_txt"].alias("comment_txt"),
        "op",
        F.col("after")["nick_name"].alias("nick_name"),
        *[number(c) for c in ("create_time", "user_id", "sku_id", "id", "spu_id", "order_id")],
    )


def envelope(
    table: Column | str,
    after: dict[str, Column] | None,
    before: dict[str, Column] | None = None,
    op: Column | str = "r",
    ts_ms: Column | int = 0,
    db: str = "shop",
) -> Column:
    """The change event of a row as JSON text: what a landed capture file holds."""

    def row(fields: dict[str, Column] | None) -> Column:
        if fields is None:
            return F.lit(None).cast("struct<id:string>")
        return F.struct(*[v.cast("string").alias(k) for k, v in fields.items()])

    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    source = F.struct(F.lit(db).alias("db"), lit(table).cast("string").alias("table"), F.lit("0").alias("server_id"))
    return F.to_json(
        F.struct(
            row(before).alias("before"),
            row(after).alias("after"),
            source.alias("source"),
            lit(op).cast("string").alias("op"),
            lit(ts_ms).cast("bigint").alias("ts_ms"),
        )
    )
