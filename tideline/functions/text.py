"""Text, key and codec functions: F17, F22-F26, F28, F29 and the tokenizers of U1."""

from __future__ import annotations

import sys
from collections.abc import Iterable
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.time import col

# Addresses that hold so many rows that each has a bucket of its own.
HOT_BUCKETS = {
    "0x0000000000000000000000000000000000000000": "9001",
    "0xdac17f958d2ee523a2206206994597c13d831ec7": "9002",
    "0x7a250d5630b4cf539739df2c5dacb4c659f2488d": "9003",
    "0xea674fdde714fd979de3edf0f56aa9716b898ec8": "9004",
    "0xc02aaa39b223fe8d0a0e5c4f27ead9083c756cc2": "9005",
    "0x0000000000000000000000000000000000000001": "9006",
    "0xa0b86991c6218b36c1d19d4a2e9eb0ce3606eb48": "9007",
}

# Fixed value: the characters a valid comment may hold.
VALID_TEXT = (
    "^[一-龥a-zA-Z0-9\\[\\]\\-_+{}:：“<>`?!——+·~@#$%^&*(、，。；‘【】！@#￥%……&*（）)\"]+\\z"
)

WORD = r"[\p{L}\p{N}]+"


def hash_bucket(value: Column | str, buckets: int = 128, hot: dict[str, str] | None = None) -> Column:
    """four-digit bucket from the last three md5 digits; hot values keep their own bucket."""
    text = col(value).cast("string")
    number = F.conv(F.right(F.md5(text), F.lit(3)), 16, 10).cast("int") % buckets
    bucket = F.lpad(number.cast("string"), 4, "0")
    if not hot:
        return bucket
    table = F.create_map(*[F.lit(x) for pair in hot.items() for x in pair])
    return F.coalesce(F.element_at(table, F.lower(text)), bucket)


def row_key(fields: Iterable[str | tuple[str, bool]], separator: str = "", whole_md5: bool = False) -> Column:
    """ordered fields joined by a separator, md5 per field or over the whole key."""
    parts = []
    for field in fields:
        name, digest = field if isinstance(field, tuple) else (field, False)
        text = F.col(name).cast("string")
        parts.append(F.md5(text) if digest else text)
    key = F.concat_ws(separator, *parts)
    return F.md5(key) if whole_md5 else key


# Hexadecimal, or decimal with an exponent of at most four digits.
NUMBER = r"^(0x[0-9a-fA-F]+|[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]{1,4})?)$"
PLAIN = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?$"


@F.pandas_udf(T.StringType())
def _expanded(values: pd.Series) -> pd.Series:
    sys.set_int_max_str_digits(0)  # numbers of any length
    return values.map(lambda v: None if v is None else str(int(v, 16)) if v.startswith("0x") else format(Decimal(v), "f"))


def plain_decimal(value: Column | str, divide: bool = False) -> Column:
    """hex (0x...) or decimal text of any length as plain decimal text, optionally divided by 10^18; null -> "0".

    Text that is no number gives null. Text that is plain already stays as it is, all other goes through integers and
    decimals of arbitrary precision in Arrow batches.
    """
    text = col(value).cast("string")
    number = F.when(text.rlike(NUMBER), text)
    whole = F.when(number.rlike(PLAIN), number).otherwise(_expanded(F.when(~number.rlike(PLAIN), number)))
    bad = text.isNotNull() & whole.isNull()
    if not divide:
        return F.when(~bad, F.coalesce(whole, F.lit("0")))
    sign = F.when(whole.startswith("-"), "-").otherwise("")
    magnitude = F.regexp_replace(whole, "^[-+]", "")
    units = F.split_part(magnitude, F.lit("."), F.lit(1))
    tail = F.split_part(magnitude, F.lit("."), F.lit(2))
    padded = F.when(F.length(units) < 19, F.lpad(units, 19, "0")).otherwise(units)
    cut = F.length(padded) - 18
    fraction = F.rtrim(F.concat(padded.substr(cut + 1, F.lit(18)), tail), F.lit("0"))
    head = F.regexp_replace(padded.substr(F.lit(1), cut), "^0+(?=[0-9])", "")
    divided = F.concat(sign, head, F.when(fraction != "", F.concat(F.lit("."), fraction)).otherwise(""))
    return F.when(~bad, F.coalesce(divided, F.lit("0")))


def hex_chunks(payload: Column | str, width: int = 64) -> Column:
    """the 0x payload cut into 0x-prefixed words of a fixed width; a shorter rest is left out."""
    text = col(payload).cast("string")
    count = F.floor((F.length(text) - 2) / width).cast("int")
    steps = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.transform(steps, lambda i: F.concat(F.lit("0x"), text.substr((i - 1) * width + 3, F.lit(width))))


def json_list_append(items: Column | str, element: Column | str) -> Column:
    """JSON list text with one element more; null text starts a new list."""
    parsed = F.from_json(F.coalesce(col(items), F.lit("[]")), "array<string>")
    return F.to_json(F.array_append(F.coalesce(parsed, F.array().cast("array<string>")), col(element)))


def is_valid_text(text: Column | str) -> Column:
    """not empty and only listed characters."""
    return col(text).rlike(VALID_TEXT)


def join_list(items: Column | str, delimiter: str = ", ") -> Column:
    """list as delimited text."""
    return F.array_join(col(items), delimiter)


def first_upper(text: Column | str) -> Column:
    return F.concat(F.upper(F.left(col(text), F.lit(1))), col(text).substr(2, 1 << 30))


def first_lower(text: Column | str) -> Column:
    return F.concat(F.lower(F.left(col(text), F.lit(1))), col(text).substr(2, 1 << 30))


def zeros(count: Column | int) -> Column:
    return F.repeat(F.lit("0"), count if isinstance(count, Column) else F.lit(count))


def is_empty(text: Column | str) -> Column:
    return col(text).isNull() | (col(text) == "")


def is_blank(text: Column | str) -> Column:
    return col(text).isNull() | ~col(text).rlike(r"[^\x00-\x20]")


def camel_name(name: str) -> str:
    """snake_case column name as camelCase."""
    head, *rest = name.lower().split("_")
    return head + "".join(part[:1].upper() + part[1:] for part in rest)


def words(text: Column | str) -> Column:
    """U1 default: runs of letters and digits, lower case, in text order."""
    return F.regexp_extract_all(F.lower(col(text)), F.lit(WORD), F.lit(0))


def dictionary_words(text: Column | str, dictionary: Iterable[str]) -> Column:
    """U1 for unspaced scripts: longest dictionary match from the left, single characters otherwise.

    Runs in Arrow batches; the dictionary travels with the function, so keep it a bounded word list.
    """
    known = frozenset(w.lower() for w in dictionary if w)
    longest = max(map(len, known), default=1)

    def cut(run: str) -> list[str]:
        out, at = [], 0
        while at < len(run):
            size = next((n for n in range(min(longest, len(run) - at), 1, -1) if run[at : at + n] in known), 1)
            out.append(run[at : at + size])
            at += size
        return out

    @F.pandas_udf("array<string>")
    def segment(runs: pd.Series) -> pd.Series:
        return runs.map(lambda rs: None if rs is None else [w for r in rs for w in (cut(r) if not r.isascii() else [r])])

    return segment(words(text))
