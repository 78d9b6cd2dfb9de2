"""Amount and profile-label functions: F4, F6, F8, F13, F16, F18."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tideline.functions.time import col

# Last month*100+day of each sign through the year; Capricorn also opens the year.
ZODIAC = [
    (119, "摩羯座"), (218, "水瓶座"), (320, "双鱼座"), (419, "白羊座"), (520, "金牛座"), (621, "双子座"),
    (722, "巨蟹座"), (822, "狮子座"), (922, "处女座"), (1023, "天秤座"), (1122, "天蝎座"), (1221, "射手座"),
    (1231, "摩羯座"),
]

# Upper amount (inclusive) and name; the last band is open.
PRICE_BANDS = [(1000, "低价商品"), (3000, "中价商品"), (None, "高价商品")]


def price_band(amount: Column | str) -> Column:
    """F4."""
    value = col(amount)
    (low, low_name), (mid, mid_name), (_, high_name) = PRICE_BANDS
    return F.when(value <= low, low_name).when(value <= mid, mid_name).when(value.isNotNull(), high_name)


def zodiac(birthday: Column | str) -> Column:
    """F6."""
    day = F.month(col(birthday)) * 100 + F.dayofmonth(col(birthday))
    sign = F.when(day <= ZODIAC[0][0], ZODIAC[0][1])
    for last, name in ZODIAC[1:]:
        sign = sign.when(day <= last, name)
    return sign


def gender_label(gender: Column | str) -> Column:
    """F8: a missing gender reads "home"."""
    return F.coalesce(col(gender), F.lit("home"))


def half_up(value: Column | str, digits: int = 3) -> Column:
    """half-up on a decimal, so 0.0045 does not depend on binary rounding."""
    return F.round(col(value).cast("decimal(20,10)"), digits)


def amount_product(quantity: Column | str, price: Column | str) -> Column:
    """F16: exact product of two money texts, as text with four digits; unreadable text gives null."""
    return (col(quantity).try_cast("decimal(16,2)") * col(price).try_cast("decimal(16,2)")).cast("string")


def money(value: Column | str, precision: int = 18) -> Column:
    return col(value).cast(f"decimal({precision},2)")
