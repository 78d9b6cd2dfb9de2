"""Age-band scores of a user's device, searches and orders, and the inferred band."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.time import TIME_SLOTS, col
from tideline.operators.joins import enrich

BANDS = ["18-24", "25-29", "30-34", "35-39", "40-49", "50"]
SCORES = "array<decimal(20,6)>"

# Weight per age band, before the rate of the source.
DEVICE_WEIGHTS = {
    "iOS": [0.7, 0.6, 0.5, 0.4, 0.3, 0.2],
    "Android": [0.8, 0.7, 0.6, 0.5, 0.4, 0.3],
}
SEARCH_WEIGHTS = {
    "时尚与潮流": [0.9, 0.7, 0.5, 0.3, 0.2, 0.1],
    "性价比": [0.2, 0.4, 0.6, 0.7, 0.8, 0.8],
    "健康与养生": [0.1, 0.2, 0.4, 0.6, 0.8, 0.7],
    "家庭与育儿": [0.1, 0.2, 0.4, 0.6, 0.8, 0.7],
    "科技与数码": [0.8, 0.6, 0.4, 0.3, 0.2, 0.1],
    "学习与发展": [0.4, 0.5, 0.6, 0.7, 0.8, 0.7],
}
TIME_WEIGHTS = {
    "凌晨": [0.2, 0.1, 0.1, 0.1, 0.1, 0.1],
    "早晨": [0.1, 0.1, 0.1, 0.1, 0.2, 0.3],
    "上午": [0.2, 0.2, 0.2, 0.2, 0.3, 0.4],
    "中午": [0.4, 0.4, 0.4, 0.4, 0.4, 0.3],
    "下午": [0.4, 0.5, 0.5, 0.5, 0.5, 0.4],
    "晚上": [0.8, 0.7, 0.6, 0.5, 0.4, 0.3],
    "夜间": [0.9, 0.7, 0.5, 0.3, 0.2, 0.1],
}
AMOUNT_WEIGHTS = {
    "low": [0.8, 0.6, 0.4, 0.3, 0.2, 0.1],
    "middle": [0.2, 0.4, 0.6, 0.7, 0.8, 0.7],
    "high": [0.1, 0.2, 0.3, 0.4, 0.5, 0.6],
}
BRAND_WEIGHTS = {
    "TCL": [0.2, 0.3, 0.4, 0.5, 0.6, 0.7],
    "苹果": [0.9, 0.8, 0.7, 0.7, 0.7, 0.5],
    "联想": [0.9, 0.8, 0.7, 0.7, 0.7, 0.5],
    "小米": [0.9, 0.8, 0.7, 0.7, 0.7, 0.5],
    "欧莱雅": [0.5, 0.6, 0.8, 0.8, 0.9, 0.2],
    "香奈儿": [0.3, 0.4, 0.6, 0.8, 0.9, 0.2],
}
OTHER_BRAND_WEIGHTS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6]
DEFAULT_BRAND = "香奈儿"

# Rate per source, and the shares of the weighted inference.
DEVICE_RATE, SEARCH_RATE, TIME_RATE, AMOUNT_RATE, BRAND_RATE = "0.1", "0.15", "0.1", "0.1", "0.2"
SHARES = {"category": "0.3", "brand": "0.2", "time": "0.15", "price": "0.1", "device": "1", "keyword": "1"}
AMOUNT_LIMITS = (1000, 4000)

NO_SCORES = [0.0] * len(BANDS)


def _scores_sql(weights: list[float], rate: str) -> str:
    """weight x rate, half-up to three digits, exact in decimal."""
    exact = [(Decimal(str(w)) * Decimal(rate)).quantize(Decimal("0.001"), "ROUND_HALF_UP") for w in weights]
    return f"cast(array({', '.join(f'{x}BD' for x in exact)}) as {SCORES})"


def scores_by_label(
    label: Column | str, weights: dict[str, list[float]], rate: str, default: list[float] | None = None
) -> Column:
    """Score vector of a label; the weight table is part of the expression, so nothing is joined."""
    value = col(label)
    table = F.create_map(*[x for k, w in weights.items() for x in (F.lit(k), F.expr(_scores_sql(w, rate)))])
    found = F.element_at(table, value)
    if default is None:
        return found
    return F.when(value.isNotNull() & (value != ""), F.coalesce(found, F.expr(_scores_sql(default, rate))))


def device_scores(os: Column | str, rate: str = DEVICE_RATE) -> Column:
    """by the first OS family of the sorted list."""
    return scores_by_label(F.split_part(col(os), F.lit(","), F.lit(1)), DEVICE_WEIGHTS, rate)


def search_scores(search_category: Column | str, rate: str = SEARCH_RATE) -> Column:
    """an unknown or missing search category scores 0."""
    known = scores_by_label(search_category, SEARCH_WEIGHTS, rate)
    return F.coalesce(known, F.expr(_scores_sql(NO_SCORES, rate)))


def with_search_category(
    df: DataFrame, keyword: str, categories: DataFrame, compare: DataFrame
) -> DataFrame:
    """F11 lookups: keyword -> first-level category -> search category, both optional."""
    tree = categories.groupBy("b3name").agg(F.min("b1name").alias("b1_category"))
    first = enrich(df, tree, keyword, "b3name", {"b1_category": "b1_category"}, "left")
    target = compare.groupBy("category_name").agg(F.min("search_category").alias("search_category"))
    return enrich(
        first, target, "b1_category", "category_name", {"search_category": "search_category"}, "left",
        {"search_category": "unknown"},
    )


def time_scores(slot: Column | str, rate: str = TIME_RATE) -> Column:
    return scores_by_label(slot, TIME_WEIGHTS, rate)


def amount_label(amount: Column | str) -> Column:
    """1000 belongs to the middle band (Q15)."""
    low, high = AMOUNT_LIMITS
    value = col(amount)
    return F.when(value < low, "low").when(value < high, "middle").when(value.isNotNull(), "high")


def amount_scores(amount: Column | str, rate: str = AMOUNT_RATE) -> Column:
    return scores_by_label(amount_label(amount), AMOUNT_WEIGHTS, rate)


def brand_scores(brand: Column | str, rate: str = BRAND_RATE) -> Column:
    return scores_by_label(brand, BRAND_WEIGHTS, rate, OTHER_BRAND_WEIGHTS)


def weight_lookup(df: DataFrame, label: str, weights: DataFrame, out: str, default_label: str | None = None) -> DataFrame:
    """Band map of a label from a weight table; unknown labels may read a default label's row."""
    value = F.col("_known") if default_label else F.col(label)
    source = df
    if default_label:
        known = weights.select(F.col("label").alias("_label")).distinct()
        source = df.join(known, F.col(label) == F.col("_label"), "left").withColumn(
            "_known", F.coalesce("_label", F.lit(default_label))
        ).drop("_label")
    side = weights.select(F.col("label").alias("_w_label"), F.col("bands").alias(out))
    return source.join(side, value == F.col("_w_label"), "left").drop("_w_label", "_known")


def brand_weight_lookup(df: DataFrame, brand: str, weights: DataFrame, out: str = "tm_code") -> DataFrame:
    """J18 for brands: an unknown brand reads the weights of the default brand."""
    return weight_lookup(df, brand, weights, out, DEFAULT_BRAND)


def band_columns(scores: Column | str, prefix: str) -> list[Column]:
    """The score vector as one column per band."""
    return [
        F.element_at(col(scores), i + 1).cast("double").alias(f"{prefix}_{band.replace('-', '_')}")
        for i, band in enumerate(BANDS)
    ]


def score_vector(columns: list[str]) -> Column:
    """band columns as a vector, missing -> 0."""
    return F.array(*[F.coalesce(F.col(c).try_cast("decimal(20,6)"), F.lit(Decimal("0"))) for c in columns]).cast(SCORES)


def total_scores(parts: dict[str, str], shares: dict[str, str] | None = None) -> Column:
    """sum per band of the named score columns; ``shares`` weights the parts, a missing part counts 0."""
    share = lambda name: f" * {shares[name]}BD" if shares else ""
    band = lambda i: " + ".join(f"coalesce(element_at(`{c}`, {i}), 0BD){share(n)}" for n, c in parts.items())
    totals = ", ".join(f"cast({band(i + 1)} as decimal(20,9))" for i in range(len(BANDS)))
    return F.expr(f"array({totals})")


def common_bands(bands: Column | str) -> Column:
    """Q16: one spelling of the bands, whether a map says 18_24, 18-24 or 50以上."""
    return F.transform_keys(col(bands), lambda band, _: F.rtrim(F.translate(band, "_", "-"), F.lit("以上")))


def vector_bands(scores: Column | str) -> Column:
    """A score vector as a map per band, as weight files give them."""
    return F.map_from_arrays(F.array(*[F.lit(b) for b in BANDS]), col(scores))


def merged_bands(parts: dict[str, Column | str], shares: dict[str, str] | None = None) -> Column:
    """F14 over maps (J18): each band's sum over the parts; ``shares`` weights the parts.

    A missing part, band or weight counts 0, and a part may have bands that another lacks.
    """
    zero, exact = F.lit(Decimal("0")), "decimal(20,9)"

    def weighted(name: str, bands: Column | str) -> Column:
        share = F.lit(Decimal(shares[name])) if shares else F.lit(Decimal("1"))
        known = F.coalesce(common_bands(bands).cast("map<string,decimal(20,6)>"), F.create_map().cast("map<string,decimal(20,6)>"))
        return F.transform_values(known, lambda _, weight: (F.coalesce(weight, zero) * share).cast(exact))

    def add(left: Column, right: Column) -> Column:
        return F.map_zip_with(left, right, lambda _, a, b: (F.coalesce(a, zero) + F.coalesce(b, zero)).cast(exact))

    return reduce(add, [weighted(n, c) for n, c in parts.items()])


def band_totals(bands: Column | str) -> Column:
    """The totals of a map in the order of the bands."""
    return F.array(*[F.coalesce(F.element_at(col(bands), b), F.lit(Decimal("0"))) for b in BANDS])


def inferred_band(totals: Column | str) -> Column:
    """the first band with the highest total."""
    vector = col(totals)
    names = F.array(*[F.lit(b) for b in BANDS])
    return F.element_at(names, F.array_position(vector, F.array_max(vector)).cast("int"))


assert list(TIME_WEIGHTS) == [name for _, name in TIME_SLOTS]
