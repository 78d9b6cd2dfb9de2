"""User profile queries: F3-F15, P17, J12-J14, J18, A9, S11."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.time import time_slot
from tideline.functions.values import price_band
from tideline.operators import profile, scoring
from tideline.operators.dedup import last_per_window
from tideline.operators.metrics import user_value_sets
from tideline.plans.inputs import VIEWS, page_views, table
from tideline.plans.registry import query
from tideline.plans.trade import SLOT_SQL
from tideline.session import scratch
from tideline.sources.readers import weight_table

BANDS = [b.replace("-", "_") for b in scoring.BANDS]

# --- basic labels -----------------------------------------------------------------------------------

BIRTHDAY = "DATE '1970-01-01' + CAST(c_custkey * 37 % 14000 AS INT)"
ZODIAC_SQL = """CASE WHEN md <= 119 THEN '摩羯座' WHEN md <= 218 THEN '水瓶座' WHEN md <= 320 THEN '双鱼座'
  WHEN md <= 419 THEN '白羊座' WHEN md <= 520 THEN '金牛座' WHEN md <= 621 THEN '双子座' WHEN md <= 722 THEN '巨蟹座'
  WHEN md <= 822 THEN '狮子座' WHEN md <= 922 THEN '处女座' WHEN md <= 1023 THEN '天秤座' WHEN md <= 1122 THEN '天蝎座'
  WHEN md <= 1221 THEN '射手座' ELSE '摩羯座' END"""
USER_TS_SQL = "1704067200000 + (c_custkey % 10) * 86400000 + (c_custkey % 1440) * 60000"


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("user_level"),
        F.concat(F.lit("login"), key.cast("string")).alias("login_name"), F.lit(None).cast("string").alias("phone_num"),
        F.concat("c_name", F.lit("@example.com")).alias("email"),
        F.when(key % 3 == 0, None).when(key % 3 == 1, "M").otherwise("F").alias("gender"),
        (key * 37 % 14000).alias("birthday"),
        (F.lit(1_704_067_200_000) + key % 10 * 86_400_000 + key % 1440 * 60_000).alias("ts_ms"),
    )


@query(
    "profile_basic",
    f"""
    SELECT CAST(c_custkey AS VARCHAR) AS uid, c_name AS uname, c_mktsegment AS user_level, 'login' || c_custkey AS login_name,
      NULL AS phone_num, c_name || '@example.com' AS email, CASE c_custkey % 3 WHEN 0 THEN 'home' WHEN 1 THEN 'M' ELSE 'F' END AS gender,
      strftime(b, '%Y-%m-%d') AS birthday, {USER_TS_SQL} AS ts_ms, year(b) // 10 * 10 AS decade,
      2025 - year(b) - CASE WHEN 228 < md THEN 1 ELSE 0 END AS age, {ZODIAC_SQL} AS zodiac_sign
    FROM (SELECT *, month(b) * 100 + day(b) AS md FROM (SELECT *, {BIRTHDAY} AS b FROM customer))
    """,
)
def profile_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.basic_profile(users(spark, sf_dir), F.lit("2025-02-28").cast("date"))


@query(
    "profile_body",
    f"""
    SELECT CAST(c_custkey AS VARCHAR) AS uid, c_name AS uname, {USER_TS_SQL} AS ts_ms,
      CAST(150 + c_custkey % 50 AS VARCHAR) AS height, 'cm' AS unit_height, CAST(40 + c_custkey % 60 AS VARCHAR) AS weight,
      'kg' AS unit_weight
    FROM customer WHERE abs(c_custkey % 13 - 6) <= 5
    """,
)
def profile_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Height and weight are recorded up to six minutes before or after the user row."""
    base = users(spark, sf_dir)
    timed = profile.basic_profile(base, F.lit("2025-02-28").cast("date")).withColumn("event_time", F.timestamp_millis("ts_ms"))
    number = F.col("id").cast("bigint")
    recorded = F.col("ts_ms") + (number % 13 - 6) * 60_000
    supplement = base.select(
        F.col("id").alias("uid"), (150 + number % 50).cast("string").alias("height"), F.lit("cm").alias("unit_height"),
        (40 + number % 60).cast("string").alias("weight"), F.lit("kg").alias("unit_weight"),
        recorded.alias("create_ts"), recorded.alias("ts_ms"),
    )
    body = profile.body_profile(supplement).withColumn("event_time", F.timestamp_millis("ts_ms"))
    return profile.with_body(timed, body, "event_time").select(
        "uid", "uname", "ts_ms", "height", "unit_height", "weight", "unit_weight"
    )


# --- slots, bands and scores ------------------------------------------------------------------------


@query("time_slot", f"SELECT event_id, {SLOT_SQL} AS slot FROM (SELECT *, hour(ts) AS h FROM events)")
def time_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", time_slot("ts").alias("slot"))


@query(
    "price_band",
    """
    SELECT o_orderkey, CASE WHEN p <= 1000 THEN '低价商品' WHEN p <= 3000 THEN '中价商品' ELSE '高价商品' END AS band
    FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) % 4000 AS p FROM orders)
    """,
)
def price_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.col("o_totalprice").cast("decimal(18,2)") % F.lit(4000).cast("decimal(18,2)")
    return table(spark, sf_dir, "orders").select("o_orderkey", price_band(amount).alias("band"))


def _weights_sql(label: str, tables: dict[str, list[float]], rate: str, default: list[float] | None) -> str:
    """One CASE per band, stating the weight tables in SQL."""
    out = []
    for i, band in enumerate(BANDS):
        cases = " ".join(f"WHEN {label} = '{k}' THEN round({w[i]} * {rate}, 3)" for k, w in tables.items())
        rest = f"ELSE round({default[i]} * {rate}, 3)" if default else ""
        out.append(f"CAST(CASE WHEN {label} IS NULL OR {label} = '' THEN NULL {cases} {rest} END AS DOUBLE) AS {{p}}_{band}")
    return ", ".join(out)


@query(
    "score_device",
    f"SELECT event_id, os, {_weights_sql('family', scoring.DEVICE_WEIGHTS, '0.1', None).replace('{p}', 'device')} "
    f"FROM (SELECT *, split_part(os, ' ', 1) AS family FROM ({VIEWS}))",
)
def score_device(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = page_views(spark, sf_dir)
    scored = views.withColumn("_s", scoring.device_scores(F.split_part("os", F.lit(" "), F.lit(1))))
    return scored.select("event_id", "os", *scoring.band_columns("_s", "device"))


# Search category of each first-level category of the fixture tree; 'c5' has none.
SEARCH_OF = {"c0": "时尚与潮流", "c1": "性价比", "c2": "健康与养生", "c3": "家庭与育儿", "c4": "科技与数码", "c6": "学习与发展"}
SEARCH_SQL = f"""
SELECT v.*, b1_category, coalesce(search_category, 'unknown') AS search_category FROM ({VIEWS}) v
LEFT JOIN (SELECT DISTINCT 'red Word' || p_size AS word, 'c' || (p_size % 7) AS b1_category FROM part) c ON v.item = c.word
LEFT JOIN (VALUES {', '.join(f"('{k}', '{v}')" for k, v in SEARCH_OF.items())}) m(cat, search_category) ON b1_category = m.cat
"""


def searched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views with the category of their item: the tree comes from part sizes, which no item 0 has."""
    size = F.col("p_size")
    tree = table(spark, sf_dir, "part").select(
        F.concat(F.lit("red Word"), size.cast("string")).alias("b3name"), F.concat(F.lit("c"), (size % 7).cast("string")).alias("b1name")
    ).distinct()
    names = F.create_map(*[F.lit(x) for p in SEARCH_OF.items() for x in p])
    compare = tree.select(F.col("b1name").alias("category_name"), names[F.col("b1name")].alias("search_category")).distinct()
    return scoring.with_search_category(page_views(spark, sf_dir), "item", tree, compare.filter(F.col("search_category").isNotNull()))


@query(
    "score_search",
    f"SELECT event_id, search_category, "
    f"{_weights_sql('search_category', scoring.SEARCH_WEIGHTS, '0.15', [0.0] * 6).replace('{p}', 'search')} FROM ({SEARCH_SQL})",
)
def score_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = searched(spark, sf_dir).withColumn("_s", scoring.search_scores("search_category"))
    return scored.select("event_id", "search_category", *scoring.band_columns("_s", "search"))


@query(
    "score_time",
    f"SELECT event_id, slot, {_weights_sql('slot', scoring.TIME_WEIGHTS, '0.1', None).replace('{p}', 'pay_time')} "
    f"FROM (SELECT *, {SLOT_SQL} AS slot FROM (SELECT *, hour(ts) AS h FROM events))",
)
def score_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = time_slots(spark, sf_dir).withColumn("_s", scoring.time_scores("slot"))
    return slots.select("event_id", "slot", *scoring.band_columns("_s", "pay_time"))


@query(
    "score_amount",
    f"SELECT o_orderkey, {_weights_sql('label', scoring.AMOUNT_WEIGHTS, '0.1', None).replace('{p}', 'amount')} FROM ("
    "SELECT o_orderkey, CASE WHEN p < 1000 THEN 'low' WHEN p < 4000 THEN 'middle' ELSE 'high' END AS label "
    "FROM (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) % 6000 AS p FROM orders))",
)
def score_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.col("o_totalprice").cast("decimal(18,2)") % F.lit(6000).cast("decimal(18,2)")
    scored = table(spark, sf_dir, "orders").select("o_orderkey", scoring.amount_scores(amount).alias("_s"))
    return scored.select("o_orderkey", *scoring.band_columns("_s", "amount"))


BRAND_NAMES = ["TCL", "苹果", "联想", "小米", "欧莱雅", "香奈儿", "other", ""]
BRAND_SQL = "[" + ", ".join(f"'{b}'" for b in BRAND_NAMES) + f"][p_partkey % {len(BRAND_NAMES)} + 1]"


@query(
    "score_brand",
    f"SELECT p_partkey, brand, "
    f"{_weights_sql('brand', scoring.BRAND_WEIGHTS, '0.2', scoring.OTHER_BRAND_WEIGHTS).replace('{p}', 'tname')} "
    f"FROM (SELECT *, {BRAND_SQL} AS brand FROM part)",
)
def score_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*[F.lit(b) for b in BRAND_NAMES])
    brand = F.element_at(names, (F.col("p_partkey") % len(BRAND_NAMES) + 1).cast("int"))
    scored = table(spark, sf_dir, "part").select("p_partkey", brand.alias("brand")).withColumn("_s", scoring.brand_scores("brand"))
    return scored.select("p_partkey", "brand", *scoring.band_columns("_s", "tname"))


def written_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A weight file written from the brands of part, read back."""
    brands = table(spark, sf_dir, "part").groupBy("p_brand").agg(
        F.count("*").alias("n"), F.max("p_size").alias("m")
    )
    bands = F.create_map(*[x for i, b in enumerate(scoring.BANDS) for x in (F.lit(b), ((F.col("m") + i) / 100).cast("double"))])
    path = scratch(spark, "weights")
    brands.select(F.to_json(F.create_map("p_brand", bands)).alias("value")).write.text(path)
    return weight_table(spark, path)


@query(
    "read_weight_file",
    "SELECT p_brand AS label, CAST((max(p_size)) / 100 AS DOUBLE) AS first, CAST((max(p_size) + 5) / 100 AS DOUBLE) AS last "
    "FROM part GROUP BY p_brand",
)
def read_weight_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written_weights(spark, sf_dir).select(
        "label", F.col("bands")["18-24"].alias("first"), F.col("bands")["50"].alias("last")
    )


@query(
    "weight_default",
    """
    WITH w AS (SELECT p_brand AS label, max(p_size) / 100 AS first FROM part GROUP BY p_brand),
    sold AS (SELECT p_partkey, CASE WHEN p_partkey % 6 = 1 THEN 'no ' ELSE '' END || p_brand AS brand FROM part)
    SELECT p_partkey, brand, CAST(coalesce(w.first, d.first) AS DOUBLE) AS first
    FROM sold LEFT JOIN w ON brand = w.label, (SELECT first FROM w WHERE label = 'Brand#1') d
    """,
)
def weight_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An unknown brand reads the default brand's weights."""
    brand = F.concat(F.when(F.col("p_partkey") % 6 == 1, "no ").otherwise(""), "p_brand").alias("brand")
    part = table(spark, sf_dir, "part").select("p_partkey", brand)
    looked_up = scoring.weight_lookup(part, "brand", written_weights(spark, sf_dir), "bands", "Brand#1")
    return looked_up.select("p_partkey", "brand", F.col("bands")["18-24"].alias("first"))


# --- inference --------------------------------------------------------------------------------------


def _dec(sql: str) -> str:
    return f"CAST({sql} AS DECIMAL(18,6))"


def _case(label: str, tables: dict[str, list[float]], rate: str, i: int, default: list[float] | None = None) -> str:
    cases = " ".join(f"WHEN {label} = '{k}' THEN {_dec(f'round({w[i]} * {rate}, 3)')}" for k, w in tables.items())
    rest = _dec(f"round({default[i]} * {rate}, 3)") if default else "0"
    return f"coalesce(CASE {cases} ELSE {rest} END, 0)"


def _arg_max(totals: list[str]) -> str:
    best = f"greatest({', '.join(totals)})"
    return "CASE " + " ".join(f"WHEN {t} = {best} THEN '{b}'" for t, b in zip(totals, scoring.BANDS)) + " END"


LABEL_SQL = "CASE WHEN amount < 1000 THEN 'low' WHEN amount < 4000 THEN 'middle' ELSE 'high' END"
BRAND_OF_SKU = BRAND_SQL.replace("p_partkey", "l_partkey")
ORDER_ROWS = f"""
SELECT o_custkey AS uid, l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(18,2)) % 6000 AS amount,
  {BRAND_OF_SKU} AS brand, {SLOT_SQL} AS slot, ms FROM lineitem
JOIN (SELECT o_orderkey, o_custkey, o_orderkey % 24 AS h, 1704067200000 + (o_orderkey % 30) * 86400000 + (o_orderkey % 24) * 3600000 AS ms FROM orders)
  ON l_orderkey = o_orderkey
"""
LAST_ORDERS = f"""
SELECT * FROM ({ORDER_ROWS}) QUALIFY row_number() OVER (PARTITION BY uid, ms // 86400000
  ORDER BY ms DESC, l_orderkey DESC, l_linenumber DESC, amount DESC, brand DESC) = 1
"""
LAST_SEARCHES = f"""
SELECT CAST(uid AS BIGINT) AS uid, split_part(os, ' ', 1) AS family, search_category, ts FROM ({SEARCH_SQL})
WHERE uid IS NOT NULL AND item_type = 'keyword'
QUALIFY row_number() OVER (PARTITION BY uid, ts // 86400000 ORDER BY ts DESC, event_id DESC) = 1
"""


def order_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last order line per user and day with time, amount and brand scores."""
    key = F.col("o_orderkey")
    placed = F.lit(1_704_067_200_000) + key % 30 * 86_400_000 + key % 24 * 3_600_000
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.timestamp_millis(placed).alias("event_time"))
    names = F.array(*[F.lit(b) for b in BRAND_NAMES])
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.col("l_extendedprice").cast("decimal(18,2)") % F.lit(6000).cast("decimal(18,2)")).alias("amount"),
        F.element_at(names, (F.col("l_partkey") % len(BRAND_NAMES) + 1).cast("int")).alias("brand"),
    )
    rows = lines.join(orders, F.col("l_orderkey") == key).withColumn("uid", F.col("o_custkey").cast("string"))
    rows = rows.select("uid", "event_time", "l_orderkey", "l_linenumber", "amount", "brand")
    last = last_per_window(rows, ["uid"], "event_time", "1 day", ["event_time", "l_orderkey", "l_linenumber", "amount", "brand"])
    return last.select(
        "uid", "event_time", F.col("l_orderkey").alias("order_id"), "brand", time_slot("event_time").alias("slot"),
        scoring.time_scores(time_slot("event_time")).alias("time_score"),
        scoring.amount_scores("amount").alias("amount_score"),
        scoring.brand_scores("brand").alias("brand_score"),
    )


def search_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last keyword view per user and day with device and search scores."""
    views = searched(spark, sf_dir).filter(F.col("uid").isNotNull() & (F.col("item_type") == "keyword"))
    rows = views.select("uid", "event_time", "ts", "event_id", "os", "search_category")
    last = last_per_window(rows, ["uid"], "event_time", "1 day", ["ts", "event_id"])
    return last.select(
        "uid", "event_time", F.col("ts").alias("search_ms"),
        scoring.device_scores(F.split_part("os", F.lit(" "), F.lit(1))).alias("device_score"),
        scoring.search_scores("search_category").alias("search_score"),
    )


def user_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users(spark, sf_dir).select(F.col("id").alias("uid"), "ts_ms", F.timestamp_millis("ts_ms").alias("event_time"))


PROFILE_SQL = f"""
SELECT c.uid, c.ts_ms, s.ts AS search_ms, s.family, s.search_category FROM (SELECT c_custkey AS uid, {USER_TS_SQL} AS ts_ms FROM customer) c
JOIN ({LAST_SEARCHES}) s ON c.uid = s.uid AND abs(s.ts - c.ts_ms) <= 3 * 86400000
"""


@query(
    "profile_search",
    f"""
    SELECT CAST(uid AS VARCHAR) AS uid, ts_ms, search_ms, {', '.join(
      f"CAST({_case('family', scoring.DEVICE_WEIGHTS, '0.1', i)} AS DOUBLE) AS device_{b}" for i, b in enumerate(BANDS))}
    FROM ({PROFILE_SQL})
    """,
)
def profile_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J13."""
    joined = profile.with_searches(
        user_times(spark, sf_dir), search_scores(spark, sf_dir), "event_time", ["device_score", "search_score", "search_ms"]
    )
    return joined.select("uid", "ts_ms", "search_ms", *scoring.band_columns("device_score", "device"))


def _totals(shares: dict[str, str] | None) -> list[str]:
    share = lambda name: shares[name] if shares else "1"
    return [
        " + ".join(
            [
                f"{_case('search_category', scoring.SEARCH_WEIGHTS, '0.15', i)} * {share('category')}",
                f"{_case('family', scoring.DEVICE_WEIGHTS, '0.1', i)} * {share('device')}",
                f"{_case('slot', scoring.TIME_WEIGHTS, '0.1', i)} * {share('time')}",
                f"{_case('label', scoring.AMOUNT_WEIGHTS, '0.1', i)} * {share('price')}",
                f"CASE WHEN brand = '' THEN 0 ELSE {_case('brand', scoring.BRAND_WEIGHTS, '0.2', i, scoring.OTHER_BRAND_WEIGHTS)} END * {share('brand')}",
            ]
        )
        for i in range(6)
    ]


@query(
    "infer_age",
    f"""
    SELECT CAST(uid AS VARCHAR) AS uid, ts_ms, search_ms, order_id, {_arg_max([f'p{i}' for i in range(6)])} AS age_level,
      {_arg_max([f'w{i}' for i in range(6)])} AS inferred_age
    FROM (SELECT *, {', '.join(f'{t} AS p{i}' for i, t in enumerate(_totals(None)))},
            {', '.join(f'{t} AS w{i}' for i, t in enumerate(_totals(scoring.SHARES)))}
      FROM (SELECT p.*, o.l_orderkey AS order_id, o.slot, o.brand, {LABEL_SQL} AS label FROM ({PROFILE_SQL}) p
        JOIN ({LAST_ORDERS}) o ON p.uid = o.uid AND abs(o.ms - p.ts_ms) <= 10 * 86400000))
    """,
)
def infer_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plain sum, and shares of the same F12 scores."""
    found = profile.with_searches(
        user_times(spark, sf_dir), search_scores(spark, sf_dir), "event_time", ["device_score", "search_score", "search_ms"]
    )
    joined = profile.with_orders(
        found, order_scores(spark, sf_dir), "event_time", ["time_score", "amount_score", "brand_score", "order_id"]
    )
    plain = {"search": "search_score", "device": "device_score", "time": "time_score", "brand": "brand_score", "amount": "amount_score"}
    shared = {"category": "search_score", "device": "device_score", "time": "time_score", "brand": "brand_score", "price": "amount_score"}
    return joined.select(
        "uid", "ts_ms", "search_ms", "order_id",
        scoring.inferred_band(scoring.total_scores(plain)).alias("age_level"),
        scoring.inferred_band(scoring.total_scores(shared, scoring.SHARES)).alias("inferred_age"),
    )


# Weight files of brands and time slots, and columns that other jobs put on an order row: one for each band, some missing.
BRAND_WEIGHTS_SQL = f"SELECT {BRAND_SQL} AS known, sum(p_size) AS s FROM part GROUP BY 1"
SLOT_WEIGHTS_SQL = f"SELECT {SLOT_SQL} AS known, count(*) AS s FROM (SELECT o_orderkey % 24 AS h FROM orders) GROUP BY 1"
BAND_NUMBERS = list(enumerate(BANDS))


def weight_file(spark: SparkSession, totals: DataFrame, modulus: int) -> DataFrame:
    """A weight file with a map per label, written from totals (label, s) and read back; bands in another spelling (Q16)."""
    bands = F.create_map(*[x for i, b in BAND_NUMBERS for x in (F.lit("50以上" if b == "50" else b), (F.col("s") * (i + 1) % modulus / 100).cast("double"))])
    path = scratch(spark, "weights")
    totals.select(F.to_json(F.create_map("label", bands)).alias("value")).write.text(path)
    return weight_table(spark, path)


def order_columns(prefix: str, factor: int) -> list[Column]:
    number = lambda i: F.col("order_id") * (i + factor) % 11
    return [F.when(number(i) != 10, (number(i) / 100).cast("string")).alias(f"{prefix}_{b}") for i, b in BAND_NUMBERS]


def joined_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each user, search and order that lie together, with all scores and labels."""
    found = profile.with_searches(
        user_times(spark, sf_dir), search_scores(spark, sf_dir), "event_time", ["device_score", "search_score", "search_ms"]
    )
    orders = order_scores(spark, sf_dir)
    orders = orders.withColumn("tm_name", F.when(F.col("order_id") % 6 == 1, "unlisted").otherwise(F.col("brand")))
    return profile.with_orders(
        found, orders, "event_time", ["time_score", "amount_score", "brand_score", "order_id", "tm_name", "slot"]
    )


def _column_sql(i: int, factor: int) -> str:
    return f"(CASE WHEN order_id * {i + factor} % 11 = 10 THEN 0 ELSE {_dec(f'(order_id * {i + factor} % 11) / 100')} END)"


def _weight_sql(alias: str, i: int, modulus: int) -> str:
    return _dec(f"({alias}.s * {i + 1} % {modulus}) / 100")


def _inferred_sql(totals: list[str], source: str, column: str) -> str:
    return (
        f"SELECT CAST(uid AS VARCHAR) AS uid, ts_ms, search_ms, order_id, {_arg_max([f't{i}' for i in range(6)])} AS {column} "
        f"FROM (SELECT *, {', '.join(f'{t} AS t{i}' for i, t in enumerate(totals))} FROM {source})"
    )


JOINED_SQL = f"""
(SELECT p.*, o.l_orderkey AS order_id, o.slot, o.brand, CASE WHEN o.l_orderkey % 6 = 1 THEN 'unlisted' ELSE o.brand END AS tm_name,
  {LABEL_SQL} AS label FROM ({PROFILE_SQL}) p JOIN ({LAST_ORDERS}) o ON p.uid = o.uid AND abs(o.ms - p.ts_ms) <= 10 * 86400000)
"""


@query(
    "infer_age_six_parts",
    _inferred_sql([f"{t} + {_column_sql(i, 2)}" for i, t in enumerate(_totals(None))], JOINED_SQL, "age_level"),
)
def infer_age_six_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F14, plain form: five scores, and the category's from one column per band."""
    joined = joined_profile(spark, sf_dir).select("*", *order_columns("b1name", 2))
    scored = joined.withColumn("b1name_score", scoring.score_vector([f"b1name_{b}" for b in BANDS]))
    parts = {n: f"{n}_score" for n in ("search", "device", "time", "brand", "amount", "b1name")}
    return scored.select("uid", "ts_ms", "search_ms", "order_id", scoring.inferred_band(scoring.total_scores(parts)).alias("age_level"))


@query(
    "infer_age_weight_maps",
    f"WITH bw AS ({BRAND_WEIGHTS_SQL}), sw AS ({SLOT_WEIGHTS_SQL}) "
    + _inferred_sql(
        [
            f"{_case('search_category', scoring.SEARCH_WEIGHTS, '0.15', i)} * 0.3 + coalesce({_weight_sql('b', i, 89)}, {_weight_sql('d', i, 89)}) * 0.2 "
            f"+ coalesce({_weight_sql('w', i, 83)}, 0) * 0.15 + {_case('label', scoring.AMOUNT_WEIGHTS, '0.1', i)} * 0.1 "
            f"+ {_case('family', scoring.DEVICE_WEIGHTS, '0.1', i)} + {_column_sql(i, 3)}"
            for i in range(6)
        ],
        f"{JOINED_SQL} j LEFT JOIN bw b ON j.tm_name = b.known LEFT JOIN sw w ON j.slot = w.known "
        f"JOIN bw d ON d.known = '{scoring.DEFAULT_BRAND}'",
        "inferred_age",
    ),
)
def infer_age_weight_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F14, weighted form: brand and time weights from files (J18), the keyword's from one column per band."""
    names = F.array(*[F.lit(b) for b in BRAND_NAMES])
    brand = F.element_at(names, (F.col("p_partkey") % len(BRAND_NAMES) + 1).cast("int")).alias("label")
    brands = weight_file(spark, table(spark, sf_dir, "part").groupBy(brand).agg(F.sum("p_size").alias("s")), 89)
    hour = F.timestamp_millis(F.col("o_orderkey") % 24 * 3_600_000)
    slots = weight_file(spark, table(spark, sf_dir, "orders").groupBy(time_slot(hour).alias("label")).agg(F.count("*").alias("s")), 83)
    joined = joined_profile(spark, sf_dir).select("*", *order_columns("keyword", 3))
    looked_up = scoring.weight_lookup(scoring.brand_weight_lookup(joined, "tm_name", brands), "slot", slots, "time_code")
    keyword = scoring.score_vector([f"keyword_{b}" for b in BANDS])
    vectors = {"category": F.col("search_score"), "price": F.col("amount_score"), "device": F.col("device_score"), "keyword": keyword}
    parts = {"brand": "tm_code", "time": "time_code", **{n: scoring.vector_bands(v) for n, v in vectors.items()}}
    totals = scoring.band_totals(scoring.merged_bands(parts, scoring.SHARES))
    return looked_up.select("uid", "ts_ms", "search_ms", "order_id", scoring.inferred_band(totals).alias("inferred_age"))


@query(
    "profile_value_sets",
    f"""
    SELECT CAST(c.uid AS VARCHAR) AS uid, count(*) AS pv, array_to_string(list_sort(list_distinct(list(s.family))), ',') AS os,
      array_to_string(list_sort(list_distinct(list(CAST(s.ts AS VARCHAR)))), ',') AS search_ms,
      array_to_string(list_sort(list_distinct(list(s.search_category))), ',') AS search_category
    FROM customer JOIN ({PROFILE_SQL}) c ON c_custkey = c.uid JOIN ({LAST_SEARCHES}) s ON s.uid = c.uid AND s.ts = c.search_ms
    GROUP BY c.uid
    """,
)
def profile_value_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8 over the joined profile."""
    views = searched(spark, sf_dir).filter(F.col("uid").isNotNull() & (F.col("item_type") == "keyword"))
    rows = views.select("uid", "event_time", "ts", "event_id", F.split_part("os", F.lit(" "), F.lit(1)).alias("os"), "search_category")
    last = last_per_window(rows, ["uid"], "event_time", "1 day", ["ts", "event_id"]).withColumnRenamed("ts", "search_ms")
    joined = profile.with_searches(user_times(spark, sf_dir), last, "event_time", ["os", "search_category", "search_ms"])
    return user_value_sets(joined, "uid", ["os", "search_ms", "search_category"])
