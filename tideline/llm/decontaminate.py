"""Benchmark decontamination (operator 2), in DataFrame functions only: SimHash of windows as long as a benchmark item.

A text's words are its runs of letters and digits in lower case, its shingles all runs of five words. A shingle is one
64-bit number: a hash, whose lowest three bits are replaced by its weight less one (1 to 8, by its length in bytes).
A window's fingerprint has a bit set where over half of its weight has it. Fingerprints within ``RADIUS`` bits of each
other agree up to RADIUS // 4 bits in one of their four blocks of 16 bits, so the index holds each item's blocks with
all such changes: an equal join on a block finds every fingerprint within the radius. What it finds is then compared
shingle by shingle.

A window without a shingle of any item is like none of them, so fingerprints are only made of windows that have one, as
long as the items it may come from.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.registry import query, table
from tideline.session import scratch

WORDS = 5
SIMILARITY = 0.8
RADIUS = 19
BLOCK_BITS = 16
# Windows go in runs of as many first words.
RUN = 64
# Sums of weights have 14 bits: longer items are compared in parts of so many shingles.
LONGEST = 2047
BROADCAST_ROWS = 1 << 20
_LANES = 0x0001000100010001


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def places_of(words: Column) -> Column:
    """First words of all shingles, from 0; null if there are none."""
    return F.when(F.size(words) >= WORDS, F.sequence(F.lit(0), F.size(words) - WORDS))


def shingle(words: Column, at: Column) -> Column:
    """The shingle that starts at a word (from 0) of a column of words."""
    string = F.concat_ws(" ", F.slice(words, (at + 1).cast("int"), WORDS))
    return F.xxhash64(string).bitwiseAND(F.lit(-8)).bitwiseOR(F.least(F.lit(7), F.shiftright(F.octet_length(string), 3)).cast("bigint"))


def weight(items: Column) -> Column:
    return F.aggregate(items, F.lit(0).cast("bigint"), lambda a, x: a + x.bitwiseAND(F.lit(7)) + 1)


def fingerprints(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``fp`` for each key: the SimHash of its rows' shingles ``x``, of which there are at most LONGEST.

    Each of 16 sums counts four bits of the hashes, in lanes of 16 bits.
    """
    heavy = F.col("x").bitwiseAND(F.lit(7)) + 1
    lanes = [F.sum(F.shiftrightunsigned("x", k).bitwiseAND(F.lit(_LANES)) * heavy).alias(f"s{k}") for k in range(16)]
    sums = rows.groupBy(*keys).agg(*lanes, F.sum(heavy).alias("total"))
    # A lane over half of the weight reaches bit 14; no lane reaches bit 15.
    lift = (F.lit(0x3FFF) - F.shiftright("total", 1)) * F.lit(_LANES)
    bits = [F.shiftleft(F.shiftright(F.col(f"s{k}") + lift, 14).bitwiseAND(F.lit(_LANES)), k) for k in range(16)]
    return sums.select(*keys, reduce(Column.bitwiseOR, bits).alias("fp"))


def blocks(fp: Column) -> Column:
    """The four blocks as (number, bits)."""
    return F.array(*[
        F.struct(F.lit(b).alias("block"), F.shiftrightunsigned(fp, b * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).alias("bits"))
        for b in range(64 // BLOCK_BITS)
    ])


def changes(radius: int) -> list[int]:
    """All ways to change at most radius // 4 bits of a block."""
    most = radius * BLOCK_BITS // 64
    return [sum(1 << b for b in bits) for n in range(most + 1) for bits in combinations(range(BLOCK_BITS), n)]


def kept(df: DataFrame, label: str) -> DataFrame:
    folder = scratch(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def matches(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """One row for each document that holds a benchmark item: doc_id, item_id, similarity, first_word, n_words, n_items.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are left out. A document holds an item if
    some window of as many words, or the whole of a shorter text, has a weighted Jaccard similarity of shingles of at
    least ``similarity`` with it, and a fingerprint within ``radius`` bits of its own. The row tells of the most similar item, of equal ones the smallest
    item_id and the first place; ``n_items`` counts all. Items of fewer than five words match nothing; those of over
    LONGEST shingles match by any part. Null doc_ids and null texts take no part, repeated rows count once. No rows on
    either side: no rows.
    """
    split = items.select("item_id", words_of(F.col("text")).alias("words")).filter(F.size("words") >= WORDS)
    starts = F.sequence(F.lit(0), F.size("words") - WORDS, F.lit(LONGEST))
    parts = split.select("item_id", "words", F.explode(starts).alias("from"))
    last = F.least(F.col("from") + (LONGEST - 1), F.size("words") - WORDS)
    item = F.transform(F.sequence("from", last), lambda i: shingle(F.col("words"), i))
    parts = kept(parts.select("item_id", "from", item.alias("item")).withColumn("n", F.size("item")), "items")
    marked = fingerprints(parts.select("item_id", "from", F.explode("item").alias("x")), ["item_id", "from"])
    parts = kept(parts.join(marked.withColumnRenamed("fp", "item_fp"), ["item_id", "from"]), "items")

    # Where a document has a shingle of an item, windows of the item's length around it are looked at.
    weighed = parts.select(F.explode("item").alias("x"), "n", weight(F.array_distinct("item")).alias("least"))
    wanted = kept(weighed.groupBy("x", "n").agg(F.min("least").alias("least")), "shingles")
    if wanted.count() <= BROADCAST_ROWS:  # at most some 30 MB; else the join shuffles
        wanted = F.broadcast(wanted)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter("doc_id is not null and text is not null")
    split = texts.select("doc_id", words_of(F.col("text")).alias("words"))
    places = split.select("doc_id", "words", F.explode(places_of(F.col("words"))).alias("at"))
    seen = places.select("doc_id", "at", shingle(F.col("words"), F.col("at")).alias("x")).join(wanted, "x")
    run = F.explode(F.sequence(F.floor(F.greatest(F.lit(0), F.col("at") - F.col("n") + 1) / RUN), F.floor(F.col("at") / RUN)))
    runs = seen.select("doc_id", "n", run.alias("run"), "least").groupBy("doc_id", "n", "run").agg(F.min("least").alias("least"))
    runs = kept(runs, "runs")

    key = ["doc_id", "of", "n", "run"]
    held = texts.join(runs, "doc_id").select(F.xxhash64("text").alias("of"), "doc_id", "n", "run", "least", words_of(F.col("text")).alias("words"))
    most = F.least(F.col("run") * RUN + F.col("n") + (RUN - 2), (F.size("words") - WORDS).cast("bigint"))
    part = F.transform(F.sequence(F.col("run") * RUN, most), lambda i: shingle(F.col("words"), i))
    # A text shorter than the item is one window, if its weight is enough for the lightest item that it has a shingle of.
    short = F.size("words").between(WORDS, F.col("n") + (WORDS - 2)) & (F.col("run") == 0)
    held = held.filter(short | (most >= F.col("run") * RUN + F.col("n") - 1)).select(*key, "least", short.alias("short"), part.alias("part"))
    held = held.filter(~F.col("short") | (weight(F.array_distinct("part")) / F.col("least") >= similarity)).select(*key, "part")
    held = kept(held.dropDuplicates(key), "windows")

    places = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("part") - F.col("n")))
    windows = held.select(*key, "part", F.explode(places).alias("place"))
    windows = fingerprints(windows.select(*key, "place", F.explode(F.slice("part", F.col("place") + 1, F.col("n"))).alias("x")), [*key, "place"])
    # Fingerprints within the radius differ by at most a quarter of it in some block. The window changes one of those bits
    # and the item the others, which takes far fewer rows in the index than if the item changed them all.
    per_block = 64 // BLOCK_BITS
    by_window = min(1, radius // per_block)
    changed = lambda n: F.explode(F.transform(F.lit(changes(n * per_block)), lambda c: F.col("b.bits").bitwiseXOR(c))).alias("bits")
    keyed = windows.select("*", F.explode(blocks(F.col("fp"))).alias("b")).select(*key, "place", "fp", "b.block", changed(by_window))
    index = parts.select("item_id", "from", "n", "item_fp", F.explode(blocks(F.col("item_fp"))).alias("b"))
    index = index.select("item_id", "from", "n", "item_fp", "b.block", changed(radius // per_block - by_window))
    near = keyed.join(index, ["n", "block", "bits"]).filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
    near = near.select(*key, "place", "item_id", "from").distinct()

    pairs = near.join(held, key).join(parts.select("item_id", "from", "item"), ["item_id", "from"])
    window = F.array_distinct(F.slice("part", F.col("place") + 1, F.col("n")))
    shared = weight(F.array_intersect(window, F.col("item")))
    alike = shared / (weight(window) + weight(F.array_distinct("item")) - shared)
    found = pairs.select("doc_id", "item_id", alike.alias("similarity"), (F.col("run") * RUN + F.col("place")).alias("first_word"), F.least("n", F.size("part")).alias("n")).filter(F.col("similarity") >= similarity)
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "item_id", "first_word", "n")).alias("best")
    by_item = found.groupBy("doc_id", "item_id").agg(best)
    out = by_item.groupBy("doc_id").agg(F.min("best").alias("best"), F.count("*").alias("n_items"))
    return out.select(
        "doc_id", "best.item_id", (-F.col("best.s")).alias("similarity"), F.col("best.first_word").cast("bigint").alias("first_word"),
        (F.col("best.n") + (WORDS - 1)).cast("bigint").alias("n_words"), "n_items",
    )


def decontaminate(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """``docs`` without the documents that hold an item; all columns stay, as do rows with a null doc_id or text."""
    found = matches(docs, items, similarity, radius)
    return docs.join(found.select(F.col("doc_id").alias("_found")), F.col("doc_id") == F.col("_found"), "left_anti")


@query("op2_decontamination")
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
