"""Comment moderation."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.search import WordSearch
from tideline.operators.joins import BROADCAST_ROWS, interval_join, membership

# Places of a text are first held against the words' beginnings of at most so many characters.
HEAD = 4
# Characters of a text that are cut at a time.
CHUNK = 128


def comments_with_orders(comments: DataFrame, orders: DataFrame, comment_ts: str, order_ts: str) -> DataFrame:
    """Comments with their order, at most a minute apart; order columns are prefixed ``info_``."""
    side = orders.withColumn("_order_ts", F.col(order_ts))
    cols = [c for c in orders.columns if c != order_ts]
    minute = timedelta(minutes=1)
    return interval_join(
        comments, side, "order_id", comment_ts, "_order_ts", -minute, minute, cols, "info_", right_key="id"
    )


def last_token(text: Column | str) -> Column:
    """The last comma-separated token; empty tokens at the end do not count."""
    c = F.col(text) if isinstance(text, str) else text
    return F.substring_index(F.rtrim(c, F.lit(",")), ",", -1)


def check_last_token(comments: DataFrame, words: DataFrame, text: str, word: str = "word") -> DataFrame:
    """a comment whose last token is a listed word violates at grade P0."""
    probe = membership(comments.withColumn("_token", last_token(text)), "_token", words, word, "_hit")
    return (
        probe.withColumn("is_violation", F.col("_hit").cast("int"))
        .withColumn("violation_grade", F.when(F.col("_hit"), "P0").otherwise(""))
        .withColumn("violation_msg", F.when(F.col("_hit"), F.col("_token")).otherwise(""))
        .drop("_hit", "_token")
    )


def contained_words(
    df: DataFrame, words: DataFrame, text: str, out: str, word: str = "word", max_words: int = BROADCAST_ROWS
) -> DataFrame:
    """all listed words inside a text, ordered by first position, then by word; null and empty texts have none.

    Up to ``max_words`` words are sent to every task, where all places of a batch of texts are looked up at once: the
    texts themselves are neither moved nor cut. A longer list is joined, see ``_joined_words``.
    """
    listed = words.select(F.col(word).alias("_w")).filter(F.length("_w") > 0).distinct()
    few = [r["_w"] for r in listed.limit(max_words + 1).collect()]
    if len(few) > max_words:
        return _joined_words(df, listed, text, out)
    sent = df.sparkSession.sparkContext.broadcast(few)

    @F.arrow_udf("array<string>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        search = WordSearch(sent.value)
        for texts in batches:
            yield search.of_texts(texts)

    return df.withColumn(out, found(F.col(text)))


def _joined_words(df: DataFrame, listed: DataFrame, text: str, out: str) -> DataFrame:
    """``contained_words`` for a list of any length, ``_w``.

    One pass cuts a text into chunks, each with as much of what follows as the longest word can need. Pieces are then cut
    from a chunk, so that the cost of a place doesn't depend on the length of the text; chunks are spread over the
    tasks, since looking a place up costs far more than moving it. Every place meets the beginnings of the words; where
    one stands, the pieces as long as the words that begin so are looked up. Both look-ups are equal joins, which
    Catalyst broadcasts where the list is small. What a text holds depends on nothing but the text, so results go back
    to the rows by its digest: rows need no key, may repeat, and busy texts are split by AQE.
    """
    heads = listed.groupBy(F.left("_w", F.lit(HEAD)).alias("_head")).agg(F.collect_set(F.length("_w")).alias("_sizes"))
    longest = F.coalesce(listed.agg(F.max(F.length("_w"))).scalar(), F.lit(1))
    size = F.greatest(F.lit(CHUNK), longest)
    key = F.unhex(F.sha2(F.col(text), 256))
    texts = df.select(key.alias("_key"), F.col(text).alias("_t")).filter(F.length("_t") > 0)
    # Two groups: a chunk, and what of the text follows it, which is looked at but not passed over.
    pattern = F.concat(F.lit("(?s)(.{1,"), size, F.lit("})(?=(.{0,"), longest - 1, F.lit("}))"))
    pairs = F.arrays_zip(*[F.regexp_extract_all("_t", pattern, F.lit(g)).alias(n) for g, n in ((1, "body"), (2, "rest"))])
    chunks = texts.select("_key", F.posexplode(pairs).alias("_n", "_pair")).select(
        "_key", (F.col("_n") * size).alias("_before"), F.length("_pair.body").alias("_places"), F.concat("_pair.body", "_pair.rest").alias("_chunk"), longest.alias("_longest")
    ).repartition("_key", "_before")
    cut = F.transform(F.sequence(F.lit(1), F.col("_places")), lambda at: F.substring("_chunk", at, F.col("_longest")))
    pieces = chunks.select("_key", "_before", F.posexplode(cut).alias("_in", "_piece"))
    # Whole words shorter than HEAD are their own beginnings. Near the end of a text some beginnings are the same, which does no harm.
    begins = F.array(*[F.left("_piece", F.lit(n)) for n in range(1, HEAD + 1)])
    begun = pieces.select("_key", (F.col("_before") + F.col("_in") + 1).alias("_at"), "_piece", F.explode(begins).alias("_head")).join(heads, "_head")
    whole = begun.select("_key", "_at", F.explode("_sizes").alias("_n"), "_piece").select("_key", "_at", F.left("_piece", F.col("_n")).alias("_w"))
    firsts = whole.join(listed, "_w").groupBy("_key", "_w").agg(F.min("_at").alias("_at"))
    found = firsts.groupBy("_key").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_at", "_w"))), lambda x: x["_w"]).alias("_words")
    )
    joined = df.withColumn("_key", key).join(found, "_key", "left")
    return joined.withColumn(out, F.coalesce("_words", F.array().cast("array<string>"))).drop("_words", "_key")


def moderate(
    comments: DataFrame, token_words: DataFrame, text_words: DataFrame, text: str, word: str = "word"
) -> DataFrame:
    """F19 then F20: rows that pass the token check get grade P1 when a listed word is inside the text.

    ``is_violation`` stays 0 for P1.
    """
    first = check_last_token(comments, token_words, text, word)
    probe = first.withColumn("_probe", F.when(F.col("is_violation") == 0, F.col(text)))
    second = contained_words(probe, text_words, "_probe", "_found", word)
    p1 = (F.col("is_violation") == 0) & (F.size("_found") > 0)
    return (
        second.withColumn("violation_msg", F.when(p1, F.array_join("_found", ", ")).otherwise(F.col("violation_msg")))
        .withColumn("violation_grade", F.when(p1, "P1").otherwise(F.col("violation_grade")))
        .drop("_found", "_probe")
    )


def _hash_number(text: Column | str, start: int = 1) -> Column:
    """28 bits of the md5 of a text, the same in every engine."""
    return F.conv(F.substring(F.md5(text), start, 7), 16, 10).cast("bigint")


def inject_words(df: DataFrame, words: DataFrame, row_id: str, text: str, percent: int = 20, word: str = "word") -> DataFrame:
    """a fixed share of comments gets a word of the list appended, both chosen by md5 of the row id.

    Words are spread over a quarter as many slots as there are words; a comment takes one of its slot's words, or the
    first word of all when the slot is empty. Only the word count and that word reach the driver.
    """
    listed = words.select(F.col(word).alias("_word")).distinct()
    total, first = listed.agg(F.count("*"), F.min("_word")).first()
    if not total:
        return df
    slots = max(1, total // 4)
    filled = listed.groupBy((_hash_number("_word") % slots).alias("_slot_no")).agg(F.sort_array(F.collect_list("_word")).alias("_words"))
    row = F.col(row_id).cast("string")
    chosen = _hash_number(row) % 100 < percent
    # Comments that get no word keep distinct negative slots, so they do not meet in one task.
    slot = F.when(chosen, _hash_number(row, 8) % slots).otherwise(-1 - _hash_number(row, 8))
    joined = df.withColumn("_slot_no", slot).join(filled, "_slot_no", "left")
    picked = F.get("_words", (_hash_number(row, 15) % F.size("_words")).cast("int"))
    added = F.when(F.col("_slot_no") >= 0, F.coalesce(picked, F.lit(first)))
    return joined.withColumn(text, F.concat_ws(",", text, added)).select(*df.columns)
