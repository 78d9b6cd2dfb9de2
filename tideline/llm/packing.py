"""Best-fit packing (operator 1): documents into training sequences of several permitted lengths, chosen jointly.

Pieces go in order of falling length, each into the open bin that it fills best. Where it fits into none, a bin opens of
the permitted length with the least cost for each token that it is going to hold, which is bounded by what is still to
be packed. At the end each bin takes the shortest permitted length that holds its contents.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.registry import query, table

LENGTHS = (1024, 2048, 4096, 8192, 16384)
SEQUENCE_COST = 256.0
SHARD_ROWS = 100_000


def byte_length(text: Column) -> Column:
    """Tokens of a byte-level model: one for each UTF-8 byte, and an end token. Null: empty."""
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("bigint") + 1


def best_fit(sizes: Sequence[int], lengths: Sequence[int], sequence_cost: float) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each size (falling, none above the largest length), and each bin's final length."""
    lengths = sorted(lengths)
    rest = int(sum(sizes))
    bins, offsets = np.empty(len(sizes), dtype=np.int64), np.empty(len(sizes), dtype=np.int64)
    used: list[int] = []
    opened: list[int] = []
    room: list[tuple[int, int]] = []  # (free tokens, bin), sorted: the first that fits is the best fit
    for i, size in enumerate(sizes):
        at = bisect_left(room, (size, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            # What a bin can hold in the end is bounded by its length and by all that is still to be packed.
            free = min((c for c in lengths if c >= size), key=lambda c: ((c + sequence_cost) / min(c, rest), c))
            b = len(used)
            used.append(0)
            opened.append(free)
        bins[i], offsets[i] = b, used[b]
        used[b] += size
        rest -= size
        if free > size:
            insort(room, (free - size, b))
    return bins, offsets, [lengths[bisect_left(lengths, u)] for u in used]


def pack(docs: DataFrame, n_tokens: Column, lengths: Sequence[int] = LENGTHS, sequence_cost: float = SEQUENCE_COST, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """doc_id, piece, start, n_tokens, bin_id, bin_length, bin_offset: where each piece of each document goes.

    A document longer than the largest permitted length is cut into pieces of that length and a last one; no token is
    dropped. Texts stay where they are: only ids and lengths are shuffled, to shards of about ``shard_rows`` pieces, by
    a hash of id, piece and length, so that no source or size makes a shard large; each shard is packed by one task.
    Null doc_ids and repeated rows are packed like any other. Rows without a length, or of 0 tokens, have no pieces. No
    rows: no rows. Other columns are left out.
    """
    longest = max(lengths)
    sized = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), n_tokens.cast("bigint").alias("total")).filter("total > 0")
    pieces = sized.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("total") - 1) / longest)))).select(
        "doc_id", "piece", (F.col("piece") * longest).alias("start"), F.least(F.lit(longest).cast("bigint"), F.col("total") - F.col("piece") * longest).alias("n_tokens")
    )
    shards = max(1, -(-pieces.count() // shard_rows))
    placed = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "n_tokens"), F.lit(shards)))

    def fill(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = pa.Table.from_batches(list(batches)).sort_by([("n_tokens", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        bins, offsets, final = best_fit(part["n_tokens"].to_pylist(), lengths, sequence_cost)
        ids = pa.array((key[0].as_py() << 32) + bins)
        out = part.select(["doc_id", "piece", "start", "n_tokens"])
        for name, column in (("bin_id", ids), ("bin_length", pa.array(np.array(final, dtype=np.int64)[bins])), ("bin_offset", pa.array(offsets))):
            out = out.append_column(name, column)
        yield from out.to_batches()

    schema = "doc_id bigint, piece bigint, start bigint, n_tokens bigint, bin_id bigint, bin_length bigint, bin_offset bigint"
    return placed.groupBy("shard").applyInArrow(fill, schema)


@query("op1_best_fit_packing")
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), byte_length(F.col("text")))
