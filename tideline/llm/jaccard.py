"""N-gram Jaccard join (operator 10) by PartEnum signatures; near-duplicate groups of documents.

Sets of similar size share a band. In a band whose largest set has r shingles, two sets at the threshold differ in at
most K = floor(2 r (1 - t) / (1 + t)) shingles. The shingle domain is partitioned N = K + S + E ways, so such sets agree
on at least S + E parts. A set's signature for a part is the sum of hashes of its shingles there. Empty parts give none:
a set with at most E empty parts shares at least S signatures with every similar set. A set with more than E goes on to
another partition of the domain, as would any set that agrees with it on empty parts; after the last, empty parts count.

Signatures are sorted by range, so a group of any size is cut into slices of even tasks. Each slice compares its members
with its first one only (links of copies are transitive). Where a group then still spans several components, members of
different components that share S signatures are compared as well. That loses no link between components, and no
group is ever expanded into all of its pairs.

Pairs are ruled out by sizes and bitmaps of their sets first; only texts of pairs that may be links move.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.llm.registry import query, table
from tideline.llm.workers import bound_batches, released
from tideline.session import discard, scratch, shuffles_freed

BAND_RATIO = 1.4
ROUNDS = 16
BAND_BITS = 128
BROADCAST_IDS = 1 << 20
# Signatures are dealt into so many parts by their own bits, and shuffled one part after the other.
PARTS = 4
_U64 = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit integers."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of ``words`` words; of fewer words, the whole sequence is one."""
    if not text:
        return np.empty(0, dtype=_U64)
    # On bytes, lower() changes A-Z only and split() cuts at space and 0x09-0x0D only.
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, dtype=_U64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), dtype=_U64, count=len(parts))
    width = min(words, len(parts))
    total = np.zeros(len(parts) - width + 1, dtype=_U64)
    for k in range(width):
        total = total * _U64(0x9E3779B97F4A7C15) + hashes[k : len(hashes) - width + 1 + k]
    return np.unique(_mix(total + _U64(width)))


def sketch(items: np.ndarray) -> bytes:
    """A bitmap with a bit for each shingle of a set, at its hash modulo the size: a power of two, two to four bits a shingle."""
    if not len(items):
        return b""
    bits = max(256, 1 << (2 * len(items) - 1).bit_length())
    filled = np.zeros(bits, dtype=bool)
    filled[(items & _U64(bits - 1)).astype(np.int64)] = True
    return np.packbits(filled, bitorder="little").tobytes()


def may_link(size_a: int, sketch_a: bytes, size_b: int, sketch_b: bytes, percent: int) -> bool:
    """False only for sets that are not ``linked``: each bit that one sketch has and the other lacks is a shingle of its own."""
    bits = 8 * min(len(sketch_a), len(sketch_b))
    a, b = (_folded(int.from_bytes(s, "little"), 8 * len(s), bits) for s in (sketch_a, sketch_b))
    common = min(size_a - (a & ~b).bit_count(), size_b - (b & ~a).bit_count())
    return common > 0 and 100 * common >= percent * (size_a + size_b - common)


def _folded(bitmap: int, bits: int, to: int) -> int:
    while bits > to > 0:
        bits //= 2
        bitmap = bitmap >> bits | bitmap & ((1 << bits) - 1)
    return bitmap


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common > 0 and 100 * common >= percent * (len(a) + len(b) - common)


@lru_cache(maxsize=100_000)
def band(size: int) -> tuple[int, int]:
    """Number and largest size of the band of a size; bands are wide enough that links reach into the next one at most."""
    low, k = 1, 0
    while True:
        high = max(low, math.floor(low * BAND_RATIO))
        if size <= high:
            return k, high
        low, k = high + 1, k + 1


@lru_cache(maxsize=100_000)
def scheme(high: int, percent: int) -> tuple[int, int, int]:
    """For sets of up to ``high`` shingles: parts of the domain, empty parts allowed, and how many signatures similar sets
    share at least. No parts if links need equal sets."""
    differ = 2 * high * (100 - percent) // (100 + percent)
    if differ == 0:
        return 0, 0, 1
    shared = 2 + differ // 4
    smallest, allowed = high / BAND_RATIO * percent / 100, 0
    while True:
        parts = differ + shared + allowed
        empty = parts * math.exp(-smallest / parts)
        if allowed >= empty + math.sqrt(empty) or allowed >= parts // 3:
            return parts, allowed, shared
        allowed += 1


def shared_by_band(percent: int) -> list[int]:
    """How many signatures similar sets share at least, by the number of the band that the signatures are for."""
    out, low = [], 1
    for _ in range(BAND_BITS):
        high = max(low, math.floor(low * BAND_RATIO))
        out.append(scheme(high, percent)[2] if high < 1 << 24 else 2)
        low = high + 1
    return out


def signatures(items: np.ndarray, percent: int) -> np.ndarray:
    """PartEnum signatures of a set, for its own band and, if a larger set in the next band can be similar, for that."""
    size = len(items)
    if not size:
        return items
    number, high = band(size)
    schemes = [(number, high)]
    if size * 100 // percent > high:
        schemes.append(band(high + 1))
    out = []
    values = _mix(items + _U64(0x5851F42D4C957F2D))
    low, up = (values & _U64(0xFFFFFF)).astype(np.float64), (values >> _U64(40)).astype(np.float64)
    for number, high in schemes:
        parts, allowed, _ = scheme(high, percent)
        if not parts:
            continue
        for turn in range(ROUNDS):
            where = (_mix(items + _U64(turn * 7919 + number + 1)) % _U64(parts)).astype(np.int64)
            # Sums of 24-bit halves are exact in doubles.
            sums = np.bincount(where, low, parts).astype(_U64) + (np.bincount(where, up, parts).astype(_U64) << _U64(32))
            filled = np.bincount(where, minlength=parts) > 0
            last = turn == ROUNDS - 1
            found = _mix(_mix(sums) + np.arange(parts, dtype=_U64) + _U64(((number * ROUNDS + turn) << 32) + 1))
            # The lowest bits tell the band.
            found = (found & ~_U64(BAND_BITS - 1)) | _U64(number)
            out.append(found if last else found[filled])
            if parts - int(filled.sum()) <= allowed:
                break
    return np.concatenate(out) if out else np.empty(0, dtype=_U64)


def small(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Texts become Python strings a few at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))


def signed_sets(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, set_key, a digest of the set (null if empty), the set's ``sketch``, and ``signs``: its signatures
    (null without any, or without a doc_id)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            sets = [shingle_set(t, words) for t in batch.column(1).to_pylist()]
            keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            signs = [signatures(s, percent).astype("<u8").tobytes() or None if i is not None else None for i, s in zip(batch.column(0).to_pylist(), sets, strict=True)]
            columns = [pa.array([len(s) for s in sets], pa.int64()), *(pa.array(c, pa.binary()) for c in (keys, list(map(sketch, sets)), signs))]
            yield pa.record_batch([batch.column(0), *columns], ["doc_id", "n_shingles", "set_key", "sketch", "signs"])

    return _rows(docs).mapInArrow(released(sign), "doc_id bigint, n_shingles bigint, set_key binary, sketch binary, signs binary")


def signature_rows(signed: DataFrame, part: int) -> DataFrame:
    """node, signature: of every distinct set with a doc_id, the signatures of one of the ``PARTS``; its node is the smallest
    doc_id that has it."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            signs = batch.column(2).to_pylist()
            values = np.frombuffer(b"".join(signs), dtype="<u8")
            here = values // _U64(BAND_BITS) % _U64(PARTS) == part
            counts = np.r_[0, np.cumsum(here)][np.cumsum([0, *(len(s) // 8 for s in signs)])]
            found = pa.Array.from_buffers(pa.binary(), len(signs), [None, pa.py_buffer((counts * 8).astype("<i4")), pa.py_buffer(values[here])])
            some = pa.array(np.diff(counts) > 0)
            yield pa.record_batch([batch.column(0), batch.column(1), found], ["doc_id", "set_key", "signs"]).filter(some)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = [np.frombuffer(b, dtype="<i8") for b in batch.column(1).to_pylist()]
            for at in range(0, len(arrays), 512):
                part = arrays[at : at + 512]
                nodes = np.repeat(batch.column(0).to_numpy()[at : at + 512], [len(a) for a in part])
                yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array(np.concatenate(part))], ["node", "signature"])

    chosen = signed.filter("signs is not null").select("doc_id", "set_key", "signs").mapInArrow(released(choose), "doc_id bigint, set_key binary, signs binary")
    # Copies of a set meet here, most of them within their task; one row for each set goes on.
    distinct = chosen.groupBy("set_key").agg(F.min("doc_id").alias("node"), F.min("signs").alias("signs"))
    return distinct.select("node", "signs").mapInArrow(released(spread), "node bigint, signature bigint")


def slices(rows: DataFrame) -> DataFrame:
    """signature, node, first, edge: groups of more than one node, cut where a task's range ends. ``first`` is the slice's
    smallest node. The first and last group of each task, which others may hold more of, have a row marked ``edge``."""
    shards = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(shards, "signature", "node").sortWithinPartitions("signature", "node")

    def rows_of(*columns) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["signature", "node", "first", "edge"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, center, alone = None, 0, True  # the group that the last batch ended in
        for batch in batches:
            if not batch.num_rows:
                continue
            signs, nodes = batch.column(1).to_numpy(), batch.column(0).to_numpy()
            starts = np.flatnonzero(np.r_[True, signs[1:] != signs[:-1]])
            sizes = np.diff(np.r_[starts, len(signs)])
            firsts, several = np.repeat(nodes[starts], sizes), sizes > 1
            if group is None:
                yield rows_of(signs[:1], nodes[:1], nodes[:1], [True])
            goes_on = group == signs[0]
            if goes_on:
                firsts[: sizes[0]], several[0] = center, True
                if alone:
                    yield rows_of([group], [center], [center], [False])
            keep = np.repeat(several, sizes)
            yield rows_of(signs[keep], nodes[keep], firsts[keep], np.zeros(keep.sum(), dtype=bool))
            group, center, alone = int(signs[-1]), int(firsts[-1]), not several[-1]
        if group is not None:
            yield rows_of([group], [center], [center], [True])

    return ordered.mapInArrow(released(cut), "signature bigint, node bigint, first bigint, edge boolean")


def if_small(ids: DataFrame) -> DataFrame:
    """Broadcast if at most ``BROADCAST_IDS`` rows (8 MB for each column of ids); else a join shuffles."""
    return F.broadcast(ids) if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else ids


def possible(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Those of the distinct pairs (a, b) of doc_ids that sizes and sketches don't rule out: a few bytes of each set move, its
    text doesn't. A doc_id that stands for several texts is out if all of them are."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            rows = zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True)
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array([may_link(*r, percent) for r in rows], pa.bool_()))

    side_a, side_b = (sizes.select(F.col("doc_id").alias(n), F.col("n_shingles").alias(f"n_{n}"), F.col("sketch").alias(f"sketch_{n}")) for n in "ab")
    both = pairs.join(side_b, "b").join(side_a, "a").select("a", "b", "n_a", "sketch_a", "n_b", "sketch_b")
    return both.mapInArrow(released(check), "a bigint, b bigint").distinct()


def compare(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of the distinct pairs (a, b) of doc_ids that are linked, by their whole texts."""
    spark = pairs.sparkSession
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
    texts = _rows(docs).join(if_small(ids), "doc_id", "left_semi")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in small(batches):
            rows = []
            for a, b, text_a, text_b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if a not in known:
                    if len(known) > 64:
                        known.clear()
                    known[a] = shingle_set(text_a, words)
                if linked(known[a], shingle_set(text_b, words), percent):
                    rows.append((a, b))
            yield pa.record_batch([pa.array([r[k] for r in rows], pa.int64()) for k in (0, 1)], ["a", "b"])

    with_b = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    found = both.select("a", "b", "text_a", "text_b").mapInArrow(released(check), "a bigint, b bigint")
    return kept(spark, found, "links")


def least_common(a: str, b: str, percent: int) -> str:
    """SQL: the smallest number of common shingles of linked sets of ``a`` and ``b`` shingles."""
    return f"({percent} * ({a} + {b}) + {99 + percent}) div {100 + percent}"


def rarest(nodes: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """node, size, common, rare: of those sets of ``nodes`` (node, component) that can be linked to another component.

    ``common`` counts the shingles that sets of other components have too; ``rare`` holds as many of the rarest as any
    link needs to share one of. Shingles are 32-bit codes here: codes that collide only make sets look more alike.
    A node that stands for several texts has a row for each.
    """

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            sets = [(shingle_set(t, words) >> _U64(32)).astype("<u4").view("<i4") for t in batch.column(2).to_pylist()]
            lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, sets)], dtype=np.int32), pa.array(np.concatenate([np.empty(0, "<i4"), *sets]), pa.int32()))
            yield pa.record_batch([batch.column(0), batch.column(1), lists], ["node", "component", "codes"])

    # Rows that repeat a text count their shingles again, which only leaves more candidates.
    texts = _rows(docs).withColumnRenamed("doc_id", "node").join(if_small(nodes), "node").select("node", "component", "text")
    sets = texts.mapInArrow(released(codes), "node bigint, component bigint, codes array<int>")
    sets = kept(docs.sparkSession, sets.withColumn("of", F.xxhash64("codes")), "codes")
    rows = sets.select("node", "of", "component", F.explode("codes").alias("code"))
    spread = rows.groupBy("code").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("n"))
    spread = spread.filter("low <> high").select("code", F.col("n").cast("int").alias("n"))
    shared = rows.select("node", "of", "code").join(spread, "code").groupBy("node", "of")
    shared = shared.agg(F.count("*").cast("int").alias("common"), F.sort_array(F.collect_list(F.struct("n", "code"))).alias("by_n"))
    sizes = sets.select("node", "of", F.size("codes").alias("size")).distinct()
    linkable = shared.join(sizes, ["node", "of"]).filter(f"100 * common >= {percent} * size")
    # Shingles that no other component has come first of all, and are left out: no link shares them.
    first = f"transform(slice(by_n, 1, common - ({percent} * size + 99) div 100 + 1), x -> x.code)"
    return linkable.select("node", "size", "common", F.expr(first).alias("rare"))


def kept(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again: cuts the lineage, later uses don't compute it anew, and what was shuffled
    for it is gone."""
    folder = scratch(spark, label)
    with shuffles_freed(spark):
        df.write.parquet(folder)
    return spark.read.parquet(folder)


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node), for every node in ``links`` (a, b), by alternating large and small stars.

    A round takes minima of neighbours, which combine before the shuffle, and joins them back, which AQE splits for
    busy nodes. Rounds grow with the logarithm of the longest path.
    """
    spark = links.sparkSession
    edges = kept(spark, links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v")).filter("u <> v").distinct()
        large = kept(spark, large, "edges")
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("low").alias("v")).union(small.select("u", F.col("low").alias("v")))
        edges = kept(spark, small.filter("u <> v").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text); other columns are left out.

    Documents whose sets of word shingles have 100 * intersection >= percent * union are linked; ``component_id`` is the
    smallest doc_id reachable by links. Empty sets (null, empty or blank texts) link with nothing. Rows that repeat a
    doc_id have the component of their own set. A null doc_id takes no part: its component is null. No rows: no rows.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    folder = scratch(spark, "signed")
    signed_sets(docs, words, percent).write.parquet(folder)
    signed = spark.read.parquet(folder)
    sizes = kept(spark, signed.drop("signs"), "sizes")
    nodes = sizes.filter("set_key is not null").groupBy("set_key").agg(F.min("doc_id").alias("node"))

    members = reduce(DataFrame.union, [kept(spark, slices(signature_rows(signed, part)), "members") for part in range(PARTS)])
    discard(spark, folder)
    star = members.filter("first <> node").select(F.col("first").alias("a"), F.col("node").alias("b"))
    # Groups cut by a task's end: their slices' first nodes are compared with the smallest one.
    ends = members.filter("edge").select("signature", F.col("first").alias("b")).distinct()
    ends = ends.join(ends.groupBy("signature").agg(F.min("b").alias("a")), "signature").filter("a <> b").select("a", "b")
    tried = kept(spark, star.union(ends).distinct(), "pairs")
    links = compare(kept(spark, possible(tried, sizes, percent), "possible"), docs, words, percent)
    found = kept(spark, components(links), "components")

    # Groups that still span components. Similar members share S signatures, all of such groups.
    label = F.coalesce("component", "node")
    placed = members.select("signature", "node").distinct().join(found, "node", "left").select("signature", "node", label.alias("component"))
    placed = kept(spark, placed, "placed")
    groups = placed.groupBy("signature").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
    open_rows = placed.join(groups.filter("low <> high").select("signature", "size"), "signature")
    # Two nodes that share S signatures still share one if each leaves out the last S - 1 of its own, in one order for
    # all. The largest groups go last: those of a passage that many documents share.
    number = F.col("signature").bitwiseAND(F.lit(BAND_BITS - 1)).cast("int")
    open_rows = open_rows.withColumn("band", number)
    last = Window.partitionBy("node", "band").orderBy(F.desc("size"), "signature")
    open_rows = open_rows.withColumn("at", F.row_number().over(last)).filter(F.col("at") >= F.get(F.lit(shared_by_band(percent)), F.col("band")))
    open_rows = kept(spark, open_rows.drop("at", "size", "band"), "open")
    nodes_open = kept(spark, open_rows.select("node", "component").distinct(), "nodes")
    marks = kept(spark, rarest(nodes_open, docs, words, percent), "marks")
    open_rows = open_rows.join(marks, "node")
    left, right = (open_rows.select("signature", *(F.col(c).alias(f"{c}_{n}") for c in ("node", "component", "size", "common", "rare"))) for n in "ab")
    least = least_common("size_a", "size_b", percent)
    heads = (f"slice(rare_{n}, 1, cast(greatest(common_{n} - {least} + 1, 0) as int))" for n in "ab")
    linkable = f"component_a < component_b and least(common_a, common_b) >= {least} and arrays_overlap({', '.join(heads)})"
    cross = left.join(right, "signature").filter(linkable).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    cross = cross.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).join(tried, ["a", "b"], "left_anti")
    cross = kept(spark, possible(cross, sizes, percent), "pairs")
    more = compare(cross, docs, words, percent)
    if more.limit(1).count():
        found = kept(spark, components(links.union(more)), "components")

    by_set = nodes.join(found, "node", "left").select("set_key", label.alias("component"))
    out = sizes.join(by_set, "set_key", "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"))


@query("op10_jaccard_join")
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), words=4, percent=85)
