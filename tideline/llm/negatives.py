"""Hard-negative mining (operator 12) with exact inner products of packed integers.

The components of many candidates stand in separate fields of one wide integer for each dimension, shifted so that
none is negative. Such an integer times one component of an anchor holds that component's products with all of the
candidates; the sum over the dimensions holds all inner products, and no field can overflow into the next. Taking the
two shifts back gives the exact scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.llm.registry import query, table
from tideline.llm.whitening import usable
from tideline.operators.joins import small_side
from tideline.session import scratch

SCALE = 256.0
# An integer component beyond +-LIMIT counts as +-LIMIT: scores of up to 32,768 such components fit a long.
LIMIT = 1 << 24
POSITIVES = NEGATIVES = 5
LOWER = 80
# Candidates of one wide integer, and the most of one shard, whose wide integers one task holds.
PACK = 512
SHARD_ROWS = 1 << 15

FOUND = "anchor_id bigint, anchor_key bigint, place int, score bigint, other_id bigint, other_score bigint"
ASKED_FOR = "array<struct<other_id: bigint, other_score: bigint>>"


@dataclass
class Pack:
    """At most PACK candidates of one length, by their label, for anchors whose components are within +-bound."""

    ids: np.ndarray
    labels: np.ndarray
    sums: np.ndarray  # of each candidate's components
    wide: list[int]  # for each dimension, the candidates' shifted components in fields of ``width`` bytes
    least: int
    bound: int
    width: int

    @staticmethod
    def of(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, bound: int) -> Pack:
        least = int(vectors.min())
        largest = vectors.shape[1] * (int(vectors.max()) - least) * 2 * bound
        width = next(w for w in (4, 8, 16) if largest < 1 << 8 * w)
        fields = np.zeros((vectors.shape[1], len(ids), width // 4), dtype="<u4")
        fields[:, :, 0] = (vectors - least).T
        wide = [int.from_bytes(row.tobytes(), "little") for row in fields]
        return Pack(ids, labels, vectors.sum(axis=1), wide, least, bound, width)

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """Inner products of an anchor with the candidates."""
        shifted = (anchor + self.bound).tolist()
        packed = sum(map(int.__mul__, shifted, self.wide)).to_bytes(len(self.ids) * self.width, "little")
        # (a + bound)(c - least) = ac + bound * c - least * (a + bound)
        back = self.least * sum(shifted) - self.bound * self.sums
        if self.width < 16:
            return np.frombuffer(packed, dtype=f"<u{self.width}").astype(np.int64) + back  # modulo 2 ** 64, as the score fits
        low, high = np.frombuffer(packed, dtype="<u8").astype(object).reshape(-1, 2).T
        return (low + high * (1 << 64) + back).astype(np.int64)


class Shard:
    def __init__(self, bound: int):
        self.bound = bound
        self.rows: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        self.packs: dict[int, list[Pack]] | None = None

    def add(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        self.rows.setdefault(vectors.shape[1], []).append((ids, labels, vectors))

    def of_length(self, length: int) -> list[Pack]:
        if self.packs is None:
            self.packs = {}
            for size, parts in self.rows.items():
                ids, labels, vectors = (np.concatenate(x) for x in zip(*parts, strict=True))
                by = np.argsort(labels, kind="stable")
                ids, labels, vectors = ids[by], labels[by], vectors[by]
                self.packs[size] = [Pack.of(*(x[at : at + PACK] for x in (ids, labels, vectors)), self.bound) for at in range(0, len(ids), PACK)]
            self.rows.clear()
        return self.packs.get(length, [])

    def scored(self, own: int, label: int, anchor: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the other rows with the anchor's label, or of those with another."""
        ids, scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for pack in self.of_length(len(anchor)):
            first, last = pack.labels[0], pack.labels[-1]
            if not first <= label <= last if same else first == label == last:
                continue
            which = (pack.labels == label) == same
            which &= pack.ids != own
            if which.any():
                ids.append(pack.ids[which])
                scores.append(pack.scores(anchor)[which])
        return np.concatenate(ids), np.concatenate(scores)


def first_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` by falling score, ties by smaller id."""
    near = np.arange(len(scores))
    if len(scores) > k:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def integer_rows(rows: DataFrame, scale: float) -> DataFrame:
    """vec_id, label, q: rows that take part, with floor(scale * component) as integers."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, matrix in usable(batch.column("embedding"))[1]:
                q = np.clip(np.floor(scale * matrix), -LIMIT, LIMIT).astype(np.int32)
                lists = pa.ListArray.from_arrays(np.arange(0, q.size + 1, q.shape[1], dtype=np.int32), pa.array(q.ravel()))
                largest = pa.array(np.abs(q).max(axis=1))
                yield pa.record_batch([batch.column("vec_id").take(pa.array(places)), batch.column("label").take(pa.array(places)), lists, largest], ["vec_id", "label", "q", "largest"])

    long = lambda name: F.col(name).cast("bigint").alias(name)
    asked = rows.select(long("vec_id"), long("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    return asked.filter("vec_id is not null and label is not null").mapInArrow(convert, "vec_id bigint, label bigint, q array<int>, largest int")


def sharded(spark: SparkSession, folder: str, shard_rows: int) -> tuple[DataFrame, int]:
    """The rows in ``folder`` with a shard, by their place in the files, so that no key or content makes a shard large."""
    rows = spark.read.parquet(folder).select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    counted = rows.groupBy("file").agg(F.count("*").alias("rows"))
    starts = counted.select("file", (F.sum("rows").over(Window.orderBy("file")) - F.col("rows")).alias("start"))
    n, parts = counted.agg(F.sum("rows")).first()[0] or 0, int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = max(1, min(shard_rows, -(-n // parts)))
    shard = F.floor((F.col("start") + F.col("row")) / size).cast("int").alias("shard")
    return rows.join(small_side(starts), "file").select("vec_id", "label", "q", shard), max(1, -(-n // size))


def against(rows: DataFrame, shards: int, anchors: DataFrame, bound: int, visit: Callable) -> DataFrame:
    """Sends every anchor to every shard, the stated query set against all rows; candidates are shuffled once, never copied.

    In a task, the candidates of a shard come before its anchors, which stream past them.
    """
    copies = anchors.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    candidates = rows.select("shard", "vec_id", "label", "q", F.lit(None).cast("bigint").alias("anchor_key"), F.lit(None).cast(ASKED_FOR).alias("asked_for"))
    placed = candidates.unionByName(copies.select(*candidates.columns)).withColumn("is_anchor", F.col("anchor_key").isNotNull())
    ordered = placed.repartitionById(shards, "shard").sortWithinPartitions("shard", "is_anchor")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard = None, Shard(bound)
        for batch in batches:
            numbers = batch.column("shard").to_numpy()
            is_anchor = batch.column("is_anchor").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(is_anchor.astype(np.int8)) != 0)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(numbers)], strict=True):
                if start == end:
                    continue
                if numbers[start] != at:
                    at, shard = numbers[start], Shard(bound)
                part = batch.slice(start, end - start)
                ids, labels = part.column("vec_id").to_numpy(), part.column("label").to_numpy()
                keys, asked_for = part.column("anchor_key").to_pylist(), part.column("asked_for").to_pylist()
                found = []
                for places, matrix in usable(part.column("q"))[1]:
                    vectors = matrix.astype(np.int64)
                    if is_anchor[start]:
                        for place, vector in zip(places, vectors, strict=True):
                            own = int(ids[place])
                            found += [(own, keys[place], *row) for row in visit(shard, own, labels[place], vector, asked_for[place])]
                    else:
                        shard.add(ids[places], labels[places], vectors)
                if found:
                    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                    names = ["anchor_id", "anchor_key", "place", "score", "other_id", "other_score"]
                    yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*found, strict=True), types, strict=True)], names)

    return ordered.mapInArrow(run, FOUND)


def mine(
    rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, lower: int = LOWER,
    scale: float = SCALE, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A row's score is the inner product of its integer vector, floor(scale * component), with the anchor's; higher ones
    come first, ties by smaller vec_id. An anchor's positives are its first ``positives`` other rows of the same label.
    For each, the negatives are the first ``negatives`` rows of other labels with
    lower * positive score <= 100 * score <= 100 * positive score; a positive without any has no row here.

    ``rows`` and ``anchors`` have vec_id, label (whole numbers) and embedding; other columns are left out. Rows with a
    null in one of them, an empty vector, or a null or non-finite component take no part; vectors of another length
    than the anchor's don't meet it. A repeated row is as many candidates, but none of an anchor with its vec_id, and a
    repeated anchor is asked once. No rows or no anchors: no rows.
    """
    spark = rows.sparkSession
    folder = scratch(spark, "candidates")
    integer_rows(rows, scale).hint("rebalance").write.parquet(folder)
    candidates, shards = sharded(spark, folder, shard_rows)
    asked = integer_rows(anchors, scale).dropDuplicates(["vec_id", "label", "q"]).withColumn("anchor_key", F.xxhash64("label", "q"))
    asked_folder = scratch(spark, "anchors")
    asked.write.parquet(asked_folder)
    asked = spark.read.parquet(asked_folder)
    bound = asked.agg(F.max("largest")).first()[0] or 1
    by_score = lambda *keys: Window.partitionBy(*keys).orderBy(F.desc("other_score"), "other_id")

    def same_label(shard: Shard, own: int, label: int, anchor: np.ndarray, _) -> Iterator[tuple]:
        ids, scores = shard.scored(own, label, anchor, same=True)
        for i in first_of(scores, ids, positives):
            yield 0, 0, int(ids[i]), int(scores[i])

    near = against(candidates, shards, asked.withColumn("asked_for", F.lit(None).cast(ASKED_FOR)), bound, same_label)
    first = near.withColumn("n", F.row_number().over(by_score("anchor_id", "anchor_key"))).filter(F.col("n") <= positives)
    lists = first.groupBy("anchor_id", "anchor_key").agg(F.sort_array(F.collect_list(F.struct("n", "other_id", "other_score"))).alias("found"))
    positive_folder = scratch(spark, "positives")
    lists.write.parquet(positive_folder)
    chosen = spark.read.parquet(positive_folder).select(
        F.col("anchor_id").alias("vec_id"), "anchor_key", F.transform("found", lambda x: F.struct(x["other_id"], x["other_score"])).cast(ASKED_FOR).alias("asked_for")
    )

    def other_label(shard: Shard, own: int, label: int, anchor: np.ndarray, asked_for: list[dict]) -> Iterator[tuple]:
        ids, scores = shard.scored(own, label, anchor, same=False)
        for place, positive in enumerate(asked_for):
            score = positive["other_score"]
            inside = np.flatnonzero((scores >= -(-lower * score // 100)) & (scores <= score))
            for i in inside[first_of(scores[inside], ids[inside], negatives)]:
                yield place, score, int(ids[i]), int(scores[i])

    hard = against(candidates, shards, asked.join(chosen, ["vec_id", "anchor_key"]), bound, other_label)
    named = spark.read.parquet(positive_folder).select("anchor_id", "anchor_key", F.posexplode("found").alias("place", "positive")).select(
        "anchor_id", "anchor_key", "place", F.col("positive.other_id").alias("positive_id")
    )
    ranked = hard.withColumn("rank", F.row_number().over(by_score("anchor_id", "anchor_key", "place"))).filter(F.col("rank") <= negatives)
    return ranked.join(named, ["anchor_id", "anchor_key", "place"]).select(
        "anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), F.col("score").alias("positive_score"), F.col("other_score").alias("negative_score")
    )


ROWS_SQL = """
SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS q
FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
"""


@query(
    "op12_packed_negatives",
    f"""
    WITH r AS ({ROWS_SQL}),
    s AS (
      SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
        CAST(list_sum([z[1] * z[2] for z in list_zip(a.q, b.q)]) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
    p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT p.anchor_id, p.vec_id AS positive_id, CAST(row_number() OVER k AS INT) AS rank, s.vec_id AS negative_id,
      p.score AS positive_score, s.score AS negative_score
    FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
    WINDOW k AS (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id)
    QUALIFY row_number() OVER k <= 5
    """,
)
def op12_packed_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return mine(rows, rows.filter(F.col("vec_id") % 100 == 0))
