"""Embedding whitening (operator 11) with an exact scatter from bit planes.

Vectors become integers. A block of rows is turned into bit planes: for each dimension, one plane for each bit of its
numbers, shifted by the least one of the block, with 64 rows in a word. The sum of products of two dimensions is the
sum, over pairs of their planes, of the popcount of the planes' AND, weighted by the two bits. All sums are whole
numbers; they are centred as such, and only the finished covariance becomes floating point.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.registry import query, table
from tideline.session import scratch

SCALE, SHIFT = 64.0, 1_000_000
COMPONENTS = 16
# A number beyond +-LIMIT counts as +-LIMIT, so that every sum of products fits 38 digits.
LIMIT = 1 << 45
BLOCK_ROWS = 1 << 13
# A direction with less than this share of the largest variance has none: rounding alone gives as much.
NO_VARIANCE = 1e-12
_LONG = 1 << 62


def integers(vectors: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * vectors) + SHIFT, -LIMIT, LIMIT).astype(np.int64)


def usable(column: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Which rows have a vector without null or non-finite entries; and for each length, their places and matrix."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten()  # leaves out what null rows may hold
    values = flat.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    broken = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    good = column.is_valid().to_numpy(zero_copy_only=False) & (broken[ends] == broken[ends - lengths]) & (lengths > 0)
    parts = []
    for length in np.unique(lengths[good]):
        rows = np.flatnonzero(good & (lengths == length))
        parts.append((rows, values[(ends[rows] - length)[:, None] + np.arange(length)]))
    return good, parts


def _vectors(batch: pa.RecordBatch) -> pa.Array:
    return batch.column("embedding").cast(pa.list_(pa.float64()))


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """Each distinct integer vector once, as the column ``x``."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, matrix in usable(_vectors(batch))[1]:
                x = integers(matrix)
                offsets = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
                yield pa.record_batch([pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))], ["x"])

    return vectors.select("embedding").mapInArrow(convert, "x array<bigint>").distinct()


def block_sums(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the columns and of the products of each two columns, as whole numbers of any size."""
    n, dimensions = x.shape
    least = x.min(axis=0)
    shifted = (x - least).astype(np.uint64)
    bits = int(shifted.max()).bit_length()
    padded = np.zeros((-(-n // 64) * 64, dimensions), dtype=np.uint64)
    padded[:n] = shifted
    planes = np.zeros((bits, dimensions, len(padded) // 64), dtype=np.uint64)
    for bit in range(bits):
        ones = np.ascontiguousarray(((padded >> np.uint64(bit)) & np.uint64(1)).astype(np.uint8).T)
        planes[bit] = np.packbits(ones, axis=1).view(np.uint64)
    sums = np.zeros(dimensions, dtype=object)
    products = np.zeros((dimensions, dimensions), dtype=object)
    by_weight = np.zeros((2 * bits, dimensions, dimensions), dtype=np.int64)
    for i in range(bits):
        sums += np.bitwise_count(planes[i]).sum(axis=1, dtype=np.int64).astype(object) * (1 << i)
        for d in range(dimensions):
            counts = np.bitwise_count(planes[i, d] & planes[:, d:]).sum(axis=2, dtype=np.int64)
            by_weight[i : i + bits, d, d:] += counts
    for weight, counts in enumerate(by_weight):
        products += counts.astype(object) * (1 << weight)
    products += np.triu(products, 1).T
    # Undo the shift: x = y + least.
    low = least.astype(object)
    cross = sums[:, None] * low[None, :]
    return sums + n * low, products + cross + cross.T + n * low[:, None] * low[None, :]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Matrices of at most BLOCK_ROWS vectors of one length."""
    held: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for _, matrix in usable(batch.column("x"))[1]:
            length = matrix.shape[1]
            # Numbers within LIMIT are exact in a double.
            held.setdefault(length, []).append(matrix.astype(np.int64))
            if sum(map(len, held[length])) >= BLOCK_ROWS:
                rows = np.concatenate(held.pop(length))
                yield from (rows[at : at + BLOCK_ROWS] for at in range(0, len(rows), BLOCK_ROWS))
    for parts in held.values():
        yield np.concatenate(parts)


@dataclass
class Model:
    n: int
    sums: np.ndarray  # of each dimension, whole numbers
    components: np.ndarray  # (dimensions, k) unit vectors by falling variance
    variances: np.ndarray  # (k,)
    trace: float

    @property
    def varied(self) -> np.ndarray:
        return self.variances > NO_VARIANCE * max(self.variances[0], np.finfo(float).tiny)

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n * x - S exactly, as integers; and x - S / n."""
        wide = self.n * int(np.abs(x).max(initial=0)) + max(abs(s) for s in self.sums) >= _LONG
        kind = object if wide else np.int64
        exact = self.n * x.astype(kind) - self.sums.astype(kind)
        return exact, exact.astype(np.float64) / self.n

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        scale = np.where(self.varied, 1 / np.sqrt(np.where(self.varied, self.variances, 1.0)), 0.0)
        return (centred @ self.components) * scale


def _decimal(sums: np.ndarray) -> pa.Array:
    return pa.array([Decimal(int(s)) for s in sums], pa.decimal128(38, 0))


def fit(distinct: DataFrame, components: int = COMPONENTS) -> dict[int, Model]:
    """One model for each length of vector. The driver takes one sum for each two dimensions, whatever the number of rows."""

    def scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for x in _blocks(batches):
            sums, products = block_sums(x)
            held = totals.setdefault(x.shape[1], [0, 0, 0])
            held[0], held[1], held[2] = held[0] + len(x), held[1] + sums, held[2] + products
        for length, (n, sums, products) in totals.items():
            # Row -1 holds the sums of the dimensions, and at -1 the number of rows.
            a, b = np.triu_indices(length)
            first = np.concatenate([np.full(length + 1, -1), a])
            second = np.concatenate([[-1], np.arange(length), b])
            values = _decimal(np.concatenate([[n], sums, products[a, b]]))
            yield pa.record_batch([pa.array(np.full(len(first), length, np.int32)), pa.array(first.astype(np.int32)), pa.array(second.astype(np.int32)), values], ["length", "a", "b", "total"])

    moments = distinct.mapInArrow(scatter, "length int, a int, b int, total decimal(38,0)").groupBy("length", "a", "b").agg(F.sum("total").alias("total"))
    models = {}
    for length, found in groupby(sorted((r.length, r.a, r.b, int(r.total)) for r in moments.collect()), key=lambda r: r[0]):
        sums, products, n = np.zeros(length, dtype=object), np.zeros((length, length), dtype=object), 0
        for _, a, b, total in found:
            if a >= 0:
                products[a, b] = products[b, a] = total
            elif b >= 0:
                sums[b] = total
            else:
                n = total
        centred = n * products - sums[:, None] * sums[None, :]  # n * n * covariance, in whole numbers
        covariance = np.array([[value / (n * n) for value in row] for row in centred], dtype=np.float64)
        variances, vectors = np.linalg.eigh(covariance)
        k = min(components, length)
        models[length] = Model(n, sums, vectors[:, ::-1][:, :k], variances[::-1][:k], float(np.trace(covariance)))
    return models


def identity_error(distinct: DataFrame, models: dict[int, Model]) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, over the directions with variance.

    Two passes: the means first, then the products of what is centred by them.
    """

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
        for x in _blocks(batches):
            model = models[x.shape[1]]
            yield x.shape[1], model.whiten(model.centred(x)[1])[:, model.varied]

    def totals(summed):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, np.ndarray] = {}
            for length, z in whitened(batches):
                held[length] = held.get(length, 0) + summed(length, z)
            for length, found in held.items():
                a, b = np.indices(found.shape).reshape(2, -1).astype(np.int32)
                yield pa.record_batch([pa.array(np.full(len(a), length, np.int32)), pa.array(a), pa.array(b), pa.array(found.ravel())], ["length", "a", "b", "total"])

        rows = distinct.mapInArrow(run, "length int, a int, b int, total double").groupBy("length", "a", "b").agg(F.sum("total").alias("total")).collect()
        sizes = {length: int(m.varied.sum()) for length, m in models.items()}
        out = {length: np.zeros((max((r.a for r in rows if r.length == length), default=0) + 1, size)) for length, size in sizes.items()}
        for r in rows:
            out[r.length][r.a, r.b] = r.total / models[r.length].n
        return out

    if not models:
        return 0.0
    means = totals(lambda length, z: z.sum(axis=0)[None, :])
    squares = totals(lambda length, z: (z - means[length]).T @ (z - means[length]))
    return max((float(np.abs(s - np.eye(s.shape[1])).max()) for s in squares.values() if s.shape[1]), default=0.0)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: one row for each vector and component.

    The model is fitted on each distinct integer vector once; vectors of another length are whitened by a model of
    their own. Rows without a vector, with an empty one, or with a null or non-finite entry have no result; every other
    row has, repeated ones and those with a null ``vec_id`` too. ``deviation`` is exact, null beyond 38 digits. A
    direction without variance whitens to 0 and explains 0; the identity is not asked of it. Numbers beyond +-2**45
    count as that. Other columns are left out. No vectors: no rows.
    """
    spark = vectors.sparkSession
    folder = scratch(spark, "fit-list")
    integer_vectors(vectors).write.parquet(folder)  # read three times, and cheap to read again after a lost executor
    distinct = spark.read.parquet(folder)
    models = fit(distinct, components)
    error = identity_error(distinct, models)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, matrix in usable(_vectors(batch))[1]:
                model = models[matrix.shape[1]]
                exact, centred = model.centred(integers(matrix))
                k = len(model.variances)
                if exact.dtype != object and matrix.shape[1] * int(np.abs(exact).max()) ** 2 >= _LONG:
                    exact = exact.astype(object)
                squares = (exact * exact).sum(axis=1)
                deviation = pa.array([Decimal(int(s)) if s < 10**38 else None for s in squares], pa.decimal128(38, 0))
                each = np.repeat(np.arange(len(rows)), k)
                share = np.where(model.varied, model.variances / (model.trace or 1.0), 0.0)
                yield pa.record_batch(
                    [
                        batch.column("vec_id").take(pa.array(rows[each])),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(len(each), model.n, dtype=np.int64)),
                        deviation.take(pa.array(each)),
                        pa.array(model.whiten(centred).ravel()),
                        pa.array(np.tile(share, len(rows))),
                        pa.array(np.full(len(each), error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    schema = "vec_id bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    return vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").mapInArrow(project, schema)


@query("op11_bit_sliced_whitening")
def op11_bit_sliced_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("bigint"))
