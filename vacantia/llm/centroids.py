"""Centroid clustering in exact integers, with candidates filtered in a PCA-rotated space.

Vectors become integers once. They are stored with their leading rotated coordinates and
the norm of the rest; the squared projected distance plus the squared difference of the
residual norms never exceeds the squared distance. So a batch finds, for all centroids, a
lower bound by one small matrix product; only centroids whose bound does not exceed the
exact distance to the most promising one are compared in integers, where ties and minima
are exact. The rotation decides how much is filtered, never what results.

Each round is one pass over the stored table: tasks send one row per centroid and component,
summed before they are shuffled. What reaches the driver is bounded by centroids x components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.llm.common import small_batches, stored

#: Integers from this size on are refused: squared distances would leave 64 bits.
LARGEST = 1 << 26


def usable(vector: str, components: int) -> Column:
    """True for vectors of that many components, none null, NaN or infinite."""
    v = F.col(vector).cast("array<double>")
    fits = (F.size(v) == components) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fits, F.lit(False))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _lists(values: np.ndarray) -> pa.Array:
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(ends, pa.array(values.ravel()))


def _integers(column: pa.Array, width: int, scale: int) -> np.ndarray:
    scaled = np.floor(scale * _matrix(column, width).astype(np.float64))
    if len(scaled) and max(scaled.max(), -scaled.min()) >= LARGEST:
        raise ValueError(f"a component times {scale} is {LARGEST} or more: its squared distances would leave 64 bits")
    return scaled.astype(np.int64)


def rotation(vectors: DataFrame, width: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Principal directions of all *vectors* (column v), as columns, the widest first, and their variances.

    Tasks sum the products of components; the driver gets width * (width + 1) sums.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, number = np.zeros((width + 1, width)), 0
        for batch in batches:
            x = _integers(batch.column(0), width, scale).astype(np.float64)
            total[:width] += x.T @ x
            total[width] += x.sum(axis=0)
            number += len(x)
        flat = np.concatenate([total.ravel(), [number]])
        yield pa.record_batch([pa.array(np.arange(len(flat))), pa.array(flat)], names=["i", "s"])

    summed = vectors.select("v").mapInArrow(sums, "i long, s double").groupBy("i").agg(F.sum("s").alias("s"))
    flat = np.zeros((width + 1) * width + 1)
    for row in summed.collect():
        flat[row.i] = row.s
    number = max(flat[-1], 1.0)
    mean = flat[width * width : -1] / number
    spread = flat[: width * width].reshape(width, width) / number - np.outer(mean, mean)
    values, directions = np.linalg.eigh(spread)
    order = np.argsort(-values)
    return directions[:, order], np.maximum(values[order], 0)


def _prepared(axes: np.ndarray, width: int, scale: int, leading: int):
    """Rows (key, v) -> (key, ints, lead, rest): integers, leading coordinates, norm of the others."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _integers(batch.column(1), width, scale)
            turned = x @ axes
            rest = np.sqrt((turned[:, leading:] ** 2).sum(axis=1))
            yield pa.record_batch(
                [batch.column(0), _lists(x.astype(np.int32)), _lists(turned[:, :leading].astype(np.float32)), pa.array(rest)],
                names=["key", "ints", "lead", "rest"],
            )

    return apply


class Filter:
    """Nearest centroids of batches of vectors."""

    def __init__(self, centroids: np.ndarray, axes: np.ndarray, leading: int) -> None:
        self.centroids = centroids
        turned = centroids @ axes
        self.lead = turned[:, :leading]
        self.rest = np.sqrt((turned[:, leading:] ** 2).sum(axis=1))

    def nearest(self, ints: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(centroid, squared distance, centroids compared) per row; ties go to the smaller number."""
        near, far, compared = [], [], []
        for at in range(0, len(ints), 2_048):
            a, b, c = self._block(ints[at : at + 2_048], lead[at : at + 2_048], rest[at : at + 2_048])
            near.append(a), far.append(b), compared.append(c)
        return np.concatenate(near), np.concatenate(far), np.concatenate(compared)

    def _block(self, ints, lead, rest):
        size = (lead**2).sum(axis=1)[:, None] + (self.lead**2).sum(axis=1)
        least = size - 2 * (lead @ self.lead.T) + (rest[:, None] - self.rest) ** 2
        # Rounding (coordinates are stored in single precision) stays below this share of the squared norms.
        least -= 1e-6 * (size + rest[:, None] ** 2 + self.rest**2) + 1e-6
        first = least.argmin(axis=1)
        best = ((ints - self.centroids[first]) ** 2).sum(axis=1)
        rows, others = np.nonzero(least <= best[:, None])
        exact = np.empty(len(rows), np.int64)
        for i in range(0, len(rows), 8_192):
            part = slice(i, i + 8_192)
            exact[part] = ((ints[rows[part]] - self.centroids[others[part]]) ** 2).sum(axis=1)
        # Survivors of a row stand together, by number: the first of the least is the smallest number.
        begin = np.searchsorted(rows, np.arange(len(ints)))
        distance = np.minimum.reduceat(exact, begin)
        hit = np.flatnonzero(exact == distance[rows])
        nearest = others[hit[np.searchsorted(rows[hit], np.arange(len(ints)))]]
        return nearest, distance, np.bincount(rows, minlength=len(ints))


def _read(batch: pa.RecordBatch, at: int, width: int, leading: int):
    return (
        _matrix(batch.column(at), width).astype(np.int64),
        _matrix(batch.column(at + 1), leading).astype(np.float64),
        batch.column(at + 2).to_numpy(),
    )


def _moved(centroids: np.ndarray, table: DataFrame, axes: np.ndarray, leading: int) -> np.ndarray:
    """One round: assign all rows, then floor(sum / count) of each centroid that has any."""
    number, width = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Filter(centroids, axes, leading)
        total = np.zeros((number, width + 1), np.int64)  # the last column counts
        for batch in batches:
            ints, lead, rest = _read(batch, 0, width, leading)
            if not len(ints):
                continue
            near, _, _ = search.nearest(ints, lead, rest)
            np.add.at(total[:, :width], near, ints)
            total[:, width] += np.bincount(near, minlength=number)
        some = np.flatnonzero(total[:, width])
        yield pa.record_batch(
            [
                pa.array(np.repeat(some, width + 1)),
                pa.array(np.tile(np.arange(width + 1), len(some))),
                pa.array(total[some].ravel()),
            ],
            names=["cluster", "i", "s"],
        )

    small_batches(table.sparkSession)
    summed = table.select("ints", "lead", "rest").mapInArrow(sums, "cluster long, i long, s long")
    total = np.zeros((number, width + 1), np.int64)
    for row in summed.groupBy("cluster", "i").agg(F.sum("s").alias("s")).collect():
        total[row.cluster, row.i] = row.s
    some = total[:, width] > 0
    after = centroids.copy()
    after[some] = total[some, :width] // total[some, width:]
    return after


def clustered(
    vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", components: int = 64, scale: int = 256,
    number: int = 40, rounds: int = 5, seed: int = 2, leading: int | None = None, share: float = 0.9,
) -> DataFrame:
    """(key, cluster, distance, compared, cluster_inertia, inertia, centroid_sha256) per usable row of *vectors*.

    Usable are vectors with exactly *components* components, none null or non-finite; others
    are left out. A component x counts as floor(scale * x); 2**26 or more is an error, since
    distances would leave 64 bits. Centroids start as the *number* rows (fewer if there are
    fewer) with the smallest SHA-256 of ``seed:key`` (null key: as an empty one), ties by the
    integers. Ties of distance go to the smaller centroid; centroids without rows stay where
    they are. Repeated rows count as often as they stand there. Only *key* and *embedding*
    are read; an empty table gives no rows. *compared* is how many of the centroids the
    filter left to be compared in integers. *leading* coordinates are kept by the filter; by
    default as many as hold *share* of the variance of all rows, which the data decide.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    given = vectors.filter(usable(embedding, components)).select(
        F.col(key).alias("key"), F.col(embedding).cast("array<double>").alias("v")
    )
    axes, spread = rotation(given, components, scale)
    if leading is None:
        leading = 1 + int(np.searchsorted(np.cumsum(spread), share * spread.sum()))
    leading = min(leading, components)
    kind = given.schema["key"].dataType.simpleString()
    table = stored(
        given.mapInArrow(
            _prepared(axes, components, scale, leading), f"key {kind}, ints array<int>, lead array<float>, rest double"
        )
    )
    label = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit("")))
    drawn = table.select(F.sha2(label.cast("binary"), 256).alias("h"), "ints").orderBy("h", "ints").limit(number).collect()
    centroids = np.array([r.ints for r in drawn], np.int64).reshape(-1, components)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(centroids, table, axes, leading)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Filter(centroids, axes, leading)
        for batch in batches:
            if batch.num_rows:
                near, far, compared = search.nearest(*_read(batch, 1, components, leading))
                yield pa.record_batch(
                    [batch.column(0), pa.array(near.astype(np.int32)), pa.array(far), pa.array(compared.astype(np.int32))],
                    names=["key", "cluster", "distance", "compared"],
                )

    small_batches(spark)
    last = stored(table.mapInArrow(assign, f"key {kind}, cluster int, distance long, compared int"))
    sums = {r.cluster: r.s for r in last.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(i, sums.get(i, 0), sum(sums.values()), digest[i]) for i in range(len(centroids))]
    # One row per centroid: bounded by *number*.
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return last.join(F.broadcast(facts), "cluster").select(
        F.col("key").alias(key), "cluster", "distance", "compared", "cluster_inertia", "inertia", "centroid_sha256"
    )
