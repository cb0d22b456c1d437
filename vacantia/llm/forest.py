"""Embedding near-duplicates by a forest of random-projection trees with spill.

Trees are fitted on a bounded sample; every vector is then routed through all of them and
goes to both sides of a split that it is close to. Pairs are compared exactly within leaves.
A pair that meets in several leaves counts in the first of them only, which both vectors
know from their lists of leaves; so links are counted without writing pairs, and a leaf
leaves a spanning forest of its links: at most one edge per vector, however dense it is.
Equal vectors are one class throughout. Leaves that more vectors reach than are compared at
once are split again by samples of their own before anything is shuffled, until none is left
that can be split; what is too dense for that is split in its task as far as it can be.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacantia.llm.common import components, small_batches, stored
from vacantia.llm.simhash import _forest

#: Vectors that a leaf should have; leaves of up to four times as many are compared at once.
LEAF = 1_500
#: Groups (label and dimension) that are given trees at once; others follow if they are too large for one leaf.
MAX_GROUPS = 5_000
#: Large leaves split at once, and sampled vectors of each at least.
MAX_LEAVES, LEAF_SAMPLE = 500, 128


@dataclass
class Node:
    """A split; a leaf has no direction."""

    name: int
    direction: np.ndarray | None = None
    at: float = 0.0
    low: Node | None = None
    high: Node | None = None


def grow(rng: np.random.Generator, sample: np.ndarray, leaves: float, spill: float) -> Node:
    """A tree with about *leaves* leaves, split at the medians of random projections."""
    node = Node(int(rng.integers(1 << 62)))
    if leaves < 2 or len(sample) < 16:
        return node
    direction = rng.standard_normal(sample.shape[1])
    direction /= np.linalg.norm(direction)
    place = sample @ direction
    at = float(np.median(place))
    low, high = place < at + spill, place >= at - spill
    if max(low.sum(), high.sum()) > 0.8 * len(sample):
        return node  # too dense to be split
    node.direction, node.at = direction, at
    node.low = grow(rng, sample[low], leaves * low.mean(), spill)
    node.high = grow(rng, sample[high], leaves * high.mean(), spill)
    return node


def route(node: Node, vectors: np.ndarray, rows: np.ndarray, spill: float) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, rows in it); rows within *spill* of a split go to both sides."""
    if not len(rows):
        return
    if node.direction is None:
        yield node.name, rows
        return
    place = vectors[rows] @ node.direction
    yield from route(node.low, vectors, rows[place < node.at + spill], spill)
    yield from route(node.high, vectors, rows[place >= node.at - spill], spill)


def leaves_of(node: Node) -> Iterator[Node]:
    """All leaves of a tree."""
    if node.direction is None:
        yield node
    else:
        yield from leaves_of(node.low)
        yield from leaves_of(node.high)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of norm 1. Each is first brought near 1 by a power of two, so squares neither overflow nor vanish."""
    _, power = np.frexp(np.abs(vectors).max(axis=1))
    vectors = np.ldexp(vectors, -power[:, None])
    return vectors / np.linalg.norm(vectors, axis=1)[:, None]


def _unit(batch: pa.RecordBatch, rows: np.ndarray) -> np.ndarray:
    """The unit vectors of the given rows, whose last column is the vector."""
    flat = batch.column(batch.num_columns - 1).take(pa.array(rows)).flatten()
    return unit(flat.to_numpy().astype(np.float64).reshape(len(rows), -1))


def _reached(shared, spill: float):
    """Rows (cid, grp, vector) -> (grp, leaf, n): vectors of a batch that reach each leaf."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            grp = np.array(batch.column(1).to_pylist())
            out = []
            for name in np.unique(grp):
                vectors = _unit(batch, np.flatnonzero(grp == name))
                for root in forest[str(name)]:
                    out += [(str(name), leaf, len(r)) for leaf, r in route(root, vectors, np.arange(len(vectors)), spill)]
            if out:
                yield pa.record_batch([pa.array(c) for c in zip(*out, strict=True)], names=["grp", "leaf", "n"])

    return apply


def _drawn(shared, spill: float):
    """Rows (cid, grp, vector) -> (leaf, vector) of those that the hash of row and leaf draws for a large leaf."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest, shares = shared.value
        for batch in batches:
            cid, grp = batch.column(0).to_numpy(), np.array(batch.column(1).to_pylist())
            for name in np.unique(grp):
                own = np.flatnonzero(grp == name)
                vectors = _unit(batch, own)
                for root in forest[str(name)]:
                    for leaf, rows in route(root, vectors, np.arange(len(own)), spill):
                        if leaf not in shares:
                            continue
                        x = (cid[own[rows]] ^ leaf).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                        rows = rows[(x >> np.uint64(32)).astype(np.float64) < shares[leaf] * 2**32]
                        if len(rows):
                            yield pa.record_batch(
                                [pa.array(np.full(len(rows), leaf)), pa.array(list(vectors[rows]), pa.list_(pa.float64()))],
                                names=["leaf", "vector"],
                            )

    return apply


def deepen(classes: DataFrame, forest: dict[str, list[Node]], large: dict[str, int], rng: np.random.Generator, trees: int, spill: float) -> None:
    """Split leaves in place until no leaf of the *large* groups that can be split is above the bound.

    Only as many leaves as the driver can hold samples of are split at a time.
    """
    spark = classes.sparkSession
    for name in sorted(large):
        if name not in forest:
            forest[name] = [Node(int(rng.integers(1 << 62))) for _ in range(trees)]
    dense: set[int] = set()
    names = spark.createDataFrame([(n,) for n in sorted(large)], "grp string")
    rows = classes.join(F.broadcast(names), "grp", "left_semi").select("cid", "grp", "v")
    while True:
        small_batches(spark)
        shared = spark.sparkContext.broadcast(forest)
        reached = rows.mapInArrow(_reached(shared, spill), "grp string, leaf long, n long")
        over = reached.groupBy("leaf").agg(F.sum("n").alias("n")).filter(F.col("n") > 4 * LEAF)
        if dense:
            over = over.join(F.broadcast(spark.createDataFrame([(x,) for x in dense], "leaf long")), "leaf", "left_anti")
        sizes = {r.leaf: r.n for r in over.orderBy(F.desc("n"), "leaf").limit(MAX_LEAVES).collect()}
        shared.destroy()
        if not sizes:
            return
        wanted = max(LEAF_SAMPLE, 20_000 // len(sizes))
        shares = {leaf: min(1.0, wanted / n) for leaf, n in sizes.items()}
        shared = spark.sparkContext.broadcast((forest, shares))
        drawn = rows.mapInArrow(_drawn(shared, spill), "leaf long, vector array<double>")
        samples: dict[int, list] = {}
        for r in drawn.collect():
            samples.setdefault(r.leaf, []).append(r.vector)
        shared.destroy()
        for name in sorted(large):
            for node in [x for root in forest[name] for x in leaves_of(root)]:
                if node.name not in sizes:
                    continue
                own = np.array(sorted(samples.get(node.name, [])), np.float64)
                for _ in range(3):
                    split = grow(rng, own, sizes[node.name] / LEAF, spill)
                    if split.direction is not None:
                        node.direction, node.at, node.low, node.high = split.direction, split.at, split.low, split.high
                        break
                else:
                    dense.add(node.name)


def _lists(found: list[tuple[int, np.ndarray]], number: int) -> np.ndarray:
    """Sorted leaves of each row, padded with -1."""
    rows = np.concatenate([r for _, r in found])
    names = np.concatenate([np.full(len(r), n) for n, r in found])
    order = np.lexsort((names, rows))
    rows, names = rows[order], names[order]
    many = np.bincount(rows, minlength=number)
    out = np.full((number, int(many.max())), -1, np.int64)
    out[rows, np.arange(len(rows)) - np.repeat(np.cumsum(many) - many, many)] = names
    return out


def _first_common(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """The least name that both lists of a pair have."""
    best = np.full(len(one), np.iinfo(np.int64).max)
    for column in one.T:
        there = (column[:, None] == two).any(axis=1) & (column >= 0)
        best = np.where(there, np.minimum(best, column), best)
    return best


class Leaf:
    """The vectors of one leaf and their links."""

    def __init__(self, least: float, spill: float, trees: int) -> None:
        self.least, self.spill, self.trees = least, spill, trees

    def links(self, leaf: int, ids, weights, lists, vectors) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """(weighted links per row, edges) of the pairs that meet here first."""
        number = len(ids)
        counts = np.zeros(number, np.int64)
        edges: list[tuple[np.ndarray, np.ndarray]] = []
        parts = [(leaf, np.arange(number))]
        inner = None
        if number > 4 * LEAF:
            rng = np.random.default_rng(leaf % (1 << 63))
            roots = [grow(rng, vectors[rng.choice(number, min(number, 20_000), replace=False)], number / LEAF, self.spill) for _ in range(self.trees)]
            if any(r.direction is not None for r in roots):
                parts = [p for r in roots for p in route(r, vectors, np.arange(number), self.spill)]
                inner = _lists(parts, number)
        for name, rows in parts:
            own = vectors[rows]
            for start in range(0, len(rows), 512):
                close = own[start : start + 512] @ own[start:].T >= self.least
                a, b = np.nonzero(np.triu(close, 1))
                for at in range(0, len(a), 100_000):
                    i, j = rows[start + a[at : at + 100_000]], rows[start + b[at : at + 100_000]]
                    here = _first_common(lists[i], lists[j]) == leaf
                    if inner is not None:
                        here &= _first_common(inner[i], inner[j]) == name
                    i, j = i[here], j[here]
                    if len(i):
                        np.add.at(counts, i, weights[j])
                        np.add.at(counts, j, weights[i])
                        edges.append(_forest(ids[i], ids[j]))
        return counts, edges


def _router(shared, trees: int, spill: float):
    """Rows (cid, grp, weight, vector) -> one row per leaf of each vector, with all its leaves."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = shared.value
        for batch in batches:
            cid, grp, weight = batch.column(0).to_numpy(), np.array(batch.column(1).to_pylist()), batch.column(2).to_numpy()
            for name in np.unique(grp):
                own = np.flatnonzero(grp == name)
                vectors = _unit(batch, own)
                roots = forest.get(name) or [Node(0)]
                found = [p for r in roots for p in route(r, vectors, np.arange(len(own)), spill)]
                lists = _lists(found, len(own))
                for leaf, rows in found:
                    for at in range(0, len(rows), 2_000):
                        r = rows[at : at + 2_000]
                        flat = pa.array(vectors[r].ravel())
                        width = vectors.shape[1]
                        own_lists = lists[r]
                        yield pa.record_batch(
                            [
                                pa.array(np.full(len(r), leaf)),
                                pa.array([str(name)] * len(r)),
                                pa.array(cid[own[r]]),
                                pa.array(weight[own[r]]),
                                pa.ListArray.from_arrays(np.arange(len(r) + 1, dtype=np.int32) * own_lists.shape[1], pa.array(own_lists.ravel())),
                                pa.ListArray.from_arrays(np.arange(len(r) + 1, dtype=np.int32) * width, flat),
                            ],
                            names=["leaf", "grp", "cid", "weight", "leaves", "vector"],
                        )

    return apply


def _comparer(least: float, spill: float, trees: int):
    """Rows sorted by (grp, leaf) -> (a, b, null) edges and (a, null, n) counts."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = Leaf(least, spill, trees)
        held: list[pa.RecordBatch] = []
        now = None

        def solved() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held)
            ids, weights = rows.column("cid").to_numpy(), rows.column("weight").to_numpy()
            lists = rows.column("leaves").to_pylist()
            width = max(map(len, lists))
            names = np.array([x + [-1] * (width - len(x)) for x in lists], np.int64)
            vectors = rows.column("vector").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
            counts, edges = worker.links(now[1], ids, weights, names, vectors)
            some = np.flatnonzero(counts)
            if len(some):
                yield pa.record_batch(
                    [pa.array(ids[some]), pa.nulls(len(some), pa.int64()), pa.array(counts[some])], names=["a", "b", "n"]
                )
            if edges:
                a, b = _forest(*(np.concatenate(x) for x in zip(*edges, strict=True)))
                yield pa.record_batch([pa.array(a), pa.array(b), pa.nulls(len(a), pa.int64())], names=["a", "b", "n"])

        for batch in batches:
            keys = list(zip(batch.column("grp").to_pylist(), batch.column("leaf").to_pylist(), strict=True))
            start = 0
            for i in range(1, len(keys) + 1):
                if i == len(keys) or keys[i] != keys[start]:
                    if held and keys[start] != now:
                        yield from solved()
                        held = []
                    now = keys[start]
                    held.append(batch.slice(start, i - start))
                    start = i
        if held:
            yield from solved()

    return apply


def linked(
    vectors: DataFrame,
    key: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    least: float = 0.98,
    trees: int = 4,
    spill: float | None = None,
    max_sample: int = 20_000,
) -> DataFrame:
    """(key, n_links, component) per row of *vectors*.

    Rows link if their labels are equal and not null, their dimensions are equal, and their
    cosine in double precision is *least* or more. Null, empty and zero vectors and those
    with a null or non-finite component link with nothing: 0 links, the component is the
    key. Repeated rows are vectors of their own that link with each other. A component is
    its least key that is not null. *spill* is half the typical projected distance of a pair
    at the threshold by default. The trees are fitted on about *max_sample* vectors, and
    leaves that are still too large on samples of their own; every row is indexed and compared.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(key).alias("vid"), F.col(label).cast("string").alias("label"), F.col(embedding).cast("array<double>").alias("v"))
    fits = (
        F.col("label").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    grp = F.concat_ws("|", "label", F.size("v").cast("string"))
    usable = rows.filter(F.coalesce(fits, F.lit(False))).select("vid", grp.alias("grp"), "v")
    classes = usable.groupBy("grp", "v").agg(F.count("*").alias("weight"), F.min("vid").alias("first"))
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()))
    sizes = {
        r.grp: r.n
        for r in classes.groupBy("grp").agg(F.count("*").alias("n")).filter(F.col("n") > LEAF)
        .orderBy(F.desc("n"), "grp").limit(MAX_GROUPS).collect()
    }
    forest: dict[str, list[Node]] = {}
    width = 64
    if sizes:
        share = int(min(1.0, max_sample / sum(sizes.values())) * 1_000_000)
        large = spark.createDataFrame([(g,) for g in sizes], "grp string")
        chosen = classes.join(F.broadcast(large), "grp", "left_semi").filter(F.pmod(F.xxhash64(F.lit("fit"), "v"), F.lit(1_000_000)) < share)
        sample: dict[str, list] = {}
        for r in chosen.select("grp", "cid", "v").collect():
            sample.setdefault(r.grp, []).append((r.cid, r.v))
        sample = {g: [v for _, v in sorted(own)] for g, own in sample.items()}
        width = max(len(v[0]) for v in sample.values()) if sample else width
    if spill is None:
        spill = 0.5 * math.sqrt(max(0.0, 2 - 2 * least)) / math.sqrt(width)
    if sizes:
        rng = np.random.default_rng(20)
        done: set[str] = set()
        for name, own in sorted(sample.items()):
            x = unit(np.array(own, np.float64))
            forest[name] = [grow(rng, x, sizes[name] / LEAF, spill) for _ in range(trees)]
        while True:
            over = classes.groupBy("grp").agg(F.count("*").alias("n")).filter(F.col("n") > 4 * LEAF)
            if done:
                over = over.join(F.broadcast(spark.createDataFrame([(g,) for g in done], "grp string")), "grp", "left_anti")
            more = {r.grp: r.n for r in over.orderBy(F.desc("n"), "grp").limit(MAX_GROUPS).collect()}
            if not more:
                break
            deepen(classes, forest, more, rng, trees, spill)
            done.update(more)
    small_batches(spark)
    shared = spark.sparkContext.broadcast(forest)
    routed = classes.select("cid", "grp", "weight", "v").mapInArrow(
        _router(shared, trees, spill),
        "leaf long, grp string, cid long, weight long, leaves array<long>, vector array<double>",
    )
    found = stored(
        routed.repartition("grp", "leaf")
        .sortWithinPartitions("grp", "leaf")
        .mapInArrow(_comparer(least, spill, trees), "a long, b long, n long")
    )
    shared.destroy()
    counts = found.filter("n is not null").groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("others"))
    roots = components(found.filter("b is not null").select("a", "b")).withColumnRenamed("node", "cid")
    joined = (
        classes.join(counts, "cid", "left")
        .join(roots, "cid", "left")
        .select("grp", "v", "first", F.coalesce("root", "cid").alias("root"), (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    )
    joined = stored(joined)
    least_key = joined.groupBy("root").agg(F.min("first").alias("component"))
    per_class = joined.join(least_key, "root").select("grp", "v", "n_links", "component")
    members = usable.join(per_class, ["grp", "v"]).select("vid", "n_links", "component")
    alone = rows.filter(~F.coalesce(fits, F.lit(False))).select(
        "vid", F.lit(0).cast("long").alias("n_links"), F.col("vid").alias("component")
    )
    return members.unionByName(alone).withColumnRenamed("vid", key)
