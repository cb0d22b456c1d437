"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at no more than 2k differing bits have a common variant within k bits of
both, and two fingerprints that share such a variant are at no more than 2k bits. So all
variants within half the radius are compared for equality, and a match needs no more than
the distance that the common variant already proves.

All variants of a fingerprint (2,081 for radius 4) are never shuffled one by one: a record
per reachable *prefix* of a variant is (56 for a 10-bit prefix), and the task that owns a
prefix makes the variants below it, in blocks of bounded size. The prefix grows with the
logarithm of the number of fingerprints, so a prefix keeps about as many records at any
size. Links leave a prefix as a spanning forest: at most one per fingerprint, however
large a group of copies is.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from xxhash import xxh64_intdigest

from vacantia.llm.common import components, small_batches, stored

#: Variants that a task holds at once.
BLOCK = 1 << 20
_HASH = partial(xxh64_intdigest, seed=42)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8: A-Z lower-cased, cut at ASCII white space."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of *width* words, repeats included."""
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < width:
        return np.array([_HASH(b" ".join(words))], np.uint64)
    runs = zip(*(words[i:] for i in range(width)), strict=False)
    return np.fromiter(map(_HASH, map(b" ".join, runs)), np.uint64, len(words) - width + 1)


def majority(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes, as a signed long."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes))
    return int(bits.view(">u8")[0].astype(np.uint64).view(np.int64))


def _again(hashes: np.ndarray, turn: int) -> np.ndarray:
    """The hashes as another hash function would give them; the first turn leaves them."""
    if turn == 0:
        return hashes
    x = (hashes + np.uint64(turn * 0x9E3779B97F4A7C15 & 2**64 - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(width: int, number: int = 1):
    """Column function: *number* independent fingerprints of a text (null and empty: 0)."""

    @F.pandas_udf("array<long>")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            hashed = [shingle_hashes(words_of(t), width) for t in texts]
            yield pd.Series([[majority(_again(h, i)) for i in range(number)] for h in hashed])

    return apply


def min_hash_bands(hashes: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A hash of each band of *rows* MinHash values, as signed longs (no hashes: none).

    Two sets at Jaccard similarity s have a given band in common with chance s ** rows.
    """
    if not len(hashes):
        return np.empty(0, np.int64)
    salts = np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    salts = _again(salts, 1)[:, None]
    least = np.full(bands * rows, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 1 << 9):
        part = (hashes[at : at + (1 << 9)] ^ salts) * (salts | np.uint64(1))
        np.minimum(least, part.min(axis=1), out=least)
    # Equal values in another place are another band.
    out = np.arange(bands, dtype=np.uint64)
    for row in least.reshape(bands, rows).T:
        out = _again(out ^ row, 1)
    return out.view(np.int64)


def banded(width: int, bands: int, rows: int):
    """Column function: MinHash bands of the shingles of a text (null and empty: none)."""

    @F.pandas_udf("array<long>")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([min_hash_bands(shingle_hashes(words_of(t), width), bands, rows) for t in texts])

    return apply


def _masks(bits: int, most: int) -> list[int]:
    return [sum(1 << i for i in c) for k in range(most + 1) for c in combinations(range(bits), k)]


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, least node of its group) of the graph with edges a-b."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        after = label.copy()
        np.minimum.at(after, label[x], low)
        np.minimum.at(after, label[y], low)
        after = after[after]
        if (after == label).all():
            break
        label = after
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


class _Prefix:
    """Finds all links whose common variant begins with a prefix."""

    def __init__(self, half: int) -> None:
        self.half = half
        self.low: dict[tuple[int, int], np.ndarray] = {}

    def masks(self, bits: int, most: int) -> np.ndarray:
        key = (bits, min(most, bits))
        if key not in self.low:
            self.low[key] = np.array(_masks(*key), np.uint64)
        return self.low[key]

    def links(self, prefix: int, length: int, fps: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        rest = 64 - length
        head = fps >> np.uint64(rest) if rest else fps
        spare = self.half - np.bitwise_count(head ^ np.uint64(prefix)).astype(np.int64)
        fps, spare = fps[spare >= 0], spare[spare >= 0]
        if len(fps) < 2:
            return []
        each = [self.masks(rest, r) for r in range(self.half + 1)]
        if rest and sum(len(each[r]) * int((spare == r).sum()) for r in range(self.half + 1)) > BLOCK:
            deeper = min(2, rest)
            found = []
            for tail in range(1 << deeper):
                found += self.links((prefix << deeper) | tail, length + deeper, fps)
            return found
        below = np.uint64((1 << rest) - 1)
        variants, owners = [], []
        for r in range(self.half + 1):
            own = fps[spare == r]
            if len(own):
                variants.append(((own & below)[:, None] ^ each[r][None, :]).ravel())
                owners.append(np.repeat(own, len(each[r])))
        variant, owner = np.concatenate(variants), np.concatenate(owners)
        ordered = np.sort(variant)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if not len(twice):
            return []
        # Few variants meet: only those are put in order together with their owners.
        slots = np.zeros(1 << 16, bool)
        mix = np.uint64(0x9E3779B97F4A7C15)
        slots[(twice * mix) >> np.uint64(48)] = True
        near = slots[(variant * mix) >> np.uint64(48)]
        variant, owner = variant[near], owner[near]
        order = np.lexsort((owner, variant))
        variant, owner = variant[order], owner[order]
        new = np.concatenate([[True], variant[1:] != variant[:-1]])
        least = owner[np.flatnonzero(new)[np.cumsum(new) - 1]]
        met = least != owner
        if not met.any():
            return []
        return [_forest(owner[met], least[met])]


def _linker(length: int, half: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = _Prefix(half)

        def solve(prefix: int, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
            found = finder.links(prefix, length, np.unique(fps))
            if found:
                a, b = _forest(*(np.concatenate(x) for x in zip(*found, strict=True)))
                yield pa.record_batch([a.view(np.int64), b.view(np.int64)], schema=schema)

        at, held = -1, []
        for batch in batches:
            prefix = batch.column(0).to_numpy()
            fps = batch.column(1).to_numpy().view(np.uint64)
            cuts = np.flatnonzero(np.diff(prefix)) + 1
            for start, end in zip([0, *cuts], [*cuts, len(prefix)], strict=True):
                if start == end:
                    continue
                if held and prefix[start] != at:
                    yield from solve(at, np.concatenate(held))
                    held = []
                at = int(prefix[start])
                held.append(fps[start:end])
        if held:
            yield from solve(at, np.concatenate(held))

    return apply


def hamming_links(prints: DataFrame, radius: int = 4) -> DataFrame:
    """Links (a, b) between fingerprints (``fp``: long) at *radius* or fewer differing bits.

    The links span every group exactly: two fingerprints are joined by links if and only
    if a chain of pairs within the radius joins them. *radius* is even, up to 6.
    """
    if radius % 2 or not 0 <= radius <= 6:
        raise ValueError("the radius is an even number up to 6")
    distinct = stored(prints.select("fp").distinct())
    number = distinct.count()
    if number == 0 or radius == 0:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).filter("false")
    length = min(32, max(8, math.ceil(math.log2(number)) - 8))
    half = radius // 2
    heads = F.array(*[F.lit(m) for m in _masks(length, half)])
    small_batches(prints.sparkSession)
    reached = distinct.select(
        F.explode(heads).alias("_mask"), "fp"
    ).select(F.shiftrightunsigned("fp", 64 - length).bitwiseXOR(F.col("_mask")).alias("prefix"), "fp")
    return (
        reached.repartition("prefix")
        .sortWithinPartitions("prefix")
        .mapInArrow(_linker(length, half), "a long, b long")
        .distinct()
    )


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 4,
    radius: int = 4,
    prints: int = 1,
    bands: int = 0,
    band_rows: int = 6,
) -> DataFrame:
    """(key, fp, root, component) per row: groups of fingerprints that links join.

    With *prints* over 1, texts are linked if any of that many independent fingerprints is
    within the radius, which meets more of the less similar copies; *fp* is the first of
    them. With *bands*, texts are also linked if one of that many bands of *band_rows*
    MinHash values is equal. Null and empty texts have fingerprint 0 and are linked like any other. Rows with a
    null key take part; *root* is the group's least fingerprint, *component* its least key
    that is not null (null if there is none). Repeated rows stay and fall in one component.
    Other columns are not read.
    """
    small_batches(docs.sparkSession)
    made = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), fingerprints(width, prints)(F.col(text)).alias("_fps"))
    if bands:
        made = made.withColumn("_bands", banded(width, bands, band_rows)(F.col("_text")))
    found = stored(made.select("_key", *[F.get("_fps", i).alias(f"fp{i}") for i in range(prints)], *["_bands"][: min(bands, 1)]))
    links = hamming_links(found.select(F.col("fp0").alias("fp")), radius)
    for i in range(1, prints):
        # A class of another fingerprint stands for its least first fingerprint.
        own = found.select("fp0", f"fp{i}").distinct()
        stands = stored(own.groupBy(f"fp{i}").agg(F.min("fp0").alias("to")))
        same = own.join(stands, f"fp{i}").filter(F.col("fp0") != F.col("to")).select(F.col("fp0").alias("a"), F.col("to").alias("b"))
        near = hamming_links(stands.select(F.col(f"fp{i}").alias("fp")), radius)
        left = stands.select(F.col(f"fp{i}").alias("a"), F.col("to").alias("x"))
        right = stands.select(F.col(f"fp{i}").alias("b"), F.col("to").alias("y"))
        near = near.join(left, "a").join(right, "b").select(F.col("x").alias("a"), F.col("y").alias("b"))
        links = links.unionByName(same).unionByName(near)
    if bands:
        own = stored(found.select("fp0", F.explode("_bands").alias("_band")).distinct())
        stands = own.groupBy("_band").agg(F.min("fp0").alias("to"), F.max("fp0").alias("_top")).filter("to <> _top")
        links = links.unionByName(own.join(stands, "_band").filter("fp0 <> to").select(F.col("fp0").alias("a"), F.col("to").alias("b")))
    roots = stored(components(links)).withColumnRenamed("node", "fp")
    first = found.groupBy(F.col("fp0").alias("fp")).agg(F.min("_key").alias("_least"))
    joined = first.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = joined.groupBy("root").agg(F.min("_least").alias("component"))
    classes = joined.join(least, "root").select(F.col("fp").alias("fp0"), "root", "component")
    return found.join(classes, "fp0").select(F.col("_key").alias(key), F.col("fp0").alias("fp"), "root", "component")


def _shingle_set(width: int):
    """Column function: the distinct shingle hashes of a text, sorted, as bytes."""

    @F.pandas_udf("binary")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([np.unique(shingle_hashes(words_of(t), width)).tobytes() for t in texts])

    return apply


class Pivots:
    """Sets of hashes that others are compared with all at once."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(s) for s in sets], np.int64)
        values = np.concatenate([np.empty(0, np.uint64), *sets])
        owners = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(values, kind="stable")
        self.values, self.owners = values[order], owners[order]

    def alike(self, one: np.ndarray, least: float) -> np.ndarray:
        """Pivots whose Jaccard similarity to a set is *least* or more; two empty sets are alike."""
        low, high = np.searchsorted(self.values, one, "left"), np.searchsorted(self.values, one, "right")
        n = high - low
        at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        both = np.bincount(self.owners[at], minlength=len(self.sizes))
        union = self.sizes + len(one) - both
        return np.flatnonzero(both >= least * np.maximum(union, 1) if len(one) else union == 0)


def _settled(least: float, schema: pa.Schema):
    """Rows of (root, part), pivots first, by order -> (root, order, size, set, state) of a round.

    The pivots of a group are settled one after the other: one that is like a pivot that
    stays goes. All other rows are compared with the pivots that stay. Every part of a
    group settles its pivots in the same way; the first part reports them. state: 0 goes,
    1 stays, 2 is open (only those keep their set).
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        held: list[np.ndarray] = []
        staying: Pivots | None = None

        def settled() -> tuple[Pivots, list[int]]:
            every, stay = Pivots(held), []
            kept = np.zeros(len(held), bool)
            for i, own in enumerate(held):
                near = every.alike(own, least)
                kept[i] = not kept[near[near < i]].any()
                if kept[i]:
                    stay.append(i)
            return Pivots([held[i] for i in stay]), kept.astype(int).tolist()

        reported: list[pa.RecordBatch] = []

        def report() -> Iterator[pa.RecordBatch]:
            nonlocal staying
            staying, states = settled()
            at = 0
            for rows in reported:
                part = states[at : at + rows.num_rows]
                at += rows.num_rows
                yield _told(rows, part, schema)

        for batch in batches:
            keys = list(zip(batch.column("root").to_pylist(), batch.column("part").to_pylist(), strict=True))
            pivot = batch.column("pivot").to_pylist()
            start = 0
            for i in range(1, len(keys) + 1):
                if i < len(keys) and keys[i] == keys[start] and pivot[i] == pivot[start]:
                    continue
                rows = batch.slice(start, i - start)
                if keys[start] != now:
                    if reported and staying is None:
                        yield from report()
                    now, held, reported, staying = keys[start], [], [], None
                sets = [np.frombuffer(x, np.uint64) for x in rows.column("set").to_pylist()]
                if pivot[start]:
                    held += sets
                    if now[1] == 0:
                        reported.append(rows)
                else:
                    if staying is None:
                        yield from report()
                    yield _told(rows, [0 if len(staying.alike(x, least)) else 2 for x in sets], schema)
                start = i
        if reported and staying is None:
            yield from report()

    return apply


def _told(rows: pa.RecordBatch, states: list[int], schema: pa.Schema) -> pa.RecordBatch:
    kept = [x if s == 2 else None for x, s in zip(rows.column("set").to_pylist(), states, strict=True)]
    columns = [rows.column("root"), rows.column("order"), rows.column("size"), pa.array(kept, pa.binary()), pa.array(states, pa.int32())]
    return pa.record_batch(columns, schema=schema)


def _first(rows: DataFrame, number: int, size: int, salts: int = 64) -> DataFrame:
    """(root, order) of the first rows of each group: *number* at most, of *size* bytes together, one at least.

    Rows are first cut within salted parts, so no task orders a whole group.
    """
    salted = rows.select("root", "order", "size", F.pmod(F.xxhash64("order"), F.lit(salts)).alias("salt"))
    for by in (["root", "salt"], ["root"]):
        window = Window.partitionBy(*by).orderBy("order")
        salted = (
            salted.withColumn("at", F.row_number().over(window))
            .withColumn("upto", F.sum("size").over(window.rowsBetween(Window.unboundedPreceding, 0)))
            .filter((F.col("at") <= number) & ((F.col("upto") <= size) | (F.col("at") == 1)))
        )
    return salted.select("root", "order")


def without_near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 5,
    radius: int = 4,
    prints: int = 1,
    least: float = 0.8,
    bands: int = 36,
    band_rows: int = 6,
    pivots: int = 64,
    pivot_bytes: int = 16 << 20,
    part_rows: int = 2_000,
) -> DataFrame:
    """*docs* without the near copies of rows that stay.

    Groups come from :func:`near_duplicates`; at similarity 0.8 it is the MinHash bands that
    join most pairs, since their fingerprints are further apart than the radius. Within a
    group rows are settled in the order of their keys (null keys last, then by place): a row
    that shares *least* of its distinct shingles with a row that stays goes, others stay.
    So each row that goes has a close copy before it that stays, and no two rows of a group
    that stay are copies of each other. Equal texts, also null and empty ones, are copies;
    repeated rows leave one. A pair at similarity s is in one group by the fingerprint or by
    a band: the bands miss (1 - s ** band_rows) ** bands of such pairs, by default 2 in
    100,000 at 0.8. Other columns are passed on; the name ``__id`` is reserved.

    A round settles the first *pivots* rows of every group (of *pivot_bytes* together) and
    compares all others with those that stay, in parts of about *part_rows* rows; each round
    takes eight times as many pivots. So a group of close copies takes one round, a loose
    group of n rows about log n, until its pivots reach the bound in bytes.
    """
    spark = docs.sparkSession
    base = stored(docs.withColumn("__id", F.monotonically_increasing_id()))
    groups = near_duplicates(base.select("__id", F.col(text).alias("__text")), "__id", "__text", width, radius, prints, bands, band_rows)
    groups = stored(groups.select("__id", F.col("root").alias("__root")))
    several = groups.groupBy("__root").agg(F.count("*").alias("__n")).filter("__n > 1").select("__root")
    members = groups.join(several, "__root", "left_semi")
    order = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("__id").alias("id")).alias("order")
    small_batches(spark)
    sets = base.join(members, "__id").select(F.col("__root").alias("root"), order, _shingle_set(width)(F.col(text)).alias("set"))
    sets = stored(sets.withColumn("digest", F.sha2("set", 256)))
    first = sets.groupBy("root", "digest").agg(F.min("order").alias("lead"))
    copies = sets.join(first, ["root", "digest"]).select(
        "root", "order", F.octet_length("set").cast("long").alias("size"), "set", (F.col("order") != F.col("lead")).alias("copy")
    )
    copies = stored(copies)
    gone = copies.filter("copy").select(F.col("order.id").alias("__id"))
    left = copies.filter("not copy").drop("copy")
    kinds = left.select("root", "order", "size", "set", F.lit(0).alias("state")).schema
    while left.limit(1).count():
        parts = left.groupBy("root").agg(F.ceil(F.count("*") / part_rows).cast("int").alias("parts"))
        chosen = _first(left, pivots, pivot_bytes).withColumn("pivot", F.lit(True))
        marked = left.join(chosen, ["root", "order"], "left").join(parts, "root")
        leading = marked.filter("pivot").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        others = marked.filter("pivot is null").withColumn("pivot", F.lit(False)).withColumn(
            "part", F.pmod(F.xxhash64("order"), F.col("parts")).cast("int")
        )
        small_batches(spark)
        rows = leading.select("root", "part", "pivot", "order", "size", "set").unionByName(
            others.select("root", "part", "pivot", "order", "size", "set")
        )
        told = stored(
            rows.repartition("root", "part")
            .sortWithinPartitions("root", "part", F.desc("pivot"), "order")
            .mapInArrow(_settled(least, to_arrow_schema(kinds)), kinds)
        )
        gone = gone.unionByName(told.filter("state = 0").select(F.col("order.id").alias("__id")))
        left = told.filter("state = 2").drop("state")
        pivots = min(8 * pivots, 1 << 30)
    return base.join(gone, "__id", "left_anti").select(*docs.columns)
