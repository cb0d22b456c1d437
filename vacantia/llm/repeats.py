"""Removal of repeated byte strings by longest-previous-factor arrays, partitioned by content.

Every string of ``length`` bytes holds an anchor: the least of its 32-byte hashes. Equal
strings have their anchor at the same place, so only suffixes around equal anchors can match
and a partition by anchor keeps all of them together.

1. Each text gives its anchors, with a hash of the bytes that any string over the anchor can
   reach. Repeats within a task are combined there.
2. By anchor: an occurrence whose whole surroundings stand earlier is repeated whole. Anchors
   with one kind of surroundings need no more work; of the others the first occurrence of
   each kind goes on.
3. Their surroundings are put into suffix order (to the depth of ``length`` bytes). Previous
   and next smaller positions in this order give each suffix its longest previous factor;
   where it is at least ``length``, the string also starts earlier.
4. Anchors with more than ``HOT`` kinds are split by the strings themselves: the first
   position of each string is a minimum with a map-side half, at any size of the group.

Nothing is cut off: strings are judged on the input, and matches never cross texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacantia.functions.numbering import numbered
from vacantia.llm.common import small_batches, stored

K = 32
#: Kinds of surroundings of one anchor beyond which its strings are compared as table rows:
#: as many take a task about 300 MB.
HOT = 40_000
#: Bytes hashed at once; longer texts go piece by piece.
PIECE = 1 << 20
#: Rows that a task combines at once.
COMBINE = 400_000
_NO_KEY = -(2**63)
_ODD = 0x9E3779B97F4A7C15
_BYTES, _OTHER_BYTES = np.random.default_rng(7).integers(0, 2**63, (2, 256), dtype=np.int64).astype(np.uint64)


def _powers(base: int, number: int) -> np.ndarray:
    out = np.full(number, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _slide(values: np.ndarray, width: int, op, fill: int) -> np.ndarray:
    """Least or greatest of every *width* neighbours: whole blocks from both of their ends."""
    number = len(values)
    padded = np.concatenate([values, np.full(-number % width, fill, values.dtype)]).reshape(-1, width)
    ahead = op.accumulate(padded, axis=1).ravel()
    behind = op.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(behind[: number - width + 1], ahead[width - 1 : number])


class Hasher:
    """Hashes of any stretch of a byte array, from running sums."""

    def __init__(self, length: int) -> None:
        self.length, self.reach = length, length - K
        self._reserve(PIECE)

    def _reserve(self, number: int) -> None:
        self.up = _powers(_ODD, 2 * number)
        self.down = _powers(pow(_ODD, -1, 1 << 64), 2 * number)

    def sums(self, data: np.ndarray, values: np.ndarray = _BYTES) -> np.ndarray:
        if len(data) >= len(self.up):
            self._reserve(len(data))
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * self.up[: len(data)], out=out[1:])
        return out

    def between(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        x = (sums[end] - sums[start]) * self.down[start]
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))

    def anchors(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, anchor, surroundings) of a text of at least ``length`` bytes."""
        found = []
        for a in range(0, len(data), PIECE):
            b = min(len(data), a + PIECE)
            low, high = max(0, a - self.reach), min(len(data), b + self.length)
            if high - low < self.length:
                low = max(0, high - self.length)
            sums = self.sums(data[low:high])
            first = np.arange(high - low - K + 1)
            hashes = self.between(sums, first, first + K)
            least = _slide(hashes, self.reach + 1, np.minimum, 2**64 - 1)
            edge = self.reach
            wide = np.concatenate([np.repeat(least[:1], edge), least, np.repeat(least[-1:], edge)])
            at = np.flatnonzero(hashes == _slide(wide, edge + 1, np.maximum, 0))
            at = at[(at + low >= a) & (at + low < b)]
            start, end = np.maximum(at - edge, 0), np.minimum(at + self.length, high - low)
            around = self.between(sums, start, end) + (at - start).astype(np.uint64) * np.uint64(0x94D049BB133111EB)
            found.append((at + low, hashes[at], around))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _utf8(value) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.uint8) if value.is_valid else np.empty(0, np.uint8)


def _find_anchors(length: int):
    """(anchor, around, num, pos); pos < 0: -1 - pos is repeated whole, found within the task."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(length)
        held: list[tuple] = []

        def combined() -> pa.RecordBatch:
            num, pos, anchor, around = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((pos, num, around, anchor))
            num, pos, anchor, around = num[order], pos[order], anchor[order], around[order]
            same = np.concatenate([[False], (anchor[1:] == anchor[:-1]) & (around[1:] == around[:-1])])
            again = np.concatenate([[False], (num[1:] == num[:-1]) & (pos[1:] == pos[:-1])]) & same
            pos = np.where(same, -1 - pos, pos)
            # Where a repeat goes next is of no matter: spread it.
            anchor = np.where(same, anchor + pos.astype(np.uint64) * np.uint64(_ODD) + num.astype(np.uint64), anchor)
            k = ~again
            return pa.record_batch(
                [anchor[k].view(np.int64), around[k].view(np.int64), num[k], pos[k].astype(np.int32)],
                names=["anchor", "around", "num", "pos"],
            )

        for batch in batches:
            for num, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = _utf8(text)
                if len(data) >= length:
                    at, anchor, around = hasher.anchors(data)
                    held.append((np.full(len(at), num), at, anchor, around))
            if sum(len(x[0]) for x in held) >= COMBINE:
                yield combined()
                held.clear()
        if held:
            yield combined()

    return apply


def _sort_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by all columns: (num, pos, anchor, whole).

    Whole repeats, and the first occurrence of each kind where an anchor has several kinds.
    Only the last row is carried from batch to batch, whatever the size of an anchor's group.
    """
    last: tuple | None = None  # the first row of the last kind, and whether it has gone out
    for batch in batches:
        columns = [c.to_numpy() for c in batch.columns]
        if last is not None:
            columns = [np.concatenate([np.array([x], c.dtype), c]) for x, c in zip(last, columns, strict=False)]
        anchor, around, num, pos = columns
        if not len(anchor):
            continue
        local = pos < 0
        kind = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (around[1:] != around[:-1])])
        first = np.flatnonzero(kind)[np.cumsum(kind) - 1]
        whole = local | (num != num[first]) | (pos != pos[first])
        # The first of a kind goes on if its anchor has another kind before or after it.
        starts = np.flatnonzero(kind & ~local)
        neighbours = anchor[starts[1:]] == anchor[starts[:-1]]
        onward = np.zeros(len(anchor), bool)
        onward[starts[1:]] |= neighbours
        onward[starts[:-1]] |= neighbours
        tail = int(first[-1])
        gone = bool(onward[tail])
        if last is not None:
            whole[0] = False
            if last[4]:
                onward[0] = False
                gone |= tail == 0
        out = whole | onward
        where = np.where(local, -1 - pos, pos).astype(np.int32)
        yield pa.record_batch(
            [num[out], where[out], anchor[out], whole[out]], names=["num", "pos", "anchor", "whole"]
        )
        last = (anchor[tail], around[tail], num[tail], pos[tail], gone)


def lpf(position: np.ndarray, lcp: np.ndarray, least: int) -> np.ndarray:
    """Longest previous factors of suffixes given in suffix order, where they reach *least*.

    *position* is where each suffix starts, *lcp* what it shares with the one before it in
    the order. The nearest suffix with a smaller position on either side shares the most of
    all earlier ones; a side is left once less than *least* is shared. Shorter ones give 0.
    """
    number = len(position)
    best = np.zeros(number, np.int64)
    if not number:
        return best
    # Within a stretch that shares *least* throughout, all but the smallest position have an earlier one.
    cut = lcp < least
    cut[0] = True
    smallest = np.minimum.reduceat(position, np.flatnonzero(cut))[np.cumsum(cut) - 1]
    most = lcp.max()
    for step in (-1, 1):
        shared = np.full(number, np.iinfo(np.int64).max)
        rows = np.flatnonzero((position > smallest) & (best < most))
        here = rows.copy()
        while len(rows):
            edge = here if step < 0 else here + 1
            inside = (edge > 0) if step < 0 else (edge < number)
            rows, here, edge = rows[inside], here[inside], edge[inside]
            shared[rows] = np.minimum(shared[rows], lcp[edge])
            on = shared[rows] >= least
            rows, here = rows[on], here[on] + step
            earlier = position[here] < position[rows]
            best[rows[earlier]] = np.maximum(best[rows[earlier]], shared[rows[earlier]])
            rows, here = rows[~earlier], here[~earlier]
    return best


def repeated_starts(
    hasher: Hasher, num: np.ndarray, first: np.ndarray, anchor: np.ndarray, pieces: list[bytes]
) -> tuple[np.ndarray, np.ndarray]:
    """(num, start) of the strings of ``length`` bytes over an anchor that also start earlier.

    *first* is where each piece starts in its text, *anchor* where its anchor is in the piece.
    """
    length = hasher.length
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    data = np.frombuffer(b"".join(pieces), np.uint8)
    begin = np.cumsum(sizes) - sizes
    many = np.maximum(0, np.minimum(anchor, sizes - length) + 1)
    owner = np.repeat(np.arange(len(pieces)), many)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
    at = begin[owner] + offset
    if not len(at):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    # A text's place in the order of keys, and the start in it, as one number.
    position = np.unique(num, return_inverse=True)[1][owner] << 32 | (first[owner] + offset)
    hashes = hasher.between(hasher.sums(data), at, at + length)
    # A string whose hash is met once has no longest previous factor of this length.
    order = np.argsort(hashes)
    near = hashes[order][1:] == hashes[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:]] |= near
    twice[order[:-1]] |= near
    owner, offset, at, position, hashes = owner[twice], offset[twice], at[twice], position[twice], hashes[twice]
    if not len(at):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    other = hasher.between(hasher.sums(data, _OTHER_BYTES), at, at + length)
    # Suffix order to the depth of *length* bytes: kinds of strings by their bytes, equal ones by position.
    sort = np.lexsort((position, other, hashes))
    new = np.concatenate([[True], (hashes[sort][1:] != hashes[sort][:-1]) | (other[sort][1:] != other[sort][:-1])])
    kind = np.cumsum(new) - 1
    heads = np.lib.stride_tricks.sliding_window_view(data, length)[at[sort[new]]]
    words = np.ascontiguousarray(np.pad(heads, ((0, 0), (0, -length % 8)))).view(">u8").astype(np.uint64)
    place = np.empty(len(words), np.int64)
    place[np.lexsort(words.T[::-1])] = np.arange(len(words))
    blocks = np.argsort(place[kind], kind="stable")
    suffix, same = sort[blocks], kind[blocks]
    # What neighbours share matters only where it is the whole depth.
    lcp = np.concatenate([[0], np.where(same[1:] == same[:-1], length, 0)])
    hit = suffix[lpf(position[suffix], lcp, length) >= length]
    return num[owner[hit]], first[owner[hit]] + offset[hit]


def _spans(num: np.ndarray, start: np.ndarray, length: int) -> pa.RecordBatch:
    order = np.lexsort((start, num))
    num, start = num[order], start[order]
    cut = np.concatenate([[True], (num[1:] != num[:-1]) | (start[1:] > start[:-1] + length)]) if len(num) else np.empty(0, bool)
    begin = np.flatnonzero(cut)
    end = np.concatenate([begin[1:], [len(num)]]) - 1 if len(begin) else begin
    return pa.record_batch(
        [num[begin].astype(np.int64), start[begin].astype(np.int32), (start[end] + length).astype(np.int32)],
        names=["num", "from", "to"],
    )


def _find_spans(length: int):
    """Rows (anchor, num, pos, left, piece) sorted by anchor -> (num, from, to)."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(length)
        held: list[pa.RecordBatch] = []

        def solved(rows: pa.Table) -> pa.RecordBatch:
            num, pos, left = (rows.column(c).to_numpy().astype(np.int64) for c in ("num", "pos", "left"))
            return _spans(*repeated_starts(hasher, num, pos - left, left, rows.column("piece").to_pylist()), length)

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < 4_000:
                continue
            rows = pa.Table.from_batches(held)
            anchor = rows.column("anchor").to_numpy()
            cut = len(anchor) - int(np.argmax(anchor[::-1] != anchor[-1])) if anchor[0] != anchor[-1] else 0
            if cut:
                yield solved(rows.slice(0, cut))
                held = rows.slice(cut).combine_chunks().to_batches()
        if held:
            yield solved(pa.Table.from_batches(held))

    return apply


def _extract(length: int):
    """Rows (num, text, wanted, ...) -> surroundings of each wanted anchor, or their strings one by one if hot."""
    reach = length - K

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(length)
        for batch in batches:
            rows = []
            for num, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                raw = _utf8(text)
                for w in wanted or ():
                    pos = w["pos"]
                    low, high = max(0, pos - reach), min(len(raw), pos + length)
                    if not w["hot"]:
                        rows.append((w["anchor"], 0, num, pos, pos - low, raw[low:high].tobytes()))
                        continue
                    begin = np.arange(low, min(pos, high - length) + 1)
                    if len(begin):
                        keys = hasher.between(hasher.sums(raw[low:high]), begin - low, begin - low + length)
                        rows += [(w["anchor"], k, num, b, None, None) for k, b in zip(keys.view(np.int64).tolist(), begin.tolist(), strict=True)]
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                for i in range(0, len(rows), 20_000):
                    part = zip(*rows[i : i + 20_000], strict=True)
                    yield pa.record_batch(
                        [pa.array(c, k) for c, k in zip(part, kinds, strict=True)],
                        names=["anchor", "string", "num", "pos", "left", "piece"],
                    )

    return apply


def _remove(length: int):
    """Rows (num, text, whole, spans, key) -> the text's bytes without them, and the removed runs."""
    reach = length - K

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed = [], []
            for text, whole, spans in zip(batch.column("text"), batch.column("whole"), batch.column("spans"), strict=True):
                data = _utf8(text)
                change = np.zeros(len(data) + 1, np.int64)
                if whole.is_valid and len(whole):
                    at = whole.values.to_numpy()
                    np.add.at(change, np.maximum(at - reach, 0), 1)
                    np.add.at(change, np.minimum(at + length, len(data)), -1)
                if spans.is_valid and len(spans):
                    np.add.at(change, spans.values.field("from").to_numpy(), 1)
                    np.add.at(change, spans.values.field("to").to_numpy(), -1)
                gone = np.cumsum(change[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                removed.append([{"from": a, "to": b} for a, b in edge.reshape(-1, 2).tolist()])
                kept.append(data[~gone].tobytes() if len(edge) else data.tobytes())
            spans_type = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
            yield pa.record_batch(
                [batch.column("key"), pa.array(kept, pa.binary()), pa.array(removed, spans_type)],
                names=["key", "kept", "removed"],
            )

    return apply


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 100) -> DataFrame:
    """(key, kept: binary, removed: array of byte ranges) per row.

    A byte goes if it lies in a string of *length* bytes that also starts earlier: in a text
    with a smaller key, or earlier in its own text. Null and empty texts, and texts shorter
    than *length*, stay as they are (null: empty). A null key is smaller than all others.
    Repeated rows are one text: each gets the same result. Rows with one key and different
    texts are different texts, in the order of their hashes. Only *key* and *text* are read.
    """
    if length < K + 4 or length > 1000:
        raise ValueError("the length is 36 to 1000 bytes")
    spark = docs.sparkSession
    source = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    body = F.xxhash64(F.coalesce("text", F.lit("")))
    clash = source.groupBy("key").agg(F.min(body).alias("a"), F.max(body).alias("b")).filter("a <> b")
    if clash.limit(1).count():
        marked = source.withColumn("_h", body)
        order = numbered(marked.select("key", "_h").distinct(), ["key", "_h"], out="num")
        order = order.select(F.col("key").alias("_k"), F.col("_h").alias("_t"), "num")
        rows = marked.join(order, F.col("key").eqNullSafe(F.col("_k")) & (F.col("_h") == F.col("_t")))
        rows = stored(rows.select(F.coalesce("num", F.lit(0)).alias("num"), "key", "text"))
    else:
        rows = source.select(F.coalesce("key", F.lit(_NO_KEY)).alias("num"), "key", "text")
    texts = rows.select("num", "text")

    small_batches(spark)
    found = texts.mapInArrow(_find_anchors(length), "anchor long, around long, num long, pos int")
    sorted_out = stored(
        found.repartition("anchor")
        .sortWithinPartitions("anchor", "around", "num", "pos")
        .mapInArrow(_sort_out, "num long, pos int, anchor long, whole boolean")
    )
    onward = sorted_out.filter("not whole")
    hot = onward.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > HOT).select("anchor", F.lit(True).alias("hot"))
    schema = "anchor long, string long, num long, pos int, left int, piece binary"

    def around(wanted: DataFrame) -> DataFrame:
        # This join and the last one read the same columns of the texts: one shuffle serves both.
        by = wanted.groupBy("num").agg(F.collect_list(F.struct("pos", "anchor", "hot")).alias("wanted"))
        joined = rows.join(by.withColumnRenamed("num", "_n"), F.col("num") == F.col("_n"), "left")
        return joined.select("num", "text", "wanted", "key").mapInArrow(_extract(length), schema)

    if hot.limit(1).count():
        split = onward.join(hot, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
        strings = stored(around(split.filter("hot"))).select("anchor", "string", F.struct("num", "pos").alias("at"))
        least = strings.groupBy("anchor", "string").agg(F.min("at").alias("least"))
        later = strings.join(least, ["anchor", "string"]).filter("at > least")
        hot_spans = later.select("at.num", F.col("at.pos").alias("from"), (F.col("at.pos") + length).alias("to"))
        others = split.filter("not hot")
    else:
        hot_spans, others = None, onward.withColumn("hot", F.lit(False))
    spans = (
        around(others)
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_find_spans(length), "num long, from int, to int")
    )
    if hot_spans is not None:
        spans = spans.unionByName(hot_spans)
    marks = (
        sorted_out.filter("whole")
        .select("num", F.col("pos").alias("whole"), F.lit(None).cast("struct<from:int,to:int>").alias("span"))
        .unionByName(
            spans.select("num", F.lit(None).cast("int").alias("whole"), F.struct("from", "to").alias("span"))
        )
        .groupBy("num")
        .agg(F.collect_list("whole").alias("whole"), F.collect_list("span").alias("spans"))
        .withColumnRenamed("num", "_n")
    )
    joined = rows.join(marks, F.col("num") == F.col("_n"), "left").select("num", "text", "whole", "spans", "key")
    out = joined.mapInArrow(_remove(length), "key long, kept binary, removed array<struct<from:int,to:int>>")
    return out.withColumnRenamed("key", key)
