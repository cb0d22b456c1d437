"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact similarity.

A window has as many words as a benchmark item. Its similarity to the item is the weighted
Jaccard of their word shingles, each shingle weighing as often as it occurs. A window that
reaches the threshold shares so many shingles with the benchmark that a running count of
known shingles finds all of them in one pass; only such windows get fingerprints. A text with
fewer words than an item is one window, if it is long enough to reach the threshold. Those are
looked up in blocks of their bits: with radius r and b blocks some block differs in at most
r // b bits, so every item fingerprint within the radius is met. What is met is compared
exactly.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from vacantia.llm.common import share, small_batches

WORD = re.compile(r"[^\W_]+")
#: UTF-8 bytes of benchmark texts in one broadcast index; a larger benchmark takes more passes.
INDEX_BYTES = 16 << 20
BLOCKS = 8


def words_of(text: str | None) -> list[str]:
    """Words of a text: runs of letters and digits, lower-cased."""
    return WORD.findall(text.lower()) if text else []


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of *width* word hashes."""
    number = len(words) - width + 1
    if number <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(number, np.uint64)
    for i in range(width):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += words[i : i + number]
    return _mixed(total)


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def _packed(set_bits: np.ndarray) -> np.ndarray:
    return np.packbits(set_bits, axis=1).view(">u8").ravel().astype(np.uint64)


@dataclass
class Size:
    """Items with one number of words: identities, shingle weights, fingerprints in blocks."""

    words: int
    width: int
    items: list[int] = field(default_factory=list)
    weights: list[dict[int, int]] = field(default_factory=list)
    prints: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))
    blocks: list[np.ndarray] = field(default_factory=list)


class Index:
    """All items of a part of a benchmark, by size in words."""

    def __init__(self, items: list[tuple], width: int, least: float, radius: int) -> None:
        self.least, self.radius = least, radius
        self.vocabulary: dict[str, int] = {}
        self.sizes: list[Size] = []
        by: dict[int, Size] = {}
        known: dict[int, list[np.ndarray]] = {}
        prints: dict[int, list[int]] = {}
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            size = by.setdefault(len(words), Size(len(words), min(width, len(words))))
            hashed = np.array([self.vocabulary.setdefault(w, xxh64_intdigest(w)) for w in words], np.uint64)
            runs = run_hashes(hashed, size.width)
            values, counts = np.unique(runs, return_counts=True)
            size.items.append(item)
            size.weights.append(dict(zip(values.tolist(), counts.tolist(), strict=True)))
            known.setdefault(size.width, []).append(values)
            bits = _bits(runs).sum(axis=0, dtype=np.int64)
            prints.setdefault(len(words), []).append(int(_packed((2 * bits > len(runs))[None, :])[0]))
        self.known = {w: np.unique(np.concatenate(v)) for w, v in known.items()}
        self.filters = {}
        for width_, values in self.known.items():
            slots = np.zeros(1 << 22, bool)
            slots[values >> np.uint64(42)] = True
            self.filters[width_] = slots
        for number, size in sorted(by.items()):
            size.prints = np.array(prints[number], np.uint64)
            # Of each block and value of its 8 bits: the items that differ in few enough of them, one bit each.
            values = np.arange(256, dtype=np.uint64)[:, None]
            for b in range(BLOCKS):
                own = (size.prints >> np.uint64(8 * b)) & np.uint64(255)
                size.blocks.append(np.packbits(np.bitwise_count(values ^ own) <= radius // BLOCKS, axis=1))
            self.sizes.append(size)

    def is_known(self, runs: np.ndarray, width: int) -> np.ndarray:
        found = self.filters[width][runs >> np.uint64(42)]
        if found.any():
            at = np.flatnonzero(found)
            values = self.known[width]
            place = np.searchsorted(values, runs[at])
            found[at] = values[np.minimum(place, len(values) - 1)] == runs[at]
        return found

    def within_radius(self, size: Size, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) for all items whose fingerprint is within the radius, by their blocks."""
        met = size.blocks[0][prints & np.uint64(255)]
        for b in range(1, BLOCKS):
            met |= size.blocks[b][(prints >> np.uint64(8 * b)) & np.uint64(255)]
        window, item = np.nonzero(np.unpackbits(met, axis=1, count=len(size.items)))
        near = np.bitwise_count(prints[window] ^ size.prints[item]) <= self.radius
        return window[near], item[near]

    def similarity(self, weights: dict[int, int], runs: np.ndarray) -> float:
        values, counts = np.unique(runs, return_counts=True)
        both = sum(min(n, weights.get(v, 0)) for v, n in zip(values.tolist(), counts.tolist(), strict=True))
        return both / (sum(weights.values()) + len(runs) - both)

    def search(self, text: str | None) -> list[tuple[int, int, int, float]]:
        """(item, first word, words, similarity): the best window of every item that is met."""
        words = words_of(text)
        if not words or not self.sizes:
            return []
        get = self.vocabulary.get
        hashed = np.fromiter(map(get, words, repeat(0)), np.uint64, len(words))
        marks: dict[int, np.ndarray] = {}
        for width in self.known:
            if len(words) >= width:
                known = self.is_known(run_hashes(hashed, width), width)
                if known.any():
                    marks[width] = np.concatenate([[0], np.cumsum(known)])
        if not marks:
            return []
        exact: np.ndarray | None = None
        hashes: dict[int, np.ndarray] = {}
        best: dict[int, tuple[float, int, int]] = {}
        for size in self.sizes:
            whole = size.words - size.width + 1
            # A text that is shorter than the item is one window.
            taken = min(size.words, len(words))
            number = taken - size.width + 1
            if size.width not in marks or number < max(1, self.least * whole - 1e-9):
                continue
            mark = marks[size.width]
            # similarity x / (whole + number - x) reaches the threshold from this x on
            enough = (whole + number) * self.least / (1 + self.least) - 1e-9
            starts = np.flatnonzero(mark[number:] - mark[:-number] >= enough)
            if not len(starts):
                continue
            if exact is None:
                exact = np.fromiter((get(w) or xxh64_intdigest(w) for w in words), np.uint64, len(words))
            if size.width not in hashes:
                hashes[size.width] = run_hashes(exact, size.width)
            runs = hashes[size.width]
            for part in np.split(starts, np.flatnonzero(np.diff(starts) > 4 * number) + 1):
                for piece in np.array_split(part, 1 + len(part) // max(16, (1 << 20) // len(size.items) // 64)):
                    low = int(piece[0])
                    sums = np.cumsum(_bits(runs[low : int(piece[-1]) + number]), axis=0, dtype=np.int32)
                    sums = np.vstack([np.zeros((1, 64), np.int32), sums])
                    ones = sums[piece - low + number] - sums[piece - low]
                    for w, i in zip(*self.within_radius(size, _packed(2 * ones > number)), strict=True):
                        start, item = int(piece[w]), size.items[i]
                        s = self.similarity(size.weights[i], runs[start : start + number])
                        if s >= self.least:
                            old = best.get(item)
                            if old is None or (-s, start, taken) < (-old[0], old[1], old[2]):
                                best[item] = s, start, taken
        return [(item, start, number, s) for item, (s, start, number) in best.items()]


def indexes(
    benchmark: DataFrame, item: str, item_text: str, width: int, least: float, radius: int, part_bytes: int
) -> Iterator[Index]:
    """Indexes of parts of the benchmark of about *part_bytes* each (one of nothing if it is empty)."""
    items = (
        benchmark.select(F.col(item).cast("long").alias("i"), F.col(item_text).alias("t"))
        .filter("i is not null and t is not null")
        .distinct()
    )
    volume = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    parts = max(1, -(-volume // part_bytes))
    for part in range(parts):
        own = items.filter(F.pmod(F.xxhash64("i"), F.lit(parts)) == part).orderBy("i", "t").collect()
        yield Index([tuple(r) for r in own], width, least, radius)


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    width: int = 5,
    least: float = 0.8,
    radius: int = 24,
    part_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """(key, item, first_word, n_words, similarity): the best window per row and item.

    Null and empty texts match nothing, nor do null, empty or wordless items. An item of
    fewer than *width* words is one shingle. Against an item with more words than the text,
    the whole text is the window. Ties: the earliest window. Repeated rows of
    *docs* each give their rows; repeated items count once. Windows more than *radius* bits
    from an item are not compared; at similarity 0.8 a window is about 10 bits away. The
    benchmark goes to the driver and the tasks in parts of about *part_bytes*; each part is
    one pass over the documents.
    """
    spark = docs.sparkSession
    schema = pa.schema([(key, pa.int64()), (item, pa.int64()), ("first_word", pa.int32()), ("n_words", pa.int32()), ("similarity", pa.float64())])
    ddl = f"`{key}` long, `{item}` long, first_word int, n_words int, similarity double"

    def searcher(shared):
        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys, texts = (c.to_pylist() for c in batch.columns)
                rows = [(k, *hit) for k, t in zip(keys, texts, strict=True) for hit in shared.value.search(t)]
                if rows:
                    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
                    yield pa.record_batch(columns, schema=schema)

        return apply

    small_batches(spark)
    narrow = docs.select(F.col(key).cast("long").alias("k"), F.col(text).alias("t"))
    found = None
    for index in indexes(benchmark, item, item_text, width, least, radius, part_bytes):
        hits = narrow.mapInArrow(searcher(share(spark, index)), ddl)
        found = hits if found is None else found.unionByName(hits)
    return found


def without_benchmark(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    width: int = 5, least: float = 0.8, radius: int = 24, part_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """The rows of *docs* whose text has no window that matches an item, as :func:`matches` finds them."""
    def free_of(shared):
        @F.pandas_udf("boolean")
        def free(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series([not shared.value.search(t) for t in texts], dtype=bool)

        return free(F.col(text))

    clean = docs
    for index in indexes(benchmark, item, item_text, width, least, radius, part_bytes):
        clean = clean.filter(free_of(share(docs.sparkSession, index)))
    small_batches(docs.sparkSession)
    return clean
