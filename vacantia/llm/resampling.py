"""Importance resampling towards a target text collection over hashed word runs.

Features are runs of words, hashed to buckets by CRC-32. The CRC is linear over bits: a
message's value is the XOR of one contribution per byte, which depends on the byte and its
distance from the end only, and of a constant per length. So a table by distance and byte
gives the values of all features of a batch in one gather and one ``bitwise_xor.reduceat``
over their spans. Spans longer than the table are cut into blocks aligned to their ends and
folded two by two, each left half moved over its right half by the table itself.

Bucket counts are taken over all documents, summed in each task before they are shuffled;
what reaches the driver is one row per bucket. Documents are scored one by one and numbered
by a range partitioning of (score, key) rows, so no step gathers documents in one task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions.numbering import numbered
from vacantia.llm.common import small_batches, stored

#: Distances from the end that the position table covers, a power of two of 4 or more.
DEPTH = 64
#: Bytes of features hashed at once: the working arrays stay within a core's cache and a few MB.
CHUNK = 1 << 17
#: The reflected polynomial of CRC-32 (fixed value).
POLYNOMIAL = 0xEDB88320

#: Bytes of words: digits, lower-case letters and everything beyond ASCII.
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


@cache
def positions() -> np.ndarray:
    """Contribution of byte b with d bytes after it at [d * 256 + b], from a register of zero."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(POLYNOMIAL), step >> 1)
    rows = [step]
    for _ in range(DEPTH - 1):
        rows.append((rows[-1] >> np.uint32(8)) ^ step[rows[-1] & np.uint32(255)])
    return np.concatenate(rows)


def _moved(registers: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Registers after the run of zero bytes that *tables* stand for."""
    out = tables[0][registers & np.uint32(255)]
    for j in (1, 2, 3):
        out = out ^ tables[j][(registers >> np.uint32(8 * j)) & np.uint32(255)]
    return out


@cache
def _shift(power: int) -> np.ndarray:
    """Four tables, one per byte of a register, that move it over 2**power zero bytes."""
    if power == 0:
        step = positions()[:256]
        values = np.arange(256, dtype=np.uint32)
        # One zero byte: the low byte goes through the step table, the others move down.
        return np.stack([step, values, values << np.uint32(8), values << np.uint32(16)])
    before = _shift(power - 1)
    return np.stack([_moved(before[j], before) for j in range(4)])


@cache
def _constant(length: int) -> int:
    """CRC-32 of *length* zero bytes: what the initial and final inversion add."""
    register = np.array([0xFFFFFFFF], np.uint32)
    for power in range(length.bit_length()):
        if length >> power & 1:
            register = _moved(register, _shift(power))
    return int(register[0]) ^ 0xFFFFFFFF


@cache
def _constants() -> np.ndarray:
    return np.array([_constant(n) for n in range(DEPTH + 1)], np.uint32)


def _raw(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Registers of spans of 1 to DEPTH bytes, without the constants."""
    ends = np.cumsum(lengths)
    first = ends - lengths
    total = int(ends[-1])
    left = np.repeat(ends, lengths) - np.arange(1, total + 1)  # bytes after this one
    at = np.repeat(starts - first, lengths) + np.arange(total)
    return np.bitwise_xor.reduceat(positions()[(left << 8) + data[at]], first)


def _folded(data: np.ndarray, start: int, length: int) -> int:
    """Register of one long span: blocks aligned to its end, folded two by two."""
    blocks = -(-length // DEPTH)
    first = length - (blocks - 1) * DEPTH
    starts = start + np.concatenate([[0], first + DEPTH * np.arange(blocks - 1)])
    lengths = np.full(blocks, DEPTH)
    lengths[0] = first
    step = CHUNK // DEPTH
    registers = np.concatenate([_raw(data, starts[i : i + step], lengths[i : i + step]) for i in range(0, blocks, step)])
    power = DEPTH.bit_length() - 1
    while len(registers) > 1:
        if len(registers) % 2:
            registers = np.concatenate([np.zeros(1, np.uint32), registers])
        registers = _moved(registers[::2], _shift(power)) ^ registers[1::2]
        power += 1
    return int(registers[0])


def crc32_of_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of the bytes *data*; spans may overlap and have any length (empty: 0)."""
    out = np.zeros(len(starts), np.uint32)
    short = np.flatnonzero((lengths > 0) & (lengths <= DEPTH))
    if len(short):
        # Chunks of spans by bytes.
        until = np.cumsum(lengths[short])
        cuts = np.searchsorted(until, np.arange(CHUNK, int(until[-1]) + CHUNK, CHUNK), "left") + 1
        begin = 0
        for cut in np.unique(np.minimum(cuts, len(short))).tolist():
            own = short[begin:cut]
            if len(own):
                out[own] = _raw(data, starts[own], lengths[own]) ^ _constants()[lengths[own]]
            begin = cut
    for i in np.flatnonzero(lengths > DEPTH).tolist():
        out[i] = _folded(data, int(starts[i]), int(lengths[i])) ^ _constant(int(lengths[i]))
    return out


class Features:
    """The features of a batch of texts: their buckets, and how many each text has."""

    def __init__(self, texts: pa.Array, longest: int, buckets: int) -> None:
        flat = pc.fill_null(pc.cast(texts, pa.large_binary()), b"")
        bounds = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
        body = flat.buffers()[2]
        data = np.frombuffer(body, np.uint8)[bounds[0] : bounds[-1]] if body is not None else np.empty(0, np.uint8)
        bounds = bounds - bounds[0]
        data = _LOWER[data]
        inside = np.zeros(len(data) + 1, bool)
        inside[:-1] = _WORD[data]
        before = np.zeros(len(data) + 1, bool)
        before[1:] = inside[:-1]
        before[bounds] = False  # a word ends with its text
        starts = np.flatnonzero(inside & ~before)
        after = inside.copy()
        after[bounds] = False
        ends = np.flatnonzero(np.concatenate([[False], inside[:-1] & ~after[1:]]))
        lengths = ends - starts
        #: Words before each text and after the last one.
        self.first = np.searchsorted(starts, bounds)
        found, owners = [crc32_of_spans(data, starts, lengths) % np.uint32(buckets)], []
        if longest > 1:
            # Words joined by one space: a run of words is one span of these bytes.
            to = np.cumsum(lengths + 1) - lengths - 1
            joined = np.full(int((lengths + 1).sum()), 0x20, np.uint8)
            joined[np.repeat(to - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))] = data[inside[:-1]]
            last = np.repeat(self.first[1:], np.diff(self.first))
            owner = np.repeat(np.arange(len(flat)), np.diff(self.first))
            owners.append(owner)
            for n in range(2, longest + 1):
                i = np.flatnonzero(np.arange(len(starts)) + n <= last)
                found.append(crc32_of_spans(joined, to[i], to[i + n - 1] + lengths[i + n - 1] - to[i]) % np.uint32(buckets))
                owners.append(owner[i])
        self.n_words = np.diff(self.first)
        self.buckets = np.concatenate(found).astype(np.int64)
        self._owners = np.concatenate(owners) if owners else None

    def sums(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(features, sum of *values* over their buckets) of each text."""
        gained = values[self.buckets]
        if self._owners is None:
            upto = np.concatenate([[0], np.cumsum(gained)])
            return self.n_words, upto[self.first[1:]] - upto[self.first[:-1]]
        number = len(self.n_words)
        total = np.zeros(number, np.int64)
        np.add.at(total, self._owners, gained)
        return np.bincount(self._owners, minlength=number), total


def bucket_counts(texts: DataFrame, text: str = "text", longest: int = 1, buckets: int = 10_000) -> DataFrame:
    """(bucket, n) over all rows of *texts*: a task sends one row per bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(Features(batch.column(0), longest, buckets).buckets, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    small_batches(texts.sparkSession)
    counted = texts.select(F.col(text).cast("string")).mapInArrow(count, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int) -> np.ndarray:
    """floor(1000 * log ratio) of each bucket, from two tables of :func:`bucket_counts`.

    Both shares are smoothed by one per bucket. The driver gets one row per bucket.
    """
    s, t = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for into, table in ((s, corpus), (t, target)):
        for row in table.collect():
            into[row.bucket] = row.n
    all_s, all_t = int(s.sum()) + buckets, int(t.sum()) + buckets
    ratio = lambda a, b: float((b + 1) * all_s) / float((a + 1) * all_t)
    return np.array([math.floor(1000 * math.log(ratio(a, b))) for a, b in zip(s.tolist(), t.tolist(), strict=True)], np.int64)


def weights(
    docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text", longest: int = 1
) -> DataFrame:
    """(key, n_words, n_features, weight) per row of *docs*: the sum of the gains of its features."""
    buckets = len(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = Features(batch.column(1), longest, buckets)
            number, total = found.sums(gain)
            yield pa.record_batch(
                [batch.column(0), pa.array(found.n_words.astype(np.int64)), pa.array(number.astype(np.int64)), pa.array(total)],
                names=[key, "n_words", "n_features", "weight"],
            )

    small_batches(docs.sparkSession)
    kind = docs.select(key).schema[0].dataType.simpleString()
    return docs.select(F.col(key), F.col(text).cast("string")).mapInArrow(
        score, f"`{key}` {kind}, n_words long, n_features long, weight long"
    )


def gumbel(key: str, seed: int) -> Column:
    """floor(1000 * Gumbel noise) of a key, from 32 bits of a hash: the same at each run (null key: as an empty one)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    uniform = (h.cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(uniform))).cast("long")


def resampled(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", longest: int = 1,
    buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: int = 2024,
) -> DataFrame:
    """(key, n_features, weight, score, rank) per row of *docs*, drawn without replacement towards *target*.

    A document's weight is the sum of its features' gains, its score the weight plus hashed
    Gumbel noise: taking the highest scores draws in proportion to the exponentials of the
    weights. Of the N rows with *least_words* words or more, floor(percent * N / 100) get the
    ranks 1, 2, ...; other rows have a null rank. Ties go to the smaller key, null keys first;
    rows equal in score and key are ranked in any order. Null and empty texts have no
    features and weight 0. Repeated rows count as often as they stand there. Only *key* and
    *text* are read (of *target*: *text*); an empty table on either side is no error.
    """
    corpus = bucket_counts(docs, text, longest, buckets)
    gain = gains(corpus, bucket_counts(target, text, longest, buckets), buckets)
    own = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    scored = weights(own, gain, "_key", "_text", longest).withColumn("score", F.col("weight") + gumbel("_key", seed))
    scored = stored(scored)
    eligible = F.col("n_words") >= least_words
    drawn = percent * scored.filter(eligible).count() // 100
    # Rows that may be drawn come first, the highest score first among them.
    ordered = scored.withColumn("_late", (~eligible).cast("int")).withColumn("_low", -F.col("score"))
    ranked = numbered(ordered, ["_late", "_low", "_key"], out="rank")
    rank = F.when(eligible & (F.col("rank") <= drawn), F.col("rank"))
    return ranked.select(F.col("_key").alias(key), "n_features", "weight", "score", rank.alias("rank"))
