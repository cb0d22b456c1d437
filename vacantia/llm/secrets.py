"""Secret scans: fixed patterns, and strings that a battery of tests cannot tell from random.

Three patterns give base spans. The method adds runs of 20 or more characters of an encoding
alphabet. For each run the smallest alphabet that holds it is inferred, and three tests ask
whether it may be uniform over that alphabet: chi-squared of its symbol counts, the number of
runs of low and high symbols, and the serial correlation of neighbours. A run that any test
rejects is not random. What is left must also be unlike the corpus: the likelihood ratio of
uniform symbols against the corpus's own character frequencies is an e-value, which grows
with length. Within each class of length the discoveries are bounded by the e-value form of
the Benjamini-Hochberg procedure, which holds for runs that depend on each other, as copies
do: of m runs the i greatest are taken where the i-th is m / (rate * i) or more.

Frequencies and e-values are counted over all documents, summed in each task before they are
shuffled; what reaches the driver is one row per byte value and one row per length class.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacantia.llm.common import small_batches, stored

#: Kinds in the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "random")
#: Base patterns (fixed values), over bytes whose A-Z are lower-cased for the first.
ASSIGN = re.compile(rb"""(?:password|passwd|secret|token|api_?key)["']? *[:=] *["']?([a-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
LEAST_VALUE, LEAST_HEX, LEAST_RUN = 6, 24, 20

_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Alphabets by size; a run belongs to the first that holds all of it. Numbers are no secrets.
ALPHABETS = (
    _DIGITS,
    _DIGITS + _LOWER[:6],
    _DIGITS + _UPPER[:6],
    _UPPER + _DIGITS[2:8],
    _DIGITS + _LOWER,
    _DIGITS + _UPPER,
    _UPPER + _LOWER + _DIGITS,
    _UPPER + _LOWER + _DIGITS + "+/",
    _UPPER + _LOWER + _DIGITS + "-_",
)
SIZES = np.array([len(a) for a in ALPHABETS])
_VALUES = np.zeros((len(ALPHABETS), 256), np.int64)
_MEMBER = np.zeros(256, np.int64)
for _i, _alphabet in enumerate(ALPHABETS):
    _at = np.frombuffer(_alphabet.encode(), np.uint8)
    _VALUES[_i, _at] = np.arange(len(_at))
    _MEMBER[_at] |= 1 << _i
_RUN = _MEMBER > 0
_HEX = (_MEMBER & 2) > 0
_SPECIAL = np.zeros(256, bool)
_SPECIAL[list(b"+/-_")] = True
#: Bytes of runs that are looked at together.
CHUNK = 1 << 17
#: e-values count by eighths of their logarithm, rounded down, up to this one.
STEPS, MOST = 8, 1_600


def frequencies(docs: DataFrame, text: str) -> np.ndarray:
    """How often each byte value stands in the texts, by value."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, np.int64)
        for batch in batches:
            total += np.bincount(_bytes(batch.column(0))[0], minlength=256)
        yield pa.record_batch([pa.array(np.arange(256)), pa.array(total)], names=["byte", "n"])

    small_batches(docs.sparkSession)
    table = docs.select(F.col(text).cast("string")).mapInArrow(count, "byte long, n long")
    out = np.zeros(256, np.int64)
    for row in table.groupBy("byte").agg(F.sum("n").alias("n")).collect():
        out[row.byte] = row.n
    return out


def evidence(counts: np.ndarray) -> np.ndarray:
    """Log of uniform over corpus probability by alphabet and byte.

    Letters count without regard to case, so that neither capitals nor mixed case are
    evidence. Every symbol is counted once more than it was seen.
    """
    fold = np.arange(256)
    fold[list(_UPPER.encode())] += 32
    seen = np.bincount(fold, counts, 256)
    out = np.zeros((len(ALPHABETS), 256))
    for i, alphabet in enumerate(ALPHABETS):
        own = np.frombuffer(alphabet.encode(), np.uint8)
        uniform = np.bincount(fold[own], minlength=256) / len(own)
        some = uniform > 0
        real = (seen[some] + 1) / (seen[some] + 1).sum()
        ratio = np.zeros(256)
        ratio[some] = np.log(uniform[some] / real)
        out[i, own] = ratio[fold[own]]
    return out


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """All bytes of a batch of texts, the bounds of each, and the texts as binary (null: empty)."""
    flat = pc.fill_null(pc.cast(texts, pa.large_binary()), b"")
    bounds = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    body = flat.buffers()[2]
    data = np.frombuffer(body, np.uint8)[bounds[0] : bounds[-1]] if body is not None else np.empty(0, np.uint8)
    return data, bounds - bounds[0], flat


def _runs(data: np.ndarray, bounds: np.ndarray, member: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of *member* bytes of *least* length or more, none across texts."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = member[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside[:-1]
    before[bounds] = False
    starts = np.flatnonzero(inside & ~before)
    after = inside.copy()
    after[bounds] = False
    ends = np.flatnonzero(np.concatenate([[False], inside[:-1] & ~after[1:]]))
    long = ends - starts >= least
    return starts[long], ends[long]


def candidates(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and alphabet numbers of runs to be tested.

    A run with signs of both base64 forms is no encoding: its letters and digits between them count.
    """
    starts, ends = _runs(data, bounds, _RUN, LEAST_RUN)
    if not len(starts):
        return starts, ends, starts
    inside = _MEMBER[data]
    cut = np.column_stack([starts, ends]).ravel()
    both = np.bitwise_and.reduceat(np.append(inside, 0), cut)[::2]
    whole = both > 0
    if not whole.all():
        marks = np.zeros(len(data) + 1, np.int64)
        np.add.at(marks, starts[~whole], 1)
        np.add.at(marks, ends[~whole], -1)
        mixed = np.flatnonzero(np.cumsum(marks)[:-1] > 0)
        plain = np.zeros(len(data), np.uint8)
        plain[mixed] = ~_SPECIAL[data[mixed]]
        more, until = _runs(plain, bounds, np.arange(256) == 1, LEAST_RUN)
        starts, ends = np.concatenate([starts[whole], more]), np.concatenate([ends[whole], until])
        order = np.argsort(starts)
        starts, ends = starts[order], ends[order]
        if not len(starts):
            return starts, ends, starts
        cut = np.column_stack([starts, ends]).ravel()
        both = np.bitwise_and.reduceat(np.append(inside, 0), cut)[::2]
    return starts, ends, np.log2(both & -both).astype(np.int64)


def tail(z: np.ndarray) -> np.ndarray:
    """Upper tail of the normal distribution."""
    return np.array([0.5 * math.erfc(x / math.sqrt(2)) for x in z.tolist()])


def battery(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kinds: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(p that the run is uniform over its alphabet, log of its e-value against the corpus) of each run.

    p is three times the least of: chi-squared (moments of uniform cells, by the cube root),
    runs of low and high symbols (two-sided), serial correlation of neighbours (two-sided).
    Long runs are summed in pieces, so memory does not grow with their length.
    """
    number = len(starts)
    squares, changes, ratio = np.zeros(number), np.zeros(number), np.zeros(number)
    sums = np.zeros((4, number))  # of x, x squared, x times the next, first and last x
    n = (ends - starts).astype(np.float64)
    for begin, end in _parts(n.astype(np.int64)):
        counts = np.zeros((end - begin, 64))
        for owner, at in _pieces(starts[begin:end], ends[begin:end]):
            kind = kinds[begin + owner]
            x = _VALUES[kind, data[at]]
            counts += np.bincount(owner * 64 + x, minlength=counts.size).reshape(counts.shape)
            paired = at + 1 < ends[begin + owner]
            y = np.where(paired, _VALUES[kind, data[np.minimum(at + 1, len(data) - 1)]], 0)
            half = SIZES[kind] // 2
            add = lambda v: np.bincount(owner, v, end - begin)  # noqa: B023, E731
            changes[begin:end] += add(paired & ((x >= half) != (y >= half)))
            ratio[begin:end] += add(logs[kind, data[at]])
            sums[0, begin:end] += add(x)
            sums[1, begin:end] += add(x * x)
            sums[2, begin:end] += add(x * y)
        squares[begin:end] = (counts**2).sum(axis=1)
    k = SIZES[kinds].astype(np.float64)
    chi = k / n * squares - n
    mean, var = k - 1, 2 * (k - 1) * (n - 1) / n
    shape = mean**2 / var
    z_chi = ((np.maximum(chi, 0) / mean) ** (1 / 3) - (1 - 1 / (9 * shape))) * 3 * np.sqrt(shape)
    z_runs = np.abs(changes - (n - 1) / 2) / (np.sqrt(n - 1) / 2)
    first, last = _VALUES[kinds, data[starts]], _VALUES[kinds, data[ends - 1]]
    mid = sums[0] / n
    spread = sums[1] - n * mid**2
    # Sum of (x - mid)(next - mid) over the n - 1 pairs.
    cross = sums[2] - mid * (2 * sums[0] - first - last) + (n - 1) * mid**2
    with np.errstate(divide="ignore", invalid="ignore"):
        z_serial = np.where(spread > 0, np.abs(cross / spread + 1 / n) * np.sqrt(n), np.inf)
    p = np.minimum(tail(z_chi), np.minimum(2 * tail(z_runs), 2 * tail(z_serial)))
    return np.minimum(1.0, 3 * p), ratio


def _parts(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Slices of runs of about CHUNK bytes, 2,000 runs at most."""
    begin, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        held += size
        if held >= CHUNK or i + 1 - begin >= 2_000:
            yield begin, i + 1
            begin, held = i + 1, 0
    if begin < len(sizes):
        yield begin, len(sizes)


def _pieces(starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(run, place) of every byte of the runs, at most CHUNK at a time."""
    sizes = ends - starts
    until = np.cumsum(sizes)
    for low in range(0, int(until[-1]), CHUNK):
        place = np.arange(low, min(low + CHUNK, int(until[-1])))
        owner = np.searchsorted(until, place, "right")
        yield owner, starts[owner] + place - (until - sizes)[owner]


def base_spans(raw: bytes) -> list[tuple[int, int, int]]:
    """(kind, start, end) in bytes of the patterns' matches, hexadecimal runs excepted."""
    found = []
    low = raw.lower()
    for m in ASSIGN.finditer(low):
        if m.end(1) - m.start(1) >= LEAST_VALUE:
            found.append((0, m.start(), m.end()))
    found += [(1, m.start(), m.end()) for m in ACCESS.finditer(raw)]
    return found


def _scanner(key: str, logs: np.ndarray, least_p: float):
    """Rows (key, text) -> (key, base, runs): spans in code points; a run's e is -1 if a test rejects it."""
    base_type = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("length", pa.int32()), ("e", pa.int32())]))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds, flat = _bytes(batch.column(1))
            number = batch.num_rows
            base: list[list] = [[] for _ in range(number)]
            runs: list[list] = [[] for _ in range(number)]
            for i, raw in enumerate(flat.to_pylist()):
                base[i] = base_spans(raw)
            starts, ends = _runs(data, bounds, _HEX, LEAST_HEX)
            owners = np.searchsorted(bounds, starts, "right") - 1
            for i, a, b in zip(owners.tolist(), (starts - bounds[owners]).tolist(), (ends - bounds[owners]).tolist(), strict=True):
                base[i].append((2, a, b))
            for spans in base:
                spans.sort(key=lambda s: (s[1], s[0]))
            starts, ends, kinds = candidates(data, bounds)
            real = kinds > 0
            starts, ends, kinds = starts[real], ends[real], kinds[real]
            if len(starts):
                p, ratio = battery(data, starts, ends, kinds, logs)
                e = np.where(p >= least_p, np.clip(np.floor(ratio * STEPS), -1, MOST), -1).astype(np.int64)
                length = np.floor(2 * np.log2(ends - starts)).astype(np.int64)
                # Up to two signs of padding belong to the run.
                padded = np.append(data, np.zeros(2, np.uint8))
                owners = np.searchsorted(bounds, starts, "right") - 1
                stop = bounds[owners + 1]
                one = (ends < stop) & (padded[ends] == 0x3D)
                two = one & (ends + 1 < stop) & (padded[ends + 1] == 0x3D)
                ends = ends + one + two
                rows = zip(owners.tolist(), (starts - bounds[owners]).tolist(), (ends - bounds[owners]).tolist(), length.tolist(), e.tolist(), strict=True)
                for i, a, b, n, x in rows:
                    runs[i].append((a, b, n, x))
            for i in range(number):
                if runs[i] and base[i]:
                    runs[i] = _outside(runs[i], base[i])
                if runs[i] or base[i]:
                    own = data[bounds[i] : bounds[i + 1]]
                    upto = np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])
                    base[i] = [(k, int(upto[a]), int(upto[b])) for k, a, b in base[i]]
                    runs[i] = [(int(upto[a]), int(upto[b]), n, x) for a, b, n, x in runs[i]]
            yield pa.record_batch(
                [batch.column(0), pa.array(base, base_type), pa.array(runs, run_type)], names=[key, "base", "runs"]
            )

    return apply


def _outside(runs: list[tuple], base: list[tuple]) -> list[tuple]:
    """Runs that no base span covers; both are sorted by start."""
    out, reach, at = [], -1, 0
    for run in runs:
        while at < len(base) and base[at][1] <= run[0]:
            reach = max(reach, base[at][2])
            at += 1
        if run[1] > reach:
            out.append(run)
    return out


def thresholds(scanned: DataFrame, rate: float) -> dict[int, int]:
    """Least e (in steps) that is a discovery, by length class; classes without one are missing.

    Of m runs of a class, the greatest i are discoveries if the i-th e-value is m / (rate * i)
    or more. The table that is ordered has one row per class and step.
    """
    runs = scanned.select(F.explode("runs").alias("r")).select("r.length", "r.e")
    counted = runs.groupBy("length", "e").agg(F.count("*").alias("n"))
    down = Window.partitionBy("length").orderBy(F.desc("e"))
    ranked = counted.select(
        "length", "e", F.sum("n").over(down).alias("i"), F.sum("n").over(Window.partitionBy("length")).alias("m")
    )
    enough = F.col("e") / STEPS >= F.log(F.col("m") / (rate * F.col("i")))
    least = ranked.filter((F.col("e") >= 0) & enough).groupBy("length").agg(F.min("e").alias("e"))
    return {r.length: r.e for r in least.collect()}


def _listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")


def scanned(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rate: float = 0.01, least_p: float = 0.001
) -> DataFrame:
    """(key, spans, base, spans_text, base_text) per row of *docs*; null and empty texts have no spans.

    *spans* and *base* are arrays of (kind, start, end) in code points, ends exclusive, by
    start, then by kind in the order of :data:`KINDS`; the texts are ``kind:start:end``,
    comma-joined. Base spans are those of the patterns, leftmost and not overlapping within
    a kind; a run that a base span covers is not added again. *least_p* is the level of the
    battery: about that share of random runs is lost. *rate* bounds the expected share of
    ordinary runs among those added, by length class, over all rows of *docs*. Repeated rows
    count as often as they stand there. Only *key* and *text* are read.
    """
    small_batches(docs.sparkSession)
    own = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    logs = evidence(frequencies(own, "_text"))
    kind = own.schema["_key"].dataType.simpleString()
    found = stored(
        own.mapInArrow(
            _scanner("_key", logs, least_p),
            f"_key {kind}, base array<struct<kind:int,start:long,end:long>>, "
            "runs array<struct<start:long,end:long,length:int,e:int>>",
        )
    )
    least = thresholds(found, rate)
    if least:
        table = F.create_map(*[F.lit(x).cast("int") for pair in sorted(least.items()) for x in pair])
        taken = lambda r: F.coalesce(r["e"] >= table[r["length"]], F.lit(False))
    else:
        taken = lambda r: F.lit(False)
    added = F.transform(
        F.filter("runs", taken),
        lambda r: F.struct(r["start"].alias("start"), F.lit(3).alias("kind"), r["end"].alias("end")),
    )
    sortable = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    merged = F.transform(
        F.array_sort(F.concat(sortable, added)),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    return found.select(F.col("_key").alias(key), merged.alias("spans"), "base").select(
        key, "spans", "base", _listed(F.col("spans")).alias("spans_text"), _listed(F.col("base")).alias("base_text")
    )
