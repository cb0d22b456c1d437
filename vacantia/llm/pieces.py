"""SentencePiece (BPE with byte fallback) encoding with seeded merge-dropout, and decoding.

The vocabulary is read once on the driver and broadcast (its size is fixed). Pieces never
reach over the start of a word, so a text is encoded word by word: a word is its spaces and
what follows them. Merges are taken from an agenda, best score first, then leftmost. With
dropout every candidate merge is skipped or not by a keyed hash of (seed, text, place of the
word, place of the merge): no random state, so a task that runs again gives the same ids, and
each occurrence of a word draws anew. A task keeps the merges of short words without dropout,
up to a bound in bytes: an occurrence that skips none of them has that segmentation. A long
word is cut where no piece has the two characters on either side, so no merge can cross; very
long texts are encoded some ten thousand words at a time.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain, islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from vacantia.llm.common import share, small_batches

#: The model's sign for a space inside pieces (fixed by the format).
MARK = "▁"
_PART = re.compile(r" *[^ \n]+| +|\n")
_M = (1 << 64) - 1
#: Words of more characters are not kept and are merged one by one.
LONGEST = 64


def place_of(left: int, middle: int, right: int, whole: int) -> int:
    """Name of the merge of [left, middle) and [middle, right) in a word of *whole* characters, 64 bits."""
    if whole < 1 << 21:
        return left << 42 | middle << 21 | right
    return (left * 0x9E3779B97F4A7C15 ^ middle * 0xC2B2AE3D27D4EB4F ^ right * 0x165667B19E3779F9) & _M


class Vocabulary:
    """Pieces by text and by id; a space stands for the mark."""

    def __init__(self, pieces: list[tuple[str, float, str]]) -> None:
        self.ids: dict[str, int] = {}
        self.ranks: dict[str, int] = {}
        self.bytes: dict[int, int] = {}
        self.back: list[bytes] = []
        #: Pairs of characters that stand side by side in some piece.
        self.pairs: set[str] = set()
        scores = sorted({score for _, score, _ in pieces}, reverse=True)
        place = {score: i for i, score in enumerate(scores)}
        for i, (piece, score, kind) in enumerate(pieces):
            if kind == "byte":
                value = int(piece[1:-1], 16)
                self.bytes[value] = i
                self.back.append(bytes([value]))
            elif kind == "normal":
                text = piece.replace(MARK, " ")
                self.ids[text] = i
                self.ranks[text] = place[score]
                self.pairs.update(text[j : j + 2] for j in range(len(text) - 1))
                self.back.append(text.encode())
            else:
                self.back.append(b"")

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """The vocabulary of a model file that the driver can open."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        kind = lambda i: (
            "byte" if model.is_byte(i)
            else "special" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
            else "normal"
        )
        size = model.get_piece_size()
        return cls([(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(size)])

    def _ids(self, symbols: list[str]) -> list[int]:
        out = []
        for s in symbols:
            i = self.ids.get(s)
            if i is None:
                out.extend(self.bytes[b] for b in s.encode("utf-8", "surrogatepass"))
            else:
                out.append(i)
        return out

    def merge(self, word: str, key: int = 0, limit: int = 0, trace: list[int] | None = None) -> list[int]:
        """Ids of one word; a merge at a place is skipped if its hash under *key* is below *limit*.

        The places of the merges that are made are added to *trace* (short words only).
        """
        if len(word) <= LONGEST:
            return self._agenda(word, 0, len(word), key, limit, trace)
        out: list[int] = []
        begin, pairs = 0, self.pairs
        for i in range(1, len(word) + 1):
            if i == len(word) or word[i - 1 : i + 1] not in pairs:
                out += self._agenda(word[begin:i], begin, len(word), key, limit, trace)
                begin = i
        return out

    def _agenda(self, word: str, offset: int, whole: int, key: int, limit: int, trace: list[int] | None) -> list[int]:
        """Ids of a part of a word of *whole* characters that begins at *offset*."""
        ranks = self.ranks
        n = len(word)
        if n == 1:
            return self._ids([word])
        bits = n.bit_length()
        low = (1 << bits) - 1
        ends = array("q", range(1, n + 1))  # end of the symbol that starts at i; 0 once merged away
        before = array("q", range(-1, n - 1))
        # A candidate is one number: rank, then left, middle and right as places in the word.
        agenda = []
        for i in range(n - 1):
            rank = ranks.get(word[i : i + 2])
            if rank is not None:
                agenda.append((((rank << bits | i) << bits | i + 1) << bits) | i + 2)
        heapify(agenda)
        while agenda:
            code = heappop(agenda)
            right = code & low
            middle = code >> bits & low
            left = code >> 2 * bits & low
            if ends[left] != middle or ends[middle] != right:
                continue
            if limit:
                x = (key ^ place_of(left + offset, middle + offset, right + offset, whole)) * 0x9E3779B97F4A7C15 & _M
                if ((x ^ x >> 29) * 0xBF58476D1CE4E5B9 & _M) >> 32 < limit:
                    continue
            if trace is not None:
                trace.append(place_of(left + offset, middle + offset, right + offset, whole))
            ends[left], ends[middle] = right, 0
            if right < n:
                before[right] = left
                end = ends[right]
                rank = ranks.get(word[left:end])
                if rank is not None:
                    heappush(agenda, (((rank << bits | left) << bits | right) << bits) | end)
            if left:
                first = before[left]
                rank = ranks.get(word[first:right])
                if rank is not None:
                    heappush(agenda, (((rank << bits | first) << bits | left) << bits) | right)
        out, at = [], 0
        while at < n:
            out.append(word[at : ends[at]])
            at = ends[at]
        return self._ids(out)

    def decode(self, ids) -> str:
        """The text of a list of ids; the first space is the one that encoding has put there."""
        back = self.back
        return b"".join([back[i] for i in ids]).decode("utf-8", "surrogatepass")[1:]


class Flat:
    """Lists of numbers, one after the other, and the length of each."""

    def __init__(self, values: np.ndarray, counts: np.ndarray) -> None:
        self.values, self.counts = values, counts.astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts

    @classmethod
    def of(cls, lists: list[list[int]], kind: type) -> Flat:
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return cls(np.fromiter(chain.from_iterable(lists), kind, int(counts.sum())), counts)

    def places(self, rows: np.ndarray) -> np.ndarray:
        """Places of the numbers of the lists *rows*, one list after the other."""
        n = self.counts[rows]
        return np.repeat(self.starts[rows] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))

    def more(self, other: Flat) -> Flat:
        return Flat(np.concatenate([self.values, other.values]), np.concatenate([self.counts, other.counts]))


class Parts:
    """Lists of numbers that come in parts, for known rows."""

    def __init__(self, number: int, kind: type) -> None:
        self.counts, self.kind = np.zeros(number, np.int64), kind
        self.held: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, rows: np.ndarray, lists: Flat) -> None:
        self.counts[rows] = lists.counts
        self.held.append((rows, lists.values))

    def flat(self) -> Flat:
        out = Flat(np.empty(int(self.counts.sum()), self.kind), self.counts)
        for rows, values in self.held:
            out.values[out.places(rows)] = values
        return out


class Merger:
    """The agenda of :meth:`Vocabulary.merge` for many words at once, a step for all words at a time."""

    SIZES = (4, 8, 12, 16, 24, 40, 64)
    NONE = np.iinfo(np.int32).max

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        ids = vocabulary.ids
        self.chars = np.full(0x110000, -1, np.int32)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.chars[ord(piece)] = i
        self.ranks = np.zeros(len(vocabulary.back), np.int32)
        keys, values = [], []
        for piece, i in ids.items():
            self.ranks[i] = vocabulary.ranks[piece]
            for cut in range(1, len(piece)):
                left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(i)
        # Pairs by hash, next free slot on a clash: a look-up tries as many slots as the worst key took.
        self.bits = max(10, (8 * len(keys)).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        self.tries = 1
        for key, value, at in zip(keys, values, self._slot(np.array(keys, np.int64)).tolist(), strict=True):
            tried = 1
            while self.slots[at] >= 0:
                at, tried = (at + 1) & ((1 << self.bits) - 1), tried + 1
            self.slots[at], self.values[at] = key, value
            self.tries = max(self.tries, tried)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        x = keys.astype(np.uint64)
        x = (x ^ (x >> np.uint64(15))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x >> np.uint64(64 - self.bits)).astype(np.int64)

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id of the piece that two symbols make, or -1."""
        keys = left.astype(np.int64) << 32 | right
        at = self._slot(keys)
        found = np.where(self.slots[at] == keys, self.values[at], -1)
        open_ = np.flatnonzero((found < 0) & (self.slots[at] >= 0))
        for _ in range(self.tries - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            here = at[open_]
            hit = self.slots[here] == keys[open_]
            found[open_[hit]] = self.values[here[hit]]
            open_ = open_[~hit & (self.slots[here] >= 0)]
        return found

    def merge(self, words: list[str], keys: np.ndarray, limit: int, traced: bool = False) -> tuple[Flat, Flat | None]:
        """Ids of each word under its key, the same as merging them one by one; if *traced*, the places of the merges too."""
        if not words:
            return Flat.of([], np.int32), Flat.of([], np.uint64) if traced else None
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        plain = sizes <= self.SIZES[-1]
        short = [w if p else "" for w, p in zip(words, plain.tolist(), strict=True)]
        text = np.frombuffer("".join(short).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols = self.chars[text]
        inside = np.where(plain, sizes, 0)
        starts = np.cumsum(inside) - inside
        own = np.flatnonzero(inside)
        if len(own):
            plain[own] = np.minimum.reduceat(symbols, starts[own]) >= 0
        ids, places = Parts(len(words), np.int32), Parts(len(words), np.uint64)
        slow = np.flatnonzero(~plain)
        for at in range(0, len(slow), 8192):
            part = slow[at : at + 8192]
            traces: list[list[int]] = [[] for _ in part]
            made = [
                self.vocabulary.merge(words[i], int(keys[i]), limit, own if traced else None)
                for i, own in zip(part.tolist(), traces, strict=True)
            ]
            ids.add(part, Flat.of(made, np.int32))
            places.add(part, Flat.of(traces, np.uint64))
        least = 0
        for most in self.SIZES:
            own = np.flatnonzero(plain & (sizes > least) & (sizes <= most))
            least = most
            for at in range(0, len(own), 8192):
                part = own[at : at + 8192]
                steps: list | None = [] if traced else None
                values, counts = self._block(symbols, starts[part], sizes[part], most, keys[part], limit, steps)
                ids.add(part, Flat(values, counts))
                if steps is not None:
                    rows = np.concatenate([r for r, _ in steps] or [np.empty(0, np.int64)])
                    found = np.concatenate([p for _, p in steps] or [np.empty(0, np.uint64)])
                    places.add(part, Flat(found[np.argsort(rows, kind="stable")], np.bincount(rows, minlength=len(part))))
        return ids.flat(), places.flat() if traced else None

    @staticmethod
    def skipped(keys: np.ndarray, places: np.ndarray, limit: int) -> np.ndarray:
        """Whether the merge at each place is skipped under its key."""
        x = (keys ^ places) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x >> np.uint64(32)) < np.uint64(limit)

    def _block(self, symbols, starts, sizes, most, key, limit, steps=None) -> tuple[np.ndarray, np.ndarray]:
        number = len(starts)
        place = np.arange(most)
        inside = place < sizes[:, None]
        symbol = np.where(inside, symbols[np.minimum(starts[:, None] + place, len(symbols) - 1)], -1)
        after = np.broadcast_to(place + 1, (number, most)).copy()
        before = np.broadcast_to(place - 1, (number, most)).copy()
        made = np.full((number, most), -1, np.int32)
        rank = np.full((number, most), self.NONE, np.int32)
        if most > 1:
            row, at = np.nonzero(inside[:, 1:])
            new = self.joined(symbol[row, at], symbol[row, at + 1])
            made[row, at] = new
            rank[row, at] = np.where(new >= 0, self.ranks[new], self.NONE)
        live = inside.copy()
        rows = np.arange(number)
        while len(rows):
            left = rank[rows].argmin(axis=1) if len(rows) < number else rank.argmin(axis=1)
            more = rank[rows, left] != self.NONE
            rows, left = rows[more], left[more]
            if not len(rows):
                break
            middle = after[rows, left]
            right = after[rows, middle]
            r, go_left, go_middle, go_right = rows, left, middle, right
            if limit:
                skip = self.skipped(key[rows], (left << 42 | middle << 21 | right).astype(np.uint64), limit)
                rank[rows[skip], left[skip]] = self.NONE
                go = ~skip
                r, go_left, go_middle, go_right = rows[go], left[go], middle[go], right[go]
            if steps is not None:
                steps.append((r, (go_left << 42 | go_middle << 21 | go_right).astype(np.uint64)))
            piece = made[r, go_left]
            symbol[r, go_left] = piece
            live[r, go_middle] = False
            rank[r, go_middle] = self.NONE
            after[r, go_left] = go_right
            has = go_right < sizes[r]
            rank[r, go_left] = self.NONE
            q, a, b = r[has], go_left[has], go_right[has]
            before[q, b] = a
            self._offer(symbol, made, rank, q, a, b)
            has = go_left > 0
            q, b = r[has], go_left[has]
            self._offer(symbol, made, rank, q, before[q, b], b)
        return symbol[live], live.sum(axis=1)

    def _offer(self, symbol, made, rank, row, left, right) -> None:
        new = self.joined(symbol[row, left], symbol[row, right])
        made[row, left] = new
        rank[row, left] = np.where(new >= 0, self.ranks[new], self.NONE)


class Encoder:
    """Encodes batches of texts, keeping the merges of short words up to a bound."""

    #: Bytes of kept words, about.
    KEEP = 32 << 20
    #: Texts of more characters are cut into lists of so many words.
    LONG_TEXT, WORDS = 1 << 20, 1 << 16

    def __init__(self, merger: Merger, dropout: float, seed: int) -> None:
        self.merger, self.vocabulary = merger, merger.vocabulary
        self.limit = round(dropout * (1 << 32))
        self.seed = seed
        self._forget()

    def _forget(self) -> None:
        #: Words without dropout: number, ids and places of the merges.
        self.number: dict[str, int] = {}
        self.ids, self.traces = Flat.of([], np.int32), Flat.of([], np.uint64)
        self.held = 0

    def _learn(self, words: list[str]) -> None:
        ids, places = self.merger.merge(words, np.zeros(len(words), np.uint64), 0, traced=True)
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words)), strict=True))
        self.ids, self.traces = self.ids.more(ids), self.traces.more(places)
        # A string and its place in the dictionary take some 200 bytes, an entry of the lists 32.
        self.held += 240 * len(words) + 4 * len(ids.values) + 8 * len(places.values)

    def _merged(self, words: list[str], keys: np.ndarray) -> Flat:
        """Ids of each occurrence of a word under its own key."""
        if self.held > self.KEEP:
            self._forget()
        number = self.number
        new = [w for w in dict.fromkeys(words) if w not in number and len(w) <= LONGEST]
        if new:
            self._learn(new)
        at = np.fromiter((number.get(w, -1) for w in words), np.int64, len(words))
        again = at < 0
        if self.limit:
            for low in range(0, len(words), 1 << 15):
                own = np.flatnonzero(at[low : low + (1 << 15)] >= 0) + low
                many = self.traces.counts[at[own]]
                places = self.traces.values[self.traces.places(at[own])]
                again[np.repeat(own, many)[self.merger.skipped(np.repeat(keys[own], many), places, self.limit)]] = True
        kept, again = np.flatnonzero(~again), np.flatnonzero(again)
        out = Parts(len(words), np.int32)
        out.add(kept, Flat(self.ids.values[self.ids.places(at[kept])], self.ids.counts[at[kept]]))
        if len(again):
            out.add(again, self.merger.merge([words[i] for i in again.tolist()], keys[again], self.limit)[0])
        return out.flat()

    def _long(self, text: str) -> np.ndarray:
        """Ids of a long text, some words at a time."""
        found, first = [], 0
        words = (m[0] for m in _PART.finditer(" " + text))
        digest = xxh64_intdigest(text.encode("utf-8", "surrogatepass"), self.seed)
        while part := list(islice(words, self.WORDS)):
            place = np.arange(first, first + len(part)).astype(np.uint64)
            found.append(self._merged(part, _mixed(np.uint64(digest), place)).values)
            first += len(part)
        return np.concatenate(found)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text (null and empty: none)."""
        long = [bool(t) and len(t) > self.LONG_TEXT for t in texts]
        split = [_PART.findall(" " + t) if t and not far else [] for t, far in zip(texts, long, strict=True)]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        words = list(chain.from_iterable(split))
        del split
        base = [xxh64_intdigest(t.encode("utf-8", "surrogatepass"), self.seed) if t else 0 for t in texts]
        place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ids = self._merged(words, _mixed(np.repeat(np.array(base, np.uint64), sizes), place.astype(np.uint64)))
        upto = np.concatenate([[0], np.cumsum(ids.counts)])
        ends = np.cumsum(sizes)
        return [
            self._long(t) if far else ids.values[a:b]
            for t, far, a, b in zip(texts, long, upto[ends - sizes].tolist(), upto[ends].tolist(), strict=True)
        ]


def _mixed(base: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The key of an occurrence: the digest of seed and text, and the word's place in the text."""
    keys = base + place * np.uint64(0x9E3779B97F4A7C15)
    keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return keys ^ (keys >> np.uint64(31))


def encoded(
    docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", dropout: float = 0.1, seed: int = 42
) -> DataFrame:
    """(key, ids, n_ids, lossless) per row of *docs*; only *key* and *text* are read.

    *lossless* tells that the ids decode to the text, checked on every row. Null and empty
    texts have no ids and decode to the empty text. A literal mark, control characters and
    characters outside the vocabulary are encoded as bytes. Words may have any length. Each
    occurrence of a word draws its own dropout. Equal texts give equal ids; repeated rows stay.
    """
    spark: SparkSession = docs.sparkSession
    shared = share(spark, Merger(Vocabulary.read(model_path)))
    kind = docs.select(key).schema[0].dataType.simpleString()
    flat = pa.list_(pa.int32())

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, dropout, seed)
        decode = encoder.vocabulary.decode
        for batch in batches:
            texts = batch.column(1).to_pylist()
            rows = encoder.encode(texts)
            same = [decode(ids.tolist()) == (t or "") for ids, t in zip(rows, texts, strict=True)]
            ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(ends, np.concatenate([np.empty(0, np.int32), *rows]))
            yield pa.record_batch(
                [batch.column(0), ids.cast(flat), pa.array(np.diff(ends)), pa.array(same)],
                names=[key, "ids", "n_ids", "lossless"],
            )

    small_batches(spark)
    return docs.select(F.col(key), F.col(text)).mapInArrow(
        apply, f"`{key}` {kind}, ids array<int>, n_ids int, lossless boolean"
    )


def decoded(encodings: DataFrame, model_path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """*encodings* with the text of its ids (null ids: null)."""
    shared = share(encodings.sparkSession, Vocabulary.read(model_path))

    @F.pandas_udf("string")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for rows in batches:
            yield pd.Series([None if x is None else shared.value.decode(x) for x in rows], dtype=object)

    small_batches(encodings.sparkSession)
    return encodings.withColumn(out, apply(F.col(ids)))
