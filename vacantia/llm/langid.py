"""Language identification, word first: known words by log frequency, unseen words by shorter and shorter runs of characters."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacantia.llm.common import discard, share, small_batches, stored

#: A word: a run of letters of any script.
WORD = re.compile(r"[^\W\d_]+")
UNDECIDED = "und"


@dataclass
class Model:
    """Log frequencies by language; ``words`` and ``grams[n]`` give the row of a string.

    A row holds what its languages have above ``missing``, the log frequency of a string
    that was not seen, by order (0: words); languages that have not seen it take no room.
    """

    langs: list[str]
    #: Words learned from each language, which decide between equal scores.
    sizes: np.ndarray
    words: dict[str, int]
    grams: dict[int, dict[str, int]]
    starts: np.ndarray
    places: np.ndarray
    above: np.ndarray
    missing: dict[int, np.ndarray]

    def above_missing(self, rows: list[int], weights: list[float]) -> np.ndarray:
        """Weighted sum of what the rows have above the strings that were not seen, by language."""
        out = np.zeros(len(self.langs))
        for at in range(0, len(rows), 1 << 15):
            r = np.array(rows[at : at + (1 << 15)], np.int64)
            begin = self.starts[r]
            n = self.starts[r + 1] - begin
            cells = np.repeat(begin - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
            much = np.repeat(np.array(weights[at : at + (1 << 15)]), n)
            out += np.bincount(self.places[cells], self.above[cells] * much, len(self.langs))
        return out


def training_words(docs: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, word, n): how often each word stands in the texts of a language."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, Counter] = {}
            for label, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found.setdefault(label, Counter()).update(WORD.findall(body.lower()))
            rows = [(a, w, n) for a, c in found.items() for w, n in c.items()]
            if rows:
                yield pa.record_batch([list(c) for c in zip(*rows, strict=True)], schema=schema)

    small_batches(docs.sparkSession)
    return (
        docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
        .filter("lang is not null and text is not null")
        .mapInArrow(count, "lang string, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
    )


def training_runs(counts: DataFrame, orders: tuple[int, ...]) -> DataFrame:
    """(order, lang, key, n): how often each run of characters stands in the whole words of *counts*.

    A word has one sign at its start and one at its end.
    """
    schema = pa.schema([("order", pa.int32()), ("lang", pa.string()), ("key", pa.string()), ("n", pa.int64())])

    def taken(found: Counter) -> pa.RecordBatch:
        keys = zip(*found, strict=True)
        return pa.record_batch([pa.array(c, f.type) for c, f in zip([*keys, found.values()], schema, strict=True)], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for lang, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                marked = f"^{word}$"
                for order in orders:
                    for i in range(len(marked) - order + 1):
                        found[order, lang, marked[i : i + order]] += n
                        if len(found) >= 200_000:
                            yield taken(found)
                            found.clear()
            if found:
                yield taken(found)

    small_batches(counts.sparkSession)
    return (
        counts.select("lang", "word", "n")
        .mapInArrow(count, "order int, lang string, key string, n long")
        .groupBy("order", "lang", "key")
        .agg(F.sum("n").alias("n"))
    )


def sample(docs: DataFrame, lang: str, text: str, bound: int) -> DataFrame:
    """About *bound* rows, as many of each language, chosen by the hash of their text: the same ones on each run."""
    numbers = {r.lang: r.n for r in docs.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).collect()}
    each = max(1, bound // max(1, len(numbers)))
    parts = {a: int(each / n * 1_000_000) + 1 for a, n in numbers.items() if n > each}
    if not parts:
        return docs
    table = F.create_map(*[F.lit(x) for pair in sorted(parts.items()) for x in pair])
    part = F.coalesce(F.element_at(table, F.col(lang)), F.lit(1_000_000))
    return docs.filter(F.pmod(F.xxhash64(F.lit("sample"), F.col(text)), F.lit(1_000_000)) < part)


def fit(
    docs: DataFrame,
    lang: str = "lang",
    text: str = "text",
    max_rows: int = 12_000,
    max_words: int = 40_000,
    max_grams: int = 30_000,
    orders: tuple[int, ...] = (5, 4, 3, 2, 1),
    floor: float = 0.5,
) -> Model:
    """Learn from the rows with a language and a text (null in either: not used).

    The model is fitted on a sample of about *max_rows* rows, an equal share of each
    language, and holds at most *max_words* words and *max_grams* n-grams of each order: of
    each language an equal share, its commonest, ties in code point order. So it has a size
    bound and may be broadcast, and a language with few rows keeps its words. *floor* is
    added to every count. Repeated rows count as often as they stand in the sample.
    """
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    counts = stored(training_words(sample(known, lang, text, max_rows), lang, text))
    totals = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    place = {a: i for i, a in enumerate(langs)}
    lengths: list[int] = []
    places: list[np.ndarray] = []
    above: list[np.ndarray] = []
    missing: dict[int, np.ndarray] = {}

    def commonest(table: DataFrame, limit: int, order: int, sums: dict[str, int]) -> dict[str, int]:
        by_count = Window.partitionBy("lang").orderBy(F.desc("n"), "key")
        share = max(1, limit // max(1, len(langs)))
        best = table.withColumn("rank", F.row_number().over(by_count)).filter(F.col("rank") <= share)
        chosen = (
            table.join(best.select("key").distinct(), "key", "left_semi")
            .groupBy("key")
            .agg(F.sort_array(F.collect_list(F.struct("lang", "n"))).alias("by"))
            .collect()
        )
        total = np.array([sums.get(a, 0) for a in langs], float) + floor * max(1, len(chosen))
        missing[order] = np.log(floor / total)
        index = {}
        for r in sorted(chosen, key=lambda r: r.key):
            index[r.key] = len(lengths)
            lengths.append(len(r.by))
            places.append(np.array([place[x.lang] for x in r.by], np.int32))
            above.append(np.log(np.array([x.n for x in r.by], float) / floor + 1))
        return index

    words = commonest(counts.withColumnRenamed("word", "key"), max_words, 0, totals)
    grams = {}
    runs = stored(training_runs(counts, orders))
    for order in orders:
        table = runs.filter(F.col("order") == order).select("lang", "key", "n")
        sums = {r.lang: r.n for r in table.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
        grams[order] = commonest(table, max_grams, order, sums)
    discard(runs)
    discard(counts)
    return Model(
        langs,
        np.array([totals[a] for a in langs], float),
        words,
        grams,
        np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64),
        np.concatenate([np.empty(0, np.int32), *places]),
        np.concatenate([np.empty(0), *above]),
        missing,
    )


class Scorer:
    """Scores texts by one model. Nothing is kept between texts."""

    def __init__(self, model: Model) -> None:
        self.model = model

    def known_runs(self, word: str) -> tuple[int, list[int]]:
        """The longest order of which the word has a known run, and the rows of all of those (none: 0)."""
        marked = f"^{word}$"
        for order, index in self.model.grams.items():
            # A sign alone says nothing about a word.
            body = marked if order > 1 else word
            at = [row for i in range(len(body) - order + 1) if (row := index.get(body[i : i + order])) is not None]
            if at:
                return order, at
        return 0, []

    def unseen_words(self, words: list[str]) -> np.ndarray:
        """Sum over words of the mean log frequency of their known runs of the longest order that has any."""
        model = self.model
        out = np.zeros(len(model.langs))
        rows: list[int] = []
        weights: list[float] = []
        many: Counter = Counter()
        for word in words:
            order, at = self.known_runs(word)
            if at:
                many[order] += 1
                rows += at
                weights += [1 / len(at)] * len(at)
            if len(rows) > 100_000:
                out += model.above_missing(rows, weights)
                rows, weights = [], []
        for order, n in sorted(many.items()):
            out += n * model.missing[order]
        return out + model.above_missing(rows, weights)

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, its share of the evidence); of equal ones the language with most learned words, then the first by name.

        So a text of which nothing is known gets the commonest language, with an equal share.
        """
        words = WORD.findall(text.lower()) if text else []
        if not words or not self.model.langs:
            return UNDECIDED, 0.0
        index = self.model.words
        found, strange = [], []
        for word in words:
            at = index.get(word)
            if at is None:
                strange.append(word)
            else:
                found.append(at)
        total = len(found) * self.model.missing[0] + self.model.above_missing(found, [1.0] * len(found))
        total = total + self.unseen_words(strange)
        # Words of one text are not independent: the evidence of a text counts as at most 16 words.
        mean = total / len(words) * min(len(words), 16)
        share = np.exp(mean - mean.max())
        best = int(np.argmax(np.where(share == share.max(), self.model.sizes, -1)))
        return self.model.langs[best], float(share[best] / share.sum())


def predicted(model: Model, docs: DataFrame, text: str = "text") -> Column:
    """Struct column (lang, score) of a text: ``und`` with 0 for a null or letterless text. Repeated rows get the same."""
    shared = share(docs.sparkSession, model)

    @F.pandas_udf("lang string, score double")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for texts in batches:
            yield pd.DataFrame([scorer.predict(t) for t in texts], columns=["lang", "score"])

    small_batches(docs.sparkSession)
    return apply(F.col(text))


def held_out(key: str = "doc_id") -> Column:
    """True for the fifth of the keys that no model learns from (null: never learned from)."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(True))
