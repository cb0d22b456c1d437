"""Quality scores learned by Bradley-Terry comparison of document pairs.

A pair is a document labelled good and one labelled bad; the model's chance that the first
is the better one is the logistic of the difference of their scores, and a score is linear
in the features of the text alone. The cut between good and bad is the quantile of training
scores that leaves as many above it as are labelled good.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.llm.common import share, small_batches

#: Probability that a score at the cut is given.
CUT = 0.3


def _classes() -> np.ndarray:
    """A class of every byte: letters by case, digits, spaces, marks one by one where common, other bytes."""
    out = np.zeros(256, np.uint8)
    out[128:] = 1
    out[ord("a") : ord("z") + 1] = 2
    out[ord("A") : ord("Z") + 1] = 3
    out[ord("0") : ord("9") + 1] = 4
    out[[32, 9]] = 5
    out[[10, 13]] = 6
    for i, mark in enumerate(".,!|*#&%$"):
        out[ord(mark)] = 7 + i
    return out


_CLASS = _classes()
FEATURES = 128 + 256 + 8


def features(text: str | None) -> np.ndarray:
    """Shares of bytes and of pairs of byte classes, and shapes of words and lines (all 0 if empty)."""
    out = np.zeros(FEATURES, np.float32)
    if not text:
        return out
    raw = text.encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, np.uint8)
    counts = np.bincount(data, minlength=256)
    out[:128] = np.sqrt(counts[:128] / len(data))
    kinds = _CLASS[data]
    if len(kinds) > 1:
        pairs = np.bincount(kinds[:-1] * np.uint8(16) + kinds[1:], minlength=256)
        out[128:384] = np.sqrt(pairs / (len(kinds) - 1))
    words = raw.split()
    lines = raw.split(b"\n")
    number = max(1, len(words))
    out[384:] = (
        np.log1p(len(data)) / 10,
        counts[128:].sum() / len(data),
        len(data) / number / 10,
        len(set(words)) / number,
        len(set(lines)) / len(lines),
        np.log1p(len(data) / len(lines)) / 10,
        sum(map(bytes.isupper, words)) / number,
        sum(map(bytes.isalpha, words)) / number,
    )
    return out


@dataclass
class Model:
    """Linear scores of standardised features; ``cut`` is the score at the quantile."""

    weights: np.ndarray
    bias: float
    cut: float

    def scores(self, texts) -> np.ndarray:
        x = np.array([features(t) for t in texts], np.float64).reshape(-1, FEATURES)
        raw = np.clip(x @ self.weights + self.bias - self.cut, -30, 30)
        return 1 / (1 + np.exp(-(raw + np.log(CUT / (1 - CUT)))))


def bradley_terry(good: np.ndarray, bad: np.ndarray, pairs: int, steps: int, penalty: float, seed: int) -> np.ndarray:
    """Weights that make good rows beat bad ones: gradient steps on the mean logistic loss of drawn pairs."""
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, len(good), pairs), rng.integers(0, len(bad), pairs)
    weights = np.zeros(good.shape[1])
    moved = np.zeros_like(weights)
    for step in range(steps):
        ahead = (good @ weights)[a] - (bad @ weights)[b]
        lost = 1 / (1 + np.exp(np.clip(ahead, -30, 30)))
        slope = -(np.bincount(a, lost, len(good)) @ good - np.bincount(b, lost, len(bad)) @ bad) / pairs
        moved = 0.9 * moved - 0.05 * (slope + penalty * weights)
        weights = weights + moved
    return weights


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    max_rows: int = 6_000,
    pairs: int = 20_000,
    steps: int = 150,
    penalty: float = 1e-3,
    seed: int = 5,
) -> Model:
    """Learn from labelled documents (0 or 1; null keys and labels are left out).

    About *max_rows* labels are used, chosen by the hash of their keys, so both the join and
    the features that reach the driver have a size bound. Without both kinds of labels all
    scores are equal. Repeated labels count as often as they stand there.
    """
    spark = docs.sparkSession
    usable = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).filter("k is not null and y in (0, 1)")
    number = usable.count()
    if number > max_rows:
        part = int(max_rows / number * 1_000_000)
        usable = usable.filter(F.pmod(F.xxhash64(F.lit("fit"), "k"), F.lit(1_000_000)) < part)

    @F.pandas_udf("array<float>")
    def vector(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([features(t) for t in texts])

    small_batches(spark)
    chosen = docs.select(F.col(key).alias("d"), F.col(text).alias("t")).join(F.broadcast(usable), F.col("d") == F.col("k"))
    rows = chosen.select("d", "y", vector("t").alias("x")).orderBy("d", "y").toPandas()
    if not len(rows) or rows.y.nunique() < 2:
        return Model(np.zeros(FEATURES), 0.0, 0.0)
    x = np.stack(rows.x).astype(np.float64)
    y = rows.y.to_numpy()
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = (x - mean) / spread
    weights = bradley_terry(x[y == 1], x[y == 0], pairs, steps, penalty, seed)
    raw = x @ weights
    cut = float(np.quantile(raw, 1 - y.mean()))
    return Model(weights / spread, -float(mean / spread @ weights), cut)


def scored(model: Model, docs: DataFrame, text: str = "text") -> Column:
    """Column: score from 0 to 1 of a text (null and empty texts: that of no features)."""
    shared = share(docs.sparkSession, model)

    @F.pandas_udf("double")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.scores(texts), dtype="float64")

    small_batches(docs.sparkSession)
    return apply(F.col(text))
