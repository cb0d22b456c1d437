"""Resampling: CRC by position table against zlib, whole results against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from vacantia.llm import resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_crc_of_spans(monkeypatch):
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 70_000).astype(np.uint8)
    lengths = np.concatenate([np.arange(0, 300), [4095, 4096, 4097, 65_000], rng.integers(1, 900, 300)])
    starts = rng.integers(0, 70_000 - lengths)
    want = [zlib.crc32(data[s : s + n].tobytes()) for s, n in zip(starts.tolist(), lengths.tolist())]
    assert resampling.crc32_of_spans(data, starts, lengths).tolist() == want
    monkeypatch.setattr(resampling, "CHUNK", 128)
    assert resampling.crc32_of_spans(data, starts, lengths).tolist() == want
    none = np.empty(0, np.int64)
    assert resampling.crc32_of_spans(data, none, none).tolist() == []


def features(text, longest):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, longest, buckets, percent, least, seed):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = [0] * buckets, [0] * buckets
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for f in features(text, longest)[1]:
                counts[bucket(f)] += 1
    S, T = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (S + buckets) / ((a + 1) * (T + buckets)))) for a, b in zip(s, t)]
    rows = []
    for key, text in docs:
        words, own = features(text, longest)
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in own)
        rows.append([key, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(words)])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for rank, row in enumerate(able[: percent * len(able) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=str)


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_same_as_brute_force(spark, longest):
    rng = random.Random(longest)
    alphabet = ["Aa", "the", "é", "漢字", "x1", "\x00", "--", "İ", "z" * 70, "y" * 300, "{", "\n", "🙂"]
    text = lambda n: "".join(rng.choice(alphabet) + rng.choice([" ", "", ".", "  "]) for _ in range(n))
    docs = [(i, text(rng.randrange(60))) for i in range(150)]
    docs += [(500, None), (501, ""), (None, text(40)), (502, "k" * 20_000 + " " + "many words " * 9_000)]
    docs += [docs[3], docs[3]] + [(i, "the same text " * 8) for i in range(600, 620)]
    target = [text(30) for _ in range(10)] + [None, ""]
    given = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, score int")
    wanted = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "rank int, text string")
    got = resampling.resampled(given, wanted, longest=longest, buckets=500, percent=30, least_words=5, seed=7)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, target, longest, 500, 30, 5, 7)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert resampling.resampled(none, some).count() == 0
    rows = resampling.resampled(some, none, buckets=10, percent=100, least_words=1).collect()
    assert sorted((r.doc_id, r.n_features, r.rank) for r in rows) == [(1, 2, 1), (2, 0, None)]
    # string keys
    named = spark.createDataFrame([("x", "a b"), ("y", "b")], "doc_id string, text string")
    assert {r.rank for r in resampling.resampled(named, some, percent=100, least_words=1).collect()} == {1, 2}
