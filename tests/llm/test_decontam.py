"""Benchmark windows against a comparison of every window with every item."""

import random
from collections import Counter

import numpy as np
import pytest

from vacantia.llm import decontam


def shingles(words, width):
    return Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(docs, items, width, least):
    out = []
    for doc, text in docs:
        words = decontam.words_of(text)
        for item, body in set(items):
            want = decontam.words_of(body)
            if not want or item is None:
                continue
            w = min(width, len(want))
            right = shingles(want, w)
            best = None
            for start in range(len(words) - len(want) + 1):
                left = shingles(words[start : start + len(want)], w)
                s = sum((left & right).values()) / sum((left | right).values())
                if s >= least and (best is None or s > best[0]):
                    best = s, start
            if best:
                out.append((doc, item, best[1], len(want), round(best[0], 9)))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_all_windows(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([2, 4, 12, 30, 31, 45])))) for i in range(25)]
    items += [(30, "a a a a a a a a b"), (31, None), (32, " "), (None, "w1 w2"), (0, items[0][1])]
    docs = []
    for doc in range(60):
        words = rng.choices(vocabulary, k=rng.randrange(0, 120))
        for _ in range(rng.randrange(3)):
            part = rng.choice(items[:25])[1].split()
            for _ in range(rng.randrange(3)):
                part[rng.randrange(len(part))] = rng.choice(["zz", "W3"])
            at = rng.randrange(len(words) + 1)
            words[at:at] = part
        docs.append((doc, rng.choice([" ", ",  ", "\n"]).join(words).upper()))
    docs += [(70, None), (71, ""), (72, "a " * 3000 + "a a a a a a a a b"), (72, items[3][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.matches(d, b)
    found = sorted((*r[:4], round(r[4], 9)) for r in got.collect())
    assert found == brute(docs, items, 5, 0.8)
    assert sorted((*r[:4], round(r[4], 9)) for r in decontam.matches(d, b, part_bytes=400).collect()) == found


def test_blocks_meet_everything_within_the_radius():
    rng = random.Random(5)
    items = [(i, " ".join(f"v{rng.randrange(999)}" for _ in range(20))) for i in range(300)]
    index = decontam.Index(items, 5, 0.8, 24)
    size = index.sizes[0]
    for i in range(100):
        near = int(size.prints[i])
        for bit in rng.sample(range(64), rng.randrange(25)):
            near ^= 1 << bit
        want = {k for k, p in enumerate(size.prints.tolist()) if (p ^ near).bit_count() <= 24}
        window, item = index.within_radius(size, np.array([near, 0], np.uint64))
        assert i in want and set(item[window == 0].tolist()) == want


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, item_id long")
    some = spark.createDataFrame([(1, "a b c d e f", 1)], "doc_id long, text string, item_id long")
    assert decontam.matches(none, some).count() == 0
    assert decontam.matches(some, none).count() == 0
    assert [tuple(r) for r in decontam.matches(some, some).collect()] == [(1, 1, 0, 6, 1.0)]


@pytest.mark.parametrize("seed", [3, 4])
def test_texts_shorter_than_an_item(spark, seed):
    rng = random.Random(seed)
    items = [(i, " ".join(f"v{rng.randrange(400)}" for _ in range(rng.choice([2, 5, 6, 39, 59])))) for i in range(40)]
    docs = []
    for doc in range(160):
        words = rng.choice(items)[1].split()
        for _ in range(rng.randrange(6)):
            del words[rng.choice([0, -1, rng.randrange(len(words))]) if words else slice(0)]
        docs.append((doc, " ".join(words)))
    docs += [(200, items[0][1].split()[0]), (201, "")]
    want = brute(docs, items, 5, 0.8)
    for doc, text in docs:  # the whole text against each item that has more words
        words = decontam.words_of(text)
        for item, body in items:
            other = decontam.words_of(body)
            w = min(5, len(other))
            if 0 < len(words) < len(other):
                left, right = shingles(words, w), shingles(other, w)
                s = sum((left & right).values()) / sum((left | right).values())
                if s >= 0.8:
                    want.append((doc, item, 0, len(words), round(s, 9)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    found = sorted((*r[:4], round(r[4], 9)) for r in decontam.matches(d, b).collect())
    assert sum(n < len(items[i][1].split()) for _, i, _, n, _ in found) > 10
    assert found == sorted(want)
    hit = {f[0] for f in found}
    assert {r.doc_id for r in decontam.without_benchmark(d, b).collect()} == {doc for doc, _ in docs} - hit
