"""Repeated strings against a table of all strings."""

import random

import numpy as np
import pytest

from vacantia.llm import repeats


def brute(rows, length):
    """rows: (order key, bytes) in order; the result of each."""
    seen, out = {}, []
    for key, data in rows:
        gone = [False] * len(data)
        for s in range(len(data) - length + 1):
            w = data[s : s + length]
            if seen.setdefault(w, (key, s)) != (key, s):
                gone[s : s + length] = [True] * length
        runs, at = [], 0
        while at < len(data):
            end = at
            while end < len(data) and gone[end] == gone[at]:
                end += 1
            if gone[at]:
                runs.append((at, end))
            at = end
        out.append((bytes(b for b, g in zip(data, gone) if not g), runs))
    return out


def corpus(seed, number, most):
    rng = random.Random(seed)
    words = [f"w{i}é" if i % 5 == 0 else f"word{i}" for i in range(300)]
    passages = [" ".join(rng.choices(words, k=rng.randrange(10, 60))) for _ in range(12)]
    texts = []
    for _ in range(number):
        parts = []
        for _ in range(rng.randrange(most)):
            parts.append(rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choices(words, k=rng.randrange(40))))
        texts.append(rng.choice([" ", "\n", ""]).join(parts))
        if rng.random() < 0.2:
            texts.append(texts[rng.randrange(len(texts))])
    return texts + ["a" * 5000, "a" * 99, "a" * 100, "ab" * 2000, "", None, "ab" * 60 + "c" + "a" * 300]


def check(spark, rows, length=100):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, bytes(r.kept), [(x["from"], x["to"]) for x in r.removed]) for r in repeats.without_repeats(docs, length=length).collect()]
    ordered = sorted(rows, key=lambda r: -(2**63) if r[0] is None else r[0])
    want = brute([(k, (t or "").encode()) for k, t in ordered], length)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(got, key=key) == sorted(((k, *w) for (k, _), w in zip(ordered, want)), key=key)


@pytest.mark.parametrize("seed,length", [(1, 100), (2, 100), (3, 40)])
def test_same_as_all_strings(spark, seed, length):
    texts = corpus(seed, 80, 8)
    random.Random(seed).shuffle(texts)
    check(spark, [(7 * i - 50, t) for i, t in enumerate(texts)], length)


def test_hot_anchors_and_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 3)
    monkeypatch.setattr(repeats, "COMBINE", 50)
    check(spark, list(enumerate(corpus(4, 60, 6))))


def test_long_text_in_pieces(monkeypatch):
    data = np.frombuffer(" ".join(t for t in corpus(5, 40, 8) if t).encode(), np.uint8)
    whole = repeats.Hasher(100).anchors(data)
    monkeypatch.setattr(repeats, "PIECE", 400)
    cut = repeats.Hasher(100).anchors(data)
    assert all((a == b).all() for a, b in zip(whole, cut))


def test_null_keys_repeats_and_clashes(spark):
    long = " ".join(f"part{i}" for i in range(40))
    check(spark, [(None, long), (3, long), (4, "x" + long)])
    twice = spark.createDataFrame([(3, long), (3, long)], "doc_id long, text string")
    assert [bytes(r.kept).decode() for r in repeats.without_repeats(twice).collect()] == [long, long]
    clash = spark.createDataFrame([(3, long, 1), (3, long + " y", 2)], "doc_id long, text string, num int")
    kept = sorted(len(r.kept) for r in repeats.without_repeats(clash).collect())
    assert kept[0] <= 2 and kept[1] >= len(long)
    assert repeats.without_repeats(clash.filter("false")).count() == 0


def test_previous_factors():
    rng = random.Random(1)
    text = "".join(rng.choice("ab") for _ in range(60))
    order = sorted(range(60), key=lambda i: text[i:])

    def common(i, j):
        n = 0
        while max(i, j) + n < 60 and text[i + n] == text[j + n]:
            n += 1
        return n

    lcp = np.array([0] + [common(a, b) for a, b in zip(order, order[1:])])
    got = dict(zip(order, repeats.lpf(np.array(order), lcp, 1).tolist()))
    assert got == {i: max([common(i, j) for j in range(i)], default=0) for i in range(60)}
