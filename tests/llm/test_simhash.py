"""Ball hashing against all pairs; edge cases of texts, keys and columns."""

import random

import numpy as np
import pytest
import xxhash

from vacantia.llm import simhash
from vacantia.llm.common import components


def naive_print(text, width=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(r, seed=42) for r in runs]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def naive_groups(fps, radius):
    root = list(range(len(fps)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(fps))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("radius", [2, 4])
def test_links_join_what_all_pairs_join(spark, radius):
    rng = random.Random(radius)
    fps = []
    for _ in range(40):
        fps.append(rng.getrandbits(64))
        for _ in range(rng.randrange(12)):
            fps.append(fps[-1] ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 6))))
    fps = sorted(set(fps))
    rows = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    links = [(a % 2**64, b % 2**64) for a, b in simhash.hamming_links(rows, radius).collect()]
    assert all(bin(a ^ b).count("1") for a, b in links)
    at = {f: i for i, f in enumerate(fps)}
    found = {r.node: r.root for r in components(spark.createDataFrame([(signed(a), signed(b)) for a, b in links], "a long, b long")).collect()}
    got = {}
    for f in fps:
        got.setdefault(found.get(signed(f), signed(f)), set()).add(at[f])
    want = {}
    for i, r in enumerate(naive_groups(fps, radius)):
        want.setdefault(r, set()).add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_dense_group_is_cut_into_blocks(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 500)
    rng = random.Random(3)
    base = rng.getrandbits(64)
    fps = sorted({base ^ sum(1 << b for b in rng.sample(range(40), 3)) for _ in range(60)})
    finder = simhash._Prefix(2)
    found = finder.links(base >> 56, 8, np.array(fps, np.uint64))
    a, b = simhash._forest(*(np.concatenate(x) for x in zip(*found)))
    groups = naive_groups(fps, 4)
    assert len(a) >= len(fps) - len(set(groups))


def test_texts(spark):
    texts = [None, "", " \t\n", "one", "ONE", "a b c", "a b c d e f g", "A  b\nc d e f g", "é É " * 40, "x " * 5000]
    rows = spark.createDataFrame(
        [(i, t, "z") for i, t in enumerate(texts)] + [(None, "one", None)], "doc_id long, text string, fp string"
    )
    got = {(r.doc_id, i): r for i, r in enumerate(simhash.near_duplicates(rows).collect())}
    by = {}
    for (doc, _), r in got.items():
        by[doc] = r
    for i, t in enumerate(texts):
        assert by[i].fp == signed(naive_print(t)), t
    assert [by[i].component for i in range(3)] == [0, 0, 0]
    assert by[3].component == by[4].component == by[None].component == 3
    assert by[6].component == by[7].component == 6
    assert len(got) == 11


def test_empty_table_and_repeated_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(none).count() == 0
    twice = spark.createDataFrame([(5, "p q r"), (5, "p q r"), (4, "p q r")], "doc_id long, text string")
    assert [r.component for r in simhash.near_duplicates(twice).collect()] == [4, 4, 4]


def test_one_document_of_each_group_stays(spark):
    rows = spark.createDataFrame(
        [(3, "a b c d e f", "k"), (7, "a b c d e f", "k"), (8, "other words here", "k"), (8, "other words here", "k"),
         (None, "only without a key", "k"), (None, "only without a key", "k"), (None, "a b c d e f", "k")],
        "doc_id long, text string, _fp string",
    ).withColumnRenamed("_fp", "fp")
    kept = simhash.without_near_duplicates(rows)
    assert sorted((r.doc_id or -1, r.text) for r in kept.collect()) == [
        (-1, "only without a key"), (3, "a b c d e f"), (8, "other words here")]
    assert kept.columns == rows.columns


def test_pairs_at_the_least_similarity_do_not_both_stay(spark):
    rng = random.Random(11)
    texts = []
    for _ in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(150)]
        texts.append(" ".join(words))
        for changed in (1, 2, 3, 4):  # about 0.93 down to 0.76
            other = list(words)
            for at in rng.sample(range(150), changed):
                other[at] = "changed"
            texts.append(" ".join(other))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [set(simhash.shingle_hashes(simhash.words_of(t), 5).tolist()) for t in texts]
    stay = []  # by all pairs: a row goes if a row before it stays and has 0.8 of its shingles
    for i, own in enumerate(sets):
        if all(len(own & sets[j]) < 0.8 * len(own | sets[j]) for j in stay):
            stay.append(i)
    got = sorted(r.doc_id for r in simhash.without_near_duplicates(docs).collect())
    assert 60 <= len(stay) < 240
    assert got == stay


def _sets(text):
    words = (text or "").encode().lower().split()
    return set(zip(*[words[i:] for i in range(5)])) if len(words) >= 5 else {tuple(words)} - {()}


def _greedy(rows):
    """One after the other in the order of keys: a row goes if it is like one before it that stays."""
    stay = []
    for key, text in rows:
        own = _sets(text)
        if not any(len(own & s) >= 0.8 * len(own | s) for _, s in stay):
            stay.append((key, own))
    return [k for k, _ in stay]


def test_one_loose_group_in_few_rounds(spark, monkeypatch):
    """5,000 texts with a common half are one group by its bands, though few of them are alike."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    common = [word() for _ in range(60)]
    rows = []
    for i in range(5_000):
        own = [word() for _ in range(18)]
        rows.append((i, " ".join(common + own)))
    rows += [(5_000 + i, rows[i * 7][1] + " end") for i in range(300)] + [(5_300, rows[3][1]), (5_301, rows[3][1])]
    rounds = []
    first = simhash._first
    monkeypatch.setattr(simhash, "_first", lambda *a, **k: rounds.append(1) or first(*a, **k))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # bands of two values join almost everything
    got = simhash.without_near_duplicates(df, bands=8, band_rows=2, part_rows=500)
    assert sorted(r.doc_id for r in got.collect()) == list(range(5_000))
    assert len(rounds) <= 5


def test_settled_like_one_by_one(spark):
    rng = random.Random(12)
    base = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(80)]
    rows = []
    for i in range(400):
        words = list(base)
        for at in rng.sample(range(80), rng.randrange(0, 9)):
            words[at] = "".join(rng.choices("abcdefgh", k=6))
        rows.append((i, " ".join(words)))
    rows += [(400, None), (401, ""), (402, ""), (403, "the " * 40_000), (403, "the " * 40_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, root string")
    for pivots in (5, 1_000):
        got = simhash.without_near_duplicates(df, bands=20, band_rows=1, pivots=pivots, part_rows=50)
        assert got.columns == ["doc_id", "text", "root"]
        assert sorted(r.doc_id for r in got.collect()) == _greedy(rows)
    small = simhash.without_near_duplicates(df, bands=20, band_rows=1, pivot_bytes=40_000)
    assert sorted(r.doc_id for r in small.collect()) == _greedy(rows)
