"""Shards: exact sizes, gapless slots, groups kept together."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

from vacantia.llm import shards


def place(spark, rows, number):
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    out = shards.sharded(docs, shards=number).collect()
    assert len(out) == len(rows)
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[s]) for s in range(number)]
    assert sum(sizes) == len(rows) and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == Counter(
        (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, _ in rows)
    by = {d: t for d, t, _ in rows}
    spread = defaultdict(Counter)
    for r in out:
        spread[by[r.doc_id]][r.shard] += 1
    return spread


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_stay_together(spark, seed):
    rng = random.Random(seed)
    texts = [f"alone {i}" for i in range(400)]
    for g in range(60):
        texts += [f"group {g} é"] * rng.randrange(2, 12)
    texts += ["hot"] * 300
    rng.shuffle(texts)
    spread = place(spark, [(i, t, "x") for i, t in enumerate(texts)], 8)
    cut = [t for t, c in spread.items() if t.startswith("group") and len(c) > 1]
    assert len(cut) <= 10  # nearly all would be cut at random
    assert len(spread["hot"]) >= -(-300 // (1 + len(texts) // 8))


def test_only_groups(spark):
    spread = place(spark, [(i, f"pair {i // 2}", "x") for i in range(402)], 4)
    assert sum(len(c) > 1 for c in spread.values()) <= 60  # about 150 would be cut at random


def test_edges(spark):
    place(spark, [(i, None, None) for i in range(7)], 3)
    place(spark, [(1, "same", None)] * 9 + [(None, "same", None), (2, "", None), (3, "z" * 100_000, None)], 5)
    place(spark, [(5, "one", None)], 40)
    none = spark.createDataFrame([], "doc_id long, text string")
    assert shards.sharded(none).count() == 0
