"""Each pipeline stage against a plain version over the same input."""

from collections import defaultdict

import pytest

import corpus_pipeline
from vacantia.llm import decontam
from vacantia.llm.common import stored
from test_linededup import brute as brute_lines
from test_simhash import naive_groups, naive_print

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = [(900_001, None, "en", "x", 0), (900_002, "12 --", None, "x", 5), (None, "The of and to in the is", None, None, None)]
    out = [docs.unionByName(spark.createDataFrame(extra, docs.schema))]
    for _, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], FOLDER)))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_order_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "piece_encoding"]
    for step in steps[:-1]:
        assert step.columns == list(corpus_pipeline.COLUMNS)


def test_language_rejects_only_texts_without_one(steps):
    before, after = texts(steps[0]), texts(steps[1])
    assert set(before) - set(after) == {900_001, 900_002}


def test_lines(steps):
    want = {d: kept for d, _, _, kept in brute_lines([(d or 0, t) for d, t in texts(steps[1]).items() if d is not None], 40, 5)}
    after = texts(steps[2])
    for doc, kept in want.items():
        assert after.get(doc, "").strip() == kept.strip()
    assert all(r.n_chars == len(r.text) for r in steps[2].collect())


def shingles(text):
    words = (text or "").encode().lower().split()
    return set(zip(*[words[i:] for i in range(5)])) if len(words) >= 5 else {tuple(words)}


def alike(one, two):
    a, b = shingles(one), shingles(two)
    return len(a & b) / len(a | b)


def test_one_of_each_group(steps):
    before, after = texts(steps[2]), texts(steps[3])
    keys = sorted(k for k in before if k is not None)
    kept = [k for k in keys if k in after]
    for key in set(keys) - set(kept):  # what goes has a copy that stays
        assert max(alike(before[key], after[k]) for k in kept if k < key) >= 0.8
    groups = defaultdict(list)
    for key, root in zip(keys, naive_groups([naive_print(before[k], 5) for k in keys], 4)):
        groups[root].append(key)
    for members in groups.values():  # copies within the radius do not both stay
        here = [m for m in members if m in after]
        assert all(alike(before[a], before[b]) < 0.8 for a in here for b in here if a < b)


def test_benchmark(spark, steps):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    index = decontam.Index(items, 5, 0.8, 24)
    before, after = texts(steps[3]), texts(steps[4])
    assert set(before) - set(after) == {k for k, t in before.items() if index.search(t)}


def test_encoding(steps):
    rows = steps[5].collect()
    assert {r.doc_id for r in rows} == set(texts(steps[4])) and all(r.lossless for r in rows)


def test_empty_table_repeated_rows_and_clashing_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    none = docs.filter("false")
    few = docs.orderBy("doc_id").limit(30)
    twice = few.unionByName(few).selectExpr("*", "1 as h", "text as kept_text", "doc_id as __id0", "'x' as p")
    for _, stage in corpus_pipeline.STAGES:
        none = stored(stage(spark, none, FOLDER))
        few, twice = stored(stage(spark, few, FOLDER)), stored(stage(spark, twice, FOLDER))
    assert none.count() == 0 and none.columns == few.columns
    # near-dedup leaves one of each repeated row: the same documents as without repeats
    assert {r.doc_id for r in twice.collect()} <= {r.doc_id for r in few.collect()}
    assert twice.count() == twice.select("doc_id").distinct().count()
