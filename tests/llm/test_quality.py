"""Bradley-Terry quality: ranking, held-out accuracy, texts without features."""

import zlib

import numpy as np

from vacantia.llm import quality
from vacantia.llm.workloads import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_weights_rank_good_over_bad():
    rng = np.random.default_rng(1)
    good, bad = rng.standard_normal((300, 5)) + [1, 0, 0, -1, 0], rng.standard_normal((200, 5))
    w = quality.bradley_terry(good, bad, 5000, 200, 1e-3, 1)
    assert w[0] > 0.3 and w[3] < -0.3 and np.abs(w[[1, 2, 4]]).max() < 0.2
    # the mean loss of all pairs is lower than without weights and about as low as it gets
    loss = lambda v: np.logaddexp(0, -((good @ v)[:, None] - (bad @ v)[None, :])).mean()
    assert loss(w) < loss(np.zeros(5)) and loss(w) < loss(0.7 * w) and loss(w) < loss(1.5 * w)


def test_held_out_accuracy(spark):
    rows = QUERIES["op1_bradley_terry_quality"](spark, FOLDER).collect()
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    assert len(rows) == docs
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.score, r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(p == y for _, p, y in held) >= 0.95 * len(held)
    good = [s for s, _, y in held if y == 1]
    bad = [s for s, _, y in held if y == 0]
    assert np.mean([g > b for g in good for b in bad]) >= 0.98


def test_odd_rows(spark):
    rows = [(1, "Some words here. More of them."), (2, "$$$ !!! |||"), (3, None), (4, ""), (None, "x"), (2, "$$$ !!! |||"), (5, "A b " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'q' AS quality")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (9, 1), (None, 1), (3, None), (4, 7)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = docs.select("doc_id", quality.scored(model, docs).alias("s")).collect()
    assert len(got) == 7 and all(0 <= r.s <= 1 for r in got)
    by = {r.doc_id: r.s for r in got}
    assert by[1] > by[2] and by[3] == by[4]
    none = quality.fit(docs, labels.filter("quality = 1"))
    assert len(set(none.scores(["a", "b", None]))) == 1
    assert docs.filter("false").select(quality.scored(model, docs)).count() == 0
