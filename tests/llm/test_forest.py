"""Forest links against all pairs; every leaf size, dense groups, unusable vectors."""

from collections import Counter

import numpy as np
import pytest

from vacantia.llm import forest


def clusters(seed, number, dim=32):
    rng = np.random.default_rng(seed)
    out = []
    while len(out) < number:
        centre = rng.standard_normal(dim)
        for _ in range(rng.integers(1, 6)):
            out.append(centre + rng.standard_normal(dim) * rng.choice([0.0, 0.05, 0.1, 0.2]))
    return np.array(out[:number])


def brute(ids, labels, x, least):
    x = x / np.linalg.norm(x, axis=1)[:, None]
    close = (x @ x.T >= least) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(close, False)
    root = np.arange(len(x))
    while True:
        low = np.array([min([root[i], *root[close[i]]]) for i in range(len(x))])
        if (low == root).all():
            break
        root = low
    return {i: (int(close[k].sum()), int(ids[root[k]])) for k, i in enumerate(ids.tolist())}


@pytest.mark.parametrize("leaf", [1500, 40])
def test_same_as_all_pairs(spark, monkeypatch, leaf):
    monkeypatch.setattr(forest, "LEAF", leaf)
    x = clusters(leaf, 900)
    x[100:160] = x[100]
    labels = np.arange(900) // 3 % 2
    ids = np.arange(900) * 2 + 5
    rows = spark.createDataFrame([(int(i), v.tolist(), int(g)) for i, v, g in zip(ids, x, labels)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component) for r in forest.linked(rows, trees=6).collect()}
    want = brute(ids, labels, x, 0.98)
    wrong = [i for i in want if got[i] != want[i]]
    assert len(got) == 900 and sum(w[0] for w in want.values()) > 300
    assert not wrong


def test_large_leaf_is_split_in_its_task(monkeypatch):
    monkeypatch.setattr(forest, "LEAF", 30)
    x = clusters(3, 600)
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids = np.arange(600)
    counts, edges = forest.Leaf(0.98, 0.03, 6).links(7, ids, np.ones(600, int), np.full((600, 1), 7), x)
    want = brute(ids, np.zeros(600), x, 0.98)
    assert counts.tolist() == [want[i][0] for i in range(600)]


def test_dense_group_leaves_few_edges():
    rng = np.random.default_rng(1)
    x = rng.standard_normal(16) + rng.standard_normal((2000, 16)) * 1e-3
    x /= np.linalg.norm(x, axis=1)[:, None]
    counts, edges = forest.Leaf(0.98, 0.03, 2).links(1, np.arange(2000), np.ones(2000, int), np.full((2000, 1), 1), x)
    assert (counts == 1999).all()
    assert len({i for a, b in edges for i in a.tolist()}) == 1999


def test_unusable_vectors(spark):
    nan, inf = float("nan"), float("inf")
    one, two = [1.0, 0.0], [1.0, 0.01]
    rows = [(1, one, 3), (2, two, 3), (2, two, 3), (3, None, 3), (4, [0.0, 0.0], 3), (5, [nan, 1.0], 3), (6, [1.0, inf], 3),
            (7, [None, 1.0], 3), (8, one, None), (9, one, 4), (10, [], 3), (11, [1.0, 0.0, 0.0], 3), (None, one, 3), (12, [2.0, 0.0], 3)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, grp string")
    got = sorted(((r.vec_id or 0, r.n_links, r.component) for r in forest.linked(table).collect()))
    assert got == sorted([(1, 4, 1), (2, 4, 1), (2, 4, 1), (0, 4, 1), (12, 4, 1)] + [(i, 0, i) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)])
    assert forest.linked(table.filter("false")).count() == 0


def test_hot_label_late_in_order_is_split_before_the_tasks(spark, monkeypatch):
    """Labels below the bound come first by name and by rows; no task sees a leaf above the bound."""
    monkeypatch.setattr(forest, "LEAF", 40)
    monkeypatch.setattr(forest, "LEAF_SAMPLE", 32)
    x = clusters(9, 1800)
    labels = np.array([f"a{i // 30:02}" if i < 900 else "z" for i in range(1800)])
    ids = np.arange(1800)
    table = spark.createDataFrame([(int(i), v.tolist(), str(g)) for i, v, g in zip(ids, x, labels)], "vec_id long, embedding array<double>, label string")
    seen = spark.sparkContext.accumulator(0)
    comparer = forest._comparer

    def counting(*args):
        inner = comparer(*args)

        def apply(batches):
            def passed():
                for batch in batches:
                    names = Counter(zip(batch.column("grp").to_pylist(), batch.column("leaf").to_pylist()))
                    seen.add(sum(n > 4 * 40 for n in names.values()))
                    yield batch

            yield from inner(passed())

        return apply

    monkeypatch.setattr(forest, "_comparer", counting)
    got = {r.vec_id: (r.n_links, r.component) for r in forest.linked(table, trees=6, max_sample=60).collect()}
    assert got == brute(ids, labels, x, 0.98)
    assert seen.value == 0


def test_very_large_and_small_components(spark):
    rows = [(1, [1e200, 1e199]), (2, [2e200, 2e199]), (3, [1e-200, 1e-205]), (4, [1e-205, 1e-200]), (5, [3e-320, 0.0]), (6, [1e308, 0.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component) for r in forest.linked(df).collect()}
    # 1 and 2 point the same way; 3, 5 and 6 lie on the first axis, and near 1 and 2 (cosine 0.995)
    assert got == {1: (4, 1), 2: (4, 1), 3: (4, 1), 4: (0, 4), 5: (4, 1), 6: (4, 1)}
