"""Centroid clustering against plain integers in Python; the filter's bound holds."""

import hashlib
import math

import numpy as np
import pytest

from vacantia.llm import centroids


def brute(rows, number, rounds, seed, width, scale=256):
    kept = []
    for key, v in rows:
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v):
            kept.append((key, [math.floor(scale * x) for x in v]))
    name = lambda k: hashlib.sha256(f"{seed}:{'' if k is None else k}".encode()).hexdigest()
    start = [v for _, v in sorted(kept, key=lambda r: (name(r[0]), r[1]))[:number]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    near = lambda v: min((far(v, c), i) for i, c in enumerate(start))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for i, own in groups.items():
            start[i] = [sum(x) // len(own) for x in zip(*own)]
    found = [(key, *near(v)) for key, v in kept]
    inertia = {}
    for _, d, i in found:
        inertia[i] = inertia.get(i, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in start]
    return sorted(((k, i, d, inertia[i], sum(inertia.values()), sha[i]) for k, d, i in found), key=str)


def found(df, **kw):
    got = centroids.clustered(df, **kw).drop("compared")
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=str)


@pytest.mark.parametrize("leading", [1, 3, 6, 16])
def test_same_as_brute_force(spark, leading):
    rng = np.random.default_rng(leading)
    centres = rng.standard_normal((7, 6))
    rows = [(i, (centres[i % 7] + 0.2 * rng.standard_normal(6)).tolist()) for i in range(300)]
    rows += [(i, centres[0].tolist()) for i in range(400, 500)]  # a hot group of equal vectors
    rows += [rows[5], rows[5], (None, [0.0] * 6), (900, [-0.001] * 6), (901, [300.25, -300.25] * 3)]
    rows += [(902, None), (903, []), (904, [1.0] * 5), (905, [None] * 6), (906, [float("nan")] * 6), (907, [float("inf")] + [0.0] * 5)]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "vec_id long, embedding array<double>, cluster string, key int")
    kw = dict(components=6, number=12, rounds=4, seed=3)
    assert found(df, **kw, leading=leading) == brute(rows, 12, 4, 3, 6)


def test_ties_small_and_empty(spark):
    rows = [(i, [float(x), 0.0]) for i, x in enumerate([0, 2, 1, 1, 1, 5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert found(df, components=2, number=3, rounds=2, leading=1) == brute(rows, 3, 2, 2, 2)
    assert found(df, components=2, number=40, rounds=5) == brute(rows, 40, 5, 2, 2)  # fewer rows than centroids
    assert found(df, components=3) == []
    assert found(df.filter("false"), components=2) == []


def test_too_large_component_is_named(spark):
    df = spark.createDataFrame([(1, [1e9, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="leave 64 bits"):
        found(df, components=2)


def test_filter_loses_no_nearest_centroid():
    rng = np.random.default_rng(4)
    for size in (1, 1000, centroids.LARGEST - 1):
        ints = rng.integers(-size, size + 1, (500, 8))
        places = ints[:40].copy()
        places[20] = places[10]  # equal centroids: the smaller number
        axes = np.linalg.qr(rng.standard_normal((8, 8)))[0]
        turned = ints @ axes
        near, far, compared = centroids.Filter(places, axes, 3).nearest(ints, turned[:, :3], np.sqrt((turned[:, 3:] ** 2).sum(axis=1)))
        want = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(places)) for v in ints]
        assert list(zip(far.tolist(), near.tolist())) == want
        assert compared.min() >= 1


def test_filter_prunes(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = centroids.clustered(df).collect()
    assert sum(r.compared for r in rows) < 0.5 * 40 * len(rows)
