"""Secret scans: base spans against plain patterns, random strings found, ordinary ones left alone."""

import random
import re

import numpy as np
import pytest

from vacantia.llm import secrets

PLAIN = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
)


def brute(text):
    spans = []
    for order, (kind, pattern, group, least) in enumerate(PLAIN):
        for m in pattern.finditer(text or ""):
            if len(m[group]) >= least:
                spans.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for *_, s in sorted(spans))


def test_base_same_as_plain_patterns(spark):
    rng = random.Random(1)
    parts = ["password", "PassWD", "toKen", "api_key", "APIKEY", "ſecret", "secret", '"', "'", " ", "  ", ":", "=", "a1b2c3d4e5f6", "0123456789abcdef",
             "AKIA", "ABCDEFGH", "IJKLMNOP12", "é", "漢", "🙂", "x", ".", "-", "\n", "toKen", "\x00"]
    docs = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(60)))) for i in range(600)]
    docs += [(700, None), (701, ""), (702, "é" * 70_000 + ' token="' + "ab12" * 50_000), docs[5], docs[5], (None, "token=abcdef")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, spans int")
    got = secrets.scanned(df)
    assert got.columns == ["doc_id", "spans", "base", "spans_text", "base_text"]
    rows = got.collect()
    assert len(rows) == len(docs)
    want = sorted((str(k), brute(t)) for k, t in docs)
    assert sorted((str(r.doc_id), r.base_text) for r in rows) == want
    for r in rows:  # base spans stay among all spans
        assert [tuple(s) for s in r.base] == [tuple(s) for s in r.spans if s.kind < 3]
        assert [(s.start, s.kind) for s in r.spans] == sorted((s.start, s.kind) for s in r.spans)


def word(rng, n):
    return "".join(rng.choices("etaoinshrdlucmfw", [12, 9, 8, 8, 7, 7, 6, 6, 6, 4, 4, 3, 3, 2, 2, 2], k=n))


def test_random_strings_found_ordinary_left(spark):
    rng = random.Random(2)
    made, docs = {}, []
    names = [secrets.ALPHABETS[i] for i in (2, 3, 4, 6, 7, 8)]
    for i in range(600):
        ordinary = " ".join(word(rng, rng.choice([3, 5, 9, 24])) for _ in range(40))
        ordinary += " " + rng.choice(["INTERNATIONALISATIONOFTHINGS", "camelCaseNamesAreLongSometimes", "some/path/to/another/place/here", "abcdefghijklmnopqrstuvwxyz0123456789",
                                      "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "4111111111111111111111", "snake_case_names_are_long_too", "ABABABABABABABABABABABABAB"])
        if i % 10 == 0:
            key = "".join(rng.choices(names[i // 10 % len(names)], k=40 + i % 3 * 12))
            made[i] = (len("é " + ordinary + " <"), key)
            ordinary += f" <{key}> {word(rng, 7)}"
        docs.append((i, "é " + ordinary if i in made else ordinary))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.doc_id: [s for s in r.spans if s.kind == 3] for r in secrets.scanned(df).collect()}
    right = {i for i, (start, key) in made.items() if any((s.start, s.end) == (start, start + len(key)) for s in found[i])}
    assert len(right) >= 0.95 * len(made)
    wrong = sum(len(found[i]) for i in found if i not in made)
    assert wrong <= 0.05 * len(made)


def test_battery_level_and_power():
    rng = np.random.default_rng(3)
    for kind in range(1, len(secrets.ALPHABETS)):
        alphabet = np.frombuffer(secrets.ALPHABETS[kind].encode(), np.uint8)
        for n in (20, 64, 400):
            data = rng.choice(alphabet, 500 * n)
            starts = np.arange(500) * n
            p, _ = secrets.battery(data, starts, starts + n, np.full(500, kind), np.zeros((len(secrets.ALPHABETS), 256)))
            assert (p < 0.01).mean() < 0.03, (kind, n)
        # a sequence in order, and one that goes up and down: even counts, but neighbours depend on each other
        half = np.concatenate([alphabet, alphabet[::-1]] * 4)
        zigzag = np.column_stack([alphabet[: len(alphabet) // 2], alphabet[::-1][: len(alphabet) // 2]]).ravel()
        for data in (half, np.tile(zigzag, 4)):
            p, _ = secrets.battery(data, np.array([0]), np.array([len(data)]), np.array([kind]), np.zeros((len(secrets.ALPHABETS), 256)))
            assert p[0] < 0.001


def test_pieces_change_nothing(monkeypatch):
    rng = np.random.default_rng(5)
    data = rng.choice(np.frombuffer(secrets.ALPHABETS[6].encode(), np.uint8), 50_000)
    starts, ends = np.array([0, 30, 400, 49_000]), np.array([25, 390, 48_000, 50_000])
    logs = secrets.evidence(np.arange(256))
    want = secrets.battery(data, starts, ends, np.full(4, 6), logs)
    monkeypatch.setattr(secrets, "CHUNK", 97)
    got = secrets.battery(data, starts, ends, np.full(4, 6), logs)
    assert all(np.allclose(a, b) for a, b in zip(want, got))


def test_candidates():
    text = b"A" * 20 + b" " + b"b" * 19 + b" " + b"c-d" * 7 + b" " + b"e+" * 10 + b"-" + b"f" * 21 + b"/" + b"g" * 5
    starts, ends, kinds = secrets.candidates(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert [text[a:b] for a, b in zip(starts, ends)] == [b"A" * 20, b"c-d" * 7, b"f" * 21]
    assert [secrets.ALPHABETS[k][-1] for k in kinds] == ["F", "_", "f"]


def test_discoveries_bounded(spark):
    """The step-up rule on a small table, against the definition."""
    rng = random.Random(6)
    rows = [(rng.choice([8, 9]), rng.choice([-1, -1, -1, 5, 30, 60, 80, 100])) for _ in range(400)]
    df = spark.createDataFrame([([(0, 1, n, e)],) for n, e in rows], "runs array<struct<start:long,end:long,length:int,e:int>>")
    want = {}
    for length in (8, 9):
        own = sorted((e for n, e in rows if n == length), reverse=True)
        fits = [e for i, e in enumerate(own, 1) if e >= 0 and e / secrets.STEPS >= np.log(len(own) / (0.01 * own.count(e) + 0.01 * sum(x > e for x in own)))]
        if fits:
            want[length] = min(fits)
    assert secrets.thresholds(df, 0.01) == want and want


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "no secrets here"), (1, "no secrets here")]])
def test_nothing_to_find(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [(r.spans, r.base_text) for r in secrets.scanned(df).collect()] == [([], "")] * len(rows)
