"""Line dedup against a plain count over all lines."""

import random
from collections import defaultdict

import pytest

from vacantia.llm import linededup

SPACE = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows, chars, docs):
    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= chars:
                holders[key_of(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        keep = [x for x in lines if len(holders[key_of(x)]) < docs or max(holders[key_of(x)]) == doc]
        out.append((doc, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out)


@pytest.mark.parametrize("batches,fanout", [(1, 2), (4, 2), (7, 3)])
def test_same_as_plain_count(spark, batches, fanout):
    rng = random.Random(batches)
    pool = [f"{'Éa' if i % 3 else 'Ab'}line {i} " + "x" * (i % 7) for i in range(20)]
    rows = []
    for doc in range(60):
        lines = []
        for _ in range(rng.randrange(0, 8)):
            x = rng.choice(pool)
            lines.append(rng.choice([x, x.upper(), f"  {x}\t", x + "\r"]))
        rows.append((doc, "\n".join(lines)))
    rows += [(61, None), (62, ""), (63, "\n\n"), (64, "\n".join(pool * 400))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = linededup.dedup_lines(table, min_chars=9, min_docs=4, batches=batches, fanout=fanout)
    found = sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got.collect())
    assert found == brute(rows, 9, 4)


def test_null_keys_repeats_and_names(spark):
    line = "a line that is long enough to be counted here"
    rows = [(None, line, "x"), (None, line, "x"), (5, line, "y"), (5, line, "y"), (6, line + "\nz", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, h string")
    got = linededup.dedup_lines(table, min_docs=3)
    assert got.columns == ["doc_id", "text", "h", "kept_text", "n_lines", "n_dropped"]
    assert sorted((r.doc_id or 0, r.kept_text, r.n_dropped) for r in got.collect()) == [
        (0, "", 1), (0, "", 1), (5, "", 1), (5, "", 1), (6, line + "\nz", 0)]
    assert linededup.dedup_lines(table.filter("false")).count() == 0
