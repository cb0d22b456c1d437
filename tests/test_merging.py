"""Runs settled as sets against the same runs worked through one by one."""

import random

import pytest
from pyspark.sql import functions as F

from vacantia.operators import merging
from vacantia.operators.history import apply_merges

JOB = "id long, company_slug string, status string, merged_into_id long, next_attempt_after timestamp_ntz, current_attempt_id long, updated_at timestamp_ntz"
CONTENT = "id long, job_id long, requisition_id string, fingerprint string, title string"
ARRIVAL = "job_id long, requisition_id string, title string, fingerprint string, turn long"


class OneByOne:
    """Jobs {id: [company, status, into]} and contents [(id, job, requisition, fingerprint, title)]."""

    def __init__(self, jobs, contents):
        self.jobs = {j: [c, s, None] for j, c, s in jobs}
        self.contents = list(contents)

    def live(self, j):
        return self.jobs[j][1] != "merged"

    def title(self, j):
        own = [c for c in self.contents if c[1] == j]
        got = max(own)[4] if own else None
        return None if got is None else " ".join(got.split()).casefold()

    def others(self, j, at, key):
        return sorted({c[1] for c in self.contents if c[at] == key and c[1] != j and self.live(c[1]) and self.jobs[c[1]][0] == self.jobs[j][0]})

    def run(self, arrivals):
        merges, ours = [], {a[0] for a in arrivals}
        for j, req, title, print_, turn in sorted(arrivals, key=lambda a: a[4]):
            if not self.live(j):
                continue
            self.contents.append((max((c[0] for c in self.contents), default=0) + 1, j, req, print_, title))
            match = by = None
            if req is not None:
                found = self.others(j, 2, req)
                if len(found) == 1 and self.title(j) is not None and self.title(j) == self.title(found[0]):
                    match, by = found[0], "requisition"
            if match is None and print_ is not None:
                found = self.others(j, 3, print_)
                if len(found) == 1:
                    match, by = found[0], "fingerprint"
            if match is None or (match > j and self.jobs[match][1] == "in_progress" and match not in ours):
                continue
            low, high = min(j, match), max(j, match)
            self.jobs[high][1:] = ["merged", low]
            merges.append((high, low, by, turn))
        return sorted(merges)


def tables(spark, plain):
    jobs = spark.createDataFrame([(j, c, s, i, None, None, None) for j, (c, s, i) in plain.jobs.items()], JOB)
    return jobs, spark.createDataFrame(plain.contents, CONTENT)


def found(df):
    return sorted((r.job_id, r.canonical_id, r.matched_by, r.turn) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_two_runs_over_stored_contents(spark, seed):
    rng = random.Random(seed)
    many = 90
    jobs = [(j, rng.choice("ab"), rng.choice(["new", "new", "done", "in_progress"])) for j in range(1, many + 1)]
    draw = lambda: (rng.choice([None, *(f"r{i}" for i in range(14))]), rng.choice([f"p{i}" for i in range(30)]), rng.choice([None, "A Title", "a  title", "Other"]))
    contents = []
    for i in range(60):
        req, print_, title = draw()
        contents.append((i + 1, rng.randrange(1, many // 2), req, print_, title))
    plain = OneByOne(jobs, contents)
    index = None
    for _ in range(2):
        chosen = rng.sample(range(1, many + 1), 60)
        arrivals = []
        for turn, j in enumerate(chosen, 1):
            req, print_, title = draw()
            arrivals.append((j, req, title, print_, turn))
        given_jobs, given = tables(spark, plain)
        df = spark.createDataFrame(arrivals, ARRIVAL)
        if index is None:
            index = merging.key_index(given_jobs, given)
        got = merging.fold_run(given_jobs, given, df, index, width=7)
        merges = found(got)
        assert merges == plain.run(arrivals) and merges
        # the index after the run is the one that would be made anew
        index = merging.grown_index(index, given_jobs, df, got)
        after_jobs, after = tables(spark, plain)
        anew = merging.key_index(after_jobs, after)
        assert sorted(map(tuple, index.select(*merging.KEY, "job_id").collect())) == sorted(map(tuple, anew.collect()))
        applied = apply_merges(given_jobs, got, F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"))
        assert {r.id: (r.status, r.merged_into_id) for r in applied.collect()} == {j: (s, i) for j, (_, s, i) in plain.jobs.items()}


def test_hot_key_and_chains(spark):
    """A requisition that a third of all postings carry, and a chain in which each fate hangs on the one before."""
    jobs = [(j, "a", "new") for j in range(1, 25)]
    plain = OneByOne(jobs, [(1, 24, "hot", "q", "T")])
    arrivals = [(j, "hot" if j % 3 == 0 else f"c{j // 2}", "T", f"d{(j + 1) // 2}", j) for j in range(1, 25)]
    given_jobs, given = tables(spark, plain)
    merges = found(merging.fold_run(given_jobs, given, spark.createDataFrame(arrivals, ARRIVAL), width=10))
    assert merges == plain.run(arrivals)


def test_long_chain_of_one_key(spark, monkeypatch):
    """Each of 40 copies is folded by its turn; that is foretold, not found one a round."""
    jobs = [(j, "a", "new") for j in range(1, 101)]
    plain = OneByOne(jobs, [(1, 90, "r", "p", "T"), (2, 95, "x", "q", "T")])
    arrivals = [(j, "r" if j % 5 else "s", "T", "p", j) for j in range(1, 41)]
    arrivals += [(j, f"u{j}", "T", "q", 200 - j) for j in range(50, 81)]
    rounds, decided = [], merging._decided
    monkeypatch.setattr(merging, "_decided", lambda *a: rounds.append(1) or decided(*a))
    given_jobs, given = tables(spark, plain)
    merges = found(merging.fold_run(given_jobs, given, spark.createDataFrame(arrivals, ARRIVAL), width=10))
    assert merges == plain.run(arrivals) and len(merges) > 60
    assert len(rounds) <= 5


def test_nothing_arrives(spark):
    plain = OneByOne([(1, "a", "new")], [(1, 1, "r", "p", "t")])
    given_jobs, given = tables(spark, plain)
    none = spark.createDataFrame([], ARRIVAL)
    assert found(merging.fold_run(given_jobs, given, none)) == []
    # a job that is merged already has no turn; a first posting meets nobody
    plain.jobs[1][1:] = ["merged", 0]
    given_jobs, given = tables(spark, plain)
    assert found(merging.fold_run(given_jobs, given, spark.createDataFrame([(1, "r", "t", "p", 1)], ARRIVAL))) == []


def test_registered_query(spark):
    """The query's two runs over all documents, one by one."""
    from vacantia.workloads import QUERIES
    from vacantia.workloads.base import Tables
    from vacantia.workloads.document_jobs import document_jobs, run_arrivals

    folder = "/root/testdata/sf0.001"
    t = Tables(spark, folder)
    plain = OneByOne([(r.id, r.company_slug, r.status) for r in document_jobs(t).collect()], [])
    want = []
    for run, arrivals in enumerate(run_arrivals(t), 1):
        rows = [(r.job_id, r.requisition_id, r.title, r.fingerprint, r.turn) for r in arrivals.collect()]
        want += [(*m[:3], run) for m in plain.run(rows)]
    got = [(r.job_id, r.canonical_id, r.matched_by, r.run) for r in QUERIES["merges_of_two_runs"](spark, folder).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and want


def test_chain_that_loses_its_first(spark, monkeypatch):
    """30 copies whose first holder is folded by its requisition: the second stays, the others are folded into it."""
    jobs = [(j, "a", "new") for j in range(1, 101)]
    plain = OneByOne(jobs, [])
    arrivals = [(1, "r", "T", "p", 1), (2, "r", "T", "q", 2), (3, "r", "U", "s", 3)]
    arrivals += [(j, f"u{j}", "T", "q", j) for j in range(4, 34)]
    rounds, decided = [], merging._decided
    monkeypatch.setattr(merging, "_decided", lambda *a: rounds.append(1) or decided(*a))
    given_jobs, given = tables(spark, plain)
    merges = found(merging.fold_run(given_jobs, given, spark.createDataFrame(arrivals, ARRIVAL), width=10))
    assert merges == plain.run(arrivals) and len(merges) == 30
    assert len(rounds) <= 4


def test_rounds_release_their_plans(spark, monkeypatch):
    """The driver keeps no plans of earlier rounds: proxies of their JVM objects go with each round."""
    import gc

    from py4j.java_gateway import JavaObject

    jobs = [(j, "a", "new") for j in range(1, 9)]
    plain = OneByOne(jobs, [])
    # A chain across keys takes a round for each link.
    arrivals = [(j, f"c{j // 2}", "T", f"d{(j + 1) // 2}", j) for j in range(1, 9)]
    kept, decided = [], merging._decided

    def counted(*a):
        gc.disable()
        kept.append(sum(isinstance(o, JavaObject) for o in gc.get_objects()))
        return decided(*a)

    monkeypatch.setattr(merging, "_decided", counted)
    given_jobs, given = tables(spark, plain)
    try:
        merges = found(merging.fold_run(given_jobs, given, spark.createDataFrame(arrivals, ARRIVAL), width=10))
    finally:
        gc.enable()
    assert merges == plain.run(arrivals)
    assert len(kept) > 3 and kept[-1] <= kept[2] + 20
