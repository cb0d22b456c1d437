"""State transitions over literal history tables and streams."""

from pyspark.sql import functions as F

from vacantia.operators import content, history, scoring
from vacantia.schemas import JOB_ATTEMPTS, JOB_CONTENTS, JOB_DECISIONS, JOB_RESULTS, JOBS

T0, T1 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"


def table(spark, schema, *rows):
    """Rows given by name; missing columns get a default of their type."""
    defaults = {"bigint": 0, "string": "", "boolean": False, "timestamp_ntz": None}
    names = schema.names
    raw = [tuple(r.get(f.name, None if f.nullable else defaults.get(f.dataType.simpleString())) for f in schema.fields) for r in rows]
    loose = ", ".join(f"{f.name} {f.dataType.simpleString() if f.dataType.simpleString() != 'timestamp_ntz' else 'string'}" for f in schema.fields)
    return spark.createDataFrame(raw, loose).select(*[F.col(n).cast(schema[n].dataType).alias(n) for n in names])


def jobs_of(spark, *rows):
    base = {"company_slug": "c", "next_phase": "eligibility", "first_seen_at": T0, "last_seen_at": T0, "updated_at": T0}
    return table(spark, JOBS, *[{**base, "url_key": f"k{r['id']}", **r} for r in rows])


def test_decisions_and_results(spark):
    jobs = jobs_of(
        spark,
        {"id": 1, "status": "in_progress", "attempt_count": 2, "current_attempt_id": 11, "current_content_id": 21},
        {"id": 2, "status": "in_progress", "attempt_count": 2, "current_attempt_id": 12, "current_content_id": 22},
        {"id": 3, "status": "in_progress", "attempt_count": 1, "current_attempt_id": 99, "current_content_id": 23},
    )
    attempts = table(spark, JOB_ATTEMPTS, *[{"id": 10 + i, "job_id": i, "run_id": "r", "trigger": "scheduled", "model": "m", "started_at": T0} for i in (1, 2, 3)])
    old = table(spark, JOB_DECISIONS, {"id": 5, "job_id": 1, "attempt_id": 1, "content_id": 21, "decision": "unknown", "is_current": True, "decided_at": T0})
    accepted = spark.createDataFrame(
        [(1, 11, 21, "eligible"), (2, 12, 22, "ineligible"), (3, 13, 23, "eligible")], "job_id long, attempt_id long, content_id long, decision string"
    ).selectExpr(
        "*", "'R.' reason", "'[]' supporting_evidence_json", "'[]' conflicting_evidence_json", "'h' prompt_hash",
        f"cast('{T1}' as timestamp_ntz) decided_at", "cast(7 as long) prompt_tokens", "cast(8 as long) completion_tokens",
    )
    new_jobs, new_attempts, decisions = history.accept_decisions(jobs, attempts, old, accepted, T1)
    got = {r["id"]: (r["status"], r["next_phase"], r["attempt_count"], r["current_attempt_id"]) for r in new_jobs.collect()}
    assert got == {1: ("ready_for_extraction", "extraction", 0, None), 2: ("completed_ineligible", "eligibility", 2, None), 3: ("in_progress", "eligibility", 1, 99)}
    assert {(r["job_id"], r["decision"], r["is_current"]) for r in decisions.collect()} == {(1, "unknown", False), (1, "eligible", True), (2, "ineligible", True)}
    assert {r["id"]: r["outcome"] for r in new_attempts.collect()} == {11: "ready_for_extraction", 12: "completed_ineligible", 13: None}

    held = jobs_of(spark, {"id": 1, "status": "in_progress", "next_phase": "extraction", "current_attempt_id": 11, "current_content_id": 21})
    results = table(spark, JOB_RESULTS, {"id": 1, "job_id": 1, "attempt_id": 1, "content_id": 21, "schema_version": 1, "is_current": True, "accepted_at": T0})
    rows = spark.createDataFrame([(1, 11, 21, 1, "{}")], "job_id long, attempt_id long, content_id long, schema_version long, result_json string").selectExpr(
        "*", f"cast('{T1}' as timestamp_ntz) accepted_at", "cast(1 as long) prompt_tokens", "cast(2 as long) completion_tokens"
    )
    done, ended, kept = history.accept_results(held, attempts, results, rows, T1)
    assert done.first()["status"] == "completed_eligible"
    assert {(r["attempt_id"], r["is_current"]) for r in kept.collect()} == {(1, False), (11, True)}
    assert {r["id"]: r["completion_tokens"] for r in ended.collect()}[11] == 2


def test_content_pointer(spark):
    jobs = jobs_of(spark, {"id": 1, "status": "in_progress", "current_attempt_id": 11}, {"id": 2, "status": "in_progress", "current_attempt_id": 12})
    stored = table(spark, JOB_CONTENTS, {"id": 7, "job_id": 1, "content_hash": "a", "retrieved_at": T0})
    acquired = spark.createDataFrame([(1, 11, "a"), (2, 99, "b")], "job_id long, attempt_id long, content_hash string").withColumn("retrieved_at", F.lit(T1).cast("timestamp_ntz"))
    fresh = content.append_contents(stored, acquired)
    assert [(r["id"], r["job_id"], r["content_hash"]) for r in fresh.collect()] == [(8, 2, "b")]
    every = stored.select("id", "job_id", "content_hash").unionByName(fresh.select("id", "job_id", "content_hash"))
    pointed = {r["id"]: r["current_content_id"] for r in content.point_at_content(jobs, every, acquired).collect()}
    assert pointed == {1: 7, 2: None}


def test_evidence_agreement(spark):
    calls = spark.createDataFrame(
        [("a", 1, "grounded", False, False, False), ("a", 2, "grounded", False, False, False), ("m", 1, "grounded", True, True, False), ("p", 1, "grounded", False, False, True), ("u", 1, "ungrounded", False, False, False)],
        "case_id string, replay int, status string, missing_information boolean, case_missing boolean, has_pairs boolean",
    )
    obligations = spark.createDataFrame([("a", "E1"), ("a", "E2"), ("p", "E1")], "case_id string, obligation_id string")
    met = spark.createDataFrame([("a", 1, "E1"), ("a", 1, "E2"), ("a", 2, "E1"), ("p", 1, "E1")], "case_id string, replay int, obligation_id string")
    split = spark.createDataFrame([("p", 1, False)], "case_id string, replay int, pairs_satisfied boolean")
    got = {(r["case_id"], r["replay"]): r["evidence_agreement"] for r in scoring.evidence_agreement(calls, obligations, met, split).collect()}
    assert got == {("a", 1): True, ("a", 2): False, ("m", 1): True, ("p", 1): False, ("u", 1): False}


def test_stream_batches_resume(spark, tmp_path):
    from vacantia.streaming.observe import VersionedState, fold_batches

    folder, state, marks = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "marks")

    def add(name, *rows):
        spark.createDataFrame([(c, u, s) for c, u, s in rows], "company_slug string, url string, seen_at string").select(
            "company_slug", "url", F.to_timestamp("seen_at").alias("seen_at")
        ).coalesce(1).write.parquet(str(folder / name))

    def run():
        stream = spark.readStream.schema("company_slug string, url string, seen_at timestamp").parquet(f"{folder}/*")
        fold_batches(stream, state, marks, trigger={"availableNow": True}).awaitTermination()
        jobs, sources = VersionedState(spark, state).read()
        return {r["url_key"]: (str(r["first_seen_at"])[:10], str(r["last_seen_at"])[:10]) for r in jobs.collect()}, sources.count()

    add("one", ("c", "https://b.io/1", "2024-01-01 00:00:00"), ("c", "https://b.io/1#x", "2024-01-01 00:00:00"))
    assert run() == ({"https://b.io/1": ("2024-01-01", "2024-01-01")}, 2)
    add("two", ("c", "https://b.io/1", "2024-01-03 00:00:00"), ("c", "https://b.io/2", "2024-01-03 00:00:00"))
    want = ({"https://b.io/1": ("2024-01-01", "2024-01-03"), "https://b.io/2": ("2024-01-03", "2024-01-03")}, 3)
    assert run() == want
    assert run() == want
    # Late, repeated and unordered sightings all count; older versions go.
    add("three", ("c", "https://b.io/9", "2023-11-01 00:00:00"), ("c", "https://b.io/1", "2023-12-01 00:00:00"))
    add("four", ("d", "https://d.io/1", "2024-01-02 00:00:00"), ("c", "https://b.io/2", "2024-01-03 00:00:00"))
    keys, sources = run()
    assert keys["https://b.io/9"] == ("2023-11-01", "2023-11-01") and keys["https://b.io/1"] == ("2023-12-01", "2024-01-03")
    assert keys["https://d.io/1"] == ("2024-01-02", "2024-01-02") and sources == 5 and len(keys) == 4
    versions = VersionedState(spark, state).versions()
    assert len(versions) == 2
    jobs, rows = VersionedState(spark, state).read()
    assert jobs.select("id").distinct().count() == 4 and rows.select("id").distinct().count() == 5


def test_state_buckets_split_as_they_grow(spark, tmp_path):
    from vacantia.streaming.observe import VersionedState, fold_batches

    folder, state, marks = tmp_path / "in", str(tmp_path / "state"), str(tmp_path / "marks")

    def fold(name, companies, day):
        rows = [(f"c{c}", f"https://b.io/{c}/{k}", f"2024-01-{day:02d} 00:00:00") for c in companies for k in range(3)]
        spark.createDataFrame(rows, "company_slug string, url string, seen_at string").withColumn(
            "seen_at", F.to_timestamp("seen_at")
        ).coalesce(1).write.parquet(str(folder / name))
        stream = spark.readStream.schema("company_slug string, url string, seen_at timestamp").parquet(f"{folder}/*")
        fold_batches(stream, state, marks, trigger={"availableNow": True}, bucket_jobs=30).awaitTermination()
        return VersionedState(spark, state)

    def check(kept, companies, last):
        """Every company in the one bucket that covers it, no bucket covered by another."""
        jobs, sources = kept.read()
        got = {(r["company_slug"], r["url_key"]): r["last_seen_at"].day for r in jobs.collect()}
        assert got == {(f"c{c}", f"https://b.io/{c}/{k}"): last(c) for c in range(companies) for k in range(3)}
        assert sources.count() == len(got) == jobs.select("id").distinct().count()
        leaves = [tuple(map(int, b.split("-"))) for b in kept.buckets()]
        assert sum(2.0**-n for n, _ in leaves) == 1.0
        assert not any(a != b and a[0] <= b[0] and b[1] % (1 << a[0]) == a[1] for a in leaves for b in leaves)

    first = fold("one", range(200), 1)
    check(first, 200, lambda c: 1)
    held = first.manifests.load()["jobs"]
    assert len(held) > 15
    # A batch of one company rewrites its bucket only.
    second = fold("two", [7], 2)
    check(second, 200, lambda c: 2 if c == 7 else 1)
    now = second.manifests.load()["jobs"]
    assert sum(now[b] != v for b, v in held.items() if b in now) + len(set(held) - set(now)) == 1
    # New companies split the buckets further, across versions.
    before = len(second.buckets())
    third = fold("three", range(200, 400), 3)
    check(third, 400, lambda c: 3 if c >= 200 else 2 if c == 7 else 1)
    assert len(third.buckets()) > before


def test_attempts_late_repeated_and_unmatched(spark, tmp_path):
    from vacantia.streaming import liveness

    runs = liveness.AttemptRuns(spark, str(tmp_path / "runs"))

    def add(batch, *rows):
        events = spark.createDataFrame([(a, a * 10, k, at) for a, k, at in rows], "attempt_id long, job_id long, kind string, at string")
        runs.add(batch, events.withColumn("at", F.to_timestamp("at")))

    day = "2024-01-01 00:%s"
    add(0, (1, "started", day % "00:00"), (2, "started", day % "00:00"), (9, "finished", day % "05:00"))
    add(1, (1, "finished", day % "00:30"), (3, "finished", day % "01:10"))
    add(1, (7, "started", day % "00:00"))  # the same batch again
    add(2, (3, "started", day % "01:00"), (1, "started", day % "00:00"), (1, "finished", day % "00:30"))
    for batch in range(3, 20):
        add(batch, (2, "finished", day % "09:00"), (4, "started", "2024-01-01 00:30:00"))
    got = {(r.attempt_id, r.outcome) for r in liveness.attempt_outcomes(runs.read(), 60).collect()}
    assert got == {(1, "finished"), (2, "interrupted"), (2, "late_finish"), (3, "finished"), (9, "unmatched")}
    assert liveness.attempt_outcomes(runs.read(), 60).count() == 5
    assert len(runs.manifests.load()["runs"]) < 12


def test_contents_as_of_runs(spark):
    """Owners, ties with the bound, days without rows, unknown runs and jobs without content."""
    moment = "cast(concat('2024-01-', lpad(%s, 2, '0')) as timestamp_ntz)"
    attempts = spark.createDataFrame(
        [(1, 10, "r1", 1, 2), (2, 10, "r2", 9, None), (3, 20, "r1", 3, 3), (4, 30, "r1", 4, None), (5, 10, "r1", 1, 1),
         (6, 40, "gone", 1, 1), (7, 40, None, 1, 1)],
        "id long, job_id long, run_id string, s int, f int",
    ).selectExpr("id", "job_id", "run_id", moment % "s" + " AS started_at", moment % "f" + " AS finished_at")
    contents = spark.createDataFrame(
        [(100, 10, 1), (101, 10, 9), (102, 10, 9), (103, 10, 20), (200, 20, 9), (300, 30, 1), (400, 40, 1)], "id long, job_id long, d int"
    ).selectExpr("id", "job_id", moment % "d" + " AS retrieved_at")
    decisions = spark.createDataFrame(
        [(1, 30, 4, 300, "a"), (2, 30, 4, 400, "b"), (3, 10, 2, 100, "c")], "id long, job_id long, attempt_id long, content_id long, decision string"
    ).selectExpr("*", "'h' AS prompt_hash")
    runs = spark.createDataFrame([("r1",), ("r2",)], "id string").selectExpr("id", moment % "25" + " AS finished_at")
    rows = history.contents_as_of_runs(attempts, contents, decisions, runs, "2024-02-01")
    got = {(r["run_id"], r["job_id"]): (r["content_id"], r["decision"], r["problem"]) for r in rows.collect()}
    assert got == {
        # Attempt 5 is the newest of r1, its next attempt begins on the 9th: content of that moment counts, the later of two.
        ("r1", 10): (102, None, None),
        ("r2", 10): (100, "c", None),
        ("r1", 20): (None, None, "no_content"),
        ("r1", 30): (None, "b", "foreign_content"),
        ("gone", None): (None, None, "unknown_run"),
    }
    one = history.contents_as_of_run("gone", attempts, contents, decisions, runs, "2024-02-01").collect()
    assert [(r["job_id"], r["problem"]) for r in one] == [(None, "unknown_run")]
    assert history.contents_as_of_runs(attempts.limit(0), contents, decisions, runs, "2024-02-01").count() == 0


def test_jobs_without_content_are_shared_out(spark):
    """Many jobs have no content: their null key alone must not bring them to one task."""
    from vacantia.plans import workplan

    rows = [(i, "c", None) for i in range(1, 200)] + [(500, "c", 500), (501, "c", 501), (502, "c", 502), (503, "c", 500)]
    held = spark.createDataFrame(rows, "id long, company_slug string, current_content_id long")
    contents = spark.createDataFrame([(500, 500), (501, 501), (502, 7), (3, 3)], "id long, job_id long")
    decisions = spark.createDataFrame([(500, "eligible", 500, True), (501, "eligible", 9, True), (3, "eligible", 3, True)], "job_id long, decision string, content_id long, is_current boolean")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        problems = workplan.checkpoint_problems(held, contents, decisions)
        found = {r["id"]: r["problem"] for r in problems.collect()}
        plan = problems._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert found == {**{i: "no_content" for i in range(1, 200)}, 501: "other_content", 502: "no_content", 503: "no_content"}
    assert "hashpartitioning(current_content_id" in plan and "_held" in plan.split("hashpartitioning(current_content_id")[1].split(")")[0]
