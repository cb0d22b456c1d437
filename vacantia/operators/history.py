"""Durable history as table versions: observe, claim, release, accept, reprocess."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacantia.functions import urls
from vacantia.functions.numbering import next_in_group, numbered
from vacantia.operators.identity import merge_roots
from vacantia.plans.workplan import _moment, claimable
from vacantia.schemas import JOB_ATTEMPTS, JOB_SOURCES, JOBS
from vacantia.session import cut_lineage

# Job state after an accepted decision.
TRANSITIONS = {
    "eligible": ("ready_for_extraction", "extraction"),
    "ineligible": ("completed_ineligible", "eligibility"),
    "unknown": ("unknown", "eligibility"),
}


def _typed(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _highest(df: DataFrame) -> int:
    return df.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).first()["m"]


def observe(
    jobs: DataFrame, sources: DataFrame, snapshot: DataFrame, seen_at=None, highest: tuple[int, int] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Fold a URL snapshot (company_slug, url) into jobs and sources; both new versions.

    Unknown keys become new jobs; a known key marks the root of its merge chain as seen;
    each raw URL is a source of that root. Unkeyable URLs are skipped. Everything is
    reduced to one row per (company, key, url) before the joins. Without *seen_at* the
    snapshot's own column of that name gives the first and last sighting of each URL; a
    sighting older than the stored ones moves the first. *highest* are the ids given so far,
    where *jobs* and *sources* are only a part of the state.
    """
    top_job, top_source = highest or (_highest(jobs), _highest(sources))
    if seen_at is not None:
        snapshot = snapshot.withColumn("seen_at", _moment(seen_at))
    # Read by several branches below: the distinct pairs are written once instead of
    # keying the raw snapshot again for each.
    pairs = cut_lineage(
        urls.with_url_key(snapshot)
        .filter("url_key is not null")
        .groupBy("company_slug", "url_key", "url")
        .agg(
            F.min(F.col("seen_at").cast("timestamp_ntz")).alias("first_at"),
            F.max(F.col("seen_at").cast("timestamp_ntz")).alias("last_at"),
        )
    )
    keys = pairs.groupBy("company_slug", "url_key").agg(
        F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at")
    )
    fresh = keys.join(jobs, ["company_slug", "url_key"], "left_anti")
    created = numbered(fresh, ["company_slug", "url_key"], "id", top_job).select(
        "id",
        "company_slug",
        "url_key",
        F.lit("new").alias("status"),
        F.lit("fetch").alias("next_phase"),
        F.lit(0).alias("attempt_count"),
        F.lit(None).alias("next_attempt_after"),
        F.lit(None).alias("current_attempt_id"),
        F.lit(None).alias("current_content_id"),
        F.lit(False).alias("reprocess_requested"),
        F.lit(None).alias("merged_into_id"),
        F.col("first_at").alias("first_seen_at"),
        F.col("last_at").alias("last_seen_at"),
        F.col("last_at").alias("updated_at"),
    )
    everything = jobs.unionByName(_typed(created, JOBS))
    # New jobs are their own roots; only the stored table can hold chains.
    roots = merge_roots(jobs)
    # A chain that leaves the table or never ends is a broken table, not a result.
    if roots.filter("problem is not null").limit(1).count():
        raise ValueError("merge chain with a missing job or a cycle")
    targets = (
        keys.join(everything.select("company_slug", "url_key", F.col("id").alias("job_id")), ["company_slug", "url_key"])
        .join(roots.select("job_id", "root_id"), "job_id", "left")
        .select("company_slug", "url_key", F.coalesce("root_id", "job_id").alias("root_id"), "first_at", "last_at")
    )
    seen = targets.groupBy(F.col("root_id").alias("id")).agg(
        F.max("last_at").alias("_seen"), F.min("first_at").alias("_first")
    )
    new_jobs = everything.join(seen, "id", "left").withColumn("first_seen_at", F.least("first_seen_at", "_first"))
    for name in ("last_seen_at", "updated_at"):
        new_jobs = new_jobs.withColumn(name, F.greatest(F.col(name), F.col("_seen")))
    observed = (
        pairs.join(targets.drop("first_at", "last_at"), ["company_slug", "url_key"])
        .groupBy(F.col("root_id").alias("job_id"), "url")
        .agg(F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"))
    )
    known = sources.join(
        observed.select("job_id", "url", F.col("first_at").alias("_first"), F.col("last_at").alias("_seen")),
        ["job_id", "url"],
        "left",
    )
    known = known.withColumn("last_seen_at", F.greatest("last_seen_at", "_seen")).withColumn(
        "first_seen_at", F.least("first_seen_at", "_first")
    )
    added = numbered(
        observed.join(sources, ["job_id", "url"], "left_anti"), ["job_id", "url"], "id", top_source
    ).select(
        "id", "job_id", "url", F.col("first_at").alias("first_seen_at"), F.col("last_at").alias("last_seen_at")
    )
    return (
        new_jobs.select(*JOBS.names),
        known.select(*JOB_SOURCES.names).unionByName(_typed(added, JOB_SOURCES)),
    )


def apply_merges(jobs: DataFrame, merges: DataFrame, now) -> DataFrame:
    """Jobs with (job_id, canonical_id) merges applied."""
    folded = merges.filter("job_id <> canonical_id").select(
        F.col("job_id").alias("id"), F.col("canonical_id").alias("_into")
    )
    merged = F.col("_into").isNotNull()

    def put(name: str, value) -> Column:
        return F.when(merged, value).otherwise(F.col(name)).alias(name)

    changed = {
        "status": F.lit("merged"),
        "merged_into_id": F.col("_into"),
        "next_attempt_after": F.lit(None).cast("timestamp_ntz"),
        "current_attempt_id": F.lit(None).cast("long"),
        "updated_at": _moment(now),
    }
    return jobs.join(folded, "id", "left").select(
        *[put(c, changed[c]) if c in changed else F.col(c) for c in jobs.columns]
    )


def start_batch(
    jobs: DataFrame,
    attempts: DataFrame,
    selected: DataFrame,
    run_id: str,
    stage: str,
    trigger: str,
    model: str,
    now,
    reason: str | None = None,
    reasoning_effort: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Claim the selected job ids and open one attempt each (single batch writer)."""
    moment = _moment(now)
    claim = jobs.filter(claimable(stage, moment, trigger == "reprocess")).join(
        selected.select("id").distinct(), "id", "left_semi"
    )
    opened = numbered(claim.select(F.col("id").alias("job_id")), ["job_id"], "id", _highest(attempts))
    rows = opened.select(
        "id",
        "job_id",
        F.lit(run_id).alias("run_id"),
        F.lit(trigger).alias("trigger"),
        F.lit(reason).alias("reason"),
        *[F.lit(None).alias(c) for c in ("phase_reached", "outcome", "error_category", "error_message")],
        F.lit(model).alias("model"),
        F.lit(reasoning_effort).alias("reasoning_effort"),
        F.lit(None).alias("prompt_tokens"),
        F.lit(None).alias("completion_tokens"),
        moment.alias("started_at"),
        F.lit(None).alias("finished_at"),
    )
    lease = opened.select(F.col("job_id").alias("id"), F.col("id").alias("_attempt"))
    taken = F.col("_attempt").isNotNull()
    changed = {
        "status": F.lit("in_progress"),
        "attempt_count": F.col("attempt_count") + 1,
        "next_attempt_after": F.lit(None).cast("timestamp_ntz"),
        "current_attempt_id": F.col("_attempt"),
        "reprocess_requested": F.lit(False),
        "updated_at": moment,
    }
    new_jobs = jobs.join(lease, "id", "left").select(
        *[
            F.when(taken, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
            for c in jobs.columns
        ]
    )
    return new_jobs, attempts.unionByName(_typed(rows, JOB_ATTEMPTS))


def advance_phase(jobs: DataFrame, steps: DataFrame, now) -> DataFrame:
    """Move jobs in progress to *next_phase* where the step's attempt owns them."""
    given = steps.select(
        F.col("job_id").alias("id"), F.col("attempt_id").alias("_a"), F.col("next_phase").alias("_p")
    )
    owned = (F.col("status") == "in_progress") & (F.col("current_attempt_id") == F.col("_a"))
    owned = F.coalesce(owned, F.lit(False))
    return (
        jobs.join(given, "id", "left")
        .withColumn("next_phase", F.when(owned, F.col("_p")).otherwise(F.col("next_phase")))
        .withColumn("updated_at", F.when(owned, _moment(now)).otherwise(F.col("updated_at")))
        .select(*jobs.columns)
    )


def release(
    jobs: DataFrame, attempts: DataFrame, outcomes: DataFrame, now
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Apply an outcomes table: new jobs, new attempts, and outcome rows with *applied*.

    *outcomes*: job_id, attempt_id, status, next_phase, next_attempt_after,
    error_category, error_message, prompt_tokens, completion_tokens. A row whose attempt
    does not hold the job is skipped.
    """
    moment = _moment(now)
    held = jobs.select(F.col("id").alias("job_id"), F.col("current_attempt_id").alias("attempt_id"))
    owned = outcomes.join(held, ["job_id", "attempt_id"], "left_semi")
    bad = (F.col("status") == "retry") != F.col("next_attempt_after").isNotNull()
    if owned.filter(bad).limit(1).count():
        raise ValueError("next_attempt_after must be set exactly for retry jobs")
    given = owned.select(
        F.col("job_id").alias("id"),
        F.struct("status", "next_phase", "next_attempt_after").alias("_o"),
    )
    freed = F.col("_o").isNotNull()
    changed = {
        "status": F.col("_o.status"),
        "next_phase": F.col("_o.next_phase"),
        "next_attempt_after": F.col("_o.next_attempt_after"),
        "current_attempt_id": F.lit(None).cast("long"),
        "updated_at": moment,
    }
    new_jobs = jobs.join(given, "id", "left").select(
        *[
            F.when(freed, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
            for c in jobs.columns
        ]
    )
    new_attempts = finish_attempts(
        attempts,
        owned.select(
            "attempt_id",
            F.col("status").alias("outcome"),
            F.col("next_phase").alias("phase_reached"),
            "error_category",
            "error_message",
            "prompt_tokens",
            "completion_tokens",
        ),
        moment,
    )
    applied = outcomes.join(
        owned.select("job_id", "attempt_id", F.lit("applied").alias("release")), ["job_id", "attempt_id"], "left"
    ).withColumn("release", F.coalesce("release", F.lit("skipped")))
    return new_jobs, new_attempts, applied


def finish_attempts(attempts: DataFrame, endings: DataFrame, now) -> DataFrame:
    """End unfinished attempts with the columns of *endings* (keyed by attempt_id)."""
    names = [c for c in endings.columns if c != "attempt_id"]
    given = endings.select(F.col("attempt_id").alias("id"), F.struct(*names).alias("_e"))
    open_row = F.col("_e").isNotNull() & F.col("finished_at").isNull()
    joined = attempts.join(given, "id", "left").withColumn("_open", open_row)
    return joined.select(
        *[
            F.when(F.col("_open"), _moment(now)).otherwise(F.col(c)).alias(c)
            if c == "finished_at"
            else F.when(F.col("_open"), F.col(f"_e.{c}")).otherwise(F.col(c)).alias(c)
            if c in names
            else F.col(c)
            for c in attempts.columns
        ]
    )


def accept_current(existing: DataFrame, accepted: DataFrame) -> DataFrame:
    """History plus accepted rows; only the newest accepted row of a job is current.

    *accepted* has the same columns without id and is_current, and at most one row per
    attempt. Jobs without a new row keep their current one.
    """
    order = ["job_id", "attempt_id"]
    new = numbered(accepted, order, "id", _highest(existing))
    top = new.groupBy("job_id").agg(F.max("id").alias("_top"))
    kept = existing.join(top, "job_id", "left").withColumn(
        "is_current", F.col("is_current") & F.col("_top").isNull()
    )
    added = new.join(top, "job_id").withColumn("is_current", F.col("id") == F.col("_top"))
    return kept.select(*existing.columns).unionByName(added.select(*existing.columns))


def decided_state(decision: Column) -> Column:
    """``struct<status, next_phase>`` of a job after the decision."""
    status = F.lit(None).cast("string")
    phase = F.lit(None).cast("string")
    for name, (new_status, new_phase) in TRANSITIONS.items():
        status = F.when(decision == name, new_status).otherwise(status)
        phase = F.when(decision == name, new_phase).otherwise(phase)
    return F.struct(status.alias("status"), phase.alias("next_phase"))


def accept_decisions(
    jobs: DataFrame, attempts: DataFrame, decisions: DataFrame, accepted: DataFrame, now
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Store accepted decisions, move their jobs on and end their attempts.

    *accepted* has the decision columns plus prompt_tokens and completion_tokens. Rows
    whose attempt and content do not hold the job are left out.
    """
    moment = _moment(now)
    held = jobs.filter("status = 'in_progress'").select(
        F.col("id").alias("job_id"),
        F.col("current_attempt_id").alias("attempt_id"),
        F.col("current_content_id").alias("content_id"),
    )
    owned = accepted.join(held, ["job_id", "attempt_id", "content_id"], "left_semi")
    columns = [c for c in decisions.columns if c not in ("id", "is_current")]
    new_decisions = accept_current(decisions, owned.select(*columns))
    given = owned.select(
        F.col("job_id").alias("id"), F.col("decision").alias("_d"), decided_state(F.col("decision")).alias("_n")
    )
    moved = F.col("_d").isNotNull()
    changed = {
        "status": F.col("_n.status"),
        "next_phase": F.col("_n.next_phase"),
        "next_attempt_after": F.lit(None).cast("timestamp_ntz"),
        "current_attempt_id": F.lit(None).cast("long"),
        "attempt_count": F.when(F.col("_d") == "eligible", 0).otherwise(F.col("attempt_count")),
        "updated_at": moment,
    }
    new_jobs = jobs.join(given, "id", "left").select(
        *[
            F.when(moved, changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
            for c in jobs.columns
        ]
    )
    endings = owned.select(
        "attempt_id",
        decided_state(F.col("decision"))["status"].alias("outcome"),
        F.lit("eligibility").alias("phase_reached"),
        F.lit(None).cast("string").alias("error_category"),
        F.lit(None).cast("string").alias("error_message"),
        "prompt_tokens",
        "completion_tokens",
    )
    return new_jobs, finish_attempts(attempts, endings, moment), new_decisions


def accept_results(
    jobs: DataFrame, attempts: DataFrame, results: DataFrame, accepted: DataFrame, now
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Store accepted extraction results and complete their jobs."""
    moment = _moment(now)
    held = jobs.filter("status = 'in_progress'").select(
        F.col("id").alias("job_id"),
        F.col("current_attempt_id").alias("attempt_id"),
        F.col("current_content_id").alias("content_id"),
    )
    owned = accepted.join(held, ["job_id", "attempt_id", "content_id"], "left_semi")
    columns = [c for c in results.columns if c not in ("id", "is_current")]
    outcomes = owned.select(
        "job_id",
        "attempt_id",
        F.lit("completed_eligible").alias("status"),
        F.lit("extraction").alias("next_phase"),
        F.lit(None).cast("timestamp_ntz").alias("next_attempt_after"),
        F.lit(None).cast("string").alias("error_category"),
        F.lit(None).cast("string").alias("error_message"),
        "prompt_tokens",
        "completion_tokens",
    )
    new_jobs, new_attempts, _ = release(jobs, attempts, outcomes, moment)
    return new_jobs, new_attempts, accept_current(results, owned.select(*columns))


def requests_without_decision(requests: DataFrame, decisions: DataFrame, prompt_hash: str) -> DataFrame:
    """Requests for which no current decision on the same content and prompt exists."""
    reusable = decisions.filter(F.col("is_current") & (F.col("prompt_hash") == prompt_hash)).select(
        "job_id", "content_id"
    )
    return requests.join(reusable, ["job_id", "content_id"], "left_anti")


def reprocess_checks(
    wanted: DataFrame, jobs: DataFrame, contents: DataFrame, decisions: DataFrame, from_phase: str
) -> DataFrame:
    """Selected job ids with the content they restart from, or the reason they may not."""
    selected = wanted.select("id").distinct().join(
        jobs.select("id", "status", "current_content_id", F.lit(True).alias("_known")), "id", "left"
    )
    owned = contents.select(F.col("job_id").alias("id"), F.col("id").alias("content_id"), F.lit(True).alias("_has"))
    if from_phase == "eligibility":
        selected = selected.withColumn("content_id", F.col("current_content_id")).join(
            owned, ["id", "content_id"], "left"
        )
        missing = F.when(F.col("_has").isNull(), "no content checkpoint")
    elif from_phase == "extraction":
        eligible = decisions.filter("is_current and decision = 'eligible'").select(
            F.col("job_id").alias("id"), "content_id", F.lit(True).alias("_decided")
        )
        selected = selected.join(eligible, "id", "left").join(owned, ["id", "content_id"], "left")
        missing = F.when(F.col("_decided").isNull(), "no current eligible decision checkpoint").when(
            F.col("_has").isNull(), "no content for its decision checkpoint"
        )
    else:
        selected = selected.withColumn("content_id", F.lit(None).cast("long"))
        missing = F.lit(None).cast("string")
    problem = (
        F.when(F.col("_known").isNull(), "no_job")
        .when(F.col("status") == "in_progress", "busy")
        .when(F.col("status") == "merged", "merged")
        .otherwise(missing)
    )
    return selected.select("id", "content_id", problem.alias("problem"))


def prepare_reprocess(
    jobs: DataFrame, decisions: DataFrame, results: DataFrame, checked: DataFrame, from_phase: str, now
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Reset checked jobs to *from_phase* and retire their current rows.

    Raises when any checked row has a problem: a selection is prepared whole or not.
    """
    if checked.filter("problem is not null").limit(1).count():
        raise ValueError("selection has jobs that cannot be prepared; see reprocess_checks")
    moment = _moment(now)
    ids = checked.select("id", F.col("content_id").alias("_content"), F.lit(True).alias("_go"))
    changed = {
        "status": F.lit("retry"),
        "next_phase": F.lit(from_phase),
        "attempt_count": F.lit(0),
        "next_attempt_after": moment,
        "current_attempt_id": F.lit(None).cast("long"),
        "current_content_id": F.lit(None).cast("long") if from_phase == "fetch" else F.col("_content"),
        "reprocess_requested": F.lit(True),
        "merged_into_id": F.lit(None).cast("long"),
        "updated_at": moment,
    }
    new_jobs = jobs.join(ids, "id", "left").select(
        *[
            F.when(F.col("_go"), changed[c]).otherwise(F.col(c)).alias(c) if c in changed else F.col(c)
            for c in jobs.columns
        ]
    )
    chosen = checked.select(F.col("id").alias("job_id"), F.lit(True).alias("_go"))

    def retire(table: DataFrame) -> DataFrame:
        return (
            table.join(chosen, "job_id", "left")
            .withColumn("is_current", F.col("is_current") & F.col("_go").isNull())
            .select(*table.columns)
        )

    new_decisions = retire(decisions) if from_phase in ("fetch", "eligibility") else decisions
    return new_jobs, new_decisions, retire(results)


def sync_catalog(stored: DataFrame, catalog: DataFrame, now) -> DataFrame:
    """Upsert the catalog projection; companies that left the catalog stay."""
    fresh = catalog.select(
        "slug", F.struct("name", "job_board_url", "strategy").alias("_n")
    )
    joined = stored.join(fresh, "slug", "full")
    return joined.select(
        "slug",
        *[
            F.coalesce(F.col(f"_n.{c}"), F.col(c)).alias(c)
            for c in ("name", "job_board_url", "strategy")
        ],
        F.when(F.col("_n").isNotNull(), _moment(now)).otherwise(F.col("synced_at")).alias("synced_at"),
    )


def latest_runs(run_events: DataFrame) -> DataFrame:
    """Current state of each run from appended rows (opened, finished, failed).

    Later rows win field by field; a failed run keeps a null count.
    """
    order = F.col("event_at")
    newest = run_events.groupBy("id").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in run_events.columns if c not in ("id", "event_at", "status")],
        F.max_by("status", F.struct(order, F.col("status") != "in_progress")).alias("status"),
    )
    return newest.withColumn(
        "url_count", F.when(F.col("status") == "success", F.col("url_count"))
    ).select(*[c for c in run_events.columns if c != "event_at"])



def newest_source(sources: DataFrame) -> DataFrame:
    return sources.groupBy("job_id").agg(
        F.max_by("url", F.struct("last_seen_at", "id")).alias("url")
    )


def latest_attempts(attempts: DataFrame) -> DataFrame:
    """Attempt with the highest id of each job and run."""
    rest = [c for c in attempts.columns if c not in ("job_id", "run_id")]
    return (
        attempts.groupBy("job_id", "run_id")
        .agg(F.max_by(F.struct(*rest), "id").alias("_a"))
        .select("job_id", "run_id", *[F.col(f"_a.{c}").alias(c) for c in rest])
        .select(*attempts.columns)
    )


def last_error_category(attempts: DataFrame) -> DataFrame:
    """Newest error of each job, by (started_at, id) over attempts that have one."""
    return (
        attempts.filter("error_category is not null")
        .groupBy("job_id")
        .agg(F.max_by("error_category", F.struct("started_at", "id")).alias("error_category"))
    )


def jobs_with_last_error(jobs: DataFrame, attempts: DataFrame, category: str) -> DataFrame:
    """Unmerged jobs whose attempt with the highest id ended in *category*."""
    newest = attempts.groupBy("job_id").agg(F.max_by(F.struct("error_category"), "id").alias("_e"))
    live = jobs.filter((F.col("status") != "merged") & F.col("merged_into_id").isNull()).select(
        F.col("id").alias("job_id")
    )
    return newest.filter(F.col("_e.error_category") == category).join(live, "job_id", "left_semi").select("job_id")


def next_attempt_start(attempts: DataFrame) -> DataFrame:
    """Attempts with the start of the job's next attempt (ties by id); hot jobs by day."""
    return next_in_group(
        attempts, ["job_id"], ["started_at", "id"], "started_at", F.to_date("started_at"), "next_started_at"
    )


def contents_as_of_runs(
    attempts: DataFrame,
    contents: DataFrame,
    decisions: DataFrame,
    runs: DataFrame,
    now,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """What each job of each run was judged on: (run_id, job_id, content_id, decision, prompt_hash, problem).

    The content of the run's newest decision on the job; without one, the newest content
    retrieved no later than the start of the job's next attempt, else the end of the
    attempt or run, else *now*. Content must belong to the job: content of another job, or
    that is not stored, gives no content_id and the problem ``foreign_content``; a job
    without any content has ``no_content``. *wanted* (run_id) names the runs, all runs of
    the attempts if it is left out; one that *runs* does not hold is a single row without a
    job and the problem ``unknown_run``.

    All runs are answered in one pass: contents and bounds of a job are put in one order of
    time, and each bound takes the last content before it. The order is kept within days
    only, so that a job with many rows is spread; a day takes the last content of the days
    before from a table with one row per job and day.
    """
    asked = (attempts if wanted is None else wanted).select("run_id").filter("run_id is not null").distinct()
    known = runs.select(F.col("id").alias("run_id"), F.col("finished_at").alias("_run_end"))
    answered = asked.join(known, "run_id")
    mine = attempts
    if wanted is not None:
        # Later attempts of the same jobs bound them, whatever run they are of.
        jobs = attempts.join(answered, "run_id", "left_semi").select("job_id").distinct()
        mine = attempts.join(jobs, "job_id", "left_semi")
    selected = (
        latest_attempts(next_attempt_start(mine))
        .join(answered, "run_id")
        .select(
            "run_id", "job_id", F.coalesce("next_started_at", "finished_at", "_run_end", _moment(now)).alias("_at")
        )
    )
    tagged = (
        contents.filter("retrieved_at is not null")
        .select("job_id", F.col("retrieved_at").alias("_at"), F.col("id").alias("_content"), F.lit(None).cast("string").alias("run_id"))
        .unionByName(selected.select("job_id", "_at", F.lit(None).cast("long").alias("_content"), F.col("run_id").cast("string").alias("run_id")))
        .withColumn("_day", F.to_date("_at"))
    )
    order = ["_at", F.col("run_id").isNotNull(), "_content"]
    within = F.last("_content", ignorenulls=True).over(Window.partitionBy("job_id", "_day").orderBy(*order))
    days = tagged.groupBy("job_id", "_day").agg(F.max_by("_content", F.when(F.col("_content").isNotNull(), F.struct("_at", "_content"))).alias("_last"))
    before = Window.partitionBy("job_id").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carried = days.select("job_id", "_day", F.last("_last", ignorenulls=True).over(before).alias("_carried"))
    as_of = (
        tagged.withColumn("_in", within)
        .filter("run_id is not null")
        .join(carried, ["job_id", "_day"])
        .select("run_id", "job_id", F.coalesce("_in", "_carried").alias("_as_of"))
    )
    in_run = attempts.select(F.col("id").alias("attempt_id"), "run_id").join(answered, "run_id", "left_semi")
    decided = (
        decisions.drop("run_id")
        .join(in_run, "attempt_id")
        .groupBy("run_id", "job_id")
        .agg(F.max_by(F.struct("content_id", "decision", "prompt_hash"), "id").alias("_d"))
    )
    judged = as_of.join(decided, ["run_id", "job_id"], "left").select(
        "run_id", "job_id", "_d", F.coalesce("_d.content_id", "_as_of").alias("_content")
    )
    stored = contents.select(F.col("id").alias("_content"), "job_id", F.lit(True).alias("_own")).distinct()
    found = judged.join(stored, ["_content", "job_id"], "left").select(
        "run_id",
        "job_id",
        F.when(F.col("_own"), F.col("_content")).alias("content_id"),
        F.col("_d.decision").alias("decision"),
        F.col("_d.prompt_hash").alias("prompt_hash"),
        F.when(F.col("_content").isNull(), "no_content").when(F.col("_own").isNull(), "foreign_content").alias("problem"),
    )
    unknown = asked.join(known, "run_id", "left_anti").select(F.col("run_id").cast("string").alias("run_id"), F.lit("unknown_run").alias("problem"))
    return found.unionByName(unknown, allowMissingColumns=True)


def contents_as_of_run(
    run_id: str, attempts: DataFrame, contents: DataFrame, decisions: DataFrame, runs: DataFrame, now
) -> DataFrame:
    """:func:`contents_as_of_runs` of one run, without its name; an unknown run is one row with that problem."""
    wanted = attempts.sparkSession.range(1).select(F.lit(run_id).alias("run_id"))
    return contents_as_of_runs(attempts, contents, decisions, runs, now, wanted).drop("run_id")
