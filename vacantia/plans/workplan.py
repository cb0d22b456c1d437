"""Planning: what is due, what is fresh, what failed and when it comes again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.schemas import STAGE_PHASES, TERMINAL_CATEGORIES

RETRY_LIMIT = 3
RETRY_BACKOFF_HOURS = 24
FRESHNESS_HOURS = 20
ABANDONED = "abandoned: scan terminated"


def _moment(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp_ntz")


def claimable(stage: str, now, reprocess: bool = False) -> Column:
    """Whether a job row may be claimed for *stage* at *now*."""
    due = (
        (F.col("status") == "retry")
        & F.col("next_phase").isin(*STAGE_PHASES[stage])
        & (F.col("next_attempt_after") <= _moment(now))
    )
    if reprocess:
        claim = due & F.col("reprocess_requested")
    else:
        waiting = "new" if stage == "eligibility" else "ready_for_extraction"
        claim = ~F.col("reprocess_requested") & ((F.col("status") == waiting) | due)
    return F.coalesce(claim, F.lit(False))


def in_snapshot(jobs: DataFrame, keys: DataFrame) -> DataFrame:
    return jobs.join(keys.select("company_slug", "url_key"), ["company_slug", "url_key"], "left_semi")


def work_list(
    jobs: DataFrame, keys: DataFrame, now, stage: str, limit: int | None = None, reprocess: bool = False
) -> DataFrame:
    """Claimable snapshot jobs by id; *limit* is the caller's batch size."""
    work = in_snapshot(jobs.filter(claimable(stage, now, reprocess)), keys).orderBy("id")
    return work if limit is None else work.limit(limit)


def disposition(now) -> Column:
    """Label of a job: retries by stage and whether they are due, others by status."""
    stage = F.when(F.col("next_phase") == "extraction", "extraction").otherwise("eligibility")
    due = F.when(F.col("next_attempt_after") <= _moment(now), "due").otherwise("waiting")
    return F.when(F.col("status") == "retry", F.concat(stage, F.lit("_retry_"), due)).otherwise(
        F.col("status")
    )


def stage_dispositions(jobs: DataFrame, keys: DataFrame, now, by_company: bool = False) -> DataFrame:
    groups = ["company_slug", "disposition"] if by_company else ["disposition"]
    return (
        in_snapshot(jobs, keys)
        .withColumn("disposition", disposition(now))
        .groupBy(*groups)
        .agg(F.count("*").alias("jobs"))
    )


# Report sections and their rows, in display order.
SECTIONS = {
    "Eligibility work": ("new", "eligibility_retry_due", "eligibility_retry_waiting"),
    "Extraction backlog": (
        "ready_for_extraction",
        "extraction_retry_due",
        "extraction_retry_waiting",
    ),
    "In progress": ("in_progress",),
    "Terminal dispositions": (
        "completed_eligible",
        "completed_ineligible",
        "unknown",
        "unavailable",
        "failed",
        "merged",
    ),
}


def preview(jobs: DataFrame, keys: DataFrame, now, limit: int | None = None) -> DataFrame:
    """Counts per section and label, in total (null company) and per company.

    One rollup gives both levels. The rows *would process* are capped by *limit* per
    level, which is what the preview shows; the jobs themselves are not cut.
    """
    section = F.lit(None).cast("string")
    for name, labels in SECTIONS.items():
        section = F.when(F.col("label").isin(*labels), name).otherwise(section)
    scoped = in_snapshot(jobs, keys).select(
        "company_slug",
        disposition(now).alias("label"),
        claimable("eligibility", now).alias("_e"),
        claimable("extraction", now).alias("_x"),
    )
    counts = scoped.groupBy("company_slug", "label").agg(
        F.count("*").alias("jobs"), F.count_if("_e").alias("_e"), F.count_if("_x").alias("_x")
    )
    label_level = counts.cube("company_slug", "label").agg(
        F.sum("jobs").alias("jobs"),
        F.sum("_e").alias("_e"),
        F.sum("_x").alias("_x"),
        F.grouping("company_slug").alias("_gc"),
        F.grouping("label").alias("_gl"),
    )

    def row(section_name: Column, label: Column, jobs_in: Column) -> Column:
        return F.struct(section_name.alias("section"), label.alias("label"), jobs_in.cast("long").alias("jobs"))

    def capped(name: str, column: str) -> Column:
        total = F.col(column) if limit is None else F.least(F.col(column), F.lit(limit))
        return row(F.lit("Would process"), F.lit(name), total)

    # Label rows and work rows come from one pass over the grouping levels.
    rows = F.when(F.col("_gl") == 0, F.array(row(section, F.col("label"), F.col("jobs")))).otherwise(
        F.array(capped("eligibility", "_e"), capped("extraction", "_x"))
    )
    return label_level.select("company_slug", F.explode(rows).alias("_r")).select("company_slug", "_r.*")


def checkpoint_problems(jobs: DataFrame, contents: DataFrame, decisions: DataFrame) -> DataFrame:
    """Jobs that cannot be extracted: no content, no eligible decision, or other content."""
    # Most jobs have no content yet: the second key, the content's id again, shares them out
    # by their own id, where the null alone would bring them all to one task.
    content = contents.select(F.col("id").alias("current_content_id"), F.col("id").alias("_held"), F.col("job_id").alias("_cj"))
    held = jobs.withColumn("_held", F.coalesce("current_content_id", "id"))
    decision = decisions.filter("is_current").select(
        F.col("job_id").alias("id"), "decision", F.col("content_id").alias("_dc")
    )
    reason = (
        F.when(F.col("_cj").isNull() | (F.col("_cj") != F.col("id")), "no_content")
        .when(F.coalesce(F.col("decision") != "eligible", F.lit(True)), "not_eligible")
        .when(F.col("_dc") != F.col("current_content_id"), "other_content")
    )
    return (
        held.join(content, ["current_content_id", "_held"], "left")
        .join(decision, "id", "left")
        .withColumn("problem", reason)
        .filter(F.col("problem").isNotNull())
        .select("id", "company_slug", "problem")
    )


def next_state(
    category: Column,
    attempt_count: Column,
    now,
    retry_limit: int = RETRY_LIMIT,
    backoff_hours: int = RETRY_BACKOFF_HOURS,
) -> Column:
    """``struct<status, next_attempt_after>`` after a failure of the given category."""
    limit = F.when(category == "internal", min(retry_limit, 2)).otherwise(retry_limit)
    again = attempt_count < limit
    status = (
        F.when(category == "missing_checkpoint", "failed")
        .when(category.isin(*TERMINAL_CATEGORIES), "unavailable")
        .when(again, "retry")
        .otherwise("failed")
    )
    wait = F.make_dt_interval(F.lit(0), (attempt_count * backoff_hours).cast("int"))
    return F.struct(
        status.alias("status"),
        F.when(status == "retry", _moment(now) + wait).alias("next_attempt_after"),
    )



def stale_companies(companies: DataFrame, runs: DataFrame, now, hours: int = FRESHNESS_HOURS) -> DataFrame:
    """Companies without a success inside the freshness window; a zero count is a success."""
    cutoff = _moment(now) - F.make_dt_interval(F.lit(0), F.lit(hours))
    fresh = (
        runs.filter((F.col("status") == "success") & (F.col("finished_at") >= cutoff))
        .select(F.col("company_slug").alias("slug"))
        .distinct()
    )
    return companies.join(fresh, "slug", "left_anti")


def scan_plan(companies: DataFrame, runs: DataFrame, now, hours: int = FRESHNESS_HOURS) -> DataFrame:
    """Each company with its cost class and whether it runs or is skipped as fresh."""
    due = stale_companies(companies, runs, now, hours).select("slug", F.lit("run").alias("plan"))
    return (
        companies.join(due, "slug", "left")
        .withColumn("plan", F.coalesce("plan", F.lit("fresh")))
    )


def cost_class(strategy: Column, browser_token_key: Column) -> Column:
    """``browser`` when a run opens a browser, else ``http``."""
    return F.when(
        (strategy == "dom") | ((strategy == "coveo") & browser_token_key.isNotNull()), "browser"
    ).otherwise("http")


def cost_mix(catalog: DataFrame) -> DataFrame:
    return (
        catalog.withColumn("cost_class", cost_class(F.col("strategy"), F.col("coveo.browser_token_key")))
        .groupBy("cost_class", "strategy")
        .agg(F.count("*").alias("companies"))
    )


def batch_summary(runs: DataFrame) -> DataFrame:
    """Per batch: companies, outcomes by status, URLs stored by successful runs."""
    status = F.col("status")
    return runs.groupBy("batch_id").agg(
        F.count("*").alias("companies"),
        F.count_if(status == "success").alias("succeeded"),
        F.count_if(status == "failed").alias("failed"),
        F.count_if(status == "skipped").alias("skipped"),
        F.coalesce(F.sum(F.when(status == "success", F.col("url_count"))), F.lit(0)).alias("stored_urls"),
    )


def reap_runs(runs: DataFrame, older_than, now) -> DataFrame:
    """Runs left in progress since before the bound become failed."""
    stale = (F.col("status") == "in_progress") & (F.col("started_at") < _moment(older_than))
    return (
        runs.withColumn("_stale", stale)
        .withColumn("status", F.when(F.col("_stale"), "failed").otherwise(F.col("status")))
        .withColumn("error_message", F.when(F.col("_stale"), ABANDONED).otherwise(F.col("error_message")))
        .withColumn("finished_at", F.when(F.col("_stale"), _moment(now)).otherwise(F.col("finished_at")))
        .drop("_stale")
    )


def reap_attempts(jobs: DataFrame, attempts: DataFrame, stage: str, older_than, now) -> tuple[DataFrame, DataFrame]:
    """Interrupt unfinished attempts older than the bound; their jobs are due at once."""
    held = jobs.filter(
        (F.col("status") == "in_progress") & F.col("next_phase").isin(*STAGE_PHASES[stage])
    ).select(F.col("current_attempt_id").alias("id"), F.col("id").alias("job_id"))
    stale = (
        attempts.filter(F.col("finished_at").isNull() & (F.col("started_at") < _moment(older_than)))
        .join(held, ["id", "job_id"], "left_semi")
        .select("id", "job_id")
    )
    flag = stale.select("id", F.lit(True).alias("_s"))
    ended = attempts.join(flag, "id", "left")

    def put(name: str, value) -> Column:
        return F.when(F.col("_s"), value).otherwise(F.col(name)).alias(name)

    changed = {
        "outcome": F.lit("interrupted"),
        "error_category": F.lit("interrupted"),
        "error_message": F.lit("pipeline run interrupted"),
        "finished_at": _moment(now),
    }
    new_attempts = ended.select(*[put(c, changed[c]) if c in changed else F.col(c) for c in attempts.columns])
    freed = jobs.join(stale.select(F.col("job_id").alias("id"), F.lit(True).alias("_s")), "id", "left")
    released = {
        "status": F.lit("retry"),
        "next_attempt_after": _moment(now),
        "current_attempt_id": F.lit(None).cast("long"),
        "reprocess_requested": F.lit(False),
        "updated_at": _moment(now),
    }
    new_jobs = freed.select(*[put(c, released[c]) if c in released else F.col(c) for c in jobs.columns])
    return new_jobs, new_attempts
