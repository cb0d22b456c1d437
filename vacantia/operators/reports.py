"""Operational and audit reports over the history tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions.urls import redact_message
from vacantia.operators.answers import evidence_list
from vacantia.operators.facts import failed_fields
from vacantia.schemas import FACTS
from vacantia.session import small_side


def dispositions(jobs: DataFrame) -> DataFrame:
    return (
        jobs.groupBy("company_slug", "status")
        .agg(F.count("*").alias("jobs"))
        .orderBy("company_slug", "status")
    )


def repeated_attempts(jobs: DataFrame, attempts: DataFrame) -> DataFrame:
    """Jobs with more than one attempt, most attempts first. Counted before the join."""
    counts = (
        attempts.groupBy("job_id").agg(F.count("*").alias("attempts")).filter("attempts > 1")
    )
    return (
        counts.join(
            jobs.select(F.col("id").alias("job_id"), "company_slug", "status"), "job_id"
        )
        .select("job_id", "company_slug", "status", "attempts")
        .orderBy(F.desc("attempts"), "company_slug", "job_id")
    )


def _usage() -> list[Column]:
    return [
        F.count("*").alias("attempts"),
        F.coalesce(F.sum("prompt_tokens"), F.lit(0)).alias("prompt_tokens"),
        F.coalesce(F.sum("completion_tokens"), F.lit(0)).alias("completion_tokens"),
    ]


def usage_groups(attempts: DataFrame) -> DataFrame:
    """Usage by run and by outcome (per model): both groupings in one pass.

    Attempts are first summed per (run, outcome, model); grouping sets then work on that
    small table instead of a doubled attempt table.
    """
    base = attempts.withColumn("outcome", F.coalesce("outcome", F.lit("in_progress"))).groupBy(
        "run_id", "outcome", "model"
    ).agg(*_usage())
    grouped = base.groupingSets(
        [["run_id", "model"], ["outcome", "model"]], "run_id", "outcome", "model"
    ).agg(
        F.sum("attempts").alias("attempts"),
        F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        F.grouping("run_id").alias("_by_outcome"),
    )
    return grouped.select(
        F.when(F.col("_by_outcome") == 1, "outcome").otherwise("run").alias("cost_scope"),
        F.when(F.col("_by_outcome") == 1, F.col("outcome")).otherwise(F.col("run_id")).alias("scope_value"),
        "model",
        "attempts",
        "prompt_tokens",
        "completion_tokens",
    )


def micro_rounded(amount: Column) -> Column:
    """Amount rounded to six places by its binary value.

    ``round`` goes by the shortest decimal form of a double and so lifts amounts that lie
    just below a half; databases that keep money as REAL do not.
    """
    return F.floor(amount * 1000000 + 0.5) / 1000000


def usage_and_cost(attempts: DataFrame, prices: DataFrame) -> DataFrame:
    """Usage groups with estimated cost; a model without price has null cost."""
    cost = micro_rounded(
        (
            F.col("prompt_tokens") * F.col("input_usd_per_million")
            + F.col("completion_tokens") * F.col("output_usd_per_million")
        )
        / 1000000.0
    )
    return (
        usage_groups(attempts)
        .join(small_side(prices), "model", "left")
        .withColumn("estimated_cost_usd", cost)
        .orderBy("cost_scope", "scope_value", "model")
    )


def usage_per_stage(attempts: DataFrame, runs: DataFrame) -> DataFrame:
    """Usage by stage, trigger and model; attempts are summed per run before the join."""
    per_run = attempts.groupBy("run_id", "model").agg(*_usage())
    return (
        per_run.join(runs.select(F.col("id").alias("run_id"), "stage", "trigger"), "run_id")
        .groupBy("stage", "trigger", "model")
        .agg(*[F.sum(c).alias(c) for c in ("attempts", "prompt_tokens", "completion_tokens")])
        .orderBy("stage", "trigger", "model")
    )


def unknown_decisions(jobs: DataFrame, decisions: DataFrame) -> DataFrame:
    current = decisions.filter("is_current and decision = 'unknown'").select(
        "job_id", "reason", "prompt_hash", "decided_at"
    )
    return (
        current.join(jobs.select(F.col("id").alias("job_id"), "company_slug"), "job_id")
        .select("job_id", "company_slug", "reason", "prompt_hash", "decided_at")
        .orderBy("decided_at", "company_slug", "job_id")
    )


def results_with_failed_fields(jobs: DataFrame, results: DataFrame) -> DataFrame:
    """Failed facts of current results: job, company and JSON path."""
    parsed = results.filter("is_current").select(
        "job_id", F.from_json("result_json", FACTS).alias("facts")
    )
    return (
        failed_fields(parsed, ["job_id"])
        .join(jobs.select(F.col("id").alias("job_id"), "company_slug"), "job_id")
        .select("job_id", "company_slug", "failed_field")
        .orderBy("company_slug", "job_id", "failed_field")
    )


# Terminal and other-stage labels that a stage's planner never selects.
NOT_WORK = {
    "eligibility": (
        "completed_eligible",
        "completed_ineligible",
        "unknown",
        "unavailable",
        "failed",
        "merged",
        "ready_for_extraction",
        "extraction_retry_due",
        "extraction_retry_waiting",
    ),
    "extraction": (
        "completed_eligible",
        "completed_ineligible",
        "unknown",
        "unavailable",
        "failed",
        "merged",
        "new",
        "eligibility_retry_due",
        "eligibility_retry_waiting",
    ),
}


def run_counts(outcomes: DataFrame, stage: str, dispositions: DataFrame, reaped: int = 0) -> DataFrame:
    """Counters of each run as a map, keyed by run_id.

    *outcomes*: run_id, status, prompt_tokens, completion_tokens. *dispositions*:
    disposition, jobs (the plan of the run).
    """
    status = F.col("status")

    def n(name: str) -> Column:
        return F.count_if(status == name)

    names: dict[str, Column] = {
        "skipped": n("skipped"),
        "attempted": F.count("*") - n("skipped"),
        "retry": n("retry"),
        "failed": n("failed"),
        "prompt_tokens": F.coalesce(F.sum("prompt_tokens"), F.lit(0)).cast("long"),
        "completion_tokens": F.coalesce(F.sum("completion_tokens"), F.lit(0)).cast("long"),
    }
    if stage == "eligibility":
        names |= {
            "ready_for_extraction": n("ready_for_extraction"),
            "ineligible": n("completed_ineligible"),
            "unknown": n("unknown"),
            "unavailable": n("unavailable"),
            "merged": n("merged"),
        }
    else:
        names["extracted"] = n("completed_eligible")
    plan = dispositions.agg(
        F.coalesce(F.sum(F.when(F.col("disposition").isin(*NOT_WORK[stage]), F.col("jobs"))), F.lit(0)).alias("_done"),
        F.coalesce(F.sum(F.when(F.col("disposition") == f"{stage}_retry_waiting", F.col("jobs"))), F.lit(0)).alias("_later"),
    )
    counted = outcomes.groupBy("run_id").agg(*[c.alias(k) for k, c in names.items()])
    entries = [x for k in names for x in (F.lit(k), F.col(k))]
    return counted.crossJoin(F.broadcast(plan)).select(
        "run_id",
        F.create_map(
            *entries,
            F.lit("skipped_completed"), F.col("_done"),
            F.lit("skipped_not_due"), F.col("_later"),
            F.lit("interrupted"), F.lit(reaped).cast("long"),
        ).alias("counts"),
    )


def audit(
    selected: DataFrame,
    jobs: DataFrame,
    sources: DataFrame,
    contents: DataFrame,
    attempts: DataFrame,
    runs: DataFrame,
    decisions: DataFrame,
    results: DataFrame,
) -> DataFrame:
    """Everything stored about the selected jobs, one row per record.

    Columns: job_id, section, section_order, sort_at, record_id, detail (JSON with
    redacted texts). Rows instead of one document per job: the history of a job has no
    bound. Evidence and reasons are redacted, texts and payloads only measured.
    """
    ids = selected.select(F.col("id").alias("job_id")).distinct()

    def section(df: DataFrame, name: str, order: int, at: Column, detail: list[Column]) -> DataFrame:
        return df.join(ids, "job_id", "left_semi").select(
            "job_id",
            F.lit(name).alias("section"),
            F.lit(order).alias("section_order"),
            at.cast("timestamp_ntz").alias("sort_at"),
            F.col("id").cast("long").alias("record_id"),
            F.to_json(F.struct(*detail)).alias("detail"),
        )

    def redacted(raw: str) -> Column:
        return F.when(
            evidence_list(F.col(raw)).isNotNull(),
            F.transform(evidence_list(F.col(raw)), lambda v: redact_message(v)),
        ).otherwise(F.array(F.lit("<invalid evidence>"))).alias(raw.removesuffix("_json"))

    stage = runs.select(
        F.col("id").alias("run_id"), F.col("stage").alias("run_stage"), F.col("trigger").alias("run_trigger")
    )
    with_runs = attempts.join(stage, "run_id", "left")
    own = jobs.withColumn("job_id", F.col("id"))
    sections = [
        section(own, "job", 1, F.col("first_seen_at"), [F.col(c) for c in jobs.columns if c != "attempt_count"]),
        section(sources, "source", 2, F.lit(None), [F.col(c) for c in sources.columns]),
        section(
            contents,
            "content",
            3,
            F.col("retrieved_at"),
            [F.col(c) for c in contents.columns if c not in ("text", "jsonld_json")]
            + [F.length("text").alias("text_chars"), F.col("jsonld_json").isNotNull().alias("has_jsonld")],
        ),
        section(
            with_runs,
            "attempt",
            4,
            F.col("started_at"),
            [F.col(c) for c in attempts.columns]
            + [
                F.coalesce("run_stage", F.lit("unknown")).alias("run_stage"),
                F.coalesce("run_trigger", F.lit("unknown")).alias("run_trigger"),
            ],
        ),
        section(
            decisions,
            "decision",
            5,
            F.col("decided_at"),
            [
                F.col(c)
                for c in decisions.columns
                if c not in ("reason", "supporting_evidence_json", "conflicting_evidence_json")
            ]
            + [
                redact_message("reason").alias("reason"),
                redacted("supporting_evidence_json"),
                redacted("conflicting_evidence_json"),
            ],
        ),
        section(results, "result", 6, F.col("accepted_at"), [F.col(c) for c in results.columns]),
    ]
    report = sections[0]
    for more in sections[1:]:
        report = report.unionByName(more)
    return report.orderBy("job_id", "section_order", "sort_at", "record_id")
