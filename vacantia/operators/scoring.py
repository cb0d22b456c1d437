"""Scoring of recorded answers against reviewed labels: metrics, gates, comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import text as tx
from vacantia.operators import phrases
from vacantia.operators.reports import micro_rounded
from vacantia.schemas import DECISIONS

MIN_GROUNDING_RATE = 0.99
MAX_EVIDENCE_CHARACTERS = 300
PARTITIONS = ("development", "exposed_regression", "blind")
ROLES = ("supporting", "conflicting", "either")
METADATA_THRESHOLDS = {
    "title": 1.0,
    "work_mode": 0.9,
    "employment_type": 0.9,
    "experience_level": 0.9,
}
# Lowest accepted precision and recall per list.
LIST_THRESHOLDS = {
    "responsibilities": (0.9, 0.9),
    "required_qualifications": (0.9, 0.9),
    "preferred_qualifications": (0.0, 0.85),
    "benefits": (0.0, 0.85),
    "technologies": (0.9, 0.9),
}


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, and 1 when there is nothing to measure."""
    return F.when(whole == 0, F.lit(1.0)).otherwise(part / F.nullif(whole, F.lit(0)))


def confusion(calls: DataFrame) -> DataFrame:
    """Expected decision by actual decision, with calls that gave none under ``error``."""
    actual = F.when(F.col("status") == "grounded", F.col("decision")).otherwise("error")
    return (
        calls.withColumn("actual", actual)
        .groupBy("expected_decision")
        .pivot("actual", [*DECISIONS, "error"])
        .agg(F.count(F.lit(1)))
        .na.fill(0)
    )


def macro_f1(calls: DataFrame) -> DataFrame:
    """One row: mean F1 over the decisions that are expected or given at all."""
    total = calls.agg(*_class_counts())
    return total.select(_macro_f1_from(total.columns).alias("macro_f1"))


def _class_counts() -> list[Column]:
    counts = []
    for d in DECISIONS:
        wanted = F.coalesce(F.col("expected_decision") == d, F.lit(False))
        given = F.coalesce(F.col("decision") == d, F.lit(False))
        counts += [
            F.count_if(wanted & given).alias(f"tp_{d}"),
            F.count_if(~wanted & given).alias(f"fp_{d}"),
            F.count_if(wanted & ~given).alias(f"fn_{d}"),
        ]
    return counts


def _macro_f1_from(_columns) -> Column:
    scores = []
    for d in DECISIONS:
        tp, fp, fn = (F.col(f"{k}_{d}") for k in ("tp", "fp", "fn"))
        precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
        both = precision + recall
        f1 = F.when(both == 0, F.lit(0.0)).otherwise(2 * precision * recall / F.nullif(both, F.lit(0.0)))
        scores.append(F.when(tp + fp + fn > 0, f1))
    present = F.array_compact(F.array(*scores))
    total = F.aggregate(present, F.lit(0.0), lambda acc, s: acc + s)
    return F.when(F.size(present) == 0, F.lit(1.0)).otherwise(
        total / F.nullif(F.size(present), F.lit(0))
    )


def case_agreement(calls: DataFrame) -> DataFrame:
    """Per case: calls, unanimity, and whether an unstable result would be unsafe.

    Needs case_id, status, decision, expected_decision, has_pairs.
    """
    return calls.groupBy("case_id").agg(
        F.count("*").alias("calls"),
        (
            F.bool_and(F.col("status") == "grounded")
            & F.coalesce(F.min("decision") == F.max("decision"), F.lit(False))
        ).alias("unanimous"),
        F.bool_or((F.col("expected_decision") != "eligible") | F.col("has_pairs")).alias("safety_critical"),
    )


def scope_metrics(calls: DataFrame, obligations: DataFrame, met: DataFrame) -> DataFrame:
    """One row of evaluation metrics.

    *calls*: case_id, replay, status, decision, expected_decision, has_pairs,
    evidence_agreement. *obligations*: case_id, obligation_id, critical. *met*: case_id,
    replay, obligation_id. Critical recall counts grounded calls only.
    """
    correct = (F.col("status") == "grounded") & (F.col("decision") == F.col("expected_decision"))
    totals = calls.agg(
        F.count("*").alias("calls"),
        F.count_if(~F.col("status").isin("invalid_response", "error")).alias("schema_valid"),
        F.count_if(F.col("status").isin("grounded", "ungrounded")).alias("consistent"),
        F.count_if(F.col("status") == "grounded").alias("grounded"),
        F.count_if(correct).alias("decision_agreement"),
        F.count_if(correct & F.col("evidence_agreement")).alias("exact_agreement"),
        F.count_if((F.col("expected_decision") != "eligible") & (F.col("decision") == "eligible")).alias(
            "false_eligible"
        ),
        F.count_if((F.col("expected_decision") == "eligible") & (F.col("decision") == "ineligible")).alias(
            "wrongful_ineligible"
        ),
        *_class_counts(),
    )
    cases = case_agreement(calls).agg(
        F.count("*").alias("case_count"),
        F.count_if("unanimous").alias("unanimous_cases"),
        F.count_if(F.col("safety_critical") & ~F.col("unanimous")).alias("unstable_safety_cases"),
    )
    critical = (
        calls.filter("status = 'grounded'")
        .select("case_id", "replay")
        .join(obligations.filter("critical").select("case_id", "obligation_id"), "case_id")
        .join(
            met.select("case_id", "replay", "obligation_id", F.lit(True).alias("_met")),
            ["case_id", "replay", "obligation_id"],
            "left",
        )
        .agg(F.count("*").alias("critical_total"), F.count_if("_met").alias("critical_hits"))
    )
    # Three one-row tables side by side.
    joined = totals.crossJoin(F.broadcast(cases)).crossJoin(F.broadcast(critical))
    return joined.select(
        "calls",
        "schema_valid",
        "consistent",
        "grounded",
        "decision_agreement",
        "exact_agreement",
        "false_eligible",
        "wrongful_ineligible",
        "case_count",
        "unanimous_cases",
        "unstable_safety_cases",
        "critical_total",
        "critical_hits",
        F.round(_macro_f1_from(None), 9).alias("macro_f1"),
    )


def gates(metrics: DataFrame, profile: str) -> DataFrame:
    """Named checks of a metrics row for a profile: gate, passed. ``report`` has none."""
    m = F.col
    checks: dict[str, Column] = {}
    if profile != "report":
        checks = {
            "grounding": (m("calls") > 0) & (ratio(m("grounded"), m("calls")) >= MIN_GROUNDING_RATE),
            "false_eligible": m("false_eligible") == 0,
            "wrongful_ineligible": m("wrongful_ineligible") == 0,
            "critical_evidence_recall": m("critical_hits") == m("critical_total"),
            "safety_case_stability": m("unstable_safety_cases") == 0,
        }
    if profile == "development":
        checks |= {
            "schema_valid": m("schema_valid") == m("calls"),
            "structural_consistency": m("consistent") == m("calls"),
            "decision_macro_f1": m("macro_f1") >= 0.9,
            "decision_evidence_role_agreement": ratio(m("exact_agreement"), m("calls")) >= 0.9,
            "unanimous_cases": ratio(m("unanimous_cases"), m("case_count")) >= 0.9,
        }
    elif profile == "blind":
        checks["decision_agreement"] = ratio(m("decision_agreement"), m("calls")) >= 0.9
    rows = F.array(
        *[F.struct(F.lit(name).alias("gate"), check.alias("passed")) for name, check in checks.items()]
    )
    if not checks:
        rows = F.array().cast("array<struct<gate:string,passed:boolean>>")
    return metrics.select(F.explode(rows).alias("_g")).select("_g.*")


def divergent_calls(calls: DataFrame) -> DataFrame:
    """Calls to look at, by case and replay: not unanimous, wrong, or evidence missed."""
    cases = case_agreement(calls).select("case_id", "unanimous")
    correct = F.coalesce(
        (F.col("status") == "grounded") & (F.col("decision") == F.col("expected_decision")), F.lit(False)
    )
    return (
        calls.join(cases, "case_id")
        .filter(~F.col("unanimous") | ~correct | ~F.col("evidence_agreement"))
        .select("case_id", "replay", "status", "decision", "expected_decision")
        .orderBy("case_id", "replay")
    )


def evidence_agreement(
    calls: DataFrame, obligations: DataFrame, met: DataFrame, split: DataFrame
) -> DataFrame:
    """Add *evidence_agreement*: all obligations met and pairs split, or both say nothing.

    *calls* needs missing_information (of the answer) and case_missing (of the case).
    """
    wanted = obligations.groupBy("case_id").agg(F.count("*").alias("_wanted"))
    done = met.groupBy("case_id", "replay").agg(F.count("*").alias("_met"))
    agreed = F.when(F.col("case_missing"), F.col("missing_information")).otherwise(
        F.coalesce("pairs_satisfied", F.lit(True))
        & (F.coalesce("_met", F.lit(0)) == F.coalesce("_wanted", F.lit(0)))
    )
    return (
        calls.join(wanted, "case_id", "left")
        .join(done, ["case_id", "replay"], "left")
        .join(split, ["case_id", "replay"], "left")
        .withColumn(
            "pairs_satisfied",
            F.coalesce("pairs_satisfied", ~F.col("has_pairs")),
        )
        .withColumn("evidence_agreement", (F.col("status") == "grounded") & agreed)
        .drop("_wanted", "_met", "pairs_satisfied")
    )


def usage_totals(rows: DataFrame, input_price: float, output_price: float) -> DataFrame:
    """Token and latency totals, means over measured rows, and the estimated cost."""
    prompt = F.coalesce(F.sum("prompt_tokens"), F.lit(0))
    completion = F.coalesce(F.sum("completion_tokens"), F.lit(0))
    return rows.agg(
        F.count("*").alias("calls"),
        prompt.alias("prompt_tokens"),
        completion.alias("completion_tokens"),
        F.count("prompt_tokens").alias("prompt_measured"),
        F.round(F.avg("prompt_tokens"), 2).alias("prompt_mean"),
        F.coalesce(F.sum("latency_ms"), F.lit(0)).alias("latency_ms_total"),
        F.round(F.coalesce(F.sum("latency_ms") / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)), 1).alias(
            "latency_ms_mean"
        ),
        micro_rounded((prompt * input_price + completion * output_price) / 1000000.0).alias("estimated_cost"),
    )


def outcome_label() -> Column:
    """Label of a replay call: decision and counts when grounded, else its status."""
    counts = F.when(F.col("missing_information"), "missing_information").otherwise(
        F.concat(
            F.lit("s"), F.col("supporting_count").cast("string"), F.lit("c"), F.col("conflicting_count").cast("string")
        )
    )
    return F.when(
        F.col("status") == "grounded", F.concat(F.col("decision"), F.lit("/"), counts)
    ).otherwise(F.col("status"))


def distribution(calls: DataFrame, keys: list[str], label: str = "label") -> DataFrame:
    """Sorted ``label: count`` text per key; counted first, so lists hold labels only."""
    counted = calls.groupBy(*keys, label).agg(F.count("*").alias("_n"))
    return counted.groupBy(*keys).agg(
        F.array_join(
            F.sort_array(
                F.collect_list(F.concat(F.col(label), F.lit(": "), F.col("_n").cast("string")))
            ),
            ", ",
        ).alias("distribution")
    )


def compare_recordings(postings: DataFrame, calls: DataFrame) -> DataFrame:
    """Two recordings side by side: one row per *side*.

    *postings*: side, job_id, accepted_decision; *calls*: side, job_id, status, decision,
    prompt_tokens, completion_tokens, latency_ms.
    """
    accepted = postings.select("side", "job_id", "accepted_decision").distinct()
    joined = calls.join(accepted, ["side", "job_id"], "left")
    grounded = F.col("status") == "grounded"
    compared = grounded & F.col("accepted_decision").isNotNull()

    def mean(name: str) -> list[Column]:
        return [F.round(F.avg(name), 2).alias(f"{name}_mean"), F.count(name).alias(f"{name}_measured")]

    return joined.groupBy("side").agg(
        F.count("*").alias("calls"),
        *[
            F.count_if(F.col("status") == s).alias(s)
            for s in ("grounded", "ungrounded", "inconsistent", "model_error", "invalid_response")
        ],
        F.count_if(compared & (F.col("decision") == F.col("accepted_decision"))).alias("agreed"),
        F.count_if(compared).alias("compared"),
        *mean("prompt_tokens"),
        *mean("completion_tokens"),
        *mean("latency_ms"),
    )


def count_misses(misses: DataFrame) -> DataFrame:
    """Grounding misses by side, path and reason."""
    return misses.groupBy("side", "path", "reason").agg(F.count("*").alias("misses"))


def count_structural_errors(calls: DataFrame) -> DataFrame:
    """Structural errors by side and kind; a leading path is dropped from the kind."""
    kind = F.regexp_replace(F.col("_e"), r"^\$\.\S* ", "")
    return (
        calls.select("side", F.explode("structural_errors").alias("_e"))
        .groupBy("side", kind.alias("kind"))
        .agg(F.count("*").alias("errors"))
    )


def grid_problems(postings: DataFrame, calls: DataFrame, replays: int) -> DataFrame:
    """Missing, extra and repeated (job_id, replay) cells of a recording."""
    grid = postings.select("job_id").distinct().select(
        "job_id", F.explode(F.sequence(F.lit(1), F.lit(replays))).alias("replay")
    )
    counted = calls.groupBy("job_id", "replay").agg(F.count("*").alias("_n"))
    joined = grid.withColumn("_g", F.lit(True)).join(counted, ["job_id", "replay"], "full")
    problem = (
        F.when(F.col("_n").isNull(), "missing").when(F.col("_g").isNull(), "extra").when(F.col("_n") > 1, "repeated")
    )
    return joined.select("job_id", "replay", problem.alias("problem")).filter("problem is not null")


def recording_differences(baseline: DataFrame, new: DataFrame) -> DataFrame:
    """Jobs on which two recordings may not be compared, with the reason."""
    names = ["content_id", "content_hash", "accepted_decision", "accepted_prompt_hash"]
    left = baseline.select("job_id", F.struct(*names).alias("a"))
    right = new.select("job_id", F.struct(*names).alias("b"))
    joined = left.join(right, "job_id", "full")

    def differs(*fields: str) -> Column:
        result = F.lit(False)
        for f in fields:
            result = result | ~F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}"))
        return result

    problem = (
        F.when(F.col("a").isNull() | F.col("b").isNull(), "jobs_differ")
        .when(differs("content_id", "content_hash"), "content_differs")
        .when(differs("accepted_decision", "accepted_prompt_hash"), "acceptance_differs")
    )
    return joined.select("job_id", problem.alias("problem")).filter("problem is not null")


def list_rates(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Precision and recall per field of exploded (case_id, field, item) lists.

    Items compare folded and trimmed, once per case.
    """
    def keyed(df: DataFrame) -> DataFrame:
        return df.select("case_id", "field", tx.collapse_ends(tx.fold("item")).alias("item")).distinct()

    both = keyed(expected).withColumn("_e", F.lit(1)).join(
        keyed(actual).withColumn("_a", F.lit(1)), ["case_id", "field", "item"], "full"
    )
    counts = both.groupBy("field").agg(
        F.count_if(F.col("_e").isNotNull() & F.col("_a").isNotNull()).alias("matched"),
        F.count("_a").alias("predicted"),
        F.count("_e").alias("wanted"),
    )
    limits = F.create_map(
        *[
            x
            for name, (p, r) in LIST_THRESHOLDS.items()
            for x in (F.lit(name), F.struct(F.lit(p).alias("p"), F.lit(r).alias("r")))
        ]
    )
    limit = F.try_element_at(limits, F.col("field"))
    rated = counts.withColumn("precision", ratio(F.col("matched"), F.col("predicted"))).withColumn(
        "recall", ratio(F.col("matched"), F.col("wanted"))
    )
    return rated.withColumn(
        "accepted",
        (F.col("precision") >= F.coalesce(limit["p"], F.lit(0.0)))
        & (F.col("recall") >= F.coalesce(limit["r"], F.lit(0.0))),
    )


def metadata_rates(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Share of exact matches per coded field; *expected*, *actual*: case_id, field, value."""
    key = lambda c: tx.collapse_ends(tx.fold(F.coalesce(F.col(c), F.lit("null"))))
    left = expected.select("case_id", "field", key("value").alias("_e"))
    right = actual.select("case_id", "field", key("value").alias("_a"))
    limits = F.create_map(*[x for n, v in METADATA_THRESHOLDS.items() for x in (F.lit(n), F.lit(v))])
    counts = (
        left.join(right, ["case_id", "field"], "left")
        .groupBy("field")
        .agg(F.count("*").alias("total"), F.count_if(F.col("_e") == F.col("_a")).alias("matches"))
    )
    return counts.withColumn("exact", ratio(F.col("matches"), F.col("total"))).withColumn(
        "accepted",
        F.col("exact") >= F.coalesce(F.try_element_at(limits, F.col("field")), F.lit(0.0)),
    )



def case_violations(cases: DataFrame) -> DataFrame:
    """Broken rules of evaluation cases: case_id, rule, detail.

    *cases*: case_id, content, decision (struct of the expected decision file) and
    evidence (struct of the expected evidence file, null when there is none).
    """
    d, e = F.col("decision"), F.col("evidence")
    source_hash = F.sha2("content", 256)

    def bad(condition: Column, rule: str, detail: Column | None = None) -> Column:
        return F.when(
            F.coalesce(condition, F.lit(True)),
            F.struct(
                F.lit(rule).alias("rule"),
                (detail if detail is not None else F.lit(None).cast("string")).alias("detail"),
            ),
        )

    has = e.isNotNull()
    wrong_id = F.exists(
        F.transform(
            e["obligations"],
            lambda o, i: o["obligation_id"]
            != F.concat(F.col("case_id"), F.lit("-E"), F.lpad((i + 1).cast("string"), 2, "0")),
        ),
        lambda v: v,
    )
    either = F.transform(
        F.filter(e["obligations"], lambda o: o["role"] == "either"), lambda o: o["obligation_id"]
    )
    cited = F.flatten(F.transform(e["obligations"], lambda o: o["excerpt_alternatives"]))
    empty = F.size(e["obligations"]) == 0
    flags = F.array_compact(
        F.array(
            bad(d["schema_version"] != 1, "decision: schema version"),
            bad(d["case_id"] != F.col("case_id"), "decision: case id", d["case_id"]),
            bad(~d["reviewed"], "decision: not reviewed"),
            bad(~d["partition"].isin(*PARTITIONS), "decision: partition", d["partition"]),
            bad(d["source_content_sha256"] != source_hash, "decision: content hash"),
            bad(~d["decision"].isin(*DECISIONS), "decision: value", d["decision"]),
            bad(
                (F.size(d["must_cite"]) < 1) | F.exists(d["must_cite"], lambda v: ~v.rlike(r"\S")),
                "decision: must_cite",
            ),
            F.when(~has, bad(d["partition"] == "blind", "blind case lacks obligations")),
            F.when(has, bad(e["schema_version"] != 1, "evidence: schema version")),
            F.when(has, bad(e["case_id"] != F.col("case_id"), "evidence: case id", e["case_id"])),
            F.when(has, bad(e["partition"] != d["partition"], "evidence: partition", e["partition"])),
            F.when(has, bad(e["source_content_sha256"] != source_hash, "evidence: content hash")),
            F.when(has, bad(e["decision"] != d["decision"], "evidence: decision", e["decision"])),
            F.when(
                has,
                bad(
                    e["review_status"]
                    != F.when(e["reviewed"], "reviewed").otherwise("pending_operator_review"),
                    "evidence: review status",
                    e["review_status"],
                ),
            ),
            F.when(has, bad(wrong_id, "evidence: obligation ids are not in order")),
            F.when(
                has,
                bad(F.exists(e["obligations"], lambda o: ~o["role"].isin(*ROLES)), "evidence: role"),
            ),
            F.when(
                has,
                bad(
                    F.exists(
                        e["obligations"], lambda o: F.coalesce(F.size(o["excerpt_alternatives"]), F.lit(0)) < 1
                    )
                    | F.exists(
                        cited, lambda q: ~q.rlike(r"\S") | (F.length(q) > MAX_EVIDENCE_CHARACTERS)
                    ),
                    "evidence: excerpt alternatives",
                ),
            ),
            F.when(
                has,
                bad(
                    F.exists(
                        e["conflict_pairs"],
                        lambda p: (F.size(p) != 2)
                        | (F.try_element_at(p, F.lit(1)) == F.try_element_at(p, F.lit(2)))
                        | (F.size(F.array_except(p, either)) > 0),
                    ),
                    "evidence: conflict pairs",
                ),
            ),
            F.when(
                has,
                bad(
                    (e["missing_information"] != empty)
                    | (e["missing_information"] & (d["decision"] != "unknown")),
                    "evidence: missing information",
                ),
            ),
            F.when(
                has & ~e["missing_information"],
                bad(F.size(F.array_except(d["must_cite"], cited)) > 0, "evidence: drops a must_cite quote"),
            ),
            F.when(
                has & (F.size(e["conflict_pairs"]) > 0),
                bad(d["decision"] != "unknown", "evidence: conflict pairs require unknown"),
            ),
        )
    )
    shaped = cases.select("case_id", F.explode(flags).alias("_f")).select("case_id", "_f.*")
    quotes = cases.select(
        "case_id", F.explode(F.coalesce(cited, d["must_cite"])).alias("quote")
    )
    located = phrases.bound_quotes(quotes, cases.select("case_id", F.col("content").alias("text")), "case_id")
    ungrounded = located.filter(~F.col("found")).select(
        "case_id", F.lit("quote is not grounded").alias("rule"), F.col("quote").alias("detail")
    )
    return shaped.unionByName(ungrounded)
