"""Recorded answers: shape and structure rules, requests, keys, verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import text as tx
from vacantia.operators import phrases
from vacantia.schemas import ANSWER, DECISIONS

# Fixed values of the answer contract.
MAX_EVIDENCE_ITEMS = 5
MAX_EVIDENCE_CHARACTERS = 300
MAX_REASON_CHARACTERS = 240
MISSING_INFORMATION_REASON = (
    "The posting states no role location, work arrangement, residence, "
    "or work authorization requirement."
)
BUCKETS = ("supporting_evidence", "conflicting_evidence")


def _flags(*rules: tuple[Column, str | Column]) -> Column:
    """Names of the rules that are broken, in order."""
    return F.array_compact(
        F.array(
            *[
                F.when(F.coalesce(broken, F.lit(True)), F.lit(name) if isinstance(name, str) else name)
                for broken, name in rules
            ]
        )
    )


def parse_answers(df: DataFrame, raw: str = "raw_json") -> DataFrame:
    """Add the typed answer; *parsed* is false when the text is not such an object.

    Unknown fields make an answer invalid, as do fields of another type.
    """
    tree = F.try_parse_json(raw)
    shape = F.schema_of_variant(tree)
    keys = F.json_object_keys(raw)
    strict = (
        F.startswith(shape, F.lit("OBJECT"))
        & (F.size(F.array_except(keys, tx.fixed_strings(ANSWER.names))) == 0)
        & (F.size(keys) == len(ANSWER.names))
        & (F.schema_of_variant(F.try_variant_get(tree, "$.decision", "variant")) == "STRING")
        & (F.schema_of_variant(F.try_variant_get(tree, "$.reason", "variant")) == "STRING")
    )
    for bucket in BUCKETS:
        kind = F.schema_of_variant(F.try_variant_get(tree, f"$.{bucket}", "variant"))
        strict = strict & kind.isin("ARRAY<STRING>", "ARRAY<VOID>", "ARRAY<>")
    answer = F.from_json(raw, ANSWER)
    typed = tx.computed(df, "answer", F.when(F.coalesce(strict, F.lit(False)), answer))
    return typed.withColumn("parsed", F.col("answer").isNotNull())


def shape_errors(answer: Column) -> Column:
    """Broken shape rules of an answer, by name."""

    def bucket_rules(name: str):
        items = answer[name]
        return [
            (F.coalesce(F.size(items), F.lit(0)) > MAX_EVIDENCE_ITEMS, f"{name}: too many excerpts"),
            (
                F.coalesce(F.exists(items, lambda v: F.length(v) > MAX_EVIDENCE_CHARACTERS), F.lit(False)),
                f"{name}: excerpt too long",
            ),
            (
                F.coalesce(F.exists(items, lambda v: ~v.rlike(r"\S")), F.lit(False)),
                f"{name}: blank excerpt",
            ),
            (items.isNull() | F.exists(items, lambda v: v.isNull()), f"{name}: missing"),
        ]

    reason = answer["reason"]
    return _flags(
        (~answer["decision"].isin(*DECISIONS), "decision: not allowed"),
        (F.length(reason) > MAX_REASON_CHARACTERS, "reason: too long"),
        (~reason.rlike(r"\A\S[^\r\n]*[.!?]\z"), "reason: not one closed sentence"),
        *bucket_rules("supporting_evidence"),
        *bucket_rules("conflicting_evidence"),
    )


def is_missing_information(answer: Column) -> Column:
    return (
        (answer["decision"] == "unknown")
        & (answer["reason"] == MISSING_INFORMATION_REASON)
        & (F.size(answer["supporting_evidence"]) == 0)
        & (F.size(answer["conflicting_evidence"]) == 0)
    )


def with_structure(df: DataFrame, answer: str = "answer", out: str = "structural_errors") -> DataFrame:
    """Add every structural violation of each answer; an empty list means consistent."""
    keyed = df.withColumn("_s", tx.word_keys(f"{answer}.supporting_evidence")).withColumn(
        "_c", tx.word_keys(f"{answer}.conflicting_evidence")
    )
    a = F.col(answer)
    empty = F.size(a["supporting_evidence"]) == 0
    canonical = a["reason"] == MISSING_INFORMATION_REASON
    both = F.filter(
        F.transform(
            F.col("_c"),
            lambda key, i: F.when(
                F.array_contains(F.col("_s"), key),
                F.concat(
                    F.lit("$.conflicting_evidence["),
                    i.cast("string"),
                    F.lit("] in_both"),
                ),
            ),
        ),
        lambda v: v.isNotNull(),
    )
    rules = _flags(
        (empty & (F.size(a["conflicting_evidence"]) > 0), "conflicting_alone"),
        (
            empty & (a["decision"] != "unknown"),
            F.concat(a["decision"], F.lit("_unsupported")),
        ),
        (empty & ~canonical, "empty_unexplained"),
        (~empty & canonical, "explained_not_empty"),
    )
    found = F.when(a.isNotNull(), F.concat(rules, both))
    return tx.computed(keyed, out, found).drop("_s", "_c")


def quotes_of(df: DataFrame, keys: list[str], answer: str = "answer") -> DataFrame:
    """One row per quote: keys, bucket, position, JSON path, quote."""
    stacked = F.concat(
        *[F.transform(F.col(answer)[name], _quote_row(name)) for name in BUCKETS]
    )
    return df.select(*keys, F.explode_outer(stacked).alias("_q")).filter("_q is not null").select(
        *keys,
        F.col("_q.bucket").alias("bucket"),
        F.col("_q.position").alias("position"),
        F.concat(
            F.lit("$."), F.col("_q.bucket"), F.lit("["), F.col("_q.position").cast("string"), F.lit("]")
        ).alias("path"),
        F.col("_q.quote").alias("quote"),
    )


def _quote_row(name: str):
    return lambda quote, i: F.struct(
        F.lit(name).alias("bucket"), i.alias("position"), quote.alias("quote")
    )


def answer_misses(answers: DataFrame, contents: DataFrame, keys: list[str]) -> DataFrame:
    """Grounding misses of answers (columns: keys incl. content_id, answer)."""
    found = phrases.bound_quotes(quotes_of(answers, keys), contents)
    return phrases.grounding_misses(found).withColumn("reason", F.lit("not_in_posting"))


def verdicts(answers: DataFrame, contents: DataFrame, keys: list[str]) -> DataFrame:
    """Accepted form of consistent, grounded answers: quotes become the posting's own text.

    Quotes that fall on the same span are merged, the first place is kept. Answers with a
    miss or a structural error are absent.
    """
    clean = with_structure(answers).filter(F.size("structural_errors") == 0)
    located = phrases.located_quotes(quotes_of(clean, keys), contents)
    merged = located.groupBy(*keys, "bucket", "span_start", "span_end").agg(
        F.min("position").alias("position"),
        F.min_by("excerpt", "position").alias("excerpt"),
        F.bool_and("found").alias("found"),
    )
    # An answer holds at most five quotes per bucket, so these lists are short.
    lists = merged.groupBy(*keys).agg(
        F.bool_and("found").alias("_whole"),
        *[
            F.transform(
                F.sort_array(
                    F.collect_list(F.when(F.col("bucket") == name, F.struct("position", "excerpt")))
                ),
                lambda e: e["excerpt"],
            ).alias(name)
            for name in BUCKETS
        ]
    )
    none = F.array().cast("array<string>")
    return (
        clean.select(*keys, F.col("answer.decision").alias("decision"), F.col("answer.reason").alias("reason"))
        .join(lists, keys, "left")
        .filter(F.coalesce("_whole", F.lit(True)))
        .select(
            *keys, "decision", "reason", *[F.coalesce(F.col(name), none).alias(name) for name in BUCKETS]
        )
    )


def call_statuses(calls: DataFrame, contents: DataFrame, keys: list[str]) -> DataFrame:
    """Status of each recorded call: error, invalid_response, inconsistent, ungrounded, grounded.

    *calls* has the keys, *call_status* (parsed, invalid_response or error) and the
    typed *answer*; content_id must be one of the keys.
    """
    structured = with_structure(calls)
    misses = (
        phrases.bound_quotes(quotes_of(calls, keys), contents)
        .filter(~F.col("found"))
        .groupBy(*keys)
        .agg(F.count("*").alias("missed"))
    )
    joined = structured.join(misses, keys, "left")
    status = (
        F.when(F.col("call_status") == "error", "error")
        .when((F.col("call_status") == "invalid_response") | F.col("answer").isNull(), "invalid_response")
        .when(F.size("structural_errors") > 0, "inconsistent")
        .when(F.coalesce("missed", F.lit(0)) > 0, "ungrounded")
        .otherwise("grounded")
    )
    return (
        joined.withColumn("status", status)
        .withColumn("decision", F.when(F.col("status") == "grounded", F.col("answer.decision")))
        .withColumn("missing_information", F.coalesce(is_missing_information(F.col("answer")), F.lit(False)))
        .withColumn("missed", F.coalesce("missed", F.lit(0)))
    )


def request_key(**fields: Column) -> Column:
    """SHA-256 of compact JSON with sorted keys; null fields are left out."""
    ordered = F.struct(*[fields[name].alias(name) for name in sorted(fields)])
    return F.sha2(F.to_json(ordered), 256)


def model_requests(
    contents: DataFrame, system: str, prefix: str, suffix: str, prompt_hash: str, model: str
) -> DataFrame:
    """Request table of a batch: messages, prompt hash and reuse key per content."""
    messages = F.array(
        F.struct(F.lit("system").alias("role"), F.lit(system).alias("content")),
        F.struct(
            F.lit("user").alias("role"),
            F.concat(F.lit(prefix), F.col("text"), F.lit(suffix)).alias("content"),
        ),
    )
    return contents.select(
        "job_id",
        "content_id",
        F.lit(prompt_hash).alias("prompt_hash"),
        request_key(
            model=F.lit(model),
            prompt_hash=F.lit(prompt_hash),
            messages=messages,
        ).alias("request_key"),
        messages.alias("messages"),
    )


def evidence_list(raw: Column) -> Column:
    """Decoded list of nonblank strings; null when the text is anything else."""
    kind = F.schema_of_variant(F.try_parse_json(raw))
    values = F.from_json(raw, "array<string>")
    good = kind.isin("ARRAY<STRING>", "ARRAY<VOID>", "ARRAY<>") & F.forall(
        values, lambda v: v.isNotNull() & v.rlike(r"\S")
    )
    return F.when(F.coalesce(good, F.lit(False)), values)


def stored_quotes(decisions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Quotes of stored decisions, and rows whose evidence text cannot be read."""
    stacked = [
        decisions.select(
            "id",
            "job_id",
            "content_id",
            F.lit(name).alias("bucket"),
            evidence_list(F.col(f"{name}_json")).alias("quotes"),
        )
        for name in BUCKETS
    ]
    both = stacked[0].unionByName(stacked[1])
    quotes = both.select("id", "job_id", "content_id", "bucket", F.posexplode("quotes").alias("position", "quote"))
    quotes = quotes.withColumn(
        "path", F.concat(F.lit("$."), F.col("bucket"), F.lit("["), F.col("position").cast("string"), F.lit("]"))
    )
    bad = both.filter("quotes is null").select("id", "job_id", "content_id", "bucket")
    return quotes, bad


def replay_shape_violations(calls: DataFrame) -> DataFrame:
    """Broken shape rules of replay records: one row per call and rule."""
    parsed = F.col("status").isin("grounded", "inconsistent", "ungrounded")
    counted = (
        F.col("supporting_count").isNotNull()
        & F.col("conflicting_count").isNotNull()
        & F.col("missing_information").isNotNull()
    )
    path = F.col("raw_response_path")
    rules = _flags(
        ((F.col("status") == "grounded") != F.col("decision").isNotNull(), "decision_without_grounding"),
        (parsed != counted, "counts_without_parse"),
        (
            (F.col("status") == "inconsistent") != (F.coalesce(F.size("structural_errors"), F.lit(0)) > 0),
            "errors_without_inconsistency",
        ),
        (
            (F.col("status") == "ungrounded") != (F.coalesce(F.size("grounding_misses"), F.lit(0)) > 0),
            "misses_without_ungrounded",
        ),
        (
            F.coalesce(path.rlike(r"^/|(?:^|/)\.\.(?:/|$)") | ~path.rlike(r"[^/]\.json$"), F.lit(False)),
            "unsafe_response_path",
        ),
    )
    return calls.select("run_id", "job_id", "replay", F.explode(rules).alias("rule"))
