"""Queries over file sources: each is written from the given tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacantia.operators import answers, content
from vacantia.session import scratch_folder
from vacantia.sources import sinks, tables
from vacantia.workloads.base import query


@query(
    "catalog_entries",
    """SELECT s_name AS name, regexp_replace(regexp_replace(lower(s_name), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS slug,
      'https://careers.example/' || s_suppkey AS job_board_url, CASE WHEN s_nationkey < 12 THEN s_nationkey::INT END AS min_depth FROM supplier""",
)
def catalog_entries(t):
    path = f"{scratch_folder(t.spark)}/catalog"
    rule = F.when(F.col("s_nationkey") < 12, F.struct(F.col("s_nationkey").cast("int").alias("min_depth")))
    t.supplier.select(
        F.col("s_name").alias("name"),
        F.concat(F.lit("https://careers.example/"), "s_suppkey").alias("job_board_url"),
        F.lit("dom").alias("strategy"),
        rule.alias("link_rule"),
    ).write.json(path)
    return tables.catalog(t.spark, path).select("name", "slug", "job_board_url", F.col("link_rule.min_depth").alias("min_depth"))


@query(
    "snapshot_of_urls",
    """SELECT company_slug, url, min(ord) AS ord FROM (
      SELECT source AS company_slug, 'https://x.example/' || n_chars AS url, doc_id::BIGINT AS ord FROM documents WHERE source IS NOT NULL)
    GROUP BY 1, 2""",
)
def snapshot_of_urls(t):
    batch = t.documents.filter("source is not null").select(
        F.col("source").alias("company_slug"),
        F.concat(F.lit("https://x.example/"), "n_chars").alias("url"),
        F.col("doc_id").cast("long").alias("ord"),
    )
    none = batch.filter("false").withColumn("captured_at", F.lit(None).cast("timestamp_ntz"))
    path = f"{scratch_folder(t.spark)}/urls"
    version = sinks.replaced_snapshot(none, batch, batch.select("company_slug"), "2024-01-01")
    sinks.write_version(version, path, "company_slug")
    return tables.url_snapshot(t.spark, path).select("company_slug", "url", "ord")


def cases(t):
    """A case per labelled document; every seventh states a hash that is not its own."""
    own = F.sha2(F.coalesce("text", F.lit("")), 256)
    digest = F.when(F.col("doc_id") % 7 == 0, F.sha2(F.lit("other"), 256)).otherwise(own)
    case = F.concat(F.lit("c"), F.col("doc_id").cast("string"))
    common = [F.lit(1).alias("schema_version"), case.alias("case_id"), F.lit(True).alias("reviewed"), digest.alias("source_content_sha256")]
    decision = F.when(F.col("toxic") == 1, "ineligible").when(F.col("quality") == 1, "eligible").otherwise("unknown")
    cites = F.array(F.substring_index("text", "\n", 1)).alias("must_cite")
    evidence = F.when(F.col("quality") == 1, F.struct(*common, decision.alias("decision")))
    return t.documents.join(t.labels, "doc_id").select(
        case.alias("case_id"),
        F.col("text").alias("content"),
        F.struct(*common, decision.alias("decision"), cites).alias("decision"),
        evidence.alias("evidence"),
    )


SQL_CASES = """
cases AS (
  SELECT 'c' || doc_id AS case_id, coalesce(text, '') AS content, doc_id % 7 <> 0 AS own_hash, quality = 1 AS has_evidence,
    CASE WHEN toxic = 1 THEN 'ineligible' WHEN quality = 1 THEN 'eligible' ELSE 'unknown' END AS decision
  FROM documents JOIN labels USING (doc_id)
)"""


@query(
    "evaluation_cases",
    f"""WITH {SQL_CASES} SELECT case_id, sha256(content) AS content_sha256, own_hash, decision, coalesce(has_evidence, false) AS has_evidence FROM cases""",
)
def evaluation_cases(t):
    path = scratch_folder(t.spark)
    sinks.write_cases(cases(t), path)
    digest = F.sha2("content", 256)
    return tables.evaluation_cases(t.spark, path, stored=True).select(
        "case_id",
        digest.alias("content_sha256"),
        (F.col("decision.source_content_sha256") == digest).alias("own_hash"),
        F.col("decision.decision").alias("decision"),
        F.col("evidence.case_id").isNotNull().alias("has_evidence"),
    )


@query(
    "recorded_answers",
    f"""WITH {SQL_CASES} SELECT case_id, CASE WHEN own_hash THEN 'usable' ELSE 'rejected' END AS state,
      CASE WHEN own_hash THEN decision END AS decision FROM cases""",
)
def recorded_answers(t):
    held = cases(t)
    path = scratch_folder(t.spark)
    fields = {
        "model": F.lit("m"),
        "eligibility_prompt_hash": F.lit("h"),
        "case_id": F.col("case_id"),
        "source_hash": F.col("decision.source_content_sha256"),
        "replay": F.lit(1),
        "reasoning_effort": F.lit(None).cast("string"),
    }
    raw = F.to_json(
        F.struct(
            F.col("decision.decision").alias("decision"),
            F.lit("r").alias("reason"),
            F.array(F.lit("q")).alias("supporting_evidence"),
            F.array().cast("array<string>").alias("conflicting_evidence"),
        )
    )
    recorded = held.select(
        answers.request_key(**fields).alias("file_key"),
        answers.request_key(**fields).alias("key"),
        F.lit(3).alias("recording_version"),
        F.lit("m").alias("requested_model"),
        F.lit("h").alias("eligibility_prompt_hash"),
        "case_id",
        F.col("decision.source_content_sha256").alias("source_content_sha256"),
        F.lit(1).alias("replay"),
        F.lit("parsed").alias("status"),
        raw.alias("raw_json"),
        F.lit(5).alias("latency_ms"),
    )
    sinks.write_keyed(recorded, "file_key", path, "recordings.json")
    read = tables.recordings(t.spark, path, stored=True)
    known = held.select("case_id", F.coalesce("content", F.lit("")).alias("content"))
    good, bad = tables.usable_recordings(read, known, "m", "h")
    return good.select("case_id", F.lit("usable").alias("state"), F.col("answer.decision").alias("decision")).unionByName(
        bad.select("case_id", F.lit("rejected").alias("state"), F.lit(None).cast("string").alias("decision"))
    )


@query(
    "board_snapshot_pages",
    """SELECT 's' || s_suppkey AS slug, 'page.html' AS file, 'https://b.example/' || s_nationkey AS url FROM supplier WHERE s_suppkey % 3 = 0
    UNION ALL SELECT 's' || s_suppkey, f, u FROM supplier, (VALUES ('s.html', 'u'), ('f.html', 'v')) x(f, u) WHERE s_suppkey % 3 <> 0""",
)
def board_snapshot_pages(t):
    files = F.array(F.struct(F.lit("f.html").alias("file"), F.lit("v").alias("url")))
    states = F.array(F.struct(F.lit("s.html").alias("file"), F.lit("u").alias("url"), files.alias("frames")))
    boards = t.supplier.select(
        F.concat(F.lit("s"), "s_suppkey").alias("slug"),
        F.col("s_name").alias("company_name"),
        F.concat(F.lit("https://b.example/"), "s_nationkey").alias("job_board_url"),
        F.lit("https://b.example/1").alias("sample_job_url"),
        F.lit(2).alias("expected_unfiltered_count"),
        F.when(F.col("s_suppkey") % 3 != 0, states).alias("states"),
    )
    path = scratch_folder(t.spark)
    sinks.write_keyed(boards, "slug", path, "metadata.json")
    return tables.snapshot_pages(tables.board_snapshots(t.spark, path, stored=True))


@query(
    "best_posting_of_each",
    """SELECT conv_id, turn, length(text)::BIGINT AS chars FROM conversations
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY length(text) DESC NULLS LAST, turn, role, text) = 1""",
)
def best_posting_of_each(t):
    """Turns stand in for the postings of a page."""
    posting = F.struct("turn", "role", F.col("text").alias("description_text"))
    pages = t.conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(posting)).alias("postings"))
    best = pages.select("conv_id", content.best_posting(F.col("postings")).alias("b"))
    return best.select("conv_id", "b.turn", F.length("b.description_text").cast("long").alias("chars"))


@query(
    "stored_quotes",
    r"""WITH d AS (
      SELECT doc_id AS id, 'supporting_evidence' AS bucket, string_split(text, chr(10))[1:2] AS quotes FROM documents
      UNION ALL SELECT doc_id, 'conflicting_evidence', CASE WHEN doc_id % 3 = 0 THEN ['a', 'b'] WHEN doc_id % 3 = 1 THEN []::VARCHAR[] END FROM documents),
    e AS (SELECT *, quotes IS NOT NULL AND len(list_filter(quotes, lambda q: NOT regexp_matches(q, '\S'))) = 0 AS good FROM d)
    SELECT id, bucket, (p - 1)::INT AS position, quotes[p] AS quote FROM e, unnest(range(1, len(quotes) + 1)) u(p) WHERE good
    UNION ALL SELECT id, bucket, NULL, NULL FROM e WHERE NOT good""",
)
def stored_quotes(t):
    lines = F.slice(F.split("text", "\n"), 1, 2)
    held = t.documents.select(
        F.col("doc_id").alias("id"),
        F.col("doc_id").alias("job_id"),
        F.col("doc_id").alias("content_id"),
        F.to_json(lines).alias("supporting_evidence_json"),
        F.when(F.col("doc_id") % 3 == 0, '["a","b"]').when(F.col("doc_id") % 3 == 1, "[]").otherwise('{"a": 1}').alias(
            "conflicting_evidence_json"
        ),
    )
    quotes, bad = answers.stored_quotes(held)
    none = bad.select("id", "bucket", F.lit(None).cast("int").alias("position"), F.lit(None).cast("string").alias("quote"))
    return quotes.select("id", "bucket", "position", "quote").unionByName(none)
