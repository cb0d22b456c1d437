"""Queries over work plans, attempts, decisions and history versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacantia.functions import urls
from vacantia.operators import checks, content, history, identity, reports
from vacantia.plans import workplan
from vacantia.schemas import JOB_SOURCES, JOBS
from vacantia.session import cut_lineage
from vacantia.workloads.base import query
from vacantia.workloads.url_jobs import SQL_KEYED, keyed_pages

NOW = "1998-06-01 00:00:00"
SQL_NOW = f"TIMESTAMP '{NOW}'"


def _ts(name):
    return F.col(name).cast("timestamp_ntz")


# Orders stand in for jobs: customer as company, status from the order.
SQL_JOBS = """
jobs AS (
  SELECT o_orderkey AS id, 'c' || o_custkey AS company_slug, 'k' || o_orderkey AS url_key,
    CASE o_orderstatus WHEN 'O' THEN 'new' WHEN 'P' THEN 'retry' ELSE
      CASE o_orderpriority WHEN '1-URGENT' THEN 'in_progress' WHEN '2-HIGH' THEN 'ready_for_extraction'
        WHEN '3-MEDIUM' THEN 'unknown' WHEN '4-NOT SPECIFIED' THEN 'unavailable' ELSE 'completed_eligible' END END AS status,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'extraction' ELSE 'fetch' END AS next_phase,
    CASE WHEN o_orderstatus = 'P' THEN o_orderdate END AS next_attempt_after,
    o_totalprice > 400000 AS reprocess_requested, (o_orderkey % 5)::BIGINT AS attempt_count, o_orderdate
  FROM orders
),
keys AS (SELECT DISTINCT j.company_slug, j.url_key FROM jobs j JOIN lineitem ON l_orderkey = id WHERE l_quantity > 45)"""


def jobs(t):
    priority = F.col("o_orderpriority")
    other = (
        F.when(priority == "1-URGENT", "in_progress")
        .when(priority == "2-HIGH", "ready_for_extraction")
        .when(priority == "3-MEDIUM", "unknown")
        .when(priority == "4-NOT SPECIFIED", "unavailable")
        .otherwise("completed_eligible")
    )
    status = (
        F.when(F.col("o_orderstatus") == "O", "new").when(F.col("o_orderstatus") == "P", "retry").otherwise(other)
    )
    held = status == "in_progress"
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("company_slug"),
        F.concat(F.lit("k"), F.col("o_orderkey").cast("string")).alias("url_key"),
        status.alias("status"),
        F.when(priority.isin("1-URGENT", "2-HIGH"), "extraction").otherwise("fetch").alias("next_phase"),
        (F.col("o_orderkey") % 5).cast("long").alias("attempt_count"),
        F.when(F.col("o_orderstatus") == "P", _ts("o_orderdate")).alias("next_attempt_after"),
        F.when(held, F.col("o_orderkey")).alias("current_attempt_id"),
        F.when(held, F.col("o_orderkey")).alias("current_content_id"),
        (F.col("o_totalprice") > 400000).alias("reprocess_requested"),
        F.lit(None).cast("long").alias("merged_into_id"),
        _ts("o_orderdate").alias("first_seen_at"),
        _ts("o_orderdate").alias("last_seen_at"),
        _ts("o_orderdate").alias("updated_at"),
    )


def snapshot_keys(t):
    seen = t.lineitem.filter("l_quantity > 45").select(F.col("l_orderkey").alias("id")).distinct()
    return jobs(t).join(seen, "id", "left_semi").select("company_slug", "url_key")


SQL_CLAIM = f"""NOT reprocess_requested AND (status = 'new' OR (status = 'retry' AND next_phase IN ('fetch', 'eligibility')
  AND next_attempt_after <= {SQL_NOW}))"""
SQL_DISPOSITION = f"""CASE WHEN status = 'retry' THEN CASE WHEN next_phase = 'extraction' THEN 'extraction' ELSE 'eligibility' END
  || '_retry_' || CASE WHEN next_attempt_after <= {SQL_NOW} THEN 'due' ELSE 'waiting' END ELSE status END"""


@query(
    "claimable_jobs",
    f"""WITH {SQL_JOBS} SELECT count(*) FILTER ({SQL_CLAIM}) AS eligibility,
      count(*) FILTER (NOT reprocess_requested AND (status = 'ready_for_extraction'
        OR (status = 'retry' AND next_phase = 'extraction' AND next_attempt_after <= {SQL_NOW}))) AS extraction,
      count(*) FILTER (reprocess_requested AND status = 'retry' AND next_phase <> 'extraction' AND next_attempt_after <= {SQL_NOW}) AS again
    FROM jobs""",
)
def claimable_jobs(t):
    return jobs(t).agg(
        F.count_if(workplan.claimable("eligibility", NOW)).alias("eligibility"),
        F.count_if(workplan.claimable("extraction", NOW)).alias("extraction"),
        F.count_if(workplan.claimable("eligibility", NOW, reprocess=True)).alias("again"),
    )


@query(
    "work_list",
    f"""WITH {SQL_JOBS} SELECT id, company_slug, url_key, status FROM jobs SEMI JOIN keys USING (company_slug, url_key)
    WHERE {SQL_CLAIM} ORDER BY id LIMIT 500""",
)
def work_list(t):
    # The limit is the feature: the first jobs of a batch by id.
    return workplan.work_list(jobs(t), snapshot_keys(t), NOW, "eligibility", limit=500).select(
        "id", "company_slug", "url_key", "status"
    )


@query(
    "stage_dispositions",
    f"""WITH {SQL_JOBS} SELECT {SQL_DISPOSITION} AS disposition, count(*) AS jobs
    FROM jobs SEMI JOIN keys USING (company_slug, url_key) GROUP BY 1""",
)
def stage_dispositions(t):
    return workplan.stage_dispositions(jobs(t), snapshot_keys(t), NOW)


@query(
    "planning_preview",
    f"""WITH {SQL_JOBS}, s AS (SELECT company_slug, {SQL_DISPOSITION} AS label, {SQL_CLAIM} AS e,
        NOT reprocess_requested AND (status = 'ready_for_extraction'
          OR (status = 'retry' AND next_phase = 'extraction' AND next_attempt_after <= {SQL_NOW})) AS x
      FROM jobs SEMI JOIN keys USING (company_slug, url_key)),
    a AS (SELECT company_slug, label, count(*) AS jobs FROM s GROUP BY GROUPING SETS ((company_slug, label), (label)))
    SELECT company_slug, CASE WHEN label IN ('new', 'eligibility_retry_due', 'eligibility_retry_waiting') THEN 'Eligibility work'
        WHEN label IN ('ready_for_extraction', 'extraction_retry_due', 'extraction_retry_waiting') THEN 'Extraction backlog'
        WHEN label = 'in_progress' THEN 'In progress' ELSE 'Terminal dispositions' END AS section, label, jobs FROM a
    UNION ALL SELECT company_slug, 'Would process', 'eligibility', least(count(*) FILTER (coalesce(e, false)), 100) FROM s GROUP BY ROLLUP (company_slug)
    UNION ALL SELECT company_slug, 'Would process', 'extraction', least(count(*) FILTER (coalesce(x, false)), 100) FROM s GROUP BY ROLLUP (company_slug)""",
)
def planning_preview(t):
    return workplan.preview(jobs(t), snapshot_keys(t), NOW, limit=100)


@query(
    "retry_states",
    f"""WITH {SQL_JOBS}, f AS (SELECT id, attempt_count AS n, ['not_found','timeout','internal','closed','model_call','missing_checkpoint','blocked'][(id % 7) + 1] AS c FROM jobs),
    s AS (SELECT *, CASE WHEN c = 'missing_checkpoint' THEN 'failed' WHEN c IN ('not_found', 'closed') THEN 'unavailable'
        WHEN n < CASE WHEN c = 'internal' THEN 2 ELSE 3 END THEN 'retry' ELSE 'failed' END AS status FROM f)
    SELECT id, status, CASE WHEN status = 'retry' THEN {SQL_NOW} + to_days(n::INT) END AS next_attempt_after FROM s""",
)
def retry_states(t):
    names = ("not_found", "timeout", "internal", "closed", "model_call", "missing_checkpoint", "blocked")
    category = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("id") % 7 + 1).cast("int"))
    return jobs(t).select("id", workplan.next_state(category, F.col("attempt_count"), NOW).alias("s")).select("id", "s.*")


@query(
    "checkpoint_problems",
    f"""WITH {SQL_JOBS}, j AS (SELECT id, company_slug, CASE WHEN status = 'in_progress' THEN id END AS current_content_id FROM jobs),
    c AS (SELECT DISTINCT l_orderkey AS content_id, l_orderkey AS job_id FROM lineitem WHERE l_quantity > 30),
    d AS (SELECT l_orderkey AS job_id, min(CASE WHEN l_tax < 0.04 THEN l_orderkey ELSE l_orderkey + 1 END) AS content_id,
          CASE WHEN max(l_discount) > 0.05 THEN 'eligible' ELSE 'unknown' END AS decision FROM lineitem GROUP BY 1)
    SELECT * FROM (SELECT j.id, company_slug, CASE WHEN c.job_id IS NULL THEN 'no_content'
      WHEN d.decision IS NULL OR d.decision <> 'eligible' THEN 'not_eligible'
      WHEN d.content_id <> j.current_content_id THEN 'other_content' END AS problem
    FROM j LEFT JOIN c ON c.content_id = j.current_content_id AND c.job_id = j.id LEFT JOIN d ON d.job_id = j.id) WHERE problem IS NOT NULL""",
)
def checkpoint_problems(t):
    contents = t.lineitem.filter("l_quantity > 30").select(
        F.col("l_orderkey").alias("id"), F.col("l_orderkey").alias("job_id")
    ).distinct()
    decisions = t.lineitem.groupBy(F.col("l_orderkey").alias("job_id")).agg(
        F.min(F.when(F.col("l_tax") < 0.04, F.col("l_orderkey")).otherwise(F.col("l_orderkey") + 1)).alias("content_id"),
        F.when(F.max("l_discount") > 0.05, "eligible").otherwise("unknown").alias("decision"),
    ).withColumn("is_current", F.lit(True))
    return workplan.checkpoint_problems(jobs(t), contents, decisions)


# Events stand in for attempts: user as job, event as outcome, value as tokens.
SQL_ATTEMPTS = """
attempts AS (
  SELECT event_id AS id, user_id AS job_id, strftime(ts, '%Y-%m-%d') AS run_id,
    CASE event_type WHEN 'error' THEN 'failed' WHEN 'click' THEN 'retry' WHEN 'purchase' THEN 'completed_eligible'
      WHEN 'signup' THEN 'ready_for_extraction' END AS outcome,
    CASE event_type WHEN 'error' THEN 'internal' WHEN 'click' THEN 'timeout' END AS error_category,
    CASE WHEN value > 50 THEN 'large' ELSE 'small' END AS model,
    CASE WHEN event_type <> 'view' THEN floor(value * 100)::BIGINT END AS prompt_tokens,
    CASE WHEN event_type <> 'view' THEN floor(value)::BIGINT END AS completion_tokens,
    ts AS started_at, CASE WHEN event_type <> 'view' THEN ts + to_seconds(floor(value)::INT) END AS finished_at
  FROM events
),
runs AS (
  SELECT DISTINCT run_id AS id, CASE WHEN right(run_id, 1) IN ('0','2','4','6','8') THEN 'eligibility' ELSE 'extraction' END AS stage,
    CASE WHEN right(run_id, 1) = '5' THEN 'reprocess' ELSE 'scheduled' END AS trigger FROM attempts
),
people AS (
  SELECT c_custkey AS id, c_mktsegment AS company_slug,
    CASE WHEN c_nationkey < 5 THEN 'merged' ELSE 'new' END AS status FROM customer
)"""


def attempts(t):
    kind = F.col("event_type")
    counted = kind != "view"
    return t.events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("job_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"),
        F.lit("scheduled").alias("trigger"),
        F.when(kind == "error", "failed")
        .when(kind == "click", "retry")
        .when(kind == "purchase", "completed_eligible")
        .when(kind == "signup", "ready_for_extraction")
        .alias("outcome"),
        F.when(kind == "error", "internal").when(kind == "click", "timeout").alias("error_category"),
        F.when(F.col("value") > 50, "large").otherwise("small").alias("model"),
        F.when(counted, F.floor(F.col("value") * 100)).alias("prompt_tokens"),
        F.when(counted, F.floor("value")).alias("completion_tokens"),
        _ts("ts").alias("started_at"),
        F.when(counted, _ts("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.floor("value").cast("decimal(18,6)"))).alias("finished_at"),
    )


def runs(t):
    ids = attempts(t).select(F.col("run_id").alias("id")).distinct()
    last = F.right("id", F.lit(1))
    return ids.select(
        "id",
        F.when(last.isin("0", "2", "4", "6", "8"), "eligibility").otherwise("extraction").alias("stage"),
        F.when(last == "5", "reprocess").otherwise("scheduled").alias("trigger"),
    )


def people(t):
    return t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("company_slug"),
        F.when(F.col("c_nationkey") < 5, "merged").otherwise("new").alias("status"),
        F.lit(None).cast("long").alias("merged_into_id"),
    )


@query("disposition_report", f"WITH {SQL_JOBS} SELECT company_slug, status, count(*) AS jobs FROM jobs GROUP BY 1, 2")
def disposition_report(t):
    return reports.dispositions(jobs(t))


@query(
    "repeated_attempts",
    f"""WITH {SQL_ATTEMPTS} SELECT p.id AS job_id, p.company_slug, p.status, count(*) AS attempts FROM people p
    JOIN attempts a ON a.job_id = p.id GROUP BY 1, 2, 3 HAVING count(*) > 1""",
)
def repeated_attempts(t):
    return reports.repeated_attempts(people(t), attempts(t))


@query(
    "usage_and_cost",
    f"""WITH {SQL_ATTEMPTS}, u AS (
      SELECT 'run' AS cost_scope, run_id AS scope_value, model, count(*) AS attempts, sum(coalesce(prompt_tokens, 0))::BIGINT AS prompt_tokens,
        sum(coalesce(completion_tokens, 0))::BIGINT AS completion_tokens FROM attempts GROUP BY 1, 2, 3
      UNION ALL SELECT 'outcome', coalesce(outcome, 'in_progress'), model, count(*), sum(coalesce(prompt_tokens, 0))::BIGINT,
        sum(coalesce(completion_tokens, 0))::BIGINT FROM attempts GROUP BY 1, 2, 3)
    SELECT cost_scope, scope_value, u.model, attempts, prompt_tokens, completion_tokens, input_usd_per_million, output_usd_per_million,
      round((prompt_tokens * input_usd_per_million + completion_tokens * output_usd_per_million) / 1000000.0, 6) AS estimated_cost_usd
    FROM u LEFT JOIN (SELECT 'large' AS model, max(r_regionkey)::DOUBLE AS input_usd_per_million, 0.5 + max(r_regionkey)::DOUBLE AS output_usd_per_million FROM region) p ON p.model = u.model""",
)
def usage_and_cost(t):
    top = F.max("r_regionkey").cast("double")
    prices = t.region.agg(
        F.lit("large").alias("model"), top.alias("input_usd_per_million"), (top + 0.5).alias("output_usd_per_million")
    )
    return reports.usage_and_cost(attempts(t), prices)


@query(
    "usage_per_stage",
    f"""WITH {SQL_ATTEMPTS} SELECT stage, trigger, model, count(*) AS attempts, sum(coalesce(prompt_tokens, 0))::BIGINT AS prompt_tokens,
      sum(coalesce(completion_tokens, 0))::BIGINT AS completion_tokens FROM attempts a JOIN runs r ON r.id = a.run_id GROUP BY 1, 2, 3""",
)
def usage_per_stage(t):
    return reports.usage_per_stage(attempts(t), runs(t))


@query(
    "run_counts",
    f"""WITH {SQL_ATTEMPTS}, {SQL_JOBS}, p AS (SELECT {SQL_DISPOSITION} AS disposition, count(*) AS jobs FROM jobs GROUP BY 1)
    SELECT run_id, count(*) AS attempted, count(*) FILTER (outcome = 'retry') AS retry, count(*) FILTER (outcome = 'failed') AS failed,
      count(*) FILTER (outcome = 'ready_for_extraction') AS ready, coalesce(sum(prompt_tokens), 0)::BIGINT AS prompt_tokens,
      (SELECT sum(jobs) FROM p WHERE disposition NOT IN ('new', 'eligibility_retry_due', 'eligibility_retry_waiting', 'in_progress'))::BIGINT AS skipped_completed,
      (SELECT sum(jobs) FROM p WHERE disposition = 'eligibility_retry_waiting')::BIGINT AS skipped_not_due
    FROM attempts GROUP BY 1""",
)
def run_counts(t):
    all_jobs = jobs(t)
    plan = workplan.stage_dispositions(all_jobs, all_jobs, NOW)
    counts = reports.run_counts(
        attempts(t).withColumn("status", F.coalesce("outcome", F.lit("in_progress"))), "eligibility", plan
    )
    names = {"attempted": "attempted", "retry": "retry", "failed": "failed", "ready": "ready_for_extraction",
             "prompt_tokens": "prompt_tokens", "skipped_completed": "skipped_completed", "skipped_not_due": "skipped_not_due"}
    return counts.select("run_id", *[F.col("counts")[v].alias(k) for k, v in names.items()])


@query(
    "latest_attempts",
    f"""WITH {SQL_ATTEMPTS} SELECT run_id, job_id, max(id) AS id, arg_max(model, id) AS model FROM attempts GROUP BY 1, 2""",
)
def latest_attempts(t):
    return history.latest_attempts(attempts(t)).select("run_id", "job_id", "id", "model")


@query(
    "last_error_categories",
    f"""WITH {SQL_ATTEMPTS} SELECT job_id, error_category FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY started_at DESC, id DESC) AS n
      FROM attempts WHERE error_category IS NOT NULL) WHERE n = 1""",
)
def last_error_categories(t):
    return history.last_error_category(attempts(t))


@query(
    "jobs_with_last_error",
    f"""WITH {SQL_ATTEMPTS}, l AS (SELECT job_id, max(id) AS id FROM attempts GROUP BY 1)
    SELECT a.job_id FROM attempts a JOIN l ON a.id = l.id JOIN people p ON p.id = a.job_id WHERE a.error_category = 'timeout' AND p.status <> 'merged'""",
)
def jobs_with_last_error(t):
    return history.jobs_with_last_error(people(t), attempts(t), "timeout")


@query(
    "next_attempt_start",
    f"""WITH {SQL_ATTEMPTS} SELECT id, lead(started_at) OVER (PARTITION BY job_id ORDER BY started_at, id) AS next_started_at FROM attempts""",
)
def next_attempt_start(t):
    return history.next_attempt_start(attempts(t)).select("id", "next_started_at")


# Each job of each run with the bound of what it was judged on; runs ending in 7 are not stored.
SQL_AS_OF = f"""WITH {SQL_ATTEMPTS},
  contents AS (SELECT event_id AS id, user_id AS job_id, ts + INTERVAL 3 HOUR AS retrieved_at FROM events WHERE event_type = 'signup'),
  decisions AS (SELECT id, job_id, id AS attempt_id, 'eligible' AS decision, model AS prompt_hash, id + 1 AS content_id FROM attempts WHERE outcome = 'completed_eligible' AND prompt_tokens > 3000),
  ordered AS (SELECT *, lead(started_at) OVER (PARTITION BY job_id ORDER BY started_at, id) AS nx FROM attempts),
  sel AS (SELECT run_id, job_id, max(id) AS id, coalesce(arg_max(struct_pack(v := nx), id).v, arg_max(struct_pack(v := finished_at), id).v, TIMESTAMP '2024-01-16', TIMESTAMP '2024-02-01') AS bound
      FROM ordered WHERE right(run_id, 1) <> '7' GROUP BY 1, 2),
  at_bound AS (SELECT s.run_id, s.job_id, arg_max(c.id, (c.retrieved_at, c.id)) AS id FROM sel s JOIN contents c ON c.job_id = s.job_id AND c.retrieved_at <= bound GROUP BY 1, 2),
  dec AS (SELECT a.run_id, d.job_id, arg_max(d.content_id, d.id) AS content_id, arg_max(d.decision, d.id) AS decision, arg_max(d.prompt_hash, d.id) AS prompt_hash
      FROM decisions d JOIN attempts a ON a.id = d.attempt_id GROUP BY 1, 2),
  judged AS (SELECT s.run_id, s.job_id, coalesce(dec.content_id, at_bound.id) AS content, dec.decision, dec.prompt_hash
      FROM sel s LEFT JOIN at_bound USING (run_id, job_id) LEFT JOIN dec USING (run_id, job_id)),
  as_of AS (SELECT j.run_id, j.job_id, c.id AS content_id, j.decision, j.prompt_hash,
      CASE WHEN content IS NULL THEN 'no_content' WHEN c.id IS NULL THEN 'foreign_content' END AS problem
    FROM judged j LEFT JOIN contents c ON c.id = content AND c.job_id = j.job_id
    UNION ALL SELECT DISTINCT run_id, NULL, NULL, NULL, NULL, 'unknown_run' FROM attempts WHERE right(run_id, 1) = '7')"""


def as_of_tables(t):
    contents = t.events.filter("event_type = 'signup'").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("job_id"),
        (_ts("ts") + F.make_dt_interval(F.lit(0), F.lit(3))).alias("retrieved_at"),
    )
    decided = attempts(t).filter("outcome = 'completed_eligible' and prompt_tokens > 3000").select(
        "id", "job_id", F.col("id").alias("attempt_id"), F.lit("eligible").alias("decision"),
        F.col("model").alias("prompt_hash"), (F.col("id") + 1).alias("content_id"),
    )
    ended = runs(t).filter(F.right("id", F.lit(1)) != "7").withColumn("finished_at", F.lit("2024-01-16").cast("timestamp_ntz"))
    return attempts(t), contents, decided, ended, "2024-02-01 00:00:00"


@query("contents_as_of_run", f"{SQL_AS_OF} SELECT * EXCLUDE (run_id) FROM as_of WHERE run_id = '2024-01-15'")
def contents_as_of_run(t):
    return history.contents_as_of_run("2024-01-15", *as_of_tables(t))


@query("contents_as_of_runs", f"{SQL_AS_OF} SELECT * FROM as_of")
def contents_as_of_runs(t):
    return history.contents_as_of_runs(*as_of_tables(t))


@query(
    "latest_contents",
    """SELECT user_id AS job_id, arg_max(event_id, (ts, event_id)) AS id, arg_max(event_type, (ts, event_id)) AS title FROM events GROUP BY 1""",
)
def latest_contents(t):
    rows = t.events.select(
        F.col("event_id").alias("id"), F.col("user_id").alias("job_id"), _ts("ts").alias("retrieved_at"), F.col("event_type").alias("title")
    )
    return identity.latest_contents(rows).select("job_id", "id", "title")


@query(
    "latest_titles",
    """SELECT user_id AS job_id, nullif(arg_max(coalesce(CASE WHEN event_type <> 'view' THEN event_type END, ''), event_id), '') AS latest_title FROM events GROUP BY 1""",
)
def latest_titles(t):
    rows = t.events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("job_id"),
        F.when(F.col("event_type") != "view", F.upper("event_type")).alias("title"),
    )
    return identity.latest_titles(rows)


def sources(t):
    return t.lineitem.select(
        ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000000 + F.col("l_suppkey")).alias("id"),
        F.col("l_orderkey").alias("job_id"),
        F.concat(F.lit("https://b.example/"), F.col("l_suppkey").cast("string")).alias("url"),
        _ts("l_shipdate").alias("first_seen_at"),
        _ts("l_shipdate").alias("last_seen_at"),
    )


SQL_SOURCES = """
sources AS (
  SELECT (l_orderkey * 10 + l_linenumber) * 1000000 + l_suppkey AS id, l_orderkey AS job_id, 'https://b.example/' || l_suppkey AS url,
    l_shipdate AS first_seen_at, l_shipdate AS last_seen_at FROM lineitem
)"""


@query(
    "newest_sources",
    f"WITH {SQL_SOURCES} SELECT job_id, arg_max(url, (last_seen_at, id)) AS url FROM sources GROUP BY 1",
)
def newest_sources(t):
    return history.newest_source(sources(t))


@query(
    "jobs_of_url",
    f"""WITH {SQL_JOBS}, {SQL_SOURCES} SELECT DISTINCT j.id, j.status FROM sources s JOIN jobs j ON j.id = s.job_id
    WHERE s.url IN (SELECT 'https://b.example/' || s_suppkey FROM supplier WHERE s_acctbal > 9000)""",
)
def jobs_of_url(t):
    wanted = t.supplier.filter("s_acctbal > 9000").select(
        F.concat(F.lit("https://b.example/"), F.col("s_suppkey").cast("string")).alias("url")
    )
    return identity.jobs_of_url(jobs(t), sources(t), wanted).select("id", "status").distinct()


# Order chains: an order with status P is merged into the order before it.
SQL_ROOTS = """
chained AS (SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN o_orderkey - 1 END AS merged_into_id FROM orders),
roots AS (SELECT id AS job_id, merged_into_id, max(CASE WHEN merged_into_id IS NULL THEN id END) OVER (ORDER BY id) AS root_id FROM chained)"""


def chained(t):
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderkey") - 1).alias("merged_into_id"),
    )


@query(
    "merge_roots",
    f"WITH {SQL_ROOTS} SELECT job_id, root_id, CASE WHEN root_id IS NULL THEN 'missing' END AS problem FROM roots",
)
def merge_roots(t):
    return identity.merge_roots(chained(t))


@query(
    "moved_sources",
    f"""WITH {SQL_ROOTS}, {SQL_SOURCES}, r AS (SELECT root_id AS job_id, url, s.id, row_number() OVER (PARTITION BY root_id, url
      ORDER BY s.job_id <> root_id, s.job_id, s.id) AS n FROM sources s JOIN roots USING (job_id) WHERE root_id IS NOT NULL)
    SELECT job_id, url, id FROM r WHERE n = 1""",
)
def moved_sources(t):
    roots = identity.merge_roots(chained(t)).filter("root_id is not null")
    return identity.moved_sources(sources(t), roots).select("job_id", "url", "id")


def page_state(t):
    """Jobs and sources after observing the first pages."""
    pages = keyed_pages(t).select("company_slug", "url", "page_id")
    spark = t.spark
    first = history.observe(
        spark.createDataFrame([], JOBS),
        spark.createDataFrame([], JOB_SOURCES),
        pages.filter("page_id < 150"),
        "2024-01-01 00:00:00",
    )
    # Stored versions, as the next observation would read them.
    return pages, tuple(cut_lineage(table) for table in first)


@query(
    "observe_snapshots",
    f"""WITH {SQL_KEYED}, k AS (SELECT host, url_key, min(page_id) AS lo, max(page_id) AS hi FROM keyed GROUP BY 1, 2)
    SELECT host AS company_slug, url_key, CASE WHEN lo < 150 THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-01-02' END AS first_seen_at,
      CASE WHEN hi >= 100 THEN TIMESTAMP '2024-01-02' ELSE TIMESTAMP '2024-01-01' END AS last_seen_at,
      'new' AS status FROM k""",
)
def observe_snapshots(t):
    pages, (state, seen) = page_state(t)
    new_jobs, _ = history.observe(state, seen, pages.filter("page_id >= 100"), "2024-01-02 00:00:00")
    return new_jobs.select("company_slug", "url_key", "first_seen_at", "last_seen_at", "status")


@query(
    "observed_sources",
    f"""WITH {SQL_KEYED}, k AS (SELECT host, url_key, url, min(page_id) AS lo, max(page_id) AS hi FROM keyed GROUP BY 1, 2, 3)
    SELECT host AS company_slug, url_key, url, CASE WHEN lo < 150 THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-01-02' END AS first_seen_at,
      CASE WHEN hi >= 100 THEN TIMESTAMP '2024-01-02' ELSE TIMESTAMP '2024-01-01' END AS last_seen_at FROM k""",
)
def observed_sources(t):
    pages, (state, seen) = page_state(t)
    new_jobs, new_sources = history.observe(state, seen, pages.filter("page_id >= 100"), "2024-01-02 00:00:00")
    return new_sources.join(new_jobs.select(F.col("id").alias("job_id"), "company_slug", "url_key"), "job_id").select(
        "company_slug", "url_key", "url", "first_seen_at", "last_seen_at"
    )


@query(
    "canonical_snapshot_keys",
    f"WITH {SQL_KEYED} SELECT DISTINCT host AS company_slug, url_key FROM keyed",
)
def canonical_snapshot_keys(t):
    pages, (state, seen) = page_state(t)
    new_jobs, _ = history.observe(state, seen, pages.filter("page_id >= 100"), "2024-01-02 00:00:00")
    return identity.canonical_snapshot_keys(pages, new_jobs, identity.merge_roots(new_jobs))


@query(
    "append_contents",
    """WITH a AS (SELECT source AS job_id, sha256(text) AS content_hash, min(doc_id) AS first_doc, min(doc_id) FILTER (doc_id < 500) IS NOT NULL AS stored FROM documents GROUP BY 1, 2)
    SELECT job_id, content_hash, first_doc FROM a WHERE NOT stored""",
)
def append_contents(t):
    rows = t.documents.select(
        F.col("doc_id").alias("first_doc"),
        F.col("source").alias("job_id"),
        F.sha2("text", 256).alias("content_hash"),
        F.timestamp_seconds("doc_id").alias("retrieved_at"),
    )
    stored = rows.filter("first_doc < 500").select(F.col("first_doc").alias("id"), "job_id", "content_hash")
    return content.append_contents(stored, rows.filter("first_doc >= 500")).select("job_id", "content_hash", "first_doc")


@query(
    "started_batch",
    f"""WITH {SQL_JOBS} SELECT status, count(*) AS jobs, count(*) FILTER (taken) AS leased, sum(attempts)::BIGINT AS attempts FROM (
      SELECT CASE WHEN taken THEN 'in_progress' ELSE status END AS status, taken, attempt_count + CASE WHEN taken THEN 1 ELSE 0 END AS attempts
      FROM (SELECT *, coalesce({SQL_CLAIM}, false) AND (company_slug, url_key) IN (SELECT (company_slug, url_key) FROM keys) AS taken FROM jobs)) GROUP BY 1""",
)
def started_batch(t):
    all_jobs = jobs(t)
    from vacantia.schemas import JOB_ATTEMPTS

    none = t.spark.createDataFrame([], JOB_ATTEMPTS)
    selected = workplan.work_list(all_jobs, snapshot_keys(t), NOW, "eligibility")
    new_jobs, opened = history.start_batch(all_jobs, none, selected, "run-1", "eligibility", "scheduled", "m", NOW)
    leased = opened.select(F.col("job_id").alias("id"), F.lit(True).alias("leased"))
    return (
        new_jobs.join(leased, "id", "left")
        .groupBy("status")
        .agg(
            F.count("*").alias("jobs"), F.count_if("leased").alias("leased"), F.sum("attempt_count").alias("attempts")
        )
    )


def _outcomes(t):
    """Outcome rows for all in-progress jobs; even ids belong to another attempt."""
    held = jobs(t).filter("status = 'in_progress'")
    return held.select(
        F.col("id").alias("job_id"),
        F.when(F.col("id") % 2 == 0, F.col("id") + 1).otherwise(F.col("id")).alias("attempt_id"),
        F.lit("unavailable").alias("status"),
        F.lit("fetch").alias("next_phase"),
        F.lit(None).cast("timestamp_ntz").alias("next_attempt_after"),
        F.lit("closed").alias("error_category"),
        F.lit("x").alias("error_message"),
        F.lit(5).cast("long").alias("prompt_tokens"),
        F.lit(6).cast("long").alias("completion_tokens"),
    )


def _order_attempts(t):
    """One open attempt per order."""
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").alias("job_id"),
        F.lit(None).cast("string").alias("outcome"),
        F.lit(None).cast("string").alias("phase_reached"),
        F.lit(None).cast("string").alias("error_category"),
        F.lit(None).cast("string").alias("error_message"),
        F.lit(None).cast("long").alias("prompt_tokens"),
        F.lit(None).cast("long").alias("completion_tokens"),
        _ts("o_orderdate").alias("started_at"),
        F.lit(None).cast("timestamp_ntz").alias("finished_at"),
    )


@query(
    "released_jobs",
    f"""WITH {SQL_JOBS}, x AS (SELECT id, status = 'in_progress' AND id % 2 = 1 AS go, status FROM jobs)
    SELECT CASE WHEN go THEN 'unavailable' ELSE status END AS status, count(*) AS jobs, count(*) FILTER (go) AS ended FROM x GROUP BY 1""",
)
def released_jobs(t):
    new_jobs, new_attempts, _ = history.release(jobs(t), _order_attempts(t), _outcomes(t), NOW)
    ended = new_attempts.filter("finished_at is not null").select("id", F.lit(True).alias("ended"))
    return (
        new_jobs.join(ended, "id", "left")
        .groupBy("status")
        .agg(F.count("*").alias("jobs"), F.count_if("ended").alias("ended"))
    )


@query(
    "advanced_phases",
    f"""WITH {SQL_JOBS} SELECT CASE WHEN status = 'in_progress' AND id % 2 = 1 THEN 'eligibility' ELSE next_phase END AS next_phase, count(*) AS jobs FROM jobs GROUP BY 1""",
)
def advanced_phases(t):
    steps = _outcomes(t).select("job_id", "attempt_id", F.lit("eligibility").alias("next_phase"))
    return history.advance_phase(jobs(t), steps, NOW).groupBy("next_phase").agg(F.count("*").alias("jobs"))


@query(
    "reaped_attempts",
    f"""WITH {SQL_JOBS}, x AS (SELECT id, status = 'in_progress' AND next_phase = 'extraction' AND o_orderdate < TIMESTAMP '1996-01-01' AS stale, status FROM jobs)
    SELECT CASE WHEN stale THEN 'retry' ELSE status END AS status, count(*) AS jobs, count(*) FILTER (stale) AS interrupted FROM x GROUP BY 1""",
)
def reaped_attempts(t):
    new_jobs, new_attempts = workplan.reap_attempts(jobs(t), _order_attempts(t), "extraction", "1996-01-01 00:00:00", NOW)
    cut = new_attempts.filter("outcome = 'interrupted'").select("id", F.lit(True).alias("cut"))
    return (
        new_jobs.join(cut, "id", "left")
        .groupBy("status")
        .agg(F.count("*").alias("jobs"), F.count_if("cut").alias("interrupted"))
    )


SQL_COMPANY_RUNS = """
company_runs AS (
  SELECT o_orderkey AS id, 'c' || o_custkey AS company_slug, strftime(o_orderdate, '%Y-%m') AS batch_id,
    CASE o_orderstatus WHEN 'O' THEN 'success' WHEN 'F' THEN 'failed' ELSE 'in_progress' END AS status,
    o_orderdate AS started_at, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 5 MINUTE END AS finished_at,
    CASE WHEN o_orderstatus = 'O' THEN floor(o_totalprice / 1000)::BIGINT END AS url_count FROM orders
)"""


def company_runs(t):
    status = F.when(F.col("o_orderstatus") == "O", "success").when(F.col("o_orderstatus") == "F", "failed").otherwise("in_progress")
    return t.orders.select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("company_slug"),
        F.date_format("o_orderdate", "yyyy-MM").alias("batch_id"),
        status.alias("status"),
        _ts("o_orderdate").alias("started_at"),
        F.when(F.col("o_orderstatus") != "P", _ts("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(5))).alias("finished_at"),
        F.when(F.col("o_orderstatus") == "O", F.floor(F.col("o_totalprice") / 1000)).alias("url_count"),
        F.lit(None).cast("string").alias("error_message"),
    )


def companies(t):
    return t.customer.select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("slug"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("https://c.example/"), F.col("c_custkey").cast("string")).alias("job_board_url"),
        F.col("c_mktsegment").alias("strategy"),
    )


@query(
    "scan_plan",
    f"""WITH {SQL_COMPANY_RUNS} SELECT slug, CASE WHEN slug IN (SELECT company_slug FROM company_runs WHERE status = 'success'
      AND finished_at >= {SQL_NOW} - INTERVAL 2400 HOUR) THEN 'fresh' ELSE 'run' END AS plan FROM (SELECT 'c' || c_custkey AS slug FROM customer)""",
)
def scan_plan(t):
    return workplan.scan_plan(companies(t), company_runs(t), NOW, hours=2400).select("slug", "plan")


@query(
    "batch_summary",
    f"""WITH {SQL_COMPANY_RUNS} SELECT batch_id, count(*) AS companies, count(*) FILTER (status = 'success') AS succeeded,
      count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped') AS skipped,
      coalesce(sum(url_count), 0)::BIGINT AS stored_urls FROM company_runs GROUP BY 1""",
)
def batch_summary(t):
    return workplan.batch_summary(company_runs(t))


@query(
    "reaped_runs",
    f"""WITH {SQL_COMPANY_RUNS} SELECT CASE WHEN stale THEN 'failed' ELSE status END AS status, count(*) AS runs, count(*) FILTER (stale) AS abandoned
    FROM (SELECT *, status = 'in_progress' AND started_at < TIMESTAMP '1997-01-01' AS stale FROM company_runs) GROUP BY 1""",
)
def reaped_runs(t):
    return (
        workplan.reap_runs(company_runs(t), "1997-01-01 00:00:00", NOW)
        .groupBy("status")
        .agg(F.count("*").alias("runs"), F.count_if(F.col("error_message") == workplan.ABANDONED).alias("abandoned"))
    )


@query(
    "latest_runs",
    f"""WITH {SQL_COMPANY_RUNS} SELECT id, status, started_at, finished_at, url_count FROM company_runs""",
)
def latest_runs(t):
    runs_now = company_runs(t).select("id", "status", "started_at", "finished_at", "url_count")
    none = F.lit(None)
    opened = runs_now.select(
        "id", F.lit("in_progress").alias("status"), "started_at", none.cast("timestamp_ntz").alias("finished_at"),
        none.cast("long").alias("url_count"), F.col("started_at").alias("event_at"),
    )
    ended = runs_now.filter("status <> 'in_progress'").select(
        "id", "status", none.cast("timestamp_ntz").alias("started_at"), "finished_at", "url_count", F.col("finished_at").alias("event_at")
    )
    return history.latest_runs(opened.unionByName(ended))


@query(
    "cost_mix",
    """SELECT CASE WHEN strategy = 'dom' OR (strategy = 'coveo' AND c_acctbal > 5000) THEN 'browser' ELSE 'http' END AS cost_class, strategy, count(*) AS companies
    FROM (SELECT c_acctbal, CASE c_mktsegment WHEN 'BUILDING' THEN 'dom' WHEN 'MACHINERY' THEN 'coveo' ELSE 'phenom' END AS strategy FROM customer) GROUP BY 1, 2""",
)
def cost_mix(t):
    strategy = F.when(F.col("c_mktsegment") == "BUILDING", "dom").when(F.col("c_mktsegment") == "MACHINERY", "coveo").otherwise("phenom")
    catalog = t.customer.select(
        strategy.alias("strategy"),
        F.struct(F.when(F.col("c_acctbal") > 5000, "token").alias("browser_token_key")).alias("coveo"),
    )
    return workplan.cost_mix(catalog)


@query(
    "synced_catalog",
    """SELECT 'c' || c_custkey AS slug, CASE WHEN c_nationkey > 10 THEN c_name ELSE lower(c_name) END AS name,
      CASE WHEN c_nationkey > 10 THEN TIMESTAMP '2024-01-02' ELSE TIMESTAMP '2024-01-01' END AS synced_at
    FROM customer WHERE c_nationkey > 10 OR c_acctbal > 0""",
)
def synced_catalog(t):
    base = companies(t).join(t.customer.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("slug"), "c_nationkey", "c_acctbal"), "slug")
    stored = base.filter("c_acctbal > 0").withColumn("name", F.lower("name")).withColumn(
        "synced_at", F.lit("2024-01-01").cast("timestamp_ntz")
    ).select("slug", "name", "job_board_url", "strategy", "synced_at")
    return history.sync_catalog(stored, base.filter("c_nationkey > 10"), "2024-01-02 00:00:00").select("slug", "name", "synced_at")


# Labelled documents stand in for decisions.
SQL_DECISIONS = """
decisions AS (
  SELECT doc_id AS id, doc_id AS job_id, doc_id AS attempt_id, doc_id AS content_id, source AS company_slug,
    CASE WHEN toxic = 1 THEN 'ineligible' WHEN quality = 1 THEN 'eligible' ELSE 'unknown' END AS decision,
    split_part(text, chr(10), 1) AS reason, lang AS prompt_hash, n_chars > 200 AS is_current,
    make_timestamp(n_chars * 1000000) AS decided_at, n_chars
  FROM documents JOIN labels USING (doc_id)
)"""


def decisions(t):
    decision = F.when(F.col("toxic") == 1, "ineligible").when(F.col("quality") == 1, "eligible").otherwise("unknown")
    return t.documents.join(t.labels, "doc_id").select(
        F.col("doc_id").alias("id"),
        F.col("doc_id").alias("job_id"),
        F.col("doc_id").alias("attempt_id"),
        F.col("doc_id").alias("content_id"),
        F.col("source").alias("company_slug"),
        decision.alias("decision"),
        F.substring_index("text", "\n", 1).alias("reason"),
        F.col("lang").alias("prompt_hash"),
        (F.col("n_chars") > 200).alias("is_current"),
        F.timestamp_seconds("n_chars").cast("timestamp_ntz").alias("decided_at"),
    )


@query(
    "unknown_decisions",
    f"""WITH {SQL_DECISIONS} SELECT job_id, company_slug, reason, prompt_hash, decided_at FROM decisions WHERE is_current AND decision = 'unknown'""",
)
def unknown_decisions(t):
    held = decisions(t)
    owners = t.documents.select(F.col("doc_id").alias("id"), F.col("source").alias("company_slug"))
    return reports.unknown_decisions(owners, held.drop("company_slug"))


@query(
    "accepted_decisions",
    f"""WITH {SQL_DECISIONS}, n AS (SELECT id FROM decisions WHERE decision = 'eligible' AND prompt_hash = 'en')
    SELECT job_id, CASE WHEN job_id IN (SELECT id FROM n) THEN 2 ELSE 1 END::BIGINT AS stored,
      CASE WHEN job_id IN (SELECT id FROM n) THEN 'unknown' WHEN is_current THEN decision END AS current_decision FROM decisions""",
)
def accepted_decisions(t):
    held = decisions(t).drop("company_slug")
    again = held.filter("decision = 'eligible' and prompt_hash = 'en'").withColumn("decision", F.lit("unknown")).withColumn(
        "attempt_id", F.col("attempt_id") + 100000
    ).drop("id", "is_current")
    stored = history.accept_current(held, again)
    return stored.groupBy("job_id").agg(
        F.count("*").alias("stored"), F.max(F.when(F.col("is_current"), F.col("decision"))).alias("current_decision")
    )


@query(
    "decided_states",
    f"""WITH {SQL_DECISIONS} SELECT CASE decision WHEN 'eligible' THEN 'ready_for_extraction' WHEN 'ineligible' THEN 'completed_ineligible' ELSE 'unknown' END AS status,
      CASE decision WHEN 'eligible' THEN 'extraction' ELSE 'eligibility' END AS next_phase, count(*) AS jobs FROM decisions GROUP BY 1, 2""",
)
def decided_states(t):
    return (
        decisions(t)
        .select(history.decided_state(F.col("decision")).alias("s"))
        .groupBy(F.col("s.status").alias("status"), F.col("s.next_phase").alias("next_phase"))
        .agg(F.count("*").alias("jobs"))
    )


@query(
    "requests_without_decision",
    f"""WITH {SQL_DECISIONS} SELECT doc_id AS job_id FROM documents WHERE doc_id NOT IN (SELECT job_id FROM decisions WHERE is_current AND prompt_hash = 'en')""",
)
def requests_without_decision(t):
    requests = t.documents.select(F.col("doc_id").alias("job_id"), F.col("doc_id").alias("content_id"))
    return history.requests_without_decision(requests, decisions(t), "en").select("job_id")


@query(
    "reprocess_checks",
    f"""WITH {SQL_DECISIONS}, w AS (SELECT doc_id AS id FROM documents UNION SELECT doc_id + 100000 FROM documents)
    SELECT w.id, CASE WHEN d.doc_id IS NULL THEN 'no_job' WHEN lang = 'de' THEN 'busy' WHEN lang = 'fr' THEN 'merged'
      WHEN x.id IS NULL THEN 'no current eligible decision checkpoint' END AS problem
    FROM w LEFT JOIN documents d ON d.doc_id = w.id LEFT JOIN (SELECT id FROM decisions WHERE is_current AND decision = 'eligible') x ON x.id = w.id""",
)
def reprocess_checks(t):
    ids = t.documents.select(F.col("doc_id").alias("id"))
    wanted = ids.unionByName(ids.select((F.col("id") + 100000).alias("id")))
    held = t.documents.select(
        F.col("doc_id").alias("id"),
        F.when(F.col("lang") == "de", "in_progress").when(F.col("lang") == "fr", "merged").otherwise("new").alias("status"),
        F.col("doc_id").alias("current_content_id"),
    )
    contents = ids.select("id", F.col("id").alias("job_id"))
    return history.reprocess_checks(wanted, held, contents, decisions(t), "extraction").select("id", "problem")


@query(
    "prepared_reprocess",
    f"""WITH {SQL_DECISIONS} SELECT count(*) FILTER (o_orderkey IN (SELECT id FROM decisions WHERE is_current AND decision = 'eligible')) AS prepared,
      (SELECT count(*) FROM decisions WHERE is_current AND decision <> 'eligible') AS still_current FROM orders""",
)
def prepared_reprocess(t):
    held = decisions(t)
    wanted = held.filter("is_current and decision = 'eligible'").select("id")
    free = jobs(t).withColumn("status", F.lit("unknown")).withColumn("current_content_id", F.col("id"))
    contents = t.documents.select(F.col("doc_id").alias("id"), F.col("doc_id").alias("job_id"))
    checked = history.reprocess_checks(wanted, free, contents, held, "eligibility")
    new_jobs, new_decisions, _ = history.prepare_reprocess(free, held, held, checked, "eligibility", NOW)
    prepared = new_jobs.agg(F.count_if(F.col("status") == "retry").alias("prepared"))
    return prepared.crossJoin(F.broadcast(new_decisions.agg(F.count_if("is_current").alias("still_current"))))


@query(
    "constraint_violations",
    f"""WITH {SQL_JOBS}, j AS (SELECT *, CASE WHEN id % 3 = 0 THEN 'odd' ELSE status END AS s FROM jobs)
    SELECT 'jobs' AS "table", 'status: not allowed' AS rule, count(*) AS rows FROM j WHERE s = 'odd'
    UNION ALL SELECT 'jobs', 'ready but held', count(*) FROM j WHERE s = 'ready_for_extraction' AND next_phase <> 'extraction' HAVING count(*) > 0
    UNION ALL SELECT 'jobs', 'retry iff due time', count(*) FROM j WHERE (s = 'retry') <> (next_attempt_after IS NOT NULL)
    UNION ALL SELECT 'jobs', 'reference(company_slug)', count(*) FROM j WHERE company_slug NOT IN (SELECT 'c' || c_custkey FROM customer WHERE c_acctbal > 0)
    UNION ALL SELECT 'job_sources', 'unique(job_id, url)', count(*) FROM (SELECT l_orderkey, l_suppkey FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
    UNION ALL SELECT 'job_sources', 'unique(id)', count(*) FROM (SELECT (l_orderkey * 10 + l_linenumber) * 1000000 + l_suppkey AS i FROM lineitem GROUP BY 1 HAVING count(*) > 1) HAVING count(*) > 0
    UNION ALL SELECT 'job_sources', 'reference(job_id)', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) HAVING count(*) > 0""",
)
def constraint_violations(t):
    odd = jobs(t).withColumn("status", F.when(F.col("id") % 3 == 0, "odd").otherwise(F.col("status")))
    found = checks.violations(
        {
            "companies": companies(t).join(
                t.customer.filter("c_acctbal > 0").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("slug")), "slug", "left_semi"
            ),
            "jobs": odd,
            "job_sources": sources(t),
        }
    )
    return found.groupBy("table", "rule").agg(F.count("*").alias("rows"))


@query(
    "audit_view",
    f"""WITH {SQL_DECISIONS} SELECT section, count(*) AS records FROM (
      SELECT 'job' AS section FROM orders WHERE o_orderkey IN (SELECT id FROM decisions)
      UNION ALL SELECT 'source' FROM lineitem WHERE l_orderkey IN (SELECT id FROM decisions)
      UNION ALL SELECT 'content' FROM documents WHERE doc_id IN (SELECT id FROM decisions)
      UNION ALL SELECT 'attempt' FROM events WHERE user_id IN (SELECT id FROM decisions)
      UNION ALL SELECT 'decision' FROM decisions UNION ALL SELECT 'result' FROM decisions WHERE is_current) GROUP BY 1""",
)
def audit_view(t):
    held = decisions(t).drop("company_slug")
    held = held.withColumn("supporting_evidence_json", F.to_json(F.array("reason"))).withColumn(
        "conflicting_evidence_json", F.lit("[]")
    )
    contents = t.documents.select(
        F.col("doc_id").alias("id"), F.col("doc_id").alias("job_id"), "text", F.lit(None).cast("string").alias("jsonld_json"),
        F.timestamp_seconds("doc_id").cast("timestamp_ntz").alias("retrieved_at"),
    )
    results = held.filter("is_current").select(
        "id", "job_id", F.to_json(F.struct("decision")).alias("result_json"), F.col("decided_at").alias("accepted_at")
    )
    view = reports.audit(held.select("id"), jobs(t), sources(t), contents, attempts(t), runs(t), held, results)
    return view.groupBy("section").agg(F.count("*").alias("records"))
