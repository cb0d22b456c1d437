"""Queries over recorded answers and their scoring against labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacantia.functions import text as tx
from vacantia.operators import answers, facts, phrases, scoring
from vacantia.schemas import FACTS
from vacantia.sources import payloads, sinks
from vacantia.workloads.base import query
from vacantia.workloads.document_jobs import SQL_IDENTITY, SQL_WORDS

MISSING = answers.MISSING_INFORMATION_REASON

# Every document is answered once: the decision follows its language and length, the
# evidence is its first line, and some answers cite the neighbour or nothing.
SQL_ANSWERS = f"""
src AS (
  SELECT doc_id, lang, n_chars, text, split_part(text, chr(10), 1) AS line,
    split_part(lead(text) OVER (ORDER BY doc_id), chr(10), 1) AS other FROM documents
),
ans AS (
  SELECT doc_id AS content_id, text,
    CASE WHEN lang = 'en' THEN 'eligible' WHEN lang = 'de' THEN 'ineligible' ELSE 'unknown' END AS decision,
    CASE WHEN n_chars < 150 THEN '{MISSING}' WHEN n_chars < 250 THEN 'No closing mark' ELSE 'States it.' END AS reason,
    CASE WHEN n_chars < 200 THEN [] WHEN n_chars > 2000 THEN [line, coalesce(other, '')] ELSE [line] END AS supporting,
    CASE WHEN n_chars BETWEEN 300 AND 400 THEN [upper(line)] ELSE [] END AS conflicting
  FROM src
)"""


def recorded(t):
    line = F.substring_index("text", "\n", 1)
    following = t.documents.select(
        (F.col("doc_id") - 1).alias("doc_id"), line.alias("other")
    )
    none = F.array().cast("array<string>")
    chars = F.col("n_chars")
    answer = F.struct(
        F.when(F.col("lang") == "en", "eligible").when(F.col("lang") == "de", "ineligible").otherwise("unknown").alias("decision"),
        F.when(chars < 150, MISSING).when(chars < 250, "No closing mark").otherwise("States it.").alias("reason"),
        F.when(chars < 200, none)
        .when(chars > 2000, F.array(line, F.coalesce("other", F.lit(""))))
        .otherwise(F.array(line))
        .alias("supporting_evidence"),
        F.when(chars.between(300, 400), F.array(F.upper(line))).otherwise(none).alias("conflicting_evidence"),
    )
    return t.documents.join(following, "doc_id", "left").select(
        F.col("doc_id").alias("content_id"), F.to_json(answer).alias("raw_json")
    )


def contents(t):
    return t.documents.select(F.col("doc_id").alias("content_id"), "text")


def typed(t):
    return answers.parse_answers(recorded(t))


@query(
    "parsed_answers",
    f"""WITH {SQL_ANSWERS} SELECT decision, count(*) AS answers, sum(len(supporting) + len(conflicting))::BIGINT AS quotes FROM ans GROUP BY 1""",
)
def parsed_answers(t):
    return (
        typed(t)
        .filter("parsed")
        .groupBy(F.col("answer.decision").alias("decision"))
        .agg(
            F.count("*").alias("answers"),
            F.sum(F.size("answer.supporting_evidence") + F.size("answer.conflicting_evidence")).alias("quotes"),
        )
    )


@query(
    "answer_shape_errors",
    f"""WITH {SQL_ANSWERS}, e AS (SELECT content_id, unnest(flatten([
        CASE WHEN reason NOT LIKE '%.' THEN ['reason: not one closed sentence'] ELSE [] END,
        CASE WHEN len([x for x in supporting if length(x) > 300]) > 0 THEN ['supporting_evidence: excerpt too long'] ELSE [] END,
        CASE WHEN len([x for x in conflicting if length(x) > 300]) > 0 THEN ['conflicting_evidence: excerpt too long'] ELSE [] END,
        CASE WHEN len([x for x in supporting if NOT regexp_matches(x, '\\S')]) > 0 THEN ['supporting_evidence: blank excerpt'] ELSE [] END])) AS error FROM ans)
    SELECT error, count(*) AS answers FROM e GROUP BY 1""",
)
def answer_shape_errors(t):
    return (
        typed(t)
        .select(F.explode(answers.shape_errors(F.col("answer"))).alias("error"))
        .groupBy("error")
        .agg(F.count("*").alias("answers"))
    )


@query(
    "structural_errors",
    f"""WITH {SQL_ANSWERS}, k AS (SELECT *, {SQL_WORDS.format('supporting[1]')} AS s1, {SQL_WORDS.format("coalesce(supporting[2], '')")} AS s2,
        {SQL_WORDS.format('conflicting[1]')} AS c1 FROM ans),
    e AS (SELECT content_id, unnest(list_concat(
      CASE WHEN len(supporting) = 0 AND len(conflicting) > 0 THEN ['conflicting_alone'] ELSE [] END,
      CASE WHEN len(supporting) = 0 AND decision <> 'unknown' THEN [decision || '_unsupported'] ELSE [] END,
      CASE WHEN len(supporting) = 0 AND reason <> '{MISSING}' THEN ['empty_unexplained'] ELSE [] END,
      CASE WHEN len(supporting) > 0 AND reason = '{MISSING}' THEN ['explained_not_empty'] ELSE [] END,
      CASE WHEN len(conflicting) > 0 AND (c1 = s1 OR (len(supporting) > 1 AND c1 = s2)) THEN ['$.conflicting_evidence[0] in_both'] ELSE [] END)) AS error FROM k)
    SELECT error, count(*) AS answers FROM e GROUP BY 1""",
)
def structural_errors(t):
    return (
        answers.with_structure(typed(t))
        .select(F.explode("structural_errors").alias("error"))
        .groupBy("error")
        .agg(F.count("*").alias("answers"))
    )


SQL_CALLS = f"""
calls AS (
  SELECT content_id, decision, CASE
    WHEN len(supporting) = 0 AND (decision <> 'unknown' OR reason <> '{MISSING}') THEN 'inconsistent'
    WHEN len(conflicting) > 0 THEN 'inconsistent'
    WHEN len([x for x in supporting if {SQL_WORDS.format('x')} = ''
      OR NOT contains(' ' || {SQL_WORDS.format('text')} || ' ', ' ' || {SQL_WORDS.format('x')} || ' ')]) > 0 THEN 'ungrounded'
    ELSE 'grounded' END AS status FROM ans
)"""


@query(
    "call_statuses",
    f"""WITH {SQL_ANSWERS}, {SQL_CALLS} SELECT content_id, status, CASE WHEN status = 'grounded' THEN decision END AS decision FROM calls""",
)
def call_statuses(t):
    calls = typed(t).withColumn("call_status", F.lit("parsed"))
    return answers.call_statuses(calls, contents(t), ["content_id"]).select("content_id", "status", "decision")


@query(
    "accepted_verdicts",
    f"""WITH {SQL_ANSWERS}, {SQL_CALLS} SELECT c.content_id, c.decision,
      CASE WHEN len(supporting) = 0 THEN '' WHEN len(supporting) > 1 AND {SQL_WORDS.format('supporting[1]')} <> {SQL_WORDS.format('supporting[2]')}
        THEN {SQL_WORDS.format('supporting[1]')} || '|' || {SQL_WORDS.format('supporting[2]')} ELSE {SQL_WORDS.format('supporting[1]')} END AS excerpts
    FROM calls c JOIN ans USING (content_id) WHERE status = 'grounded'""",
)
def accepted_verdicts(t):
    kept = answers.verdicts(typed(t), contents(t), ["content_id"])
    return kept.withColumn("keys", tx.word_keys("supporting_evidence")).select(
        "content_id", "decision", F.array_join("keys", "|").alias("excerpts")
    )


@query(
    "answer_misses",
    f"""WITH {SQL_ANSWERS}, q AS (SELECT content_id, text, unnest(supporting) AS quote, generate_subscripts(supporting, 1) - 1 AS i, 'supporting' AS b FROM ans
      UNION ALL SELECT content_id, text, unnest(conflicting), generate_subscripts(conflicting, 1) - 1, 'conflicting' FROM ans)
    SELECT content_id, '$.' || b || '_evidence[' || i || ']' AS path, sha256(quote) AS value_sha256 FROM q
    WHERE {SQL_WORDS.format('quote')} = '' OR NOT contains(' ' || {SQL_WORDS.format('text')} || ' ', ' ' || {SQL_WORDS.format('quote')} || ' ')""",
)
def answer_misses(t):
    return answers.answer_misses(typed(t), contents(t), ["content_id"]).select("content_id", "path", "value_sha256")


@query(
    "evidence_lists",
    """SELECT count(*) AS rows, count(*) FILTER (c = 0) AS unreadable, sum(CASE WHEN c = 0 THEN 0 ELSE 1 END)::BIGINT AS quotes FROM (
      SELECT CASE WHEN turn = 0 OR NOT regexp_matches(text, '\\S') THEN 0 ELSE 1 END AS c FROM conversations)""",
)
def evidence_lists(t):
    raw = F.when(F.col("turn") == 0, F.to_json(F.struct("text"))).otherwise(F.to_json(F.array("text")))
    lists = t.conversations.select(answers.evidence_list(raw).alias("q"))
    return lists.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("q").isNull()).alias("unreadable"),
        F.sum(F.when(F.col("q").isNotNull(), F.size("q")).otherwise(0)).alias("quotes"),
    )


@query(
    "request_keys",
    """SELECT conv_id, turn, sha256('{"conv_id":' || conv_id || ',"role":"' || role || '","turn":' || turn || '}') AS key FROM conversations""",
)
def request_keys(t):
    return t.conversations.select(
        "conv_id",
        "turn",
        answers.request_key(role=F.col("role"), turn=F.col("turn"), conv_id=F.col("conv_id")).alias("key"),
    )


@query(
    "model_requests",
    """SELECT doc_id AS content_id, 'hash' AS prompt_hash, length('Judge.')::BIGINT AS system_chars, length('<p>' || text || '</p>')::BIGINT AS user_chars FROM documents""",
)
def model_requests(t):
    rows = contents(t).withColumn("job_id", F.col("content_id"))
    requests = answers.model_requests(rows, "Judge.", "<p>", "</p>", "hash", "m")
    return requests.select(
        "content_id",
        "prompt_hash",
        F.length(F.col("messages")[0]["content"]).cast("long").alias("system_chars"),
        F.length(F.col("messages")[1]["content"]).cast("long").alias("user_chars"),
    )


# Labelled documents with three replays each.
SQL_SCORED = """
cases AS (
  SELECT doc_id AS case_id, n_chars, lang, CASE WHEN toxic = 1 THEN 'ineligible' WHEN quality = 1 THEN 'eligible' ELSE 'unknown' END AS expected_decision
  FROM documents JOIN labels USING (doc_id)
),
graded AS (
  SELECT case_id, replay, expected_decision, n_chars, lang,
    CASE WHEN n_chars < 80 * replay THEN 'invalid_response' WHEN lang = 'es' AND replay = 3 THEN 'ungrounded' WHEN n_chars > 9000 THEN 'inconsistent' ELSE 'grounded' END AS status
  FROM cases, (SELECT unnest([1, 2, 3]) AS replay)
),
calls AS (
  SELECT *, CASE WHEN status = 'grounded' THEN CASE WHEN n_chars > 1500 - 100 * replay THEN 'eligible' WHEN n_chars < 200 THEN 'unknown' ELSE expected_decision END END AS decision,
    n_chars > 300 AS evidence_agreement, lang = 'fr' AS has_pairs FROM graded
)"""


def scored(t):
    chars, replay = F.col("n_chars"), F.col("replay")
    expected = F.when(F.col("toxic") == 1, "ineligible").when(F.col("quality") == 1, "eligible").otherwise("unknown")
    rows = (
        t.documents.join(t.labels, "doc_id")
        .select(F.col("doc_id").alias("case_id"), "n_chars", "lang", expected.alias("expected_decision"))
        .withColumn("replay", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
        .withColumn(
            "status",
            F.when(chars < replay * 80, "invalid_response")
            .when((F.col("lang") == "es") & (replay == 3), "ungrounded")
            .when(chars > 9000, "inconsistent")
            .otherwise("grounded"),
        )
    )
    decision = F.when(chars > 1500 - replay * 100, "eligible").when(chars < 200, "unknown").otherwise(F.col("expected_decision"))
    return (
        rows.withColumn("decision", F.when(F.col("status") == "grounded", decision))
        .withColumn("evidence_agreement", chars > 300)
        .withColumn("has_pairs", F.col("lang") == "fr")
    )


@query(
    "confusion_matrix",
    f"""WITH {SQL_SCORED} SELECT expected_decision, count(*) FILTER (decision = 'eligible') AS eligible, count(*) FILTER (decision = 'ineligible') AS ineligible,
      count(*) FILTER (decision = 'unknown') AS unknown, count(*) FILTER (decision IS NULL) AS error FROM calls GROUP BY 1""",
)
def confusion_matrix(t):
    return scoring.confusion(scored(t))


SQL_F1 = """
f1 AS (
  SELECT d, count(*) FILTER (expected_decision = d AND decision = d) AS tp, count(*) FILTER (expected_decision <> d AND decision = d) AS fp,
    count(*) FILTER (expected_decision = d AND decision IS DISTINCT FROM d) AS fn
  FROM calls, (SELECT unnest(['eligible', 'ineligible', 'unknown']) AS d) GROUP BY 1
),
macro AS (SELECT round(avg(CASE WHEN tp = 0 THEN 0 ELSE 2.0 * tp / (2 * tp + fp + fn) END), 9) AS macro_f1 FROM f1 WHERE tp + fp + fn > 0)"""


@query("macro_f1", f"WITH {SQL_SCORED}, {SQL_F1} SELECT macro_f1 FROM macro")
def macro_f1(t):
    return scoring.macro_f1(scored(t)).select(F.round("macro_f1", 9).alias("macro_f1"))


SQL_METRICS = f"""WITH {SQL_SCORED}, {SQL_F1},
  by_case AS (SELECT case_id, bool_and(status = 'grounded') AND count(DISTINCT decision) = 1 AS unanimous,
    bool_or(expected_decision <> 'eligible' OR has_pairs) AS safety FROM calls GROUP BY 1),
  m AS (SELECT count(*) AS calls, count(*) FILTER (status <> 'invalid_response') AS schema_valid, count(*) FILTER (status IN ('grounded', 'ungrounded')) AS consistent,
    count(*) FILTER (status = 'grounded') AS grounded, count(*) FILTER (decision = expected_decision) AS decision_agreement,
    count(*) FILTER (decision = expected_decision AND evidence_agreement) AS exact_agreement,
    count(*) FILTER (expected_decision <> 'eligible' AND decision = 'eligible') AS false_eligible,
    count(*) FILTER (expected_decision = 'eligible' AND decision = 'ineligible') AS wrongful_ineligible,
    count(*) FILTER (status = 'grounded') AS critical_total, count(*) FILTER (status = 'grounded' AND n_chars > 600) AS critical_hits FROM calls),
  metrics AS (SELECT m.*, (SELECT count(*) FROM by_case) AS case_count, (SELECT count(*) FROM by_case WHERE unanimous) AS unanimous_cases,
    (SELECT count(*) FROM by_case WHERE safety AND NOT unanimous) AS unstable_safety_cases, (SELECT macro_f1 FROM macro) AS macro_f1 FROM m)"""


def metrics(t):
    calls = scored(t)
    obligations = calls.select("case_id").distinct().select(
        "case_id", F.lit("e1").alias("obligation_id"), F.lit(True).alias("critical")
    )
    met = calls.filter("n_chars > 600").select("case_id", "replay", F.lit("e1").alias("obligation_id"))
    return scoring.scope_metrics(calls, obligations, met)


@query("scope_metrics", f"{SQL_METRICS} SELECT * FROM metrics")
def scope_metrics(t):
    return metrics(t)


@query(
    "gate_results",
    f"""{SQL_METRICS} SELECT gate, passed FROM metrics, LATERAL (SELECT unnest([
      {{'gate': 'grounding', 'passed': grounded / calls >= 0.99}}, {{'gate': 'false_eligible', 'passed': false_eligible = 0}},
      {{'gate': 'wrongful_ineligible', 'passed': wrongful_ineligible = 0}}, {{'gate': 'critical_evidence_recall', 'passed': critical_hits = critical_total}},
      {{'gate': 'safety_case_stability', 'passed': unstable_safety_cases = 0}}, {{'gate': 'schema_valid', 'passed': schema_valid = calls}},
      {{'gate': 'structural_consistency', 'passed': consistent = calls}}, {{'gate': 'decision_macro_f1', 'passed': macro_f1 >= 0.9}},
      {{'gate': 'decision_evidence_role_agreement', 'passed': exact_agreement / calls >= 0.9}},
      {{'gate': 'unanimous_cases', 'passed': unanimous_cases / case_count >= 0.9}}], recursive := true))""",
)
def gate_results(t):
    return scoring.gates(metrics(t), "development")


@query(
    "case_agreement",
    f"""WITH {SQL_SCORED} SELECT case_id, count(*) AS calls, bool_and(status = 'grounded') AND count(DISTINCT decision) = 1 AS unanimous,
      bool_or(expected_decision <> 'eligible' OR has_pairs) AS safety_critical FROM calls GROUP BY 1""",
)
def case_agreement(t):
    return scoring.case_agreement(scored(t))


@query(
    "divergent_calls",
    f"""WITH {SQL_SCORED}, u AS (SELECT case_id, bool_and(status = 'grounded') AND count(DISTINCT decision) = 1 AS unanimous FROM calls GROUP BY 1)
    SELECT case_id, replay, status, decision, expected_decision FROM calls JOIN u USING (case_id)
    WHERE NOT unanimous OR decision IS DISTINCT FROM expected_decision OR NOT evidence_agreement""",
)
def divergent_calls(t):
    return scoring.divergent_calls(scored(t))


@query(
    "outcome_distribution",
    f"""WITH {SQL_SCORED}, c AS (SELECT case_id, coalesce(decision || '/s1c0', status) AS label, count(*) AS n FROM calls GROUP BY 1, 2)
    SELECT case_id, string_agg(label || ': ' || n, ', ' ORDER BY label || ': ' || n) AS distribution FROM c GROUP BY 1""",
)
def outcome_distribution(t):
    calls = scored(t).withColumn("missing_information", F.lit(False)).withColumn("supporting_count", F.lit(1)).withColumn("conflicting_count", F.lit(0))
    return scoring.distribution(calls.withColumn("label", scoring.outcome_label()), ["case_id"])


@query(
    "usage_totals",
    """SELECT count(*) AS calls, sum(p)::BIGINT AS prompt_tokens, sum(floor(value))::BIGINT AS completion_tokens, count(p) AS prompt_measured,
      round(avg(p), 2) AS prompt_mean, sum(event_id)::BIGINT AS latency_ms_total, round(sum(event_id) / count(*), 1) AS latency_ms_mean,
      round((sum(p) * 0.25 + sum(floor(value)) * 2.0) / 1000000.0, 6) AS estimated_cost
    FROM (SELECT *, CASE WHEN event_type <> 'view' THEN floor(value * 100)::BIGINT END AS p FROM events)""",
)
def usage_totals(t):
    rows = t.events.select(
        F.when(F.col("event_type") != "view", F.floor(F.col("value") * 100)).alias("prompt_tokens"),
        F.floor("value").alias("completion_tokens"),
        F.col("event_id").alias("latency_ms"),
    )
    return scoring.usage_totals(rows, 0.25, 2.0)


@query(
    "recording_comparison",
    f"""WITH {SQL_SCORED}, s AS (SELECT CASE WHEN replay = 1 THEN 'baseline' ELSE 'new' END AS side, case_id AS job_id, status, decision, expected_decision AS accepted_decision, n_chars FROM calls)
    SELECT side, count(*) AS calls, count(*) FILTER (status = 'grounded') AS grounded, count(*) FILTER (status = 'ungrounded') AS ungrounded,
      count(*) FILTER (status = 'inconsistent') AS inconsistent, count(*) FILTER (status = 'invalid_response') AS invalid_response,
      count(*) FILTER (decision = accepted_decision AND accepted_decision <> 'unknown') AS agreed, count(*) FILTER (status = 'grounded' AND accepted_decision <> 'unknown') AS compared,
      round(avg(n_chars), 2) AS latency_ms_mean FROM s GROUP BY 1""",
)
def recording_comparison(t):
    calls = scored(t).select(
        F.when(F.col("replay") == 1, "baseline").otherwise("new").alias("side"),
        F.col("case_id").alias("job_id"), "status", "decision", "expected_decision",
        F.lit(None).cast("long").alias("prompt_tokens"), F.lit(None).cast("long").alias("completion_tokens"),
        F.col("n_chars").alias("latency_ms"),
    )
    postings = calls.select(
        "side", "job_id", F.when(F.col("expected_decision") != "unknown", F.col("expected_decision")).alias("accepted_decision")
    )
    return scoring.compare_recordings(postings, calls).select(
        "side", "calls", "grounded", "ungrounded", "inconsistent", "invalid_response", "agreed", "compared", "latency_ms_mean"
    )


@query(
    "structural_error_kinds",
    f"""WITH {SQL_ANSWERS}, {SQL_CALLS}, n AS (SELECT a.*, {SQL_WORDS.format('supporting[1]')} AS s1, {SQL_WORDS.format("coalesce(supporting[2], '')")} AS s2, {SQL_WORDS.format('conflicting[1]')} AS c1 FROM ans a)
    SELECT decision AS side, 'in_both' AS kind, count(*) AS errors FROM n WHERE len(conflicting) > 0 AND (c1 = s1 OR (len(supporting) > 1 AND c1 = s2)) GROUP BY 1
    UNION ALL SELECT decision, 'conflicting_alone', count(*) FROM ans WHERE len(supporting) = 0 AND len(conflicting) > 0 GROUP BY 1
    UNION ALL SELECT decision, decision || '_unsupported', count(*) FROM ans WHERE len(supporting) = 0 AND decision <> 'unknown' GROUP BY 1
    UNION ALL SELECT decision, 'empty_unexplained', count(*) FROM ans WHERE len(supporting) = 0 AND reason <> '{MISSING}' GROUP BY 1
    UNION ALL SELECT decision, 'explained_not_empty', count(*) FROM ans WHERE len(supporting) > 0 AND reason = '{MISSING}' GROUP BY 1""",
)
def structural_error_kinds(t):
    calls = answers.with_structure(typed(t)).withColumn("side", F.col("answer.decision"))
    return scoring.count_structural_errors(calls)


@query(
    "miss_counts",
    f"""WITH {SQL_ANSWERS}, q AS (SELECT decision, text, 'supporting' AS bucket, unnest(supporting) AS quote, generate_subscripts(supporting, 1) - 1 AS i FROM ans
      UNION ALL SELECT decision, text, 'conflicting', unnest(conflicting), generate_subscripts(conflicting, 1) - 1 FROM ans)
    SELECT decision AS side, '$.' || bucket || '_evidence[' || i || ']' AS path, 'not_in_posting' AS reason, count(*) AS misses FROM q
    WHERE {SQL_WORDS.format('quote')} = '' OR NOT contains(' ' || {SQL_WORDS.format('text')} || ' ', ' ' || {SQL_WORDS.format('quote')} || ' ') GROUP BY 1, 2""",
)
def miss_counts(t):
    sided = typed(t).withColumn("side", F.col("answer.decision"))
    misses = answers.answer_misses(sided, contents(t), ["content_id", "side"])
    return scoring.count_misses(misses)


@query(
    "replay_grid_problems",
    """WITH p AS (SELECT DISTINCT conv_id AS job_id FROM conversations), g AS (SELECT job_id, unnest([1, 2, 3]) AS replay FROM p),
    c AS (SELECT conv_id AS job_id, turn::INT AS replay, count(*) AS n FROM conversations GROUP BY 1, 2)
    SELECT coalesce(g.job_id, c.job_id) AS job_id, coalesce(g.replay, c.replay) AS replay,
      CASE WHEN c.n IS NULL THEN 'missing' WHEN g.job_id IS NULL THEN 'extra' ELSE 'repeated' END AS problem
    FROM g FULL JOIN c ON g.job_id = c.job_id AND g.replay = c.replay WHERE c.n IS NULL OR g.job_id IS NULL OR c.n > 1""",
)
def replay_grid_problems(t):
    calls = t.conversations.select(F.col("conv_id").alias("job_id"), F.col("turn").cast("int").alias("replay"))
    return scoring.grid_problems(calls.select("job_id"), calls, 3)


@query(
    "recording_differences",
    """SELECT job_id, problem FROM (SELECT coalesce(a.doc_id, b.doc_id) AS job_id, CASE WHEN a.doc_id IS NULL OR b.doc_id IS NULL THEN 'jobs_differ'
      WHEN a.n_chars > 3000 THEN 'content_differs' WHEN a.lang = 'fr' THEN 'acceptance_differs' END AS problem
    FROM (SELECT * FROM documents WHERE source <> 'src1') a FULL JOIN (SELECT * FROM documents WHERE source <> 'src2') b ON a.doc_id = b.doc_id) WHERE problem IS NOT NULL""",
)
def recording_differences(t):
    def side(df, hash_of, decision):
        return df.select(
            F.col("doc_id").alias("job_id"), F.col("doc_id").alias("content_id"), hash_of.alias("content_hash"),
            decision.alias("accepted_decision"), F.lit(None).cast("string").alias("accepted_prompt_hash"),
        )

    base = side(t.documents.filter("source <> 'src1'"), F.col("source"), F.col("lang"))
    new = side(
        t.documents.filter("source <> 'src2'"),
        F.when(F.col("n_chars") > 3000, "other").otherwise(F.col("source")),
        F.when(F.col("lang") == "fr", "other").otherwise(F.col("lang")),
    )
    return scoring.recording_differences(base, new)


@query(
    "list_rates",
    """WITH e AS (SELECT DISTINCT l_orderkey AS c, CASE l_returnflag WHEN 'R' THEN 'benefits' ELSE 'responsibilities' END AS f, l_suppkey AS i FROM lineitem WHERE l_quantity > 10),
    a AS (SELECT DISTINCT l_orderkey AS c, CASE l_returnflag WHEN 'R' THEN 'benefits' ELSE 'responsibilities' END AS f, l_suppkey AS i FROM lineitem WHERE l_quantity < 45)
    SELECT coalesce(e.f, a.f) AS field, count(*) FILTER (e.f IS NOT NULL AND a.f IS NOT NULL) AS matched, count(a.f) AS predicted, count(e.f) AS wanted,
      round(count(*) FILTER (e.f IS NOT NULL AND a.f IS NOT NULL) / count(a.f), 9) AS precision FROM e FULL JOIN a ON e.c = a.c AND e.f = a.f AND e.i = a.i GROUP BY 1""",
)
def list_rates(t):
    def items(df, lead):
        return df.select(
            F.col("l_orderkey").alias("case_id"),
            F.when(F.col("l_returnflag") == "R", "benefits").otherwise("responsibilities").alias("field"),
            F.concat(F.lit(lead), F.col("l_suppkey").cast("string")).alias("item"),
        )

    rates = scoring.list_rates(items(t.lineitem.filter("l_quantity > 10"), " Item "), items(t.lineitem.filter("l_quantity < 45"), "ITEM "))
    return rates.select("field", "matched", "predicted", "wanted", F.round("precision", 9).alias("precision"))


@query(
    "metadata_rates",
    """SELECT 'work_mode' AS field, count(*) AS total, count(*) FILTER (o_orderstatus = 'O') AS matches FROM orders
    UNION ALL SELECT 'title', count(*), count(*) FROM orders""",
)
def metadata_rates(t):
    base = t.orders.select(F.col("o_orderkey").alias("case_id"), "o_orderstatus", "o_orderpriority")
    expected = base.select("case_id", F.lit("work_mode").alias("field"), F.lit("o").alias("value")).unionByName(
        base.select("case_id", F.lit("title").alias("field"), F.lower("o_orderpriority").alias("value"))
    )
    actual = base.select("case_id", F.lit("work_mode").alias("field"), F.col("o_orderstatus").alias("value")).unionByName(
        base.select("case_id", F.lit("title").alias("field"), F.concat("o_orderpriority", F.lit(" ")).alias("value"))
    )
    return scoring.metadata_rates(expected, actual).select("field", "total", "matches")


@query(
    "obligation_results",
    f"""WITH q AS (SELECT doc_id, {SQL_WORDS.format('text')} AS dk, {SQL_WORDS.format('split_part(text, chr(10), 1)')} AS first FROM documents)
    SELECT doc_id AS case_id, count(*) AS met FROM (
      SELECT doc_id FROM q WHERE first <> '' UNION ALL SELECT doc_id FROM q WHERE first <> '' AND contains(' ' || dk || ' ', ' the ')) GROUP BY 1""",
)
def obligation_results(t):
    first = F.substring_index("text", "\n", 1)
    case = F.col("doc_id").alias("case_id")

    def obligation(name, role, alternatives):
        return t.documents.select(
            case, F.lit(name).alias("obligation_id"), F.lit(role).alias("role"), F.lit(True).alias("critical"), alternatives.alias("alternatives")
        )

    # The second obligation needs the conflicting bucket only when some line says "the".
    wanted = obligation("E1", "supporting", F.array(F.lit("never said so"), F.upper(first))).unionByName(
        obligation("E2", "either", F.array(F.lit("THE")))
    )
    cited = t.documents.select(case, F.lit(1).alias("replay"), F.lit("supporting").alias("bucket"), first.alias("excerpt")).unionByName(
        t.documents.select(case, F.lit(1).alias("replay"), F.lit("conflicting").alias("bucket"), F.col("text").alias("excerpt"))
    )
    pairs = t.documents.select(case, F.lit("E1").alias("left_id"), F.lit("E2").alias("right_id"))
    met, _ = phrases.obligation_results(wanted, cited, pairs)
    said = t.documents.filter(first != "").select(case)
    return met.join(said, "case_id", "left_semi").join(
        t.documents.select(case, tx.word_key(first).alias("k")).filter("k <> ''"), "case_id", "left_semi"
    ).groupBy("case_id").agg(F.count("*").alias("met"))


def extracted(t):
    """Documents as extracted facts: title and summary from the first line, some of them lost."""
    line = F.substring_index("text", "\n", 1)
    quote = F.when(F.col("lang") == "de", F.lit("not in there at all")).otherwise(F.upper(line))
    filled = {
        "title": (F.when(F.col("n_chars") < 100, "extracted").otherwise("uncertain"), line, line),
        "summary": (F.lit("extracted"), line, quote),
        "compensation_text": (F.lit("extracted"), F.lit("x"), line),
        "requisition_id": (F.lit("extracted"), F.lit("y"), line),
        "location_text": (F.lit("extracted"), F.lit("z"), line),
    }
    fields = []
    for f in FACTS.fields:
        if f.name in filled:
            state, value, said = filled[f.name]
            fact = F.struct(state.alias("state"), value.alias("value"), F.array(said).alias("evidence"))
        else:
            fact = F.struct(
                F.lit("not_stated").alias("state"), F.lit(None).alias("value"), F.array().cast("array<string>").alias("evidence")
            )
        fields.append(fact.cast(f.dataType).alias(f.name))
    return t.documents.select(F.col("doc_id").alias("content_id"), F.struct(*fields).alias("facts"))


@query(
    "validated_facts",
    f"""WITH d AS (SELECT doc_id, lang, n_chars, text, {SQL_IDENTITY.format('split_part(text, chr(10), 1)')} AS k FROM documents)
    SELECT doc_id AS content_id, false AS rejected, CASE WHEN lang = 'de' THEN 'failed' ELSE 'extracted_or_uncertain' END AS summary_state,
      CASE WHEN lang = 'de' THEN 1 ELSE 0 END::BIGINT AS ungrounded_notes FROM d""",
)
def validated_facts(t):
    checked = facts.validate_facts(extracted(t), contents(t))
    return checked.select(
        "content_id",
        "rejected",
        F.when(F.col("facts.summary.state") == "failed", "failed").otherwise("extracted_or_uncertain").alias("summary_state"),
        F.size(F.filter("notes", lambda n: F.contains(n, F.lit("ungrounded")))).cast("long").alias("ungrounded_notes"),
    )


@query(
    "fact_quotes",
    """SELECT path, count(*) AS quotes FROM documents, (SELECT unnest(['$.title.evidence[0]', '$.summary.evidence[0]', '$.compensation_text.evidence[0]',
      '$.requisition_id.evidence[0]', '$.location_text.evidence[0]']) AS path) GROUP BY 1""",
)
def fact_quotes(t):
    return facts.fact_quotes(extracted(t), ["content_id"]).groupBy("path").agg(F.count("*").alias("quotes"))


@query(
    "failed_fields",
    """SELECT '$.summary.state' AS failed_field, count(*) AS results FROM documents WHERE lang = 'de'""",
)
def failed_fields(t):
    checked = facts.validate_facts(extracted(t), contents(t))
    return facts.failed_fields(checked, ["content_id"]).groupBy("failed_field").agg(F.count("*").alias("results"))


@query(
    "fact_violations",
    """SELECT 'title' AS field, 'quote_blank' AS rule, count(*) AS results FROM documents WHERE NOT regexp_matches(split_part(text, chr(10), 1), '\\S') HAVING count(*) > 0
    UNION ALL SELECT 'source_language', 'language_code', count(*) FROM documents WHERE lang = 'fr'
    UNION ALL SELECT 'source_language', 'extracted_incomplete', count(*) FROM documents""",
)
def fact_violations(t):
    odd = extracted(t).join(t.documents.select(F.col("doc_id").alias("content_id"), "lang"), "content_id")
    value = F.when(F.col("lang") == "fr", "FR").otherwise(F.col("lang"))
    odd = odd.withColumn(
        "facts",
        F.col("facts").withField(
            "source_language",
            F.struct(F.lit("extracted").alias("state"), value.alias("value"), F.array().cast("array<string>").alias("evidence")),
        ),
    )
    found = facts.fact_violations(odd, ["content_id"])
    return found.groupBy("field", "rule").agg(F.count("*").alias("results"))


@query(
    "replay_shape_violations",
    """SELECT rule, count(*) AS calls FROM (
      SELECT 'decision_without_grounding' AS rule FROM orders WHERE (o_orderstatus = 'O') <> (o_orderpriority <> '1-URGENT')
      UNION ALL SELECT 'unsafe_response_path' FROM orders WHERE o_orderpriority = '5-LOW') GROUP BY 1""",
)
def replay_shape_violations(t):
    grounded = F.col("o_orderstatus") == "O"
    calls = t.orders.select(
        F.lit("r").alias("run_id"), F.col("o_orderkey").alias("job_id"), F.lit(1).alias("replay"),
        F.when(grounded, "grounded").otherwise("model_error").alias("status"),
        F.when(F.col("o_orderpriority") != "1-URGENT", "eligible").alias("decision"),
        F.when(grounded, F.lit(1)).alias("supporting_count"), F.when(grounded, F.lit(0)).alias("conflicting_count"),
        F.when(grounded, F.lit(False)).alias("missing_information"),
        F.array().cast("array<string>").alias("structural_errors"), F.array().cast("array<string>").alias("grounding_misses"),
        F.when(F.col("o_orderpriority") == "5-LOW", "../x.json").otherwise("a/b.json").alias("raw_response_path"),
    )
    return answers.replay_shape_violations(calls).groupBy("rule").agg(F.count("*").alias("calls"))


# Board payloads written from the tables: suppliers as postings, one per payload.
def suppliers(t):
    return t.supplier.join(
        t.nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("board")), "s_nationkey"
    )



@query(
    "greenhouse_postings",
    """SELECT n_name AS board, 'https://b/' || s_suppkey AS url FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 5000""",
)
def greenhouse_postings(t):
    place = F.when(F.col("s_acctbal") > 5000, "Heredia, Costa Rica").otherwise("San Jose, CA")
    rows = suppliers(t)
    boards = rows.select("board",
        F.to_json(
            F.struct(
                F.array(
                    F.struct(
                        F.concat(F.lit("https://b/"), F.col("s_suppkey").cast("string")).alias("absolute_url"),
                        F.struct(place.alias("name")).alias("location"),
                    )
                ).alias("jobs")
            )
        ).alias("payload")
    )
    return payloads.select_region(payloads.greenhouse(boards)).select("board", "url")


@query(
    "phenom_postings",
    """SELECT n_name AS board, 'https://b/job/' || s_suppkey || '/' || regexp_replace(s_name, '[^A-Za-z0-9]+', '-', 'g') AS url, s_acctbal > 5000 AS in_region
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def phenom_postings(t):
    rows = suppliers(t)
    jobs = F.array(
        F.struct(
            F.col("s_suppkey").alias("jobId"),
            F.col("s_name").alias("title"),
            F.lit("United Kingdom").alias("country"),
            F.array(F.struct(F.when(F.col("s_acctbal") > 5000, "Sabana, Costa Rica").otherwise("Leeds").alias("location"))).alias("multi_location_array"),
        )
    )
    boards = rows.select("board",
        F.to_json(F.struct(F.struct(F.struct(jobs.alias("jobs")).alias("data")).alias("refineSearch"))).alias("payload")
    ).withColumn("origin", F.lit("https://b")).withColumn("path_prefix", F.lit("/job"))
    return payloads.phenom(boards).select("board", "url", "in_region")


@query(
    "coveo_postings",
    """SELECT n_name AS board, 'https://b/' || s_suppkey AS url FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 5000 OR s_suppkey % 2 = 0""",
)
def coveo_postings(t):
    rows = suppliers(t)
    results = F.array(
        F.struct(
            F.concat(F.lit("https://b/"), F.col("s_suppkey").cast("string")).alias("clickUri"),
            F.struct(
                F.when(F.col("s_acctbal") > 5000, "Costa Rica").otherwise("").alias("country"),
                F.array(F.when(F.col("s_suppkey") % 2 == 0, "Heredia").otherwise("Leeds")).alias("city"),
            ).alias("raw"),
        )
    )
    boards = rows.select("board",
        F.to_json(F.struct(results.alias("results"))).alias("payload")
    ).withColumn("page", F.lit(1))
    return payloads.coveo_in_region(boards).select("board", "url")


@query(
    "bamboohr_postings",
    """SELECT n_name AS board, 'https://b/careers/' || s_suppkey AS url FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 5000""",
)
def bamboohr_postings(t):
    rows = suppliers(t)
    rich = F.col("s_acctbal") > 5000
    result = F.array(
        F.struct(
            F.col("s_suppkey").alias("id"),
            F.struct(F.when(rich & (F.col("s_suppkey") % 2 == 0), "CR").alias("country")).alias("atsLocation"),
            F.struct(F.when(rich, "Cartago").otherwise("Leeds").alias("city")).alias("location"),
        )
    )
    boards = rows.select("board",
        F.to_json(F.struct(result.alias("result"))).alias("payload")
    ).withColumn("origin", F.lit("https://b"))
    return payloads.bamboohr_in_region(boards).select("board", "url")


@query(
    "regions_of_locations",
    """SELECT region, count(*) AS suppliers FROM (SELECT 'north' AS region FROM supplier WHERE s_nationkey < 12 UNION ALL SELECT 'codes' FROM supplier WHERE s_nationkey >= 12) GROUP BY 1""",
)
def regions_of_locations(t):
    rows = t.supplier.select(F.when(F.col("s_nationkey") < 12, "Upper NORTH side").otherwise("XY, 12").alias("location"))
    rules = {"north": (["north"], []), "codes": (["south"], ["XY"])}
    return payloads.select_region_rules(rows, rules).groupBy("region").agg(F.count("*").alias("suppliers"))


@query(
    "replaced_snapshot",
    """SELECT source AS company_slug, url, min(ord) AS ord FROM (
      SELECT source, lang || n_chars AS url, doc_id AS ord FROM documents WHERE source <> 'src1' AND doc_id >= 500 AND source IN ('src2', 'src3', 'src4')
      UNION ALL SELECT source, lang || n_chars, doc_id FROM documents WHERE doc_id < 500 AND source NOT IN ('src1', 'src2', 'src3', 'src4')) GROUP BY 1, 2""",
)
def replaced_snapshot(t):
    rows = t.documents.select(
        F.col("source").alias("company_slug"), F.concat("lang", F.col("n_chars").cast("string")).alias("url"),
        F.col("doc_id").alias("ord"),
    )
    first = rows.filter("ord < 500").groupBy("company_slug", "url").agg(F.min("ord").alias("ord")).withColumn(
        "captured_at", F.lit("2024-01-01").cast("timestamp_ntz")
    )
    named = rows.filter("company_slug in ('src1', 'src2', 'src3', 'src4')").select("company_slug").distinct()
    # src1 is in the batch without URLs: its old set must go.
    batch = rows.filter("ord >= 500 and company_slug <> 'src1'")
    return sinks.replaced_snapshot(first, batch, named, "2024-01-02 00:00:00").select("company_slug", "url", "ord")


@query(
    "accepted_envelopes",
    """SELECT 'c' || o_custkey AS company_slug, o_orderkey AS job_id FROM orders WHERE o_orderstatus = 'F'""",
)
def accepted_envelopes(t):
    jobs = t.orders.select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("company_slug"),
        F.col("o_orderpriority").alias("url_key"),
    )
    results = t.orders.select(
        F.col("o_orderkey").alias("job_id"), F.lit(True).alias("is_current"), F.lit(1).alias("schema_version"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("accepted_at"), F.to_json(F.struct("o_totalprice")).alias("result_json"),
    )
    outcomes = t.orders.select(
        F.col("o_orderkey").alias("job_id"), F.when(F.col("o_orderstatus") == "F", "completed_eligible").otherwise("failed").alias("status")
    )
    rows = sinks.accepted_envelopes(jobs, results, outcomes)
    parsed = F.from_json("value", "job_id long, company_slug string, result struct<o_totalprice:double>")
    return rows.select(parsed.alias("v")).filter("v.result.o_totalprice is not null").select("v.company_slug", "v.job_id")


@query(
    "extraction_reports",
    """SELECT source AS company_slug, count(*) AS total, ((max(doc_id) // 100) - (min(doc_id) // 100) + 1)::BIGINT AS parts FROM documents GROUP BY 1""",
)
def extraction_reports(t):
    urls = t.documents.select(F.col("source").alias("company_slug"), F.col("doc_id").alias("ord"), F.col("lang").alias("url"))
    names = urls.select(F.col("company_slug").alias("slug")).distinct().select("slug", F.col("slug").alias("name"), F.lit("https://b").alias("job_board_url"))
    runs = names.select(F.col("slug").alias("company_slug"), F.lit("dom").alias("strategy"), F.lit(1.234).alias("seconds"), F.lit(None).cast("string").alias("error"))
    parts = sinks.extraction_reports(names, urls, runs, part_size=100)
    parsed = F.from_json("value", "jobs array<string>, metadata struct<total_jobs_found:bigint>")
    return parts.select("company_slug", parsed.alias("v")).groupBy("company_slug").agg(
        F.sum(F.size("v.jobs")).alias("total"), F.count("*").alias("parts")
    )


@query(
    "guarded_snapshot",
    """WITH d AS (SELECT doc_id, source, coalesce(lang, '') AS lang, n_chars FROM documents),
    kept AS (SELECT source FROM d GROUP BY 1 HAVING bool_or(source = 'src3' AND doc_id % 50 = 7) OR source IN ('src4', 'src5')),
    fresh AS (SELECT source, 'https://x.example/' || doc_id AS url, doc_id * 2 AS ord FROM d UNION ALL SELECT source, lang || n_chars, doc_id * 2 + 1 FROM d)
    SELECT source AS company_slug, url, min(ord) AS ord FROM fresh WHERE source NOT IN (FROM kept) GROUP BY 1, 2
    UNION ALL SELECT source, 'old' || lang, min(doc_id) FROM d WHERE source IN (FROM kept) GROUP BY 1, 2""",
)
def guarded_snapshot(t):
    """Boards are sources with a payload page per document; src3 has broken pages, src4 and src5 promise too much."""
    docs = t.documents.select("doc_id", "source", F.coalesce("lang", F.lit("")).alias("lang"), "n_chars")
    promised = docs.groupBy("source").agg((F.count("*") * 2).alias("_n"))

    def item(link):
        return F.struct(link.alias("clickUri"), F.struct(F.lit("Costa Rica").alias("country")).alias("raw"))

    payload = F.to_json(
        F.struct(
            (F.col("_n") + F.col("source").isin("src4", "src5").cast("int")).alias("totalCount"),
            F.array(
                item(F.concat(F.lit("https://x.example/"), F.col("doc_id").cast("string"))),
                item(F.concat("lang", F.col("n_chars").cast("string"))),
            ).alias("results"),
        )
    )
    broken = (F.col("source") == "src3") & (F.col("doc_id") % 50 == 7)
    pages = docs.join(promised, "source").select(
        F.col("source").alias("board"), F.col("doc_id").alias("page"), F.when(broken, "{").otherwise(payload).alias("payload")
    )
    batch = payloads.coveo(pages).select(
        F.col("board").alias("company_slug"), "url", (F.col("page") * 2 + F.col("ord")).alias("ord")
    )
    stored = docs.groupBy(F.col("source").alias("company_slug"), F.concat(F.lit("old"), "lang").alias("url")).agg(
        F.min("doc_id").alias("ord")
    ).withColumn("captured_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    kept = sinks.guarded_snapshot(stored, batch, payloads.coveo_counts(pages), "2024-01-02 00:00:00")
    return kept.select("company_slug", "url", "ord")
