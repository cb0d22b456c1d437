"""Queries over document texts: identity, merges, phrases, content rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacantia.functions import text as tx
from vacantia.functions import urls
from vacantia.operators import content, facts, history, identity, merging, phrases
from vacantia.session import cut_lineage
from vacantia.workloads.base import query

# Folding in check SQL: lower case plus the one full folding the texts need.
SQL_FOLD = "replace(lower({0}), 'ß', 'ss')"
SQL_IDENTITY = "trim(regexp_replace(" + SQL_FOLD + r", '\s+', ' ', 'g'))"
SQL_WORDS = "trim(regexp_replace(" + SQL_FOLD + r", '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
SQL_TIDY = (
    r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '\r\n?', chr(10), 'g'),"
    r" '[ \t\f\v]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10))"
)
SQL_DOCS = f"""
d AS (
  SELECT doc_id, source, lang, n_chars, text, split_part(text, chr(10), 1) AS title,
    lang || '-' || n_chars AS requisition_id
  FROM documents
),
c AS (
  SELECT *, {SQL_IDENTITY.format('title')} AS title_key,
    sha256({SQL_IDENTITY.format('title')} || chr(10) || {SQL_IDENTITY.format('text')}) AS fingerprint FROM d
)"""


def contents(t):
    """Documents as stored contents: one per job, title on the first line."""
    title = F.substring_index("text", "\n", 1)
    return t.documents.select(
        F.col("doc_id").alias("id"),
        F.col("doc_id").alias("job_id"),
        F.col("source").alias("company_slug"),
        title.alias("title"),
        F.concat_ws("-", "lang", F.col("n_chars").cast("string")).alias("requisition_id"),
        tx.fingerprint(title, "text").alias("fingerprint"),
        F.timestamp_seconds("doc_id").cast("timestamp_ntz").alias("retrieved_at"),
        "text",
    )


def document_jobs(t):
    return t.documents.select(
        F.col("doc_id").alias("id"),
        F.col("source").alias("company_slug"),
        F.when(F.col("lang") == "de", "in_progress").otherwise("new").alias("status"),
        F.lit(None).cast("long").alias("merged_into_id"),
    )


@query("fingerprints", f"WITH {SQL_DOCS} SELECT doc_id, fingerprint FROM c")
def fingerprints(t):
    return contents(t).select(F.col("id").alias("doc_id"), "fingerprint")


@query(
    "content_hashes",
    f"SELECT doc_id, sha256({SQL_TIDY.format('text')}) AS content_hash FROM documents",
)
def content_hashes(t):
    return t.documents.select("doc_id", tx.content_hash("text").alias("content_hash"))


@query(
    "normalized_lengths",
    f"SELECT doc_id, length({SQL_TIDY.format('text')})::BIGINT AS chars FROM documents",
)
def normalized_lengths(t):
    return t.documents.select("doc_id", F.length(tx.normalize("text")).cast("long").alias("chars"))


@query(
    "word_counts",
    f"""SELECT doc_id, len(string_split({SQL_WORDS.format('text')}, ' '))::BIGINT AS words,
      sha256({SQL_WORDS.format('text')}) AS word_hash FROM documents""",
)
def word_counts(t):
    keyed = t.documents.select("doc_id", tx.word_key("text").alias("key"))
    return keyed.select(
        "doc_id", F.size(F.split("key", " ")).cast("long").alias("words"), F.sha2("key", 256).alias("word_hash")
    )


@query(
    "word_spans",
    f"""SELECT doc_id, len(string_split({SQL_WORDS.format('text')}, ' '))::BIGINT AS spans,
      split_part({SQL_WORDS.format('text')}, ' ', 1) AS first_word FROM documents""",
)
def word_spans(t):
    spanned = t.documents.select("doc_id", tx.word_spans("text").alias("s"))
    # A text without words counts as one empty word, as in the check SQL and in word_counts.
    none = F.size("s") == 0
    return spanned.select(
        "doc_id",
        F.when(none, 1).otherwise(F.size("s")).cast("long").alias("spans"),
        F.when(none, "").otherwise(F.get("s", F.lit(0))["word"]).alias("first_word"),
    )


@query(
    "grounding_texts",
    f"SELECT doc_id, sha256({SQL_IDENTITY.format('text')}) AS folded_hash FROM documents",
)
def grounding_texts(t):
    return t.documents.select("doc_id", F.sha2(tx.grounding_text("text"), 256).alias("folded_hash"))


@query(
    "closed_texts",
    "SELECT doc_id FROM documents WHERE n_chars < 300 OR regexp_matches(lower(text), 'this position has been filled')",
)
def closed_texts(t):
    text = F.when(
        F.col("n_chars") < 300, F.concat("text", F.lit("\nThis POSITION  has been filled."))
    ).otherwise(F.col("text"))
    shown = t.documents.select("doc_id", tx.normalize(text).alias("n"))
    return shown.filter(tx.looks_closed(F.col("n"))).select("doc_id")


@query(
    "expired_postings",
    """SELECT o_orderkey FROM orders WHERE o_orderpriority <> '5-LOW' AND o_orderdate < DATE '1997-01-01'""",
)
def expired_postings(t):
    valid = F.when(
        F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    ).when(F.col("o_orderpriority") == "5-LOW", "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.filter(tx.is_expired(valid, F.lit("1997-01-01").cast("date"))).select("o_orderkey")


@query(
    "naive_utc_times",
    "SELECT o_orderkey, o_orderdate - INTERVAL 2 HOUR AS moment FROM orders",
)
def naive_utc_times(t):
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'+02:00'")
    return t.orders.select("o_orderkey", tx.naive_utc(text).alias("moment"))


@query(
    "paragraphs_once",
    f"""WITH n AS (SELECT doc_id, {SQL_TIDY.format('text')} AS x FROM documents),
    l AS (SELECT doc_id, unnest(string_split(x || chr(10) || x, chr(10))) AS line,
      generate_subscripts(string_split(x || chr(10) || x, chr(10)), 1) AS i FROM n),
    f AS (SELECT doc_id, line, min(i) AS i FROM l WHERE line <> '' GROUP BY 1, 2)
    SELECT doc_id, sha256(string_agg(line, chr(10) ORDER BY i)) AS paragraphs FROM f GROUP BY 1""",
)
def paragraphs_once(t):
    twice = t.documents.withColumn("again", F.col("text"))
    return content.paragraphs_once(twice, "text", "again").select(
        "doc_id", F.sha2("paragraphs", 256).alias("paragraphs")
    )


@query(
    "secret_findings",
    r"""SELECT pattern, count(*) AS documents FROM (
      SELECT CASE k WHEN 1 THEN 'credential_value' WHEN 2 THEN 'token_parameter'
          WHEN 3 THEN 'authorization_header' ELSE 'cookie_header' END AS pattern,
        CASE k WHEN 1 THEN regexp_matches(text, '(?i)(?:access[_-]?token|api[_-]?key|client[_-]?secret|password)\s*[=:]\s*[^\s"''&<>]+')
          WHEN 2 THEN regexp_matches(text, '(?i)[?&](?:token|access_token|api_key|key|secret)=[^&#\s"''<>]+')
          WHEN 3 THEN regexp_matches(text, '(?i)(?:authorization\s*[=:]\s*(?:bearer|basic)\s+)[A-Za-z0-9._~+/-]+=*')
          ELSE regexp_matches(text, '(?i)(?:set-cookie|cookie)\s*:') END AS hit
      FROM (SELECT CASE WHEN n_chars < 400 THEN text || ' Cookie: a Password=b' ELSE text END AS text FROM documents),
           (SELECT unnest([1, 2, 3, 4]) AS k))
    WHERE hit GROUP BY 1""",
)
def secret_findings(t):
    text = F.when(
        F.col("n_chars") < 400, F.concat("text", F.lit(" Cookie: a Password=b"))
    ).otherwise(F.col("text"))
    return (
        t.documents.select(F.explode(tx.secret_names(text)).alias("pattern"))
        .groupBy("pattern")
        .agg(F.count("*").alias("documents"))
    )


_SQL_CREDENTIAL = tx.CREDENTIAL.removeprefix("(?i)").replace("'", "''")


@query(
    "redacted_messages",
    rf"""WITH f AS (SELECT doc_id, 'at https://U:p@H.example.com:8080/a/b?t=1#x ' || regexp_extract(text, '^[^\n\r]*') AS line FROM documents),
    u AS (SELECT doc_id, regexp_replace(regexp_replace(line, 'https://U:p@H.example.com:8080/a/b\?t=1#x', 'https://h.example.com:8080/a/b'),
        '(https?)://([\w.-]+(?::\d+)?)(/[^\s<>"''?#]*)?(?:[?#][^\s<>"'']*)?', '\1://\2\3', 'g') AS line FROM f)
    SELECT doc_id, left(trim(regexp_replace(regexp_replace(line, '{_SQL_CREDENTIAL}', '<redacted>', 'gi'), '\s+', ' ', 'g')), 200) AS message FROM u""",
)
def redacted_messages(t):
    message = F.concat(F.lit("at https://U:p@H.example.com:8080/a/b?t=1#x "), "text")
    return t.documents.select("doc_id", urls.redact_message(message).alias("message"))


@query(
    "proper_nouns",
    r"""SELECT doc_id, list_sum([1 for m in regexp_extract_all('. ' || x, '(?:[.!?]\s*)?[A-Z][A-Za-z0-9.+#-]*[A-Za-z0-9]\b')
        if regexp_matches(m, '^[A-Z]')])::BIGINT AS nouns
    FROM (SELECT doc_id, regexp_replace(regexp_replace(text, '[^\x00-\x7f]+', ' ', 'g'), '[^A-Za-z.!? ]+', ' ', 'g') AS x FROM documents)
    WHERE len([1 for m in regexp_extract_all('. ' || x, '(?:[.!?]\s*)?[A-Z][A-Za-z0-9.+#-]*[A-Za-z0-9]\b')
        if regexp_matches(m, '^[A-Z]')]) > 0""",
)
def proper_nouns(t):
    plain = F.regexp_replace(F.regexp_replace("text", r"[^\x{00}-\x{7f}]+", " "), "[^A-Za-z.!? ]+", " ")
    # Tokens of two and more characters, as the check pattern needs.
    nouns = F.filter(tx.proper_nouns(plain), lambda n: F.length(n) > 1)
    return t.documents.select("doc_id", F.size(nouns).cast("long").alias("nouns")).filter("nouns > 0")


@query(
    "duplicate_matches",
    f"""WITH {SQL_DOCS},
    gf AS (SELECT source, fingerprint AS k, min(doc_id) AS lo, max(doc_id) AS hi FROM c GROUP BY 1, 2 HAVING count(*) = 2),
    gr AS (SELECT source, requisition_id AS k, min(doc_id) AS lo, max(doc_id) AS hi FROM c GROUP BY 1, 2 HAVING count(*) = 2),
    m AS (SELECT c.doc_id, c.lang, c.title_key,
        CASE WHEN c.doc_id = gr.lo THEN gr.hi ELSE gr.lo END AS by_req,
        CASE WHEN c.doc_id = gf.lo THEN gf.hi ELSE gf.lo END AS by_print
      FROM c LEFT JOIN gf ON gf.source = c.source AND gf.k = c.fingerprint
             LEFT JOIN gr ON gr.source = c.source AND gr.k = c.requisition_id),
    e AS (SELECT m.doc_id, m.lang, CASE WHEN o.title_key = m.title_key AND m.title_key <> '' THEN by_req END AS req, by_print
      FROM m LEFT JOIN c o ON o.doc_id = m.by_req),
    x AS (SELECT greatest(doc_id, coalesce(req, by_print)) AS folded, least(doc_id, coalesce(req, by_print)) AS canonical_id,
        CASE WHEN req IS NOT NULL THEN 'requisition' ELSE 'fingerprint' END AS matched_by,
        coalesce(req, by_print) < doc_id AS own FROM e WHERE coalesce(req, by_print) IS NOT NULL)
    SELECT folded AS job_id, min(canonical_id) AS canonical_id,
      arg_min(matched_by, (canonical_id, matched_by = 'fingerprint')) AS matched_by
    FROM x JOIN d ON d.doc_id = x.folded WHERE own OR d.lang <> 'de' GROUP BY 1""",
)
def duplicate_matches(t):
    # Contents are stored rows when merges are looked for; so they are here.
    return identity.duplicate_matches(document_jobs(t), cut_lineage(contents(t).drop("text")))


@query(
    "key_partners",
    f"""WITH {SQL_DOCS} SELECT source AS company_slug, fingerprint, min(doc_id) AS low, max(doc_id) AS high
    FROM c GROUP BY 1, 2 HAVING count(*) = 2""",
)
def key_partners(t):
    return identity.key_partners(contents(t), "fingerprint")


@query(
    "fold_in_order",
    f"""WITH {SQL_DOCS} SELECT doc_id AS job_id, min(doc_id) OVER (PARTITION BY source, fingerprint) AS canonical_id FROM c""",
)
def fold_in_order(t):
    postings = contents(t).select(
        "job_id",
        "company_slug",
        F.lit(None).cast("string").alias("requisition_id"),
        tx.comparable_title("title").alias("title_key"),
        "fingerprint",
    )
    return identity.fold_in_order(postings)


def run_arrivals(t):
    """Two runs over all documents: first whole texts by id, then shortened ones in the opposite order."""
    stored = contents(t)
    title = F.col("title")
    first = stored.select("job_id", "requisition_id", "title", "fingerprint", (F.col("job_id") + 1).alias("turn"))
    shortened = tx.fingerprint(title, F.substring_index("text", "\n", 2))
    second = stored.select(
        "job_id", "requisition_id", "title", shortened.alias("fingerprint"), (F.lit(1 << 40) - F.col("job_id")).alias("turn")
    )
    return cut_lineage(first), cut_lineage(second)


@query("merges_of_two_runs")
def merges_of_two_runs(t):
    first, second = run_arrivals(t)
    jobs = document_jobs(t).withColumns(
        {"next_attempt_after": F.lit(None).cast("timestamp_ntz"), "current_attempt_id": F.lit(None).cast("long"), "updated_at": F.lit(None).cast("timestamp_ntz")}
    )
    kept = contents(t).drop("text")
    index = merging.key_index(jobs, kept.filter("false"))
    one = merging.fold_run(jobs, kept.filter("false"), first, index)
    index = merging.grown_index(index, jobs, first, one)
    later = history.apply_merges(jobs, one, F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"))
    two = merging.fold_run(later, kept, second, index)
    return one.withColumn("run", F.lit(1)).unionByName(two.withColumn("run", F.lit(2))).drop("turn")


@query(
    "duplicate_texts",
    f"""WITH {SQL_DOCS} SELECT source AS company_slug, fingerprint, count(*) AS copies FROM c
    GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicate_texts(t):
    return (
        contents(t)
        .groupBy("company_slug", "fingerprint")
        .agg(F.count("*").alias("copies"))
        .filter("copies > 1")
    )


@query(
    "phrases_in_documents",
    f"""WITH p AS (SELECT item_id, {SQL_WORDS.format('text')} AS k FROM benchmark),
    d AS (SELECT doc_id, ' ' || {SQL_WORDS.format('text')} || ' ' AS w FROM documents)
    SELECT item_id, doc_id FROM p JOIN d ON k <> '' AND contains(w, ' ' || k || ' ')""",
)
def phrases_in_documents(t):
    return phrases.unbound_phrases(
        t.benchmark.select("item_id", F.col("text").alias("phrase")), t.documents
    )


@query(
    "short_phrases_in_documents",
    f"""WITH p AS (SELECT item_id, array_to_string(string_split({SQL_WORDS.format('text')}, ' ')[4:6], ' ') AS k FROM benchmark),
    d AS (SELECT doc_id, ' ' || {SQL_WORDS.format('text')} || ' ' AS w FROM documents)
    SELECT item_id, doc_id FROM p JOIN d ON k <> '' AND contains(w, ' ' || k || ' ')""",
)
def short_phrases_in_documents(t):
    words = t.benchmark.select("item_id", tx.word_key("text").alias("key"))
    return phrases.unbound_phrases(
        words.select("item_id", F.array_join(F.slice(F.split("key", " "), 4, 3), " ").alias("phrase")),
        t.documents,
    )


SQL_QUOTES = f"""
q AS (
  SELECT doc_id AS content_id, 0 AS position, upper(regexp_replace(split_part(text, chr(10), 1), '[.,]', ' ;', 'g')) AS quote FROM documents
  UNION ALL SELECT doc_id - 1, 1, split_part(text, chr(10), 1) FROM documents WHERE doc_id > 0
),
k AS (
  SELECT q.*, {SQL_WORDS.format('quote')} AS qk, {SQL_WORDS.format('text')} AS dk, text
  FROM q LEFT JOIN documents ON doc_id = content_id
)"""


def quotes(t):
    """Two quotes per document: its own first line rewritten, and its neighbour's."""
    first = F.substring_index("text", "\n", 1)
    own = t.documents.select(
        F.col("doc_id").alias("content_id"),
        F.lit(0).alias("position"),
        F.upper(F.regexp_replace(first, "[.,]", " ;")).alias("quote"),
    )
    other = t.documents.filter("doc_id > 0").select(
        (F.col("doc_id") - 1).alias("content_id"), F.lit(1).alias("position"), first.alias("quote")
    )
    return own.unionByName(other)


def as_contents(t):
    return t.documents.select(F.col("doc_id").alias("content_id"), "text")


@query(
    "bound_quotes",
    f"""WITH {SQL_QUOTES} SELECT content_id, position, qk <> '' AND coalesce(contains(' ' || dk || ' ', ' ' || qk || ' '), false) AS found,
      CASE WHEN qk <> '' AND contains(' ' || dk || ' ', ' ' || qk || ' ') THEN
        len(string_split(left(' ' || dk, instr(' ' || dk || ' ', ' ' || qk || ' ')::INT), ' ')) - 2 END::BIGINT AS first_word FROM k""",
)
def bound_quotes(t):
    return phrases.bound_quotes(quotes(t), as_contents(t)).select(
        "content_id", "position", "found", F.col("first_word").cast("long").alias("first_word")
    )


@query(
    "located_excerpts",
    f"""WITH {SQL_QUOTES} SELECT content_id, position, qk AS excerpt_words FROM k
    WHERE qk <> '' AND contains(' ' || dk || ' ', ' ' || qk || ' ')""",
)
def located_excerpts(t):
    return phrases.located_quotes(quotes(t), as_contents(t)).filter("found").select(
        "content_id", "position", tx.word_key("excerpt").alias("excerpt_words")
    )


@query(
    "grounding_misses",
    f"""WITH {SQL_QUOTES} SELECT content_id, position, sha256(quote) AS value_sha256, length(quote)::BIGINT AS value_characters FROM k
    WHERE NOT (qk <> '' AND coalesce(contains(' ' || dk || ' ', ' ' || qk || ' '), false))""",
)
def grounding_misses(t):
    return phrases.grounding_misses(phrases.bound_quotes(quotes(t), as_contents(t))).withColumn(
        "value_characters", F.col("value_characters").cast("long")
    )


@query(
    "substring_quotes",
    f"""WITH {SQL_QUOTES} SELECT content_id, position,
      coalesce(contains({SQL_IDENTITY.format('text')}, {SQL_IDENTITY.format('quote')}), false) AS found FROM k""",
)
def substring_quotes(t):
    return phrases.substring_quotes(quotes(t), as_contents(t)).drop("quote")


@query(
    "corpora_overlap",
    r"""WITH h AS (SELECT * FROM documents WHERE quality IS NULL), v AS (SELECT * FROM documents WHERE quality IS NOT NULL),
    l AS (SELECT DISTINCT trim(line) AS line FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM benchmark)
      WHERE len(string_split(trim(regexp_replace(line, '\s+', ' ', 'g')), ' ')) >= 3)
    SELECT doc_id AS case_id, 'text' AS shares FROM h WHERE text IN (SELECT text FROM v)
    UNION SELECT doc_id, 'source_url' FROM h WHERE lang || n_chars IN (SELECT lang || n_chars FROM v)
    UNION SELECT doc_id, 'company' FROM h WHERE source || lang IN (SELECT source || lang FROM v)
    UNION SELECT doc_id, 'example_line' FROM (SELECT doc_id, trim(unnest(string_split(text, chr(10)))) AS line FROM h)
      WHERE line IN (SELECT line FROM l)""".replace(
        "FROM documents WHERE quality", "FROM documents LEFT JOIN labels USING (doc_id) WHERE quality"
    ),
)
def corpora_overlap(t):
    docs = t.documents.select(
        F.col("doc_id").alias("case_id"),
        "text",
        F.concat("lang", F.col("n_chars").cast("string")).alias("source_url"),
        F.concat("source", "lang").alias("company"),
    )
    labelled = t.labels.select(F.col("doc_id").alias("case_id"))
    return phrases.corpora_overlap(
        docs.join(labelled, "case_id", "left_anti"), docs.join(labelled, "case_id", "left_semi"), t.benchmark
    )


@query(
    "required_sections",
    r"""WITH l AS (SELECT doc_id, n_chars, unnest(string_split(text, chr(10))) AS line,
          generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents),
      n AS (SELECT doc_id, count(*) AS n FROM l GROUP BY 1)
    SELECT doc_id, n > 1 AND n_chars > 500 AND last_first AS in_required FROM (
      SELECT n.doc_id, n.n, any_value(n_chars) AS n_chars,
        (SELECT count(*) = 0 FROM documents x WHERE x.doc_id = n.doc_id AND contains(
           trim(regexp_replace(replace(lower(split_part(x.text, chr(10), 1)), 'ß', 'ss'), '\s+', ' ', 'g')),
           trim(regexp_replace(replace(lower(split_part(x.text, chr(10), 2)), 'ß', 'ss'), '\s+', ' ', 'g')))) AS last_first
      FROM n JOIN l USING (doc_id) GROUP BY 1, 2)""",
)
def required_sections(t):
    # The heading goes between the first and the second line of longer texts.
    first = F.substring_index("text", "\n", 1)
    rest = F.substring(F.col("text"), F.length(first) + 2, F.length("text"))
    heading = F.when(F.col("n_chars") > 500, "\nRequirements:\n").otherwise("\n")
    docs = t.documents.select(
        "doc_id",
        F.concat(first, heading, rest).alias("text"),
        F.coalesce(F.try_element_at(F.split("text", "\n"), F.lit(2)), F.lit("")).alias("quote"),
    )
    keyed = docs.withColumn("folded", tx.folded_text("text")).withColumn("key", tx.grounding_text("quote"))
    return keyed.select(
        "doc_id",
        tx.in_required_section(F.col("key"), tx.section_lines("text", "folded")).alias("in_required"),
    )


_MENTIONS = ("Python 3.11", "js", "ReactJS", "C#", "Foo v2", "Postgres", "K8s", "ci/cd 17+")
_SQL_MENTIONS = """
m AS (SELECT p_partkey // 20 AS job_id, p_partkey AS ord,
    ['Python 3.11','js','ReactJS','C#','Foo v2','Postgres','K8s','ci/cd 17+'][p_size % 8 + 1] AS mention,
    CASE WHEN p_retailprice > 1500 THEN 'required' WHEN p_retailprice > 1000 THEN 'preferred' ELSE 'mentioned' END AS status FROM part),
r AS (SELECT *, CASE mention WHEN 'Python 3.11' THEN 'Python' WHEN 'js' THEN 'JavaScript' WHEN 'ReactJS' THEN 'React'
    WHEN 'C#' THEN 'C#' WHEN 'Postgres' THEN 'PostgreSQL' WHEN 'K8s' THEN 'Kubernetes' WHEN 'ci/cd 17+' THEN 'CI/CD'
    ELSE 'raw:foo v2' END AS technology FROM m)"""


def technology_mentions(t):
    return t.part.select(
        F.floor(F.col("p_partkey") / 20).alias("job_id"),
        F.col("p_partkey").alias("ord"),
        F.element_at(tx.fixed_strings(_MENTIONS), F.col("p_size") % 8 + 1).alias("mention"),
        F.when(F.col("p_retailprice") > 1500, "required")
        .when(F.col("p_retailprice") > 1000, "preferred")
        .otherwise("mentioned")
        .alias("status"),
    )


@query("technology_lookup", f"WITH {_SQL_MENTIONS} SELECT technology, count(*) AS mentions FROM r GROUP BY 1")
def technology_lookup(t):
    return (
        facts.resolve_technologies(technology_mentions(t))
        .groupBy("technology")
        .agg(F.count("*").alias("mentions"))
    )


@query(
    "technology_groups",
    f"""WITH {_SQL_MENTIONS} SELECT job_id, technology,
      ['mentioned','preferred','required'][max(list_position(['mentioned','preferred','required'], status))] AS status,
      string_agg(mention, '|' ORDER BY ord) AS mentions FROM r GROUP BY 1, 2""",
)
def technology_groups(t):
    return facts.group_technologies(technology_mentions(t)).select(
        "job_id", "technology", "status", F.array_join("mentions", "|").alias("mentions")
    )


# Main text of a page with plain markup: sections dropped, blocks as line ends, entities read.
SQL_UNESCAPED = "regexp_replace(replace(replace(replace({0}, '&quot;', '\"'), '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g')"
SQL_PAGE_TEXTS = rf"""WITH bare AS (
  SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS title, replace(regexp_replace(html,
    '(?s)<!--.*?-->|<head>.*?</head>|<(?:script|style|nav|footer)>.*?</(?:script|style|nav|footer)>', '', 'g'), chr(10), ' ') AS body
  FROM pages),
shown AS (
  SELECT page_id, {SQL_UNESCAPED.format("title")} AS title, {SQL_UNESCAPED.format(
    "regexp_replace(regexp_replace(body, '</?(?:html|body|div|article|h1|p|br|li|ul)[^>]*>', chr(10), 'g'), '<[^>]*>', '', 'g')")} AS body
  FROM bare),
page_texts AS (
  SELECT page_id, nullif(trim(regexp_replace(title, '[ \t]+', ' ', 'g')), '') AS page_title,
    trim(regexp_replace(regexp_replace(regexp_replace(body, '[ \t]+', ' ', 'g'), '(?m)^ +| +$', '', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'),
      ' ' || chr(10)) AS main_text FROM shown)"""


@query(
    "page_texts",
    f"{SQL_PAGE_TEXTS} SELECT page_id, main_text, page_title, 0 AS structured FROM page_texts",
)
def page_texts(t):
    read = content.read_pages(t.pages.select("page_id", "html"))
    return read.select("page_id", "main_text", "page_title", F.size("postings").alias("structured"))


@query(
    "page_content_gate",
    f"""{SQL_PAGE_TEXTS} SELECT page_id, CASE WHEN length(main_text) >= 400 THEN 'main_content' END AS method,
      CASE WHEN length(main_text) < 400 THEN 'empty_content' END AS failure_category,
      CASE WHEN length(main_text) >= 400 THEN page_title END AS title,
      CASE WHEN length(main_text) >= 400 THEN length(main_text)::INT END AS chars FROM page_texts""",
)
def page_content_gate(t):
    gated = content.page_contents(t.pages, "2024-06-01")
    return gated.select(
        "page_id", "method", "failure_category", "title", F.length("text").alias("chars")
    )


@query(
    "structured_postings",
    """SELECT doc_id AS page_id, lang || '-' || n_chars AS identifier, 'Heredia, CR' AS location,
      lang AS title, CASE WHEN n_chars > 1000 THEN '2020-01-01' ELSE '2999-01-01' END AS valid_through FROM documents""",
)
def structured_postings(t):
    posting = F.struct(
        F.lit("JobPosting").alias("@type"),
        F.col("lang").alias("title"),
        F.struct(F.lit("employer").alias("name"), F.concat_ws("-", "lang", F.col("n_chars").cast("string")).alias("value")).alias("identifier"),
        F.array(
            F.struct(F.struct(F.lit("Heredia").alias("addressLocality"), F.lit("CR").alias("addressCountry")).alias("address")),
            F.struct(F.struct(F.lit("Heredia").alias("addressLocality"), F.lit("CR").alias("addressCountry")).alias("address")),
        ).alias("jobLocation"),
        F.when(F.col("n_chars") > 1000, "2020-01-01").otherwise("2999-01-01").alias("validThrough"),
        F.regexp_replace("text", "[<>&]", " ").alias("description"),
    )
    graph = F.to_json(F.struct(F.array(posting).alias("@graph")))
    pages = t.documents.select(
        F.col("doc_id").alias("page_id"),
        F.concat(F.lit('<script type="application/ld+json">'), graph, F.lit("</script>")).alias("html"),
    )
    return content.structured_postings(pages).select(
        "page_id", "identifier", F.array_join("locations", "; ").alias("location"), "title", "valid_through"
    )
