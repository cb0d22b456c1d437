"""Queries over stored board pages: platforms, controls, pagination, frames, cases, streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacantia.operators import content, platforms, scoring
from vacantia.session import scratch_folder
from vacantia.sources import payloads
from vacantia.streaming.liveness import AttemptRuns, attempt_outcomes, fold_attempts
from vacantia.streaming.observe import VersionedState, fold_batches
from vacantia.workloads.base import query
from vacantia.workloads.document_jobs import SQL_WORDS
from vacantia.workloads.url_jobs import SQL_ANCHORS, SQL_KEYED


def supplier_pages(t):
    """A board page per supplier: some on a known host, some with a known frame."""
    url = F.when(F.col("s_nationkey") < 5, "https://jobs.lever.co/x").otherwise("https://careers.example.com/x")
    html = F.when(
        F.col("s_acctbal") > 5000, '<body><iframe src="https://a.icims.com/f"></iframe><div class="z phw-a"></div></body>'
    ).otherwise("<body><p>plain</p></body>")
    return t.supplier.select(F.col("s_suppkey").alias("page_id"), url.alias("url"), html.alias("html"))


def supplier_network(t):
    return t.supplier.select(
        F.col("s_suppkey").alias("page_id"),
        F.explode(
            F.array(
                F.lit("https://API.lever.co/v0/postings"),
                F.concat(F.lit("https://x.example/api/JOBS?n="), F.col("s_nationkey").cast("string")),
                F.lit("https://jobs.example/track"),
            )
        ).alias("network_url"),
    )


@query(
    "platform_hits",
    """SELECT s_suppkey AS page_id, 'Lever' AS platform, CASE WHEN s_nationkey < 5 THEN 'host,network' ELSE 'network' END AS signals FROM supplier
    UNION ALL SELECT s_suppkey, 'iCIMS', 'dom' FROM supplier WHERE s_acctbal > 5000
    UNION ALL SELECT s_suppkey, 'Phenom', 'dom' FROM supplier WHERE s_acctbal > 5000""",
)
def platform_hits(t):
    return platforms.platform_hits(supplier_pages(t), supplier_network(t)).select(
        "page_id", "platform", F.array_join("signals", ",").alias("signals")
    )


@query(
    "unclassified_job_apis",
    "SELECT s_suppkey AS page_id, 'https://x.example/api/JOBS?n=' || s_nationkey AS network_url FROM supplier",
)
def unclassified_job_apis(t):
    hits = platforms.platform_hits(supplier_pages(t), supplier_network(t))
    return platforms.unclassified_job_apis(supplier_network(t), hits)


@query(
    "next_controls",
    """SELECT p_partkey AS page_id, CASE p_size % 5 WHEN 0 THEN 'rel-next' WHEN 1 THEN 'aria-label' WHEN 2 THEN 'numeric-successor' WHEN 3 THEN 'load-more' END AS signal
    FROM part WHERE p_size % 5 <> 4""",
)
def next_controls(t):
    kinds = (
        '<a href="/n" rel="nofollow next">x</a><a>Next</a>',
        '<button aria-label="View next page">&gt;</button><a>Next office</a>',
        '<div><span>1</span><a>3</a><a>2</a></div><a class="next">&gt;</a>',
        '<button>Load More Jobs</button><a hidden>Next</a>',
        '<a disabled>Next</a><a aria-disabled="true">Next page</a><a>Nextcloud</a>',
    )
    html = F.element_at(F.array(*[F.lit(k) for k in kinds]), F.col("p_size") % 5 + 1)
    pages = t.part.select(F.col("p_partkey").alias("page_id"), html.alias("html"))
    return platforms.next_controls(pages).select("page_id", "signal")


@query(
    "filter_controls",
    """SELECT kind, name, label, samples, count(*) AS pages FROM nation, (VALUES ('select', 'country', NULL, 'All|CR|x'),
      ('combobox', NULL, 'Pick', ''), ('checkbox_group', NULL, 'Office\n A B', 'A|B'), ('search_box', 'q', 'Find', '')) v(kind, name, label, samples) GROUP BY ALL""",
)
def filter_controls(t):
    html = (
        '<select name="country"><option>All</option><optgroup><option>CR</option></optgroup><option> x </option></select>'
        '<select name="sort"><option>new</option></select><div role="combobox" aria-label="Pick">p</div>'
        '<fieldset>Office\n <label><input type="checkbox">A</label> <label for="b">B</label><input id="b" type="checkbox"></fieldset>'
        '<input type="search" name="q" placeholder="Find"><input type="text" name="city">'
    )
    pages = t.nation.select(F.col("n_nationkey").alias("page_id"), F.lit(html).alias("html"))
    found = platforms.filter_controls(pages)
    return found.groupBy("kind", "name", "label", F.array_join("sample_options", "|").alias("samples")).agg(
        F.count("*").alias("pages")
    )


@query(
    "location_options",
    """SELECT 'r' || n_regionkey AS board, n_nationkey::VARCHAR AS option_id, 'Costa Rica/' || n_name AS label FROM nation WHERE n_nationkey < 20""",
)
def location_options(t):
    option = F.concat(
        F.lit('<li data-cy="_location_id_select_'), "n_nationkey", F.lit('_option" data-value="'), "n_nationkey",
        F.lit('" data-text="'), F.when(F.col("n_nationkey") < 20, "Costa Rica/").otherwise("Peru/"), "n_name",
        F.lit('">x</li><li data-cy="_employment_type_select_1_option" data-value="9" data-text="LATAM">y</li>'),
    )
    pages = t.nation.select(
        F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("board"), option.alias("html")
    )
    return payloads.peopleforce_locations(pages).select("board", "option_id", "label")


def page_series(t, second):
    """Each stored page as a board of two list pages; *second* gives the second page's HTML."""
    number = F.explode(F.array(F.lit(1), F.lit(2))).alias("page")
    base = t.pages.select(
        F.concat(F.lit("b"), F.col("page_id").cast("string")).alias("board"), "page_id", number, F.col("html").alias("_h")
    )
    return base.select(
        "board",
        "page",
        "page_id",
        F.lit("https://b.example/list").alias("url"),
        F.lit("https://b.example").alias("origin"),
        F.lit("").alias("base_path"),
        F.lit(1).alias("min_depth"),
        F.lit(3).alias("records_per_page"),
        F.when(F.col("page") == 1, F.col("_h")).otherwise(second).alias("html"),
    )


@query(
    "talentbrew_postings",
    f"""WITH {SQL_ANCHORS} SELECT 'b' || page_id AS board, count(DISTINCT href) + CASE WHEN page_id % 2 = 0 AND count(DISTINCT href) >= 3 THEN 1 ELSE 0 END AS urls
    FROM anchors WHERE href NOT IN ('/') GROUP BY page_id""",
)
def talentbrew_postings(t):
    rows = page_series(t, F.lit('<a href="/second page">2</a>'))
    has = (F.col("page") == 1) | (F.col("page_id") % 2 == 0)
    envelopes = rows.withColumn("payload", F.to_json(F.struct(F.col("html").alias("results"), has.alias("hasJobs")))).drop("html")
    return payloads.talentbrew(envelopes).groupBy("board").agg(F.count("*").alias("urls"))


@query(
    "peopleforce_postings",
    f"""WITH {SQL_ANCHORS} SELECT 'b' || page_id AS board, count(DISTINCT href) AS urls, 1 AS last_page FROM anchors GROUP BY page_id""",
)
def peopleforce_postings(t):
    # The second page repeats the first, as boards do that ignore the page number.
    rows = page_series(t, F.col("_h"))
    return payloads.peopleforce(rows).groupBy("board").agg(
        F.count("*").alias("urls"), F.max("page").alias("last_page")
    )


SQL_FLAT = "trim(regexp_replace(regexp_replace(text, '[<>&]', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(
    "chosen_frames",
    f"""SELECT doc_id AS page_id, CASE WHEN length({SQL_FLAT}) >= 400 THEN 'rendered_frame_main' END AS method,
      CASE WHEN length({SQL_FLAT}) < 400 THEN 'empty_content' END AS failure_category,
      CASE WHEN length({SQL_FLAT}) >= 400 THEN 1 END AS selected_frame FROM documents""",
)
def chosen_frames(t):
    body = F.concat(F.lit("<p>"), F.regexp_replace("text", "[<>&]", " "), F.lit("</p>"))
    pages = t.documents.select(F.col("doc_id").alias("page_id"), F.lit("<p>short</p>").alias("html"))
    half = F.concat(F.lit("<p>"), F.substring(F.regexp_replace("text", "[<>&]", " "), F.lit(1), F.floor(F.length("text") / 2).cast("int")), F.lit("</p>"))
    frames = t.documents.select(
        F.col("doc_id").alias("page_id"),
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("index"), F.lit("candidate").alias("outcome"), half.alias("html")),
                F.struct(F.lit(1).alias("index"), F.lit("candidate").alias("outcome"), body.alias("html")),
                F.struct(F.lit(2).alias("index"), F.lit("hidden").alias("outcome"), F.lit("").alias("html")),
            )
        ).alias("f"),
    ).select("page_id", "f.*")
    return content.choose_frames(pages, frames, "2024-06-01").select(
        "page_id", "method", "failure_category", "selected_frame"
    )


@query(
    "case_violations",
    f"""SELECT doc_id::VARCHAR AS case_id, 'decision: content hash' AS rule FROM documents WHERE lang = 'de'
    UNION ALL SELECT doc_id::VARCHAR, 'blind case lacks obligations' FROM documents WHERE n_chars > 1000
    UNION ALL SELECT doc_id::VARCHAR, 'quote is not grounded' FROM documents WHERE lang = 'fr' OR {SQL_WORDS.format('split_part(text, chr(10), 1)')} = ''
    UNION ALL SELECT doc_id::VARCHAR, 'decision: must_cite' FROM documents WHERE lang <> 'fr' AND NOT regexp_matches(split_part(text, chr(10), 1), '\\S')""",
)
def case_violations(t):
    from vacantia.schemas import EXPECTED_DECISION, EXPECTED_EVIDENCE

    case = F.col("doc_id").cast("string")
    wrong = F.when(F.col("lang") == "de", "x").otherwise(F.col("text"))
    decision = F.struct(
        F.lit(1).alias("schema_version"),
        case.alias("case_id"),
        F.lit(True).alias("reviewed"),
        F.lit("eligible").alias("decision"),
        F.array(F.when(F.col("lang") == "fr", "nowhere to be found here").otherwise(F.substring_index("text", "\n", 1))).alias("must_cite"),
        F.lit("r").alias("rationale"),
        F.when(F.col("n_chars") > 1000, "blind").otherwise("development").alias("partition"),
        F.sha2(wrong, 256).alias("source_content_sha256"),
        F.lit(None).cast(EXPECTED_DECISION["provenance"].dataType).alias("provenance"),
    )
    cases = t.documents.select(
        case.alias("case_id"),
        F.col("text").alias("content"),
        decision.alias("decision"),
        F.lit(None).cast(EXPECTED_EVIDENCE).alias("evidence"),
    )
    return scoring.case_violations(cases).select("case_id", "rule")


@query(
    "streamed_liveness",
    """WITH a AS (SELECT *, floor(value) AS took, event_type <> 'view' AS done FROM events),
    w AS (SELECT greatest(max(ts), max(ts + to_seconds(took::INT)) FILTER (done)) AS mark FROM a)
    SELECT event_id AS attempt_id, user_id AS job_id, outcome FROM (
      SELECT event_id, user_id, 'finished' AS outcome FROM a WHERE done AND took <= 60
      UNION ALL SELECT event_id, user_id, 'interrupted' FROM a, w WHERE (NOT done OR took > 60) AND ts + INTERVAL 60 SECOND < mark
      UNION ALL SELECT event_id, user_id, 'late_finish' FROM a WHERE done AND took > 60)""",
)
def streamed_liveness(t):
    spark = t.spark
    stored = t.events
    folder = scratch_folder(spark)
    # Several files, in no order of time: each is a micro-batch.
    stored.repartition(5, "user_id").write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    moments = F.array(
        F.struct(F.lit("started").alias("kind"), F.col("ts").alias("at")),
        F.struct(
            F.lit("finished").alias("kind"),
            F.when(
                F.col("event_type") != "view",
                F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + F.floor("value") * 1000000).cast(stored.schema["ts"].dataType),
            ).alias("at"),
        ),
    )
    events = stream.select(
        F.col("event_id").alias("attempt_id"), F.col("user_id").alias("job_id"), F.explode(moments).alias("m")
    ).select("attempt_id", "job_id", "m.*").filter("at is not null")
    running = fold_attempts(events, f"{folder}/state", f"{folder}/ckpt", trigger={"availableNow": True})
    running.awaitTermination()
    attempts = AttemptRuns(spark, f"{folder}/state").read()
    return attempt_outcomes(attempts, stale_seconds=60).select("attempt_id", "job_id", "outcome")


@query(
    "streamed_observe",
    f"""WITH {SQL_KEYED} SELECT host AS company_slug, url_key, count(DISTINCT url) AS sources, make_timestamp((min(page_id) + 1700000000) * 1000000) AS first_seen_at,
      make_timestamp((max(page_id) + 1700000000) * 1000000) AS last_seen_at FROM keyed GROUP BY 1, 2""",
)
def streamed_observe(t):
    from vacantia.functions import urls

    spark = t.spark
    folder = scratch_folder(spark)
    stored = t.pages.select("page_id", "url")
    stored.repartition(4, "url").write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(stored.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    seen = stream.select(
        urls.authority_host(urls.url_parts("url")["authority"]).alias("company_slug"),
        "url",
        F.timestamp_seconds(F.col("page_id") + 1700000000).alias("seen_at"),
    )
    running = fold_batches(seen, f"{folder}/state", f"{folder}/ckpt", trigger={"availableNow": True})
    running.awaitTermination()
    jobs, sources = VersionedState(spark, f"{folder}/state").read()
    counted = sources.groupBy(F.col("job_id").alias("id")).agg(F.count("*").alias("sources"))
    return jobs.join(counted, "id").select("company_slug", "url_key", "sources", "first_seen_at", "last_seen_at")
