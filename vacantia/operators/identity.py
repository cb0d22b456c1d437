"""Posting identity: URL keys, duplicate keys, merge groups and merge chains."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import urls
from vacantia.functions.text import comparable_title
from vacantia.session import cut_lineage


def keyed_urls(df: DataFrame, url: str = "url") -> tuple[DataFrame, DataFrame]:
    """URLs with a canonical key, and the malformed ones aside."""
    keyed = urls.with_url_key(df, url)
    return keyed.filter(F.col("url_key").isNotNull()), keyed.filter(F.col("url_key").isNull()).drop(
        "url_key"
    )


def duplicate_keys(keyed: DataFrame, company: str = "company_slug") -> DataFrame:
    """Keys reached by more than one raw URL.

    Raw URLs are made distinct before they are counted, so a key that holds a large
    share of all rows is reduced on the map side and never gathered in one place.
    """
    distinct = keyed.select(company, "url_key", "url").distinct()
    return (
        distinct.groupBy(company, "url_key")
        .agg(
            F.count("*").alias("raw_urls"),
            F.min("url").alias("first_url"),
            F.max("url").alias("last_url"),
        )
        .filter(F.col("raw_urls") > 1)
    )


def latest_contents(contents: DataFrame) -> DataFrame:
    """Newest content of each job by (retrieved_at, id), as plain columns."""
    rest = [c for c in contents.columns if c != "job_id"]
    newest = contents.groupBy("job_id").agg(
        F.max_by(F.struct(*rest), F.struct("retrieved_at", "id")).alias("_c")
    )
    return newest.select("job_id", *[F.col(f"_c.{c}").alias(c) for c in rest])


def latest_titles(contents: DataFrame) -> DataFrame:
    """Comparable title of the content with the highest id; null stays null."""
    # The title sits inside a struct: a bare max_by would skip rows with a null title.
    newest = contents.groupBy("job_id").agg(
        F.max_by(F.struct("title"), F.col("id")).alias("_t")
    )
    return newest.select("job_id", comparable_title(F.col("_t.title")).alias("latest_title"))


def key_partners(live_keys: DataFrame, key: str) -> DataFrame:
    """(company_slug, key, low, high) of the keys held by exactly two live jobs.

    Counting by key replaces the self join: a key shared by very many jobs is one
    counter here, not a block of pairs.
    """
    return (
        live_keys.filter(F.col(key).isNotNull())
        .select("company_slug", key, "job_id")
        .distinct()
        .groupBy("company_slug", key)
        .agg(F.count("*").alias("n"), F.min("job_id").alias("low"), F.max("job_id").alias("high"))
        .filter("n = 2")
        .drop("n")
    )


def _spread_key(key: str) -> Column:
    """The key as text; a null key is the job's own, so that nulls are no hot group."""
    return F.coalesce(F.concat(F.lit("r"), F.col(key)), F.concat(F.lit("j"), F.col("job_id").cast("string")))


def _partner_of(current: DataFrame, pairs: DataFrame, key: str, out: str) -> DataFrame:
    known = pairs.withColumn("_key", F.concat(F.lit("r"), F.col(key))).drop(key)
    joined = current.withColumn("_key", _spread_key(key)).join(known, ["company_slug", "_key"], "left").drop("_key")
    other = F.when(F.col("job_id") == F.col("low"), F.col("high")).when(
        F.col("job_id") == F.col("high"), F.col("low")
    )
    return joined.withColumn(out, other).drop("low", "high")


def duplicate_matches(jobs: DataFrame, contents: DataFrame) -> DataFrame:
    """Matches of one state of the tables: (job_id, canonical_id, matched_by).

    A requisition match needs exactly one other live job of the company with it (in any
    stored content) and equal newest titles; failing that, a fingerprint match needs
    exactly one other live job. The lower id stays; a job in progress is not folded by
    another job's match. Groups of three and more are left alone: see
    :func:`fold_in_order` for the result of working through the jobs one by one.
    """
    # Texts stay out of the shuffles: only keys and titles are compared.
    contents = contents.select("id", "job_id", "requisition_id", "fingerprint", "title", "retrieved_at")
    live = jobs.filter(
        (F.col("status") != "merged") & F.col("merged_into_id").isNull()
    ).select(F.col("id").alias("job_id"), "company_slug", "status")
    stored = contents.select("job_id", "requisition_id", "fingerprint").join(live, "job_id")
    current = (
        latest_contents(contents)
        .select("job_id", "requisition_id", "fingerprint")
        .join(live, "job_id")
    )
    titles = latest_titles(contents)
    matched = _partner_of(current, key_partners(stored, "requisition_id"), "requisition_id", "by_req")
    matched = _partner_of(matched, key_partners(stored, "fingerprint"), "fingerprint", "by_print")
    matched = matched.join(titles, "job_id", "left").join(
        titles.select(F.col("job_id").alias("by_req"), F.col("latest_title").alias("other_title")),
        "by_req",
        "left",
    )
    agreed = F.when(F.col("latest_title") == F.col("other_title"), F.col("by_req"))
    edges = (
        matched.withColumn("match", F.coalesce(agreed, F.col("by_print")))
        .filter(F.col("match").isNotNull())
        .select(
            F.greatest("job_id", "match").alias("folded"),
            F.least("job_id", "match").alias("canonical_id"),
            F.when(agreed.isNotNull(), "requisition").otherwise("fingerprint").alias("matched_by"),
            (F.col("match") < F.col("job_id")).alias("own"),
        )
    )
    busy = live.filter("status = 'in_progress'").select(F.col("job_id").alias("folded"))
    allowed = edges.filter("own").unionByName(edges.filter("not own").join(busy, "folded", "left_anti"))
    return allowed.groupBy(F.col("folded").alias("job_id")).agg(
        F.min("canonical_id").alias("canonical_id"),
        F.min_by("matched_by", F.struct("canonical_id", F.col("matched_by") == "fingerprint")).alias(
            "matched_by"
        ),
    )


def fold_in_order(postings: DataFrame) -> DataFrame:
    """Result of merging the postings of a first run one by one in id order.

    *postings* has one row per job: job_id, company_slug, requisition_id, title_key
    (comparable title), fingerprint. A job joins the only live earlier job that has its
    requisition and title, else the only live earlier job with its fingerprint, else it
    stays live. Whether a job is live depends on earlier jobs alone, and only through
    three numbers per key: the first live job of a fingerprint and the first two live
    jobs of a requisition. Those are plain minimum aggregates, so the order is settled
    by recomputing them until nothing changes (each round settles one more job of every
    chain at least, so it ends); no group is ever worked through by one task. Returns
    job_id, canonical_id (own id when live).
    """
    base = cut_lineage(postings.withColumn("live", F.lit(True)))
    while True:
        live = base.filter("live")
        by_print = live.groupBy("company_slug", "fingerprint").agg(F.min("job_id").alias("print_1"))
        by_req = live.filter("requisition_id is not null")
        first = by_req.groupBy("company_slug", "requisition_id").agg(
            F.min(F.struct("job_id", "title_key")).alias("r1")
        )
        second = (
            by_req.join(first, ["company_slug", "requisition_id"])
            .filter(F.col("job_id") > F.col("r1.job_id"))
            .groupBy("company_slug", "requisition_id")
            .agg(F.min("job_id").alias("req_2"))
        )
        firsts = first.join(second, ["company_slug", "requisition_id"], "left").select(
            "company_slug",
            "requisition_id",
            F.col("r1.job_id").alias("req_1"),
            F.col("r1.title_key").alias("req_title"),
            "req_2",
        )
        firsts = firsts.withColumn("_req", F.concat(F.lit("r"), "requisition_id")).drop("requisition_id")
        seen = (
            base.join(by_print, ["company_slug", "fingerprint"], "left")
            .withColumn("_req", _spread_key("requisition_id"))
            .join(firsts, ["company_slug", "_req"], "left")
        )
        by_requisition = F.when(
            (F.col("req_1") < F.col("job_id"))
            & (F.col("req_2").isNull() | (F.col("req_2") >= F.col("job_id")))
            & (F.col("req_title") == F.col("title_key")),
            F.col("req_1"),
        )
        by_fingerprint = F.when(F.col("print_1") < F.col("job_id"), F.col("print_1"))
        target = F.coalesce(by_requisition, by_fingerprint)
        settled = cut_lineage(
            seen.select(
                *postings.columns,
                F.col("live").alias("was"),
                target.isNull().alias("live"),
                F.coalesce(target, F.col("job_id")).alias("canonical_id"),
            )
        )
        if settled.filter("live <> was").limit(1).count() == 0:
            return settled.select("job_id", "canonical_id")
        base = settled.drop("was", "canonical_id")


def merge_roots(jobs: DataFrame) -> DataFrame:
    """Root of every job's merge chain: (job_id, root_id, problem).

    Pointer jumping: each round doubles the distance covered, so the number of rounds is
    the logarithm of the number of merged jobs. *problem* is ``missing`` when the chain
    leaves the table and ``cycle`` when it never ends; root_id is null then.
    """
    jobs = jobs.select(F.col("id").alias("job_id"), "merged_into_id")
    merged = jobs.filter("merged_into_id is not null")
    total = merged.count()
    if total == 0:
        return jobs.select(
            "job_id", F.col("job_id").alias("root_id"), F.lit(None).cast("string").alias("problem")
        )
    links = merged.select("job_id", F.col("merged_into_id").alias("up"))
    for _ in range(math.ceil(math.log2(total + 1))):
        parents = links.select(F.col("job_id").alias("up"), F.col("up").alias("_next"))
        links = cut_lineage(
            links.join(parents, "up", "left").select(
                "job_id",
                F.coalesce("_next", "up").alias("up"),
                F.col("_next").isNotNull().alias("moved"),
            )
        )
        moving = links.filter("moved").limit(1).count()
        links = links.drop("moved")
        if moving == 0:
            break
    looping = links.join(
        merged.select(F.col("job_id").alias("up"), F.lit(True).alias("loop")), "up", "left"
    )
    known = jobs.select(F.col("job_id").alias("up"), F.lit(True).alias("known"))
    ends = looping.join(known, "up", "left").select(
        "job_id",
        F.when(F.col("known").isNull(), "missing").when(F.col("loop"), "cycle").alias("problem"),
        F.col("up"),
    )
    return jobs.join(ends, "job_id", "left").select(
        "job_id",
        F.when(F.col("problem").isNull(), F.coalesce("up", "job_id")).alias("root_id"),
        "problem",
    )


def moved_sources(sources: DataFrame, roots: DataFrame) -> DataFrame:
    """Sources under their root job; on a clash of URLs the root's own row wins.

    Without an own row of the root, the source of the lowest job id stays (the order in
    which the jobs were folded).
    """
    rest = [c for c in sources.columns if c not in ("job_id", "url")]
    return (
        sources.join(roots.select("job_id", "root_id"), "job_id")
        .groupBy(F.col("root_id").alias("job_id"), "url")
        .agg(
            F.min_by(
                F.struct(*rest), F.struct(F.col("job_id") != F.col("root_id"), "job_id", "id")
            ).alias("_s")
        )
        .select("job_id", "url", *[F.col(f"_s.{c}").alias(c) for c in rest])
    )


def canonical_snapshot_keys(snapshot: DataFrame, jobs: DataFrame, roots: DataFrame) -> DataFrame:
    """Distinct (company_slug, url_key) of the root jobs that a URL snapshot reaches."""
    keyed = urls.with_url_key(snapshot).select("company_slug", "url_key").distinct()
    targets = jobs.select(F.col("id").alias("root_id"), F.col("url_key").alias("root_key"))
    return (
        keyed.join(jobs.select("company_slug", "url_key", F.col("id").alias("job_id")), ["company_slug", "url_key"])
        .join(roots.select("job_id", "root_id"), "job_id")
        .join(targets, "root_id")
        .select("company_slug", F.col("root_key").alias("url_key"))
        .distinct()
    )


def jobs_of_url(jobs: DataFrame, sources: DataFrame, wanted: DataFrame) -> DataFrame:
    """Jobs that a raw URL belongs to; *wanted* holds the URLs."""
    return (
        sources.select("job_id", "url")
        .join(wanted.select("url").distinct(), "url")
        .join(jobs, F.col("job_id") == F.col("id"))
        .drop("job_id")
    )


def on_board_root(fetches: DataFrame, companies: DataFrame) -> DataFrame:
    """Fetches whose final URL is their company's board URL."""
    final = urls.with_url_key(fetches, "final_url", "final_key").filter("final_key is not null")
    board = urls.with_url_key(companies, "job_board_url", "final_key").select(
        F.col("slug").alias("company_slug"), "final_key"
    )
    return final.join(board, ["company_slug", "final_key"], "left_semi")


def observation_summary(raw: DataFrame, jobs: DataFrame, company: str = "company_slug") -> DataFrame:
    """Per company: raw URLs, malformed ones, snapshot jobs, new and reseen keys, collapsed."""
    keyed = urls.with_url_key(raw)
    known = jobs.select(company, "url_key", F.lit(True).alias("known")).distinct()
    per_key = keyed.groupBy(company, "url_key").agg(F.count("*").alias("urls"))
    joined = per_key.join(known, [company, "url_key"], "left")
    has_key: Column = F.col("url_key").isNotNull()
    return (
        joined.groupBy(company)
        .agg(
            F.sum("urls").alias("raw_urls"),
            F.sum(F.when(has_key, 0).otherwise(F.col("urls"))).cast("long").alias("malformed"),
            F.count_if(has_key).alias("snapshot_jobs"),
            F.count_if(has_key & F.col("known").isNull()).alias("new"),
            F.count_if(has_key & F.col("known").isNotNull()).alias("reseen"),
        )
        .withColumn("collapsed", F.col("raw_urls") - F.col("malformed") - F.col("snapshot_jobs"))
    )
