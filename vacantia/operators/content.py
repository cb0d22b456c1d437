"""From page to posting text: structured postings, content gate, frames, checkpoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import markup
from vacantia.functions.numbering import numbered
from vacantia.functions.text import (
    dedup_paragraphs,
    is_expired,
    looks_closed,
    normalize,
    tidy,
)

MIN_CONTENT_CHARS = 400
_ADDRESS = ("streetAddress", "addressLocality", "addressRegion", "postalCode", "addressCountry")


def _is(value: Column, kind: str) -> Column:
    return F.startswith(F.schema_of_variant(value), F.lit(kind))


def _text(value: Column) -> Column:
    """Tidied string value; null for other types and empty text."""
    return F.when(_is(value, "STRING"), markup.tidy_or_null(F.try_variant_get(value, "$", "string")))


def _items(value: Column) -> Column:
    """The list itself, or a list of the one value."""
    return F.when(_is(value, "ARRAY"), F.try_variant_get(value, "$", "array<variant>")).when(
        value.isNotNull(), F.array(value)
    )


def _field(value: Column, name: str) -> Column:
    return F.try_variant_get(value, f"$.{name}", "variant")


def _place(item: Column) -> Column:
    has_address = _is(item, "OBJECT") & _field(item, "address").isNotNull()
    address = F.when(has_address, _field(item, "address")).otherwise(item)
    joined = F.concat_ws(
        ", ", *[F.when(_is(address, "OBJECT"), _text(_field(address, name))) for name in _ADDRESS]
    )
    return F.when(_is(item, "STRING"), _text(item)).otherwise(
        F.when(_is(address, "OBJECT"), joined).otherwise(_text(address))
    )


def posting_fields(fields: Column) -> Column:
    """Typed struct of a structured posting object (a variant)."""
    identifier, organisation = _field(fields, "identifier"), _field(fields, "hiringOrganization")
    places = F.transform(_items(_field(fields, "jobLocation")), _place)
    kinds = F.transform(_items(_field(fields, "employmentType")), _text)
    return F.struct(
        _text(_field(fields, "title")).alias("title"),
        # The value of an identifier object is the requisition; its name is the employer's.
        F.when(_is(identifier, "OBJECT"), _text(_field(identifier, "value")))
        .otherwise(_text(identifier))
        .alias("identifier"),
        _text(_field(fields, "datePosted")).alias("date_posted"),
        _text(_field(fields, "validThrough")).alias("valid_through"),
        F.array_distinct(
            F.filter(places, lambda p: p.isNotNull() & (p != ""))
        ).alias("locations"),
        F.array_compact(kinds).alias("employment_type"),
        F.when(_is(organisation, "OBJECT"), _text(_field(organisation, "name")))
        .otherwise(_text(organisation))
        .alias("hiring_org"),
    )


def read_pages(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add main text, page title and the array of structured postings of each page."""
    parsed = pages.withColumn("_c", markup.page_content(html))
    postings = F.transform(
        F.col("_c.postings"),
        lambda p: F.struct(
            posting_fields(F.try_parse_json(p["fields"])).alias("fields"),
            tidy(p["description"]).alias("description_text"),
            p["raw"].alias("raw"),
        ),
    )
    return parsed.select(
        *pages.columns,
        tidy(F.col("_c.main")).alias("main_text"),
        markup.tidy_or_null(F.col("_c.title")).alias("page_title"),
        postings.alias("postings"),
    )


def structured_postings(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per structured posting of a page."""
    return (
        read_pages(pages)
        .select(key, F.posexplode_outer("postings").alias("ord", "_p"))
        .filter("_p is not null")
        .select(key, "ord", "_p.fields.*", "_p.description_text", "_p.raw")
    )


def best_posting(postings: Column) -> Column:
    """Posting with the longest description; the first one on ties; null when none."""
    ranked = F.transform(
        postings,
        lambda p, i: F.struct(F.length(p["description_text"]).alias("n"), (-i).alias("i")),
    )
    return F.when(F.size(postings) > 0, F.element_at(postings, 1 - F.array_max(ranked)["i"]))


def gate(
    posting: Column, main: Column, page_title: Column, corroborating: Column, today: Column, prefix: str = ""
) -> Column:
    """Acquired text or failure of one page: struct with *method* or *failure_category*.

    *prefix* is '', 'rendered_' or 'rendered_frame_'. Nothing set means the page is too
    short to judge.
    """
    description = F.coalesce(posting["description_text"], F.lit(""))
    valid_through = posting["fields"]["valid_through"]
    expired = (
        posting.isNotNull()
        & F.coalesce(is_expired(valid_through, today), F.lit(False))
        & (
            looks_closed(main)
            | looks_closed(corroborating)
            | (F.length(corroborating) < MIN_CONTENT_CHARS)
        )
    )
    structured = posting.isNotNull() & (F.length(description) >= MIN_CONTENT_CHARS)
    plain = F.length(main) >= MIN_CONTENT_CHARS
    text = F.when(structured, dedup_paragraphs(description, main)).when(plain, main)
    closed = looks_closed(text)
    title = F.when(structured, F.coalesce(posting["fields"]["title"], page_title)).otherwise(
        F.coalesce(page_title, posting["fields"]["title"])
    )
    main_name = "main_content" if prefix == "" else f"{prefix}main"
    ok = ~expired & text.isNotNull() & ~closed
    return F.struct(
        F.when(ok, F.when(structured, f"{prefix}jsonld").otherwise(main_name)).alias("method"),
        F.when(expired | (text.isNotNull() & closed), "closed").alias("failure_category"),
        F.when(ok, text).alias("text"),
        F.when(ok, title).alias("title"),
        F.when(ok, posting["fields"]["identifier"]).alias("requisition_id"),
        F.when(ok, posting["raw"]).alias("jsonld"),
    )


def page_contents(pages: DataFrame, today, html: str = "html", prefix: str = "") -> DataFrame:
    """Run the content gate over fetched pages: page columns, method or failure, text."""
    read = read_pages(pages, html).withColumn("posting", best_posting(F.col("postings")))
    gated = read.withColumn(
        "_g",
        gate(
            F.col("posting"),
            F.col("main_text"),
            F.col("page_title"),
            F.col("main_text"),
            F.lit(today).cast("date"),
            prefix,
        ),
    )
    return gated.select(*pages.columns, "main_text", "page_title", "_g.*").withColumn(
        "failure_category",
        F.when(F.col("method").isNull(), F.coalesce("failure_category", F.lit("empty_content"))),
    )


def choose_frames(page: DataFrame, frames: DataFrame, today, key: str = "page_id") -> DataFrame:
    """Result of rendered pages with frames: the page first, else the best frame.

    *page*: key, html; *frames*: key, index, outcome, html. Frames rank by structured
    text, then length, then position, as a partial maximum per page. A chosen frame's
    text is joined to the page's own.
    """
    today = F.lit(today).cast("date")
    candidates = read_pages(frames.filter("outcome = 'candidate'")).withColumn(
        "posting", best_posting(F.col("postings"))
    )
    candidates = candidates.withColumn(
        "g",
        gate(
            F.col("posting"), F.col("main_text"), F.col("page_title"), F.col("main_text"), today,
            "rendered_frame_",
        ),
    )
    candidates = candidates.withColumn(
        "closed", (F.col("g.failure_category") == "closed") | (F.col("g.method").isNull() & looks_closed(F.col("main_text")))
    )
    rank = F.struct(
        (F.col("g.method") == "rendered_frame_jsonld").alias("a"),
        F.length("g.text").alias("b"),
        (-F.col("index")).alias("c"),
    )
    chosen = candidates.groupBy(key).agg(
        F.max_by(
            F.struct("index", "g", "posting", "page_title"), F.when(F.col("g.method").isNotNull(), rank)
        ).alias("frame"),
        F.bool_or("closed").alias("frame_closed"),
    )
    read = (
        read_pages(page)
        .withColumn("posting", best_posting(F.col("postings")))
        .join(chosen, key, "left")
    )
    own = gate(
        F.col("posting"),
        F.col("main_text"),
        F.col("page_title"),
        F.coalesce(F.col("frame.g.text"), F.col("main_text")),
        today,
        "rendered_",
    )
    read = read.withColumn("own", own)
    settled = F.col("own.method").isNotNull() | F.col("own.failure_category").isNotNull()
    joined = dedup_paragraphs(F.col("main_text"), F.col("frame.g.text"))
    has_frame = F.col("frame.g.method").isNotNull()
    frame_ok = ~settled & has_frame & ~looks_closed(joined)
    posting = F.coalesce("frame.posting", "posting")
    return read.select(
        key,
        F.when(settled, F.col("own.method")).when(frame_ok, F.col("frame.g.method")).alias("method"),
        F.when(settled, F.col("own.failure_category"))
        .when(frame_ok, None)
        .when(has_frame | F.coalesce("frame_closed", F.lit(False)), "closed")
        .otherwise("empty_content")
        .alias("failure_category"),
        F.when(settled, F.col("own.text")).when(frame_ok, joined).alias("text"),
        F.when(settled, F.col("own.title"))
        .when(
            frame_ok,
            F.coalesce("frame.posting.fields.title", "posting.fields.title", "page_title", "frame.page_title"),
        )
        .alias("title"),
        F.when(settled, F.col("own.requisition_id"))
        .when(frame_ok, posting["fields"]["identifier"])
        .alias("requisition_id"),
        F.when(frame_ok, F.col("frame.index")).alias("selected_frame"),
    )


def paragraphs_once(docs: DataFrame, *texts: str, out: str = "paragraphs") -> DataFrame:
    """Texts of a row joined with repeated paragraphs dropped, first place kept.

    Normalising first makes a paragraph equal to its own key, so an in-row distinct does
    it; nothing is shuffled.
    """
    df = docs
    for index, name in enumerate(texts):
        df = df.withColumn(f"_t{index}", normalize(name))
    return df.withColumn(
        out, dedup_paragraphs(*[F.col(f"_t{i}") for i in range(len(texts))])
    ).drop(*[f"_t{i}" for i in range(len(texts))])


def append_contents(stored: DataFrame, acquired: DataFrame) -> DataFrame:
    """New content rows of a batch: one per (job, hash) not stored yet, with fresh ids.

    The first row of a repeated (job, hash) in the batch is kept. Ids follow the highest
    stored one in the order of job and hash.
    """
    rest = [c for c in acquired.columns if c not in ("job_id", "content_hash")]
    once = (
        acquired.groupBy("job_id", "content_hash")
        .agg(F.min_by(F.struct(*rest), F.col("retrieved_at")).alias("_r"))
        .select("job_id", "content_hash", *[F.col(f"_r.{c}").alias(c) for c in rest])
    )
    fresh = once.join(stored.select("job_id", "content_hash"), ["job_id", "content_hash"], "left_anti")
    top = stored.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top")).first()["top"]
    return numbered(fresh, ["job_id", "content_hash"], "id", top)


def point_at_content(jobs: DataFrame, contents: DataFrame, acquired: DataFrame) -> DataFrame:
    """Jobs in progress under the acquiring attempt now point at the acquired content."""
    newest = acquired.groupBy("job_id").agg(
        F.max_by(F.struct("content_hash", "attempt_id"), F.col("retrieved_at")).alias("_a")
    ).select("job_id", "_a.*")
    target = newest.join(
        contents.select("job_id", "content_hash", F.col("id").alias("_content")), ["job_id", "content_hash"]
    ).select(F.col("job_id").alias("id"), "attempt_id", "_content")
    owned = (F.col("status") == "in_progress") & (F.col("current_attempt_id") == F.col("attempt_id"))
    return (
        jobs.join(target, "id", "left")
        .withColumn(
            "current_content_id",
            F.when(F.coalesce(owned, F.lit(False)), F.col("_content")).otherwise(F.col("current_content_id")),
        )
        .select(*jobs.columns)
    )
