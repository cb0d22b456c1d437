"""Recorded board payloads to posting rows. Payloads come as text and are read as variants,
so a wrongly typed row costs that row and not the board."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import regions
from vacantia.functions.markup import page_anchors
from vacantia.operators.links import (
    absolute_links,
    apply_link_rule,
    first_seen,
    pages_until_stale,
)
from vacantia.operators.platforms import location_options


def _get(value: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(value, f"$.{path}", kind)


def _string(value: Column, path: str) -> Column:
    """The value only when it is a JSON string."""
    piece = F.try_variant_get(value, f"$.{path}", "variant")
    return F.when(F.schema_of_variant(piece) == "STRING", _get(value, path))


def records(payloads: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Items of the list at *path*: keys, ord, item (variant)."""
    tree = F.try_parse_json("payload")
    items = F.try_variant_get(tree, f"$.{path}", "array<variant>")
    return payloads.select(*keys, F.posexplode(items).alias("ord", "item"))


def payload_problems(payloads: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Payloads that are not JSON or hold no list at *path*."""
    tree = F.try_parse_json("payload")
    found = F.try_variant_get(tree, f"$.{path}", "variant")
    return payloads.select(*keys, _problem(tree, found, path).alias("problem")).filter("problem is not null")


def _problem(tree: Column, found: Column, path: str) -> Column:
    return (
        F.when(tree.isNull(), "not JSON")
        .when(found.isNull(), f"missing {path}")
        .when(~F.startswith(F.schema_of_variant(found), F.lit("ARRAY")), f"{path} is not a list")
    )


def board_counts(payloads: DataFrame, path: str, total: str | None = None, page: str | None = None) -> DataFrame:
    """What each board's payloads promised and gave: board, expected, received, problem, status.

    *expected* is the whole number at *total* (``refineSearch.totalHits``, ``totalCount``) of
    the first page that states one, *received* the listed records of all pages. A board with
    a payload that cannot be read is ``failed``, with the problem of its first such page; one
    that promised more than it gave is ``short``; others are ``complete``.
    """
    tree = F.try_parse_json("payload")
    found = F.try_variant_get(tree, f"$.{path}", "variant")
    stated = F.try_variant_get(tree, f"$.{total}", "variant") if total else F.lit(None)
    at = F.col(page) if page else F.lit(0)
    pages = payloads.select(
        "board",
        at.alias("_at"),
        (F.when(F.schema_of_variant(stated) == "BIGINT", F.try_variant_get(stated, "$", "long")) if total else F.lit(None).cast("long")).alias("_stated"),
        F.coalesce(F.size(F.try_variant_get(tree, f"$.{path}", "array<variant>")), F.lit(0)).alias("_listed"),
        _problem(tree, found, path).alias("_problem"),
    )
    counts = pages.groupBy("board").agg(
        F.min_by("_stated", F.when(F.col("_stated").isNotNull(), F.col("_at"))).alias("expected"),
        F.sum(F.greatest("_listed", F.lit(0))).alias("received"),
        F.min_by("_problem", F.when(F.col("_problem").isNotNull(), F.struct("_at", "_problem"))).alias("problem"),
    )
    status = (
        F.when(F.col("problem").isNotNull(), "failed")
        .when(F.col("expected") > F.col("received"), "short")
        .otherwise("complete")
    )
    return counts.withColumn("status", status)


def phenom_counts(payloads: DataFrame) -> DataFrame:
    return board_counts(payloads, "refineSearch.data.jobs", "refineSearch.totalHits")


def coveo_counts(payloads: DataFrame) -> DataFrame:
    return board_counts(payloads, "results", "totalCount", "page")


def greenhouse(payloads: DataFrame) -> DataFrame:
    """board, ord, url, location of every listed posting."""
    return (
        records(payloads, "jobs", ["board"])
        .select(
            "board",
            "ord",
            _get(F.col("item"), "absolute_url").alias("url"),
            F.coalesce(_get(F.col("item"), "location.name"), F.lit("")).alias("location"),
        )
        .filter("url is not null and url <> ''")
    )


def bamboohr(payloads: DataFrame) -> DataFrame:
    """board, ord, url, location; the URL is made from the id; needs column origin."""
    item = F.col("item")

    def joined(prefix: str, names) -> Column:
        return F.concat_ws(
            ", ",
            *[
                F.nullif(F.trim(_get(item, f"{prefix}.{n}")), F.lit(""))
                for n in names
            ],
        )

    location = F.coalesce(
        F.nullif(joined("atsLocation", ("city", "state", "province", "country")), F.lit("")),
        joined("location", ("city", "state")),
    )
    rows = (
        records(payloads, "result", ["board", "origin"])
        .filter(F.startswith(F.schema_of_variant("item"), F.lit("OBJECT")))
        .select(
            "board",
            "ord",
            F.trim(_get(item, "id")).alias("id"),
            "origin",
            location.alias("location"),
        )
        .filter("id is not null and id <> ''")
    )
    return rows.select(
        "board", "ord", "id", F.concat("origin", F.lit("/careers/"), "id").alias("url"), "location"
    )


def title_slug(title: Column) -> Column:
    """Slug of a posting title; letter case is kept."""
    return F.regexp_replace(F.regexp_replace(title, "[^A-Za-z0-9]+", "-"), "^-+|-+$", "")


def phenom(payloads: DataFrame) -> DataFrame:
    """board, ord, url, in_region: rows out of region are flagged, not dropped.

    Needs columns origin and path_prefix. Rows without id or usable title are left out;
    a URL listed twice keeps its first place.
    """
    item = F.col("item")
    places = F.transform(
        F.try_variant_get(item, "$.multi_location_array", "array<variant>"),
        lambda p: F.struct(
            _get(p, "country").alias("country"), _get(p, "city").alias("city"), _get(p, "location").alias("location")
        ),
    )
    rows = (
        records(payloads, "refineSearch.data.jobs", ["board", "origin", "path_prefix"])
        .filter(F.startswith(F.schema_of_variant("item"), F.lit("OBJECT")))
        .select(
            "board",
            "ord",
            F.trim(F.coalesce(_get(item, "jobId"), F.lit(""))).alias("id"),
            title_slug(F.coalesce(_get(item, "title"), F.lit(""))).alias("slug"),
            "origin",
            "path_prefix",
            regions.record_in_region(_get(item, "country"), _get(item, "city"), places).alias("in_region"),
        )
        .filter("id <> '' and slug <> ''")
        .select(
            "board",
            "ord",
            F.concat("origin", "path_prefix", F.lit("/"), "id", F.lit("/"), "slug").alias("url"),
            "in_region",
        )
    )
    return first_seen(rows, ["board", "url"], "ord")


def coveo(payloads: DataFrame) -> DataFrame:
    """board, page, ord, url, in_region over all payload pages, first place of each URL.

    The city may be one text or a list; rows without a link are left out, never rebuilt.
    """
    item = F.col("item")
    city = F.try_variant_get(item, "$.raw.city", "variant")
    cities = F.when(F.schema_of_variant(city) == "STRING", F.array(_get(item, "raw.city"))).when(
        F.startswith(F.schema_of_variant(city), F.lit("ARRAY")),
        F.transform(
            F.filter(
                F.try_variant_get(item, "$.raw.city", "array<variant>"),
                lambda c: F.schema_of_variant(c) == "STRING",
            ),
            lambda c: F.try_variant_get(c, "$", "string"),
        ),
    )
    rows = (
        records(payloads, "results", ["board", "page"])
        .filter(F.startswith(F.schema_of_variant("item"), F.lit("OBJECT")))
        .select(
            "board",
            "page",
            "ord",
            _string(item, "clickUri").alias("url"),
            regions.country_or_city_in_region(
                F.coalesce(_string(item, "raw.country"), F.lit("")), F.filter(cities, lambda c: c != "")
            ).alias("in_region"),
        )
        .filter("url is not null and url <> ''")
    )
    matching_first = F.struct(~F.col("in_region"), F.col("page"), F.col("ord"))
    return first_seen(rows, ["board", "url"], matching_first)


def select_region(rows: DataFrame) -> DataFrame:
    """Rows whose location text names the region."""
    return rows.filter(regions.in_region("location"))


def select_region_rules(rows: DataFrame, rules: dict[str, tuple[list[str], list[str]]]) -> DataFrame:
    """Rows per region for several regions: *rules* maps region to its names and codes.

    The rules are configuration, so they are part of the plan: each location is tested in
    its own row and nothing is joined.
    """
    hits = F.array_compact(
        F.array(
            *[
                F.when(regions.in_region("location", names, codes), F.lit(region))
                for region, (names, codes) in rules.items()
            ]
        )
    )
    return rows.withColumn("region", F.explode(hits))


def bamboohr_in_region(payloads: DataFrame) -> DataFrame:
    """In-region rows, the first of each id."""
    return first_seen(select_region(bamboohr(payloads)), ["board", "id"], "ord")


def coveo_in_region(payloads: DataFrame) -> DataFrame:
    return coveo(payloads).filter("in_region")


def _talentbrew_read(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Matching links of the pages up to each board's end, and what is wrong with those pages."""
    tree = F.try_parse_json("payload")
    flag = F.try_variant_get(tree, "$.hasJobs", "variant")
    pages = payloads.withColumn("html", _string(tree, "results")).withColumn(
        "has_jobs", F.when(F.schema_of_variant(flag) == "BOOLEAN", _get(tree, "hasJobs", "boolean"))
    )
    keyed = pages.withColumn("_key", F.struct("board", "page"))
    rules = pages.select("board", "page", "origin", "base_path", "min_depth")
    anchors = page_anchors(keyed, "_key").select(
        F.col("_key.board").alias("board"), F.col("_key.page").alias("page"), "url", "ord", "href"
    )
    matched = apply_link_rule(
        absolute_links(anchors).join(rules, ["board", "page"]), ["board", "page"]
    )
    counts = matched.groupBy("board", "page").agg(F.count("*").alias("_n"))
    hrefs = anchors.groupBy("board", "page").agg(F.count("*").alias("_a"))
    state = (
        pages.select("board", "page", "html", "has_jobs", "records_per_page")
        .join(counts, ["board", "page"], "left")
        .join(hrefs, ["board", "page"], "left")
        .fillna(0, ["_n", "_a"])
    )
    ends = state.groupBy("board").agg(
        F.min(F.when(~F.col("has_jobs"), F.col("page"))).alias("_before"),
        F.min(F.when(F.col("_n") < F.col("records_per_page"), F.col("page"))).alias("_after"),
    )
    first = (F.col("page") == 1) & F.col("has_jobs")
    problem = (
        F.when(F.col("html").isNull(), "results_type")
        .when(F.col("has_jobs").isNull(), "has_jobs_type")
        .when(first & (F.col("_a") == 0), "no_anchors")
        .when(first & (F.col("_n") == 0), "no_links")
    )

    def until_the_end(rows: DataFrame, at_end: bool) -> DataFrame:
        before = F.col("page") <= F.col("_before") if at_end else F.col("page") < F.col("_before")
        joined = rows.join(ends, "board", "left").filter(F.col("_before").isNull() | before)
        return joined.filter(F.col("_after").isNull() | (F.col("page") <= F.col("_after")))

    wrong = until_the_end(state.withColumn("problem", problem), True).filter("problem is not null")
    return until_the_end(matched, False), wrong.select("board", "page", "problem")


def talentbrew_problems(payloads: DataFrame) -> DataFrame:
    """board, page, problem of the read pages that fail their board.

    ``results_type`` and ``has_jobs_type``: the envelope's field has another type or is
    absent; ``no_anchors`` and ``no_links``: page 1 claims jobs and shows none.
    """
    return _talentbrew_read(payloads)[1]


def talentbrew(payloads: DataFrame) -> DataFrame:
    """board, page, ord, url of recorded result pages up to the first stopping page.

    Needs board, page, url (request URL), origin, base_path, min_depth, records_per_page,
    payload. A page without jobs ends the board before it, a page with fewer matching
    links than a full page ends it after it. A board with a page of
    :func:`talentbrew_problems` gives no rows: what is stored of it stays as it is.
    """
    kept, wrong = _talentbrew_read(payloads)
    sound = kept.join(wrong.select("board").distinct(), "board", "left_anti")
    rows = sound.select("board", "page", "ord", F.col("link").alias("url"))
    return first_seen(rows, ["board", "url"], F.struct("page", "ord"))


def peopleforce_locations(pages: DataFrame) -> DataFrame:
    """In-region location options of a board page: board, ord, option_id, label."""
    options = location_options(pages, "board").filter(regions.in_region("label"))
    return first_seen(options, ["board", "option_id"], "ord")


def peopleforce(pages: DataFrame) -> DataFrame:
    """board, page, ord, url of stored list pages up to the first that adds nothing.

    Needs board, page, url, html, origin, base_path, min_depth.
    """
    keyed = pages.withColumn("_key", F.struct("board", "page"))
    anchors = page_anchors(keyed, "_key").select(
        F.col("_key.board").alias("board"), F.col("_key.page").alias("page"), "url", "ord", "href"
    )
    rules = pages.select("board", "page", "origin", "base_path", "min_depth")
    matched = apply_link_rule(
        absolute_links(anchors).join(rules, ["board", "page"]), ["board", "page"]
    ).withColumnRenamed("link", "url")
    # A page without any matching link is stale too, so empty pages take part in the stop.
    empty = pages.select("board", "page").join(matched, ["board", "page"], "left_anti")
    stops = empty.groupBy("board").agg(F.min("page").alias("_empty"))
    read = pages_until_stale(matched, "board", "page", "url")
    kept = read.join(stops, "board", "left").filter(
        F.col("_empty").isNull() | (F.col("page") < F.col("_empty"))
    )
    return first_seen(kept.drop("_empty"), ["board", "url"], F.struct("page", "ord"))
