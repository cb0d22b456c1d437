"""Link selection over page tables: link rule, first-seen order, pagination, census."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacantia.functions import urls
from vacantia.functions.markup import in_trail
from vacantia.functions.text import computed


def first_seen(df: DataFrame, keys: list[str], order: Column | str) -> DataFrame:
    """First row of each key by *order*; map-side partial minimum, no window sort."""
    rest = [c for c in df.columns if c not in keys]
    order = F.col(order) if isinstance(order, str) else order
    return (
        df.groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), order).alias("_r"))
        .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])
        .select(*df.columns)
    )


def absolute_links(anchors: DataFrame, url: str = "url") -> DataFrame:
    return computed(anchors, "abs_url", urls.resolve_url(F.col(url), F.col("href")))


def visible_links(anchors: DataFrame, suppress_selector: str | None = None) -> DataFrame:
    """Drop hidden anchors and anchors at or below an element that matches the selector."""
    shown = anchors.filter(~F.col("hidden"))
    if suppress_selector is None:
        return shown
    return shown.filter(~in_trail(F.col("trail"), suppress_selector))


def bucketed_links(links: DataFrame, browser_form: bool = False) -> DataFrame:
    """Classify absolute links: columns *bucket* (path, query or null), *depth*, *link*.

    Needs columns abs_url, origin, base_path, min_depth. *browser_form* compares origins
    as browsers do: lower-case host, default port dropped.
    """
    df = computed(links, "_u", urls.url_parts("abs_url"))
    parts = F.col("_u")
    authority = parts["authority"]
    if browser_form:
        authority = F.lower(authority)
        authority = F.when(parts["scheme"] == "https", F.regexp_replace(authority, ":443$", "")).when(
            parts["scheme"] == "http", F.regexp_replace(authority, ":80$", "")
        ).otherwise(authority)
    same = (
        (parts["scheme"] != "")
        & (authority != "")
        & (F.concat(parts["scheme"], F.lit("://"), authority) == F.col("origin"))
    )
    path = F.regexp_replace(parts["path"], "/$", "")
    below = F.startswith(path, F.concat(F.col("base_path"), F.lit("/")))
    depth = F.size(
        F.split(F.substring(path, F.length("base_path") + 2, F.length(path)), "/")
    )
    link = F.concat(
        parts["scheme"],
        F.lit("://"),
        authority,
        F.when((parts["path"] == "") & F.lit(browser_form), F.lit("/")).otherwise(parts["path"]),
        F.when(parts["query"] == "", F.lit("")).otherwise(F.concat(F.lit("?"), parts["query"])),
    )
    return df.select(
        *links.columns,
        F.when(same & below, "path")
        .when(same & (path == F.col("base_path")) & (parts["query"] != ""), "query")
        .alias("bucket"),
        F.when(same & below, depth).alias("depth"),
        link.alias("link"),
        (parts["fragment"] != "").alias("has_fragment"),
    )


def apply_link_rule(
    links: DataFrame, page_keys: list[str], order: str = "ord", browser_form: bool = False
) -> DataFrame:
    """Posting links of each page in first-seen order: page keys, order, link.

    A page keeps its query bucket only when its path bucket is empty after the depth
    floor. Duplicates go first, by a partial minimum per (page, bucket, link); the page
    level flag is another small aggregate joined back.
    """
    kept = bucketed_links(links, browser_form).filter(
        (F.col("bucket") == "query") | ((F.col("bucket") == "path") & (F.col("depth") >= F.col("min_depth")))
    )
    distinct = kept.groupBy(*page_keys, "bucket", "link").agg(F.min(order).alias(order))
    with_path = (
        distinct.filter("bucket = 'path'").select(*page_keys).distinct().withColumn("_path", F.lit(True))
    )
    return (
        distinct.join(with_path, page_keys, "left")
        .filter((F.col("bucket") == "path") | F.col("_path").isNull())
        .select(*page_keys, order, "link")
    )


def pages_until_stale(
    links: DataFrame, board: str, page: str, url: str
) -> DataFrame:
    """Rows of the pages read before the first one that adds no new URL.

    A page is fresh when some URL appears on it first. Pages count from the lowest
    number; only the first page without fresh URLs ends the board, however many it has.
    """
    first = links.groupBy(board, url).agg(F.min(page).alias("_first"))
    fresh = first.select(board, F.col("_first").alias(page)).distinct()
    seen = links.select(board, page).distinct()
    stale = (
        seen.join(fresh, [board, page], "left_anti").groupBy(board).agg(F.min(page).alias("_stop"))
    )
    return (
        links.join(stale, board, "left")
        .filter(F.col("_stop").isNull() | (F.col(page) < F.col("_stop")))
        .drop("_stop")
    )


def url_union(*frames: DataFrame) -> DataFrame:
    """Distinct union of URL sets over page states, frames and pages."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result.distinct()


def url_set_difference(old: DataFrame, new: DataFrame, board: str, url: str = "url") -> DataFrame:
    """Per board with differing sets: counts only in one side and three samples of each.

    Fragments are stripped from the old side first. One aggregate per URL tells the sides it
    is on; the three lowest URLs of a side are ranks that Spark cuts before its shuffle, so
    a board's URLs are neither listed nor sorted whole.
    """
    strip = F.regexp_replace(F.col(url), "#.*$", "")
    sides = old.select(board, strip.alias(url), F.lit(True).alias("_old")).unionByName(
        new.select(board, url, F.lit(False).alias("_old"))
    )
    either = (
        sides.groupBy(board, url)
        .agg(F.bool_and("_old").alias("_old"), F.bool_or("_old").alias("_any"))
        .filter(F.col("_old") == F.col("_any"))
    )
    counts = either.groupBy(board).agg(
        F.count_if(~F.col("_old")).alias("new_only"), F.count_if("_old").alias("old_only")
    )
    rank = F.row_number().over(Window.partitionBy(board, "_old").orderBy(url))
    lowest = either.select(board, "_old", url, rank.alias("_n")).filter("_n <= 3")

    def samples(is_old: bool) -> Column:
        held = [F.max(F.when((F.col("_old") == is_old) & (F.col("_n") == n), F.col(url))) for n in (1, 2, 3)]
        return F.when(held[0].isNotNull(), F.concat_ws(" ", *held)).alias("old_samples" if is_old else "new_samples")

    return counts.join(lowest.groupBy(board).agg(samples(False), samples(True)), board, "left")


def link_census(links: DataFrame, page_keys: list[str]) -> DataFrame:
    """Per page: eligible, visible, hidden and fragment links, repeats, depth counts.

    Needs abs_url, origin, base_path, min_depth and hidden. Depth counts are a map of
    visible path links by depth, built from a (page, depth) count.
    """
    eligible = bucketed_links(links, browser_form=True).filter("bucket is not null")
    visible = ~F.col("hidden")
    counted = eligible.groupBy(*page_keys, "link").agg(
        F.count("*").alias("n"),
        F.count_if(visible & ((F.col("bucket") == "query") | (F.col("depth") >= F.col("min_depth")))).alias("v"),
        F.count_if(F.col("hidden")).alias("h"),
        F.count_if("has_fragment").alias("f"),
    )
    totals = counted.groupBy(*page_keys).agg(
        F.sum("n").alias("eligible_links"),
        F.sum("v").alias("visible_links"),
        F.sum("h").alias("hidden_links"),
        F.sum("f").alias("fragment_links"),
        F.sum(F.col("n") - 1).alias("repeated_links"),
    )
    depths = (
        eligible.filter(visible & (F.col("bucket") == "path"))
        .groupBy(*page_keys, "depth")
        .count()
        .groupBy(*page_keys)
        .agg(
            F.map_from_entries(F.sort_array(F.collect_list(F.struct("depth", "count")))).alias(
                "depth_counts"
            )
        )
    )
    return totals.join(depths, page_keys, "left")


def suggested_min_depth(sample_depth: Column, depth_counts: Column) -> Column:
    """Deepest depth above the sample's own, plus one; null when there is none."""
    shallow = F.filter(F.map_keys(depth_counts), lambda d: (d > 0) & (d < sample_depth))
    return F.when(sample_depth > 0, F.array_max(shallow) + 1)


def expected_count_mismatches(found: DataFrame, boards: DataFrame) -> DataFrame:
    """Boards whose distinct URL count differs from the recorded one."""
    counts = found.groupBy("slug").agg(F.count_distinct("url").alias("found"))
    return (
        boards.select("slug", "expected_unfiltered_count")
        .join(counts, "slug", "left")
        .withColumn("found", F.coalesce("found", F.lit(0)))
        .filter(F.col("found") != F.col("expected_unfiltered_count"))
    )
