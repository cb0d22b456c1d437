"""Queries over page URLs and page links."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacantia.functions import regions, urls
from vacantia.functions.markup import page_anchors, page_anchors_by_pattern
from vacantia.functions.text import acronym, slug
from vacantia.operators import identity, links
from vacantia.workloads.base import query

# Check SQL of the canonical key, for URLs that need no percent-decoding.
_PARAMS = ", ".join(f"'{name}'" for name in urls.NON_IDENTIFYING_PARAMS)
SQL_PARTS = r"""
parts AS (
  SELECT page_id, url,
    regexp_extract(url, '^([a-z]+)://', 1) AS scheme,
    lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host,
    regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(url, '\?([^#]*)', 1) AS q
  FROM pages
)"""
SQL_KEYED = (
    SQL_PARTS
    + f""",
cleaned AS (
  SELECT *, array_to_string(list_sort([x for x in string_split(q, '&')
      if x <> '' and not (split_part(x, '=', 1) in ({_PARAMS})) and not starts_with(x, 'utm_')]), '&') AS kept
  FROM parts
),
keyed AS (
  SELECT page_id, url, host, path, q,
    scheme || '://' || host
      || CASE WHEN path <> '/' AND path LIKE '%/' THEN left(path, length(path) - 1) ELSE path END
      || CASE WHEN kept = '' THEN '' ELSE '?' || kept END AS url_key
  FROM cleaned
)"""
)


def keyed_pages(t):
    """Pages as raw URLs of a company: the host stands in for the company."""
    return urls.with_url_key(t.pages.select("page_id", "url")).withColumn(
        "company_slug", urls.authority_host(urls.url_parts("url")["authority"])
    )


@query("url_keys", f"WITH {SQL_KEYED} SELECT page_id, url_key FROM keyed")
def url_keys(t):
    return keyed_pages(t).select("page_id", "url_key")


@query(
    "url_key_collapse",
    f"""WITH {SQL_KEYED}
    SELECT host AS company_slug, url_key, count(DISTINCT url) AS raw_urls,
           min(url) AS first_url, max(url) AS last_url
    FROM keyed GROUP BY 1, 2 HAVING count(DISTINCT url) > 1""",
)
def url_key_collapse(t):
    return identity.duplicate_keys(keyed_pages(t))


@query(
    "observation_counts",
    f"""WITH {SQL_KEYED}, known AS (SELECT DISTINCT host, url_key FROM keyed WHERE page_id < 100),
    per_key AS (SELECT host, url_key, count(*) AS urls FROM keyed GROUP BY 1, 2)
    SELECT p.host AS company_slug, sum(urls)::BIGINT AS raw_urls, 0::BIGINT AS malformed,
      count(*) AS snapshot_jobs, count(*) FILTER (k.url_key IS NULL) AS new,
      count(*) FILTER (k.url_key IS NOT NULL) AS reseen, (sum(urls) - count(*))::BIGINT AS collapsed
    FROM per_key p LEFT JOIN known k ON p.host = k.host AND p.url_key = k.url_key GROUP BY 1""",
)
def observation_counts(t):
    pages = keyed_pages(t)
    known = pages.filter("page_id < 100")
    return identity.observation_summary(pages.select("company_slug", "url"), known)


@query(
    "malformed_urls",
    """SELECT count(*) AS malformed FROM (
      SELECT url AS raw FROM pages UNION ALL
      SELECT unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) FROM pages)
    WHERE NOT regexp_matches(raw, '^https?://[^/?#]')""",
)
def malformed_urls(t):
    raw = t.pages.select("url").unionByName(
        page_anchors_by_pattern(t.pages).select(F.col("href").alias("url"))
    )
    return identity.keyed_urls(raw)[1].agg(F.count("*").alias("malformed"))


@query(
    "path_prefixes",
    f"""WITH {SQL_PARTS}, trimmed AS (SELECT *, regexp_replace(path, '/+$', '') AS p FROM parts)
    SELECT page_id, CASE WHEN regexp_extract(p, '^(.*)/[^/]*$', 1) = '' THEN '/'
      ELSE regexp_extract(p, '^(.*)/[^/]*$', 1) END AS prefix,
      len([s for s in string_split(p, '/') if s <> ''])::BIGINT AS depth_below_root
    FROM trimmed""",
)
def path_prefixes(t):
    return t.pages.select(
        "page_id",
        urls.path_prefix("url").alias("prefix"),
        urls.tail_depth("url", F.lit("/")).cast("long").alias("depth_below_root"),
    )


@query(
    "prefix_ancestors",
    f"""WITH {SQL_PARTS}, trimmed AS (SELECT *, regexp_replace(path, '/+$', '') AS p FROM parts),
    pre AS (SELECT page_id, regexp_extract(p, '^(.*)/[^/]*$', 1) AS f FROM trimmed)
    SELECT page_id, f AS ancestor FROM pre WHERE f <> '' UNION
    SELECT page_id, '/' FROM pre UNION
    SELECT page_id, regexp_extract(f, '^(.*)/[^/]*$', 1) FROM pre
      WHERE regexp_extract(f, '^(.*)/[^/]*$', 1) <> ''""",
)
def prefix_ancestors(t):
    return t.pages.select("page_id", F.explode(urls.prefix_ancestry("url")).alias("ancestor"))


@query(
    "registrable_domains",
    f"""WITH {SQL_PARTS}, l AS (SELECT page_id, host, string_split(host, '.') AS a FROM parts)
    SELECT array_to_string(CASE WHEN len(a) >= 3 AND length(a[-1]) = 2
        AND a[-2] IN ('ac','co','com','edu','gov','net','org') THEN a[-3:] ELSE a[-2:] END, '.') AS domain,
      count(*) AS pages, count(DISTINCT host) AS hosts
    FROM l GROUP BY 1""",
)
def registrable_domains(t):
    host = urls.authority_host(urls.url_parts("url")["authority"])
    return (
        t.pages.select(host.alias("host"))
        .withColumn("domain", urls.registrable_domain("host"))
        .groupBy("domain")
        .agg(F.count("*").alias("pages"), F.count_distinct("host").alias("hosts"))
    )


@query(
    "redirect_verdicts",
    f"""WITH {SQL_KEYED}, d AS (SELECT page_id, url_key, host,
        array_to_string(string_split(host, '.')[-2:], '.') AS domain FROM keyed),
    moved AS (SELECT a.page_id, a.host AS h1, b.host AS h2, a.domain AS d1, b.domain AS d2,
        b.url_key = a.url_key AS same_key FROM d a JOIN d b ON b.page_id = a.page_id + 1)
    SELECT page_id, CASE WHEN h1 <> h2 AND d1 <> d2 THEN 'off_site_redirect'
      WHEN same_key THEN 'closed' ELSE 'allowed' END AS verdict FROM moved""",
)
def redirect_verdicts(t):
    start = t.pages.select("page_id", F.col("url").alias("start_url"))
    final = t.pages.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("final_url"))
    return start.join(final, "page_id").select(
        "page_id",
        urls.redirect_verdict(F.col("start_url"), F.col("final_url"), F.col("start_url")).alias("verdict"),
    )


@query(
    "fetches_on_board_root",
    f"""WITH {SQL_KEYED}, board AS (SELECT host, min(url_key) AS root_key FROM keyed GROUP BY 1)
    SELECT k.page_id FROM keyed k JOIN board b ON k.host = b.host AND k.url_key = b.root_key""",
)
def fetches_on_board_root(t):
    pages = keyed_pages(t)
    boards = pages.groupBy(F.col("company_slug").alias("slug")).agg(
        F.min("url_key").alias("job_board_url")
    )
    return identity.on_board_root(
        pages.select("page_id", "company_slug", F.col("url").alias("final_url")), boards
    ).select("page_id")


@query(
    "http_outcomes",
    """SELECT outcome, count(*) AS fetches FROM (
      SELECT CASE WHEN status IN (404, 410) THEN 'not_found'
        WHEN status IN (401, 403, 429) OR (status = 503 AND (contains(b, 'captcha') OR contains(b, 'cloudflare')
          OR contains(b, 'challenge-platform') OR contains(b, 'access denied')
          OR contains(b, 'verify you are human') OR contains(b, 'checking your browser'))) THEN 'blocked'
        WHEN status >= 500 THEN 'server_error' END AS outcome
      FROM (SELECT l_quantity::INT + 395 + CASE WHEN l_tax > 0.04 THEN 100 ELSE 0 END AS status,
                   CASE WHEN l_returnflag = 'R' THEN 'Checking your BROWSER' ELSE 'x' END AS raw,
                   lower(raw) AS b FROM lineitem))
    GROUP BY 1""",
)
def http_outcomes(t):
    log = t.lineitem.select(
        (F.col("l_quantity").cast("int") + 395 + F.when(F.col("l_tax") > 0.04, 100).otherwise(0)).alias(
            "status"
        ),
        F.when(F.col("l_returnflag") == "R", "Checking your BROWSER").otherwise("x").alias("body"),
    )
    return (
        log.withColumn("outcome", urls.http_outcome(F.col("status"), F.col("body")))
        .groupBy("outcome")
        .agg(F.count("*").alias("fetches"))
    )


@query(
    "off_network_targets",
    """SELECT count(*) AS targets, count(*) FILTER (
        a IN (0, 10, 127) OR (a = 172 AND b BETWEEN 16 AND 31) OR (a = 192 AND b = 168)
        OR (a = 169 AND b = 254) OR (a = 100 AND b BETWEEN 64 AND 127) OR a >= 224
        OR (a = 198 AND b IN (18, 19)) OR (a = 192 AND b = 0 AND c IN (0, 2)) OR (a = 198 AND b = 51 AND c = 100)
        OR (a = 203 AND b = 0 AND c = 113)) AS unsafe
    FROM (SELECT l_orderkey % 256 AS a, l_partkey % 256 AS b, l_suppkey % 256 AS c FROM lineitem)""",
)
def off_network_targets(t):
    part = [F.col(c) % 256 for c in ("l_orderkey", "l_partkey", "l_suppkey")]
    url = F.format_string("http://%d.%d.%d.7:8080/x", *part)
    return t.lineitem.select(urls.off_public_network(url).alias("unsafe")).agg(
        F.count("*").alias("targets"), F.count_if("unsafe").alias("unsafe")
    )


@query(
    "posting_guard",
    f"""WITH {SQL_PARTS}, g AS (SELECT page_id, url, host, scheme,
        CASE WHEN path LIKE '%/' THEN left(path, length(path) - 1) ELSE path END AS p FROM parts)
    SELECT page_id, starts_with(p, '/en/') AND p <> '/en/25' AS is_posting FROM g""",
)
def posting_guard(t):
    parts = urls.url_parts("url")
    return t.pages.select(
        "page_id",
        urls.is_posting_url(
            F.col("url"),
            urls.origin_of(parts),
            F.lit("/en"),
            F.lit(1),
            F.concat(urls.origin_of(parts), F.lit("/en/25/?country=x")),
        ).alias("is_posting"),
    )


@query(
    "sanitized_urls",
    """SELECT page_id, CASE WHEN contains(url, '?ref') OR contains(url, 'page=') OR contains(url, 'utm')
        THEN regexp_replace(regexp_replace(url, '#.*$', ''), '=([^&]*)(&|$)', '=\\1\\2', 'g')
        ELSE regexp_replace(url, '#.*$', '') END AS safe_url FROM pages""",
)
def sanitized_urls(t):
    return t.pages.select("page_id", urls.sanitized_url("url").alias("safe_url"))


@query(
    "name_slugs",
    """SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_') AS slug,
      array_to_string([left(w, 1) for w in string_split(
        trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_'), '_')], '') AS acronym FROM part""",
)
def name_slugs(t):
    return t.part.select("p_partkey", slug("p_name").alias("slug")).withColumn("acronym", acronym("slug"))


# Links of a page: nav anchors are relative words; the page's own origin is the board.
SQL_ANCHORS = (
    SQL_PARTS
    + """,
anchors AS (
  SELECT page_id, scheme || '://' || host AS origin,
    unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS href,
    generate_subscripts(regexp_extract_all(html, '<a href="([^"]*)"', 1), 1) - 1 AS ord
  FROM parts JOIN pages USING (page_id)
)"""
)


def anchor_links(t, by_pattern: bool = True):
    anchors = (page_anchors_by_pattern if by_pattern else page_anchors)(t.pages)
    return links.absolute_links(anchors).withColumn(
        "origin", urls.origin_of(urls.url_parts("url"))
    )


@query(
    "anchors_by_pattern",
    f"WITH {SQL_ANCHORS} SELECT page_id, ord::BIGINT AS ord, href, origin || href AS abs_url FROM anchors",
)
def anchors_by_pattern(t):
    return anchor_links(t).select("page_id", F.col("ord").cast("long").alias("ord"), "href", "abs_url")


@query(
    "anchors_by_parser",
    f"WITH {SQL_ANCHORS} SELECT page_id, count(*) AS anchors, 0::BIGINT AS hidden, min(origin || href) AS first_link FROM anchors GROUP BY 1",
)
def anchors_by_parser(t):
    return (
        anchor_links(t, by_pattern=False)
        .groupBy("page_id")
        .agg(
            F.count("*").alias("anchors"),
            F.count_if("hidden").alias("hidden"),
            F.min("abs_url").alias("first_link"),
        )
    )


@query(
    "visible_anchors",
    f"WITH {SQL_ANCHORS} SELECT (SELECT count(*) FROM anchors) AS visible, 0::BIGINT AS outside_nav",
)
def visible_anchors(t):
    anchors = page_anchors(t.pages)
    return links.visible_links(anchors).agg(
        F.count("*").alias("visible"),
        F.count_if(~links.in_trail(F.col("trail"), "nav, .menu")).alias("outside_nav"),
    )


@query(
    "link_rule",
    f"""WITH {SQL_ANCHORS}, deep AS (SELECT page_id, origin || href AS link, min(ord) AS ord FROM anchors
        WHERE starts_with(origin || href, origin || '/') AND href <> '/' GROUP BY 1, 2)
    SELECT page_id, count(*) AS links, arg_min(link, ord) AS first_link FROM deep
    WHERE length(regexp_extract(link, '^[a-z]+://[^/?#]*([^?#]*)', 1)) > 1 GROUP BY 1""",
)
def link_rule(t):
    # Base path '' puts every path of the origin into the path bucket.
    rule = anchor_links(t).withColumn("base_path", F.lit("")).withColumn("min_depth", F.lit(1))
    chosen = links.apply_link_rule(rule, ["page_id"])
    return chosen.groupBy("page_id").agg(F.count("*").alias("links"), F.min_by("link", "ord").alias("first_link"))


@query(
    "link_rule_buckets",
    f"""WITH {SQL_PARTS}, r AS (SELECT host, page_id, url, scheme || '://' || host || path
          || CASE WHEN q = '' THEN '' ELSE '?' || q END AS link,
        CASE WHEN path LIKE '%/' THEN left(path, length(path) - 1) ELSE path END AS p, q FROM parts),
    b AS (SELECT *, CASE WHEN starts_with(p, '/en/') THEN 'path' WHEN p = '/en' AND q <> '' THEN 'query' END AS bucket FROM r)
    SELECT host, link FROM b WHERE bucket = 'path' OR (bucket = 'query' AND host NOT IN
      (SELECT host FROM b WHERE bucket = 'path')) GROUP BY 1, 2""",
)
def link_rule_buckets(t):
    parts = urls.url_parts("url")
    rule = t.pages.select(
        urls.authority_host(parts["authority"]).alias("host"),
        F.col("page_id").alias("ord"),
        F.col("url").alias("abs_url"),
        urls.origin_of(parts).alias("origin"),
        F.lit("/en").alias("base_path"),
        F.lit(1).alias("min_depth"),
    )
    return links.apply_link_rule(rule, ["host"]).select("host", "link")


@query(
    "first_seen_links",
    f"""WITH {SQL_ANCHORS} SELECT href, min(page_id * 1000 + ord)::BIGINT AS seen_at FROM anchors GROUP BY 1""",
)
def first_seen_links(t):
    rows = page_anchors_by_pattern(t.pages).select(
        "href", (F.col("page_id") * 1000 + F.col("ord")).alias("seen_at")
    )
    return links.first_seen(rows, ["href"], "seen_at")


@query(
    "pages_until_stale",
    f"""WITH {SQL_ANCHORS}, s AS (SELECT regexp_extract(p.host, '([^.]*)$', 1) AS host, p.page_id AS page, a.href
        FROM parts p JOIN anchors a USING (page_id)),
    f AS (SELECT host, href, min(page) AS first FROM s GROUP BY 1, 2),
    stop AS (SELECT s.host, min(s.page) AS stop FROM (SELECT DISTINCT host, page FROM s) s
        LEFT JOIN (SELECT DISTINCT host, first FROM f) f ON s.host = f.host AND s.page = f.first
        WHERE f.first IS NULL GROUP BY 1)
    SELECT s.host, count(*) AS links, max(s.page) AS last_page FROM s LEFT JOIN stop USING (host)
    WHERE stop IS NULL OR s.page < stop GROUP BY 1""",
)
def pages_until_stale(t):
    # The page id stands in for the page number of a board.
    rows = page_anchors_by_pattern(t.pages).select(
        F.regexp_extract(urls.authority_host(urls.url_parts("url")["authority"]), r"([^.]*)$", 1).alias("host"),
        F.col("page_id").alias("page"),
        "href",
    )
    return (
        links.pages_until_stale(rows, "host", "page", "href")
        .groupBy("host")
        .agg(F.count("*").alias("links"), F.max("page").alias("last_page"))
    )


@query(
    "link_census",
    f"""WITH {SQL_ANCHORS}, c AS (SELECT page_id, origin || href AS link, ord FROM anchors)
    SELECT page_id, count(*) AS eligible_links, count(*) AS visible_links, 0::BIGINT AS hidden_links,
      0::BIGINT AS fragment_links, (count(*) - count(DISTINCT link))::BIGINT AS repeated_links,
      count(*) AS at_depth_one, NULL::INT AS min_depth FROM c GROUP BY 1""",
)
def link_census(t):
    rule = (
        links.absolute_links(page_anchors(t.pages))
        .withColumn("origin", urls.origin_of(urls.url_parts("url")))
        .withColumn("base_path", F.lit(""))
        .withColumn("min_depth", F.lit(1))
    )
    census = links.link_census(rule, ["page_id"])
    return census.select(
        "page_id", "eligible_links", "visible_links", "hidden_links", "fragment_links", "repeated_links",
        F.coalesce(F.try_element_at("depth_counts", F.lit(1)), F.lit(0)).alias("at_depth_one"),
        links.suggested_min_depth(F.lit(1), F.col("depth_counts")).alias("min_depth"),
    )


@query(
    "url_union",
    f"""WITH {SQL_ANCHORS} SELECT count(*) AS urls FROM (
        SELECT host AS slug, url FROM parts UNION SELECT p.host, a.origin || a.href FROM anchors a JOIN parts p USING (page_id))""",
)
def url_union(t):
    host = urls.authority_host(urls.url_parts("url")["authority"]).alias("slug")
    linked = anchor_links(t).select(host, F.col("abs_url").alias("url"))
    return links.url_union(t.pages.select(host, "url"), linked).agg(F.count("*").alias("urls"))


@query(
    "url_set_difference",
    f"""WITH {SQL_ANCHORS}, host_links AS (SELECT DISTINCT regexp_extract(host, '([^.]*)$', 1) AS board, href, page_id
        FROM anchors JOIN parts USING (page_id)),
    o AS (SELECT DISTINCT board, href FROM host_links WHERE page_id >= 20),
    n AS (SELECT DISTINCT board, href FROM host_links WHERE href < '/s'),
    oo AS (SELECT * FROM o EXCEPT SELECT * FROM n), nn AS (SELECT * FROM n EXCEPT SELECT * FROM o),
    co AS (SELECT board, count(*) AS old_only, array_to_string(list_sort(list(href))[1:3], ' ') AS old_samples FROM oo GROUP BY 1),
    cn AS (SELECT board, count(*) AS new_only, array_to_string(list_sort(list(href))[1:3], ' ') AS new_samples FROM nn GROUP BY 1)
    SELECT coalesce(co.board, cn.board) AS board, coalesce(new_only, 0) AS new_only,
      coalesce(old_only, 0) AS old_only, new_samples, old_samples
    FROM co FULL JOIN cn ON co.board = cn.board""",
)
def url_set_difference(t):
    rows = page_anchors_by_pattern(t.pages).select(
        F.regexp_extract(urls.authority_host(urls.url_parts("url")["authority"]), r"([^.]*)$", 1).alias("board"),
        F.col("href").alias("url"),
        "page_id",
    )
    return links.url_set_difference(
        rows.filter("page_id >= 20"), rows.filter("url < '/s'"), "board"
    )


@query(
    "expected_count_mismatches",
    f"""WITH {SQL_ANCHORS}, f AS (SELECT host AS slug, count(DISTINCT origin || href) AS found
        FROM anchors JOIN parts USING (page_id) GROUP BY 1),
    e AS (SELECT host AS slug, 6 * count(*) AS expected_unfiltered_count FROM parts GROUP BY 1)
    SELECT e.slug, expected_unfiltered_count, coalesce(found, 0) AS found
    FROM e LEFT JOIN f USING (slug) WHERE coalesce(found, 0) <> expected_unfiltered_count""",
)
def expected_count_mismatches(t):
    host = urls.authority_host(urls.url_parts("url")["authority"]).alias("slug")
    boards = t.pages.groupBy(host).agg((F.count("*") * 6).alias("expected_unfiltered_count"))
    found = anchor_links(t).select(host, F.col("abs_url").alias("url"))
    return links.expected_count_mismatches(found, boards)


@query(
    "region_locations",
    """SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber,
        CASE WHEN l_returnflag = 'R' THEN 'Heredia, ' WHEN l_returnflag = 'A' THEN 'San Jose ' ELSE 'CRi ' END
        || CASE WHEN l_linestatus = 'F' THEN 'CR' ELSE 'usa' END AS place FROM lineitem)
    WHERE regexp_matches(place, '(?i)\\b(heredia|costa\\s+rica|latam|latin\\s+america)\\b')
       OR regexp_matches(place, '\\b(CR|CRI)\\b')""".replace("\\\\", "\\"),
)
def region_locations(t):
    place = F.concat(
        F.when(F.col("l_returnflag") == "R", "Heredia, ")
        .when(F.col("l_returnflag") == "A", "San Jose ")
        .otherwise("CRi "),
        F.when(F.col("l_linestatus") == "F", "CR").otherwise("usa"),
    )
    return t.lineitem.filter(regions.in_region(place)).select("l_orderkey", "l_linenumber")
