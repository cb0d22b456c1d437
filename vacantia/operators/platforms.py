"""What a stored page tells about its board: platform, filters, next-page control."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import urls
from vacantia.functions.markup import node_text, page_tree
from vacantia.functions.text import computed, fixed_strings

# Platform, host parts, page markers, network parts, suggested strategy.
# A marker is (kind, value): attr, class, id, tag, frame (iframe source part),
# attr_value (attr=value) or class_start (a class name beginning).
PLATFORMS = (
    ("Greenhouse", ("job-boards.greenhouse.io", "boards.greenhouse.io"),
     (("attr", "data-gh_jid"), ("class", "grnhse_iframe"), ("id", "grnhse_iframe"), ("frame", "greenhouse.io")),
     ("boards-api.greenhouse.io",), "greenhouse"),
    ("Lever", ("jobs.lever.co",), (("frame", "jobs.lever.co"),), ("api.lever.co",), "dom"),
    ("Workday", ("myworkdayjobs.com", "myworkday.com"), (("attr_value", "data-automation-id=jobResults"),),
     ("myworkdayjobs.com", "wday/cxs"), "dom"),
    ("Phenom", ("phenompeople.com",), (("class_start", "phw-"), ("tag", "phw-app")),
     ("/widgets", "phenompeople.com"), "dom"),
    ("Coveo", (".coveo.com",), (("tag", "atomic-search-interface"), ("attr", "data-coveo")),
     ("/rest/search/v2", ".coveo.com"), "dom"),
    ("iCIMS", ("icims.com",), (("id", "icims_content_iframe"), ("frame", "icims.com")), ("icims.com",), "dom"),
    ("Ashby", ("jobs.ashbyhq.com", "ashbyhq.com"), (("frame", "ashbyhq.com"),), ("ashbyhq.com",), "dom"),
    ("BambooHR", (".bamboohr.com",), (("frame", "bamboohr.com"),), ("bamboohr.com",), "dom"),
    ("SmartRecruiters", ("smartrecruiters.com",), (("frame", "smartrecruiters.com"),), ("smartrecruiters.com",), "dom"),
    ("RecruitCRM", ("recruitcrm.io",), (), ("recruitcrm.io",), "dom"),
    ("Simplicant", (".simplicant.com",), (), (".simplicant.com",), "dom"),
    ("TeamTailor", ("teamtailor.com",), (), ("teamtailor.com",), "dom"),
)
# Path parts of job-like endpoints, words of location filters.
JOB_PATH_TOKENS = (
    "job",
    "jobs",
    "career",
    "careers",
    "posting",
    "postings",
    "opening",
    "openings",
    "requisition",
    "requisitions",
)
LOCATION_TOKENS = ("country", "location", "region", "office", "city", "pais", "país")
NEXT_WORDS = (
    "next",
    "view",
    "go",
    "to",
    "the",
    "page",
    "pages",
    "result",
    "results",
    "job",
    "jobs",
    "posting",
    "postings",
    "listing",
    "listings",
    "opening",
    "openings",
)
SAMPLE_OPTIONS = 10


def _any_part(text: Column, parts) -> Column:
    hit = F.lit(False)
    for part in parts:
        hit = hit | F.contains(text, F.lit(part.lower()))
    return hit


def _marker(nodes: Column, kind: str, value: str) -> Column:
    def holds(n: Column) -> Column:
        attrs = n["attrs"]
        if kind == "attr":
            return F.map_contains_key(attrs, value)
        if kind == "attr_value":
            name, wanted = value.split("=", 1)
            return F.coalesce(attrs[name] == wanted, F.lit(False))
        if kind == "class":
            return F.coalesce(F.array_contains(F.split(attrs["class"], r"\s+"), value), F.lit(False))
        if kind == "class_start":
            return F.coalesce(attrs["class"].rlike(rf"(?:^| ){value}"), F.lit(False))
        if kind == "id":
            return F.coalesce(attrs["id"] == value, F.lit(False))
        if kind == "tag":
            return n["tag"] == value
        return (n["tag"] == "iframe") & F.coalesce(F.contains(attrs["src"], F.lit(value)), F.lit(False))

    return F.exists(nodes, holds)


def platform_hits(pages: DataFrame, network: DataFrame | None = None, key: str = "page_id") -> DataFrame:
    """Platforms recognised per page with the signals that fired: key, platform, signals.

    The rule list is fixed and small, so it is applied inside each row. *network* holds
    response URLs (key, network_url); each is matched on its own and reduced to one flag
    per page and platform before it is joined.
    """
    host = urls.authority_host(urls.url_parts("url")["authority"])
    read = pages.select(key, host.alias("_host"), page_tree("html").alias("_tree"))
    rows = []
    for place, (name, hosts, markers, _, strategy) in enumerate(PLATFORMS):
        dom = F.lit(False)
        for kind, value in markers:
            dom = dom | _marker(F.col("_tree.nodes"), kind, value)
        rows.append(
            F.struct(
                F.lit(place).alias("place"),
                F.lit(name).alias("platform"),
                F.lit(strategy).alias("strategy"),
                _any_part(F.col("_host"), hosts).alias("on_host"),
                dom.alias("in_dom"),
            )
        )
    hits = read.select(key, F.explode_outer(F.array(*rows)).alias("_h")).select(key, "_h.*")
    if network is not None:
        called = network.select(key, F.explode(_claimed_by(F.lower("network_url"))).alias("platform")).distinct()
        hits = hits.join(called.withColumn("on_network", F.lit(True)), [key, "platform"], "left")
    else:
        hits = hits.withColumn("on_network", F.lit(False))
    signals = F.array_compact(
        F.array(
            F.when(F.col("on_host"), "host"),
            F.when(F.col("in_dom"), "dom"),
            F.when(F.coalesce("on_network", F.lit(False)), "network"),
        )
    )
    return (
        hits.withColumn("signals", signals)
        .filter(F.size("signals") > 0)
        .select(key, "place", "platform", "strategy", "signals")
    )


def _claimed_by(url: Column) -> Column:
    """Platforms whose network parts occur in a lower-case URL."""
    return F.array_compact(
        F.array(*[F.when(_any_part(url, parts), F.lit(name)) for name, _, _, parts, _ in PLATFORMS])
    )


def unclassified_job_apis(network: DataFrame, hits: DataFrame, key: str = "page_id") -> DataFrame:
    """Distinct job-like response URLs that no recognised platform of the page claims."""
    path = F.lower(urls.url_parts("network_url")["path"])
    jobs = network.filter(_any_part(path, JOB_PATH_TOKENS)).select(key, "network_url").distinct()
    claims = jobs.select(
        key, "network_url", F.explode(_claimed_by(F.lower("network_url"))).alias("platform")
    ).join(hits.select(key, "platform").distinct(), [key, "platform"], "left_semi")
    return jobs.join(claims.select(key, "network_url").distinct(), [key, "network_url"], "left_anti")


def location_options(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Location options of a board page: key, ord, option_id, label."""
    nodes = pages.select(key, F.posexplode_outer(page_tree("html")["nodes"]).alias("ord", "_n"))
    attrs = F.col("_n.attrs")
    return (
        nodes.filter(attrs["data-cy"].rlike("^_location_id_select_.*_option$"))
        .select(
            key,
            "ord",
            F.trim(attrs["data-value"]).alias("option_id"),
            F.trim(attrs["data-text"]).alias("label"),
        )
        .filter("option_id <> '' and label <> ''")
    )


def filter_controls(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Filter controls of stored pages: key, kind, tag, name, id, label, sample_options.

    Kinds: location selects, comboboxes, location checkbox groups and plain search boxes.
    All rules work on the page's own element list; samples hold the first ten options,
    which is what the census shows. The group of a visible checkbox is the nearest of the
    first six elements around it that holds two checkboxes or more, hidden ones included, and
    the seventh if none of the six does; a group is shown if the first 200 characters of its
    text name a place. What lies below an element is a range of positions, and checkboxes
    below it are a difference of counts, so no element searches the others.
    """
    read = pages.select(key, page_tree("html").alias("tree"))
    tree, nodes = F.col("tree"), F.col("tree.nodes")
    shown = F.filter(nodes, lambda n: ~n["hidden"])
    labelling = F.filter(nodes, lambda n: n["tag"] == "label")

    def is_box(n: Column) -> Column:
        return (n["tag"] == "input") & F.coalesce(F.lower(n["attrs"]["type"]) == "checkbox", F.lit(False))

    # Lists that lambdas look into are columns of their own, or each call would make them anew.
    read = computed(
        read,
        "parts",
        F.struct(
            labelling.alias("labels"),
            F.transform(labelling, lambda n: F.coalesce(n["attrs"]["for"], F.lit(""))).alias("labelled"),
            F.filter(nodes, lambda n: n["tag"] == "option").alias("options"),
            F.filter(nodes, is_box).alias("boxes"),
        ),
    )
    labels, labelled, options, boxes = (F.col(f"parts.{c}") for c in ("labels", "labelled", "options", "boxes"))
    tokens = "(?iu)" + "|".join(LOCATION_TOKENS)

    def at(position: Column) -> Column:
        return F.try_element_at(nodes, position + 1)

    def named(text: Column) -> Column:
        return F.coalesce(text.rlike(tokens), F.lit(False))

    def label_for(element_id: Column) -> Column:
        place = F.array_position(labelled, element_id)
        return F.when((element_id != "") & (place > 0), node_text(tree, F.get(labels, place.cast("int") - 1)))

    def control(kind: str, n: Column, label: Column, options: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            n["position"].alias("position"),
            n["tag"].alias("tag"),
            F.nullif(F.coalesce(n["attrs"]["name"], F.lit("")), F.lit("")).alias("name"),
            F.nullif(F.coalesce(n["attrs"]["id"], F.lit("")), F.lit("")).alias("id"),
            F.nullif(F.coalesce(label, F.lit("")), F.lit("")).alias("label"),
            options.alias("sample_options"),
        )

    none = F.array().cast("array<string>")

    def options_of(select: Column) -> Column:
        # Options may sit in groups: their parent or its parent is the select.
        def group_of(option: Column) -> Column:
            return F.when(at(option["parent"])["tag"] == "optgroup", at(option["parent"])["parent"])

        own = F.filter(
            options,
            lambda o: o["position"].between(select["position"] + 1, select["end"])
            & ((o["parent"] == select["position"]) | F.coalesce(group_of(o) == select["position"], F.lit(False))),
        )
        return F.slice(F.filter(F.transform(own, lambda o: node_text(tree, o)), lambda v: v != ""), 1, SAMPLE_OPTIONS)

    selects = F.transform(
        F.filter(
            shown,
            lambda n: (n["tag"] == "select")
            & (named(n["attrs"]["name"]) | named(n["attrs"]["id"]) | named(label_for(n["attrs"]["id"]))),
        ),
        lambda n: control("select", n, label_for(n["attrs"]["id"]), options_of(n)),
    )
    comboboxes = F.transform(
        F.filter(
            shown,
            lambda n: F.coalesce(n["attrs"]["role"] == "combobox", F.lit(False))
            | F.coalesce(n["attrs"]["aria-haspopup"] == "listbox", F.lit(False)),
        ),
        lambda n: control(
            "combobox",
            n,
            F.substring(F.coalesce(F.nullif(n["attrs"]["aria-label"], F.lit("")), node_text(tree, n, 200)), 1, 200),
            none,
        ),
    )

    def group_of(box: Column) -> Column:
        def climb(place: Column, _: Column) -> Column:
            around = at(place)
            held = at(around["end"])["boxes"] - around["boxes"]
            return F.when(held >= 2, place).otherwise(around["parent"])

        return F.aggregate(F.sequence(F.lit(1), F.lit(6)), box["parent"], climb)

    def box_label(box: Column) -> Column:
        return F.coalesce(
            F.nullif(label_for(F.coalesce(box["attrs"]["id"], F.lit(""))), F.lit("")),
            node_text(tree, at(box["label"])),
        )

    def labels_in(group: Column) -> Column:
        # The page's checkboxes are in document order, so a group's own are a slice.
        own = F.slice(boxes, group["boxes"] + 1, at(group["end"])["boxes"] - group["boxes"])
        return F.slice(
            F.filter(F.transform(own, box_label), lambda v: v.isNotNull() & (v != "")), 1, SAMPLE_OPTIONS
        )

    places = F.array_distinct(F.array_compact(F.transform(F.filter(boxes, lambda b: ~b["hidden"]), group_of)))
    groups = F.transform(
        F.filter(F.transform(places, at), lambda n: named(node_text(tree, n, 200))),
        lambda n: control("checkbox_group", n, node_text(tree, n, 80), labels_in(n)),
    )
    searches = F.transform(
        F.filter(
            shown,
            lambda n: (n["tag"] == "input")
            & F.coalesce(n["attrs"]["type"].isin("search", "text"), F.lit(False))
            & ~(
                named(n["attrs"]["placeholder"])
                | named(n["attrs"]["aria-label"])
                | named(n["attrs"]["name"])
                | named(n["attrs"]["id"])
            ),
        ),
        lambda n: control(
            "search_box",
            n,
            F.substring(
                F.coalesce(F.nullif(n["attrs"]["aria-label"], F.lit("")), n["attrs"]["placeholder"], F.lit("")), 1, 80
            ),
            none,
        ),
    )
    found = F.concat(selects, comboboxes, groups, searches)
    return read.select(key, F.explode_outer(found).alias("_c")).filter("_c is not null").select(
        key,
        *[F.col(f"_c.{c}").alias(c) for c in ("kind", "position", "tag", "name", "id", "label", "sample_options")],
    )


def _means_next(text: Column) -> Column:
    words = F.filter(F.split(F.lower(text), "[^a-z]+"), lambda w: w != "")
    return (
        F.array_contains(words, "next") & (F.size(F.array_except(words, fixed_strings(NEXT_WORDS))) == 0)
    )


def next_controls(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Next-page control of each stored page: key, signal, position, text.

    Signals in order: rel=next, label, text, number after the current page, class token,
    load-more. Each element is ranked by its strongest signal and the page's best is kept.
    """
    read = pages.select(key, page_tree("html").alias("tree"))
    nodes = F.col("tree.nodes")
    leaf_numbers = F.filter(
        nodes,
        lambda n: ~n["tag"].isin("a", "button") & (n["children"] == 0) & n["text"].rlike(r"^\d{1,9}$"),
    )
    read = computed(read, "numbers", leaf_numbers)
    numbers = F.col("numbers")
    usable = F.filter(
        nodes,
        lambda n: n["tag"].isin("a", "button")
        & ~n["hidden"]
        & ~F.map_contains_key(n["attrs"], "disabled")
        & ~F.coalesce(F.lower(n["attrs"]["aria-disabled"]) == "true", F.lit(False)),
    )

    def place(n: Column) -> Column:
        """Earliest current-page mark that this control follows as a number."""
        marks = F.filter(
            numbers,
            lambda c: (F.try_to_number(c["text"], F.lit("999999999")) + 1 == F.try_to_number(n["text"], F.lit("999999999")))
            & F.coalesce(
                n["position"].between(c["parent"] + 1, F.try_element_at(nodes, c["parent"] + 1)["end"]), F.lit(False)
            ),
        )
        return F.try_element_at(marks, F.lit(1))["position"]

    def signal(n: Column) -> Column:
        attrs, text = n["attrs"], node_text(F.col("tree"), n)
        label = F.coalesce(attrs["aria-label"], F.lit(""))
        more = r"(?i)^(?:load|show)\s*more"

        def hit(rank: int, name: str, at: Column, shown: Column) -> Column:
            return F.struct(
                F.lit(rank).alias("rank"),
                at.cast("int").alias("at"),
                n["position"].alias("position"),
                F.lit(name).alias("signal"),
                F.trim(shown).alias("text"),
            )

        at = n["position"]
        rel = F.array_contains(F.split(F.lower(F.coalesce(attrs["rel"], F.lit(""))), r"\s+"), "next")
        classes = F.array_contains(F.split(F.coalesce(attrs["class"], F.lit("")), r"\s+"), "next")
        follows = F.when(text.rlike(r"^\d{1,9}$"), place(n))
        return (
            F.when((n["tag"] == "a") & rel, hit(1, "rel-next", at, text))
            .when(_means_next(label), hit(2, "aria-label", at, label))
            .when(_means_next(text), hit(3, "text-next", at, text))
            .when(follows.isNotNull(), hit(4, "numeric-successor", follows, text))
            .when(classes, hit(5, "class-next", at, text))
            .when(text.rlike(more), hit(6, "load-more", at, text))
            .when(label.rlike(more), hit(6, "load-more", at, label))
        )

    best = F.array_min(F.array_compact(F.transform(usable, signal)))
    return (
        read.select(key, best.alias("_s"))
        .filter("_s is not null")
        .select(key, "_s.signal", "_s.position", "_s.text")
    )
