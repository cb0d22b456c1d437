"""Operators on small fixtures, against brute force where order matters."""

import random

import pytest
from pyspark.sql import functions as F

from vacantia.functions.numbering import next_in_group, numbered
from vacantia.operators import answers, content, facts, history, identity, links, phrases, platforms, scoring
from vacantia.schemas import FACT_VALUES, FACTS, JOB_SOURCES, JOBS
from vacantia.sources import payloads, sinks, tables


def fold_one_by_one(rows):
    """Brute force of merging postings one by one."""
    live, result = [], {}
    for job, company, req, title, mark in sorted(rows):
        others = [o for o in live if o[1] == company]
        match = None
        same_req = [o for o in others if req is not None and o[2] == req]
        if len(same_req) == 1 and title is not None and same_req[0][3] == title:
            match = same_req[0]
        same_mark = [o for o in others if o[4] == mark]
        if match is None and len(same_mark) == 1:
            match = same_mark[0]
        if match is None:
            live.append((job, company, req, title, mark))
        result[job] = match[0] if match else job
    return result


@pytest.mark.parametrize("seed", range(4))
def test_fold_in_order(spark, seed):
    rng = random.Random(seed)
    rows = []
    for job in range(60):
        title = rng.choice(["a", "b", None])
        rows.append((job, rng.choice("xy"), rng.choice([None, "r1", "r2", "r3"]), title, f"{title}-{rng.randrange(12)}"))
    frame = spark.createDataFrame(rows, "job_id long, company_slug string, requisition_id string, title_key string, fingerprint string")
    got = {r["job_id"]: r["canonical_id"] for r in identity.fold_in_order(frame).collect()}
    assert got == fold_one_by_one(rows)


def test_merge_roots(spark):
    frame = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (5, 99), (6, 7), (7, 6), (8, 6)], "id long, merged_into_id long")
    got = {r["job_id"]: (r["root_id"], r["problem"]) for r in identity.merge_roots(frame).collect()}
    assert got == {1: (1, None), 2: (1, None), 3: (1, None), 4: (1, None), 5: (None, "missing"), 6: (None, "cycle"), 7: (None, "cycle"), 8: (None, "cycle")}


def test_numbered_and_next(spark):
    frame = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    rows = numbered(frame, ["k"], "n", 5).collect()
    assert all(r["n"] == r["k"] + 6 for r in rows)
    data = spark.createDataFrame([("a", i, f"2024-01-0{1 + i // 3}") for i in range(9)], "g string, t int, d string")
    got = {r["t"]: r["x"] for r in next_in_group(data, ["g"], ["t"], "t", F.col("d"), "x").collect()}
    assert got == {**{i: i + 1 for i in range(8)}, 8: None}


def test_unbound_phrases_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["the", "a", "é", "straße", "x1", "Go"]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 60)))) for i in range(80)]
    wanted = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 5)))) for i in range(30)]
    got = phrases.unbound_phrases(
        spark.createDataFrame(wanted, "item_id long, phrase string"), spark.createDataFrame(docs, "doc_id long, text string"), max_span=2
    ).collect()
    fold = lambda s: f" {s.casefold()} "
    assert {(r[0], r[1]) for r in got} == {(i, d) for i, p in wanted if p for d, t in docs if fold(p) in fold(t)}


def test_link_rule(spark):
    hrefs = ["/jobs/1#a", "/jobs/1", "/jobs/1/", "/jobs?x=1", "https://o.io/jobs/2", "/jobs//3", "/about"]
    rows = [("p1", i, "https://b.io/jobs", h, "https://b.io", "/jobs", 1) for i, h in enumerate(hrefs)]
    rows += [("p2", 0, "https://b.io/jobs", "?id=5", "https://b.io", "/jobs", 2), ("p2", 1, "https://b.io/jobs", "/jobs/1", "https://b.io", "/jobs", 2)]
    frame = spark.createDataFrame(rows, "page string, ord int, url string, href string, origin string, base_path string, min_depth int")
    got = links.apply_link_rule(links.absolute_links(frame), ["page"]).orderBy("page", "ord").collect()
    assert [(r["page"], r["link"]) for r in got] == [
        ("p1", "https://b.io/jobs/1"), ("p1", "https://b.io/jobs/1/"), ("p1", "https://b.io/jobs//3"), ("p2", "https://b.io/jobs?id=5"),
    ]


def test_visibility_and_suppression(spark):
    html = '<div style="display: none"><a href="/h">x</a></div><nav class="menu top"><a href="/n">n</a></nav><a href="/v">v</a><a hidden href="/w">w</a>'
    from vacantia.functions.markup import page_anchors

    anchors = page_anchors(spark.createDataFrame([(1, "https://b.io", html)], "page_id long, url string, html string"))
    assert [r["href"] for r in links.visible_links(anchors).orderBy("ord").collect()] == ["/n", "/v"]
    assert [r["href"] for r in links.visible_links(anchors, "nav.menu, #x").collect()] == ["/v"]
    with pytest.raises(ValueError):
        links.visible_links(anchors, "nav > a")


def test_structured_postings(spark):
    html = """<title> Page  title </title><script type="application/ld+json">{"@graph": [{"@type": ["Thing", "jobposting"], "title": "Dev ",
    "identifier": {"name": "Acme", "value": "R-1"}, "validThrough": "2024-01-01", "employmentType": ["FULL", 3],
    "hiringOrganization": "Acme", "jobLocation": [{"address": {"addressLocality": "Heredia", "addressCountry": "CR"}}, "Remote", {"address": "Remote"}],
    "description": "<p>Hi</p><ul><li>one</li></ul>"}]}</script><script type="application/ld+json">{bad</script>
    <nav>skip</nav><p>Body<br>text</p><ul><li>a</li></ul><footer>f</footer>"""
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    row = content.structured_postings(pages).first()
    assert (row["title"], row["identifier"], row["hiring_org"]) == ("Dev", "R-1", "Acme")
    assert row["locations"] == ["Heredia, CR", "Remote"] and row["employment_type"] == ["FULL"]
    assert row["description_text"] == "Hi\n\n• one"
    read = content.read_pages(pages).first()
    assert read["page_title"] == "Page title" and read["main_text"] == "Body\ntext\n\n• a"


def test_content_gate(spark):
    long = "word " * 100

    def page(extra, body=long, described=long):
        return f'<title>T</title><script type="application/ld+json">{{"@type": "JobPosting", "title": "J"{extra}, "description": "{described}"}}</script><p>{body}</p>'

    pages = spark.createDataFrame(
        [
            (1, page("")), (2, page(', "validThrough": "2020-01-01"', body="short")), (3, page(', "validThrough": "2020-01-01"')),
            (4, f"<title>T</title><p>{long}</p>"), (5, "<p>short</p>"), (6, f"<p>{long} This position has been filled</p>"),
        ],
        "page_id long, html string",
    )
    got = {r["page_id"]: (r["method"], r["failure_category"], r["title"]) for r in content.page_contents(pages, "2024-01-01").collect()}
    assert got == {
        1: ("jsonld", None, "J"), 2: (None, "closed", None), 3: ("jsonld", None, "J"),
        4: ("main_content", None, "T"), 5: (None, "empty_content", None), 6: (None, "closed", None),
    }


def answer(decision="eligible", reason="Fine.", supporting=("we hire",), conflicting=()):
    import json

    return json.dumps({"decision": decision, "reason": reason, "supporting_evidence": list(supporting), "conflicting_evidence": list(conflicting)})


def test_answers(spark):
    rows = [
        (1, answer()), (2, answer(supporting=["WE  hire", "we hire."])), (3, answer(supporting=["nobody"])),
        (4, answer("unknown", answers.MISSING_INFORMATION_REASON, [])), (5, answer(supporting=[])),
        (6, answer(conflicting=["We hire"])), (7, "{}"), (8, answer()[:-1] + ', "x": 1}'), (9, "not json"),
    ]
    contents = spark.createDataFrame([(i, "Here We Hire, remote.") for i in range(1, 10)], "content_id long, text string")
    typed = answers.parse_answers(spark.createDataFrame(rows, "content_id long, raw_json string")).withColumn("call_status", F.lit("parsed"))
    got = {r["content_id"]: r["status"] for r in answers.call_statuses(typed, contents, ["content_id"]).collect()}
    assert got == {1: "grounded", 2: "grounded", 3: "ungrounded", 4: "grounded", 5: "inconsistent", 6: "inconsistent", 7: "invalid_response", 8: "invalid_response", 9: "invalid_response"}
    kept = {r["content_id"]: r["supporting_evidence"] for r in answers.verdicts(typed.filter("parsed"), contents, ["content_id"]).collect()}
    assert kept == {1: ["We Hire"], 2: ["We Hire"], 4: []}


def fact(state="not_stated", value=None, evidence=()):
    return (state, value, list(evidence))


def result(**given):
    return tuple(given.get(name, fact()) for name in FACT_VALUES)


POSTING = "Engineer at Acme\nRequirements:\n- Know Java well\nNice to have\n- Go\nWe must see Rust."


def judged(spark, **given):
    frame = spark.createDataFrame([(1, result(**given))], "content_id long, facts " + FACTS.simpleString())
    posting = spark.createDataFrame([(1, POSTING)], "content_id long, text string")
    return facts.validate_facts(frame, posting).first()


def test_fact_rules(spark):
    good = {n: fact("extracted", "v", ["engineer"]) for n in ("title", "summary", "compensation_text", "requisition_id")}
    row = judged(spark, **good)
    assert not row["rejected"] and row["notes"] == []
    row = judged(spark, **{**good, "benefits": fact("extracted", ["x"], ["not there"])})
    assert not row["rejected"] and row["facts"]["benefits"]["state"] == "failed"
    assert row["notes"] == ['benefits: ungrounded evidence "not there"']
    assert judged(spark, **{**good, "title": fact("extracted", "v", ["absent"])})["ungrounded"] == ["absent"]
    row = judged(spark, **{**good, "location": fact("extracted", ("CR", None, None), ["acme"])})
    assert row["facts"]["location"]["state"] == "failed"
    row = judged(spark, **{**good, "summary": fact("extracted", "We use Acme and Zebra.", ["engineer"])})
    assert row["facts"]["summary"]["state"] == "uncertain" and "Zebra" in row["notes"][0]
    row = judged(
        spark,
        **{
            **good,
            "required_qualifications": fact("extracted", [("Java", "skill", ["Know Java well"])], ["Requirements"]),
            "preferred_qualifications": fact("extracted", [("JAVA ", "skill", ["Go"])], ["Go"]),
            "technologies": fact(
                "extracted",
                [("Java", "required", ["know java well"]), ("Go", "required", ["- Go"]), ("Rust", "required", ["must see Rust"]), ("Acme", "mentioned", ["Acme"])],
                ["Acme"],
            ),
        },
    )
    assert row["facts"]["preferred_qualifications"]["state"] == "failed"
    assert [m["status"] for m in row["facts"]["technologies"]["value"]] == ["required", "mentioned", "required", "mentioned"]
    assert row["notes"][-1] == "technologies: lowered Go from required to mentioned"


def test_next_control_and_filters(spark):
    pages = spark.createDataFrame([(1, "<div><span>2</span><p><a>3</a></p></div><a class='next'>x</a>"), (2, "<button>Show more</button>"), (3, "<a>Prev</a>")], "page_id long, html string")
    got = {r["page_id"]: (r["signal"], r["text"]) for r in platforms.next_controls(pages).collect()}
    assert got == {1: ("numeric-successor", "3"), 2: ("load-more", "Show more")}


def test_checkbox_groups(spark):
    box = "<input type='checkbox'%s>"
    near = "<div>City <label>" + box % "" + "A</label><span><label for='b'>B</label>" + box % " id='b' hidden" + "</span></div>"
    far = "<section>Region" + "<div>" * 7 + box % "" + "</div>" * 7 + box % "" + "</section>"
    wrapped = "<fieldset>Office <label><b>" + box % "" + "</b> C</label>" + box % "" + "</fieldset>"
    lonely = "<p>City</p>" + box % ""
    pages = spark.createDataFrame(list(enumerate([near, far, wrapped, lonely, "", None])), "page_id long, html string")
    got = sorted((r["page_id"], r["kind"], r["tag"], r["label"], r["sample_options"]) for r in platforms.filter_controls(pages).collect())
    # Seven elements stand between the far box and the section; its own box makes the section a group.
    assert got == [
        (0, "checkbox_group", "div", "City AB", ["A", "B"]),
        (1, "checkbox_group", "section", "Region", []),
        (2, "checkbox_group", "fieldset", "Office  C", ["C"]),
    ]


def test_filter_census_of_a_large_page(spark):
    """20,000 elements with nested groups: ranges and counts, no search per element."""
    from time import monotonic

    item = "<div><ul>City " + "".join(f"<li><label><input type='checkbox' id='x{i}'>o{i}</label></li>" for i in range(6)) + "</ul></div>"
    pages = spark.createDataFrame([(1, item * 1_000)], "page_id long, html string")
    platforms.filter_controls(pages.limit(0)).collect()
    begun = monotonic()
    rows = platforms.filter_controls(pages).collect()
    assert len(rows) == 1_000 and monotonic() - begun < 30
    assert {tuple(r["sample_options"]) for r in rows} == {tuple(f"o{i}" for i in range(6))}


def test_payload_types(spark):
    payload = '{"jobs": [{"absolute_url": "u1", "location": {"name": "Costa Rica"}}, 5, {"absolute_url": "", "location": null}, {"absolute_url": "u2"}]}'
    frame = spark.createDataFrame([("b", payload), ("c", '{"jobs": 3}'), ("d", "x"), ("e", "{}")], "board string, payload string")
    assert [r["url"] for r in payloads.greenhouse(frame).orderBy("ord").collect()] == ["u1", "u2"]
    problems = {r["board"]: r["problem"] for r in payloads.payload_problems(frame, "jobs", ["board"]).collect()}
    assert problems == {"c": "jobs is not a list", "d": "not JSON", "e": "missing jobs"}


def test_snapshot_versions(spark, tmp_path):
    stored = spark.createDataFrame([("a", "u1", 0), ("b", "u2", 0)], "company_slug string, url string, ord long").withColumn("captured_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    batch = spark.createDataFrame([("c", "u4", 1), ("c", "u3", 0), ("c", "u4", 2)], "company_slug string, url string, ord long")
    named = spark.createDataFrame([("a",), ("c",)], "company_slug string")
    version = sinks.replaced_snapshot(stored, batch, named, "2024-01-02")
    sinks.write_version(version, str(tmp_path / "v1"), "company_slug")
    got = [(r["company_slug"], r["url"]) for r in tables.url_snapshot(spark, str(tmp_path / "v1")).collect()]
    assert got == [("b", "u2"), ("c", "u3"), ("c", "u4")]


def test_only_whole_boards_are_replaced(spark):
    page = '{"totalCount": %s, "results": [%s]}'
    item = '{"clickUri": "%s", "raw": {"country": "Costa Rica"}}'
    rows = [
        ("whole", 1, page % (2, item % "w1")), ("whole", 2, page % (9, item % "w2")),
        ("short", 1, page % (3, item % "s1")), ("short", 2, page % (3, "")),
        ("broken", 1, page % (1, item % "b1")), ("broken", 2, "{"), ("broken", 3, '{"results": 3}'),
        ("untold", 1, page % ('"7"', item % "u1")), ("emptied", 1, page % (0, "")),
    ]
    pages = spark.createDataFrame(rows, "board string, page int, payload string")
    counts = payloads.coveo_counts(pages)
    got = {r["board"]: (r["expected"], r["received"], r["problem"], r["status"]) for r in counts.collect()}
    assert got == {
        "whole": (2, 2, None, "complete"),
        "short": (3, 1, None, "short"),
        "broken": (1, 1, "not JSON", "failed"),
        "untold": (None, 1, None, "complete"),
        "emptied": (0, 0, None, "complete"),
    }
    boards = ["whole", "short", "broken", "untold", "emptied", "absent"]
    stored = spark.createDataFrame([(b, "old", 0) for b in boards], "company_slug string, url string, ord long").withColumn("captured_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    batch = payloads.coveo(pages).select(F.col("board").alias("company_slug"), "url", F.col("ord").cast("long").alias("ord"))

    def kept(**how):
        return sorted((r["company_slug"], r["url"]) for r in sinks.guarded_snapshot(stored, batch, counts, "2024-01-02", **how).collect())

    same = [("absent", "old"), ("broken", "old")]
    whole = [("untold", "u1"), ("whole", "w1"), ("whole", "w2")]
    assert kept() == same + [("short", "old")] + whole
    assert kept(accept_short=True) == same + [("short", "s1")] + whole
    hits = '{"refineSearch": {"totalHits": %s, "data": {"jobs": [{}, 5]}}}'
    more = spark.createDataFrame([("a", hits % 3), ("b", hits % 2), ("c", hits % "2.5")], "board string, payload string")
    assert {r["board"]: r["status"] for r in payloads.phenom_counts(more).collect()} == {"a": "short", "b": "complete", "c": "complete"}


def test_file_sources(spark, tmp_path):
    import hashlib
    import json

    text = "We hire\nin Costa Rica.\n"
    digest = hashlib.sha256(text.encode()).hexdigest()
    case = tmp_path / "cases" / "C1"
    case.mkdir(parents=True)
    (case / "content.txt").write_text(text)
    (case / "expected_eligibility.json").write_text(json.dumps({"schema_version": 1, "case_id": "C1", "reviewed": True, "decision": "eligible", "must_cite": ["Costa Rica"], "partition": "development", "source_content_sha256": digest}))
    cases = tables.evaluation_cases(spark, str(tmp_path / "cases"))
    assert scoring.case_violations(cases).count() == 0
    key = hashlib.sha256(json.dumps({"model": "m", "eligibility_prompt_hash": "h", "case_id": "C1", "source_hash": digest, "replay": 1}, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    saved = tmp_path / "rec"
    saved.mkdir()
    base = {"recording_version": 3, "key": key, "requested_model": "m", "eligibility_prompt_hash": "h", "case_id": "C1", "source_content_sha256": digest, "replay": 1, "status": "parsed", "raw_json": answer(supporting=["costa rica"]), "latency_ms": 7, "prompt_tokens": -1}
    (saved / f"{key}.json").write_text(json.dumps(base))
    (saved / "other.json").write_text(json.dumps({**base, "replay": 2}))
    good, bad = tables.usable_recordings(tables.recordings(spark, str(saved)), cases, "m", "h")
    row = good.first()
    assert (row["case_id"], row["call_status"], row["prompt_tokens"], row["latency_ms"]) == ("C1", "parsed", None, 7)
    assert row["answer"]["supporting_evidence"] == ["costa rica"] and bad.count() == 1
    board = tmp_path / "boards" / "acme"
    board.mkdir(parents=True)
    (board / "metadata.json").write_text(json.dumps({"company_name": "Acme", "job_board_url": "https://b", "sample_job_url": "https://b/1", "expected_unfiltered_count": 2, "states": [{"file": "s.html", "url": "u", "frames": [{"file": "f.html", "url": "v"}]}]}))
    boards = tables.board_snapshots(spark, str(tmp_path / "boards"))
    assert {(r["slug"], r["file"]) for r in tables.snapshot_pages(boards).collect()} == {("acme", "s.html"), ("acme", "f.html")}
    (tmp_path / "catalog.json").write_text(json.dumps({"name": "Ácme & Co", "job_board_url": "https://b", "strategy": "dom", "link_rule": {"min_depth": 2}}))
    entry = tables.catalog(spark, str(tmp_path / "catalog.json")).first()
    assert entry["slug"] == "cme_co" and entry["link_rule"]["min_depth"] == 2


def test_packed_files(spark, tmp_path):
    """Many keys share few files; texts, labels and missing parts come back as written."""
    texts = {"a": "x\n", "b": None, "c": 'q"\n\n\t', "d": "é\r\n"}
    rows = [(k, v, (k, "eligible"), (k,) if k == "a" else None) for k, v in texts.items()]
    rows += [(f"k{i}", str(i), (f"k{i}", "unknown"), None) for i in range(300)]
    held = spark.createDataFrame(rows, "case_id string, content string, decision struct<case_id:string,decision:string>, evidence struct<case_id:string>")
    sinks.write_cases(held, str(tmp_path / "cases"))
    assert len(list((tmp_path / "cases").rglob("part-*"))) < 60
    read = tables.evaluation_cases(spark, str(tmp_path / "cases"), stored=True).collect()
    assert {r["case_id"]: (r["content"], r["decision"]["decision"], r["evidence"] and r["evidence"]["case_id"]) for r in read} == {
        k: (v or "", d[1], e and e[0]) for k, v, d, e in rows}
    assert len(read) == len(rows)
    boards = spark.createDataFrame([(k, "Acme", "https://b") for k in ("s1", "s2", None, "a/b")], "slug string, company_name string, job_board_url string")
    sinks.write_keyed(boards, "slug", str(tmp_path / "boards"), "metadata.json")
    found = tables.snapshot_pages(tables.board_snapshots(spark, str(tmp_path / "boards"), stored=True)).collect()
    assert {tuple(r) for r in found} == {(k, "page.html", "https://b") for k in ("s1", "s2", "__HIVE_DEFAULT_PARTITION__", "a/b")}


def test_observe_follows_merges(spark):
    t0, t1 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
    empty = (spark.createDataFrame([], JOBS), spark.createDataFrame([], JOB_SOURCES))
    first = spark.createDataFrame([("c", "https://b.io/1"), ("c", "https://b.io/2"), ("c", "bad")], "company_slug string, url string")
    jobs, sources = history.observe(*empty, first, t0)
    jobs = history.apply_merges(jobs, spark.createDataFrame([(2, 1)], "job_id long, canonical_id long"), t0)
    again = spark.createDataFrame([("c", "https://b.io/2?utm_a=1")], "company_slug string, url string")
    jobs, sources = history.observe(jobs, sources, again, t1)
    seen = {r["id"]: str(r["last_seen_at"]) for r in jobs.collect()}
    assert seen == {1: t1, 2: t0}
    assert {(r["job_id"], r["url"]) for r in sources.collect()} == {(1, "https://b.io/1"), (2, "https://b.io/2"), (1, "https://b.io/2?utm_a=1")}
    moved = identity.moved_sources(sources, identity.merge_roots(jobs)).collect()
    assert {(r["job_id"], r["url"]) for r in moved} == {(1, "https://b.io/1"), (1, "https://b.io/2"), (1, "https://b.io/2?utm_a=1")}


def test_pairs_must_split(spark):
    wanted = spark.createDataFrame([("c", "E1", "either", True, ["remote"]), ("c", "E2", "either", True, ["on site"])], "case_id string, obligation_id string, role string, critical boolean, alternatives array<string>")
    cited = spark.createDataFrame([("c", 1, "supporting", "Remote work"), ("c", 1, "conflicting", "on-site only"), ("c", 2, "supporting", "remote, on site")], "case_id string, replay int, bucket string, excerpt string")
    pairs = spark.createDataFrame([("c", "E1", "E2")], "case_id string, left_id string, right_id string")
    met, split = phrases.obligation_results(wanted, cited, pairs)
    assert met.count() == 4
    assert {r["replay"]: r["pairs_satisfied"] for r in split.collect()} == {1: True, 2: False}


def test_metrics_of_nothing(spark):
    empty = spark.createDataFrame([], "expected_decision string, decision string, status string")
    assert scoring.macro_f1(empty).first()["macro_f1"] == 1.0


def test_sql_functions(spark):
    from vacantia.functions.registry import register_sql_functions

    register_sql_functions(spark)
    spark.createDataFrame([(1, "<title>T</title><a href='/x'>x</a><a hidden href='/y'>y</a>")], "page_id long, html string").createOrReplaceTempView("stored")
    rows = spark.sql("SELECT page_id, a.* FROM stored, LATERAL html_anchors(html) a ORDER BY ord").collect()
    assert [(r["href"], r["hidden"]) for r in rows] == [("/x", False), ("/y", True)]
    assert spark.sql("SELECT m.title FROM stored, LATERAL html_main_text(html) m").first()[0] == "T"
    assert spark.sql("SELECT nfkc_fold('ÀSS')").first()[0] == "àss"


def test_min_depth(spark):
    counts = F.create_map(F.lit(1), F.lit(5), F.lit(2), F.lit(9), F.lit(3), F.lit(1))
    got = spark.range(1).select(links.suggested_min_depth(F.lit(3), counts), links.suggested_min_depth(F.lit(1), counts), links.suggested_min_depth(F.lit(0), counts)).first()
    assert tuple(got) == (3, None, None)


def test_failed_fields_of_stored_results(spark):
    from vacantia.operators import reports

    jobs = spark.createDataFrame([(1, "c")], "id long, company_slug string")
    held = [(1, True, '{"title": {"state": "failed", "value": null, "evidence": []}, "summary": {"state": "extracted", "value": "x", "evidence": ["x"]}}'), (1, False, '{"summary": {"state": "failed"}}')]
    results = spark.createDataFrame(held, "job_id long, is_current boolean, result_json string")
    assert [tuple(r) for r in reports.results_with_failed_fields(jobs, results).collect()] == [(1, "c", "$.title.state")]


def test_talentbrew_boards_that_fail(spark):
    from vacantia.sources import payloads

    link = '<a href=\\"/jobs/%d\\">x</a>'

    def page(board, number, results, flag):
        return (board, number, "https://b.io/list", "https://b.io", "", 1, 2, '{"results": %s, "hasJobs": %s}' % (results, flag))

    two = '"%s%s"' % (link % 1, link % 2)
    rows = [page("good", 1, two, "true"), page("good", 2, '"%s"' % (link % 3), "true"), page("good", 3, "7", '"no"'),
            page("typed", 1, two, '"true"'), page("list", 1, "[]", "true"), page("late", 1, two, "true"), page("late", 2, two, "1"),
            page("bare", 1, '"nothing"', "true"), page("empty", 1, '""', "false")]
    rows += [page("long", n, '"%s%s"' % (link % (2 * n), link % (2 * n + 1)), "true") for n in range(1, 31)]
    table = spark.createDataFrame(
        rows, "board string, page int, url string, origin string, base_path string, min_depth int, records_per_page int, payload string")
    found = {}
    for r in payloads.talentbrew(table).collect():
        found.setdefault(r.board, set()).add(r.url)
    assert found["good"] == {f"https://b.io/jobs/{n}" for n in (1, 2, 3)} and len(found["long"]) == 60 and len(found) == 2
    wrong = {(r.board, r.page): r.problem for r in payloads.talentbrew_problems(table).collect()}
    assert wrong == {("typed", 1): "has_jobs_type", ("list", 1): "results_type", ("late", 2): "has_jobs_type", ("bare", 1): "no_anchors"}
