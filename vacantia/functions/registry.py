"""Names of the batch functions for SQL users."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from vacantia.functions import text

# Plain names, so that a table function carries only the readers it uses.
from vacantia.functions.markup import _content, _Tree


@F.udtf(returnType="ord int, href string, hidden boolean")
class HtmlAnchors:
    """``SELECT p.page_id, a.* FROM pages p, LATERAL html_anchors(p.html) a``"""

    def eval(self, html: str) -> Iterator[tuple]:
        tree = _Tree()
        tree.feed(html or "")
        tree.close()
        links = [n for n in tree.nodes if n["tag"] == "a" and "href" in n["attrs"]]
        for place, node in enumerate(links):
            yield place, node["attrs"]["href"], node["hidden"]


@F.udtf(returnType="ord int, raw string, description string")
class JsonldBlocks:
    """Structured posting objects of a page."""

    def eval(self, html: str) -> Iterator[tuple]:
        for place, found in enumerate(_content(html or "")["postings"]):
            yield place, found["raw"], found["description"]


@F.udtf(returnType="main_text string, title string")
class HtmlMainText:
    """Main text and title of a page, before white space is tidied."""

    def eval(self, html: str) -> Iterator[tuple]:
        found = _content(html or "")
        yield found["main"], found["title"]


def register_sql_functions(spark: SparkSession) -> None:
    """Make nfkc, nfkc_fold, word_spans, html_anchors, html_main_text, jsonld_blocks
    available to ``spark.sql``."""
    for name, function in (
        ("nfkc", text.nfkc),
        ("nfkc_fold", text.nfkc_fold),
        ("word_spans", text.word_spans),
    ):
        spark.udf.register(name, function)
    for name, table in (
        ("html_anchors", HtmlAnchors),
        ("html_main_text", HtmlMainText),
        ("jsonld_blocks", JsonldBlocks),
    ):
        spark.udtf.register(name, table)
