"""HTML readers: one small parser per Arrow batch, everything after it in Catalyst.

``page_tree`` gives the elements of a page as an array column beside the page's text,
``page_anchors`` its anchors, ``page_content`` main text, title and structured posting
objects in one pass. All work on stored HTML: scripts and external style sheets are not
run. Time and output grow with the size of a page, however deep its elements nest; only an
anchor's trail has an entry per ancestor.
"""

from __future__ import annotations

import json
import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacantia.functions.text import col, fixed_strings, in_parts, tidy

NODE = T.StructType(
    [
        T.StructField("position", T.IntegerType()),
        T.StructField("parent", T.IntegerType()),
        # Position of the last element inside, its own if there is none: the elements below
        # a node are those after it up to here.
        T.StructField("end", T.IntegerType()),
        T.StructField("tag", T.StringType()),
        T.StructField("attrs", T.MapType(T.StringType(), T.StringType())),
        # Text of leaves and of outermost anchors, buttons and options; see node_text.
        T.StructField("text", T.StringType()),
        # Place of the trimmed text in the text of the page.
        T.StructField("start", T.IntegerType()),
        T.StructField("chars", T.IntegerType()),
        T.StructField("children", T.IntegerType()),
        T.StructField("hidden", T.BooleanType()),
        # Position of the innermost label around this element.
        T.StructField("label", T.IntegerType()),
        # Checkboxes from the page's begin up to this element.
        T.StructField("boxes", T.IntegerType()),
    ]
)
TREE = T.StructType([T.StructField("text", T.StringType()), T.StructField("nodes", T.ArrayType(NODE))])
ANCHOR = T.StructType(
    [
        T.StructField("href", T.StringType()),
        T.StructField("hidden", T.BooleanType()),
        # One token list per element, the anchor first, then its ancestors:
        # tag, #id, .class, [attr] and [attr=value].
        T.StructField("trail", T.ArrayType(T.ArrayType(T.StringType()))),
    ]
)
CONTENT = T.StructType(
    [
        T.StructField("main", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField(
            "postings",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("raw", T.StringType()),
                        T.StructField("fields", T.StringType()),
                        T.StructField("description", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)
_CONTENT_ROWS = pa.struct(
    {"main": pa.string(), "title": pa.string(), "postings": pa.list_(pa.struct({name: pa.string() for name in ("raw", "fields", "description")}))}
)
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_DROPPED = frozenset("script style noscript template nav footer aside head svg".split())
# Never text of a page, not even where nothing else is left.
_UNREAD = frozenset("script style template svg".split())
_HEAD = frozenset("html head title base link meta style script noscript template".split())
_BLOCK = frozenset(
    "address article blockquote body br dd div dl dt fieldset figcaption figure form h1 h2 "
    "h3 h4 h5 h6 header hr html li main ol p pre section table tbody td tfoot th thead tr ul".split()
)
# Fixed values of HTML: a start tag ends these open elements, up to a container that holds them apart.
_CELLS = frozenset(("td", "th"))
_ROWS = _CELLS | {"tr"}
_SECTIONS = _ROWS | {"thead", "tbody", "tfoot"}
_ENDS = {
    "li": (frozenset(("li",)), frozenset(("ul", "ol", "menu"))),
    "option": (frozenset(("option",)), frozenset(("select", "datalist"))),
    "optgroup": (frozenset(("option", "optgroup")), frozenset(("select",))),
    "dt": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "dd": (frozenset(("dt", "dd")), frozenset(("dl",))),
    "td": (_CELLS, frozenset(("table", "tr"))),
    "th": (_CELLS, frozenset(("table", "tr"))),
    "tr": (_ROWS, frozenset(("table", "thead", "tbody", "tfoot"))),
    "thead": (_SECTIONS, frozenset(("table",))),
    "tbody": (_SECTIONS, frozenset(("table",))),
    "tfoot": (_SECTIONS, frozenset(("table",))),
}
# A block ends an open paragraph, unless one of these stands between.
_APART = frozenset("button td th caption object html body table noscript template svg".split())
_PARAGRAPH = frozenset(("p",))
_ENDS_PARAGRAPH = (_BLOCK | {"nav", "footer", "aside"}) - _ENDS.keys()
_LISTS = frozenset("ul ol menu dl".split())
_LISTED = _LISTS | {"li", "dt", "dd"}
# Elements whose text is given with them, if none of them is around.
_TEXTUAL = frozenset("a button option".split())
_INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_INK = re.compile(r"\S+")


class _Stack:
    """Open elements, with the depths at which each tag is open: nothing is searched for."""

    def __init__(self) -> None:
        self.tags: list[str] = []
        self.at: dict[str, list[int]] = {}

    def push(self, tag: str) -> None:
        self.at.setdefault(tag, []).append(len(self.tags))
        self.tags.append(tag)

    def cut(self, depth: int) -> None:
        while len(self.tags) > depth:
            self.at[self.tags.pop()].pop()

    def last(self, tags) -> int:
        """Depth of the innermost open element with one of the tags, -1 if there is none."""
        found = -1
        for tag in tags:
            depths = self.at.get(tag)
            if depths and depths[-1] > found:
                found = depths[-1]
        return found

    def implied(self, tag: str) -> int:
        """How many of the open elements stay open when *tag* starts."""
        stay = len(self.tags)
        if tag in _ENDS_PARAGRAPH:
            ends, until = _PARAGRAPH, _APART
        elif tag in _ENDS:
            ends, until = _ENDS[tag]
        else:
            return stay
        holder = None
        for end in ends:
            if depths := self.at.get(end):
                holder = self.last(until) if holder is None else holder
                inside = bisect_right(depths, holder)
                if inside < len(depths):
                    stay = min(stay, depths[inside])
        return stay


class _Tree(HTMLParser):
    """Elements in document order with the range of their text and of the elements inside."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[dict] = []
        self.open: list[dict] = []
        self.stack = _Stack()
        self.pieces: list[str] = []
        self.length = 0
        self.boxes = 0

    def handle_starttag(self, tag, attrs):
        kept: dict[str, str] = {}
        for name, value in attrs:
            if name == "href" and value is None:
                continue
            kept.setdefault(name, value or "")
        self._close(self.stack.implied(tag))
        parent = self.open[-1] if self.open else None
        kind = kept.get("type", "").lower()
        labelled = self.stack.last(("label",))
        self.boxes += tag == "input" and kind == "checkbox"
        node = {
            "position": len(self.nodes),
            "parent": parent["position"] if parent else None,
            "end": len(self.nodes),
            "tag": tag,
            "attrs": kept,
            "text": None,
            "start": self.length,
            "chars": 0,
            "children": 0,
            "hidden": bool(parent and parent["hidden"])
            or "hidden" in kept
            or kind == "hidden"
            or bool(_INVISIBLE.search(kept.get("style", ""))),
            "label": self.open[labelled]["position"] if labelled >= 0 else None,
            "boxes": self.boxes,
            "told": tag in _TEXTUAL and self.stack.last(_TEXTUAL) < 0,
        }
        if parent:
            parent["children"] += 1
        self.nodes.append(node)
        if tag not in _VOID:
            self.open.append(node)
            self.stack.push(tag)

    def handle_endtag(self, tag):
        depth = self.stack.last((tag,))
        if depth >= 0:
            self._close(depth)

    def _close(self, depth):
        for node in self.open[depth:]:
            node["end"] = len(self.nodes) - 1
            node["chars"] = self.length - node["start"]
        del self.open[depth:]
        self.stack.cut(depth)

    def handle_data(self, data):
        self.pieces.append(data)
        self.length += len(data)

    def read(self, html: str) -> _Tree:
        self.feed(html)
        self.close()
        self._close(0)
        return self

    def rows(self) -> dict:
        """The page's text and its elements, with trimmed ranges."""
        page = "".join(self.pieces)
        runs = [found.span() for found in _INK.finditer(page)]
        first, last = [run[0] for run in runs], [run[1] for run in runs]
        for node in self.nodes:
            start, stop = node["start"], node["start"] + node["chars"]
            # White space ends with the first run that reaches into the range, and begins again after the last.
            after, before = bisect_right(last, start), bisect_left(first, stop) - 1
            if after <= before:
                start, stop = max(start, first[after]), min(stop, last[before])
            else:
                stop = start
            node["start"], node["chars"] = start, stop - start
            if node["told"] or not node["children"]:
                node["text"] = page[start:stop]
        return {"text": page, "nodes": self.nodes}

    def anchors(self) -> list[dict]:
        """Anchors with the tokens of their ancestors."""
        tokens: dict[int, list[str]] = {}

        def own(node: dict) -> list[str]:
            known = tokens.get(node["position"])
            if known is None:
                attrs = node["attrs"]
                known = [node["tag"]]
                if attrs.get("id"):
                    known.append("#" + attrs["id"])
                known += ["." + part for part in attrs.get("class", "").split()]
                for name, value in attrs.items():
                    known += [f"[{name}]", f"[{name}={value}]"]
                tokens[node["position"]] = known
            return known

        found = []
        for node in self.nodes:
            if node["tag"] == "a":
                trail, above = [own(node)], node["parent"]
                while above is not None:
                    trail.append(own(self.nodes[above]))
                    above = self.nodes[above]["parent"]
                found.append({"href": node["attrs"].get("href"), "hidden": node["hidden"], "trail": trail})
        return found


class _Reader(HTMLParser):
    """Main text with bullets and block breaks, page title and JSON-LD blocks.

    Navigation and other dropped sections are left out up to their end tag. Where that is
    missing, a section ends at its first block outside a list, so that it takes no more of
    the page with it; if nothing stands outside such sections, all text is given.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = []
        # The innermost dropped section of each piece, -1 outside.
        self.owners: list[int] = []
        self.titles: list[str] = []
        self.blocks: list[str] = []
        self.everything: list[str] = []
        self.stack = _Stack()
        # Of each dropped section: the one around it, and the piece from which it counts as text.
        self.around: list[int] = []
        self.shown_from: list[float] = []
        # Open dropped sections as (depth, number), and those of them still without an end.
        self.dropped: list[tuple[int, int]] = []
        self.endless: list[tuple[int, int]] = []
        self.unread = 0
        self.in_title = False
        self.block: list[str] | None = None

    def handle_starttag(self, tag, attrs):
        if tag not in _HEAD and self.stack.at.get("head"):
            self._close(self.stack.at["head"][0], True)  # its end tag may be left out
        self._close(self.stack.implied(tag))
        if tag == "title":
            self.in_title = True
        if tag == "script":
            kind = (dict(attrs).get("type") or "").split(";", 1)[0].strip().casefold()
            if kind == "application/ld+json":
                self.block = []
        if tag in _DROPPED:
            place = (len(self.stack.tags), len(self.around))
            self.around.append(self.dropped[-1][1] if self.dropped else -1)
            self.shown_from.append(float("inf"))
            self.dropped.append(place)
            if tag in _UNREAD:
                self.unread += 1
            else:
                self.endless.append(place)
        elif tag in _BLOCK:
            if tag not in _LISTED and self.endless:
                listed = self.stack.last(_LISTS)
                while self.endless and self.endless[-1][0] > listed:
                    self.shown_from[self.endless.pop()[1]] = len(self.pieces)
            self._add("\n• " if tag == "li" else "\n")
        if tag not in _VOID:
            self.stack.push(tag)

    def handle_endtag(self, tag):
        if tag == "title":
            self.in_title = False
        if tag == "script" and self.block is not None:
            self.blocks.append("".join(self.block))
            self.block = None
        depth = self.stack.last((tag,))
        if depth >= 0:
            # Whatever is still open inside ends too, dropped sections among it.
            self._close(depth, True)
        if tag in _BLOCK and tag not in _DROPPED:
            self._add("\n")

    def _close(self, depth, by_end_tag=False):
        while self.endless and self.endless[-1][0] >= depth:
            self.endless.pop()
        while self.dropped and self.dropped[-1][0] >= depth:
            at, number = self.dropped.pop()
            self.unread -= self.stack.tags[at] in _UNREAD
            if at == depth and by_end_tag:
                self.shown_from[number] = float("inf")
        self.stack.cut(depth)

    def _add(self, piece):
        self.pieces.append(piece)
        self.owners.append(self.dropped[-1][1] if self.dropped else -1)

    def handle_data(self, data):
        if self.in_title:
            self.titles.append(data)
        if self.block is not None:
            self.block.append(data)
        if not self.in_title and not self.unread:
            data = " ".join(data.split("\n"))
            self.everything.append(data)
            self._add(data)

    def text(self) -> str:
        outside = "".join(piece for piece, owner in zip(self.pieces, self.owners) if owner < 0)
        if not outside.replace("•", "").strip():
            return "".join(self.everything)
        shown_from: list[float] = []
        for around, own in zip(self.around, self.shown_from):
            shown_from.append(max(own, shown_from[around]) if around >= 0 else own)
        return "".join(
            piece if owner < 0 or place >= shown_from[owner] else "\n" if piece[:1] == "\n" else ""
            for place, (piece, owner) in enumerate(zip(self.pieces, self.owners))
        )


def _read(html: str) -> _Reader:
    reader = _Reader()
    reader.feed(html)
    reader.close()
    return reader


def _sound(text: str) -> str:
    """The text with lone surrogates replaced: they have no UTF-8 form."""
    return text.encode("utf-8", "replace").decode() if any("\ud800" <= c <= "\udfff" for c in text) else text


def _nfkc(value):
    if isinstance(value, str):
        return _sound(unicodedata.normalize("NFKC", value))
    if isinstance(value, list):
        return [_nfkc(item) for item in value]
    if isinstance(value, dict):
        return {_sound(key): _nfkc(item) for key, item in value.items()}
    return value


def _refused(name: str):
    raise ValueError(f"{name} is not JSON")


def _posting_objects(value):
    """Posting objects inside lists and graphs, outer ones first."""
    waiting = [value]
    while waiting:
        item = waiting.pop(0)
        if isinstance(item, list):
            waiting[:0] = item
        elif isinstance(item, dict):
            kinds = item.get("@type")
            kinds = kinds if isinstance(kinds, list) else [kinds]
            if any(isinstance(k, str) and k.casefold() == "jobposting" for k in kinds):
                yield item
            if isinstance(item.get("@graph"), (dict, list)):
                waiting.insert(0, item["@graph"])


def _postings(blocks: list[str]) -> list[dict]:
    found = []
    for block in blocks:
        try:
            # NaN and infinities are no JSON; a block nested too deep to read counts as broken.
            payload = json.loads(block, parse_constant=_refused)
            items = [(item, _nfkc({k: v for k, v in item.items() if k != "description"})) for item in _posting_objects(payload)]
        except (ValueError, RecursionError):
            continue
        for item, fields in items:
            description = item.get("description")
            shown = (
                _read(description).text() if isinstance(description, str) else ""
            )
            found.append(
                {
                    "raw": _sound(json.dumps(item, ensure_ascii=False)),
                    "fields": json.dumps(fields, ensure_ascii=False),
                    "description": _sound(unicodedata.normalize("NFKC", shown)),
                }
            )
    return found


def _content(html: str) -> dict:
    reader = _read(html)
    return {
        "main": _sound(unicodedata.normalize("NFKC", reader.text())),
        "title": _sound(unicodedata.normalize("NFKC", " ".join(reader.titles))),
        "postings": _postings(reader.blocks),
    }


@F.arrow_udf(CONTENT)
def _page_content(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        for pages in in_parts(batch):
            yield pa.array([_content(html or "") for html in pages], _CONTENT_ROWS)


def page_content(html: Column | str) -> Column:
    """``struct<main, title, postings>`` in NFKC form, white space not yet tidied."""
    return _page_content(col(html))


@F.pandas_udf(TREE)
def _page_tree(pages: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_Tree().read(page or "").rows() for page in pages], columns=["text", "nodes"])


def page_tree(html: Column | str) -> Column:
    """``struct<text, nodes>``: the page's text and its elements in document order."""
    return _page_tree(col(html))


def node_text(tree: Column, node: Column, chars: int | None = None) -> Column:
    """Trimmed text of an element with all that is inside it; its first *chars* characters, if given."""
    size = node["chars"] if chars is None else F.least(node["chars"], F.lit(chars))
    held = F.substring(tree["text"], node["start"] + 1, size)
    return F.coalesce(node["text"] if chars is None else F.substring(node["text"], 1, chars), held)


@F.pandas_udf(T.ArrayType(ANCHOR))
def _page_links(pages: pd.Series) -> pd.Series:
    return pd.Series([_Tree().read(page or "").anchors() for page in pages], dtype=object)


def tidy_or_null(text: Column) -> Column:
    return F.nullif(tidy(text), F.lit(""))


def in_trail(trail: Column, selector: str) -> Column:
    """Whether the node or an ancestor matches a selector list of compound selectors.

    Supported parts: tag, ``#id``, ``.class``, ``[attr]`` and ``[attr=value]`` (also
    quoted), joined without combinators; lists are separated by commas.
    """
    piece = re.compile(r"#[\w-]+|\.[\w-]+|\[[\w-]+(?:=(?:\"[^\"]*\"|'[^']*'|[^\]]*))?\]|[A-Za-z][\w-]*")
    hit = F.lit(False)
    for part in selector.split(","):
        part = part.strip()
        tokens = piece.findall(part)
        if not tokens or "".join(tokens) != part:
            raise ValueError(f"unsupported selector: {selector!r}")
        tokens = [re.sub(r"=(\"|')(.*)\1\]$", r"=\2]", t) if t[0] == "[" else t for t in tokens]
        tokens = [t if t[0] in "#.[" else t.lower() for t in tokens]
        wanted = fixed_strings(tokens)
        hit = hit | F.exists(trail, _holds_all(wanted))
    return hit


def _holds_all(wanted: Column):
    return lambda element: F.size(F.array_except(wanted, element)) == 0


def page_anchors(pages, key: str = "page_id", url: str = "url", html: str = "html"):
    """One row per anchor with an href: key, ord, href, hidden, trail and page URL."""
    # The outer form keeps the parse from being repeated in a size filter.
    nodes = pages.select(key, url, _page_links(col(html)).alias("_nodes"))
    return (
        nodes.select(key, url, F.posexplode_outer("_nodes").alias("ord", "_n"))
        .select(key, url, "ord", "_n.href", "_n.hidden", "_n.trail")
        .filter(F.col("href").isNotNull())
    )


def page_anchors_by_pattern(pages, key: str = "page_id", url: str = "url", html: str = "html"):
    """Anchor hrefs found by pattern inside the JVM, for pages with plain markup.

    Cheaper than :func:`page_anchors`; it knows no ancestors or visibility and does not
    skip anchors inside comments.
    """
    hrefs = F.regexp_extract_all(
        F.col(html), F.lit(r"(?i)<a(?:\s[^>]*?)?\shref\s*=\s*[\"']([^\"']*)[\"']"), F.lit(1)
    )
    return pages.select(key, url, F.posexplode(hrefs).alias("ord", "href")).withColumn(
        "href", F.replace(F.col("href"), F.lit("&amp;"), F.lit("&"))
    )
