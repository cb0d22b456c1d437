"""Parsers on valid HTML with left-out tags, unclosed sections and odd JSON."""

from vacantia.functions import markup


def tree(html):
    rows = markup._Tree().read(html).rows()
    return [(n["tag"], rows["text"][n["start"] : n["start"] + n["chars"]], n["hidden"]) for n in rows["nodes"]]


def test_left_out_end_tags():
    assert tree('<ul><li style="display:none">a<li>b<ul><li>c</ul></ul>') == [
        ("ul", "abc", False), ("li", "a", True), ("li", "bc", False), ("ul", "c", False), ("li", "c", False)]
    assert tree("<select><option>A<option>B<optgroup><option>C</select>d")[1:3] == [("option", "A", False), ("option", "B", False)]
    assert tree("<table><tr><td>1<td>2<tr><td>3</table>") == [
        ("table", "123", False), ("tr", "12", False), ("td", "1", False), ("td", "2", False), ("tr", "3", False), ("td", "3", False)]
    assert tree("<dl><dt>a<dd>b<dt>c</dl>")[1:] == [("dt", "a", False), ("dd", "b", False), ("dt", "c", False)]
    assert tree("<p>a<div>b</div>") == [("p", "a", False), ("div", "b", False)]
    assert tree("<table><tr><td>1<table><tr><td>2</table>x<td>3</table>")[-1] == ("td", "3", False)


def main(html):
    return " ".join(markup._content(html)["main"].split())


def test_sections_that_do_not_end():
    assert main("<html><head><title>t</title><meta><body><p>shown</html>") == "shown"
    assert main("<head><title>t</title><p>shown") == "shown"
    assert main("<div><nav>menu</div><p>shown</p>") == "shown"
    assert main("<nav>menu<p>all there is") == "menuall there is"
    assert main("<nav>menu</nav><p>shown</p><footer>foot") == "shown"
    assert main("<script>x = 1</script>") == ""


def test_body_after_a_section_without_end():
    assert main("<h1>Title</h1><nav><ul><li>menu</ul><div>body</div>") == "Title body"
    assert main("<html><body><h1>Title</h1><nav>menu<div>body</div></body></html>") == "Title body"
    assert main("<header><p>head</header><p>one<aside>x<p>two") == "head one two"
    # An end tag bounds a section, and what it holds stays out.
    assert main("<p>a<nav><div>x</div></nav>b<noscript><p>q</p></noscript>c") == "a b c"
    assert main("<h1>T</h1><nav><aside>x</aside><p>kept<footer><p>gone</footer>") == "T kept"
    assert main("<h1>T</h1><svg><p>never") == "T"
    assert "•" not in markup._content("<p>a<nav><ul><li>x</ul></nav><p>b")["main"]


def test_ranges():
    html = "<div> a <p> b <i>c</i>  </p> <br> d </div><a> e <b>f</b></a><p>  </p>"
    rows = markup._Tree().read(html).rows()
    held = [(n["tag"], rows["text"][n["start"] : n["start"] + n["chars"]], n["end"], n["text"]) for n in rows["nodes"]]
    assert held == [
        ("div", "a  b c    d", 3, None), ("p", "b c", 2, None), ("i", "c", 2, "c"), ("br", "", 3, ""),
        ("a", "e f", 5, "e f"), ("b", "f", 5, "f"), ("p", "", 6, "")]
    assert [n["parent"] for n in rows["nodes"]] == [None, 0, 1, 0, None, 4, None]


def test_large_and_deep_pages_take_linear_time():
    """Output and steps per element are bounded, so twice the page takes about twice the time."""
    from time import process_time

    def took(read, html):
        times = []
        for _ in range(3):
            begun = process_time()
            read(html)
            times.append(process_time() - begun)
        return min(times)

    for part in ("<p>abc<b>x</b>", "<div>x", "<nav><p>x", "<p><button><div>", "<li><ul>x", "<p>a<aside>b"):
        for read in (lambda h: markup._content(h), lambda h: markup._Tree().read(h).rows()):
            assert took(read, part * 20_000) < 8 * took(read, part * 5_000) + 0.2, part
    deep = markup._Tree().read("<div>x" * 5_000).rows()
    assert sum(len(n["text"] or "") for n in deep["nodes"]) <= 2 * len(deep["text"])


def test_odd_json():
    block = '<script type="application/ld+json">%s</script>'
    job = '{"@type": "JobPosting", "title": "%s", "x": %s}'
    pages = [job % ("a", "NaN"), job % ("b\\ud800", 1), job % ("c", "[" * 100_000 + "]" * 100_000), "{", job % ("d", 2)]
    found = [markup._content(block % p)["postings"] for p in pages]
    assert [len(f) for f in found] == [0, 1, 0, 0, 1]
    for f in found:
        for p in f:
            (p["raw"] + p["fields"] + p["description"]).encode("utf-8")
    both = markup._content(block % pages[0] + block % pages[4])["postings"]
    assert len(both) == 1


def test_page_content_in_parts():
    import pyarrow as pa

    posting = '<script type="application/ld+json">{"@type": "JobPosting", "title": "T", "description": "d"}</script>'
    pages = [posting, None, "<p>" + "x" * 700_000, "<title>t</title><p>" + "y " * 400_000, "<p>z"]
    # a batch of pages is read in parts of bounded size, never whole
    parts = [p.to_pylist() for p in markup._page_content.func(iter([pa.array(pages)]))]
    assert [len(p) for p in parts] == [3, 2]
    assert [p["main"].strip()[:1] for part in parts for p in part] == ["", "", "x", "y", "z"]
    assert [len(p["postings"]) for part in parts for p in part] == [1, 0, 0, 0, 0] and parts[1][0]["title"] == "t"
