"""Text, URL and region rules on literal rows, compared with plain Python where it has them."""

import ipaddress
import re
import unicodedata
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from vacantia.functions import regions, urls
from vacantia.functions import text as tx


def one(spark, expr, **values):
    frame = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return frame.select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "raw,key",
    [
        ("HTTPS://Example.COM:443/jobs/x/?b=hello%20world&a=2&a=1&utm_x=z#part", "https://example.com/jobs/x?a=1&a=2&b=hello+world"),
        ("https://example.com/jobs/x?a=1&b=hello+world&a=2", "https://example.com/jobs/x?a=1&a=2&b=hello+world"),
        ("http://EXAMPLE.com:8080/", "http://example.com:8080/"),
        ("http://user:pw@h.io/a", "http://h.io/a"),
        ("https://h.io", "https://h.io"),
        ("https://h.io/x//", "https://h.io/x/"),
        ("https://h.io/a b|c", "https://h.io/a b|c"),
        ("https://h.io/?q=%zz&e=&t=~*", "https://h.io/?e=&q=%25zz&t=~%2A"),
        ("https://[2001:DB8::1]:443/p", "https://[2001:db8::1]/p"),
        ("https://h.io/p?lang=en&source=x&id=7", "https://h.io/p?id=7"),
        ("/jobs/1", None),
        ("ftp://example.com/jobs/1", None),
        ("https://x:bad/", None),
        ("https://x:70000/", None),
        ("https:///p", None),
    ],
)
def test_url_key(spark, raw, key):
    assert one(spark, urls.url_key("u"), u=raw) == key


def test_prefix_and_depth(spark):
    u = "https://a.io/company/careers/eng/1234-senior"
    assert one(spark, urls.path_prefix("u"), u=u) == "/company/careers/eng"
    assert one(spark, urls.path_prefix("u"), u="https://a.io/careers/requirements/271/") == "/careers/requirements"
    assert one(spark, urls.path_prefix("u"), u="https://a.io/x") == "/"
    assert one(spark, urls.prefix_ancestry("u"), u=u) == ["/company/careers/eng", "/company/careers", "/company", "/"]
    assert one(spark, urls.tail_depth("u", F.lit("/company/careers")), u=u) == 2
    assert one(spark, urls.tail_depth("u", F.lit("/other")), u=u) == 0
    assert one(spark, urls.tail_depth("u", F.lit("/")), u=u) == 4


@pytest.mark.parametrize("host,domain", [("careers.acme.com", "acme.com"), ("x.acme.co.cr", "acme.co.cr"), ("a.b.io", "b.io"), ("h", "h")])
def test_registrable_domain(spark, host, domain):
    assert one(spark, urls.registrable_domain("h"), h=host) == domain


def test_redirects(spark):
    def verdict(a, b, board="https://acme.com/jobs"):
        return one(spark, urls.redirect_verdict(F.lit(a), F.lit(b), F.lit(board)))

    assert verdict("https://careers.acme.com/1", "https://www.acme.com/2") == "allowed"
    assert verdict("https://careers.acme.com/1", "https://x.lever.co/2") == "allowed"
    assert verdict("https://careers.acme.com/1", "https://evil.org/2") == "off_site_redirect"
    assert verdict("https://careers.acme.com/1", "https://acme.com/jobs/") == "closed"


@pytest.mark.parametrize("address", ["10.1.2.3", "8.8.8.8", "127.0.0.1", "172.31.0.1", "172.32.0.1", "192.168.1.1", "169.254.3.3", "100.64.0.1", "224.0.0.1", "203.0.113.9", "1.1.1.1", "198.19.0.1", "192.0.0.9", "0.0.0.0"])
def test_network_targets(spark, address):
    value = ipaddress.ip_address(address)
    wanted = not value.is_global or value.is_multicast
    assert one(spark, urls.off_public_network(F.lit(f"https://{address}:8443/x"))) == wanted


def test_network_names(spark):
    assert one(spark, urls.off_public_network(F.lit("https://localhost/x"))) is False
    assert one(spark, urls.off_public_network(F.lit("https://[::1]/x"))) is True


@pytest.mark.parametrize("base", ["https://a.com/x/y?w#f", "https://a.com", "https://a.com/x/"])
@pytest.mark.parametrize("ref", ["../z?q", "k", "//b.com/q", "./j/../k/.", "#f", "/p/../q", "https://c.io/z", "mailto:x@y.z", "?a=1"])
def test_resolve(spark, base, ref):
    assert one(spark, urls.resolve_url(F.lit(base), F.lit(ref))) == urljoin(base, ref)


def test_redaction(spark):
    message = 'see https://u:p@Host.com/x?y=1 "http://bad\\host" api_key=zz\nnext'
    assert one(spark, urls.redact_message("m"), m=message) == 'see https://host.com/x "<unparseable-url>" <redacted>'
    assert one(spark, urls.redact_message("m", 5), m="abc  defg") == "abc d"
    assert one(spark, urls.sanitized_url("u"), u="https://h/p?Token=a&b=c d#x") == "https://h/p?Token=REDACTED&b=c+d"


@pytest.mark.parametrize("body,status,outcome", [("", 404, "not_found"), ("", 429, "blocked"), ("Just a CAPTCHA", 503, "blocked"), ("", 503, "server_error"), ("", 200, None)])
def test_http_outcome(spark, body, status, outcome):
    assert one(spark, urls.http_outcome(F.lit(status), F.lit(body))) == outcome


TEXTS = [
    "Plain ASCII text, with words_and 12 numbers.",
    "Straße ÀB x été ﬁne ½ Ké Ⅷ İstanbul",
    "日本語テキスト ｆｕｌｌ ａ１ ́x under_score",
    "  lines\r\n\r\n\r\n\r\nwith\t tabs   and \x1c breaks\r end ",
    "",
    "xͅy ᾳ",
]
WORD = re.compile(r"[^\W_]+(?:[̀-ͯ]+[^\W_]*)*")


@pytest.mark.parametrize("text", TEXTS)
def test_text_forms(spark, text):
    nfkc = unicodedata.normalize("NFKC", text)
    rows = re.sub(r"\n{3,}", "\n\n", "\n".join(re.sub(r"[^\S\n]+", " ", line).strip() for line in nfkc.replace("\r\n", "\n").replace("\r", "\n").split("\n"))).strip()
    assert one(spark, tx.normalize("t"), t=text) == rows
    assert one(spark, tx.grounding_text("t"), t=text) == " ".join(nfkc.casefold().split())
    assert one(spark, tx.identity_text("t"), t=text) == re.sub(r"\s+", " ", text.casefold()).strip()
    words = [w for m in WORD.finditer(text) for w in WORD.findall(unicodedata.normalize("NFKC", m.group()).casefold())]
    assert one(spark, tx.word_key("t"), t=text) == " ".join(words)
    assert [(s["word"]) for s in one(spark, tx.word_spans("t"), t=text)] == words
    assert one(spark, tx.word_keys(F.array("t")), t=text) == [" ".join(words)]
    assert one(spark, tx.lines("t"), t=text) == text.splitlines()


def test_word_spans_in_parts(spark):
    import pyarrow as pa

    texts = ["one Two", None, "", "x" * 700_000, "y " * 400_000, "End."]
    # a batch is unfolded in parts of bounded size, never whole
    parts = [p.to_pylist() for p in tx.word_spans.func(iter([pa.array(texts), pa.array([], pa.string())]))]
    assert [len(p) for p in parts] == [4, 2, 0]
    assert parts[0][:3] == [[{"word": "one", "start": 0, "end": 3}, {"word": "two", "start": 4, "end": 7}], None, []]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string").coalesce(1).select("id", tx.word_spans("t").alias("s"))
    got = [(r["n"], r["last"]) for r in rows.select("id", F.size("s").alias("n"), F.get("s", F.size("s") - 1)["start"].alias("last")).orderBy("id").collect()]
    assert got == [(2, 4), (None, None), (0, None), (1, 0), (400_000, 799_998), (1, 0)]
    assert list(tx.in_parts(pa.array(["abc", "d", "efg", None]), 4)) == [["abc", "d"], ["efg", None]]


def test_fingerprint(spark):
    def mark(title, text):
        return one(spark, tx.fingerprint("a", "b"), a=title, b=text)

    assert mark(" Senior Engineer ", "Build APIs\nwith Python") == mark("SENIOR engineer", "Build   APIs with python")
    assert mark("Other", "Build APIs") != mark("Senior", "Build APIs")


def test_closed_and_expired(spark):
    assert one(spark, tx.looks_closed(F.col("t")), t="Este empleo YA NO ESTÁ disponible.")
    assert not one(spark, tx.looks_closed(F.col("t")), t="We are open")
    today = F.lit("2024-06-01").cast("date")
    for value, expired in [("2024-05-31", True), ("2024-06-01", False), ("2024-05-31T23:00:00Z", True), ("2024-05-31 junk", True), ("soon", False), ("2024-13-01", False)]:
        assert one(spark, tx.is_expired(F.col("v"), today), v=value) == expired, value


def test_proper_nouns(spark):
    text = "Work at Acme Corp. Then ASP.NET and C++ on Node.js! End. Mr X"
    assert one(spark, tx.proper_nouns("t"), t=text) == ["Acme", "Corp", "ASP.NET", "C", "Node.js", "X"]


@pytest.mark.parametrize("mention,key", [("Python 3.11", "python"), (" React v18 ", "react"), ("Java 17+", "java"), ("C#", "c#"), ("Vue3", "vue3")])
def test_technology_key(spark, mention, key):
    assert one(spark, tx.technology_key("m"), m=mention) == key


def test_sections(spark):
    text = "Intro Java\nRequirements:\n- know  JAVA well\nNice to have\n- Go"
    frame = spark.createDataFrame([(text,)], ["t"]).withColumn("f", tx.folded_text("t"))

    def inside(quote):
        return frame.withColumn("k", tx.grounding_text(F.lit(quote))).select(tx.in_required_section(F.col("k"), tx.section_lines("t", "f")).alias("r")).first()["r"]

    assert inside("Know Java") is True
    assert inside("java") is False  # the first line that holds it is outside
    assert inside("Go") is False
    assert inside("") is False


@pytest.mark.parametrize("place,hit", [("Heredia, CR", True), ("Cracow, Poland", False), ("CRü", False), ("costa  RICA", True), ("San Jose, CA", False), ("cri", False), ("Remote LATAM", True), ("", False), ("X_CR", False)])
def test_region(spark, place, hit):
    assert one(spark, regions.in_region("p"), p=place) == hit


def test_first_word_index(spark):
    key = "we know java and java"
    assert one(spark, tx.first_word_index(F.lit(key), F.lit("java"))) == 2
    assert one(spark, tx.first_word_index(F.lit(key), F.lit("jav"))) is None
    assert one(spark, tx.first_word_index(F.lit(key), F.lit(""))) is None


def test_ipv6_hosts(spark):
    import ipaddress

    hosts = ["::1", "::", "::ffff:127.0.0.1", "::ffff:8.8.8.8", "::ffff:192.0.0.9", "2002:7f00:1::", "2606:4700::1111", "2001:db8::1", "2001:1::1",
             "2001:1::3", "2001:20::5", "fe80::1", "fec0::1", "fd00::1", "ff02::1", "64:ff9b::808:808", "100::1", "4000::1", "3fff::1",
             "2a00:1450:4001:81b::200e", "0:0:0:0:0:ffff:a00:1", "2001:0:1:2:3:4:5:6"]
    got = {r.h: r.off for r in spark.createDataFrame([(h,) for h in hosts], "h string")
           .withColumn("off", urls.off_public_network(F.concat(F.lit("https://["), "h", F.lit("]/x")))).collect()}

    def unsafe(host):
        v = ipaddress.ip_address(host)
        v = getattr(v, "ipv4_mapped", None) or v
        return not v.is_global or v.is_reserved or v.is_multicast or v.is_link_local or getattr(v, "is_site_local", False)

    assert got == {h: unsafe(h) for h in hosts}


def test_texts_without_words(spark, tmp_path):
    """The query counts them as one empty word, as its check SQL does; the operator gives no spans."""
    import duckdb

    from vacantia.workloads import CHECKS, QUERIES

    texts = ["One two", "", "... --\n", None, "_", "x"]
    rows = [(i, text, "en", "a", len(text or "")) for i, text in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, QUERIES["word_spans"](spark, str(tmp_path)).collect()))
    assert got == [(0, 2, "one"), (1, 1, ""), (2, 1, ""), (3, None, None), (4, 1, ""), (5, 1, "x")]
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        assert got == sorted(con.execute(CHECKS["word_spans"]).fetchall())
    assert one(spark, tx.word_spans("t"), t="... --\n") == []
