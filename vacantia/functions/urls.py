"""URL rules as Column expressions (RFC 3986 split by pattern, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions.text import CREDENTIAL, col, collapse, computed, fixed_strings, let, lines

# Query parameters that never identify a posting (besides utm_*).
NON_IDENTIFYING_PARAMS = (
    "title",
    "name",
    "jobName",
    "lastSelectedFacet",
    "selectedLocationsFacet",
    "in_iframe",
    "locationCountry",
    "locationId",
    "source",
    "new",
    "trid",
    "locations",
    "mode",
    "l",
    "lang",
    "c",
    "export-pdf",
)
# Second-level labels under two-letter country domains.
SECOND_LEVEL_LABELS = ("ac", "co", "com", "edu", "gov", "net", "org")
# Hosts of known applicant tracking systems.
KNOWN_ATS_HOSTS = (
    "greenhouse.io",
    "myworkdayjobs.com",
    "icims.com",
    "lever.co",
    "ashbyhq.com",
    "smartrecruiters.com",
    "oraclecloud.com",
    "successfactors.com",
    "csod.com",
    "ultipro.com",
    "bamboohr.com",
    "phenompeople.com",
)
# Texts that mark a bot challenge page.
CHALLENGE_MARKERS = (
    "captcha",
    "cloudflare",
    "challenge-platform",
    "access denied",
    "verify you are human",
    "checking your browser",
)
# IPv4 blocks that are not globally reachable (IANA special-purpose registry), first
# address and prefix length; the exceptions inside 192.0.0.0/24 are reachable.
NON_PUBLIC_IPV4 = (
    ("0.0.0.0", 8),
    ("10.0.0.0", 8),
    ("100.64.0.0", 10),
    ("127.0.0.0", 8),
    ("169.254.0.0", 16),
    ("172.16.0.0", 12),
    ("192.0.0.0", 24),
    ("192.0.2.0", 24),
    ("192.168.0.0", 16),
    ("198.18.0.0", 15),
    ("198.51.100.0", 24),
    ("203.0.113.0", 24),
    ("224.0.0.0", 4),
    ("240.0.0.0", 4),
)
PUBLIC_INSIDE = ("192.0.0.9", "192.0.0.10")
# Blocks of 2000::/3 that are not global, and what is global inside them.
NON_PUBLIC_IPV6 = ("2001::/23", "2001:db8::/32", "2002::/16")
PUBLIC_INSIDE_IPV6 = (
    "2001:1::1/128",
    "2001:1::2/128",
    "2001:3::/32",
    "2001:4:112::/48",
    "2001:20::/28",
    "2001:30::/28",
)

_GENERIC = r"(?s)^([A-Za-z][A-Za-z0-9+.-]*):(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_SERVER = r"^(?:.*@)?(\[[^\[\]@]*\]|[^\[\]@:]*)(?::(.*))?$"


def url_parts(url: Column | str) -> Column:
    """``struct<scheme, authority, path, query, fragment>``; pieces are empty when absent.

    Leading blanks and control characters and all tabs and line breaks are dropped
    before the split, as URL readers do.
    """
    clean = F.regexp_replace(col(url), r"\A[\x{00}-\x{20}]+|[\t\r\n]", "")
    return F.struct(
        F.lower(F.regexp_extract(clean, _GENERIC, 1)).alias("scheme"),
        F.regexp_extract(clean, _GENERIC, 2).alias("authority"),
        F.regexp_extract(clean, _GENERIC, 3).alias("path"),
        F.regexp_extract(clean, _GENERIC, 4).alias("query"),
        F.regexp_extract(clean, _GENERIC, 5).alias("fragment"),
    )


def authority_host(authority: Column) -> Column:
    """Lower-case host without brackets, user part and port; empty when malformed."""
    return F.lower(F.regexp_replace(F.regexp_extract(authority, _SERVER, 1), r"[\[\]]", ""))


def authority_port(authority: Column) -> Column:
    return F.regexp_extract(authority, _SERVER, 2)


def _clean_query(query: Column) -> Column:
    """Sorted, re-encoded query without the parameters that do not identify a posting."""

    def decode(piece: Column) -> Column:
        # A stray percent sign stays itself instead of failing the decoder.
        return F.url_decode(F.regexp_replace(piece, "%(?![0-9A-Fa-f]{2})", "%25"))

    def encode(piece: Column) -> Column:
        return F.replace(
            F.replace(F.url_encode(piece), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~")
        )

    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda piece: piece != ""),
        lambda piece: F.struct(
            decode(F.substring_index(piece, "=", 1)).alias("name"),
            decode(F.regexp_replace(piece, "^[^=]*=?", "")).alias("value"),
        ),
    )
    kept = F.array_sort(
        F.filter(
            pairs,
            lambda pair: ~pair["name"].isin(*NON_IDENTIFYING_PARAMS)
            & ~pair["name"].startswith("utm_"),
        )
    )
    encoded = F.array_join(
        F.transform(
            kept, lambda pair: F.concat(encode(pair["name"]), F.lit("="), encode(pair["value"]))
        ),
        "&",
    )
    return F.when(query == "", F.lit("")).otherwise(encoded)


def key_from_parts(parts: Column) -> Column:
    """Canonical key of a split URL; null when it is not an absolute http(s) URL."""
    authority = parts["authority"]
    host, port = authority_host(authority), authority_port(authority)
    number = F.when(port.rlike(r"^[0-9]{1,18}$"), port.cast("long"))
    port_ok = (port == "") | F.coalesce(number.between(0, 65535), F.lit(False))
    brackets_ok = ~authority.rlike(r"[\[\]]") | authority.rlike(
        r"^(?:[^\[\]]*@)?\[[0-9A-Fa-f:.]+(?:%[^\[\]]*)?\](?::.*)?$"
    )
    valid = parts["scheme"].isin("http", "https") & (host != "") & port_ok & brackets_ok
    shown_host = F.when(F.contains(host, F.lit(":")), F.concat(F.lit("["), host, F.lit("]"))).otherwise(host)
    default_port = ((parts["scheme"] == "http") & (number == 80)) | (
        (parts["scheme"] == "https") & (number == 443)
    )
    shown_port = F.when((port == "") | default_port, F.lit("")).otherwise(
        F.concat(F.lit(":"), number.cast("string"))
    )
    path = F.when(parts["path"] == "/", parts["path"]).otherwise(
        F.regexp_replace(parts["path"], "/$", "")
    )
    query = _clean_query(parts["query"])
    return F.when(
        valid,
        F.concat(
            parts["scheme"],
            F.lit("://"),
            shown_host,
            shown_port,
            path,
            F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)),
        ),
    )


def url_key(url: Column | str) -> Column:
    return key_from_parts(url_parts(url))


def with_url_key(df: DataFrame, url: str = "url", out: str = "url_key") -> DataFrame:
    """Add the canonical key, computed once per row (keep the rows narrow)."""
    split = df.withColumn("_parts", url_parts(url))
    return computed(split, out, key_from_parts(F.col("_parts"))).drop("_parts")


def origin_of(parts: Column) -> Column:
    return F.concat(parts["scheme"], F.lit("://"), parts["authority"])


def path_prefix(sample_url: Column | str) -> Column:
    """Parent folder of the sample's path, ``/`` when there is none."""
    path = F.regexp_replace(url_parts(sample_url)["path"], "/+$", "")
    # A parent made of more than slashes loses its own trailing slashes.
    parent = F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    return F.when(parent == "", F.lit("/")).otherwise(
        F.when(parent.rlike("^/+$"), F.concat(parent, F.lit("/"))).otherwise(
            F.regexp_replace(parent, "/+$", "")
        )
    )


def prefix_ancestry(sample_url: Column | str) -> Column:
    """The derived prefix and each of its parents up to ``/``."""
    prefix = path_prefix(sample_url)
    pieces = F.filter(F.split(prefix, "/"), lambda p: p != "")
    depth = F.size(pieces)
    parents = F.transform(
        F.sequence(F.lit(0), depth),
        lambda i: F.concat(F.lit("/"), F.array_join(F.slice(pieces, F.lit(1), depth - i), "/")),
    )
    return F.array_distinct(parents)


def tail_depth(sample_url: Column | str, prefix: Column) -> Column:
    """Number of path segments of the sample below *prefix*; 0 when it is elsewhere."""
    path = F.regexp_replace(url_parts(sample_url)["path"], "/+$", "")
    segments = F.size(F.filter(F.split(path, "/"), lambda s: s != ""))
    below = F.size(F.split(F.substring(path, F.length(prefix) + 2, F.length(path)), "/"))
    return (
        F.when(prefix == "/", segments)
        .when(F.startswith(path, F.concat(prefix, F.lit("/"))), below)
        .otherwise(F.lit(0))
    )


def registrable_domain(host: Column | str) -> Column:
    labels = F.split(F.regexp_replace(F.lower(col(host)), r"\.+$", ""), r"\.")
    count = F.size(labels)
    three = (
        (count >= 3)
        & (F.length(F.element_at(labels, -1)) == 2)
        & F.try_element_at(labels, F.lit(-2)).isin(*SECOND_LEVEL_LABELS)
    )
    take = F.when(three, F.lit(3)).otherwise(F.least(count, F.lit(2)))
    return F.array_join(F.slice(labels, -take, take), ".")


def redirect_verdict(start_url: Column, final_url: Column, board_url: Column) -> Column:
    """``closed`` on the board root, ``allowed`` on a related or known host, else off-site."""
    start, final = (
        authority_host(url_parts(start_url)["authority"]),
        authority_host(url_parts(final_url)["authority"]),
    )
    known = F.exists(
        fixed_strings(KNOWN_ATS_HOSTS),
        lambda h: (final == h) | F.endswith(final, F.concat(F.lit("."), h)),
    )
    allowed = (start == final) | (registrable_domain(start) == registrable_domain(final)) | known
    return (
        F.when(~allowed, "off_site_redirect")
        .when(F.coalesce(url_key(final_url) == url_key(board_url), F.lit(False)), "closed")
        .otherwise("allowed")
    )


def http_outcome(status: Column, body: Column) -> Column:
    """Failure category of an HTTP answer; null when it may be read."""
    challenged = body.rlike("(?iu)" + "|".join(CHALLENGE_MARKERS))
    return (
        F.when(status.isin(404, 410), "not_found")
        .when(status.isin(401, 403, 429) | ((status == 503) & challenged), "blocked")
        .when(status >= 500, "server_error")
    )


def _ipv4_number(address: Column) -> Column:
    octets = F.split(address, r"\.")
    return F.aggregate(
        octets, F.lit(0).cast("long"), lambda acc, o: acc * 256 + o.try_cast("long")
    )


def _groups_of(address: str) -> list[int]:
    left, _, right = address.partition("::")
    head, tail = ([int(x, 16) for x in side.split(":") if x] for side in (left, right))
    return head + [0] * (8 - len(head) - len(tail)) + tail


def _ipv6_groups(host: Column) -> Column:
    """The eight groups of an IPv6 host as numbers; null if it is none."""
    tail = r"([0-9]+\.[0-9]+\.[0-9]+\.[0-9]+)$"
    v4 = F.regexp_extract(host, tail, 1)
    number = _ipv4_number(v4)
    as_groups = F.concat(
        F.regexp_replace(host, tail, ""), F.lower(F.hex(F.shiftright(number, 16))), F.lit(":"), F.lower(F.hex(number % 65536))
    )
    plain = F.when(v4 == "", host).otherwise(as_groups)

    def numbers(side: Column) -> Column:
        return F.transform(F.filter(F.split(side, ":"), lambda x: x != ""), lambda x: F.conv(x, 16, 10).try_cast("long"))

    def spread(text: Column) -> Column:
        sides = F.split(text, "::", 2)
        left, right = numbers(F.get(sides, 0)), numbers(F.coalesce(F.get(sides, 1), F.lit("")))
        gap = F.when(F.size(sides) == 2, 8 - F.size(left) - F.size(right)).otherwise(0)
        return F.concat(left, F.array_repeat(F.lit(0).cast("long"), F.greatest(gap, F.lit(0))), right)

    sound = plain.rlike(r"^[0-9a-f:]*:[0-9a-f:]*$") & ~plain.rlike(r"[0-9a-f]{5}")
    return F.when(sound, let(plain, spread))


def off_public_network(url: Column | str) -> Column:
    """Whether the URL names a literal address that is not globally reachable.

    A literal IPv6 host is written out to its eight groups: IPv4 in IPv6 is judged as
    IPv4, and of the rest only 2000::/3 without its reserved blocks is global. Names are
    not resolved.
    """
    octet = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
    ranges = []
    for base, bits in NON_PUBLIC_IPV4:
        low = sum(int(part) << shift for part, shift in zip(base.split("."), (24, 16, 8, 0)))
        ranges.append((low, low + (1 << (32 - bits)) - 1))

    def judge_number(number: Column) -> Column:
        hit = F.lit(False)
        for low, high in ranges:
            hit = hit | number.between(low, high)
        return hit

    inside = [sum(int(part) << shift for part, shift in zip(a.split("."), (24, 16, 8, 0))) for a in PUBLIC_INSIDE]

    def judge_v4(number: Column) -> Column:
        return judge_number(number) & ~number.isin(*inside)

    def judge_groups(g: Column) -> Column:
        def under(block: str) -> Column:
            base, bits = block.split("/")
            bits, test = int(bits), F.lit(True)
            for i, group in enumerate(_groups_of(base)):
                if 16 * i < bits:
                    kept = 16 - min(16, bits - 16 * i)
                    test = test & (F.shiftright(F.get(g, i), kept) == group >> kept)
            return test

        def within(blocks) -> Column:
            hit = F.lit(False)
            for block in blocks:
                hit = hit | under(block)
            return hit

        inner = judge_v4(F.get(g, 6) * 65536 + F.get(g, 7))
        unsafe = ~under("2000::/3") | (within(NON_PUBLIC_IPV6) & ~within(PUBLIC_INSIDE_IPV6))
        return F.when(F.size(g) == 8, F.when(under("::ffff:0:0/96"), inner).otherwise(unsafe))

    def judge(host: Column) -> Column:
        is_v4 = host.rlike(rf"^{octet}(?:\.{octet}){{3}}$")
        unsafe_v6 = let(_ipv6_groups(host), judge_groups)
        unsafe_v4 = let(_ipv4_number(host), judge_v4)
        return F.when(is_v4, unsafe_v4).when(F.contains(host, F.lit(":")), unsafe_v6)

    return F.coalesce(let(authority_host(url_parts(url)["authority"]), judge), F.lit(False))


def redact_url(url: Column) -> Column:
    """Scheme, host, port and path of an http(s) URL; a fixed mark when unreadable."""
    parts = url_parts(url)
    host, port = authority_host(parts["authority"]), authority_port(parts["authority"])
    bracketed = F.contains(host, F.lit(":"))
    number = F.when(port.rlike(r"^[0-9]{1,18}$"), port.cast("long"))
    readable = (
        parts["scheme"].isin("http", "https")
        & host.rlike(r"^(?:[A-Za-z0-9_.-]+|[0-9a-f:.]*:[0-9a-f:.]*)$")
        & ((port == "") | F.coalesce(number.between(0, 65535), F.lit(False)))
        & ~F.contains(url, F.lit("\\"))
        & ~url.rlike(r"[\x{00}-\x{20}]")
    )
    shown = F.when(bracketed, F.concat(F.lit("["), host, F.lit("]"))).otherwise(host)
    shown = F.when(port == "", shown).otherwise(
        F.concat(shown, F.lit(":"), number.cast("string"))
    )
    return F.when(
        readable, F.concat(parts["scheme"], F.lit("://"), shown, parts["path"])
    ).otherwise("<unparseable-url>")


def redact_message(text: Column | str, limit: int = 200) -> Column:
    """First line only, URLs cut down, credentials masked, collapsed and cut to *limit*."""
    first = F.coalesce(F.try_element_at(lines(text), F.lit(1)), F.lit(""))
    pieces = F.regexp_extract_all(
        first, F.lit(r"(?i)https?:[^\s<>\"']*|(?:(?!https?:).)+"), F.lit(0)
    )
    safe = F.array_join(
        F.transform(
            pieces, lambda p: F.when(p.rlike("(?i)^https?:"), redact_url(p)).otherwise(p)
        ),
        "",
    )
    safe = F.regexp_replace(safe, CREDENTIAL, "<redacted>")
    return F.substring(collapse(safe), 1, max(0, limit))


def sanitized_url(url: Column | str) -> Column:
    """Query values of token-like parameters replaced by REDACTED; fragment dropped."""
    parts = url_parts(url)
    pairs = F.transform(
        F.filter(F.split(parts["query"], "&"), lambda p: p != ""),
        lambda p: F.struct(
            F.url_decode(
                F.regexp_replace(F.substring_index(p, "=", 1), "%(?![0-9A-Fa-f]{2})", "%25")
            ).alias("name"),
            F.url_decode(
                F.regexp_replace(
                    F.regexp_replace(p, "^[^=]*=?", ""), "%(?![0-9A-Fa-f]{2})", "%25"
                )
            ).alias("value"),
        ),
    )

    def encode(piece: Column) -> Column:
        return F.replace(
            F.replace(F.url_encode(piece), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~")
        )

    query = F.array_join(
        F.transform(
            pairs,
            lambda p: F.concat(
                encode(p["name"]),
                F.lit("="),
                F.when(F.contains(F.lower(p["name"]), F.lit("token")), F.lit("REDACTED")).otherwise(
                    encode(p["value"])
                ),
            ),
        ),
        "&",
    )
    query = F.when(parts["query"] == "", F.lit("")).otherwise(query)
    return F.concat(
        origin_of(parts),
        parts["path"],
        F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)),
    )


def _remove_dots(path: Column) -> Column:
    """Path without ``.`` and ``..`` segments (RFC 3986, 5.2.4)."""
    segments = F.split(path, "/")
    last = F.element_at(segments, -1)
    start = F.array().cast("array<string>")

    def step(acc: Column, segment: Column) -> Column:
        shorter = F.when(
            F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)
        ).otherwise(acc)
        return (
            F.when(segment == ".", acc)
            .when(segment == "..", shorter)
            .otherwise(F.concat(acc, F.array(segment)))
        )

    kept = F.aggregate(segments, start, step)
    joined = F.array_join(kept, "/")
    closed = last.isin(".", "..") & ~F.endswith(joined, F.lit("/"))
    resolved = F.when(closed, F.concat(joined, F.lit("/"))).otherwise(joined)
    return F.when(path.rlike(r"(?:^|/)\.\.?(?:/|$)"), resolved).otherwise(path)


def resolve_url(base: Column | str, reference: Column | str) -> Column:
    """Absolute form of a link found on the page at *base* (RFC 3986, 5.2)."""
    base_parts = url_parts(base)
    ref = F.trim(F.regexp_replace(col(reference), r"[\t\r\n]", ""))
    has_scheme = ref.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:")
    path = F.regexp_extract(ref, r"^([^?#]*)", 1)
    tail = F.regexp_replace(ref, r"^[^?#]*", "")
    root = origin_of(base_parts)
    folder = F.regexp_replace(base_parts["path"], r"[^/]*$", "")
    merged = F.when(folder == "", F.concat(F.lit("/"), path)).otherwise(F.concat(folder, path))
    base_query = F.when(base_parts["query"] == "", F.lit("")).otherwise(
        F.concat(F.lit("?"), base_parts["query"])
    )
    return (
        F.when(ref == "", col(base))
        .when(has_scheme, ref)
        .when(F.startswith(ref, F.lit("//")), F.concat(base_parts["scheme"], F.lit(":"), ref))
        .when(F.startswith(ref, F.lit("/")), F.concat(root, _remove_dots(path), tail))
        .when(
            path == "",
            F.concat(
                root,
                base_parts["path"],
                F.when(F.startswith(tail, F.lit("?")), tail).otherwise(F.concat(base_query, tail)),
            ),
        )
        .otherwise(F.concat(root, _remove_dots(merged), tail))
    )


def is_posting_url(
    url: Column, origin: Column, base_path: Column, min_depth: Column, listing_url: Column
) -> Column:
    """Whether the page at *url* is itself a posting of the board and not its listing."""
    parts, listing = url_parts(url), url_parts(listing_url)
    path = F.regexp_replace(parts["path"], "/$", "")
    below = F.substring(path, F.length(base_path) + 2, F.length(path))
    return F.coalesce(
        (parts["scheme"] != "")
        & (parts["authority"] != "")
        & (origin_of(parts) == origin)
        & (path != F.regexp_replace(listing["path"], "/$", ""))
        & F.startswith(path, F.concat(base_path, F.lit("/")))
        & (F.size(F.split(below, "/")) >= min_depth),
        F.lit(False),
    )
