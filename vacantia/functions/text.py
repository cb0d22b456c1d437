"""Text rules as Column expressions.

Catalyst has neither NFKC nor case folding, so those two run in Arrow batches, and
only for rows that hold a non-ASCII character: ASCII text is its own NFKC form and
``lower`` folds it. Everything else stays inside the JVM.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Phrases by which a posting says that it is closed.
CLOSED_PHRASES = (
    "no longer accepting applications",
    "this job is no longer available",
    "this position has been filled",
    "the job you are looking for is no longer open",
    "ya no se aceptan solicitudes",
    "este empleo ya no está disponible",
    "esta posición ha sido cubierta",
    "el empleo que buscas ya no está disponible",
)
# Fixed patterns: requirement cue and section headings of a posting.
REQUIRED_CUE = r"(?i)(?<![\p{L}\p{N}_])(required|must|essential|minimum|mandatory|need|should have)(?![\p{L}\p{N}_])"
REQUIRED_HEADING = (
    r"(?i)^(requirements|required qualifications|minimum qualifications|must have)s?:?$"
)
PREFERRED_HEADING = r"(?i)^(preferred qualifications|nice to have|bonus qualifications)s?:?$"
VERSION_SUFFIX = r"(?i)(?:\s+v?\d+(?:\.\d+)*(?:\+)?|\s+\d+\+)$"
CAPITALIZED_TOKEN = (
    r"(?<![\p{L}\p{N}_])[A-Z][A-Za-z0-9.+#-]*"
    r"(?:(?<=[A-Za-z0-9])(?![\p{L}\p{N}_])|(?<=[.+#-])(?=[\p{L}\p{N}_]))"
)
CREDENTIAL = (
    r"(?i)\b(?:authorization|proxy-authorization)\b[^\r\n]*"
    r"|\b(?:api[_-]?key|password|secret|(?:access[_-]?|refresh[_-]?)?token)"
    r"\b(?:\\*[\"'])?\s*[=:][^\r\n]*"
    r"|\bsk-[\w-]+"
)
# Fixed patterns: what counts as a secret in a stored document.
SECRET_PATTERNS = (
    ("credential_value", r"(?i)(?:access[_-]?token|api[_-]?key|client[_-]?secret|password)\s*[=:]\s*[^\s\"'&<>]+"),
    ("token_parameter", r"(?i)(?:[?&](?:token|access_token|api_key|key|secret)=)(?!REDACTED(?:[&#]|$))[^&#\s\"'<>]+"),
    ("authorization_header", r"(?i)(?:authorization\s*[=:]\s*(?:bearer|basic)\s+)[A-Za-z0-9._~+/-]+=*"),
    ("cookie_header", r"(?i)(?:set-cookie|cookie)\s*:"),
)
# White space as the source rules see it (Unicode), in Java regex form. Single plain
# blanks need no change, so the replacing patterns skip them.
_ODD = (
    r"\t\x{0b}\f\r\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
_WS = rf"[ \n{_ODD}]"
_WS_RUN = rf"[ \n{_ODD}]{{2,}}|[\n{_ODD}]"
_HORIZONTAL_WS = rf"[ {_ODD}]{{2,}}|[{_ODD}]"
_LINE_BREAK = r"\r\n|[\n\r\x{0b}\f\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
_NON_ASCII = r"[^\x{00}-\x{7f}]"
# Text that a batch function unfolds at a time: a batch may hold thousands of long texts.
PART_BYTES = 1 << 20
_WORD = re.compile(r"[^\W_]+(?:[\u0300-\u036f]+[^\W_]*)*")

WORD_SPAN = T.ArrayType(
    T.StructType(
        [
            T.StructField("word", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
        ]
    )
)


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body) -> Column:
    """*body* of *value* with the value computed once per row (no Python UDF inside)."""
    return F.element_at(F.transform(F.array(value), body), 1)


@F.pandas_udf(T.StringType())
def nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFKC", v))


@F.pandas_udf(T.StringType())
def casefold(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else v.casefold())


@F.pandas_udf(T.StringType())
def nfkc_fold(values: pd.Series) -> pd.Series:
    return values.map(
        lambda v: None if v is None else unicodedata.normalize("NFKC", v).casefold()
    )


def _plain(text: str) -> bool:
    """Whether folding keeps word borders: NFKC text without the one folding mark."""
    return unicodedata.is_normalized("NFKC", text) and "\u0345" not in text


def _key(text: str) -> str:
    if _plain(text):
        return " ".join(_WORD.findall(text.casefold()))
    return " ".join(word for word, _, _ in _spans(text))


def _spans(text: str) -> list[tuple[str, int, int]]:
    if _plain(text):
        return [(m.group().casefold(), m.start(), m.end()) for m in _WORD.finditer(text)]
    return [
        (word, match.start(), match.end())
        for match in _WORD.finditer(text)
        for word in _WORD.findall(unicodedata.normalize("NFKC", match.group()).casefold())
    ]


def in_parts(texts: pa.Array, most: int = PART_BYTES) -> Iterator[list]:
    """The texts of an Arrow batch in lists of at most *most* bytes, one text at least."""
    begun, held = 0, 0
    for place, size in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if place > begun and held + size > most:
            yield texts.slice(begun, place - begun).to_pylist()
            begun, held = place, 0
        held += size
    yield texts.slice(begun).to_pylist()


@F.arrow_udf(WORD_SPAN)
def word_spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Words with the character range each one has in the original text."""
    for batch in batches:
        for texts in in_parts(batch):
            ends, words, starts, stops = [], [], [], []
            for text in texts:
                ends.append(None if text is None else len(words))
                for word, start, stop in _spans(text) if text else ():
                    words.append(word)
                    starts.append(start)
                    stops.append(stop)
            ends.append(len(words))
            spans = pa.StructArray.from_arrays(
                [pa.array(words, pa.string()), pa.array(starts, pa.int32()), pa.array(stops, pa.int32())],
                names=["word", "start", "end"],
            )
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans)


@F.pandas_udf(T.StringType())
def _word_key_unicode(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else _key(v))


@F.pandas_udf(
    T.StructType(
        [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
    )
)
def span_of_words(texts: pd.Series, first: pd.Series, count: pd.Series) -> pd.DataFrame:
    """Character range of a run of words (null text: none); rows of one text in a row share its words."""
    last, spans, rows = None, [], []
    for text, start, size in zip(texts, first, count):
        if text is None:
            rows.append((None, None))
            continue
        if text is not last:
            last, spans = text, _spans(text)
        rows.append((spans[int(start)][1], spans[int(start + size) - 1][2]))
    return pd.DataFrame(rows, columns=["start", "end"], dtype="Int32")


def computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row.

    Later filters on a projected column are pushed below it with its expression copied
    into them, which multiplies the work of long expressions. A generated column has no
    such copies. Use it on narrow rows.
    """
    return df.withColumn(name, F.explode_outer(F.array(value)))


def _by_alphabet(text: Column, ascii_form: Column, udf) -> Column:
    """*ascii_form* for ASCII rows; the batch function sees only the other rows."""
    plain = ~text.rlike(_NON_ASCII)
    return F.when(plain, ascii_form).otherwise(udf(F.when(plain, F.lit(None)).otherwise(text)))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _word_keys_unicode(values: pd.Series) -> pd.Series:
    return values.map(
        lambda items: None
        if items is None
        else [None if v is None else _key(v) for v in items]
    )


@F.pandas_udf(T.ArrayType(T.StringType()))
def _grounding_texts_unicode(values: pd.Series) -> pd.Series:
    return values.map(
        lambda items: None
        if items is None
        else [
            None
            if v is None
            else " ".join(unicodedata.normalize("NFKC", v).casefold().split())
            for v in items
        ]
    )


def _each_by_alphabet(items: Column, ascii_form, udf) -> Column:
    plain = ~F.exists(items, lambda v: v.rlike(_NON_ASCII))
    return F.when(plain, F.transform(items, ascii_form)).otherwise(
        udf(F.when(plain, F.lit(None)).otherwise(items))
    )


def _ascii_key(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", " "))


def word_keys(items: Column | str) -> Column:
    """:func:`word_key` of every element of an array."""
    return _each_by_alphabet(col(items), _ascii_key, _word_keys_unicode)


def grounding_texts(items: Column | str) -> Column:
    """:func:`grounding_text` of every element of an array."""
    return _each_by_alphabet(
        col(items), lambda v: collapse(F.lower(v)), _grounding_texts_unicode
    )


def fold(text: Column | str) -> Column:
    """Full case folding."""
    text = col(text)
    return _by_alphabet(text, F.lower(text), casefold)


def compat(text: Column | str) -> Column:
    """Unicode compatibility (NFKC) form."""
    text = col(text)
    return _by_alphabet(text, text, nfkc)


def collapse(text: Column) -> Column:
    """One blank between words, none at the ends."""
    return F.trim(F.regexp_replace(text, _WS_RUN, " "))


def tidy(text: Column) -> Column:
    """White-space half of :func:`normalize`, for text already in NFKC form."""
    lines = F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), _HORIZONTAL_WS, " ")
    lines = F.regexp_replace(lines, r"(?m)^ +| +$", "")
    return F.regexp_replace(
        F.regexp_replace(lines, r"\n{3,}", "\n\n"), r"\A\s+|\s+\z", ""
    )


def normalize(text: Column | str) -> Column:
    """NFKC, unified line ends, single blanks per line, at most one empty line, trimmed."""
    return tidy(compat(text))


def grounding_text(text: Column | str) -> Column:
    """NFKC, folded, white space collapsed: the form in which fact quotes are searched."""
    return collapse(folded_text(text))


def identity_text(text: Column | str) -> Column:
    """Folded, white space collapsed (no NFKC): the form that fingerprints hash."""
    return collapse(fold(text))


def word_key(text: Column | str) -> Column:
    """The words of *text*, folded and joined by one blank."""
    text = col(text)
    return _by_alphabet(text, _ascii_key(text), _word_key_unicode)


def words(text: Column | str) -> Column:
    return key_words(word_key(text))


def key_words(key: Column) -> Column:
    return F.when(key == "", F.array().cast("array<string>")).otherwise(F.split(key, " "))


def padded(key: Column) -> Column:
    """A word key between blanks, so that substring search finds whole words only."""
    return F.concat(F.lit(" "), key, F.lit(" "))


def contains_words(text_key: Column, phrase_key: Column) -> Column:
    """Whether the phrase's words occur in the text as one unbroken run of whole words."""
    return (phrase_key != "") & F.contains(padded(text_key), padded(phrase_key))


def first_word_index(text_key: Column, phrase_key: Column) -> Column:
    """0-based index of the first word of the first occurrence; null if there is none."""
    at = F.instr(padded(text_key), padded(phrase_key))
    before = F.substring(padded(text_key), F.lit(1), at)
    blanks = F.length(before) - F.length(F.replace(before, F.lit(" "), F.lit("")))
    return F.when((phrase_key != "") & (at > 0), (blanks - 1).cast("int"))


def content_hash(text: Column | str) -> Column:
    return F.sha2(normalize(text), 256)


def fingerprint(title: Column | str, text: Column | str) -> Column:
    """SHA-256 over folded, collapsed title and whole text."""
    return F.sha2(F.concat(identity_text(title), F.lit("\n"), identity_text(text)), 256)


def fixed_strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def looks_closed(normalized: Column) -> Column:
    """Whether normalised text carries one of the closing phrases, in any letter case."""
    return normalized.rlike("(?iu)" + "|".join(CLOSED_PHRASES))


def iso_date(value: Column) -> Column:
    """ISO date or timestamp to a date, falling back to the first ten characters."""
    trimmed = F.trim(value)
    # Only the date part matters: an offset is kept, not applied.
    whole = F.when(
        trimmed.rlike(
            r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}(?::\d{2}(?::\d{2}(?:[.,]\d+)?)?)?(?:Z|[+-]\d{2}:?\d{2})?)?$"
        ),
        F.substring(trimmed, 1, 10),
    )
    return F.coalesce(
        F.try_to_date(whole, "yyyy-MM-dd"),
        F.when(
            F.substring(trimmed, 1, 10).rlike(r"^\d{4}-\d{2}-\d{2}$"),
            F.try_to_date(F.substring(trimmed, 1, 10), "yyyy-MM-dd"),
        ),
        F.try_to_date(F.when(F.substring(trimmed, 1, 8).rlike(r"^\d{8}$"), F.substring(trimmed, 1, 8)), "yyyyMMdd"),
    )


def is_expired(valid_through: Column, today: Column) -> Column:
    """A parseable validThrough before *today*; an unreadable one never expires."""
    return F.coalesce(iso_date(valid_through) < today, F.lit(False))


def comparable_title(title: Column | str) -> Column:
    return F.nullif(identity_text(title), F.lit(""))


def technology_key(mention: Column | str) -> Column:
    return fold(F.regexp_replace(collapse_ends(col(mention)), VERSION_SUFFIX, ""))


def collapse_ends(text: Column) -> Column:
    return F.regexp_replace(text, r"\A" + _WS + "+|" + _WS + r"+\z", "")


def lines(text: Column | str) -> Column:
    """Lines of a text; the empty piece after a last line break is no line."""
    parts = F.split(col(text), _LINE_BREAK)
    return F.when(
        F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)
    ).otherwise(parts)


def proper_nouns(summary: Column | str) -> Column:
    """Capitalised tokens that do not open the text or a sentence."""
    # The leading ". " makes the start of the text a sentence start; a hit that begins
    # with its sentence mark is an opening token and is dropped.
    marked = F.concat(F.lit(". "), col(summary))
    hits = F.regexp_extract_all(
        marked, F.lit(r"(?:[.!?]" + _WS + "*)?" + CAPITALIZED_TOKEN), F.lit(0)
    )
    return F.filter(hits, lambda hit: hit.rlike("^[A-Z]"))


def in_required_section(quote_key: Column, text_lines: Column) -> Column:
    """Section in force at the first line that holds the quote (folded search form).

    *text_lines* is ``array<struct<heading:string, key:string>>`` from
    :func:`section_lines`; headings carry down, the first hit decides.
    """
    start = F.struct(
        F.lit(None).cast("string").alias("section"), F.lit(None).cast("boolean").alias("hit")
    )

    def step(acc: Column, line: Column) -> Column:
        section = F.coalesce(line["heading"], acc["section"])
        found = (quote_key != "") & F.contains(line["key"], quote_key)
        return F.struct(
            section.alias("section"),
            F.coalesce(
                acc["hit"], F.when(found, F.coalesce(section == "required", F.lit(False)))
            ).alias("hit"),
        )

    return F.aggregate(text_lines, start, step, lambda acc: F.coalesce(acc["hit"], F.lit(False)))


def heading_of(line: Column) -> Column:
    stripped = collapse_ends(line)
    return F.when(stripped.rlike(REQUIRED_HEADING), "required").when(
        stripped.rlike(PREFERRED_HEADING), "preferred"
    )


def folded_text(text: Column | str) -> Column:
    """NFKC-folded text with its line breaks in place."""
    text = col(text)
    return _by_alphabet(text, F.lower(text), nfkc_fold)


def section_lines(text: Column | str, folded: Column | str) -> Column:
    """Lines with the heading they are (if any) and their folded search form.

    *folded* is the stored :func:`folded_text` of the same text: folding keeps line
    breaks, so both line lists stay aligned.
    """
    return F.zip_with(
        lines(text),
        lines(folded),
        lambda line, key: F.struct(heading_of(line).alias("heading"), collapse(key).alias("key")),
    )


def dedup_paragraphs(*normalized: Column) -> Column:
    """Paragraphs of several normalised texts, repeats dropped, first place kept."""
    joined = F.concat_ws("\n", *normalized)
    return F.array_join(
        F.array_distinct(F.filter(F.split(joined, "\n"), lambda line: line != "")), "\n"
    )


def secret_names(text: Column | str) -> Column:
    """Names of the secret patterns that occur in the text."""
    text = col(text)
    return F.array_compact(
        F.array(*[F.when(text.rlike(pattern), F.lit(name)) for name, pattern in SECRET_PATTERNS])
    )


def slug(name: Column | str) -> Column:
    return F.regexp_replace(
        F.regexp_replace(F.lower(col(name)), "[^a-z0-9]+", "_"), "^_+|_+$", ""
    )


def acronym(slug_value: Column | str) -> Column:
    return F.array_join(
        F.transform(F.split(col(slug_value), "_"), lambda part: F.substring(part, 1, 1)), ""
    )


def naive_utc(text: Column | str) -> Column:
    """ISO timestamp text to naive UTC: an offset is applied and dropped."""
    text = F.trim(col(text))
    aware = text.rlike(r"[T ].*(?:Z|[+-]\d{2}:?\d{2})$")
    moved = F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), F.try_to_timestamp(text).cast("timestamp_ntz")
    )
    return F.when(aware, moved).otherwise(text.try_cast("timestamp_ntz"))
