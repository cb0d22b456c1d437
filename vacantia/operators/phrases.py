"""Phrase location: quotes in their own document, and phrases in any document."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import text as tx
from vacantia.session import cut_lineage, small_side


def _cited(contents: DataFrame, quotes: DataFrame, key: str) -> DataFrame:
    """The contents that some quote names: no other text is folded or sent."""
    return contents.join(small_side(quotes.select(key).distinct()), key, "left_semi")


def _with_words(quotes: DataFrame, contents: DataFrame, key: str, quote: str, text: str, *held: Column) -> DataFrame:
    """Quotes joined to their document's folded words: adds found, first_word, word_count and *held*.

    Each cited document is folded once, before the join, so a document with very many quotes
    is an ordinary skewed join.
    """
    docs = _cited(contents, quotes, key).select(key, tx.word_key(text).alias("_doc"), *held)
    keyed = quotes.withColumn("_quote", tx.word_key(quote))
    index = tx.first_word_index(F.col("_doc"), F.col("_quote"))
    return (
        keyed.join(docs, key, "left")
        .withColumn("first_word", index)
        .withColumn("word_count", F.size(tx.key_words(F.col("_quote"))))
        .withColumn("found", F.col("first_word").isNotNull())
        .drop("_doc", "_quote")
    )


def bound_quotes(
    quotes: DataFrame, contents: DataFrame, key: str = "content_id", quote: str = "quote", text: str = "text"
) -> DataFrame:
    """Each quote against its own document: adds *found*, *first_word* and *word_count*.

    Whole-word runs are plain substring search between blanks. A quote without words never
    occurs, nor does one without a document.
    """
    return _with_words(quotes, contents, key, quote, text)


def located_quotes(
    quotes: DataFrame, contents: DataFrame, key: str = "content_id", quote: str = "quote", text: str = "text"
) -> DataFrame:
    """:func:`bound_quotes` with *span_start*, *span_end* and the literal *excerpt*, null if not found.

    The document comes with its folded words in the same join, so its text is sent once.
    """
    located = _with_words(quotes, contents, key, quote, text, F.col(text).alias("_text"))
    read = F.when(F.col("found"), F.col("_text"))
    spanned = located.withColumn("_span", tx.span_of_words(read, "first_word", "word_count"))
    start, end = F.col("_span.start"), F.col("_span.end")
    return spanned.select(
        *[c for c in located.columns if c != "_text"],
        start.alias("span_start"),
        end.alias("span_end"),
        F.substring(F.col("_text"), start + 1, end - start).alias("excerpt"),
    )


def substring_quotes(
    quotes: DataFrame, contents: DataFrame, key: str = "content_id", quote: str = "quote", text: str = "text"
) -> DataFrame:
    """The rule for facts: folded, collapsed quote inside the folded, collapsed document."""
    docs = _cited(contents, quotes, key).select(key, tx.grounding_text(text).alias("_doc"))
    return (
        quotes.withColumn("_quote", tx.grounding_text(quote))
        .join(docs, key, "left")
        .withColumn("found", F.coalesce(F.contains("_doc", "_quote"), F.lit(False)))
        .drop("_doc", "_quote")
    )


def grounding_misses(checked: DataFrame, quote: str = "quote") -> DataFrame:
    """Rows whose quote does not occur, with hash and length in place of the text."""
    return (
        checked.filter(~F.col("found"))
        .withColumn("value_sha256", F.sha2(F.col(quote), 256))
        .withColumn("value_characters", F.length(quote))
        .drop(quote, "found", "first_word", "word_count")
    )


def _doubled(hashes: Column, span: int) -> Column:
    """Hashes of runs of 2*span words from the hashes of runs of span words."""
    return F.when(
        F.size(hashes) > span,
        F.transform(
            F.sequence(F.lit(1), F.size(hashes) - span),
            lambda i: F.xxhash64(F.element_at(hashes, i), F.element_at(hashes, i + span)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _with_run_hashes(df: DataFrame, words: str, spans: list[int]) -> DataFrame:
    """Columns _h1, _h2, _h4 ... up to the longest span: hashes of all word runs."""
    df = df.withColumn("_h1", F.transform(F.col(words), lambda w: F.xxhash64(w)))
    span = 1
    while span < max(spans):
        df = df.withColumn(f"_h{span * 2}", _doubled(F.col(f"_h{span}"), span))
        span *= 2
    return df


def _bitmap(seeds: DataFrame) -> list[int]:
    """A set of the seeds' low bits as words of 64 bits, some 32 bits for each seed, 1 MB at most.

    Only the words come to the driver; with more seeds than the bound is meant for, the
    bitmap prunes less and the join on the seeds does the rest.
    """
    number = seeds.count()
    size = 1 << min(23, max(10, (32 * number).bit_length()))
    place = F.col("seed").bitwiseAND(size - 1)
    word = seeds.select(F.shiftright(place, 6).alias("word"), F.expr("shiftleft(1L, cast(seed & 63 as int))").alias("bit"))
    out = [0] * (size // 64)
    for row in word.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():
        out[row.word] = row.bits
    return out


def _set_in(hashes: Column, bits: list[int]) -> Column:
    """The hashes whose bit is set."""
    words = F.lit(np.array(bits, np.int64))
    size = 64 * len(bits)

    def here(h: Column) -> Column:
        word = F.get(words, F.shiftright(h.bitwiseAND(size - 1), 6).cast("int"))
        return F.bit_get(word, h.bitwiseAND(63).cast("int")) == 1

    return F.filter(hashes, here)


def unbound_phrases(
    phrases: DataFrame,
    docs: DataFrame,
    phrase_id: str = "item_id",
    phrase: str = "phrase",
    doc_id: str = "doc_id",
    text: str = "text",
    max_span: int = 64,
) -> DataFrame:
    """Which documents contain which phrases, as (phrase_id, doc_id) pairs.

    A phrase of k words is keyed by the hash of its leading run, whose length is the
    greatest power of two up to min(k, max_span). The runs of a document are tested in the
    row against a bitmap of the phrases' keys; what passes leaves as (doc, run length, hash)
    rows, reduced to the keys in use before any wide exchange. Candidates are then verified
    on the whole text, so bitmap and keys only prune. Equal phrases are
    searched once and given back to their ids at the end.
    """
    keyed = phrases.select(phrase_id, tx.word_key(phrase).alias("phrase_key")).filter("phrase_key != ''")
    distinct = keyed.select("phrase_key").distinct()
    # Phrases are few beside documents; their keys are computed once.
    sized = cut_lineage(distinct).withColumn("_words", F.split("phrase_key", " ")).withColumn(
        "span",
        F.least(
            F.lit(max_span),
            # Number of binary digits gives the power of two without rounding.
            F.pow(F.lit(2), F.length(F.bin(F.size("_words").cast("long"))) - 1).cast("int"),
        ).cast("int"),
    )
    spans = sorted(r["span"] for r in sized.select("span").distinct().collect())
    if not spans:
        return docs.sparkSession.createDataFrame(
            [], f"{phrase_id} {dict(phrases.dtypes)[phrase_id]}, {doc_id} {dict(docs.dtypes)[doc_id]}"
        )
    # A run starting at the phrase's first word: only that window is hashed.
    seeds = None
    for span in spans:
        group = sized.filter(F.col("span") == span).withColumn(
            "_words", F.slice("_words", 1, span)
        )
        group = _with_run_hashes(group, "_words", [span]).select(
            "phrase_key", "span", F.coalesce(F.element_at(f"_h{span}", 1), F.lit(0)).alias("seed")
        )
        seeds = group if seeds is None else seeds.unionByName(group)
    # Seeds as a set of bits: a run whose bit is not set is dropped inside its row.
    seeds = cut_lineage(seeds)
    bits = _bitmap(seeds)
    # The word list is computed once and kept out of the later steps.
    doc_words = docs.select(doc_id, tx.word_key(text).alias("_key")).select(
        doc_id, tx.key_words(F.col("_key")).alias("_words")
    )
    # Outer explodes and seeds without nulls: a size filter of a plain explode, or a null
    # filter of the join, would be pushed below the hash columns and so compute them again
    # inside each other.
    runs = _with_run_hashes(doc_words, "_words", spans).select(
        doc_id,
        F.explode_outer(
            F.array(
                *[
                    F.struct(
                        F.lit(span).alias("span"),
                        F.array_distinct(_set_in(F.col(f"_h{span}"), bits)).alias("runs"),
                    )
                    for span in spans
                ]
            )
        ).alias("_r"),
    )
    runs = runs.select(doc_id, F.col("_r.span").alias("span"), F.explode_outer("_r.runs").alias("seed")).select(
        doc_id, F.coalesce("span", F.lit(0)).alias("span"), F.coalesce("seed", F.lit(0)).alias("seed")
    )
    used = small_side(seeds.select("span", "seed").distinct())
    hits = runs.join(used, ["span", "seed"])
    candidates = hits.join(seeds, ["span", "seed"]).select(doc_id, "phrase_key").distinct()
    verified = (
        docs.select(doc_id, text)
        .join(candidates.select(doc_id).distinct(), doc_id, "left_semi")
        .select(doc_id, tx.word_key(text).alias("_doc"))
        .join(candidates, doc_id)
        .filter(tx.contains_words(F.col("_doc"), F.col("phrase_key")))
        .select(doc_id, "phrase_key")
    )
    return verified.join(keyed, "phrase_key").select(phrase_id, doc_id).distinct()


def corpora_overlap(held_out: DataFrame, development: DataFrame, examples: DataFrame) -> DataFrame:
    """Rows of a held-out corpus that share something with the other corpus.

    *held_out* and *development*: case_id, text, source_url, company. *examples*: text of
    prompt examples; their lines of three and more words must not be posting lines.
    """

    def shared(kind: str, left: Column, right: Column) -> DataFrame:
        known = development.select(right.alias("_v")).distinct()
        return (
            held_out.select("case_id", left.alias("_v"))
            .join(known, "_v", "left_semi")
            .select("case_id", F.lit(kind).alias("shares"))
        )

    lines = examples.select(F.explode(tx.lines("text")).alias("line")).select(
        tx.collapse_ends(F.col("line")).alias("_v")
    )
    lines = lines.filter(F.size(F.split(tx.collapse(F.col("_v")), " ")) >= 3).distinct()
    own = held_out.select("case_id", F.explode(tx.lines("text")).alias("line")).select(
        "case_id", tx.collapse_ends(F.col("line")).alias("_v")
    )
    in_examples = own.join(lines, "_v", "left_semi").select(
        "case_id", F.lit("example_line").alias("shares")
    )
    return (
        shared("text", F.sha2("text", 256), F.sha2("text", 256))
        .unionByName(shared("source_url", F.col("source_url"), F.col("source_url")))
        .unionByName(shared("company", F.col("company"), F.col("company")))
        .unionByName(in_examples)
        .distinct()
    )


def obligation_results(
    obligations: DataFrame, excerpts: DataFrame, pairs: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Which obligations each call meets, and whether its conflict pairs split.

    *obligations*: case_id, obligation_id, role, critical, alternatives (array);
    *excerpts*: case_id, replay, bucket, excerpt; *pairs*: case_id, left_id, right_id.
    Returns (case_id, replay, obligation_id, critical, in_supporting, in_conflicting) for
    obligations met, and (case_id, replay, pairs_satisfied) for calls of cases with pairs.
    """
    wanted = obligations.select(
        "case_id", "obligation_id", "role", "critical", tx.word_keys("alternatives").alias("_alts")
    )
    cited = excerpts.select("case_id", "replay", "bucket", tx.word_key("excerpt").alias("_cited"))
    joined = cited.join(wanted, "case_id")
    hit = F.exists("_alts", lambda a: tx.contains_words(F.col("_cited"), a))
    allowed = (F.col("role") == "either") | (F.col("role") == F.col("bucket"))
    met = (
        joined.filter(allowed & hit)
        .groupBy("case_id", "replay", "obligation_id", "critical")
        .agg(
            F.bool_or(F.col("bucket") == "supporting").alias("in_supporting"),
            F.bool_or(F.col("bucket") == "conflicting").alias("in_conflicting"),
        )
    )
    sides = met.select("case_id", "replay", "obligation_id", "in_supporting", "in_conflicting")
    left = sides.select(
        "case_id", "replay", F.col("obligation_id").alias("left_id"),
        F.col("in_supporting").alias("_ls"), F.col("in_conflicting").alias("_lc"),
    )
    right = sides.select(
        "case_id", "replay", F.col("obligation_id").alias("right_id"),
        F.col("in_supporting").alias("_rs"), F.col("in_conflicting").alias("_rc"),
    )
    calls = excerpts.select("case_id", "replay").distinct()
    split = (
        calls.join(pairs, "case_id")
        .join(left, ["case_id", "replay", "left_id"], "left")
        .join(right, ["case_id", "replay", "right_id"], "left")
        .withColumn(
            "_ok",
            F.coalesce(
                (F.col("_ls") & F.col("_rc")) | (F.col("_lc") & F.col("_rs")), F.lit(False)
            ),
        )
        .groupBy("case_id", "replay")
        .agg(F.bool_and("_ok").alias("pairs_satisfied"))
    )
    return met, split
