"""Corpus cleaning: each stage is one operator of vacantia.llm over all its predecessor kept.

Stages read no columns but those of documents; others, also of clashing names, are left out.
An empty table passes through all of them. When a stage begins, its predecessor's rows are
written, so the executors give up what that one had sent to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.llm import decontam, langid, linededup, pieces, simhash
from vacantia.llm.common import release, stored, table
from vacantia.llm.workloads import PIECES

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A language below this share of the evidence is not trusted.
LEAST_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text is in a learned language, with that language.

    Texts that are null or have no letter go, and so do those no language of which has half
    of the evidence. The model learns from the languages that the rows state.
    """
    release(keep=True)
    model = langid.fit(docs.filter(~langid.held_out()))
    told = docs.select(*COLUMNS).withColumn("p", langid.predicted(model, docs))
    kept = told.filter((F.col("p.lang") != langid.UNDECIDED) & (F.col("p.score") >= LEAST_SCORE))
    return kept.withColumn("lang", F.col("p.lang")).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that stand in many documents; a text of which nothing is left goes."""
    release(keep=True)
    clean = linededup.dedup_lines(docs.select(*COLUMNS))
    emptied = (F.col("n_dropped") > 0) & (F.btrim("kept_text", F.lit(" \t\n\x0b\x0c\r")) == "")
    return (
        clean.filter(~emptied)
        .withColumn("text", F.col("kept_text"))
        .withColumn("n_chars", F.char_length("kept_text").cast("long"))
        .select(*COLUMNS)
    )


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: its least doc_id.

    Most pairs are met by MinHash bands rather than by the fingerprints' balls: at similarity
    0.8 fingerprints are about 10 bits apart. All are verified exactly, in the order of doc_id
    (null last). Null and empty texts are copies of each other, and so are repeated rows.
    """
    release(keep=True)
    return simhash.without_near_duplicates(docs.select(*COLUMNS), width=5, radius=4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; null and empty texts, ties and repeated rows stay.

    Texts of any length are compared whole.
    """
    release(keep=True)
    return decontam.without_benchmark(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_ids, lossless) of each text; null and empty texts have no ids, repeated rows stay."""
    release(keep=True)
    return pieces.encoded(docs, PIECES, dropout=0.1, seed=42)


STAGES = [
    ("language_id", language),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("piece_encoding", encoding),
]

#: A language model, fingerprints and merges cannot be said in SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
        release()
    return docs
