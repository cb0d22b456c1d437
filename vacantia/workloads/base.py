"""Registry of runnable queries over the given tables, each with its check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vacantia.session import spread

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Tables of long texts, whose work is worth sharing out, with their keys.
TEXT_KEYS = {"documents": "doc_id", "pages": "page_id"}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


class Tables:
    """Lazy readers of one data folder: ``t.pages`` is the pages DataFrame."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return spread(table, TEXT_KEYS[name]) if name in TEXT_KEYS else table


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables`; *sql* must give the same rows."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if sql is not None:
            CHECKS[name] = sql
        return function

    return register
