"""Shared helpers: readers, reliable tables between steps, bounded Arrow batches, components."""

from __future__ import annotations

import uuid

from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.session import scratch_folder

#: Bounds of one Arrow batch; a batch with whole texts must fit a worker many times over.
BATCH_ROWS, BATCH_BYTES = 20_000, 2 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; only Spark's reader touches the path."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the rows and the bytes of Arrow batches for the Python stages of this session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_SHARED: list[Broadcast] = []


def share(spark: SparkSession, value) -> Broadcast:
    """A broadcast of a value of bounded size that :func:`release` can give up."""
    made = spark.sparkContext.broadcast(value)
    _SHARED.append(made)
    return made


def release(keep: bool = False) -> None:
    """Give up what :func:`share` has sent since the last call.

    Call it once every table that needs it is written; *keep* leaves the driver's copy, so
    that a table which is not written after all can still be made.
    """
    for made in _SHARED:
        try:
            made.unpersist() if keep else made.destroy()
        except Exception as gone:  # a stopped session has given everything up itself
            if "stopped" not in str(gone).lower() and "NoneType" not in str(gone):
                raise
    if not keep:
        _SHARED.clear()


def stored(df: DataFrame) -> DataFrame:
    """*df* as a Parquet table in the shared checkpoint folder: lineage ends there.

    A lost executor costs its own tasks only; later reads start from the files.
    """
    path = f"{scratch_folder(df.sparkSession)}/t-{uuid.uuid4().hex[:8]}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table made by :func:`stored` once nothing reads it any more."""
    path = getattr(df, "_stored_at", None)
    if path:
        jvm = df.sparkSession._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(
            target, True
        )


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftright(F.xxhash64("a", "b"), 20))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of *edges* (a, b: long): root is the component's least node.

    Alternating large and small stars: each round links every node to the least neighbour
    of its neighbourhood, by minimum aggregates and joins, until no edge changes. Rounds
    grow with the logarithm of the longest chain; edges never multiply. Nothing reaches
    the driver but a count and a sum.
    """
    both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = stored(both.filter("a <> b").distinct())
    mark = _mark(now)
    while mark[0]:
        flow = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = flow.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = (
            flow.join(least, "a")
            .filter("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .filter("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b")))
            .distinct()
        )
        after = stored(small)
        discard(now)
        now, before, mark = after, mark, _mark(after)
        if mark == before:
            break
    roots = now.groupBy("a").agg(F.min("b").alias("root"))
    return roots.select(F.col("a").alias("node"), "root").unionByName(
        roots.select(F.col("root").alias("node"), "root").distinct()
    )
