"""Attempt liveness on a stream of starts and finishes, kept as durable runs of reduced rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.streaming.state import Manifests

SCHEMA = "attempt_id long, job_id long, started_at timestamp, ended_at timestamp, latest timestamp"
#: Runs that are merged into one.
FANOUT = 8


def _reduced(rows: DataFrame) -> DataFrame:
    return rows.groupBy("attempt_id").agg(
        F.min("job_id").alias("job_id"),
        F.min("started_at").alias("started_at"),
        F.min("ended_at").alias("ended_at"),
        F.max("latest").alias("latest"),
    )


class AttemptRuns:
    """Runs of one row per attempt; a batch adds a run, and every few runs become one.

    Reducing is idempotent and takes rows in any order, so late and repeated events change
    nothing they should not. A batch writes its own rows, not the whole state.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.manifests = Manifests(spark, path)

    def _rows(self, runs: list[str]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*[f"{self.path}/{r}" for r in runs])

    def add(self, batch: int, events: DataFrame) -> None:
        if batch in self.manifests.versions():
            return
        at = F.col("at").cast("timestamp")
        rows = events.select(
            F.col("attempt_id").cast("long").alias("attempt_id"),
            F.col("job_id").cast("long").alias("job_id"),
            F.when(F.col("kind") == "started", at).alias("started_at"),
            F.when(F.col("kind") == "finished", at).alias("ended_at"),
            at.alias("latest"),
        )
        # Levels as digits: a run of level k holds FANOUT ** k batches.
        runs = self.manifests.load(batch).get("runs", [])
        _reduced(rows).write.mode("overwrite").parquet(f"{self.path}/level=0/batch={batch}")
        runs = [*runs, f"level=0/batch={batch}"]
        level = 0
        while len(same := [r for r in runs if r.startswith(f"level={level}/")]) >= FANOUT:
            level += 1
            _reduced(self._rows(same)).write.mode("overwrite").parquet(f"{self.path}/level={level}/batch={batch}")
            runs = [r for r in runs if r not in same] + [f"level={level}/batch={batch}"]
        self.manifests.save(batch, {"runs": runs})
        self.manifests.prune(lambda m: m.get("runs", []))

    def read(self) -> DataFrame:
        """One row per attempt: first start, first finish, latest event."""
        return _reduced(self._rows(self.manifests.load().get("runs", [])))


def fold_attempts(events: DataFrame, state_path: str, checkpoint: str, trigger=None):
    """Start folding a stream of (attempt_id, job_id, kind, at) into :class:`AttemptRuns`."""

    def fold(batch: DataFrame, batch_id: int) -> None:
        AttemptRuns(batch.sparkSession, state_path).add(batch_id, batch)

    writer = events.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def attempt_outcomes(attempts: DataFrame, stale_seconds: int, now=None) -> DataFrame:
    """Outcome of each attempt: (attempt_id, job_id, outcome, started_at, ended_at).

    ``finished`` when the finish comes within *stale_seconds* of the start, ``interrupted``
    once *now* (the latest event by default) passes that bound without one. A finish after
    the bound is reported besides as ``late_finish`` and not applied. A finish whose start
    is unknown is ``unmatched``. One row per attempt and outcome, however often events come.
    """
    if now is None:
        clock = attempts.agg(F.max("latest").alias("_now"))  # one row
    else:
        clock = attempts.sparkSession.range(1).select(F.lit(now).cast("timestamp").alias("_now"))
    rows = attempts.crossJoin(F.broadcast(clock)).withColumn(
        "bound", F.col("started_at") + F.expr(f"interval {int(stale_seconds)} seconds")
    )
    ended = F.when(F.col("ended_at") >= F.col("started_at"), F.col("ended_at"))
    rows = rows.withColumn("ended", ended)
    known = F.col("started_at").isNotNull()
    kinds = {
        "finished": (known & (F.col("ended") <= F.col("bound")), F.col("ended")),
        "interrupted": (
            known & (F.col("bound") < F.col("_now")) & (F.col("ended").isNull() | (F.col("ended") > F.col("bound"))),
            F.col("bound"),
        ),
        "late_finish": (known & (F.col("ended") > F.col("bound")), F.col("ended")),
        "unmatched": (~known & F.col("ended_at").isNotNull(), F.col("ended_at")),
    }
    parts = [
        rows.filter(F.coalesce(test, F.lit(False))).select("attempt_id", "job_id", F.lit(kind).alias("outcome"), "started_at", at.alias("ended_at"))
        for kind, (test, at) in kinds.items()
    ]
    return reduce(DataFrame.unionByName, parts)
