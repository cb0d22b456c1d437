"""Incremental observe: a stream of seen URLs folded into versioned job state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.operators.history import observe
from vacantia.schemas import JOB_SOURCES, JOBS
from vacantia.session import small_side
from vacantia.streaming.state import Manifests

#: A bucket with more jobs than this is split when it is next written.
BUCKET_JOBS = 200_000
#: Levels by which a bucket is split at once, and in all; one company always stays in one bucket.
SPLIT_LEVELS, MAX_LEVELS = 10, 40
WHOLE = "0-0"


def _name(levels: Column, company: str = "company_slug") -> Column:
    """Bucket of a company at a number of levels: the low bits of its hash."""
    low = F.xxhash64(company).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), levels) - 1)
    return F.concat_ws("-", levels.cast("string"), low.cast("string"))


class VersionedState:
    """Jobs and sources in buckets of companies; a version says which batch wrote each bucket.

    Buckets are leaves of a binary tree over the low bits of the company's hash. State begins
    as one bucket; a batch that writes a bucket of more than *bucket_jobs* jobs splits it, so
    buckets keep their size however many companies there are. A batch writes the buckets of
    its companies only and its manifest last. A batch that ran before is not folded again.
    The last two versions are kept.
    """

    def __init__(self, spark: SparkSession, path: str, bucket_jobs: int = BUCKET_JOBS) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.bucket_jobs = bucket_jobs
        self.manifests = Manifests(spark, path)

    def versions(self) -> list[int]:
        return self.manifests.versions()

    def buckets(self, before: int | None = None) -> list[str]:
        """The buckets that cover all companies."""
        return self.manifests.load(before).get("buckets", [WHOLE])

    def _placed(self, rows: DataFrame, buckets) -> DataFrame:
        """Rows with their *bucket* among some buckets; rows of other companies are left out."""
        names = self.spark.createDataFrame([(b,) for b in buckets], "bucket string")
        levels = sorted({int(b.split("-")[0]) for b in buckets})
        tried = rows.withColumn("bucket", F.explode(F.array(*[_name(F.lit(n)) for n in levels])))
        return tried.join(small_side(names), "bucket", "left_semi")

    def touched(self, companies: DataFrame, before: int | None = None) -> set[str]:
        """Buckets that hold some of the companies."""
        named = companies.select("company_slug").distinct()
        return {r.bucket for r in self._placed(named, self.buckets(before)).select("bucket").distinct().collect()}

    def _table(self, name: str, schema, manifest: dict, buckets) -> DataFrame:
        held = manifest.get(name, {})
        own = [f"{self.path}/{name}/batch={v}/bucket={b}" for b, v in held.items() if buckets is None or b in buckets]
        if not own:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*own)

    def read(self, before: int | None = None, buckets: set[str] | None = None) -> tuple[DataFrame, DataFrame]:
        manifest = self.manifests.load(before)
        return (
            self._table("jobs", JOBS, manifest, buckets),
            self._table("sources", JOB_SOURCES, manifest, buckets),
        )

    def _split(self, placed: DataFrame, touched: set[str]) -> dict[str, int]:
        """Levels that each bucket shall have, by its number of jobs."""
        levels = {b: int(b.split("-")[0]) for b in touched}
        for row in placed.groupBy("bucket").count().collect():
            parts = -(-row["count"] // self.bucket_jobs)
            more = min(SPLIT_LEVELS, (parts - 1).bit_length())
            levels[row.bucket] = min(MAX_LEVELS, levels[row.bucket] + more)
        return levels

    def write(self, batch: int, jobs: DataFrame, sources: DataFrame, touched: set[str]) -> None:
        """Write the *touched* buckets anew, split where they are full; all others stay as they are."""
        manifest = self.manifests.load(batch)
        placed = held = self._placed(jobs, touched).persist()
        levels = self._split(placed, touched)
        deep = self.spark.createDataFrame(sorted(levels.items()), "bucket string, levels int")
        placed = placed.join(small_side(deep), "bucket").withColumn("bucket", _name(F.col("levels"))).drop("levels")
        homes = placed.select(F.col("id").alias("job_id"), "bucket")
        leaves = set(self.buckets(batch)) - touched
        for name, depth in levels.items():
            old, low = map(int, name.split("-"))
            leaves |= {f"{depth}-{low + (part << old)}" for part in range(1 << (depth - old))}
        out = {"highest": dict(manifest.get("highest", {})), "buckets": sorted(leaves)}
        for name, table in (("jobs", placed), ("sources", sources.join(homes, "job_id").select(*JOB_SOURCES.names, "bucket"))):
            folder = f"{self.path}/{name}/batch={batch}"
            table.write.mode("overwrite").partitionBy("bucket").parquet(folder)
            written = [n[7:] for n in self.manifests.names(name, f"batch={batch}") if n.startswith("bucket=")]
            kept = {b: v for b, v in manifest.get(name, {}).items() if b not in touched}
            out[name] = {**kept, **{b: batch for b in written}}
            if written:
                schema = JOBS if name == "jobs" else JOB_SOURCES
                top = self._table(name, schema, {name: {b: batch for b in written}}, None).agg(F.max("id")).first()[0]
                out["highest"][name] = max(top or 0, out["highest"].get(name, 0))
        held.unpersist()
        self.manifests.save(batch, out)
        self.manifests.prune(lambda m: [f"{n}/batch={v}/bucket={b}" for n in ("jobs", "sources") for b, v in m.get(n, {}).items()])

    def highest(self, before: int | None = None) -> tuple[int, int]:
        found = self.manifests.load(before).get("highest", {})
        return found.get("jobs", 0), found.get("sources", 0)


def fold_batches(seen: DataFrame, state_path: str, checkpoint: str, trigger=None, bucket_jobs: int = BUCKET_JOBS):
    """Start folding a stream of (company_slug, url, seen_at) into versioned state.

    The fold keeps the first and last sighting of each URL, so redelivered, late and
    unordered sightings are folded like any other and none is dropped. A replayed batch
    starts from the version before it, so folding it again gives the same state. Only
    buckets with a company of the batch are read and written.
    """

    def fold(batch: DataFrame, batch_id: int) -> None:
        state = VersionedState(batch.sparkSession, state_path, bucket_jobs)
        if batch_id in state.versions():
            return
        rows = batch.select("company_slug", "url", "seen_at").groupBy("company_slug", "url")
        rows = rows.agg(F.min("seen_at").alias("a"), F.max("seen_at").alias("b"))
        rows = rows.select("company_slug", "url", F.explode(F.array("a", "b")).alias("seen_at")).persist()
        touched = state.touched(rows, before=batch_id)
        if touched:
            jobs, sources = state.read(before=batch_id, buckets=touched)
            new_jobs, new_sources = observe(jobs, sources, rows, highest=state.highest(batch_id))
            state.write(batch_id, new_jobs, new_sources, touched)
        rows.unpersist()

    writer = seen.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
