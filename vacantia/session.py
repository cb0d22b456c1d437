"""Session set-up, reliable lineage cuts and size-checked broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A broadcast side is accepted only when it has been counted below this bound.
BROADCAST_ROW_BOUND = 200_000


def build_session(app: str = "vacantia", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; the cluster's own settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Files of lineage cuts go when nothing refers to them any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # Pages are wide rows: keep one Arrow batch of HTML small.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _checkpoint_ready(spark: SparkSession) -> None:
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir", None
    )
    if context.getCheckpointDir() is not None:
        return
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="vacantia-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder on this cluster")


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder, for streams that write and end."""
    _checkpoint_ready(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/run-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the cluster's shared folder (survives lost executors)."""
    _checkpoint_ready(df.sparkSession)
    return df.checkpoint(eager=True)


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROW_BOUND) -> DataFrame:
    """Broadcast *df* only after counting it below the bound; else leave it to AQE."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Share the rows of a scan with fewer partitions than cores among all cores.

    Few large files (or row groups) would leave text work to a few tasks. A scan that
    already has a partition per core is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
