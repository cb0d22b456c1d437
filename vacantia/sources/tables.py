"""Readers with explicit schemas: snapshots, catalog, boards, evaluation cases, recordings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia import schemas as S
from vacantia.functions.text import slug
from vacantia.operators.answers import parse_answers, request_key


def url_snapshot(spark: SparkSession, path: str, company_slug: str | None = None) -> DataFrame:
    """Current posting URLs in emitted order; the company filter prunes partitions."""
    urls = spark.read.parquet(path)
    if company_slug is not None:
        urls = urls.filter(F.col("company_slug") == company_slug)
    return urls.orderBy("company_slug", "ord")


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """Company catalog with nested rules; the slug is derived from the name."""
    return spark.read.schema(S.CATALOG).json(path).withColumn("slug", slug("name"))


def _packed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Folder and whole text of each file *name* that ``write_keyed`` stored."""
    return spark.read.schema("folder string, value string").parquet(f"{path}/{name}")


def _named_json(spark: SparkSession, schema, path: str, name: str, stored: bool) -> DataFrame:
    """Typed JSON files *name* with the name of their folder; *stored*: packed by ``write_keyed``."""
    if stored:
        return _packed(spark, path, name).select("folder", F.from_json("value", schema).alias("_f")).select("folder", "_f.*")
    reader = spark.read.schema(schema).option("multiLine", "true").option("recursiveFileLookup", "true")
    return reader.option("pathGlobFilter", name).json(path).withColumn("folder", _folder())


def _folder() -> Column:
    """Key of the file that is read: the name of its folder."""
    return F.element_at(F.split(F.input_file_name(), "/"), -2)


def board_snapshots(spark: SparkSession, path: str, stored: bool = False) -> DataFrame:
    """Frozen board metadata, one file per board; the folder name is the slug."""
    return _named_json(spark, S.BOARD_SNAPSHOTS, path, "metadata.json", stored).withColumn("slug", F.col("folder")).drop("folder")


def snapshot_pages(boards: DataFrame) -> DataFrame:
    """Stored page files of each board (pages, states and frames): slug, file, url."""
    pieces = F.concat(
        F.coalesce("pages", F.array().cast("array<struct<file:string,url:string>>")),
        F.coalesce("frames", F.array().cast("array<struct<file:string,url:string>>")),
        F.coalesce(
            F.transform("states", lambda s: F.struct(s["file"].alias("file"), s["url"].alias("url"))),
            F.array().cast("array<struct<file:string,url:string>>"),
        ),
        F.coalesce(
            F.flatten(F.transform("states", lambda s: s["frames"])),
            F.array().cast("array<struct<file:string,url:string>>"),
        ),
    )
    single = F.array(
        F.struct(F.lit("page.html").alias("file"), F.coalesce("top_url", "job_board_url").alias("url"))
    )
    return boards.select(
        "slug", F.explode(F.when(F.size(pieces) > 0, pieces).otherwise(single)).alias("_p")
    ).select("slug", "_p.*")


def evaluation_cases(spark: SparkSession, path: str, stored: bool = False) -> DataFrame:
    """Cases of an evaluation corpus: case_id, content, decision, evidence.

    Each case is a folder with content.txt and one or two label files; the parts meet on
    the folder name. *stored*: the parts were packed by ``write_cases``, which ends each
    content with a line break of its own.
    """
    if stored:
        content = _packed(spark, path, "content.txt")
        content = content.select(F.col("folder").alias("case_id"), F.regexp_replace("value", r"\n\z", "").alias("content"))
    else:
        reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "content.txt")
        content = reader.text(path, wholetext=True).select(_folder().alias("case_id"), F.col("value").alias("content"))

    def labels(name: str, schema, alias: str) -> DataFrame:
        rows = _named_json(spark, schema, path, name, stored)
        return rows.select("folder", F.struct(*schema.names).alias(alias)).withColumnRenamed("folder", "case_id")

    return content.join(
        labels("expected_eligibility.json", S.EXPECTED_DECISION, "decision"), "case_id"
    ).join(labels("expected_evidence.json", S.EXPECTED_EVIDENCE, "evidence"), "case_id", "left")


def recordings(spark: SparkSession, path: str, stored: bool = False) -> DataFrame:
    """Recorded answers, one JSON file each, with the file's key (stored: the folder's)."""
    read = _named_json(spark, S.RECORDING, path, "recordings.json" if stored else "*.json", stored)
    name = F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1)
    return read.withColumn("file_key", F.col("folder") if stored else name).drop("folder")


def usable_recordings(
    recorded: DataFrame, cases: DataFrame, model: str, prompt_hash: str, effort: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Recordings that keep the contract, with typed answers, and those that break it.

    The contract ties a recording to model, prompt, case, content and replay by a key over
    exactly these fields.
    """
    known = cases.select("case_id", F.sha2("content", 256).alias("_hash"))
    fields = {
        "model": F.col("requested_model"),
        "eligibility_prompt_hash": F.col("eligibility_prompt_hash"),
        "case_id": F.col("case_id"),
        "source_hash": F.col("source_content_sha256"),
        "replay": F.col("replay"),
        "reasoning_effort": F.col("reasoning_effort"),
    }
    joined = recorded.join(known, "case_id", "left")
    kept = (
        (F.col("recording_version") == 3)
        & (F.col("requested_model") == model)
        & (F.col("eligibility_prompt_hash") == prompt_hash)
        & F.col("reasoning_effort").eqNullSafe(F.lit(effort))
        & (F.col("source_content_sha256") == F.col("_hash"))
        & (F.col("key") == F.col("file_key"))
        & (F.col("key") == request_key(**fields))
    )
    typed = parse_answers(joined.withColumn("_kept", F.coalesce(kept, F.lit(False))))
    sound = (
        F.when(F.col("status") == "parsed", F.col("parsed"))
        .when(F.col("status") == "invalid_response", F.col("raw_json").isNull())
        .otherwise(False)
    )
    typed = typed.withColumn("_kept", F.col("_kept") & F.coalesce(sound, F.lit(False)))

    def count(name: str):
        return F.when(F.col(name) >= 0, F.col(name))

    good = typed.filter("_kept").select(
        "case_id",
        "replay",
        F.col("status").alias("call_status"),
        "answer",
        F.coalesce("response_model", "requested_model").alias("model"),
        count("prompt_tokens").alias("prompt_tokens"),
        count("completion_tokens").alias("completion_tokens"),
        F.coalesce(count("latency_ms"), F.lit(0)).alias("latency_ms"),
    )
    return good, typed.filter("not _kept").select("case_id", "replay", "file_key")
