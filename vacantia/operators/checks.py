"""Table constraints as violation rows: codes, uniqueness, references, conditional nulls."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia import schemas as S

#: Rows a task counts: few while the shuffle needs no sort (up to 200 partitions), else more.
ROWS, MORE_ROWS, UNSORTED = 300_000, 1_200_000, 200
#: Tasks that a hot key's rows are shared among, by the partition they are read in.
SALTS = 16

# table -> (column, allowed values); null is allowed where the column may be null.
CODES = {
    "jobs": {"status": S.JOB_STATUSES, "next_phase": S.PHASES},
    "pipeline_runs": {"stage": S.RUN_STAGES, "trigger": S.TRIGGERS, "reasoning_effort": S.EFFORTS},
    "job_attempts": {
        "trigger": S.TRIGGERS,
        "phase_reached": S.PHASES,
        "outcome": S.ATTEMPT_OUTCOMES,
        "error_category": S.ERROR_CATEGORIES,
        "reasoning_effort": S.EFFORTS,
    },
    "job_decisions": {"decision": S.DECISIONS},
    "company_runs": {"status": S.RUN_STATUSES},
}
UNIQUE = {
    "companies": (("slug",),),
    "job_urls": (("company_slug", "url"),),
    "jobs": (("id",), ("company_slug", "url_key")),
    "job_sources": (("id",), ("job_id", "url")),
    "job_contents": (("id",), ("job_id", "content_hash")),
    "job_attempts": (("id",),),
    "job_decisions": (("id",),),
    "job_results": (("id",),),
}
# table -> (columns, parent table, parent columns)
REFERENCES = {
    "job_urls": ((("company_slug",), "companies", ("slug",)),),
    "company_runs": ((("company_slug",), "companies", ("slug",)),),
    "jobs": (
        (("company_slug",), "companies", ("slug",)),
        (("merged_into_id",), "jobs", ("id",)),
    ),
    "job_sources": ((("job_id",), "jobs", ("id",)),),
    "job_contents": ((("job_id",), "jobs", ("id",)),),
    "job_attempts": (
        (("job_id",), "jobs", ("id",)),
        (("run_id",), "pipeline_runs", ("id",)),
    ),
    "job_decisions": (
        (("attempt_id", "job_id"), "job_attempts", ("id", "job_id")),
        (("content_id", "job_id"), "job_contents", ("id", "job_id")),
    ),
    "job_results": (
        (("attempt_id", "job_id"), "job_attempts", ("id", "job_id")),
        (("content_id", "job_id"), "job_contents", ("id", "job_id")),
    ),
}
REQUIRED = {
    "jobs": [f.name for f in S.JOBS.fields if not f.nullable],
    "job_sources": [f.name for f in S.JOB_SOURCES.fields if not f.nullable],
    "job_contents": [f.name for f in S.JOB_CONTENTS.fields if not f.nullable],
    "job_attempts": [f.name for f in S.JOB_ATTEMPTS.fields if not f.nullable],
    "job_decisions": [f.name for f in S.JOB_DECISIONS.fields if not f.nullable],
    "job_results": [f.name for f in S.JOB_RESULTS.fields if not f.nullable],
}


def job_rules() -> dict[str, Column]:
    """Row rules of jobs, true when broken."""
    retry = F.col("status") == "retry"
    return {
        "retry iff due time": retry != F.col("next_attempt_after").isNotNull(),
        "merged into itself": F.coalesce(F.col("merged_into_id") == F.col("id"), F.lit(False)),
        "ready but held": (F.col("status") == "ready_for_extraction")
        & ((F.col("next_phase") != "extraction") | F.col("current_attempt_id").isNotNull()),
    }


def _rows(df: DataFrame, table: str, rule: Column | str, key: Column) -> DataFrame:
    rule = F.lit(rule) if isinstance(rule, str) else rule
    return df.select(F.lit(table).alias("table"), rule.alias("rule"), key.cast("string").alias("key"))


def _parts(rows: int) -> int:
    return max(1, min(math.ceil(rows / ROWS), UNSORTED), math.ceil(rows / MORE_ROWS))


def repeated(df: DataFrame, columns: Sequence[str], parts: int) -> DataFrame:
    """Keys that stand more than once, counted in two steps by *parts* tasks each.

    Keys are nearly all different, so counting them where they are read saves nothing and
    holds every key of a large split; and small shuffles of such keys are put together to
    many millions in a task. Here the rows of a task are given by *parts*.
    """
    salted = df.select(*columns, (F.spark_partition_id() % SALTS).alias("_salt"))
    salted = salted.repartition(parts, *columns, "_salt").groupBy(*columns, "_salt").agg(F.count("*").alias("_n"))
    whole = salted.select(*columns, "_n").repartition(parts, *columns).groupBy(*columns)
    return whole.agg(F.sum("_n").alias("_n")).filter("_n > 1")


def violations(tables: dict[str, DataFrame]) -> DataFrame:
    """All violations of the given tables: table, rule, key. Checks whose parent table is
    not given are left out. Row rules of a table share one scan; its rows are counted once
    to share out keys that should be unique."""
    found = []
    for name, df in tables.items():
        key = F.col("slug" if "slug" in df.columns else "id") if {"slug", "id"} & set(df.columns) else F.col(df.columns[0])
        broken: list[Column] = []
        for column, allowed in CODES.get(name, {}).items():
            if column in df.columns:
                broken.append(F.when(F.col(column).isNotNull() & ~F.col(column).isin(*allowed), F.lit(f"{column}: not allowed")))
        for column in REQUIRED.get(name, ()):
            if column in df.columns:
                broken.append(F.when(F.col(column).isNull(), F.lit(f"{column}: null")))
        if name == "jobs":
            broken += [F.when(rule, F.lit(label)) for label, rule in job_rules().items()]
        if broken:
            flagged = df.select(key.alias("_k"), F.explode(F.array_compact(F.array(*broken))).alias("_r"))
            found.append(_rows(flagged, name, F.col("_r"), F.col("_k")))
        unique = [columns for columns in UNIQUE.get(name, ()) if set(columns) <= set(df.columns)]
        parts = _parts(df.count()) if unique else 1
        for columns in unique:
            twice = repeated(df, columns, parts)
            found.append(
                _rows(twice, name, f"unique({', '.join(columns)})", F.concat_ws("|", *columns))
            )
        for columns, parent, parent_columns in REFERENCES.get(name, ()):
            if parent in tables and set(columns) <= set(df.columns):
                known = tables[parent].select(
                    *[F.col(p).alias(c) for c, p in zip(columns, parent_columns)]
                )
                # Only parent keys are held, each once; rows pass by without a sort.
                orphans = df.dropna(subset=list(columns)).join(known.hint("shuffle_hash"), list(columns), "left_anti")
                found.append(_rows(orphans, name, f"reference({', '.join(columns)})", key))
        if name in ("job_decisions", "job_results"):
            many = df.filter("is_current").groupBy("job_id").agg(F.count("*").alias("_n")).filter("_n > 1")
            found.append(_rows(many, name, "one current row per job", F.col("job_id")))
    return reduce(DataFrame.unionByName, found)
