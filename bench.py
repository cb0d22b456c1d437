"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "url_key_collapse",
    "link_rule",
    "anchors_by_parser",
    "fingerprints",
    "duplicate_matches",
    "fold_in_order",
    "phrases_in_documents",
    "bound_quotes",
    "located_excerpts",
    "paragraphs_once",
    "page_content_gate",
    "planning_preview",
    "usage_and_cost",
    "contents_as_of_run",
    "next_attempt_start",
    "merge_roots",
    "moved_sources",
    "observe_snapshots",
    "call_statuses",
    "validated_facts",
    "scope_metrics",
    "constraint_violations",
)


def main() -> None:
    from vacantia import build_session
    from vacantia.workloads import QUERIES

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One small query loads the engine before anything is timed.
    QUERIES["cost_mix"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
