"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``), ``BENCH_CPUS`` (default 8) and ``BENCH_QUERIES``
(comma-separated names, ``all`` for every query) set what runs.  Results go to Spark's noop sink,
so every row is computed and none is collected.  Each query runs once to warm up (code generation,
Python workers) and then twice; the better time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from jobtide.queries import ALL
from jobtide.session import build_session

HEADLINE = (
    "clean_text", "dictionary_tags", "skill_tags", "top_tags", "tag_share_by_group",
    "tag_presence_matrix", "salary_extract", "seniority_cascade", "experience_level",
    "workload_parse", "workload_share", "geo_resolve", "city_extract", "rule_classifier",
    "rule_trace", "rule_trace_first", "classification_audit", "dedup_first", "duplicate_rows", "coverage_log",
    "macro_join_region", "macro_join_industry", "region_vs_macro", "latest_k_periods",
    "jsonstat_decode", "html_facts", "html_text", "html_links", "html_cards", "kpi_row",
    "missingness", "describe_numeric", "group_median", "boxplot_stats", "rate_by_group",
    "pivot_counts", "semi_topk", "facet_options", "facet_filter", "exec_summary", "csv_roundtrip",
)


def run(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query.run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(ALL) if chosen == "all" else chosen.split(",") if chosen else list(HEADLINE)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        query = ALL[name]
        run(query, spark, sf_dir)
        times[name] = round(min(run(query, spark, sf_dir) for _ in range(2)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
