"""

Each query runs once to warm up and then ``BENCH_RUNS`` times (default 1); the
median counts. Shared runs are forgotten before every timing, so a query that
reports on the whole run pays for the whole run. The given tables are one file of
one row group each, which one task would read; so they are first copied, untimed,
to as many files as there are cores, as large tables are laid out.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pagesieve.plans import queries
from pagesieve.sources.session import session
from pagesieve.sources.workspace import clean, new_folder

HEADLINE = [
    "capture_scan", "job_request_scan", "sensitive_field_gate", "robots_url_decision",
    "anchor_explode", "visible_text", "pagination_signals", "price_candidates_count",
    "field_evidence_generic", "source_profile", "scrape_route", "json_project_fields",
    "xml_project_fields", "html_links", "in_page_dedup", "bounded_crawl", "squeeze_whitespace",
    "url_resolve", "price_clean", "items_per_page", "store_insert_or_ignore", "run_summary",
]


def spread(spark, sf_dir: str, files: int) -> str:
    """A copy of the tables the queries read, in several files each."""
    to = new_folder(spark, "bench")
    for name in ("pages", "part", "lineitem", "orders", "documents"):
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(files).write.parquet(f"{to}/{name}.parquet")
    return to


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = session(
        "pagesieve-bench", f"local[{cpus}]", spark_sql_shuffle_partitions=cpus,
        spark_driver_memory="16g", spark_ui_enabled="false", spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = spread(spark, sf_dir, int(cpus))
    times: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            queries.forget_runs()
            start = time.perf_counter()
            queries.QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[-runs:]), 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    clean(spark)
    print(
        json.dumps(
            {
                "metric": "sum of median query times",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
