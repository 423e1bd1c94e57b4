"""Seconds per headline query on local cores; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (cores), BENCH_RUNS (runs per query, best one counts),
BENCH_QUERIES (comma-separated names instead of the headline set).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from finlake.queries import QUERIES  # noqa: E402
from finlake.session import get_session  # noqa: E402

HEADLINE = (
    "silver_income", "silver_quotes", "silver_dividends", "silver_from_zip", "clean_table", "normalize_text",
    "dedupe_rows", "dim_company", "fact_balance", "fact_income", "fact_equity", "fact_quotes", "fact_dividends",
    "current_ratio", "dividends_by_quarter", "gold_build", "null_profile", "duplicate_keys", "quality_summary", "quality_sweep",
    "latest_snapshot", "replace_year", "layout_migration", "year_scan", "export_parquet",
)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = get_session(
        "finlake-bench", f"local[{cpus}]", **{
            "spark.driver.memory": "12g", "spark.sql.shuffle.partitions": cpus, "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/lineitem.parquet").count()
    seconds = {}
    for name in names:
        best = None
        for _ in range(runs):
            started = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - started
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": Path(sf).name}))
    spark.stop()


if __name__ == "__main__":
    main()
