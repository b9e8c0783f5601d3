"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores.
BENCH_ALL=1 times every registered query, BENCH_DUCKDB=1 adds the time DuckDB
takes for the same SQL.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from moodtape.plans.catalog import QUERIES  # noqa: E402
from moodtape.plans.oracle import ORACLE  # noqa: E402
from moodtape.session import build_session  # noqa: E402
from moodtape.sources.star import SCAN_TASKS  # noqa: E402

HEADLINE = [
    "price_bars",
    "sentiment_daily",
    "lag_correlation",
    "optimal_lag",
    "backfill_correlation",
    "sentiment_price_view",
    "sector_sentiment",
    "latest_correlations",
    "latest_sentiment",
    "sector_overview",
    "period_summary",
    "quality_report",
    "dedup_first",
    "unscored",
    "keyword_match",
    "clean_text",
    "html_text",
    "lexicon_scores",
    "batch_scoring",
    "upsert_replace",
]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.conf.set(SCAN_TASKS, cpus)  # the files have one row group each
    spark.sparkContext.setLogLevel("ERROR")
    result = {}
    for name in names:
        def once(name=name):
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

        once()
        result[name] = round(statistics.median(timed(once) for _ in range(runs)), 3)
        print(name, result[name], file=sys.stderr, flush=True)
    line = {
        "metric": "total seconds over the headline queries, median of warm runs",
        "value": round(sum(result.values()), 3),
        "unit": "sec",
        "queries": result,
        "sf": folder.rsplit("sf", 1)[-1],
    }
    if os.environ.get("BENCH_DUCKDB"):
        sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "tests"))
        from oracle_compare import connect

        con = connect(folder)
        con.execute(f"set threads to {cpus}")
        line["duckdb"] = {
            n: round(statistics.median(timed(lambda n=n: con.execute(ORACLE[n]).fetchall()) for _ in range(runs)), 3)
            for n in names
            if n in ORACLE
        }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
