"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the number of cores and
``BENCH_QUERIES`` an optional comma-separated choice of queries (``all`` for
every one). Each query is computed whole and its rows discarded.
"""

from __future__ import annotations

import json
import os
import sys
import time

from feedsieve.plans.queries import queries
from feedsieve.session import local_session

HEADLINE = (
    "typed_feed",
    "collapse_retries",
    "trade_upsert",
    "rule_report",
    "validation_verdict",
    "rule_labels",
    "rule_trade_id_unique",
    "rule_agreement",
    "quarantine_rows",
    "quarantine_upsert",
    "valid_trades",
    "reason_counts",
    "orphan_trades",
    "orphan_keys",
    "run_history",
    "daily_pnl",
    "daily_pnl_by_asset_class",
    "daily_position",
    "coverage_gap",
    "partition_report",
    "scoped_report",
    "touched_duplicates",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    chosen = os.environ.get("BENCH_QUERIES", "")
    spark = local_session("bench", cores, **{"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    names = list(known) if chosen == "all" else (chosen.split(",") if chosen else HEADLINE)

    def run(name: str) -> float:
        begun = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begun

    run("rule_report")  # starts the JVM's code paths; not timed
    seconds = {}
    for name in names:
        seconds[name] = round(run(name), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
