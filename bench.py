"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.registry import QUERIES  # noqa: E402
from tidelog.session import build_session  # noqa: E402

HEADLINE = (
    "bronze_flatten",
    "silver_latest",
    "silver_latest_max_by",
    "gold_email_domain",
    "gold_daily_changes",
    "gold_daily_incremental",
    "op_mix",
    "domain_share",
    "silver_kpis",
    "insert_if_absent",
    "merge_upsert_delete",
    "merge_ordered",
    "silver_incremental",
    "bronze_append_idempotent",
    "stream_silver",
    "window_changes_5m",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        {
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    QUERIES["gold_email_domain"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.monotonic()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - started, 3)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    match = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(match.group(1)) if match else None,
                "cpus": int(cpus),
                "events": events,
                "events_per_sec": {n: round(events / s) for n, s in seconds.items() if s},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
