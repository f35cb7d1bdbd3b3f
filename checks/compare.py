"""Run every registered query and its SQL side by side and report differences."""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.oracles import ORACLES  # noqa: E402
from checks.registry import QUERIES  # noqa: E402
from tidelog.session import build_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events".split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS FROM read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def normalised(columns: list[str], rows) -> list[tuple]:
    """Rows as comparable text, columns by name, order of rows ignored."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_text(row[i]) for i in order) for row in rows)


def _text(value) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    return repr(value) if value is None else f"{type(value).__name__}:{value}"


def compare(spark, connection, sf_dir: str, name: str) -> tuple[bool, str]:
    started = time.monotonic()
    df = QUERIES[name](spark, sf_dir)
    ours = normalised(df.columns, df.collect())
    seconds = time.monotonic() - started
    if name not in ORACLES:
        return bool(ours), f"{len(ours)} rows, {seconds:.1f} s, no oracle"
    result = connection.sql(ORACLES[name])
    theirs = normalised(result.columns, result.fetchall())
    if sorted(df.columns) != sorted(result.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(result.columns)}"
    if ours == theirs:
        return True, f"{len(ours)} rows, {seconds:.1f} s"
    extra = [r for r in ours if r not in set(theirs)][:3]
    missing = [r for r in theirs if r not in set(ours)][:3]
    return False, f"{len(ours)} vs {len(theirs)} rows; only Spark {extra}; only SQL {missing}"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    parser.add_argument("--cpus", default="8")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = build_session(
        "compare",
        {
            "spark.master": f"local[{args.cpus}]",
            "spark.sql.shuffle.partitions": args.cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(args.sf_dir)
    failed = []
    for name in args.names or QUERIES:
        ok, note = compare(spark, connection, args.sf_dir, name)
        print(f"{'ok  ' if ok else 'FAIL'} {name}: {note}", flush=True)
        if not ok:
            failed.append(name)
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
