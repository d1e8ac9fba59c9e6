"""Time the headline queries; one JSON line on standard output.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the threads. Each query runs once
to warm up and then ``BENCH_RUNS`` times; the best time counts. ``duckdb`` has the times
of the same SQL there, where that engine is installed: the only baseline there is.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from poolweave.catalog import ORACLES, QUERIES  # noqa: E402
from poolweave.session import build_session  # noqa: E402

HEADLINES = (
    "prefer_esma",
    "prefer_esma_nullsafe",
    "pool_universe",
    "dedup_counts",
    "overlap_months",
    "ue_collateral_join",
    "ue_collateral_pairs",
    "ue_collateral_stats",
    "file_pairs",
    "country_detect",
    "country_rows",
    "non_empty",
    "sorted_panel",
    "sort_violations",
    "unique_keys",
    "distinct_columns",
    "loan_checksum",
    "dup_groups",
    "loan_series",
    "input_output_diff",
    "integrity_report",
    "ordered_row_checksum",
    "reconciled_diff",
    "overlap_months_of_bits",
    "resume_pending",
)


def seconds(spark, name: str, tables: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def other_engine(tables: str, cpus: str, runs: int) -> dict[str, float]:
    """Best time of each query's SQL in DuckDB, results fetched into memory."""
    try:
        import duckdb
    except ImportError:
        return {}
    con = duckdb.connect(config={"threads": int(cpus)})
    con.execute("SET enable_progress_bar = false")
    for file in sorted(Path(tables).glob("*.parquet")):
        con.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")

    def once(sql: str) -> float:
        start = time.perf_counter()
        con.execute(sql).fetchall()
        return time.perf_counter() - start

    return {n: round(min(once(ORACLES[n]) for _ in range(runs)), 3) for n in HEADLINES if n in ORACLES}


def main() -> None:
    tables = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "poolweave-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINES:
        seconds(spark, name, tables)
        times[name] = round(min(seconds(spark, name, tables) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "duckdb": other_engine(tables, cpus, runs),
                "sf": float(Path(tables).name.removeprefix("sf") or 0),
            }
        )
    )


if __name__ == "__main__":
    main()
