"""Headline queries at $BENCH_SF_DIR: one warm-up, then the median of three runs.

Prints one JSON line. Results go to Spark's no-op sink, so every row of a query
is computed and nothing is pulled to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quayload.plans.catalog import REGISTRY  # noqa: E402
from quayload.session import local_session  # noqa: E402

# Query and the table whose rows it works through.
HEADLINE = {
    "load_readiness": "lineitem",
    "conform_table": "lineitem",
    "conform_datetime2": "events",
    "conform_datetimeoffset": "events",
    "conform_nvarchar": "documents",
    "plan_columns": "documents",
    "observed_decimal_shape": "lineitem",
    "rejected_batches": "events",
    "running_load_stats": "events",
    "payload_bytes": "documents",
    "pack_ranges": "documents",
    "pack_ranges_unbounded": "documents",
    "chunk_batches_hot_key": "lineitem",
    "roundtrip_diff": "lineitem",
    "file_io_deltas": "lineitem",
    "table_load": "events",
    "shape_tpch_lineitem_like": "events",
}


def run(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = sys.argv[1:] or list(HEADLINE)
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    rows = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in set(HEADLINE.values())}
    seconds, rates = {}, {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(repeats)), 4)
        if name in HEADLINE:
            rates[name] = round(rows[HEADLINE[name]] / seconds[name])
    print(json.dumps({
        "metric": "total_median_seconds",
        "value": round(sum(seconds.values()), 4),
        "unit": "sec",
        "queries": seconds,
        "rows_per_second": rates,
        "input_rows": rows,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cores": cpus,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
