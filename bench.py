"""Times headline queries (or all, with BENCH_ALL=1) and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from hangtally.session import SETTINGS

HEADLINES = [
    "size_run_status", "ledger_net", "ledger_range_by_store", "stock_at_month_end", "stock_on_date", "sell_through_table",
    "sales_mart", "asof_margin", "outstanding_orders", "discount_allocation", "monthly_sales_matrix", "receipt_aging",
    "merge_upsert", "cell_diff",
]


def run(df) -> float:
    t = time.perf_counter()
    df().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
               .config("spark.ui.enabled", "false").config("spark.driver.memory", "16g")
               .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.showConsoleProgress", "false"))
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if "spark.checkpoint.dir" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    from hangtally.catalog import QUERIES
    chosen = os.environ.get("BENCH_ONLY", "").split() or (list(QUERIES) if os.environ.get("BENCH_ALL") else HEADLINES)
    times: dict[str, float] = {}
    for name in chosen:
        runs = [run(lambda: QUERIES[name](spark, folder)) for _ in range(repeats + 1)]
        # the first run warms up; it also ingests (ledger by month, SKU numbers, snapshots), once per session
        times[name] = round(statistics.median(runs[1:] or runs), 3)
        print(name, [round(r, 2) for r in runs], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "total seconds of the queries (median after one warm-up)", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                      "cores": int(cpus)}))


if __name__ == "__main__":
    main()
