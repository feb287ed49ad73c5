"""Benchmark the headline queries.

Reads the tables at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints one JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed in full through the ``noop`` sink (every row is
computed, nothing is collected on the driver); the reported time per query is
the median of $BENCH_REPEATS runs after one warm-up run of the whole set.

The shared test tables are first lifted into the invoice model and written
as the model's parquet tables (test scaffolding: timed once and reported as
``lift_to_model_sec``, outside the headline total); the reports then read those
tables, as they would in production.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.catalog import SPARK, decimals_to_double  # noqa: E402
from tallybook import build_session, checkpoint_dir  # noqa: E402
from tallybook.sources.lift import lift  # noqa: E402
from tallybook.sources.model import from_parquet, write_model  # noqa: E402

HEADLINE = ["rp_customers", "rp_purchase", "rp_sales", "bz_payment_status", "bz_invoice_totals",
            "bz_global_discount", "jn_or_keys", "bz_rounded_lines"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(f"local[{cpus}]", app="tallybook-bench", shuffle_partitions=cpus * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})

    model_root = f"{checkpoint_dir(spark).rstrip('/')}/bench-model-{os.getpid()}"
    t = time.perf_counter()
    write_model(lift(spark, sf_dir), model_root, files_per_table=cpus)
    lift_sec = round(time.perf_counter() - t, 3)
    model = from_parquet(spark, model_root)

    def run(key: str) -> float:
        t = time.perf_counter()
        decimals_to_double(SPARK[key](model)).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    for key in HEADLINE:  # warm-up: JIT, file listing caches
        run(key)
    times = {key: round(statistics.median(run(key) for _ in range(repeats)), 3) for key in HEADLINE}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total_median", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": cpus, "repeats": repeats, "lift_to_model_sec": lift_sec}))
    spark.stop()


if __name__ == "__main__":
    main()
