"""Time the headline queries; print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set). Each query runs in
full through the ``noop`` sink (no collect), once to warm up the JVM and
then timed. ``warehouse_build`` is the one-time build of the dimension
histories that the mart queries read.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fraudlake.plans import demo  # noqa: E402
from fraudlake.plans.catalog import QUERIES  # noqa: E402
from fraudlake.session import build_session  # noqa: E402

HEADLINE = ["fraud_report_month", "fraud_report_day", "scd2_clients", "asof_chain",
            "rule3_cities", "rule4_guessing_7d", "txn_normalize", "txn_dedupe"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "8g"})
    QUERIES["txn_normalize"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times, errors = {}, {}

    def timed(name, run):
        t0 = time.perf_counter()
        try:
            run()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # keep the line whole; report which query failed
            times[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:200]}"

    # The dimension histories (three SCD2 loads of clients, first loads of
    # the rest) are built once per session, as a daily run stores them;
    # timed on their own so no query hides that cost.
    timed("warehouse_build", lambda: demo.warehouse(spark, sf_dir))
    for name in names:
        timed(name, lambda name=name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save())
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(v for v in times.values() if v), 3),
        "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus,
        **({"errors": errors} if errors else {}),
    }))


if __name__ == "__main__":
    main()
