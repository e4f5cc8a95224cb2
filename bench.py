"""Benchmark: time the headline queries on one scale factor.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_SHUFFLE_PARTITIONS`` (default one per core; on a cluster
size it to the data, roughly 128-256 MB of shuffle per partition),
``BENCH_QUERIES`` (comma list, default the headline set), ``BENCH_CONF``
(extra Spark settings, ``key=value`` pairs separated by commas).
Each query is planned and run to completion into Spark's ``noop`` sink (the
whole result is computed, nothing is collected).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starloom.plans.catalog import QUERIES  # noqa: E402
from starloom.session import build_session  # noqa: E402

HEADLINE = [
    "stg_orders",
    "shipping_dim",
    "customer_dim",
    "geo_dim",
    "product_dim",
    "calendar_dim",
    "sales_fact",
    "returns_dim",
    "sales_fact_with_returns",
    "sales_fact_with_managers",
    "manager_assignment_audit",
    "manager_audit_fanout",
    "row_count_reconciliation",
    "pk_violations",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus))
    extra = {"spark.driver.memory": "8g",
             # let the cleaner drop checkpoints of finished queries promptly
             "spark.cleaner.periodicGC.interval": "1min"}
    extra.update(dict(kv.split("=", 1) for kv in os.environ.get("BENCH_CONF", "").split(",") if kv))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=partitions, extra=extra)
    # Warm the JVM (class loading, codegen caches) on a query outside the timed set.
    QUERIES["managers_dim"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    QUERIES["stg_orders"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "shuffle_partitions": partitions,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
