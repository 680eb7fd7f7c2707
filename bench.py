"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (every row is
computed, nothing is collected to the driver).  One warm-up pass, then the
best of ``$BENCH_RUNS`` (default 2) timed runs per query.  Prints one JSON
line: {"metric", "value" (sum of per-query seconds), "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tessera.queries import load_all  # noqa: E402
from tessera.session import get_spark  # noqa: E402

HEADLINE = [
    "customer_analytics", "product_metrics", "daily_metrics", "top_products",
    "quality_report", "sales_trend", "monthly_summary", "word_count_ws", "word_count_space",
    "quotes_clean", "sql_rank", "sql_dept_stats", "region_sales", "category_stats",
    "join_lookup", "agg_group_multi", "agg_count_distinct", "top_k", "gen_orders",
    "json_purchase_totals", "line_value", "cln_dedup_key", "snk_dynamic_overwrite",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = get_spark(f"local[{cpus}]", int(cpus) * 2,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                             # each table is one file of one row group here
                             "spark.tessera.spread": cpus})
    registry = load_all()
    times = {}
    for name in names:
        q = registry[name]
        run(q.fn(spark, sf_dir))            # warm-up (JIT, file listing cache)
        best = float("inf")
        for _ in range(runs):
            t0 = time.perf_counter()
            run(q.fn(spark, sf_dir))
            best = min(best, time.perf_counter() - t0)
        times[name] = round(best, 3)
        print(f"# {name}: {times[name]:.3f}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
