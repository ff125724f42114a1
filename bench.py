"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidemark.plans.registry import registered  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = (
    "gold_market", "gold_commerce", "silver_ticks_1s", "silver_order_events", "bronze_ticks",
    "scan_orders_cdc", "cdc_unwrap", "json_tolerant_decode", "load_layers", "latest_ticks",
    "latest_market_kpis", "table_counts", "dq_checkpoint", "freshness", "time_travel",
    "create_tables", "stream_gold_market", "stream_silver_order_events",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "tidemark-bench", f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = registered(), {}

    def run(name: str) -> float:
        begun = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begun

    run("gold_market")  # warm-up: class loading and first code generation
    for name in HEADLINE:
        seconds[name] = round(run(name), 3)
    factor = re.search(r"sf([\d.]+)$", sf_dir.rstrip("/"))
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(factor.group(1)) if factor else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
