"""Time the headline queries; print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 4),
BENCH_QUERIES (optional comma list), BENCH_CHECKPOINT_DIR (for intermediate tables).  Each query is run to completion with
the ``noop`` sink, so nothing is collected on the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "filter_stats",
    "drop_reasons",
    "metric_summary",
    "dropped_examples",
    "quality_filter",
    "exact_dedup",
    "minhash",
    "near_dedup",
    "verified_near_dedup",
    "dup_examples",
    "prefix_sum",
    "packed_blocks",
    "packing_report",
    "bpe_vocab",
    "bpe_encode",
    "fertility",
    "packed_blocks_bpe",
    "batch_plan",
    "stream_filter",
    "stream_ingest",
    "stream_near_dedup",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE

    from kiln.plans.catalog import QUERIES
    from kiln.session import local_session

    partitions = 2 * int(cpus) if cpus.isdigit() else 8
    spark = local_session(cpus, shuffle_partitions=partitions, checkpoint_dir=os.environ.get("BENCH_CHECKPOINT_DIR"))
    # Warm the JVM once (class loading, codegen caches) on a tiny read.
    spark.read.parquet(f"{sf_dir}/region.parquet").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
