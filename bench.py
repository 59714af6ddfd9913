"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed completely with the ``noop`` sink (no driver collect).
Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import tempfile  # noqa: E402
import uuid  # noqa: E402

from shelfwise.plans import context, pipeline, registry, storage  # noqa: E402
from shelfwise.session import checkpoint_dir, local_session  # noqa: E402

HEADLINE = [
    "V02_duplicate_items_in_location_view", "V07_collection_value_branch_view", "V09_hold_title_view",
    "V11_ld_compare_view", "V13_book_connections_view", "V14_two_months_leased_item_view",
    "V18_dup_at_location_view", "V22_circ_agg_branch_view", "V25_collection_detail_view",
    "Q02_top_holds", "R04_bib_holds", "E01_facet_counts", "R14_search_bibs", "R14_search_documents",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus != "*" else 16)
    times = {}
    # Landing and snapshot live under $BENCH_ROOT or spark.checkpoint.dir; only a local
    # master may fall back to a fresh folder of this machine.
    own = os.environ.get("BENCH_ROOT") or spark.conf.get("spark.checkpoint.dir", None)
    if not own and not spark.sparkContext.master.startswith("local"):
        raise SystemExit("set BENCH_ROOT or spark.checkpoint.dir to a folder that all executors share")
    root = storage.join(own or checkpoint_dir(spark, tempfile.mkdtemp(prefix="shelfwise-bench-")),
                        f"bench-{uuid.uuid4().hex}", "snapshot")
    # Stage 0: land the source relations once (production: the JDBC extraction into a landing zone).
    t0 = time.perf_counter()
    workers = int(cpus) if cpus.isdigit() else 8
    landed = pipeline.land_sources(spark, context.sources(spark, sf_dir), root.replace("/snapshot", "/landing"),
                                   workers=workers)
    times["land_sources"] = round(time.perf_counter() - t0, 3)
    # Stage 1: the rebuild (all 21 base tables written once into a published snapshot).
    t0 = time.perf_counter()
    pipeline.rebuild(spark, landed["sources"], root, context.AS_OF, workers=workers)
    times["rebuild_base_tables"] = round(time.perf_counter() - t0, 3)
    context.use_snapshot(spark, sf_dir, root)
    # Stage 2: marts and reports over the published base tables.
    for name in names:
        try:
            df = registry.QUERIES[name](spark, sf_dir)
            t0 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # noqa: BLE001 - report the failure, keep the JSON line
            print(f"bench: {name} failed: {str(exc)[:300]}", file=sys.stderr)
            times[name] = None
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total",
                      "value": round(sum(v for v in times.values() if v is not None), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
