"""Seconds per headline query, as one JSON line.

Each query is run once untimed and then timed; the result is written to a
sink that keeps nothing, so all columns are computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.queries import QUERIES
from tidemark.session import build_session

HEADLINE = [
    "feed_order_epoch",
    "bootstrap_dedup",
    "dedup_pk",
    "bundle_bytes",
    "enrich_owner",
    "resolve_project",
    "asof_mode",
    "assemble_parts",
    "classify_asset",
    "state_fanout",
    "dispatch_mutations",
    "route_ops",
    "fold_documents",
    "fold_map",
    "fold_provenance",
    "fold_apps",
    "rebuild_tree",
    "rebuild_documents",
    "cascade_simple",
    "cascade_fixpoint",
    "retention_buffer",
    "metrics_hour",
    "response_errors",
    "stream_replay",
]
INPUTS = {
    "events": "feed",
    "orders": "admin and application logs",
    "lineitem": "catalog rows",
}


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(cores)
    rows = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet").count() for t in INPUTS}
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(run(spark, name, sf_dir), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cores": int(cores),
                "spark": spark.version,
                "input_rows": rows,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
