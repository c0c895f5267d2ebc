"""Times the headline queries on $BENCH_SF_DIR and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from clipledger.queries import QUERIES
from clipledger.session import build_session, release

HEADLINE = [
    "plan_stratified", "plan_cross", "assign_positions_large", "pending_large", "pending_by_key",
    "limit_per_voice", "limit_per_voice_large", "budget_plan", "first_n_successes",
    "sequence_names", "manifest_merge", "manifest_typed", "locate_files", "decollide_names",
    "flatten_manifest", "reconcile", "pairs", "transcripts_keep_last", "char_stats",
    "resolve_attempts", "voice_summary", "voice_catalogue", "pcm_quantise", "convert_each_row",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = build_session("bench", os.environ.get("BENCH_CPUS", "8"))
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_custkey").count().write.format(
        "noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        begun = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begun, 3)
    release(spark)
    spark.stop()
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
