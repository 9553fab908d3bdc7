"""Hot-basket experiment: one basket holds a third of all purchase rows.

    python tools/skew_check.py [sf_dir] [max_items ...]

Environment: SKEW_DRIVER_MEMORY (default 8g), SKEW_SHUFFLE_PARTITIONS (default 8).

Derives the workload from the tables (sparse items; every third order is
moved into one basket), runs ``pair_support`` once per ``max_items`` and
reads task metrics from a Spark event log written to a fresh scratch folder.
For each run it prints the wall time, the busiest task's duration and the
median task duration of the slowest stage, and checks that every run gives
the same supports.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from basketry.operators.pairs import pair_support, prepare_baskets  # noqa: E402
from basketry.plans.session import build_session  # noqa: E402
from basketry.sources import tables  # noqa: E402


def stage_tasks(log_dir: str) -> dict[tuple[int, int], list[int]]:
    durations: dict[tuple[int, int], list[int]] = {}
    for path in glob.glob(f"{log_dir}/**/events_*", recursive=True) + glob.glob(f"{log_dir}/*.inprogress"):
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerTaskEnd":
                    info = ev["Task Info"]
                    key = (ev["Stage ID"], ev["Stage Attempt ID"])
                    durations.setdefault(key, []).append(info["Finish Time"] - info["Launch Time"])
    return durations


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    limits = [int(x) for x in sys.argv[2:]] or [1_000_000, 250]
    results = {}
    for max_items in limits:
        log_dir = tempfile.mkdtemp(prefix="run-skew-")
        spark = build_session("local[8]", shuffle_partitions=int(os.environ.get("SKEW_SHUFFLE_PARTITIONS", "8")),
                              driver_memory=os.environ.get("SKEW_DRIVER_MEMORY", "8g"), extra_conf={
            "spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false",
            "spark.ui.showConsoleProgress": "false"})
        p = tables.purchases(spark, sf_dir, items="partkey")
        hot = F.pmod(F.xxhash64("customer_id", "date"), F.lit(3)) == 0
        skewed = p.select(
            F.when(hot, F.lit(-1)).otherwise(F.col("customer_id")).alias("customer_id"),
            F.when(hot, F.to_date(F.lit("1990-01-01"))).otherwise(F.col("date")).alias("date"),
            F.col("product").alias("item"),
        )
        t0 = time.perf_counter()
        bs = prepare_baskets(skewed, max_items=max_items)
        out = pair_support(bs)
        digest = out.select(F.count("*").alias("n"), F.sum("support").alias("s"),
                            F.bit_xor(F.xxhash64("item_a", "item_b", "support")).alias("h")).first()
        wall = time.perf_counter() - t0
        spark.stop()
        stages = stage_tasks(log_dir)
        results[max_items] = tuple(digest)
        top = sorted(stages.values(), key=max, reverse=True)[:3]
        print(json.dumps({
            "max_items": max_items, "heavy_chunked": bs.heavy is not None, "wall_sec": round(wall, 2),
            "pairs": digest.n, "occurrences": digest.s,
            "busiest_stages": [{"tasks": len(d), "max_task_ms": max(d), "median_task_ms": statistics.median(d)}
                               for d in top],
        }), flush=True)
    assert len(set(results.values())) == 1, "supports differ between runs"
    print("same supports in every run")


if __name__ == "__main__":
    main()
