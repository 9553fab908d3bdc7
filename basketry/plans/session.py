"""SparkSession defaults for tests and the bench.

Library code never depends on these settings for correctness; they only
make the plans run well: adaptive execution re-plans joins and partition
counts from measured shuffle sizes, and splits skewed join partitions.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from basketry.plans.lineage import ensure_checkpoint_dir


def build_session(
    master: str | None = None,
    app_name: str = "basketry",
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with adaptive execution switched on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": str(shuffle_partitions or os.cpu_count() or 8),
    }
    if driver_memory:
        conf["spark.driver.memory"] = driver_memory
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark
