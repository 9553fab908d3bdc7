"""Lineage and broadcast helpers."""

from basketry.plans.guards import broadcast_checked, broadcast_stored, measured_size
from basketry.plans.lineage import (
    ensure_checkpoint_dir,
    materialize,
    materialize_with_folder,
    release_scratch,
    remove_folder,
    scratch_folder,
    scratch_mark,
)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_checkpoint_dir_comes_from_the_session(spark):
    folder = ensure_checkpoint_dir(spark)
    assert folder and folder == spark.sparkContext.getCheckpointDir()
    assert scratch_folder(spark).startswith(folder.rstrip("/") + "/basketry-")


def test_materialize_round_trip_and_removal(spark):
    df = spark.range(100).selectExpr("id", "id % 7 AS k")
    back, folder = materialize_with_folder(df)
    assert folder.startswith(ensure_checkpoint_dir(spark).rstrip("/"))
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())
    assert "FileScan parquet" in _plan(back)  # lineage cut: a scan, not the original plan
    assert remove_folder(spark, folder)
    assert not remove_folder(spark, folder)


def test_scratch_is_remembered_until_released(spark):
    release_scratch(spark)
    first = materialize(spark.range(3))
    mark = scratch_mark()
    materialize(spark.range(5))
    assert release_scratch(spark, mark) == 1 and first.count() == 3
    assert release_scratch(spark) == 1 and release_scratch(spark) == 0


def test_broadcast_only_within_bounds(spark):
    small = spark.range(10).withColumnRenamed("id", "k")
    probe = spark.range(10_000).withColumnRenamed("id", "k")
    hinted, within = broadcast_checked(small, 100)
    assert within and "BroadcastHashJoin" in _plan(probe.join(hinted, "k"))
    plain, within = broadcast_checked(small, 9)
    assert not within and plain is small
    # few rows, but wide ones
    wide = spark.range(10).selectExpr("id AS k", "repeat('x', 1000) AS s", "CAST(NULL AS string) AS t")
    assert measured_size(wide) == (10, 10 * 1008)
    assert not broadcast_checked(wide, 100, 10_000)[1] and broadcast_checked(wide, 100, 10_080)[1]


def test_broadcast_stored_reads_the_stored_copy(spark):
    agg = spark.range(1000).selectExpr("id % 10 AS k").groupBy("k").count()
    stored, within = broadcast_stored(agg, 100)
    assert within
    plan = _plan(spark.range(10_000).withColumnRenamed("id", "k").join(stored, "k"))
    assert "BroadcastHashJoin" in plan and "FileScan parquet" in plan and "HashAggregate" not in plan
    big, within = broadcast_stored(spark.range(500), 100)
    assert not within and "FileScan parquet" in _plan(big)
