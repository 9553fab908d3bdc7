"""Plan shape: pruned scans, partial aggregation, no Python workers."""

from basketry.operators.baskets import top_pair_per_month
from basketry.plans.catalog import QUERIES
from basketry.sources.tables import purchases
from conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_any_plan(spark):
    for name, fn in QUERIES.items():
        plan = _plan(fn(spark, SF_SMALL))
        for marker in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
            assert marker not in plan, (name, marker)


def test_word_count_reads_one_column(spark):
    plan = _plan(QUERIES["word_count"](spark, SF_SMALL))
    assert "ReadSchema: struct<text:string>" in plan or "struct<text:string>" in plan
    assert "partial_count" in plan


def test_purchases_scan_is_pruned(spark):
    df = purchases(spark, SF_SMALL).where("month = 3").select("customer_id", "product")
    plan = _plan(df)
    assert "struct<l_orderkey:bigint,l_partkey:bigint>" in plan
    assert "struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_top_pair_limits_before_shuffle(spark):
    plan = _plan(top_pair_per_month(purchases(spark, SF_SMALL)))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_no_cross_join_in_any_plan(spark):
    for name, fn in QUERIES.items():
        plan = _plan(fn(spark, SF_SMALL))
        for marker in ("CartesianProduct", "BroadcastNestedLoopJoin"):
            assert marker not in plan, (name, marker)


def test_heavy_basket_plan_has_no_cross_join(spark):
    from basketry.operators.pairs import pair_support, prepare_baskets
    from basketry.sources.tables import basket_items

    bs = prepare_baskets(basket_items(purchases(spark, SF_SMALL)), max_items=3)
    assert bs.heavy is not None
    plan = _plan(pair_support(bs))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BroadcastHashJoin" in plan  # the checked heavy list is broadcast


def test_every_query_reads_files_not_made_up_input(spark):
    import re

    for name, fn in QUERIES.items():
        plan = _plan(fn(spark, SF_SMALL))
        assert re.search(r"FileScan (parquet|text|csv)", plan), name
        assert "LocalTableScan" not in plan and "Range (" not in plan, name
        assert "pipeline" not in name and not re.match(r"op\d+_", name), name
