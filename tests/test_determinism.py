"""Results do not depend on partitioning or adaptive execution (ties included)."""

import pytest

from conftest import SF_SMALL

QUERIES_TO_CHECK = [
    "top_customers_by_distinct_products",
    "top_pair_per_month",
    "most_irregular_customers",
    "most_irregular_customer",
    "frequent_pairs_pcy",
    "association_rules",
    "recommend_top_item",
    "recommend_held_items",
    "document_word_pairs",
]


def _rows(spark, name):
    from __spark_entry__ import queries

    return sorted(tuple(r) for r in queries()[name](spark, SF_SMALL).collect())


@pytest.mark.parametrize("name", QUERIES_TO_CHECK)
def test_same_result_under_other_partitionings(spark, name):
    base = _rows(spark, name)
    conf = spark.conf
    saved = {k: conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        for parts, adaptive in (("3", "false"), ("11", "true")):
            conf.set("spark.sql.shuffle.partitions", parts)
            conf.set("spark.sql.adaptive.enabled", adaptive)
            assert _rows(spark, name) == base, (parts, adaptive)
    finally:
        for k, v in saved.items():
            conf.set(k, v)
