"""Every operator accepts empty inputs and returns empty (or zero) results."""

from basketry.operators import baskets as B
from basketry.operators import rules as R
from basketry.operators.graph import degree_count
from basketry.operators.pairs import frequent_pairs, pair_support, pcy_pruning, prepare_baskets
from basketry.operators.text import word_count
from helpers import purchases_frame


def test_empty_inputs(spark):
    text = spark.createDataFrame([], "value string")
    assert word_count(text).count() == 0
    edges = spark.createDataFrame([], "src long, dst long")
    assert degree_count(edges).count() == 0

    purchases = purchases_frame(spark, [])
    assert B.top_customers_by_distinct_products(purchases).count() == 0
    assert B.baskets_per_month(purchases).count() == 0
    assert B.pair_counts_per_month(purchases).count() == 0
    assert B.top_pair_per_month(purchases).count() == 0
    assert B.purchase_irregularity(purchases).count() == 0
    assert B.most_irregular_customers(purchases, 3).count() == 0
    assert B.to_basket_lines(purchases).count() == 0

    items = spark.createDataFrame([], "customer_id long, date string, item string")
    bs = prepare_baskets(items)
    assert bs.heavy is None and bs.light_pairs == 0
    assert pair_support(bs).count() == 0
    assert frequent_pairs(bs, 1, num_buckets=10).count() == 0
    assert tuple(pcy_pruning(bs, 1, 10).first()) == (0, 0, 0, 0)
    pairs = frequent_pairs(bs, 1)
    assert R.association_rules(pairs, items).count() == 0
    assert R.basket_total(items).first().n_baskets == 0
