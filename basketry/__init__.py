"""basketry: market-basket, text and graph statistics as Spark DataFrame plans.

Every operator takes DataFrames and returns a DataFrame built from native
Spark expressions, so Catalyst prunes columns, pushes filters into the
Parquet scan and aggregates partially before every shuffle.
"""

from basketry.operators.baskets import (
    baskets_per_month,
    most_irregular_customers,
    pair_counts_per_month,
    purchase_irregularity,
    to_basket_lines,
    top_customers_by_distinct_products,
    top_pair_per_month,
)
from basketry.operators.graph import degree_count, synthetic_edges
from basketry.operators.pairs import (
    BasketSet,
    frequent_pairs,
    pair_occurrences,
    pcy_pass1,
    pcy_pass2,
    prepare_baskets,
)
from basketry.operators.rules import (
    association_rules,
    basket_total,
    generate_rules,
    item_support,
    recommend,
    recommend_all,
    with_confidence,
    with_interest,
)
from basketry.operators.text import word_count

__all__ = [
    "BasketSet",
    "association_rules",
    "basket_total",
    "baskets_per_month",
    "degree_count",
    "frequent_pairs",
    "generate_rules",
    "item_support",
    "most_irregular_customers",
    "pair_counts_per_month",
    "pair_occurrences",
    "pcy_pass1",
    "pcy_pass2",
    "prepare_baskets",
    "purchase_irregularity",
    "recommend",
    "recommend_all",
    "synthetic_edges",
    "to_basket_lines",
    "top_customers_by_distinct_products",
    "top_pair_per_month",
    "with_confidence",
    "with_interest",
    "word_count",
]
