"""Property test: pair supports equal brute force for any baskets and chunk size."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from basketry.operators.pairs import frequent_pairs, pair_support, prepare_baskets
from helpers import brute_pair_support

ITEMS = [f"i{k}" for k in range(12)]

baskets_strategy = st.lists(
    st.tuples(st.integers(0, 6), st.integers(0, 2), st.sampled_from(ITEMS)), min_size=1, max_size=80
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=baskets_strategy, max_items=st.integers(2, 6), support=st.integers(1, 3))
def test_pair_support_property(spark, rows, max_items, support):
    df = spark.createDataFrame([(c, str(d), i) for c, d, i in rows], "customer_id long, date string, item string")
    sets = {}
    for c, d, i in rows:
        sets.setdefault((c, d), set()).add(i)
    want = brute_pair_support(sets.values())
    bs = prepare_baskets(df, max_items=max_items)
    got = {(r.item_a, r.item_b): r.support for r in pair_support(bs).collect()}
    assert got == want
    frequent = {(r.item_a, r.item_b): r.support for r in frequent_pairs(bs, support, num_buckets=7).collect()}
    assert frequent == {k: v for k, v in want.items() if v >= support}
