import math

import pyarrow.parquet as pq

from basketry.operators import baskets as B
from basketry.sources.formats import basket_lines_to_items, parse_basket_lines
from basketry.sources.tables import purchases
from conftest import SF_SMALL
from helpers import purchases_frame

ROWS = [
    # customer 1: three days, counts 3, 1, 2; repeated item in one basket
    (1, "2020-01-05", "milk"), (1, "2020-01-05", "milk"), (1, "2020-01-05", "bread"),
    (1, "2020-02-01", "eggs"),
    (1, "2021-01-09", "milk"), (1, "2021-01-09", "bread"),
    # customer 2: a single day (stddev 0.0 / null), one-item basket
    (2, "2020-01-05", "tea"),
    # customer 3: ties with customer 4 on distinct products
    (3, "2020-03-03", "milk"), (3, "2020-03-04", "bread"), (3, "2020-03-04", "jam"),
    (4, "2020-03-03", "milk"), (4, "2020-03-03", "bread"), (4, "2020-03-03", "tea"),
    # null item is not a product
    (5, "2020-03-03", None),
]


def test_top_customers_ties(spark):
    df = purchases_frame(spark, ROWS)
    got = [tuple(r) for r in B.top_customers_by_distinct_products(df, 3).collect()]
    assert got == [(1, 3), (3, 3), (4, 3)]
    got2 = [tuple(r) for r in B.top_customers_by_distinct_products(df, 2).collect()]
    assert got2 == [(1, 3), (3, 3)]


def test_baskets_per_month_pools_years(spark):
    df = purchases_frame(spark, ROWS)
    got = {r.month: r.n_baskets for r in B.baskets_per_month(df).collect()}
    # January: (1, 2020-01-05), (1, 2021-01-09), (2, 2020-01-05)
    assert got == {1: 3, 2: 1, 3: 4}


def test_pair_counts_and_top_pair(spark):
    df = purchases_frame(spark, ROWS)
    counts = {(r.month, r.item_a, r.item_b): r.n_baskets for r in B.pair_counts_per_month(df).collect()}
    assert counts == {
        (1, "bread", "milk"): 2,
        (3, "bread", "jam"): 1, (3, "bread", "milk"): 1, (3, "bread", "tea"): 1, (3, "milk", "tea"): 1,
    }
    top = [tuple(r) for r in B.top_pair_per_month(df).collect()]
    # month 3 has a four-way tie at 1: smallest pair wins
    assert top == [(1, "bread", "milk", 2), (3, "bread", "jam", 1)]


def test_irregularity_single_day(spark):
    df = purchases_frame(spark, ROWS)
    zero = {r.customer_id: r.stddev_items for r in B.purchase_irregularity(df, "zero").collect()}
    null = {r.customer_id: r.stddev_items for r in B.purchase_irregularity(df, "null").collect()}
    assert math.isclose(zero[1], 1.0) and zero[2] == 0.0 and null[2] is None
    assert math.isclose(zero[3], math.sqrt(0.5))
    top = B.most_irregular_customers(df, 1, "null").first()
    assert top.customer_id == 1
    ranked = [r.customer_id for r in B.most_irregular_customers(df, 10, "null").collect()]
    assert ranked[-3:] == [2, 4, 5]  # nulls last, ties by id


def test_irregularity_matches_python_on_table(spark):
    p = purchases(spark, SF_SMALL)
    got = {r.customer_id: r.stddev_items for r in B.purchase_irregularity(p, "zero").collect()}
    rows = p.select("customer_id", "date").collect()
    per_day = {}
    for r in rows:
        per_day.setdefault(r.customer_id, {}).setdefault(r.date, 0)
        per_day[r.customer_id][r.date] += 1
    for cust, days in per_day.items():
        v = list(days.values())
        if len(v) < 2:
            want = 0.0
        else:
            m = sum(v) / len(v)
            want = math.sqrt(sum((x - m) ** 2 for x in v) / (len(v) - 1))
        assert math.isclose(got[cust], want, abs_tol=1e-9)
    top = B.most_irregular_customers(p, 1, "zero").first()
    assert math.isclose(top.stddev_items, max(got.values()))


def test_basket_lines_round_trip(spark):
    df = purchases_frame(spark, ROWS)
    lines = {r.basket_id: r.line for r in B.to_basket_lines(df).collect()}
    assert lines["1_2020-01-05"] == "1_2020-01-05,bread,milk"
    assert "5_2020-03-03" not in lines  # no product, no basket
    parsed = parse_basket_lines(B.to_basket_lines(df).selectExpr("line AS value"))
    items = {(r.basket_id, r.item) for r in basket_lines_to_items(parsed).collect()}
    assert ("1_2020-01-05", "milk") in items and len(items) == 12


def test_a_basket_of_any_size_is_one_line(spark):
    items = [f"item{i:03d}" for i in range(450)]
    rows = [(9, "2020-05-05", i) for i in reversed(items)] + [(9, "2020-05-05", items[0]), (8, "2020-05-05", "x")]
    df = purchases_frame(spark, rows)
    lines = {r.basket_id: r.line for r in B.to_basket_lines(df).collect()}
    assert lines == {"9_2020-05-05": ",".join(["9_2020-05-05", *items]), "8_2020-05-05": "8_2020-05-05,x"}
    parsed = parse_basket_lines(B.to_basket_lines(df).selectExpr("line AS value")).collect()
    assert {r.basket_id: len(r["items"]) for r in parsed} == {"9_2020-05-05": 450, "8_2020-05-05": 1}


def test_basket_lines_store_nothing(spark):
    from basketry.plans.lineage import scratch_mark

    before = scratch_mark()
    B.to_basket_lines(purchases_frame(spark, ROWS)).collect()
    assert scratch_mark() == before


def test_sorted_outputs_are_in_order(spark):
    p = purchases(spark, SF_SMALL)
    months = [r.month for r in B.baskets_per_month(p).collect()]
    assert months == sorted(months)
    counts = [(r.month, -r.n_baskets, r.item_a, r.item_b) for r in B.pair_counts_per_month(p).collect()]
    assert counts == sorted(counts)
    assert [r.month for r in B.top_pair_per_month(p).collect()] == months


def test_prepared_baskets_give_the_same_pairs(spark):
    p = purchases(spark, SF_SMALL)
    want = B.pair_counts_per_month(p).collect()
    for collapse in (True, False):
        baskets = B.month_baskets(p, collapse_copies=collapse)
        assert B.pair_counts_per_month(baskets).collect() == want
        assert baskets.release() == 1


def test_parse_basket_line_cases(spark):
    lines = ["id_only", "b1,x,,y,", "b2, a , b ,a", "b3,", " , z", "b4,,"]
    df = spark.createDataFrame([(s,) for s in lines], "value string")
    got = {r.basket_id: r.items for r in parse_basket_lines(df).collect()}
    assert got == {"b1": ["x", "y"], "b2": ["a", "b"]}


def test_purchases_fixture_shape(spark):
    p = purchases(spark, SF_SMALL)
    n = pq.read_metadata(f"{SF_SMALL}/lineitem.parquet").num_rows
    assert p.count() == n  # every line item has an order and a part
    assert [f.name for f in p.schema.fields] == ["customer_id", "date", "product", "year", "month", "day"]


def test_irregularity_ties_ignore_float_noise(spark):
    # same daily counts in a different order: equal deviations, tie broken by id
    rows = []
    for cust, counts in ((7, [1, 2, 9, 4]), (3, [9, 4, 2, 1]), (5, [4, 1, 9, 2])):
        for day, n in enumerate(counts, start=1):
            rows += [(cust, f"2020-01-{day:02d}", f"p{i}") for i in range(n)]
    df = purchases_frame(spark, rows)
    ranked = [r.customer_id for r in B.most_irregular_customers(df, 3, "zero").collect()]
    assert ranked == [3, 5, 7]


def test_irregularity_ranks_exactly(spark):
    # variances 1e8 apart from each other by one part in 1e9: rounding would tie them
    rows = [(c, f"2020-01-{d:02d}", n) for c, days in {4: [1, 3, 8, 9], 2: [1, 3, 8, 8], 6: [1, 3, 8, 9]}.items()
            for d, k in enumerate(days, 1) for n in map(str, range(k))]
    df = purchases_frame(spark, rows)
    got = [r.customer_id for r in B.most_irregular_customers(df, 3, "zero").collect()]
    assert got == [4, 6, 2]
    keys = {r.customer_id: r.rank_key for r in B.irregularity_with_rank(df, "zero").collect()}
    assert keys[4] == keys[6] > keys[2]
    # (4 * 155 - 21 ** 2) / 12
    assert tuple(keys[4]) == (14, 916_666_666_666)
