"""Purchase statistics f1-f4 (Q5-Q10) and basket lines (Q11).

Input is a purchases frame ``(customer_id, date, product, year, month, day)``;
a basket is all purchases of one customer on one date. Every top-k breaks
ties by key, so results are deterministic (the reference's are not).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.stats import stddev_or_zero
from basketry.operators.coded import coded_pair_support, item_codes
from basketry.operators.pairs import DEFAULT_MAX_ITEMS, BasketSet, pair_support, prepare_baskets

BASKET_KEYS = ("customer_id", "date")


def top_customers_by_distinct_products(purchases: DataFrame, k: int = 10) -> DataFrame:
    """f1: ``(customer_id, n_products)`` for the ``k`` customers with the most
    distinct products; ties by ascending ``customer_id``.

    ``count_distinct`` plans as two partial aggregates (by customer and
    product, then by customer), so one very active customer is spread over
    many tasks in the first shuffle. ``orderBy().limit(k)`` is a top-k per
    task (TakeOrderedAndProject), not a full sort.
    """
    return (
        purchases.groupBy("customer_id")
        .agg(F.count_distinct("product").alias("n_products"))
        .orderBy(F.desc("n_products"), F.asc("customer_id"))
        .limit(k)
    )


def baskets_per_month(purchases: DataFrame) -> DataFrame:
    """f2: ``(month, n_baskets)``; months of different years are pooled."""
    return (
        purchases.where(F.col("customer_id").isNotNull() & F.col("date").isNotNull())
        .select("customer_id", "date", "month")
        .distinct()
        .groupBy("month")
        .agg(F.count(F.lit(1)).alias("n_baskets"))
        .orderBy("month")
    )


def month_baskets(purchases: DataFrame, max_items: int = DEFAULT_MAX_ITEMS,
                  collapse_copies: bool = True) -> BasketSet:
    """The baskets of the purchases with their month; release them after use."""
    rows = purchases.select("customer_id", "date", "month", F.col("product").alias("item"))
    return prepare_baskets(rows, keys=BASKET_KEYS, attrs=("month",), max_items=max_items,
                           collapse_copies=collapse_copies)


def pair_counts_per_month(purchases: DataFrame | BasketSet, max_items: int = DEFAULT_MAX_ITEMS,
                          sort: bool = True, coded: bool = False) -> DataFrame:
    """f3 (DataFrame form): ``(month, item_a, item_b, n_baskets)`` for every
    pair bought together in a basket, ordered by month then count. ``coded``
    counts pairs of integer codes, so that each travels as one long.

    ``purchases`` may be the baskets that ``month_baskets`` prepared, for
    callers that use them more than once or release them.
    """
    baskets = purchases if isinstance(purchases, BasketSet) else month_baskets(purchases, max_items)
    if coded:
        counts = coded_pair_support(baskets, item_codes(baskets, baskets.support()), ("month",), name="n_baskets")
    else:
        counts = pair_support(baskets, group=("month",), name="n_baskets")
    if sort:
        counts = counts.orderBy("month", F.desc("n_baskets"), "item_a", "item_b")
    return counts


def top_pairs(counts: DataFrame) -> DataFrame:
    """The most frequent pair of each month from ``(month, item_a, item_b, n_baskets)``.

    Ties go to the smallest ``(item_a, item_b)``. ``row_number() ... = 1``
    is planned with a per-task group limit before the shuffle on month, so
    each task sends one candidate per month instead of all its pairs.
    """
    w = Window.partitionBy("month").orderBy(F.desc("n_baskets"), "item_a", "item_b")
    return (
        counts.withColumn("_rank", F.row_number().over(w))
        .where(F.col("_rank") == 1)
        .drop("_rank")
        .orderBy("month")
    )


def top_pair_per_month(purchases: DataFrame | BasketSet, max_items: int = DEFAULT_MAX_ITEMS) -> DataFrame:
    """f3 (RDD form): the most frequent pair of each month, one row per month."""
    return top_pairs(pair_counts_per_month(purchases, max_items, sort=False))


def purchase_irregularity(purchases: DataFrame, single_day: str = "zero") -> DataFrame:
    """f4: ``(customer_id, stddev_items)``, the sample standard deviation of
    the number of items a customer buys per shopping day.

    Items are counted as rows, repeats included. ``single_day="zero"`` gives
    0.0 to customers with one shopping day (the RDD form); ``"null"`` keeps
    Spark's null (the DataFrame form). Both levels aggregate partially.
    """
    return irregularity_with_rank(purchases, single_day).drop("rank_key")


# Fixed point of the variance that customers are ranked by: exact integers tell
# apart all variances that differ by this part of one.
_RANK_SCALE = 10**12


def irregularity_with_rank(purchases: DataFrame, single_day: str = "zero") -> DataFrame:
    """``purchase_irregularity`` with ``rank_key``, an exact stand-in for the deviation in comparisons.

    It is the variance, ``(n * sum of squares - sum ** 2) / (n * (n - 1))``, in
    integer arithmetic. A floating-point deviation depends in its last bits
    on the order of the days, which must not decide a tie.
    """
    if single_day not in ("zero", "null"):
        raise ValueError("single_day must be 'zero' or 'null'")
    per_day = purchases.groupBy("customer_id", "date").agg(F.count(F.lit(1)).alias("n_items"))
    spread = stddev_or_zero("n_items") if single_day == "zero" else F.stddev_samp("n_items")
    sums = per_day.groupBy("customer_id").agg(
        spread.alias("stddev_items"),
        F.count(F.lit(1)).cast("decimal(19,0)").alias("_n"),
        F.sum("n_items").cast("decimal(19,0)").alias("_s"),
        F.sum(F.col("n_items") * F.col("n_items")).cast("decimal(19,0)").alias("_q"),
    )
    parts = sums.select("customer_id", "stddev_items", F.expr("_n * _q - _s * _s").alias("_a"), F.expr("_n * (_n - 1)").alias("_b"))
    whole = F.expr("_a div nullif(_b, 0)")
    rest = F.expr(f"((_a % nullif(_b, 0)) * {_RANK_SCALE}) div nullif(_b, 0)")
    key = F.when(F.col("_b") > 0, F.struct(whole.alias("whole"), rest.alias("rest")))
    if single_day == "zero":
        nothing = F.lit(0).cast("bigint")
        key = F.coalesce(key, F.struct(nothing.alias("whole"), nothing.alias("rest")))
    return parts.select("customer_id", "stddev_items", key.alias("rank_key"))


def most_irregular_customers(purchases: DataFrame, k: int = 1, single_day: str = "null") -> DataFrame:
    """The ``k`` customers with the largest ``stddev_items`` (nulls last, ties by
    ascending ``customer_id``), ranked exactly (see ``irregularity_with_rank``)."""
    return (
        irregularity_with_rank(purchases, single_day)
        .orderBy(F.desc_nulls_last("rank_key"), F.asc("customer_id"))
        .limit(k)
        .drop("rank_key")
    )


def to_basket_lines(purchases: DataFrame) -> DataFrame:
    """``(basket_id, line)`` with ``line = "<customer>_<date>,item,item,..."``.

    One line per basket, whatever its size; items are distinct and sorted
    (every consumer reads a basket as a set). A line holds one basket's
    distinct items and nothing else, so it is bounded by the basket; a basket
    too big for a row fails the job. For pair counts on such baskets use the
    long form ``(keys, item)``, which ``prepare_baskets`` cuts into chunks.
    """
    basket_id = F.concat_ws("_", F.col("customer_id").cast("string"), F.col("date").cast("string"))
    return (
        purchases.where(F.col("customer_id").isNotNull() & F.col("date").isNotNull() & F.col("product").isNotNull())
        .groupBy("customer_id", "date")
        .agg(F.array_sort(F.collect_set("product")).alias("items"))
        .select(basket_id.alias("basket_id"), F.concat_ws(",", basket_id, F.col("items")).alias("line"))
    )
