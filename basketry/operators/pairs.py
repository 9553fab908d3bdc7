"""Pairs of items that occur in the same basket: expansion, support, PCY.

Plan shape (all native Spark, no Python workers):

1. ``prepare_baskets``: ``(basket keys, item)`` rows are de-duplicated by a
   distributed aggregate and written once to the shared checkpoint folder,
   as the reference writes its basket file once and reads it in two passes.
   Baskets that come as one array of items a row lose repeats within the row,
   without a shuffle of their items; only baskets of several rows are
   de-duplicated by the aggregate.
   Basket sizes are counted in one job that also measures the pair volume;
   the (normally empty) list of *heavy* baskets, those with more than
   ``max_items`` distinct items, is broadcast only when that count is within
   a bound, and shuffled otherwise.
2. ``chunk_baskets``: a light basket becomes one sorted item array (at most
   ``max_items`` items). A heavy basket is cut into ``ceil(n / max_items)``
   chunks by a hash of the item, so no task ever holds a whole hot basket.
3. ``pair_occurrences``: identical light baskets collapse into one weighted
   item set first (a third of all baskets may be copies of one another), then
   each set expands to its n(n-1)/2 pairs inside one code-generated stage.
   Pairs of a heavy basket are the pairs inside each chunk plus the pairs
   across two chunks; the latter come from a join keyed by
   ``(basket, lo chunk, hi chunk)``, which spreads one basket over many tasks.
   Chunk arrays and chunk pairs are weighted the same way, so copies of a
   heavy basket expand once too.
4. Rows that explode into many pairs are round-robined over as many tasks as
   the measured pair volume asks for (``PAIRS_PER_TASK``), whatever the number of
   cores: adaptive execution sizes partitions by input bytes and would
   otherwise pack them into few tasks.
5. Supports are sums of weights, aggregated partially before the shuffle.

What a set of baskets stores (items, heavy list, item supports, item codes) it
stores once; ``BasketSet.release`` deletes all of it.

PCY (``pcy_pass1`` / ``pcy_pass2``) prunes before expansion: pass 2 keeps
only frequent items (semi join) and only pairs whose hash bucket is frequent
(a bitmap of ``num_buckets`` bits, broadcast if that size is within the bound). A pair with
support >= s has both items and its bucket at >= s, so the result equals the
plain count for every bucket count and hash.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.pairs import (
    bitmap_bytes,
    bucket_bitmap,
    check_buckets,
    combined_polynomial_bucket,
    explode_cross_pairs,
    explode_pairs,
    in_bitmap,
    item_polynomial,
    pair_bucket,
)
from basketry.plans.guards import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, broadcast_checked, measured_size
from basketry.plans.lineage import materialize_with_folder, remove_folder

DEFAULT_KEYS = ("customer_id", "date")
# Largest basket expanded as one array (at most 19,900 pairs); bigger
# baskets are chunked and spread.
DEFAULT_MAX_ITEMS = 200
# Pair rows one task should generate.
PAIRS_PER_TASK = 5_000_000


@dataclass
class BasketSet:
    """De-duplicated basket items plus the heavy-basket list.

    ``items``: ``(keys..., attrs..., item)``, one row per item of a basket.
    ``attrs`` are columns fixed per basket (e.g. ``month``) carried along for
    grouping. ``heavy``: ``(keys..., n_chunks)`` or ``None`` when no basket
    has more than ``max_items`` items. ``n_baskets`` counts every basket, also
    those whose items are all null.
    """

    items: DataFrame
    keys: tuple[str, ...]
    attrs: tuple[str, ...]
    max_items: int
    lists: DataFrame | None = None  # stored arrays of items, see ``_stored_lists``
    heavy: DataFrame | None = None
    heavy_chunks: int = 0  # chunks of all heavy baskets
    heavy_cells: int = 0  # (lo, hi) chunk pairs of all heavy baskets
    light_pairs: int = 0  # pairs of all light baskets (upper bound after pruning)
    heavy_broadcast: bool = True  # False: the heavy list is joined by a shuffle
    n_baskets: int = 0
    collapse_copies: bool = True  # count identical item sets once, with a weight
    folders: list[str] = field(default_factory=list)  # everything stored for this set
    _support: DataFrame | None = field(default=None, repr=False)
    _codes: dict[int, tuple[DataFrame, bool]] = field(default_factory=dict, repr=False)

    @property
    def columns(self) -> list[str]:
        return [*self.keys, *self.attrs]

    def store(self, df: DataFrame) -> DataFrame:
        """Write ``df`` once under the shared checkpoint folder, as part of this set."""
        stored, folder = materialize_with_folder(df)
        self.folders.append(folder)
        return stored

    def support(self) -> DataFrame:
        """``(item, support bigint)``: baskets holding the item, counted and stored once
        for the item filter, the pruning report and the rules."""
        if self._support is None:
            self._support = self.store(item_counts(self))
        return self._support

    def codes(self, num_buckets: int) -> tuple[DataFrame, bool]:
        """``(item, support, h, p)`` with the item's polynomial codes, stored once, and
        whether it is within the broadcast bounds."""
        if num_buckets not in self._codes:
            h, p = item_polynomial("item", num_buckets)
            codes = self.store(self.support().select("item", "support", h.alias("h"), p.alias("p")))
            self._codes[num_buckets] = broadcast_checked(codes)
        return self._codes[num_buckets]

    def pair_volume(self, items: DataFrame | None = None) -> tuple[int, int, int]:
        """Pairs of light baskets, inside the chunks of heavy ones and across them:
        upper bounds by the sizes measured on the full baskets or, given a subset of
        the items, by the pairs of that subset if they are fewer."""
        chunk = self.max_items**2
        volume = self.light_pairs, self.heavy_chunks * chunk // 2, self.heavy_cells * chunk
        if items is None:
            return volume
        n = F.count(F.lit(1))
        sizes = items.groupBy(*self.keys).agg((n * (n - 1) / 2).cast("bigint").alias("pairs"))
        total = int(sizes.agg(F.coalesce(F.sum("pairs"), F.lit(0))).first()[0])
        return tuple(min(v, total) for v in volume)

    def release(self) -> int:
        """Delete everything stored for this set once every result built on it
        has been computed or written. Returns the number of folders removed."""
        spark = self.items.sparkSession
        removed = sum(remove_folder(spark, folder) for folder in self.folders)
        self.folders.clear()
        self._support, self._codes = None, {}
        return removed


def prepare_baskets(
    basket_items: DataFrame,
    keys: Sequence[str] = DEFAULT_KEYS,
    item: str = "item",
    attrs: Sequence[str] = (),
    max_items: int = DEFAULT_MAX_ITEMS,
    materialize_items: bool = True,
    broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
    broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
    collapse_copies: bool = True,
) -> BasketSet:
    """Build a ``BasketSet`` from rows ``(keys..., attrs..., item)``.

    ``item`` may be an array: its entries are items of the row's basket, and a
    null or empty array is a basket without items. Such rows are always stored.
    Rows with a null key are dropped (a null key is not a basket). A null item
    is no item, but its basket counts in ``n_baskets``. ``collapse_copies=False``
    states that few baskets are copies of one another: pairs are then
    expanded without first grouping equal item sets, which saves a shuffle of
    all item arrays.
    """
    if max_items < 2:
        raise ValueError("max_items must be at least 2")
    keys = tuple(keys)
    attrs = tuple(attrs)
    cols = [*keys, *attrs]
    not_null = F.lit(True)
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    rows = basket_items.where(not_null).select(*cols, F.col(item).alias("item"))
    baskets = BasketSet(rows, keys, attrs, max_items, collapse_copies=collapse_copies)
    if isinstance(rows.schema["item"].dataType, T.ArrayType):
        baskets.lists = _stored_lists(baskets, rows)
        baskets.items = baskets.lists.select(*cols, F.explode("item").alias("item"))
        sizes = baskets.lists.groupBy(*keys).agg(F.sum(F.size("item")).alias("_n"))
    else:
        rows = rows.distinct()
        if materialize_items:
            rows = baskets.store(rows)
        baskets.items = rows.where(F.col("item").isNotNull())
        sizes = rows.groupBy(*keys).agg(F.count("item").alias("_n"))
    n = F.col("_n").cast("bigint")
    is_heavy = F.col("_n") > max_items
    chunks = F.ceil(n / F.lit(max_items))
    # One job measures everything the plan needs: how many baskets are heavy,
    # how many chunks and chunk pairs they make, how many pairs light ones make.
    stats = sizes.agg(
        F.count_if(is_heavy).alias("heavy"),
        F.sum(F.when(is_heavy, chunks)).alias("chunks"),
        F.sum(F.when(is_heavy, chunks * (chunks - 1) / 2)).cast("bigint").alias("cells"),
        F.sum(F.when(~is_heavy, n * (n - 1) / 2)).cast("bigint").alias("light_pairs"),
        F.count(F.lit(1)).alias("baskets"),
    ).first()
    baskets.light_pairs = int(stats.light_pairs or 0)
    baskets.n_baskets = int(stats.baskets)
    if stats.heavy:
        # stored once, so the plan does not group every basket again to rebuild it
        heavy = baskets.store(sizes.where(is_heavy).select(*keys, chunks.cast("int").alias("n_chunks")))
        baskets.heavy, baskets.heavy_broadcast = broadcast_checked(heavy, broadcast_rows, broadcast_bytes)
        baskets.heavy_chunks, baskets.heavy_cells = int(stats.chunks), int(stats.cells)
    return baskets


def _stored_lists(baskets: BasketSet, rows: DataFrame) -> DataFrame:
    """``(keys..., attrs..., item array, place bigint)``, stored: every item of a basket once.

    A basket of one row keeps its row, with a ``place`` that numbers such rows
    within their partition (see ``coded.numbered``). A basket of several rows
    has a row for each of its items, however many these are, and no place."""
    keys, cols, kind = list(baskets.keys), baskets.columns, rows.schema["item"].dataType
    none, place = F.array().cast(kind), F.monotonically_increasing_id().alias("place")
    items = F.coalesce(F.array_compact(F.array_distinct("item")), none).alias("item")
    stored = baskets.store(rows.select(*cols, items, place))
    several = baskets.store(stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").select(*keys))
    if several.isEmpty():
        return stored
    several, _ = broadcast_checked(several)
    once = stored.join(several, keys, "left_anti").select(*cols, "item", place)
    merged = stored.join(several, keys, "left_semi").select(*cols, F.explode_outer("item").alias("item")).distinct()
    one = F.when(F.col("item").isNull(), none).otherwise(F.array("item")).alias("item")
    return baskets.store(once.unionByName(merged.select(*cols, one, F.lit(None).cast("bigint").alias("place"))))


def tasks_for(pairs: int) -> int:
    """Tasks that so many pairs are spread over."""
    return max(1, -(-pairs // PAIRS_PER_TASK))


def _spread(df: DataFrame, pairs: int) -> DataFrame:
    """Round-robin ``df`` over the tasks that its pairs ask for.

    Rows here are small (item arrays) but each expands to up to
    ``max_items`` squared pairs, so partitions must be sized by pairs, not by
    bytes: an explicit partition count keeps adaptive execution from
    coalescing many such rows into one task. What one task can do keeps
    adaptive partitioning.
    """
    return df if pairs <= PAIRS_PER_TASK else df.repartition(tasks_for(pairs))


def chunk_baskets(baskets: BasketSet, items: DataFrame | None = None) -> DataFrame:
    """``(keys..., attrs..., chunk int, n_chunks int, items array<string>)``.

    ``items`` may be a filtered subset of ``baskets.items`` (pass 2 of PCY);
    chunking still follows the sizes measured on the full baskets.
    """
    src = baskets.items if items is None else items
    cols = baskets.columns
    agg = F.array_sort(F.collect_set("item")).alias("items")
    if baskets.heavy is None:
        return src.groupBy(*cols).agg(agg).select(
            *cols, F.lit(0).alias("chunk"), F.lit(1).alias("n_chunks"), "items"
        )
    tagged = src.join(baskets.heavy, list(baskets.keys), "left")
    n_chunks = F.coalesce(F.col("n_chunks"), F.lit(1))
    chunk = F.when(F.col("n_chunks").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64("item"), F.col("n_chunks")).cast("int")
    )
    tagged = tagged.select(*cols, "item", chunk.alias("chunk"), n_chunks.alias("n_chunks"))
    if not baskets.heavy_broadcast:
        # A shuffle join leaves rows partitioned by basket, which would satisfy
        # the grouping below without a new exchange and keep a hot basket in
        # one task; partition by chunk as well.
        tagged = tagged.repartition(*cols, "chunk")
    return tagged.groupBy(*cols, "chunk", "n_chunks").agg(agg)


def pair_occurrences(
    baskets: BasketSet, group: Sequence[str] = (), items: DataFrame | None = None
) -> DataFrame:
    """``(group..., item_a, item_b, weight bigint)`` with ``item_a < item_b``.

    Summing ``weight`` by pair gives the number of baskets holding both
    items. ``group`` must be among the basket attributes (e.g. ``month``).
    """
    group = list(group)
    unknown = set(group) - set(baskets.attrs)
    if unknown:
        raise ValueError(f"group columns {sorted(unknown)} are not basket attributes")
    light_pairs, inside_pairs, across_pairs = baskets.pair_volume(items)
    chunks = chunk_baskets(baskets, items)
    light = chunks if baskets.heavy is None else chunks.where(F.col("n_chunks") == 1)
    light = light.where(F.size("items") >= 2)
    if baskets.collapse_copies:
        weighted = light.groupBy(*group, "items").agg(F.count(F.lit(1)).alias("weight"))
    else:
        weighted = light.select(*group, "items", F.lit(1).cast("bigint").alias("weight"))
    pairs = explode_pairs(_spread(weighted, light_pairs), keep=[*group, "weight"])
    if baskets.heavy is None:
        return pairs

    # Pairs inside a chunk depend only on the chunk's items, and pairs across
    # two chunks only on the two item arrays: identical arrays (copies of a
    # heavy basket) are counted once with a weight, then spread over tasks.
    big = chunks.where(F.col("n_chunks") > 1)
    inside = (
        big.where(F.size("items") >= 2)
        .groupBy(*group, "items")
        .agg(F.count(F.lit(1)).alias("weight"))
    )
    within = explode_pairs(_spread(inside, inside_pairs), keep=[*group, "weight"])
    cols = baskets.columns
    lower = big.where(F.col("chunk") < F.col("n_chunks") - 1).select(
        *cols,
        F.col("chunk").alias("lo"),
        F.explode(F.sequence(F.col("chunk") + 1, F.col("n_chunks") - 1)).alias("hi"),
        F.col("items").alias("items_lo"),
    )
    upper = big.where(F.col("chunk") > 0).select(
        *cols,
        F.explode(F.sequence(F.lit(0), F.col("chunk") - 1)).alias("lo"),
        F.col("chunk").alias("hi"),
        F.col("items").alias("items_hi"),
    )
    grid = (
        lower.join(upper, [*cols, "lo", "hi"])
        .groupBy(*group, "items_lo", "items_hi")
        .agg(F.count(F.lit(1)).alias("weight"))
    )
    across = explode_cross_pairs(_spread(grid, across_pairs), "items_lo", "items_hi",
                                 keep=[*group, "weight"])
    return pairs.unionByName(within).unionByName(across)


def pair_support(
    baskets: BasketSet, group: Sequence[str] = (), items: DataFrame | None = None, name: str = "support"
) -> DataFrame:
    """``(group..., item_a, item_b, <name> bigint)``: baskets holding both items."""
    occ = pair_occurrences(baskets, group, items)
    return occ.groupBy(*group, "item_a", "item_b").agg(F.sum("weight").alias(name))


def item_counts(baskets: BasketSet, group: Sequence[str] = ()) -> DataFrame:
    """``(group..., item, support bigint)``: baskets holding the item."""
    return baskets.items.groupBy(*group, "item").agg(F.count(F.lit(1)).alias("support"))


def frequent_items(baskets: BasketSet, min_support: int) -> DataFrame:
    """``(item, support)`` of the items in at least ``min_support`` baskets."""
    return baskets.support().where(F.col("support") >= min_support)


def _keep_items(baskets: BasketSet, keep: DataFrame) -> DataFrame:
    """Basket items restricted to ``keep.item``, broadcast after a size check.

    ``keep`` is read from storage (a filter of the stored supports)."""
    keep = keep.select("item")
    rows, size = measured_size(keep)
    if rows <= DEFAULT_BROADCAST_ROWS and size <= DEFAULT_BROADCAST_BYTES:
        keep = F.broadcast(keep)
    return baskets.items.join(keep, "item", "left_semi")


def with_bucket(baskets: BasketSet, pairs: DataFrame, num_buckets: int, hash_kind: str,
                name: str = "bucket", supports: bool = False) -> DataFrame:
    """Adds the bucket of ``(item_a, item_b)``; with ``supports`` also the supports
    of both items as ``support_a`` and ``support_b``.

    For the polynomial hash the characters of each distinct item are folded
    once and the codes are looked up per pair in a table that is broadcast
    within the size bounds, so pairs only do arithmetic. Beyond the bounds,
    pairs without need of supports fold their characters themselves.
    """
    check_buckets(num_buckets)
    polynomial = hash_kind == "polynomial"
    if polynomial or supports:
        table, within = baskets.codes(num_buckets)
        if within or supports:
            a = table.select(F.col("item").alias("item_a"), F.col("support").alias("support_a"), F.col("h").alias("_h_a"))
            b = table.select(F.col("item").alias("item_b"), F.col("support").alias("support_b"),
                             F.col("h").alias("_h_b"), F.col("p").alias("_p_b"))
            if within:
                a, b = F.broadcast(a), F.broadcast(b)
            bucket = (combined_polynomial_bucket(F.col("_h_a"), F.col("_h_b"), F.col("_p_b"), num_buckets)
                      if polynomial else pair_bucket("item_a", "item_b", num_buckets, hash_kind))
            out = pairs.join(a, "item_a").join(b, "item_b").withColumn(name, bucket).drop("_h_a", "_h_b", "_p_b")
            return out if supports else out.drop("support_a", "support_b")
    return pairs.withColumn(name, pair_bucket("item_a", "item_b", num_buckets, hash_kind))


def pcy_pass1(
    baskets: BasketSet, min_support: int = 3, num_buckets: int = 100, hash_kind: str = "xxhash64"
) -> tuple[DataFrame, DataFrame]:
    """Frequent items ``(item, support)`` and frequent buckets ``(bucket, count)``.

    Every pair of every basket is hashed into ``[0, num_buckets)``; a bucket
    is frequent when the pairs hashed into it occur in at least
    ``min_support`` baskets in total. Both counts are partial aggregates:
    a task sends at most ``num_buckets`` bucket counts to the shuffle.
    """
    items = frequent_items(baskets, min_support)
    occ = with_bucket(baskets, pair_occurrences(baskets), num_buckets, hash_kind)
    buckets = (
        occ.select("bucket", "weight")
        .groupBy("bucket")
        .agg(F.sum("weight").alias("count"))
        .where(F.col("count") >= min_support)
    )
    return items, buckets


def pcy_pass2(
    baskets: BasketSet,
    items: DataFrame,
    buckets: DataFrame | None,
    min_support: int = 3,
    num_buckets: int = 100,
    hash_kind: str = "xxhash64",
) -> DataFrame:
    """``(item_a, item_b, support bigint)`` for pairs with support >= ``min_support``.

    Only frequent items enter the expansion; with ``buckets`` (pass 1) only
    pairs in a frequent bucket are counted.
    """
    occ = pair_occurrences(baskets, items=_keep_items(baskets, items))
    if buckets is not None:
        bitmap = bucket_bitmap(buckets)
        if bitmap_bytes(num_buckets) <= DEFAULT_BROADCAST_BYTES:
            bitmap = F.broadcast(bitmap)
        occ = in_bitmap(with_bucket(baskets, occ, num_buckets, hash_kind), bitmap)
    return (
        occ.groupBy("item_a", "item_b")
        .agg(F.sum("weight").alias("support"))
        .where(F.col("support") >= min_support)
    )


def frequent_pairs(
    baskets: BasketSet | DataFrame,
    min_support: int = 3,
    num_buckets: int | None = None,
    hash_kind: str = "xxhash64",
    keys: Sequence[str] = DEFAULT_KEYS,
    item: str = "item",
    max_items: int = DEFAULT_MAX_ITEMS,
) -> DataFrame:
    """``(item_a, item_b, support)``: pairs in at least ``min_support`` baskets.

    ``num_buckets=None`` counts the pairs of frequent items directly (one
    expansion); a bucket count runs both PCY passes. The result is the same.
    """
    if not isinstance(baskets, BasketSet):
        baskets = prepare_baskets(baskets, keys=keys, item=item, max_items=max_items)
    if num_buckets is None:
        return pcy_pass2(baskets, frequent_items(baskets, min_support), None, min_support)
    items, buckets = pcy_pass1(baskets, min_support, num_buckets, hash_kind)
    return pcy_pass2(baskets, items, buckets, min_support, num_buckets, hash_kind)


def pcy_pruning(
    baskets: BasketSet, min_support: int = 3, num_buckets: int = 100, hash_kind: str = "xxhash64"
) -> DataFrame:
    """One row reporting how much each PCY filter prunes.

    ``(all_pairs, item_candidates, bucket_candidates, frequent_buckets)``:
    distinct pairs before pruning, after the item filter, after the item and
    bucket filters, and the number of frequent buckets. Computed from one
    expansion: a bucket's pass-1 count is the sum of the supports of the
    pairs hashed into it, and both item filters are looked up with the item
    codes, so one aggregate by bucket holds all four numbers.
    """
    found = with_bucket(baskets, pair_support(baskets), num_buckets, hash_kind, supports=True)
    items_ok = (F.col("support_a") >= min_support) & (F.col("support_b") >= min_support)
    by_bucket = found.groupBy("bucket").agg(
        F.sum("support").alias("count"),
        F.count(F.lit(1)).alias("pairs"),
        F.count_if(items_ok).alias("candidates"),
    )
    frequent = F.col("count") >= min_support
    zero = F.lit(0).cast("bigint")
    return by_bucket.agg(
        F.coalesce(F.sum("pairs"), zero).alias("all_pairs"),
        F.coalesce(F.sum("candidates"), zero).alias("item_candidates"),
        F.coalesce(F.sum(F.when(frequent, F.col("candidates"))), zero).alias("bucket_candidates"),
        F.count_if(frequent).alias("frequent_buckets"),
    )
