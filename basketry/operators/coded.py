"""Pairs of dictionary-coded items, by arrays or by bitmaps.

Frequent items get dense integer codes in the order of their names, so that
``code_a < code_b`` means ``item_a < item_b`` and a pair is one long. Pairs are
counted, filtered and shuffled as longs; names join back to the pairs that
remain. Two exact ways count them, both native Spark:

* ``coded_pair_support``: the baskets' arrays (see ``operators.pairs``) with
  codes in place of names. A basket of n items costs n(n-1)/2 rows.
* ``vertical_pair_support``: baskets are numbered in blocks of ``64 * words``,
  and each item has a bitmap of the baskets of a block that hold it
  (``bit_or``). Baskets stored as arrays of items are numbered where they lie,
  so only bitmaps are shuffled. Within a block the bitmaps of two items are ANDed and their
  bits counted (``bit_count``), so a pair costs a row a block and not a row
  a basket. It suits few items in many long baskets: a block with m of the
  items costs m(m-1)/2 rows, whatever its baskets hold.

Codes are found without a single-task sort: items are range-sorted, numbered
within each partition, and moved by the number of items before the partition.
The dictionary is broadcast only within the size bounds of ``plans.guards``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.operators.pairs import BasketSet, frequent_items, pair_occurrences, tasks_for
from basketry.plans.guards import broadcast_checked, measured_size

# Two codes of 31 bits make a pair.
CODE_BITS = 31
# Longs of a bitmap: a block has 64 times as many baskets. Two bitmaps must stay
# under the 100 columns that one stage of generated code takes.
WORDS = 16
MAX_WORDS = 40
# Blocks whose baskets are numbered in one task.
BLOCKS_PER_NUMBERING = 64


@dataclass
class ItemCodes:
    """``table``: ``(item, support, code int)`` with codes 0, 1, ... in order of the items."""

    table: DataFrame
    n_items: int
    within: bool  # small enough to be broadcast

    def _side(self, *columns: Column) -> DataFrame:
        side = self.table.select(*columns)
        return F.broadcast(side) if self.within else side

    def coded(self, items: DataFrame, columns: Sequence[str]) -> DataFrame:
        """Basket items that have a code, with the code as ``item``."""
        return items.join(self._side(F.col("item"), F.col("code")), "item").select(*columns, F.col("code").alias("item"))

    def decoded(self, pairs: DataFrame, name: str, group: Sequence[str] = ()) -> DataFrame:
        """``(group..., item_a, item_b, <name>)`` of coded ``pair`` rows."""
        a = F.shiftright("pair", CODE_BITS).cast("int")
        b = F.col("pair").bitwiseAND(F.lit(2**CODE_BITS - 1)).cast("int")
        names = lambda k: self._side(F.col("code").alias(f"code_{k}"), F.col("item").alias(f"item_{k}"))
        out = pairs.select(*group, a.alias("code_a"), b.alias("code_b"), name)
        return out.join(names("a"), "code_a").join(names("b"), "code_b").select(*group, "item_a", "item_b", name)


def pair_code(a: str, b: str) -> Column:
    """The long of two codes, ``a < b``."""
    return F.shiftleft(F.col(a).cast("bigint"), CODE_BITS).bitwiseOR(F.col(b).cast("bigint"))


def numbered(stored: DataFrame, place: str, name: str) -> DataFrame:
    """Stored rows with a number 0, 1, ... in the order of ``place``, the
    ``monotonically_increasing_id`` that they were stored with."""
    part = F.shiftright(place, 33).alias("_part")
    # a row for each partition that was stored
    before = F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = stored.groupBy(part).agg(F.count(F.lit(1)).alias("_n")).select("_part", before.alias("_before"))
    number = F.col("_before") + F.col(place).bitwiseAND(F.lit(2**33 - 1))
    return stored.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn(name, number).drop("_part", "_before")


def item_codes(baskets: BasketSet, items: DataFrame) -> ItemCodes:
    """Codes of ``items`` (item, support), stored as part of ``baskets``."""
    place = F.monotonically_increasing_id()
    ranked = baskets.store(items.select("item", "support").orderBy("item").withColumn("_place", place))
    n, size = measured_size(ranked)
    if n >= 2**CODE_BITS:
        raise ValueError(f"{n} items are more than {CODE_BITS} bits of codes")
    code = F.col("_number").cast("int").alias("code")
    coded = numbered(ranked, "_place", "_number").select("item", "support", code)
    table = baskets.store(coded)
    return ItemCodes(table, n, broadcast_checked(table)[1])


def _frequent(counts: DataFrame, name: str, min_support: int | None) -> DataFrame:
    return counts if min_support is None else counts.where(F.col(name) >= min_support)


def coded_pair_support(baskets: BasketSet, codes: ItemCodes, group: Sequence[str] = (),
                       min_support: int | None = None, name: str = "support") -> DataFrame:
    """``(group..., item_a, item_b, <name> bigint)``: baskets holding both items, for
    pairs of coded items with at least ``min_support`` of them."""
    coded = codes.coded(baskets.items, baskets.columns)
    occ = pair_occurrences(baskets, group, coded).select(*group, pair_code("item_a", "item_b").alias("pair"), "weight")
    counts = occ.groupBy(*group, "pair").agg(F.sum("weight").alias(name))
    return codes.decoded(_frequent(counts, name, min_support), name, group)


def item_bitmaps(baskets: BasketSet, codes: ItemCodes, words: int = WORDS) -> DataFrame:
    """``(block bigint, item int, w0 .. bigint)``: which of a block's baskets hold the item; stored.

    Every basket with a coded item has one place in one block."""
    if not 1 <= words <= MAX_WORDS:
        raise ValueError(f"words must be between 1 and {MAX_WORDS}, not {words}")
    bits = 64 * words
    if baskets.lists is None:
        rows = _placed(baskets, codes, baskets.items, bits)
    else:
        lists = baskets.lists.where(F.col("place").isNotNull())
        number = F.col("_number")
        rows = numbered(lists, "place", "_number").select(number, F.explode("item").alias("item"))
        rows = codes.coded(rows, ["_number"]).select(F.floor(number / bits).alias("block"), F.pmod(number, F.lit(bits)).alias("_at"), "item")
        others = baskets.lists.where(F.col("place").isNull())
        if not others.isEmpty():
            # baskets of several rows have blocks of their own, below zero
            others = _placed(baskets, codes, others.select(*baskets.keys, F.explode("item").alias("item")), bits)
            rows = rows.unionByName(others.withColumn("block", -1 - F.col("block")))
    word, bit = F.floor(F.col("_at") / 64), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("_at", F.lit(64)).cast("int"))
    rows = rows.select("block", "item", word.cast("int").alias("_word"), bit.alias("_bit"))
    columns = [F.bit_or(F.when(F.col("_word") == w, F.col("_bit")).otherwise(F.lit(0).cast("bigint"))).alias(f"w{w}") for w in range(words)]
    return baskets.store(rows.groupBy("block", "item").agg(*columns))


def _placed(baskets: BasketSet, codes: ItemCodes, items: DataFrame, bits: int) -> DataFrame:
    """``(block bigint, _at bigint, item int)`` of the coded ``items``: baskets numbered by
    windows over hashes of their keys."""
    keys = list(baskets.keys)
    present = baskets.store(codes.coded(items, keys))
    parts = max(1, -(-baskets.n_baskets // (bits * BLOCKS_PER_NUMBERING)))
    part = F.pmod(F.xxhash64(*keys), F.lit(parts))
    row = F.row_number().over(W.partitionBy("_part").orderBy(*keys)) - 1
    places = present.select(*keys).distinct().withColumn("_part", part).withColumn("_row", row)
    block = F.col("_part") + F.floor(F.col("_row") / bits) * parts
    places = places.select(*keys, block.alias("block"), F.pmod("_row", F.lit(bits)).cast("bigint").alias("_at"))
    return present.join(places, keys).select("block", "_at", "item")


def vertical_pair_support(baskets: BasketSet, codes: ItemCodes, min_support: int | None = None,
                          name: str = "support", words: int = WORDS) -> DataFrame:
    """``coded_pair_support`` by bitmaps; pairs that no basket holds are left out."""
    maps = item_bitmaps(baskets, codes, words)
    n = F.col("_n").cast("bigint")
    sizes = maps.groupBy("block").agg(F.count(F.lit(1)).alias("_n"))
    made = sizes.agg(F.count(F.lit(1)).alias("blocks"), F.coalesce(F.sum(n * n), F.lit(0)).alias("pairs")).first()
    # rows are few and small, and a block makes many pairs: tasks are sized by pairs,
    # and the items of one side are dealt to lanes where there are fewer blocks than tasks
    tasks = tasks_for(int(made.pairs))
    lanes = max(1, -(-tasks // max(1, int(made.blocks))))
    lane = F.pmod(F.xxhash64("item"), F.lit(lanes)).cast("int")
    side = lambda k: [F.col("item").alias(f"code_{k}"), *[F.col(f"w{w}").alias(f"{k}{w}") for w in range(words)]]
    left = maps.select("block", lane.alias("_lane"), *side("a"))
    right = maps.select("block", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("_lane"), *side("b"))
    left, right = (x.repartition(tasks, "block", "_lane") for x in (left, right))
    both = sum((F.bit_count(F.col(f"a{w}").bitwiseAND(F.col(f"b{w}"))) for w in range(words)), F.lit(0))
    met = left.join(right, ["block", "_lane"]).where("code_a < code_b")
    counts = met.select(pair_code("code_a", "code_b").alias("pair"), both.cast("bigint").alias("_both")).where("_both > 0")
    counts = counts.groupBy("pair").agg(F.sum("_both").alias(name))
    return codes.decoded(_frequent(counts, name, min_support), name)


def frequent_pairs_by_codes(baskets: BasketSet, min_support: int, bitmaps: bool = False, words: int = WORDS) -> DataFrame:
    """``pairs.frequent_pairs`` without buckets, by codes; ``bitmaps`` chooses the vertical way."""
    codes = item_codes(baskets, frequent_items(baskets, min_support))
    if bitmaps:
        return vertical_pair_support(baskets, codes, min_support, words=words)
    return coded_pair_support(baskets, codes, min_support=min_support)
