"""Unordered item pairs: canonical order, expansion and bucket hashes.

Pairs are the struct-free columns ``(item_a, item_b)`` with ``item_a <
item_b`` in Spark's binary string order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ordered_pair(a: str | Column, b: str | Column) -> tuple[Column, Column]:
    """``(least, greatest)`` of two items."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    return F.least(ca, cb), F.greatest(ca, cb)


def explode_pairs(df: DataFrame, items: str = "items", keep: list[str] | None = None) -> DataFrame:
    """All pairs ``(item_a < item_b)`` of a sorted, distinct item array.

    Two generators without lambdas (``posexplode``, then ``explode`` of the
    tail ``slice``), so the expansion stays inside whole-stage code generation
    and emits exactly n(n-1)/2 rows per array.
    """
    keep = keep or []
    heads = df.select(*keep, F.posexplode(items).alias("_pos", "item_a"), F.col(items).alias("_items"))
    return heads.select(
        *keep,
        "item_a",
        F.explode(F.slice("_items", F.col("_pos") + 2, F.size("_items"))).alias("item_b"),
    )


def explode_cross_pairs(df: DataFrame, left: str, right: str, keep: list[str] | None = None) -> DataFrame:
    """Every pair of one item of ``left`` with one item of ``right`` (disjoint arrays)."""
    keep = keep or []
    xs = df.select(*keep, F.explode(left).alias("_x"), F.col(right).alias("_right"))
    ys = xs.select(*keep, "_x", F.explode("_right").alias("_y"))
    a, b = ordered_pair("_x", "_y")
    return ys.select(*keep, a.alias("item_a"), b.alias("item_b"))


# Bucket ids are 32-bit integers.
MAX_BUCKETS = 2**31 - 1


def check_buckets(num_buckets: int) -> int:
    """``num_buckets`` if bucket ids fit a 32-bit integer, else ``ValueError``."""
    if not 1 <= num_buckets <= MAX_BUCKETS:
        raise ValueError(f"num_buckets must be between 1 and {MAX_BUCKETS}, not {num_buckets}")
    return num_buckets


def pair_text(a: str | Column = "item_a", b: str | Column = "item_b") -> Column:
    """``a|b`` (the reference's text form of a pair)."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    return F.concat(ca, F.lit("|"), cb)


def polynomial_bucket(a: str | Column, b: str | Column, num_buckets: int) -> Column:
    """Bucket of the reference's pair hash: over the characters ``c`` of
    ``"a|b"`` (a < b), ``h = (h * 31 + code(c)) % n``, starting at 0.

    Evaluated in 64 bits so that large bucket counts do not overflow.
    Interpreted (higher-order functions); use ``fast_bucket`` in hot paths.
    """
    chars = F.split(pair_text(a, b), "")
    codes = F.transform(chars, lambda c: F.ascii(c).cast("bigint"))
    return F.aggregate(codes, F.lit(0).cast("bigint"), lambda h, c: (h * 31 + c) % num_buckets).cast("int")


def item_polynomial(item: str | Column, num_buckets: int) -> tuple[Column, Column]:
    """``(h, p)`` of one item for the polynomial pair hash: ``h`` folds the
    item's characters from 0 (``h = (h * 31 + code) % n``), ``p`` is
    ``31 ** length % n``. Computed once per distinct item."""
    col = F.col(item) if isinstance(item, str) else item
    codes = F.transform(F.split(col, ""), lambda c: F.ascii(c).cast("bigint"))
    codes = F.when(col == "", F.array().cast("array<bigint>")).otherwise(codes)
    start = F.struct(F.lit(0).cast("bigint").alias("h"), F.lit(1).cast("bigint").alias("p"))
    folded = F.aggregate(
        codes,
        start,
        lambda acc, c: F.struct(
            ((acc["h"] * 31 + c) % num_buckets).alias("h"), ((acc["p"] * 31) % num_buckets).alias("p")
        ),
    )
    return folded["h"], folded["p"]


def combined_polynomial_bucket(h_a: Column, h_b: Column, p_b: Column, num_buckets: int) -> Column:
    """The polynomial bucket of ``"a|b"`` from per-item codes (code of ``|`` is
    124). Up to ``MAX_BUCKETS`` no product overflows 64 bits: folding is linear modulo n, so ``fold(a|b) = (fold(a|) * 31**len(b)
    + fold(b)) % n``. Plain arithmetic, code-generated."""
    head = (h_a * 31 + 124) % num_buckets
    return ((head * p_b + h_b) % num_buckets).cast("int")


def fast_bucket(a: str | Column, b: str | Column, num_buckets: int) -> Column:
    """``pmod(xxhash64(a, b), n)``: code-generated and well spread."""
    return F.pmod(F.xxhash64(a, b), F.lit(num_buckets)).cast("int")


def pair_bucket(a: str | Column, b: str | Column, num_buckets: int, hash_kind: str = "xxhash64") -> Column:
    check_buckets(num_buckets)
    if hash_kind == "xxhash64":
        return fast_bucket(a, b, num_buckets)
    if hash_kind == "polynomial":
        return polynomial_bucket(a, b, num_buckets)
    raise ValueError(f"hash_kind must be 'xxhash64' or 'polynomial', not {hash_kind!r}")


# Longs of one row of a bitmap of buckets.
BITMAP_WORDS = 64


def bucket_bitmap(buckets: DataFrame, bucket: str = "bucket") -> DataFrame:
    """``(chunk int, words array<bigint>)``: the bucket ids (0 and up) as a bitmap, a row
    for every 4,096 buckets of which one is there. 10^8 buckets take 24,415 rows
    of 512 bytes. Bits are combined within tasks; no task holds more than a row of it."""
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(bucket, F.lit(64)))
    words = buckets.groupBy(F.floor(F.col(bucket) / 64).cast("int").alias("_word")).agg(F.bit_or(one).alias("_bits"))
    place = F.pmod("_word", F.lit(BITMAP_WORDS)).alias("_at")
    chunks = words.groupBy(F.floor(F.col("_word") / BITMAP_WORDS).cast("int").alias("chunk")).agg(
        F.map_from_entries(F.collect_list(F.struct(place, "_bits"))).alias("_set"))
    zero = F.lit(0).cast("bigint")
    return chunks.select("chunk", F.transform(
        F.sequence(F.lit(0), F.lit(BITMAP_WORDS - 1)), lambda i: F.coalesce(F.try_element_at("_set", i), zero)).alias("words"))


def bitmap_bytes(num_buckets: int) -> int:
    """Bytes that ``bucket_bitmap`` takes at most: a row's words, and 48 bytes beside them."""
    return -(-num_buckets // (64 * BITMAP_WORDS)) * (8 * BITMAP_WORDS + 48)


def in_bitmap(rows: DataFrame, bitmap: DataFrame, bucket: str = "bucket") -> DataFrame:
    """The rows whose bucket is in ``bitmap``, probed by shift and mask."""
    chunk = F.shiftright(bucket, 12).alias("chunk")
    word = F.get("words", F.shiftright(bucket, 6).bitwiseAND(F.lit(BITMAP_WORDS - 1)))
    met = rows.select("*", chunk).join(bitmap, "chunk")
    return met.where(F.getbit(word, F.col(bucket).bitwiseAND(F.lit(63))) == 1).drop("chunk", "words")
