"""Sinks (K1-K3) and the text forms the reference writes.

Nothing here collects to the driver: results are written by the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.text import escaped_item


def write_key_value_text(df: DataFrame, key: str | Column, value: str | Column, path: str,
                         mode: str = "errorifexists") -> None:
    """``key<TAB>value`` lines (the default text output of a MapReduce job)."""
    key_c = F.col(key) if isinstance(key, str) else key
    value_c = F.col(value) if isinstance(value, str) else value
    df.select(F.concat_ws("\t", key_c.cast("string"), value_c.cast("string")).alias("value")).write.mode(
        mode
    ).text(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = False) -> None:
    """Comma separated text, one folder of part files."""
    df.write.mode(mode).option("header", header).csv(path)


def fixed_decimals(col: str | Column, digits: int = 4) -> Column:
    """Number as text with a fixed number of decimals (``%.4f``)."""
    return F.format_string(f"%.{digits}f", F.col(col) if isinstance(col, str) else col)


def degree_label(direction: str | Column = "direction", degree: str | Column = "degree") -> Column:
    """``in=N`` / ``out=N``."""
    d = F.col(direction) if isinstance(direction, str) else direction
    n = F.col(degree) if isinstance(degree, str) else degree
    return F.concat(d, F.lit("="), n.cast("string"))


def pair_lines(pairs: DataFrame) -> DataFrame:
    """``(item_a, item_b, support)`` -> ``a|b<TAB>n`` lines as ``(value)``. Plain names are
    written as they are, odd ones by ``functions.text.escaped_item``."""
    return pairs.select(
        F.concat(escaped_item("item_a"), F.lit("|"), escaped_item("item_b"), F.lit("\t"), F.col("support").cast("string")).alias(
            "value"
        )
    )


def write_pairs(pairs: DataFrame, path: str, mode: str = "errorifexists", ordered: bool = False) -> None:
    """``a|b<TAB>n`` lines. ``ordered=True`` writes them in byte order of the
    ``a|b`` key across part files (as a MapReduce reducer output is sorted),
    at the cost of a range-partitioned sort."""
    lines = pair_lines(pairs)
    if ordered:
        lines = lines.orderBy("value")  # the key comes first, so this is key order
    lines.write.mode(mode).text(path)


def write_basket_lines(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Basket lines from ``to_basket_lines`` as a text folder."""
    lines.select(F.col("line").alias("value")).write.mode(mode).text(path)


# Key prefixes of the reference's PCY pass-1 output.
ITEM_PREFIX = "ITEM_"
BUCKET_PREFIX = "BUCKET_"


def pass1_lines(items: DataFrame, buckets: DataFrame) -> DataFrame:
    """PCY pass-1 result as ``ITEM_<item><TAB>n`` and ``BUCKET_<id><TAB>n`` lines."""
    item_lines = items.select(
        F.concat(F.lit(ITEM_PREFIX), F.col("item"), F.lit("\t"), F.col("support").cast("string")).alias("value")
    )
    bucket_lines = buckets.select(
        F.concat(F.lit(BUCKET_PREFIX), F.col("bucket").cast("string"), F.lit("\t"),
                 F.col("count").cast("string")).alias("value")
    )
    return item_lines.unionByName(bucket_lines)


def edge_lines(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``src dst`` lines, the edge-list text format."""
    return edges.select(F.concat_ws(" ", F.col(src).cast("string"), F.col(dst).cast("string")).alias("value"))
