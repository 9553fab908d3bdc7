"""Text formats of the reference, read with Spark's own readers.

* text lines (S1, S2): ``spark.read.text``
* purchases CSV with a header (S3-S5): explicit schema, fail fast, trimmed
* basket lines ``id,item,item,...`` (S7)
* edge lines ``src dst`` (S8)
* pair lines ``a|b<TAB>support`` (S6)
* small in-memory item lists (S9, S10)

Parsers work on a DataFrame with a ``value`` column, so they apply to files
and to lines derived from tables alike.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.text import unescaped_item

# The purchases CSV header of the reference, our names and types
# (the id is read as bigint so large customer keys do not overflow).
PURCHASES_CSV = {
    "Member_number": ("customer_id", "bigint"),
    "Date": ("date", "string"),
    "itemDescription": ("product", "string"),
    "year": ("year", "int"),
    "month": ("month", "int"),
    "day": ("day", "int"),
}

# Characters a Java String.trim() removes: every code point up to U+0020.
_JAVA_TRIM_CHARS = "".join(chr(c) for c in range(0x21))


def java_trim(col: Column) -> Column:
    """Strip leading and trailing characters <= U+0020 (no regex)."""
    return F.btrim(col, F.lit(_JAVA_TRIM_CHARS))


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(value string)``, one row per line."""
    return spark.read.text(path)


def read_purchases_csv(spark: SparkSession, path: str, date_format: str | None = None) -> DataFrame:
    """Purchases CSV with a header line; columns are bound by their names in it.

    Columns may stand in any order and further ones are ignored; a missing one
    raises ``ValueError``, and a file whose header differs from the first one's
    fails the read. Quoted fields are honoured and surrounding blanks trimmed.
    Every field of every line is checked, also when the query needs few of the
    columns: a line with too few or too many fields, or with a number that is
    not one, fails the read. ``date_format`` (e.g. ``"dd/MM/yyyy"``) turns the
    text date into a ``date``; without it the date stays text.
    """
    def reader():
        return (
            spark.read.option("header", True)
            .option("ignoreLeadingWhiteSpace", True)
            .option("ignoreTrailingWhiteSpace", True)
        )

    header = reader().csv(path).columns
    missing = [name for name in PURCHASES_CSV if name not in header]
    if missing:
        raise ValueError(f"columns missing in the header of {path}: {missing}")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    text = reader().schema(schema).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)
    # every column is read as text and stands in the filter, so no pruned plan skips its check
    bad = F.lit(False)
    for name, (_, kind) in PURCHASES_CSV.items():
        if kind != "string":
            bad = bad | (F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull())
    line = F.concat_ws(",", *[F.coalesce(F.col(f"`{name}`"), F.lit("")) for name in header])
    checked = text.where(F.when(bad, F.raise_error(F.concat(F.lit("malformed line: "), line)).cast("boolean"))
                         .otherwise(F.length(line) >= 0))
    df = checked.select(*[F.col(name).try_cast(kind).alias(alias) for name, (alias, kind) in PURCHASES_CSV.items()])
    if date_format:
        df = df.withColumn("date", F.to_date("date", date_format))
    return df


def _observed(lines: DataFrame, observation: Observation | None, skipped: dict[str, Column]) -> DataFrame:
    """``lines`` with their number and those skipped for each reason counted on the way into ``observation``."""
    if observation is None:
        return lines
    counts = [F.count_if(F.coalesce(why, F.lit(False))).alias(name) for name, why in skipped.items()]
    return lines.observe(observation, F.count(F.lit(1)).alias("lines"), *counts)


def parse_basket_lines(lines: DataFrame, value: str = "value", observation: Observation | None = None) -> DataFrame:
    """``id,item,item,...`` -> ``(basket_id string, items array<string>)``.

    Items are trimmed, empty items dropped and repeats removed (first
    occurrence kept). Lines without an item are skipped, and so are lines with
    an empty id: the id names the basket wherever lines are joined or merged, so
    a basket without one cannot be told apart. An ``observation`` gets ``lines``,
    ``no_id`` and ``no_items`` in the pass that reads them.
    """
    parts = F.split(F.col(value), ",")
    items = F.filter(
        F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), java_trim),
        lambda x: x != "",
    )
    no_id = F.coalesce(java_trim(F.get(parts, 0)), F.lit("")) == ""
    lines = _observed(lines, observation, {"no_id": no_id, "no_items": ~no_id & (F.size(items) <= 0)})
    return (
        lines.select(java_trim(F.get(parts, 0)).alias("basket_id"), F.array_distinct(items).alias("items"))
        .where((F.col("basket_id") != "") & (F.size("items") > 0))
    )


def basket_lines_to_items(baskets: DataFrame) -> DataFrame:
    """``(basket_id, items)`` -> ``(basket_id, item)``, one row per item."""
    return baskets.select("basket_id", F.explode("items").alias("item"))


# The white space that separates the fields of an edge line (Java's \s class).
_EDGE_SPACES = " \t\n\x0b\f\r"


def parse_edge_lines(lines: DataFrame, value: str = "value", observation: Observation | None = None) -> DataFrame:
    """``src dst`` -> ``(src string, dst string)``.

    Lines are trimmed and must hold exactly two whitespace-separated fields;
    empty lines and lines with one or three fields are skipped. White space is
    made single spaces' worth by ``translate`` and each line is split once,
    without a regex: the fields come out of a generator, so neither the filter
    nor the projection repeats the split. An ``observation`` gets ``lines``, ``empty``,
    ``one_field`` and ``many_fields`` in the pass that reads them; counting splits lines once more.
    """
    spaced = F.translate(java_trim(F.col(value)), _EDGE_SPACES[1:], " " * (len(_EDGE_SPACES) - 1))
    fields = F.array_remove(F.split(spaced, " "), "")
    size = F.greatest(F.coalesce(F.size(fields), F.lit(0)), F.lit(0))
    lines = _observed(lines, observation, {"empty": size == 0, "one_field": size == 1, "many_fields": size > 2})
    return (
        lines.select(F.explode(F.array(fields)).alias("_fields"))
        .where(F.size("_fields") == 2)
        .select(F.get("_fields", 0).alias("src"), F.get("_fields", 1).alias("dst"))
    )


def parse_pair_lines(lines: DataFrame, value: str = "value", observation: Observation | None = None) -> DataFrame:
    """``a|b<TAB>n`` -> ``(item_a string, item_b string, support bigint)``.

    Only well-formed lines are returned: one tab, one pipe, an integer
    support. ``rejected_pair_lines`` returns the others, and an ``observation``
    gets ``lines`` and ``malformed`` in the pass that reads them.
    """
    classified = _observed(_classify_pair_lines(lines, value), observation, {"malformed": ~F.col("well_formed")})
    return classified.where("well_formed").drop("line", "well_formed")


def rejected_pair_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines ``parse_pair_lines`` skips, as ``(line string)``."""
    return _classify_pair_lines(lines, value).where(~F.col("well_formed")).select("line")


def _classify_pair_lines(lines: DataFrame, value: str) -> DataFrame:
    tab = F.split(F.col(value), "\t")
    pair = F.split(F.get(tab, 0), r"\|")
    support = F.get(tab, 1).try_cast("bigint")
    well_formed = (
        (F.size(tab) == 2)
        & (F.size(pair) == 2)
        & support.isNotNull()
        & (F.get(pair, 0) != "")
        & (F.get(pair, 1) != "")
    )
    return lines.select(
        F.col(value).alias("line"),
        unescaped_item(F.get(pair, 0)).alias("item_a"),
        unescaped_item(F.get(pair, 1)).alias("item_b"),
        support.alias("support"),
        F.coalesce(well_formed, F.lit(False)).alias("well_formed"),
    )


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Pair file written by ``write_pairs`` (or the reference's PCY output)."""
    return parse_pair_lines(spark.read.text(path))


def item_list(spark: SparkSession, items: Iterable[str], name: str = "antecedent") -> DataFrame:
    """A small user-supplied item list as a one-column DataFrame (may be empty)."""
    schema = T.StructType([T.StructField(name, T.StringType())])
    return spark.createDataFrame([(item,) for item in items], schema)
