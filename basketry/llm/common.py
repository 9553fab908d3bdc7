"""Helpers shared by the operators: table reading, stored intermediates, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.plans.lineage import scratch_folder
from basketry.sources.tables import table

#: Code points that separate words in most contracts: space, tab, LF, VT, FF, CR.
SPACES = " \t\n\x0b\x0c\r"
#: The same as a regular-expression class body.
SPACE_CLASS = "\\x20\\x09-\\x0D"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def quoted(name: str) -> Column:
    """A column by its exact name, whatever characters are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_of(docs: DataFrame, keep: list[str] | None = None) -> Column:
    """The columns ``keep`` (all by default) as one struct ``row``: inside it, no name can clash with an operator's own."""
    return F.struct(*[quoted(c) for c in (docs.columns if keep is None else keep)]).alias("row")


def stored(df: DataFrame) -> DataFrame:
    """Write a derived frame once under the shared checkpoint folder and read it back.

    It outlives any executor, and its columns can be read one by one. The codec
    is one that keeps copies of texts small."""
    spark = df.sparkSession
    folder = scratch_folder(spark)
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """Add a 64-bit row number. Store the frame before reading it more than once."""
    return df.withColumn(name, F.monotonically_increasing_id())


def numbered(docs: DataFrame, keep: list[str] | None, text_col: str, *more: Column) -> DataFrame:
    """(row, text, more, number), stored once: rows get names that don't change between
    reads. The text is written once, even where ``row`` has it too."""
    names = docs.columns if keep is None else keep
    inside = text_col in names
    base = docs.select(row_of(docs, keep), *([] if inside else [F.col(text_col).alias("text")]), *more)
    base = stored(with_row_id(base, "number"))
    return base.withColumn("text", F.col("row").getField(text_col)) if inside else base


def training_remainder(doc_id, modulus: int):
    """``crc32(doc_id as text) mod modulus``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def text_slices(batches: Iterable[pa.RecordBatch], column: str, max_chars: int = 4_000_000) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut Arrow batches into slices of a few million characters, so that what a
    task holds beside its input doesn't depend on the batch size or on a few very
    long texts. Null texts come as empty ones."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        texts = [x or "" for x in values.to_pylist()]
        start = size = 0
        for i, x in enumerate(texts):
            size += len(x)
            if size >= max_chars or i + 1 == len(texts):
                yield batch.slice(start, i + 1 - start), texts[start:i + 1]
                start, size = i + 1, 0
