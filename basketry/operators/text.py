"""Word count (Q1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.text import split_on_delimiters


def word_count(df: DataFrame, text_col: str = "value") -> DataFrame:
    """``(word string, n bigint)``: occurrences of every whitespace token.

    ``explode`` feeds a hash aggregate that combines counts inside each task
    before the shuffle on ``word``, so a very frequent word sends one partial
    count per task, not one row per occurrence.
    """
    pieces = df.select(F.explode(split_on_delimiters(text_col)).alias("word"))
    words = pieces.where(F.col("word") != "")  # runs of delimiters leave empty pieces
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
