"""Fixtures derived from the driver's Parquet tables.

The reference reads a purchases CSV, a text file and an edge list; the test
tables replace them:

* purchases: ``orders`` x ``lineitem`` x ``part`` (one row per line item)
* sparse purchases: the same with the part key as the product
* edges: ``lineitem`` (``l_partkey -> l_suppkey``)
* text: ``documents.text``

Only the columns each fixture needs are selected, so the Parquet scans read
narrow schemas; the joins are planned by Catalyst (broadcast when a scanned
side is small by file size, sort-merge otherwise).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions.text import split_on_delimiters


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def purchases(spark: SparkSession, sf_dir: str, items: str = "name") -> DataFrame:
    """``(customer_id bigint, date date, product string, year int, month int, day int)``.

    ``items="name"`` uses ``p_name`` (few, dense items); ``items="partkey"``
    uses the part key as a string (many, sparse items) and skips ``part``.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    if items == "name":
        part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
        joined = joined.join(part, joined.l_partkey == part.p_partkey)
        product = F.col("p_name")
    elif items == "partkey":
        product = F.col("l_partkey").cast("string")
    else:
        raise ValueError(f"items must be 'name' or 'partkey', not {items!r}")
    date = F.to_date("o_orderdate")
    return joined.select(
        F.col("o_custkey").alias("customer_id"),
        date.alias("date"),
        product.alias("product"),
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.dayofmonth(date).alias("day"),
    )


def basket_items(purchases_df: DataFrame) -> DataFrame:
    """``(customer_id, date, item)``: the baskets of the purchases. Null items and
    repeats stay: ``prepare_baskets`` counts every basket and removes both."""
    return purchases_df.select("customer_id", "date", F.col("product").alias("item"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src bigint, dst bigint)``: part -> supplier for every line item."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst")
    )


def documents_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id bigint, text string)``."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def document_words(spark: SparkSession, sf_dir: str, lists: bool = False) -> DataFrame:
    """``(doc_id bigint, item string)``: every document as a basket of its words
    (see ``functions.text``), repeats included; a document without words is a
    basket of one null item. With ``lists`` a document is one row with all its
    words, ``(doc_id bigint, item array<string>)``."""
    words = F.array_remove(split_on_delimiters("text"), "")
    return table(spark, sf_dir, "documents").select("doc_id", (words if lists else F.explode_outer(words)).alias("item"))
