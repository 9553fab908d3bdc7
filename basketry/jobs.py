"""Batch jobs: read a source, run an operator, write the result.

One function per task of the reference; from the command line
(``python -m basketry.jobs ...``, or ``spark-submit run_job.py ...`` with
the package shipped by ``--py-files``):

    word-count     <text in> <out>
    degrees        <edge lines in> <out>
    generate-edges <out> [--vertices 100000] [--edges 1000000000] [--seed 42]
    basket-stats   <purchases csv> <out dir> [-k 10] [--date-format dd/MM/yyyy]
    basket-lines   <purchases csv> <out> [--date-format dd/MM/yyyy]
    pcy            <basket lines in> <out> [--support 3] [--buckets 100] [--pass1 <out>] [--sorted]
    rules          <purchases csv> <pair file> <out> [--confidence 0.05] [--interest 0.02]

Every job writes with executors; nothing is collected to the driver. Intermediate
data that a job stores under the shared checkpoint folder is deleted when it
ends, also when it fails.
"""

from __future__ import annotations

import argparse
import contextlib
import sys
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators import baskets as B
from basketry.operators import rules as R
from basketry.operators.graph import degree_count, synthetic_edges
from basketry.operators.pairs import frequent_pairs, pcy_pass1, pcy_pass2, prepare_baskets
from basketry.operators.text import word_count
from basketry.plans.lineage import materialize, release_scratch, scratch_mark
from basketry.sources import formats, sinks, tables


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes what is stored under the checkpoint folder inside the block."""
    before = scratch_mark()
    try:
        yield
    finally:
        release_scratch(spark, before)


def word_count_job(spark: SparkSession, source: str, target: str) -> None:
    counts = word_count(formats.read_text_lines(spark, source))
    sinks.write_key_value_text(counts, "word", "n", target)


def degree_job(spark: SparkSession, source: str, target: str) -> None:
    degrees = degree_count(formats.parse_edge_lines(formats.read_text_lines(spark, source)))
    sinks.write_key_value_text(degrees, "vertex", sinks.degree_label(), target)


def basket_stats_job(spark: SparkSession, source: str, target: str, k: int = 10,
                     date_format: str | None = None) -> None:
    """f1-f4 as CSV folders ``f1 f2 f3 f3_pairs f4 f4_top`` under ``target``."""
    out = target.rstrip("/")
    with scratch(spark):
        # the CSV is read and checked once, baskets are prepared and pairs counted once
        purchases = materialize(formats.read_purchases_csv(spark, source, date_format))
        sinks.write_csv(B.top_customers_by_distinct_products(purchases, k), f"{out}/f1")
        sinks.write_csv(B.baskets_per_month(purchases), f"{out}/f2")
        counts = materialize(B.pair_counts_per_month(B.month_baskets(purchases), sort=False))
        sinks.write_csv(B.top_pairs(counts), f"{out}/f3")
        sinks.write_csv(counts.orderBy("month", F.desc("n_baskets"), "item_a", "item_b"), f"{out}/f3_pairs")
        ranked = B.irregularity_with_rank(purchases, "zero").orderBy(F.desc("rank_key"), "customer_id")
        sinks.write_csv(
            ranked.select("customer_id", sinks.fixed_decimals("stddev_items").alias("stddev_items")), f"{out}/f4"
        )
        sinks.write_csv(B.most_irregular_customers(purchases, 1, "null"), f"{out}/f4_top")


def basket_lines_job(spark: SparkSession, source: str, target: str, date_format: str | None = None) -> None:
    sinks.write_basket_lines(B.to_basket_lines(formats.read_purchases_csv(spark, source, date_format)), target)


def basket_line_items(spark: SparkSession, source: str) -> DataFrame:
    """``(basket_id, item)`` from basket lines; lines with one id merge."""
    return formats.basket_lines_to_items(formats.parse_basket_lines(formats.read_text_lines(spark, source)))


def pcy_job(spark: SparkSession, source: str, target: str, min_support: int = 3,
            num_buckets: int | None = 100, hash_kind: str = "polynomial", pass1_target: str | None = None,
            ordered: bool = False) -> None:
    """Frequent pairs of basket lines; with ``pass1_target`` also the pass-1
    frequent items and buckets as tagged key/value lines."""
    with scratch(spark):
        baskets = prepare_baskets(basket_line_items(spark, source), keys=("basket_id",))
        if pass1_target is None or num_buckets is None:
            sinks.write_pairs(frequent_pairs(baskets, min_support, num_buckets, hash_kind), target, ordered=ordered)
            return
        items, buckets = pcy_pass1(baskets, min_support, num_buckets, hash_kind)
        # stored: written to the pass-1 file and used by pass 2 from one expansion of the pairs
        buckets = baskets.store(buckets)
        sinks.pass1_lines(items, buckets).write.mode("errorifexists").text(pass1_target)
        sinks.write_pairs(pcy_pass2(baskets, items, buckets, min_support, num_buckets, hash_kind), target,
                          ordered=ordered)


def generate_edges_job(spark: SparkSession, target: str, num_vertices: int = 100_000,
                       num_edges: int = 1_000_000_000, seed: int = 42) -> None:
    """Synthetic edge list as ``src dst`` text lines, written in parallel."""
    sinks.edge_lines(synthetic_edges(spark, num_vertices, num_edges, seed)).write.mode("errorifexists").text(target)


def rules_job(spark: SparkSession, purchases_csv: str, pairs_path: str, target: str,
              min_confidence: float = R.DEFAULT_CONFIDENCE, min_interest: float = R.DEFAULT_INTEREST) -> None:
    with scratch(spark):
        purchases = formats.read_purchases_csv(spark, purchases_csv)
        baskets = prepare_baskets(tables.basket_items(purchases))
        rules = R.association_rules(formats.read_pairs(spark, pairs_path), baskets.items, min_confidence,
                                    min_interest, total=baskets.n_baskets, support=baskets.support())
        sinks.write_csv(rules, target)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="basketry.jobs")
    sub = parser.add_subparsers(dest="job", required=True)
    for name in ("word-count", "degrees", "basket-stats", "basket-lines"):
        p = sub.add_parser(name)
        p.add_argument("source")
        p.add_argument("target")
        if name.startswith("basket"):
            p.add_argument("--date-format", default=None)
        if name == "basket-stats":
            p.add_argument("-k", type=int, default=10)
    p = sub.add_parser("pcy")
    p.add_argument("source")
    p.add_argument("target")
    p.add_argument("--support", type=int, default=3)
    p.add_argument("--buckets", type=int, default=100)
    p.add_argument("--pass1", default=None)
    p.add_argument("--sorted", action="store_true")
    p = sub.add_parser("generate-edges")
    p.add_argument("target")
    p.add_argument("--vertices", type=int, default=100_000)
    p.add_argument("--edges", type=int, default=1_000_000_000)
    p.add_argument("--seed", type=int, default=42)
    p = sub.add_parser("rules")
    p.add_argument("purchases")
    p.add_argument("pairs")
    p.add_argument("target")
    p.add_argument("--confidence", type=float, default=R.DEFAULT_CONFIDENCE)
    p.add_argument("--interest", type=float, default=R.DEFAULT_INTEREST)
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"basketry-{args.job}").getOrCreate()
    if args.job == "word-count":
        word_count_job(spark, args.source, args.target)
    elif args.job == "degrees":
        degree_job(spark, args.source, args.target)
    elif args.job == "basket-stats":
        basket_stats_job(spark, args.source, args.target, args.k, args.date_format)
    elif args.job == "basket-lines":
        basket_lines_job(spark, args.source, args.target, args.date_format)
    elif args.job == "pcy":
        pcy_job(spark, args.source, args.target, args.support, args.buckets, pass1_target=args.pass1,
                ordered=args.sorted)
    elif args.job == "generate-edges":
        generate_edges_job(spark, args.target, args.vertices, args.edges, args.seed)
    elif args.job == "rules":
        rules_job(spark, args.purchases, args.pairs, args.target, args.confidence, args.interest)


if __name__ == "__main__":
    main(sys.argv[1:])
