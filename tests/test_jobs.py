"""End-to-end jobs over files written from the sf0.001 tables."""

import tempfile

import pytest
from pyspark.sql import functions as F

from basketry import jobs
from basketry.operators import baskets as B
from basketry.operators import rules as R
from basketry.operators.pairs import frequent_pairs, prepare_baskets
from basketry.operators.text import word_count
from basketry.plans.lineage import ensure_checkpoint_dir
from basketry.sources import formats, tables
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def work(spark):
    d = tempfile.mkdtemp(prefix="basketry-jobs-")
    p = tables.purchases(spark, SF_SMALL)
    # the reference's CSV layout: Member_number, Date (dd/mm/yyyy), itemDescription, year, month, day
    p.select(
        F.col("customer_id").cast("int").alias("Member_number"),
        F.date_format("date", "dd/MM/yyyy").alias("Date"),
        F.col("product").alias("itemDescription"), "year", "month", "day",
    ).write.option("header", True).csv(f"{d}/baskets.csv")
    tables.documents_text(spark, SF_SMALL).select("text").write.text(f"{d}/text")
    tables.edges(spark, SF_SMALL).select(F.concat_ws(" ", "src", "dst")).write.text(f"{d}/edges.txt")
    return d


def _stored(spark):
    import glob

    return set(glob.glob(ensure_checkpoint_dir(spark).replace("file:", "", 1) + "/basketry-*"))


@pytest.fixture(autouse=True)
def nothing_left(spark, work):
    """A job deletes all that it stores."""
    from basketry.plans.lineage import release_scratch

    release_scratch(spark)
    yield
    release_scratch(spark)


def test_jobs_leave_no_folder(spark, work):
    before = _stored(spark)
    jobs.main(["basket-stats", f"{work}/baskets.csv", f"{work}/stats_cli", "-k", "3", "--date-format", "dd/MM/yyyy"])
    assert spark.read.csv(f"{work}/stats_cli/f1").count() == 3
    jobs.main(["basket-lines", f"{work}/baskets.csv", f"{work}/lines_cli", "--date-format", "dd/MM/yyyy"])
    first = spark.read.text(f"{work}/lines_cli").first().value
    assert first.split(",")[0].count("-") == 2  # an ISO date in the id
    jobs.main(["pcy", f"{work}/lines_cli", f"{work}/pairs_cli", "--pass1", f"{work}/pass1_cli"])
    jobs.main(["pcy", f"{work}/lines_cli", f"{work}/pairs_cli2"])
    jobs.main(["rules", f"{work}/baskets.csv", f"{work}/pairs_cli", f"{work}/rules_cli"])
    with pytest.raises(Exception):
        jobs.main(["pcy", f"{work}/lines_cli", f"{work}/pairs_cli"])  # the target exists
    assert _stored(spark) == before


def test_two_expansions_with_a_pass1_file(spark, work, monkeypatch):
    import basketry.operators.pairs as P

    jobs.basket_lines_job(spark, f"{work}/baskets.csv", f"{work}/lines3")
    calls = []
    monkeypatch.setattr(P, "pair_occurrences", lambda *a, f=P.pair_occurrences, **k: calls.append(1) or f(*a, **k))
    stored = []
    monkeypatch.setattr(P.BasketSet, "store", lambda self, df, f=P.BasketSet.store: stored.append(df) or f(self, df))
    jobs.pcy_job(spark, f"{work}/lines3", f"{work}/pairs3", pass1_target=f"{work}/pass1_3")
    assert len(calls) == 2
    # items, supports, codes and buckets are stored once each, so no output expands pairs anew
    assert len(stored) == 4


def test_word_count_job(spark, work):
    jobs.word_count_job(spark, f"{work}/text", f"{work}/wc")
    got = {tuple(r.value.split("\t")) for r in spark.read.text(f"{work}/wc").collect()}
    want = {(r.word, str(r.n)) for r in word_count(tables.documents_text(spark, SF_SMALL), "text").collect()}
    assert got == want


def test_degree_job(spark, work):
    jobs.degree_job(spark, f"{work}/edges.txt", f"{work}/deg")
    lines = [r.value for r in spark.read.text(f"{work}/deg").collect()]
    n_edges = tables.edges(spark, SF_SMALL).count()
    total_in = sum(int(v.split("\tin=")[1]) for v in lines if "\tin=" in v)
    total_out = sum(int(v.split("\tout=")[1]) for v in lines if "\tout=" in v)
    assert total_in == total_out == n_edges


def test_basket_stats_job(spark, work):
    jobs.basket_stats_job(spark, f"{work}/baskets.csv", f"{work}/stats")
    f2 = {(int(r[0]), int(r[1])) for r in spark.read.csv(f"{work}/stats/f2").collect()}
    want = {tuple(r) for r in B.baskets_per_month(tables.purchases(spark, SF_SMALL)).collect()}
    assert f2 == want
    f1 = spark.read.csv(f"{work}/stats/f1").count()
    f4 = spark.read.csv(f"{work}/stats/f4").count()
    customers = tables.purchases(spark, SF_SMALL).select("customer_id").distinct().count()
    assert f1 == 10 and f4 == customers
    assert spark.read.csv(f"{work}/stats/f3").count() == 12


def test_pcy_and_rules_jobs(spark, work):
    jobs.basket_lines_job(spark, f"{work}/baskets.csv", f"{work}/lines")
    jobs.pcy_job(spark, f"{work}/lines", f"{work}/pairs", min_support=3, num_buckets=100)
    got = {tuple(r) for r in formats.read_pairs(spark, f"{work}/pairs").collect()}
    items = tables.basket_items(tables.purchases(spark, SF_SMALL))
    want = {tuple(r) for r in frequent_pairs(prepare_baskets(items), 3).collect()}
    assert got == want
    jobs.rules_job(spark, f"{work}/baskets.csv", f"{work}/pairs", f"{work}/rules")
    n_rules = spark.read.csv(f"{work}/rules").count()
    want_rules = R.association_rules(formats.read_pairs(spark, f"{work}/pairs"), items).count()
    assert n_rules == want_rules


def test_pcy_job_pass1_output(spark, work):
    jobs.basket_lines_job(spark, f"{work}/baskets.csv", f"{work}/lines2")
    jobs.pcy_job(spark, f"{work}/lines2", f"{work}/pairs2", min_support=3, num_buckets=100,
                 pass1_target=f"{work}/pass1")
    lines = [r.value for r in spark.read.text(f"{work}/pass1").collect()]
    items = [v for v in lines if v.startswith("ITEM_")]
    buckets = [v for v in lines if v.startswith("BUCKET_")]
    assert items and buckets and len(items) + len(buckets) == len(lines)
    assert all(int(v.split("\t")[1]) >= 3 for v in lines)
    assert {int(v.split("\t")[0][len("BUCKET_"):]) for v in buckets} <= set(range(100))
    assert sorted(tuple(r) for r in formats.read_pairs(spark, f"{work}/pairs2").collect()) == sorted(
        tuple(r) for r in formats.read_pairs(spark, f"{work}/pairs").collect()
    )


def test_generate_edges_job(spark, work):
    jobs.generate_edges_job(spark, f"{work}/gen", num_vertices=20, num_edges=5000, seed=42)
    edges = formats.parse_edge_lines(spark.read.text(f"{work}/gen"))
    assert edges.count() == 5000
    assert edges.where("src = dst").count() == 0


def test_command_line(spark, work):
    jobs.main(["word-count", f"{work}/text", f"{work}/wc_cli"])
    assert spark.read.text(f"{work}/wc_cli").count() == spark.read.text(f"{work}/wc").count()
    jobs.main(["generate-edges", f"{work}/gen_cli", "--vertices", "5", "--edges", "100"])
    assert spark.read.text(f"{work}/gen_cli").count() == 100


def test_pcy_job_sorted_output(spark, work):
    import glob

    jobs.main(["pcy", f"{work}/lines", f"{work}/pairs_sorted", "--support", "3", "--sorted"])
    parts = sorted(glob.glob(f"{work}/pairs_sorted/part-*"))
    lines = [line.rstrip("\n") for part in parts for line in open(part, encoding="utf-8")]
    keys = [line.split("\t")[0].encode() for line in lines]
    assert keys == sorted(keys) and len(lines) == spark.read.text(f"{work}/pairs").count()
