from pyspark.sql import functions as F

from basketry.operators.graph import degree_count, synthetic_edges
from basketry.sources.formats import parse_edge_lines
from basketry.sources.sinks import degree_label
from basketry.sources.tables import edges
from conftest import SF_SMALL


def test_edge_line_cases(spark):
    lines = ["", "  ", "a", "a b c", "a b", "  a\t b ", "c c", "a b", "a_IN b_OUT"]
    df = spark.createDataFrame([(s,) for s in lines], "value string")
    parsed = parse_edge_lines(df)
    assert sorted(tuple(r) for r in parsed.collect()) == sorted(
        [("a", "b"), ("a", "b"), ("c", "c"), ("a", "b"), ("a_IN", "b_OUT")]
    )
    got = {(r.vertex, r.direction): r.degree for r in degree_count(parsed).collect()}
    # duplicates count again, self-loop counts both ways, suffix-like names stay intact
    assert got == {
        ("a", "out"): 3, ("b", "in"): 3, ("c", "out"): 1, ("c", "in"): 1,
        ("a_IN", "out"): 1, ("b_OUT", "in"): 1,
    }


def test_degree_invariants(spark):
    e = edges(spark, SF_SMALL)
    n_edges = e.count()
    d = degree_count(e)
    sums = {r.direction: r.s for r in d.groupBy("direction").agg(F.sum("degree").alias("s")).collect()}
    assert sums == {"in": n_edges, "out": n_edges}


def test_null_endpoints_are_skipped(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (1, None)], "src long, dst long")
    assert {tuple(r) for r in degree_count(df).collect()} == {(1, "out", 1), (2, "in", 1)}


def test_degree_label(spark):
    df = spark.createDataFrame([("v", "in", 3)], "vertex string, direction string, degree long")
    assert df.select(degree_label().alias("x")).first().x == "in=3"


def test_synthetic_edges(spark):
    e = synthetic_edges(spark, num_vertices=50, num_edges=60_000, seed=42, num_partitions=4)
    stats = e.agg(
        F.count("*").alias("n"),
        F.sum((F.col("src") == F.col("dst")).cast("int")).alias("loops"),
        F.min("src").alias("lo_s"), F.max("src").alias("hi_s"),
        F.min("dst").alias("lo_d"), F.max("dst").alias("hi_d"),
        F.count_distinct("src", "dst").alias("distinct_edges"),
    ).first()
    assert stats.n == 60_000 and stats.loops == 0
    assert stats.lo_s == 0 and stats.hi_s == 49 and stats.lo_d == 0 and stats.hi_d == 49
    assert stats.distinct_edges == 50 * 49  # every possible edge is drawn at this density
    # the same seed gives the same edges, however they are partitioned
    again = synthetic_edges(spark, 50, 60_000, seed=42, num_partitions=7)
    assert e.exceptAll(again).count() == 0
    other = synthetic_edges(spark, 50, 60_000, seed=43, num_partitions=4)
    assert e.exceptAll(other).count() > 0


def test_draws_of_an_edge_are_independent(spark):
    """Offsets of no seed repeat the sources of another, in any alignment."""
    n = 3000
    rows = {seed: [(r.src, (r.dst - r.src - 1) % 1000) for r in synthetic_edges(spark, 1000, n, seed, 4).collect()] for seed in (42, 43)}
    for a in rows.values():
        for b in rows.values():
            for shift in (0, n // 4):
                same = sum(x[0] == y[1] for x, y in zip(a[shift:], b))
                assert same < 30


def test_scalar_map_demo(spark):
    # the reference's demo: parallelize(range(100)).map(x * 2)
    out = [r.value for r in spark.range(100).select((F.col("id") * 2).alias("value")).collect()]
    assert out == [2 * i for i in range(100)]
