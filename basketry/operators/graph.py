"""In/out degrees of a directed edge list (Q2) and a synthetic edge source (Q3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def degree_count(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(vertex, direction, degree bigint)``, one row per vertex and direction.

    Each edge becomes two rows, ``(src, 'out')`` and ``(dst, 'in')``, in one
    pass over the input (``inline`` of a two-element array), then a partial +
    final aggregate counts them. Duplicate edges count again and self-loops
    are kept; a vertex without out-edges has no ``out`` row. Edges with a
    missing endpoint are not edges and are skipped.
    """
    ends = F.array(
        F.struct(F.col(src).alias("vertex"), F.lit("out").alias("direction")),
        F.struct(F.col(dst).alias("vertex"), F.lit("in").alias("direction")),
    )
    return (
        edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull())
        .select(F.inline(ends))
        .groupBy("vertex", "direction")
        .agg(F.count(F.lit(1)).alias("degree"))
    )


def synthetic_edges(spark: SparkSession, num_vertices: int, num_edges: int, seed: int = 42,
                    num_partitions: int | None = None) -> DataFrame:
    """``(src bigint, dst bigint)``: exactly ``num_edges`` edges, no self-loops.

    ``src`` is uniform on ``[0, V)``; ``dst`` is uniform on the other V-1
    vertices, drawn as an offset from ``src`` instead of redrawing, so every
    row is kept and the row count is exact. Both draws are hashes of the row id
    and the seed, so edges do not depend on partitioning; the numbers differ
    from a sequential ``java.util.Random``.
    """
    if num_vertices < 2:
        raise ValueError("need at least two vertices for an edge without self-loop")
    ids = spark.range(0, num_edges, 1, num_partitions) if num_partitions else spark.range(num_edges)
    src = F.pmod(F.xxhash64("id", F.lit(seed), F.lit("src")), F.lit(num_vertices))
    offset = F.pmod(F.xxhash64("id", F.lit(seed), F.lit("offset")), F.lit(num_vertices - 1))
    return ids.select(src.alias("src"), offset.alias("_off")).select(
        "src", ((F.col("src") + 1 + F.col("_off")) % num_vertices).alias("dst")
    )
