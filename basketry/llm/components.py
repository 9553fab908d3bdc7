"""Connected components of an edge table, by minimum labels and pointer jumping.

Each round gives every node the least label among its own and its neighbours', then
the label of that label. Labels are numbers of nodes of the same component and
only fall, so the rounds end; stars and chains of n nodes take about log n rounds.
Every round is stored, which keeps plans short and survives lost executors.
Nothing is collected: the driver only learns how many labels changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (a, b: long); root is the least node of the component.

    Null ends, loops and repeated edges don't matter; no edges give no rows."""
    # stored before it is read in both directions: a second run of its plan may choose other edges
    pairs = stored(edges.where("a is not null and b is not null and a <> b").select("a", "b"))
    both = stored(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        step = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        step = stored(step)
        jump = step.select(F.col("node").alias("root"), F.col("root").alias("further"))
        # a label is a node of the same component, so it has a label too
        after = stored(step.join(jump, "root").select("node", "old", F.col("further").alias("root")))
        if after.where("root <> old").limit(1).count() == 0:
            return after.select("node", "root")
        labels = after.select("node", "root")
