"""Sharding by a hierarchical weighted hash tree.

The tree has regions, racks and shards; a shard has a weight, a rack or region
the sum of the weights below it. A key descends from the root: at each node it
draws, for each child, an exponential variate of rate ``weight`` from a hash of
(key, level, child), and goes to the child of least draw. So each child gets keys
in proportion to its weight, with as many draws a key as there are children on its
path. The tree travels as one literal, so a plan has the same size for any tree.

The draws of two children are independent and change with nothing but their own
weight. So when weights change, keys move, at each node, only into children that got
heavier (or are new) or out of those that got lighter (or went); children of one node
whose weights stayed the same exchange no key. A key that enters a region or rack
goes on by the draws there. A shard in a region of its own (``grown_tree``) therefore
takes keys only into itself, and no other key moves.

Defined cases: a null key is hashed as such and gets a shard like any other;
equal keys share a shard; null texts have no bytes and crc32 0; an empty table
gives an empty result; only the two named columns are read, so clashing names
don't matter. Rows equal in all of (key, crc32, size) get distinct slots, in
any order among themselves. Slots are numbered in buckets that a hash of key, crc32
and place in the table chooses, so that many rows of one key, or one null, or wholly
equal ones, don't meet in one task; another order of the table gives other slots.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.llm.common import documents, stored

#: Rows that one numbering bucket of a shard holds on average.
ROWS_PER_BUCKET = 2_000
#: Added to the size of every text, for its other columns.
ROW_BYTES = 16


@dataclass(frozen=True)
class Shard:
    shard: int
    rack: int
    region: int
    weight: float = 1.0


def uniform_tree(n_shards: int, shards_per_rack: int = 4, racks_per_region: int = 4) -> list[Shard]:
    """Equal shards, dealt to racks and regions in order."""
    if n_shards < 1:
        raise ValueError("at least one shard is needed")
    return [Shard(s, s // shards_per_rack, s // (shards_per_rack * racks_per_region)) for s in range(n_shards)]


def grown_tree(tree: list[Shard]) -> list[Shard]:
    """One more shard, of mean weight, in a rack and a region of its own: it takes keys only into itself."""
    after = lambda name: 1 + max(getattr(s, name) for s in tree)
    return [*tree, Shard(after("shard"), after("rack"), after("region"), sum(s.weight for s in tree) / len(tree))]


#: The levels from the root down.
LEVELS = ("region", "rack", "shard")
_CHILDREN = "array<array<struct<id: int, weight: double, at: int>>>"


def _children(tree: list[Shard]) -> list[list[list[dict]]]:
    """For each level the children of each node above it: number, weight and place among the
    nodes of the level. Equal racks of two regions are two nodes."""
    if not tree or len({s.shard for s in tree}) != len(tree):
        raise ValueError("a tree needs shards, and a shard may stand at one place of it only")
    if any(s.weight <= 0 for s in tree):
        raise ValueError("weights must be positive; leave a shard out instead of giving it none")
    out, above = [], {(): list(tree)}
    for depth, level in enumerate(LEVELS):
        nodes: dict[tuple, list[Shard]] = {}
        lists = []
        for path, members in above.items():
            groups: dict[int, list[Shard]] = {}
            for s in members:
                groups.setdefault(getattr(s, level), []).append(s)
            start = len(nodes)
            for i, group in groups.items():
                nodes[(*path, i)] = group
            lists.append([{"id": i, "weight": sum(s.weight for s in group), "at": start + k} for k, (i, group) in enumerate(groups.items())])
        out.append(lists)
        above = nodes
    return out


def _draws(key: Column, level: int, nodes: Column) -> Column:
    """An exponential variate of each child's rate, with the child; of 53 hash bits, never 0."""
    def draw(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(level), child["id"]), 11)
        variate = -F.log((bits + F.lit(1)).cast("double") / F.lit(float(2**53 + 1))) / child["weight"]
        return F.struct(variate.alias("draw"), child["id"].alias("id"), child["at"].alias("at"))

    return F.transform(nodes, draw)


def descend(docs: DataFrame, key: str, tree: list[Shard], into: str) -> DataFrame:
    """``docs`` with the column ``into``, ``struct(region, rack, shard)`` of the column ``key``."""
    names = []
    at: Column = F.lit(0)
    for level, lists in enumerate(_children(tree)):
        nodes = F.get(F.from_json(F.lit(json.dumps(lists)), _CHILDREN), at)
        names.append(f"_{into}_{LEVELS[level]}")
        docs = docs.withColumn(names[-1], F.array_min(_draws(F.col(key), level, nodes)))
        at = F.col(names[-1])["at"]
    path = F.struct(*[F.col(n)["id"].alias(level) for n, level in zip(names, LEVELS)])
    return docs.withColumn(into, path).drop(*names)


def assign_shards(
    docs: DataFrame, tree: list[Shard], grown: list[Shard] | None = None, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(doc_id, size, text_crc32, region, rack, shard, grown_shard, slot)``, a row for each row.

    ``slot`` numbers the rows of a shard from 0 without gaps. It isn't a window
    over a whole shard: rows are dealt to hash buckets of about ROWS_PER_BUCKET
    rows, numbered inside their bucket, and shifted by the counts of the shard's
    earlier buckets. Rows are stored once, without texts, for counts and numbers to agree."""
    # cast, not hash, of the text: an equal text has an equal crc32 wherever it lies
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = descend(rows, "doc_id", tree, "path")
    rows = descend(rows, "doc_id", grown, "grown") if grown else rows.withColumn("grown", F.lit(None).cast("struct<shard: int>"))
    spread = F.xxhash64("doc_id", "text_crc32", F.monotonically_increasing_id())
    rows = stored(rows.select("doc_id", "size", "text_crc32", F.col("grown.shard").alias("grown_shard"), "path.*", spread.alias("spread")))
    buckets = max(1, rows.count() // (len(tree) * ROWS_PER_BUCKET))
    rows = rows.withColumn("bucket", F.pmod("spread", F.lit(buckets)))

    offsets = (
        rows.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("rows"))
        .select("shard", "bucket", (F.sum("rows").over(W.partitionBy("shard").orderBy("bucket")) - F.col("rows")).alias("offset"))
    )
    within = F.row_number().over(W.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size"))
    return (
        rows.withColumn("within", within - 1)
        .join(offsets, ["shard", "bucket"])
        .select(
            "doc_id", "size", "text_crc32", "region", "rack", "shard", "grown_shard",
            (F.col("offset") + F.col("within")).cast("long").alias("slot"),
        )
    )


#: Shards of the production tree.
N_SHARDS = 40


def op10_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in 40 equal shards under the ``key`` law, and in 41."""
    tree = uniform_tree(N_SHARDS)
    out = assign_shards(documents(spark, sf_dir), tree, grown_tree(tree))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "region", "rack",
    )
