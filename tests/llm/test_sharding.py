"""Sharding: draws against Python, the key law at each level, even and weighted shares, gapless slots."""

import math
import struct
import zlib
from collections import Counter

import pytest
import xxhash

from basketry.llm import sharding as sh


def place(spark, tree, n=4000):
    rows = sh.descend(spark.range(n), "id", tree, "p").collect()
    return {r.id: (r.p.region, r.p.rack, r.p.shard) for r in rows}


def brute(key, tree):
    """Region, rack and shard of a long key, drawn one after the other."""
    def draw(level, i, weight):
        h = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
        for x in (level, i):
            h = xxhash.xxh64_intdigest(struct.pack("<i", x), h)
        return -math.log(((h >> 11) + 1) / (2**53 + 1)) / weight

    path = []
    for level, name in enumerate(("region", "rack", "shard")):
        weights = Counter()
        for s in tree:
            weights[getattr(s, name)] += s.weight
        best = min(weights, key=lambda i: draw(level, i, weights[i]))
        path.append(best)
        tree = [s for s in tree if getattr(s, name) == best]
    return tuple(path)


def test_descent_equals_brute_force(spark):
    trees = [sh.uniform_tree(1), sh.uniform_tree(40), sh.grown_tree(sh.uniform_tree(40)), [sh.Shard(s, s // 3 % 2, s // 5, 0.5 + s % 4) for s in range(20)]]
    for tree in trees:
        got = place(spark, tree, 1000)
        assert got == {k: brute(k, tree) for k in range(1000)}


def test_one_more_shard_takes_only_into_itself(spark):
    for n in (1, 3, 16, 40):
        tree = sh.uniform_tree(n)
        before, after = place(spark, tree), place(spark, sh.grown_tree(tree))
        moved = [k for k in before if before[k] != after[k]]
        assert {after[k][2] for k in moved} == {n}
        assert abs(len(moved) / len(before) - 1 / (n + 1)) < 0.03


@pytest.mark.parametrize("weight", [0.2, 4.0, None])
def test_movement_is_confined_at_each_level(spark, weight):
    """Children of one node with the weights they had exchange no key, whether a shard gets lighter, heavier or goes."""
    tree = [sh.Shard(s, s // 3, s // 9, 1.0 + s % 2) for s in range(27)]
    changed = [sh.Shard(s.shard, s.rack, s.region, weight if s.shard == 13 else s.weight) for s in tree if weight or s.shard != 13]
    before, after = place(spark, tree, 20_000), place(spark, changed, 20_000)
    where = (1, 4, 13)
    seen = [0, 0, 0]
    for k, a in before.items():
        b = after[k]
        for level in range(3):
            if a[level] != b[level]:
                # the two parted here: one of them is the changed child of this node
                assert where[level] in (a[level], b[level]) and a[:level] == where[:level]
                assert (a if weight != 4.0 else b)[level] == where[level]
                seen[level] += 1
                break
    assert all(seen)


def test_large_tree_is_a_small_plan(spark):
    tree = [sh.Shard(s, s // 20, s // 400) for s in range(10_000)]
    frame = sh.descend(spark.range(2000), "id", tree, "p")
    assert frame._jdf.queryExecution().analyzed().expressions().size() < 10
    rows = frame.collect()
    assert all((r.p.rack, r.p.region) == (r.p.shard // 20, r.p.shard // 400) for r in rows)
    assert [tuple(r.p) for r in rows[:100]] == [brute(k, tree) for k in range(100)]


def test_slots_of_one_hot_id(spark, monkeypatch):
    """With a third of the rows under one id and wholly equal, no bucket has much more than its share."""
    monkeypatch.setattr(sh, "ROWS_PER_BUCKET", 50)
    docs = spark.range(6000).selectExpr("if(id % 3 = 0, 7, if(id % 3 = 1, null, id)) as doc_id", "if(id % 3 = 0, 'x', string(id)) as text")
    frames = []
    monkeypatch.setattr(sh, "stored", lambda df, keep=sh.stored: frames.append(keep(df)) or frames[-1])
    out = sh.assign_shards(docs, sh.uniform_tree(4)).collect()
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    sizes = frames[0].groupBy("shard", sh.F.pmod("spread", sh.F.lit(30))).count().collect()
    assert max(r["count"] for r in sizes) < 300


def test_shares_follow_weights(spark):
    tree = [sh.Shard(0, 0, 0, 1.0), sh.Shard(1, 0, 0, 2.0), sh.Shard(2, 1, 1, 5.0)]
    got = place(spark, tree, 16000)
    for s, share in ((0, 1 / 8), (1, 2 / 8), (2, 5 / 8)):
        assert abs(sum(p[2] == s for p in got.values()) / 16000 - share) < 0.02
    assert all(p == (tree[p[2]].region, tree[p[2]].rack, p[2]) for p in got.values())


def test_bad_trees():
    with pytest.raises(ValueError):
        sh.uniform_tree(0)
    with pytest.raises(ValueError):
        sh._children([sh.Shard(0, 0, 0), sh.Shard(0, 1, 0)])
    with pytest.raises(ValueError):
        sh._children([sh.Shard(0, 0, 0, 0.0)])


def test_rows_and_slots(spark, monkeypatch):
    monkeypatch.setattr(sh, "ROWS_PER_BUCKET", 3)
    data = [(i % 50, "täxt" * (i % 7), "s") for i in range(300)] + [(None, None, "s"), (None, "", "s"), (3, None, "s")]
    docs = spark.createDataFrame(data, "doc_id long, text string, shard string")
    out = sh.assign_shards(docs, sh.uniform_tree(5), sh.uniform_tree(6)).collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in out), key=str) == sorted(((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, _ in data), key=str)
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    assert len({(r.doc_id, r.shard) for r in out}) == len({r.doc_id for r in out})
    assert sh.assign_shards(docs.limit(0), sh.uniform_tree(5)).collect() == []


def test_query(spark):
    """The whole table against Python."""
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = sh.op10_sharding(spark, sf).collect()
    assert len(rows) == len(texts) and {r.law for r in rows} == {"key"}
    tree = sh.uniform_tree(40)
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
        assert (r.region, r.rack, r.shard) == brute(r.doc_id, tree) and r.grown_shard == brute(r.doc_id, sh.grown_tree(tree))[2]
        assert r.grown_shard in (r.shard, 40)
    for shard in range(40):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
