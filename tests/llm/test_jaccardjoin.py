"""N-gram Jaccard join against all pairs, its bound, and connected components."""

import random
import re

import numpy as np
import pytest
from helpers_llm import odd_documents

from basketry.llm import jaccardjoin as jj
from basketry.llm.components import connected_components

WORD = re.compile("[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """(n, component) of each row (id, text)."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            o = len(a & sets[j])
            if a and sets[j] and 100 * o >= 75 * (len(a) + len(sets[j]) - o) and top(i) != top(j):
                root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return [(len(a), least.get(top(i)) if a else rows[i][0]) for i, a in enumerate(sets)]


def near_copies(rng, n_families, copies, length, kinds=3000):
    """Families whose members differ by changed, dropped and added words, around the threshold."""
    rows = []
    for _ in range(n_families):
        base = [f"w{rng.randrange(kinds)}" for _ in range(rng.randrange(5, length))]
        for _ in range(rng.randrange(1, copies)):
            w = list(base)
            for _ in range(int(len(w) * rng.random() * 0.05)):
                k = rng.randrange(len(w))
                w[k:k + 1] = rng.choice([[], ["New%d" % rng.randrange(9000)], [w[k], "x%d" % rng.randrange(9000)]])
            rows.append(" ".join(w))
    return rows


def run(spark, rows, **more):
    docs = spark.createDataFrame([(i, d, t, "x") for i, (d, t) in enumerate(rows)], "nr int, doc_id long, text string, n_shingles string").repartition(3)
    got = {r.row.nr: r for r in jj.jaccard_components(docs, **more).collect()}
    assert len(got) == len(rows)
    return [got[i] for i in range(len(rows))]


@pytest.mark.parametrize("small", [False, True])
def test_equals_all_pairs(spark, monkeypatch, small):
    if small:  # many ranges, flushes and tiles
        for name, value in (("RANGE_ENTRIES", 64), ("FLUSH_ENTRIES", 500), ("TILE_SETS", 5), ("TILE_SHINGLES", 700), ("FAN_OUT", 3), ("FILTER_BITS", 1)):
            monkeypatch.setattr(jj, name, value)
    rng = random.Random(5)
    texts = near_copies(rng, 25, 12, 120)
    passage = " ".join(f"p{i}" for i in range(25))
    texts += [f"{passage} " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(60))) for _ in range(30)]
    texts += ["one two", "One two", "one two three", "", None, " \n", "a b c d e", "a b c d e", texts[0], texts[1].upper(), "z " * 40, "z " * 50]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = list(zip(ids, texts)) + [(3, texts[2]), (None, texts[3]), (None, "only null id here now"), (7, "")]
    got = run(spark, rows)
    assert [(r.n_shingles, r.component_id) for r in got] == brute(rows)
    keepers = [r.component_id for r, (n, _) in zip(got, brute(rows)) if r.first and n]
    assert len(keepers) == len(set(keepers)) == len({r.component_id for r in got if r.n_shingles})
    assert all(r.first for r in got if not r.n_shingles) and {r.row.n_shingles for r in got} == {"x"}


def test_one_large_family(spark, monkeypatch):
    """Near copies of one text, some of them under the threshold to it."""
    monkeypatch.setattr(jj, "TILE_SETS", 40)
    rng = random.Random(6)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randrange(14)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    assert [(r.n_shingles, r.component_id) for r in run(spark, rows)] == brute(rows)


def test_tree_never_loses_a_link():
    rng = random.Random(7)
    sets = [np.unique(np.array([rng.randrange(2**63) if rng.random() < 0.1 else k * 7919 for k in range(rng.randrange(1, 90))], np.uint64)) for _ in range(120)]
    tree = jj.CountTree(sets, 64)
    everyone = np.ones(len(sets), bool)
    for i, a in enumerate(sets):
        found = set(tree.candidates(tree.points[i], len(a), everyone, 75).tolist())
        for j, b in enumerate(sets):
            if jj.overlap(a, b) >= jj.needed(len(a), len(b)):
                assert j in found
    assert sum(len(tree.candidates(tree.points[i], len(a), everyone, 75)) for i, a in enumerate(sets)) < 0.6 * len(sets) ** 2


def test_needed_is_the_threshold():
    for a in range(1, 60):
        for b in range(1, 60):
            for i in range(min(a, b) + 1):
                assert (i >= jj.needed(a, b)) == (100 * i >= 75 * (a + b - i))


def test_first_shingles_meet():
    """Sets that link share enough of their first shingles for each to leave out some."""
    rng = random.Random(8)
    linked = 0
    for _ in range(2000):
        pool = [rng.randrange(2**63) for _ in range(rng.randrange(1, 60))]
        a, b = (np.unique(np.array([x for x in pool if rng.random() < 0.95] or pool[:1], np.uint64)) for _ in range(2))
        if jj.overlap(a, b) >= jj.needed(len(a), len(b)):
            linked += 1
            common = set(jj.first_shingles(a).tolist()) & set(jj.first_shingles(b).tolist())
            least = [-(-15 * len(x) // 100) for x in (a, b)]
            assert len(common) >= max(least) and len(common) > sum((n - 1) // 2 for n in least)
    assert linked > 500


def test_shingles_are_distinct_sequences():
    words = jj.WordHashes()
    rng = random.Random(10)
    for _ in range(100):
        text = " ".join(rng.choice(["a", "bb", "CCC", "d" * 30, "é"]) for _ in range(rng.randrange(12)))
        found = jj.shingle_set(text, words)
        assert len(found) == len(shingles(text)) and (np.diff(found.astype(object)) > 0).all()
    assert not set(jj.shingle_set("a b c", words).tolist()) & set(jj.shingle_set("a b c d", words).tolist())
    # longer words come first
    assert jj.shingle_set("aaaaaaaa bbbbbbbb cccccccc dddddddd eeeeeeee", words)[0] < jj.shingle_set("a b c d e", words)[0]


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(100, 160)] + [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(200, k) for k in range(201, 300)] + [(5, 5), (None, 3), (100, 101)]
    root = {}

    def top(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    frame = spark.createDataFrame(edges, "a long, b long")
    assert {r.node: r.root for r in connected_components(frame).collect()} == {i: top(i) for i in root}
    assert connected_components(frame.limit(0)).collect() == []


def test_components_of_edges_that_change_between_runs(spark):
    """A plan that gives its edges another direction each time it runs connects the same nodes."""
    def turned(batches):
        import random as r

        import pyarrow as pa

        for batch in batches:
            ends = [(i, i + 1) if r.random() < 0.5 else (i + 1, i) for i in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in ends]), pa.array([e[1] for e in ends])], names=["a", "b"])

    edges = spark.range(80).where("id % 40 <> 39").mapInArrow(turned, "a long, b long")
    assert {r.node: r.root for r in connected_components(edges).collect()} == {i: i - i % 40 for i in range(80)}


def test_odd_and_empty(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(((r.row.doc_id, r.n_shingles, r.component_id) for r in jj.jaccard_components(docs).collect()), key=str)
    assert got == sorted(((d, n, c) for (d, _), (n, c) in zip(rows, brute(rows))), key=str)
    assert jj.jaccard_components(docs.limit(0)).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in jj.documents(spark, sf).collect()]
    want = {d: (n, c) for (d, _), (n, c) in zip(rows, brute(rows))}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jj.op8_jaccard_join(spark, sf).collect()}
    assert got == want and len({c for _, c in got.values()}) < len(got)


@pytest.mark.parametrize("small", [False, True])
def test_every_link(spark, monkeypatch, small):
    """All links between different sets, each once, not only a forest that connects them."""
    if small:
        for name, value in (("RANGE_ENTRIES", 64), ("FLUSH_ENTRIES", 500), ("TILE_SETS", 5), ("TILE_SHINGLES", 700), ("FAN_OUT", 3), ("FILTER_BITS", 1)):
            monkeypatch.setattr(jj, name, value)
    rng = random.Random(8)
    texts = near_copies(rng, 20, 14, 120) + ["", None, "a b c", "a b c"]
    texts += texts[:6] + [texts[0].upper()]
    want, copies = set(), {}
    for t in texts:
        copies[shingles(t)] = copies.get(shingles(t), 0) + 1
    kinds = [k for k in copies if k]
    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            if 100 * len(a & b) >= 75 * len(a | b):
                want.add(frozenset([a, b]))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    got = jj.jaccard_links(docs).collect()
    pairs = [frozenset([shingles(r.row_a.text), shingles(r.row_b.text)]) for r in got]
    assert len(pairs) == len(set(pairs)) and set(pairs) == want
    assert all((r.copies_a, r.copies_b) == (copies[shingles(r.row_a.text)], copies[shingles(r.row_b.text)]) for r in got)
    # a forest has no triangles
    assert any(len(x | y) == 3 and x ^ y in want for x in want for y in want)
