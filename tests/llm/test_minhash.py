"""b-bit MinHash against all pairs, its estimate, its tiles, odd rows."""

import random
import re

import numpy as np
import pytest
from helpers_llm import odd_documents

from basketry.llm import minhash as mh

WORD = re.compile("[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[k:k + 4]) for k in range(max(1, len(w) - 3))) if w else frozenset()


def brute(rows, threshold=80):
    """(n, component) of each row (id, text), by all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            o = len(a & sets[j])
            if a and sets[j] and 100 * o >= threshold * (len(a) + len(sets[j]) - o) and top(i) != top(j):
                root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return [(len(a), least.get(top(i)) if a else rows[i][0]) for i, a in enumerate(sets)]


def families(rng, n, copies, length, kinds=3000):
    """Texts whose copies have changed, dropped and added words, on both sides of the threshold."""
    rows = []
    for _ in range(n):
        base = [f"w{rng.randrange(kinds)}" for _ in range(rng.randrange(1, length))]
        for _ in range(rng.randrange(1, copies)):
            w = list(base)
            for _ in range(int(len(w) * rng.random() * 0.08)):
                k = rng.randrange(len(w))
                w[k:k + 1] = rng.choice([[], ["New%d" % rng.randrange(9000)], [w[k], "x%d" % rng.randrange(9000)]])
            rows.append(" ".join(w))
    return rows


def run(spark, rows, **more):
    docs = spark.createDataFrame([(i, d, t, "x") for i, (d, t) in enumerate(rows)], "nr int, doc_id long, text string, n_shingles string").repartition(3)
    got = {r.row.nr: r for r in mh.minhash_components(docs, **more).collect()}
    assert len(got) == len(rows)
    return [(got[i].n_shingles, got[i].component_id) for i in range(len(rows))]


def test_equals_all_pairs(spark):
    rng = random.Random(5)
    texts = families(rng, 60, 8, 60) + families(rng, 3, 60, 90) + ["one", "one two", "ONE two", "one two three four", "", None, " \n"]
    texts += rng.choices(texts, k=60)
    rng.shuffle(texts)
    rows = [(rng.randrange(10**6) if rng.random() > 0.05 else None, t) for t in texts]
    assert run(spark, rows) == brute(rows)


@pytest.mark.parametrize("tile", [2, 7])
def test_tiles_and_groups_of_any_size(spark, monkeypatch, tile):
    """Families far over the tiles' bounds, with members that link with few others or none."""
    monkeypatch.setattr(mh, "TILE_SETS", tile)
    monkeypatch.setattr(mh, "TILE_SIGNATURES", tile)
    monkeypatch.setattr(mh, "PART_SIGNATURES", 5)
    rng = random.Random(tile)
    rows = list(enumerate(families(rng, 3, 50, 80) + families(rng, 5, 9, 12)))
    chain = [f"c{k}" for k in range(60)]
    for k in range(25):  # each links with the next ones only
        chain = chain[2:] + [f"d{k}", f"e{k}"]
        rows.append((1000 + k, " ".join(chain)))
    assert run(spark, rows) == brute(rows)


def test_chance_of_the_bound():
    """Pairs of similarity 0.8 always pass the bound on the signature, unrelated ones never do; the estimate is right on average."""
    rng, least = np.random.default_rng(7), mh.least_matches(80)
    assert 130 <= least <= 150
    found, far = [], []
    for _ in range(300):
        pool = rng.integers(0, 2**63, 1400, np.uint64)
        a, b, c = pool[:900], pool[100:1000], pool[1000:]
        sa, sb, sc = (mh.signature(mh.minima(np.sort(x)))[None] for x in (a, b, c))
        found.append(int(mh._equal(sa, sb[0])[0]))
        far.append(int(mh._equal(sa, sc[0])[0]))
    assert min(found) >= least and max(far) < 100
    assert abs(np.mean([mh.estimate(m) for m in found]) - 0.8) < 0.01 and abs(np.mean([mh.estimate(m) for m in far])) < 0.02


def test_spark_and_numpy_agree_on_matches(spark):
    rng = np.random.default_rng(8)
    a, b = (mh.signature(mh.minima(np.sort(rng.integers(0, 2**63, 5, np.uint64)))) for _ in range(2))
    row = spark.createDataFrame([(a.tolist(), b.tolist())], "a array<long>, b array<long>").select(mh._matches("a", "b").alias("m"), mh._matches("a", "a").alias("all")).first()
    assert row.m == mh._equal(a[None], b)[0] and row["all"] == mh.MINIMA


def test_family_makes_rows_in_proportion(spark, monkeypatch):
    """Members that link with their original: the rows that confirm links grow with the family, not its square."""
    monkeypatch.setattr(mh, "TILE_SETS", 16)
    rng = random.Random(9)
    base = [f"w{k}" for k in range(200)]
    made = {}
    for n in (100, 400):
        texts = [" ".join(base)] + [" ".join(base[:k] + [f"n{i}"] + base[k + 1:]) for i, k in enumerate(rng.choices(range(200), k=n - 1))]
        seen = []
        plain = mh._confirmed
        monkeypatch.setattr(mh, "_confirmed", lambda b, jobs, t: (seen.append(jobs.count()), plain(b, jobs, t))[1])
        assert {c for _, c in run(spark, list(enumerate(texts)))} == {0}
        monkeypatch.setattr(mh, "_confirmed", plain)
        made[n] = sum(seen)
    assert made[400] <= 4.2 * made[100] and made[100] < 200


def test_odd_rows(spark):
    docs = odd_documents(spark).withColumn("class", mh.F.lit("c")).withColumn("number", mh.F.lit(1))
    out = mh.minhash_components(docs).collect()
    rows = [(r.row.doc_id, r.row.text) for r in out]
    assert [(r.n_shingles, r.component_id) for r in out] == brute(rows)
    assert mh.minhash_components(docs.limit(0)).collect() == []
    same = spark.createDataFrame([(5, "a b c d e f")] * 40 + [(None, "a b c d e f"), (3, "A b c d e f"), (None, None)], "doc_id long, text string")
    assert {(r.n_shingles, r.component_id) for r in mh.minhash_components(same).collect()} == {(3, 3), (0, None)}


def test_query(spark):
    rows = mh.op11_minhash(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = brute([(r.doc_id, r.text) for r in docs])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {r.doc_id: w for r, w in zip(docs, want)}
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
