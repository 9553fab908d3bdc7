"""Elias-Fano sequences, the trie, and scores against dictionaries."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers_llm import odd_documents

from basketry.llm import eliasfano as ef
from basketry.llm import lm

WORD = re.compile("[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (5, 3), (1000, 10**7), (5000, 600), (300, 2**40), (2000, 2000), (64, 2**60)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, top, n))
    e = ef.EliasFano.build(values)
    assert (e.access(np.arange(n)) == values).all()
    x = np.r_[rng.integers(0, top + 5, 500), values, values + 1]
    assert (e.successor(x) == np.searchsorted(values, x)).all()
    if n >= 1000 and top > n:  # close to log2(u / n) + 2 bits each
        assert 8 * (e.high.nbytes + e.low.nbytes) < n * (math.log2(top / n) + 4) + 4096


def test_children():
    rng = np.random.default_rng(4)
    nodes = np.unique(rng.integers(0, 50, (400, 2)) * [1, 7], axis=0)
    nodes = nodes[nodes[:, 0] % 5 != 0]
    pointers, ids = ef.children(50, nodes[:, 0], nodes[:, 1])
    parent, child = np.repeat(np.arange(50), 360), np.tile(np.arange(360), 50)
    at, begin = ef.find_child(pointers, ids, parent, child)
    place = {tuple(x): i for i, x in enumerate(nodes.tolist())}
    assert at.tolist() == [place.get((p, c), -1) for p, c in zip(parent.tolist(), child.tolist())]
    assert (begin == np.searchsorted(nodes[:, 0], parent)).all()


def test_mapped_arrays():
    arrays = {"a": np.arange(5), "b": np.zeros(0, np.uint16), "c": np.array([1.5, 2.5])}
    raw, index = ef.packed(arrays)
    back = ef.mapped(raw, index)
    assert all((back[k] == v).all() and back[k].dtype == v.dtype for k, v in arrays.items())


def words(text):
    return [*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


class Brute:
    def __init__(self, texts):
        rows = [[None, *words(t)] for t in texts]
        self.c = Counter(w for r in rows for w in r[1:])
        self.total, self.kinds = sum(self.c.values()), len(self.c)
        pairs = Counter(g for r in rows for g in zip(r, r[1:]))
        self.pairs = {g: n for g, n in pairs.items() if n >= lm.LEAST}
        triples = Counter(g for r in rows for g in zip(r, r[1:], r[2:]))
        self.triples = {g: n for g, n in triples.items() if n >= lm.LEAST}

    def p1(self, w):
        return (self.c[w] + 1) / (self.total + self.kinds + 1)

    def p2(self, u, w):
        if not self.c[u]:
            return self.p1(w)
        kept = {g: n - lm.DISCOUNT for g, n in self.pairs.items() if g[0] == u}
        return kept.get((u, w), 0) / self.c[u] + (1 - sum(kept.values()) / self.c[u]) * self.p1(w)

    def p3(self, t, u, w):
        if (t, u) not in self.pairs:
            return self.p2(u, w)
        kept = {g: n - lm.DISCOUNT for g, n in self.triples.items() if g[:2] == (t, u)}
        n = self.pairs[t, u]
        return kept.get((t, u, w), 0) / n + (1 - sum(kept.values()) / n) * self.p2(u, w)

    def score(self, text):
        r = [None, *words(text)]
        return sum(math.log10(self.p3(r[i - 2], r[i - 1], r[i]) if i > 1 else self.p2(r[0], r[1])) for i in range(1, len(r)))


def corpus(rng, n, kinds):
    return [" ".join("w%d" % int(rng.paretovariate(0.7)) for _ in range(rng.randrange(30))).replace("w1 ", rng.choice(["W1 ", "w1\t"])) + rng.choice(["", f" r{i}"]) for i in range(n)]


def test_probabilities_sum_to_one():
    brute = Brute(corpus(random.Random(5), 60, 30))
    for t, u in [*list(brute.pairs)[:10], (None, "w1"), ("zz", "w1"), ("w1", "zz")]:
        assert sum(brute.p3(t, u, w) for w in [*brute.c, "unknown"]) == pytest.approx(1)


@pytest.mark.parametrize("top", [0, 1, 255, 256, 2**40, 2**64 - 1])
def test_packed_integers(top):
    rng = np.random.default_rng(2)
    x = rng.integers(0, top, 3000, np.uint64, endpoint=True)
    assert (lm.unpacked_ints(lm.packed_ints(x)) == x).all() and len(lm.unpacked_ints(lm.packed_ints(x[:0]))) == 0
    assert (lm.unpacked_keys(lm.packed_keys(np.sort(x))) == np.sort(x)).all()


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in lm.documents(spark, sf).collect()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    brute = Brute([t for d, t in texts.items() if not held[d]])
    rows = lm.op5_lm_score(spark, sf).collect()
    assert len(rows) == len(texts) and any(held.values())
    for r in rows:
        w = words(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(w), sum(brute.c[x] > 0 for x in w), brute.total)
        assert r.base_score == pytest.approx(sum(math.log10(brute.p1(x)) for x in w), rel=1e-9)
    # the model predicts held-out text better than single words do
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)


def whole(spark, train, probe):
    rows = [(i, t, i < len(train)) for i, t in enumerate([*train, *probe])]
    docs = spark.createDataFrame(rows, "doc_id int, text string, score boolean").repartition(3)
    return {r.row.doc_id: r for r in lm.score_whole(docs, lm.F.col("score"), ["doc_id", "score"]).collect()}


@pytest.mark.parametrize("chars,keys", [(lm.BLOCK_CHARS, lm.RANGE), (300, lm.RANGE), (300, 100)])
def test_whole_model_equals_dictionaries(spark, monkeypatch, chars, keys):
    """Every n-gram from two occurrences on is in the model, whatever the blocks and ranges."""
    monkeypatch.setattr(lm, "BLOCK_CHARS", chars)
    monkeypatch.setattr(lm, "RANGE", keys)
    rng = random.Random(3)
    train, probe = corpus(rng, 120, 40), corpus(rng, 30, 40) + ["", None, "unknown words only", "w2 unknown w2 w3 w2 w3"]
    brute, rows = Brute(train), whole(spark, train, probe)
    assert len(rows) == len(train) + len(probe) and min(brute.triples.values()) == 2
    for i, text in enumerate([*train, *probe]):
        r, w = rows[i], words(text)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(brute.c[x] > 0 for x in w), brute.total)
        assert r.base_score == pytest.approx(sum(math.log10(brute.p1(x)) for x in w), rel=1e-9)
        assert r.score == pytest.approx(brute.score(text), abs=len(w) * 1.01 / lm.GRID)


def test_rare_pair_is_in_the_query_beside_frequent_ones(spark, tmp_path):
    """A pair of two occurrences raises its second word's probability."""
    texts = ["common words all over " * 50] * 20 + ["seldom seen"] * 20
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in range(40)}
    brute = Brute([t for i, t in enumerate(texts) if not held[i]])
    for r in lm.op5_lm_score(spark, str(tmp_path)).collect():
        assert r.score == pytest.approx(brute.score(texts[r.doc_id]), abs=r.n_tokens * 1.01 / lm.GRID)


def test_whole_model_odd_and_empty(spark):
    docs = odd_documents(spark)
    out = lm.score_whole(docs, lm.F.lit(True), ["doc_id"]).collect()
    assert len(out) == docs.count() and all(r.score <= 0 and r.n_tokens >= 1 for r in out)
    none = lm.score_whole(docs, lm.F.lit(False), ["doc_id"]).collect()
    assert {(r.train_tokens, r.base_score, r.score, r.n_known) for r in none} == {(0, 0.0, 0.0, 0)}
    assert lm.score_whole(docs.limit(0), lm.F.lit(True), ["doc_id"]).collect() == []


def test_frequent_ngram_comes_once_from_each_block(spark, monkeypatch):
    """A range's rows for a third of all tokens being one word are as many as the blocks."""
    monkeypatch.setattr(lm, "BLOCK_CHARS", 500)
    texts = ["hot " * 40 + f"a{i} b{i} c{i}" for i in range(60)]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    blocks = lm.blocked(frame.select(lm.F.struct("text").alias("row"), lm.F.lit(True).alias("train"), "text"))
    held = []
    for r in blocks.collect():
        b = lm.Block(lm.pa.Table.from_pylist([{c: r[c] for c in ("block", "train", "lengths", "words", "ids")}]))
        hot = np.flatnonzero(b.words == lm.word_keys([b"hot"])[0])
        held.append((len(hot), int(b.counts[1][hot[0]]), int(b.counts[2][b.kinds[2] == hot[0] * b.wide + hot[0]][0])))
    assert len(held) > 5 and {h[0] for h in held} == {1}
    assert sum(h[1] for h in held) == 60 * 40 and sum(h[2] for h in held) == 60 * 39
