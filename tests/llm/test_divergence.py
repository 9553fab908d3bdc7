"""The divergence audit against dictionaries and its SQL, ties, odd rows."""

import random
import re
from collections import Counter, defaultdict

import pandas as pd
import pytest
from helpers_llm import odd_documents, oracle_rows, sorted_rows

from basketry.llm import divergence as dv

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, least=10, top=10):
    """Rows of the audit from (text, lang, source), with dictionaries and all terms of all groups."""
    found, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        g = (lang or "", source or "")
        groups.add(g)
        words = TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        found[g].update(words)
        docs[g[0]].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = [s for x, s in groups if x == lang]

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares(found[lang, s]) for s in sources}
        q = shares(sum((found[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s)
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(pairs)]
            terms = sorted((-f(p[s][t], q[t]), t.encode(), t) for t in kept if found[lang, s][t] and p[s][t] > q[t])
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(terms[:top])]
    return sorted_rows(out)


def frame(spark, rows):
    return spark.createDataFrame([(t, x, s, 1) for t, x, s in rows], "text string, lang string, source string, term int").repartition(5)


def made(rng, n, kinds=60):
    words = [f"{rng.choice('abxyzÄé日')}{rng.choice('BCdé')}{k}q" if k % 3 else f"t{chr(97 + k % 26)}" for k in range(kinds)]
    rows = []
    for _ in range(n):
        lang = rng.choice(["en", "en", "en", "fr", None])
        source = rng.choice(["hot", "hot", "b", "c", "", None, "ß"])
        text = rng.choice([" ", ".", "\n", "1"]).join(rng.choices(words, k=rng.randrange(0, 30), weights=[1 / (i + 1) for i in range(kinds)]))
        rows.append((text if rng.random() > 0.05 else None, lang, source))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_dictionaries_and_sql(spark, monkeypatch, seed):
    monkeypatch.setattr(dv, "FLUSH_TERMS", 7)  # tasks pass on what they have many times
    monkeypatch.setattr(dv, "PAIRS_PER_TASK", 5)
    rows = made(random.Random(seed), 400)
    want = brute(rows)
    assert sorted_rows(dv.divergence(frame(spark, rows)).collect()) == want
    frames = {"documents": pd.DataFrame(rows, columns=["text", "lang", "source"])}
    sql = f"select lang, source, part, item, value, rank from ({dv.OP12_SQL})"
    assert sorted_rows(oracle_rows(sql, **frames)) == want


def test_ties_go_by_bytes(spark):
    """Thirty terms of one cell: the ten that are least in UTF-8, over several tasks, and other tops."""
    many = [f"w{chr(97 + i)}" for i in range(15)] + [f"é{chr(97 + i)}" for i in range(10)] + ["zz", "日本", "ÿ"]
    rows = [(" ".join(random.Random(k).sample(many, len(many))), "en", "a") for k in range(10)] + [("common words here", "en", "b")] * 30
    for top in (1, 3, 10, 40):
        got = sorted_rows(dv.divergence(frame(spark, rows), top=top).collect())
        assert got == brute(rows, top=top)
    assert len([r for r in got if r[2] == "term" and r[1] == "a"]) == 28


def test_least_documents(spark):
    rows = [("once twice twice", "en", "a")] * 9 + [("once", "en", "b")] + [("rare", "fr", "a")]
    got = sorted_rows(dv.divergence(frame(spark, rows)).collect())
    assert got == brute(rows) and {r[3] for r in got if r[2] == "term"} <= {"once"}
    for least in (1, 2, 11):
        assert sorted_rows(dv.divergence(frame(spark, rows), least_docs=least).collect()) == brute(rows, least)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [(r.text, r.lang, r.source) for r in docs.collect()]
    for least in (1, 10):
        assert sorted_rows(dv.divergence(docs, least_docs=least).collect()) == brute(rows, least)
    empty = docs.limit(0)
    assert dv.divergence(empty).collect() == [] and dv.divergence(empty).columns == ["lang", "source", "part", "item", "value", "rank"]
    nothing = spark.createDataFrame([(None, None, None), (None, None, "a")], "text string, lang string, source string")
    assert sorted_rows(dv.divergence(nothing).collect()) == [("", "", "pair", "a", 0, 1), ("", "a", "pair", "", 0, 1)]


def test_counts_beyond_64_bits_of_products(spark):
    """10^9 times a count of 10^11 needs more than 64 bits."""
    got = spark.range(1).select(dv._p(dv.F.lit(10**11), dv.F.lit(10**12), dv.F.lit(10**6)).alias("p")).first().p
    assert got == 1 + 10**9 * (10**11 + 2) // (10**12 + 2 * 10**6)


def test_query(spark):
    rows = dv.op12_divergence(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    assert sorted_rows(rows) == brute([(r.text, r.lang, r.source) for r in docs])
