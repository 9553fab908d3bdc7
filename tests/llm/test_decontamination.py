"""Decontamination against a brute-force search of word windows."""

import hashlib
import re

import pytest

from basketry.llm import decontamination as dec

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window=13):
    owners = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            owners.setdefault(tuple(w[i:i + window]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in {len(k) for k in owners}:
            for i in range(len(w) - n + 1):
                if (own := owners.get(tuple(w[i:i + n]))) is not None:
                    found |= own
                    hit.update(range(i, i + n))
        out.append((doc, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


LONG = " ".join(f"w{i}" for i in range(20))
ITEMS = [(1, LONG), (10, "Kurze Frage, ÄÖ?"), (2, ""), (3, None), (4, "w5 w6"), (1, LONG), (7, "a b a b a b a b a b a b a b a b")]
DOCS = [
    (1, LONG), (2, None), (3, ""), (4, "kurze FRAGE; ÄÖ " + "x " * 100), (4, "kurze frage äö"), (5, "w5\tw6 w5 w6"), (6, "aw5 w6"),
    (7, "y " * 500 + LONG + " z" * 500), (8, " ".join(f"w{i}" for i in range(3, 15))), (9, "a b " * 30), (None, "w5-w6"), (11, "ñ" * 30 + " w5, W6"),
]


@pytest.mark.parametrize("block", [10**6, 40])
def test_equals_brute_force(spark, block):
    docs = spark.createDataFrame([(d, t, "clash") for d, t in DOCS], "doc_id long, text string, runs string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = dec.decontaminate(docs, bench, max_block_chars=block).collect()
    got = sorted(((r.row.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in out), key=str)
    assert got == sorted(brute(DOCS, ITEMS), key=str)
    assert {r.row.runs for r in out} == {"clash"}
    for r in out:
        marked = [w for s in r.spans for w in words(r.row.text[s.start:s.end])]
        assert marked == [w for s, e in zip(r.runs[::2], r.runs[1::2]) for w in words(r.row.text)[s:e]]
        assert len(marked) == r.n_hit


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert dec.decontaminate(docs.limit(0), bench).collect() == []
    assert not any(r.contaminated for r in dec.decontaminate(docs, bench.limit(0)).collect())


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = [(d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), c) for d, n, h, i, c in brute(docs, items)]
    assert sorted(map(tuple, dec.op7_decontamination(spark, sf).collect())) == sorted(want)
    assert any(w[-1] for w in want)


def test_one_block_at_a_time(spark, monkeypatch):
    """The hits of a block are stored, and it is dropped, before the next one is read."""
    steps, blocks, stored = [], dec._blocks, dec.stored

    def read(*args):
        n, found = blocks(*args)
        return n, (steps.append("read") or b for b in found)

    monkeypatch.setattr(dec, "_blocks", read)
    monkeypatch.setattr(dec, "stored", lambda df: steps.append("stored") or stored(df))
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    dec.decontaminate(docs, bench, max_block_chars=40).collect()
    assert steps[0] == "stored" and len(steps) > 4 and steps[1:] == ["read", "stored"] * (len(steps) // 2)
