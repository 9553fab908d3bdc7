"""Quality rules against DuckDB and a brute-force count."""

import random
import re
from collections import Counter

import pytest
from helpers_llm import odd_documents, oracle_rows, sorted_rows

from basketry.llm import quality as q

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in q.SYMBOLS), len(lines) - len(set(lines)), len(inside)


def run(docs):
    out = q.judge(docs, ["doc_id"])
    return out.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = run(docs).collect()
    assert sorted_rows((r[0], *r[1:6]) for r in got) == sorted_rows((r.doc_id, *brute(r.text)) for r in docs.collect())
    assert sorted_rows(got) == sorted_rows(oracle_rows(q.OP2_SQL, documents=docs.toPandas()))
    assert run(docs.limit(0)).collect() == []


def test_random_texts(spark, monkeypatch):
    rng = random.Random(11)
    rows = []
    for i in range(600):
        words = [rng.choice(["a", "bb", "ccc", "dd#", "|", "é"]) if i % 5 == 0 else "w%d" % rng.randrange(2000) for _ in range(rng.choice([0, 2, 3, 60, 90, 300]))]
        rows.append((i, "".join(w + rng.choice([" ", "\n", "\t ", "\x0b"]) for w in words), rng.choice(["en", "en", None, "de"]), rng.choice(["s1", "s2", None])))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = run(docs).collect()
    assert sorted_rows((r[0], *r[1:6]) for r in got) == sorted_rows((r[0], *brute(r[1])) for r in rows)
    frame = docs.toPandas().astype(object).where(lambda x: x.notna(), None)
    assert sorted_rows(got) == sorted_rows(oracle_rows(q.OP2_SQL, documents=frame))
    assert 0 < sum(r.kept for r in got) < len(got)


def test_hash_collisions_are_verified(spark):
    """With no hash bits left, windows are told apart by their words."""
    words = ["w%d" % i for i in range(40)] + ["w3", "w4", "w5"]
    frame = spark.createDataFrame([(words,)], "words array<string>")
    for name, step in q._repeat_positions("words"):
        frame = frame.withColumn(name, q.F.expr("transform(packed, x -> x & 63)") if name == "found" else step)
        if name == "found":
            frame = frame.withColumn("found", q.F.expr("transform(found, x -> cast(x as int))"))
    assert frame.first().repeats == [3, 40]


def test_sketches_merge(spark):
    """Sketches of parts add up to the sketch of all."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    counts = q.text_counts(docs, ["doc_id", "lang", "source"]).withColumn("base_failed", q.F.col("n_words") < 50)
    key = ["level", "lang", "source", "rate", "bucket"]
    parts = q.sketches(counts.where("doc_id % 2 = 0")).unionByName(q.sketches(counts.where("doc_id % 2 = 1")))
    merged = parts.groupBy(*key).agg(q.F.sum("n").alias("n"))
    assert sorted_rows(merged.collect()) == sorted_rows(q.sketches(counts).select(*key, "n").collect())


@pytest.mark.parametrize("value", [0, 1, 31, 32, 33, 63, 64, 1000, 10**6 + 7])
def test_bucket_error(spark, value):
    low = spark.range(1).select(q.bucket(q.F.lit(value).cast("long")).alias("b")).first().b
    assert low <= value <= low + low / q.SUB_BUCKETS


def test_query_plan_is_native(spark):
    plan = q.op2_quality(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian|NestedLoop", plan)


def prose(rng, n_words=200, lines=20, letters=(3, 8)):
    """Words that hardly repeat, on lines that don't."""
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(*letters))) for _ in range(n_words)]
    step = n_words // lines
    return [" ".join(words[i:i + step]) for i in range(0, n_words, step)]


def in_groups(spark, rng, extra):
    """300 documents of prose for each of two sources, and ``extra`` rows (text, source) with ids from 10,000.
    Texts of ``code`` have symbols, repeated lines and repeated windows; those of ``news`` one repeated line in 20 at most."""
    rows = []
    for i in range(300):
        rows.append((i, "\n".join(prose(rng) + (["a line again"] * 2 if i % 3 == 0 else [])), "en", "news"))
        code = prose(rng, letters=(2, 5))
        code += rng.sample(code, rng.randrange(1, 5)) + ["# " * rng.randrange(30)]
        rows.append((1000 + i, "\n".join(code), "en", "code"))
    rows += [(10_000 + i, text, "en", source) for i, (text, source) in enumerate(extra)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_limits_follow_each_group(spark):
    """Groups with other tails have other limits, for every rule; nothing of them is rejected."""
    docs = in_groups(spark, random.Random(5), [])
    counts = q.text_counts(docs, ["doc_id", "lang", "source"]).withColumn("base_failed", q.F.lit(False))
    got = {r.source: r.limits for r in q.group_limits(counts).collect()}
    for k in q.RATES:
        assert got["code"][f"{k}_high"] != got["news"][f"{k}_high"]
    assert got["code"].symbols_high > 20 * got["news"].symbols_high and got["code"].dup_lines_high > got["news"].dup_lines_high
    assert run(docs).where("not kept").count() == 0


def test_each_rule_fails_its_outlier(spark):
    rng = random.Random(6)
    again, new = prose(rng, 30, 30), prose(rng, 120, 120)
    run_on = ["pre", "post", "over"]
    planted = {
        "word_length": "\n".join(prose(rng, letters=(12, 16))),
        "symbols": "\n".join(prose(rng) + ["# " * 40]),
        "dup_lines": "\n".join(x for pair in zip(again * 4, new) for x in pair),
        "repeat_words": " ".join(" ".join(prose(rng, 6, 1) + run_on) for _ in range(30)),
    }
    docs = in_groups(spark, rng, [(t, "news") for t in planted.values()] + [("\n".join(f"{x} #" for x in prose(rng, letters=n)), s) for s, n in (("code", (2, 5)), ("news", (3, 8)))])
    failed = {r.row.doc_id: r for r in q.judge(docs, ["doc_id"]).where("row.doc_id >= 10000").collect()}
    for i, rule in enumerate(planted):
        assert rule in failed[10_000 + i].failed and not failed[10_000 + i].base_failed and not failed[10_000 + i].kept
    # what is usual in one source is an outlier in the other
    assert failed[10_004].kept and failed[10_005].failed == ["symbols"]
    frame = docs.toPandas()
    assert sorted_rows(run(docs).collect()) == sorted_rows(oracle_rows(q.OP2_SQL, documents=frame))


def test_limits_differ_at_scale(spark):
    """On the given table languages differ in each rate but symbols, of which ordinary texts have none."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    counts = q.stored(q.text_counts(docs, ["doc_id", "lang", "source"]).selectExpr("*", "n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed"))
    got = q.group_limits(counts).collect()
    for k in ("word_length", "repeat_words"):
        assert len({r.limits[f"{k}_high"] for r in got}) > 3
    assert len({r.limits.dup_lines_high for r in got}) > 1
