"""The pipeline against the brute-force versions of its stages."""

import hashlib

import corpus_pipeline as pipeline
import pytest
import test_decontamination
import test_jaccardjoin
import test_linededup
from helpers_llm import odd_documents

from basketry.llm import bpe, langid

SF = "/root/testdata/sf0.001"


def test_whole_run(spark):
    tokenizers = pytest.importorskip("tokenizers")
    docs = langid.documents(spark, SF)
    model = langid.fit(docs)
    rows = sorted((r.asDict() for r in docs.collect()), key=lambda r: r["doc_id"])
    _, _, rejected = langid.predict(model, [r["text"] or "" for r in rows])
    rows = [r for r, no in zip(rows, rejected) if not no]
    after = []
    for r, gone in zip(rows, test_linededup.brute([(r["doc_id"], r["text"]) for r in rows])):
        if gone:
            text = "\n".join(x for i, x in enumerate(r["text"].split("\n")) if i not in gone)
            r = {**r, "text": text, "n_chars": len(text)}
        if not gone or r["text"].strip():
            after.append(r)
    groups = test_jaccardjoin.brute([(r["doc_id"], r["text"]) for r in after])
    after = [r for r, (n, c) in zip(after, groups) if not n or c == r["doc_id"]]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {d for d, *_, no in test_decontamination.brute([(r["doc_id"], r["text"]) for r in after], items) if no}
    after = [r for r in after if r["doc_id"] not in bad]
    library = tokenizers.Tokenizer.from_file(bpe.default_model_path())
    want = {}
    for r in after:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        want[r["doc_id"]] = {**r, "ids": ids, "n_tokens": len(ids), "decoded_sha256": hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()}
    got = {r.doc_id: r.asDict() for r in pipeline.run(spark, SF).collect()}
    assert got == want and bad and len(want) < len(rows)


def test_stages_keep_columns_and_take_odd_rows(spark):
    docs = odd_documents(spark).withColumnsRenamed({"n_words": "a.b"}).selectExpr("*", "lang as row", "doc_id as number", "'i' as IDS")
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, SF)
        rows = out.collect()
        assert stage(spark, docs.limit(0), SF).collect() == []
        if name == "bpe":
            assert out.columns == [c for c in docs.columns if c != "IDS"] + ["ids", "n_tokens", "decoded_sha256"] and len(rows) == docs.count()
        else:
            assert out.schema == docs.schema or out.columns == docs.columns
    kept = {r.doc_id for r in pipeline.language_id(spark, docs, SF).collect()}
    assert not kept & {2, 3, 4}


def test_decisions(spark):
    p = " ".join(f"p{i}" for i in range(60))
    rows = [(1, f"{p}\nown words here", "en", "s", 1), (2, f"other words\n{p}", "en", "s", 1), (3, p, "en", "s", 1), (4, "other words", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    lines = {r.doc_id: (r.text, r.n_chars) for r in pipeline.line_dedup(spark, docs, SF).collect()}
    assert lines == {1: (rows[0][1], 1), 2: ("other words", 11), 4: ("other words", 1)}
    assert {r.doc_id for r in pipeline.jaccard_join(spark, docs, SF).collect()} == {1, 4}


def test_registered():
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is pipeline.run and "pipeline" not in entry.oracle_sql()
    assert {f"op{n}" for n in range(1, 11)} <= {k.split("_")[0] for k in entry.queries()}
