import pyarrow.parquet as pq
from collections import Counter

from basketry.operators.text import word_count
from conftest import SF_SMALL

DELIMS = " \t\n\r\f"


def string_tokenizer(text):
    """Brute-force StringTokenizer with the default delimiters."""
    out, cur = [], []
    for ch in text:
        if ch in DELIMS:
            if cur:
                out.append("".join(cur))
                cur = []
        else:
            cur.append(ch)
    if cur:
        out.append("".join(cur))
    return out


def test_edge_cases(spark):
    lines = ["", "   ", "\tA a\ta", "b\fb\r\nB", "x  y", None, "\u00a0z"]
    df = spark.createDataFrame([(s,) for s in lines], "value string")
    got = {r.word: r.n for r in word_count(df).collect()}
    want = Counter(w for s in lines if s for w in string_tokenizer(s))
    assert got == dict(want)
    # case and punctuation are kept; the no-break space is not a delimiter
    assert got["A"] == 1 and got["a"] == 2 and got["\u00a0z"] == 1


def test_whole_documents_match_brute_force(spark):
    texts = pq.read_table(f"{SF_SMALL}/documents.parquet", columns=["text"]).column(0).to_pylist()
    want = Counter(w for t in texts if t for w in string_tokenizer(t))
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = {r.word: r.n for r in word_count(df, "text").collect()}
    assert got == dict(want)
