"""BPE against the tokenizers library, as brute force."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import bpe

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(bpe.default_model_path())


@pytest.fixture(scope="module")
def model():
    return bpe.load_model(bpe.default_model_path())


def check(model, library, texts):
    ids, counts, decoded = bpe.Encoder(model).encode(texts)
    at = 0
    for text, n, back in zip(texts, counts, decoded):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids[at:at + n].tolist() == want
        assert back == library.decode(want, skip_special_tokens=False)
        at += n
    assert at == len(ids)


ODD = [
    "", "   ", "\n\t", "aaaa aaaaa aaaaaa", "ΑΣ ΣΑΣ. ὈΔΥΣΣΕΎΣ", "İstanbul ß ﬁ Å", "a\u0085b c​d\x1cz \x00 q",
    "<|endoftext|> hi <|startoftext|><|endoftext|>x", "<|endof", "日本語テキスト 🙂🙂", "'s't're I'LL we'Ve", "éå",
    "x" * 1000, "٣٤٥ ²³ ½ Ⅷ", "__a_b--c!!??", "1234 5", "ACHT—UND",
]


def test_odd_texts(model, library):
    rng = random.Random(3)
    check(model, library, [*ODD, "".join(rng.choice("abcdefgh") for _ in range(5000))])


def test_heap_equals_rounds(model):
    rng = random.Random(5)
    e = bpe.Encoder(model)
    for _ in range(50):
        raw = np.array([rng.choice(b"abcent") for _ in range(rng.randrange(2, 60))])
        symbols = model["inner"][raw]
        rounds, n = e.by_rounds(symbols, np.zeros(len(symbols), np.int64), 1)
        assert rounds.tolist() == e.by_heap(symbols).tolist() and n.tolist() == [len(rounds)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.characters(max_codepoint=0x24F, exclude_categories=["Cs"])), max_size=6))
def test_any_latin_text(model, library, texts):
    check(model, library, texts)


def test_small_cache_starts_anew(model, library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    e = bpe.Encoder(model)
    for text in ("one two three four five six", "seven one <|endoftext|> two", "one"):
        ids, _, _ = e.encode([text])
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_frame(spark, library):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (2, "Hello hello", None), (None, "Hello hello", "z")], "doc_id long, text string, n_tokens string")
    rows = bpe.bpe_round_trip(docs, bpe.default_model_path()).collect()
    assert [r.n_tokens for r in rows] == ["x", "y", None, "z"]
    assert [len(r.ids) for r in rows][:2] == [0, 0] and rows[0].decoded == ""
    assert rows[2].ids == rows[3].ids == library.encode("Hello hello", add_special_tokens=False).ids
    back = bpe.bpe_decode(spark.createDataFrame(rows).drop("decoded"), bpe.default_model_path()).collect()
    assert [r.decoded for r in back] == [r.decoded for r in rows]
    assert bpe.bpe_round_trip(docs.limit(0), bpe.default_model_path()).collect() == []
    clash = bpe.bpe_round_trip(docs.withColumnsRenamed({"n_tokens": "IDS", "doc_id": "a.b"}), bpe.default_model_path())
    assert clash.columns == ["a.b", "text", "ids", "decoded"] and [len(r.ids) for r in clash.collect()] == [len(r.ids) for r in rows]


def test_query(spark, library):
    import hashlib

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = bpe.op6_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_every_code_point(model, library):
    """Between letters, after a digit, before a combining mark, and behind one."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f" a{c}B 1{c} e̖{c}́ ́{c}̖" for c in points[i:i + 64]) for i in range(0, len(points), 64)]
    check(model, library, texts)


def test_code_points_that_tables_differ_on(model, library):
    rng = random.Random(8)
    ranges = [r[:2] for r in bpe.NO_LETTERS + bpe.NO_NUMBERS + bpe.NO_MARKS + bpe.LOWER]
    odd = [chr(rng.randint(a, b)) for a, b in ranges] + list("ab1 ̖́̈́Σ") + ["\U00011935", "\U00011938"]
    check(model, library, ["".join(rng.choice(odd) for _ in range(12)) for _ in range(4000)])
