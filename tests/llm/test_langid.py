"""Language ID: Kneser-Ney against dictionaries, held-out accuracy, rejection."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers_llm import odd_documents

from basketry.llm import langid

N = langid.ORDER


def plain(text):
    return [c for c in re.sub(r"[\W\d_]+", " ", text.lower())]


def sequence(text):
    x = plain(text)
    if x and x[-1] != " ":
        x.append(" ")
    return [" "] * (N - 1) + (x[1:] if x and x[0] == " " else x) if x else []


class Brute:
    """Interpolated Kneser-Ney with dictionaries."""

    def __init__(self, texts):
        self.count = [Counter() for _ in range(N + 1)]
        raw = Counter()
        grams = [set() for _ in range(N + 1)]
        for t in texts:
            s = sequence(t) or [" "] * N
            for i in range(N - 1, len(s)):
                raw[tuple(s[i - N + 1:i + 1])] += 1
                for n in range(1, N + 1):
                    grams[n].add(tuple(s[i - n + 1:i + 1]))
        self.count[N] = raw
        for n in range(1, N):
            for g in grams[n + 1]:
                self.count[n][g[1:]] += 1
        self.total, self.kinds, self.discount = [], [], []
        for n in range(N + 1):
            total, kinds = defaultdict(int), defaultdict(int)
            for g, c in self.count[n].items():
                total[g[:-1]] += c
                kinds[g[:-1]] += 1
            n1, n2 = sum(c == 1 for c in self.count[n].values()), sum(c == 2 for c in self.count[n].values())
            self.total.append(total)
            self.kinds.append(kinds)
            self.discount.append(n1 / (n1 + 2 * n2) if n1 and n2 else 0.5)

    def p(self, gram):
        if not gram:
            return 1 / langid.ALPHABET
        n, ctx = len(gram), gram[:-1]
        if not self.total[n][ctx]:
            return self.p(gram[1:])
        d = self.discount[n]
        own = max(self.count[n][gram] - d, 0) if gram in self.count[n] else 0
        return (own + d * self.kinds[n][ctx] * self.p(gram[1:])) / self.total[n][ctx]

    def entropy(self, text):
        s = sequence(text)
        if not s:
            return None
        return -sum(math.log(self.p(tuple(s[i - N + 1:i + 1]))) for i in range(N - 1, len(s))) / (len(s) - N + 1)


def sample(rng, syllables, n):
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(n)).capitalize() + "."


EN, DE = ["the", "in", "er", "an", "th", "re"], ["ein", "sch", "er", "ü", "ß", "ung"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    return {"de": [sample(rng, DE, 30) for _ in range(20)], "en": [sample(rng, EN, 30) for _ in range(20)]}


@pytest.fixture(scope="module")
def table():
    return langid.letter_table()


def test_equals_dictionaries(texts, table, monkeypatch):
    model = langid.train(texts, table)
    brutes = [Brute(texts[k]) for k in model["langs"]]
    rng = random.Random(2)
    probes = [sample(rng, EN + DE + ["xyz", "é", "1", "-"], rng.randrange(1, 40)) for _ in range(30)] + ["a", "  the", "... ", "", "ЖЖЖ the", "ING 12"]
    for piece in (langid.PIECE, 37):
        monkeypatch.setattr(langid, "PIECE", piece)
        counts, got = langid.cross_entropies(model, probes, table)
        for text, n, row in zip(probes, counts, got):
            if n:
                assert np.allclose(row, [b.entropy(text) for b in brutes], rtol=1e-4)
            else:
                assert not re.search(r"[^\W\d_]", text)


def test_probabilities_sum_to_one(texts):
    b = Brute(texts["en"])
    known = sorted({g[-1] for g in b.count[1]})
    for ctx in [("t", "h", "e"), (" ", " ", " "), ("q", "q", "q")]:
        total = sum(b.p((*ctx, c)) for c in known) + (langid.ALPHABET - len(known)) * b.p((*ctx, "\U0001F600"))
        assert abs(total - 1) < 1e-9


def test_fit_and_identify(spark, texts):
    rows = [(i, t, lang, "x") for i, (lang, t) in enumerate([(k, t) for k, v in texts.items() for t in v])] + [(900, None, "fr", "x"), (901, "the the", None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    model = langid.fit(docs)
    assert model["langs"] == ["de", "en"]
    rng = random.Random(7)
    probe = [(1, sample(rng, DE, 20), "de"), (2, sample(rng, EN, 20), "en"), (3, "", "und"), (4, None, "und"), (5, "123 ...", "und"), (None, sample(rng, EN, 3000), "en"), (6, "ЖЩЪЫ ЯЮЭЖ " * 30, None)]
    out = langid.identify(spark.createDataFrame(probe, "id long, text string, score string"), model).collect()
    assert [r.lang_pred for r in out][:6] == [p[2] for p in probe][:6]
    assert [r.rejected for r in out] == [False, False, True, True, True, False, True]
    assert all(0 <= r.score <= 1 for r in out) and out[2].score == 0
    assert [r.row.score for r in out] == [p[2] for p in probe]


def test_sample_is_bounded(spark, texts, monkeypatch):
    rows = [(i, t, k) for k, v in texts.items() for i, t in enumerate(v)] + [(50, "the " * 5000, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 5)
    monkeypatch.setattr(langid, "SAMPLE_CHARS", 600)
    seen = {}
    monkeypatch.setattr(langid, "train", lambda texts, table, f=langid.train: seen.update(texts) or f(texts, table))
    langid.fit(docs)
    assert seen and all(len(v) <= 5 and sum(map(len, v)) <= 600 for v in seen.values())


def test_odd_and_empty(spark):
    docs = odd_documents(spark)
    model = langid.fit(docs)
    assert langid.identify(docs, model).count() == docs.count()
    assert langid.identify(docs.limit(0), model).collect() == []
    none = langid.fit(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(docs, none).collect()} == {"und"}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in langid.documents(spark, sf).select("doc_id", "lang").collect()}
    rows = langid.op9_language_id(spark, sf).collect()
    assert len(rows) == len(lang)
    held = [r for r in rows if r.held_out]
    assert len(held) > 200 and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.99 * len(held)


def learned(spark, monkeypatch, rows):
    """What each language learns from, of rows (doc_id, text, lang)."""
    seen = {}
    monkeypatch.setattr(langid, "train", lambda texts, table, f=langid.train: seen.update(texts) or f(texts, table))
    langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    return seen


def test_long_texts_take_no_room(spark, texts, monkeypatch):
    """Wherever they stand in the order, longer texts leave the others in the sample."""
    monkeypatch.setattr(langid, "SAMPLE_CHARS", 20_000)
    rows = [(i, t, k) for k, v in texts.items() for i, t in enumerate(v)]
    huge = [(100 + i, "the " * 6000, k) for k in texts for i in range(60)]
    alone, beside = learned(spark, monkeypatch, rows), learned(spark, monkeypatch, rows + huge)
    assert {k: sorted(v) for k, v in beside.items()} == {k: sorted(v) for k, v in alone.items()} and set(alone) == {"de", "en"}
    only = learned(spark, monkeypatch, rows + [(900, "le " * 9000, "fr")])
    assert only["fr"] == [("le " * 9000)[:20_000]]


def test_text_that_does_not_fit_is_passed_over(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_CHARS", 1000)
    rows = [(i, "the " * 200, "en") for i in range(6)] + [(i, "in " * 10, "en") for i in range(10, 14)]
    chars = [len(t) for v in learned(spark, monkeypatch, rows).values() for t in v]
    assert sorted(chars) == [30] * 4 + [800]


def test_equal_ids_and_copies(spark, texts, monkeypatch):
    """Equal ids don't bring rows in together, copies count once, and no language is only for calibration."""
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 10)
    rows = [(None, t, k) for k, v in texts.items() for t in v]
    seen = learned(spark, monkeypatch, rows + rows[:1] * 200)
    assert set(seen) == {"de", "en"} and all(7 < len(v) <= 10 and len(set(v)) == len(v) for v in seen.values())
    seen = learned(spark, monkeypatch, [(1, f"the text {i}", f"l{i:02}") for i in range(20)])
    assert len(seen) == 20
