"""Personal data: base spans against Python's re, checksums, and context."""

import hashlib
import random
import re

from helpers_llm import odd_documents, oracle_rows, sorted_rows

from basketry.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def holds(kind, value):
    number = re.sub("[^0-9]", "", value)
    return {
        "email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in value.split(".")),
        "card": lambda: 16 <= len(number) <= 19 and luhn(number), "phone": lambda: 8 <= len(number) <= 15,
    }[kind]()


def brute(text):
    return [(i, m.start(), k, m.end()) for i, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if holds(k, m[0])]


TEXTS = [
    "", None, "a@b.c%d@e.f", "a@b", "x.y+z@mail-1.example.com.", "ñ🙂 1.2.3.4.5.6.7.8 9.9.9.9", "256.1.1.1 0255.000.01.1 99999999999999999999.1.1.1",
    "4111 1111 1111 1111", "4111-1111-1111-1111 5", "41111111111111111111", "+1 (968) 555-9369, +49 30 1234567.", "+1 2", "++1 5555555555", "+12345678901234567890",
    "1" * 20_000, "1 " * 20_000, "a." * 20_000 + "@", "a@" * 5_000, "1." * 20_000, "+1" + "(" * 20_000, "d@d.dd " * 2_000, "1٣.1.1.1 ١.٢.٣.٤",
]


def query(docs):
    out = pii.find_pii(docs, ["doc_id"])
    count = lambda k: pii.F.size(pii.F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return out.select("row.doc_id", *map(count, pii.BASE), pii.F.sha2(pii.spelled(pii.F.col("base")), 256), pii.spelled(pii.F.col("spans")))


def got(rows, column):
    return {r.row.doc_id: [(s.kind_order, s.start, s.kind, s.stop) for s in r[column]] for r in rows}


def test_base_spans(spark):
    rng = random.Random(4)
    parts = ["1", "22", "255", ".", "-", " ", "@", "a", "mail", "+", "(", ")", "4111111111111111", "%", "é", "300"]
    texts = TEXTS + ["".join(rng.choice(parts) for _ in range(rng.randrange(50))) for _ in range(500)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id int, text string, email string")
    short = docs.where("length(text) < 5000")
    assert sorted_rows(query(short).collect()) == sorted_rows(oracle_rows(pii.OP3_SQL, documents=short.toPandas()))
    assert got(pii.find_pii(docs, ["doc_id"]).collect(), "base") == {i: brute(t) for i, t in enumerate(texts)}


def test_odd_rows(spark):
    docs = odd_documents(spark)
    frame = docs.toPandas().astype(object).where(lambda x: x.notna(), None)
    assert sorted_rows(query(docs).collect()) == sorted_rows(oracle_rows(pii.OP3_SQL, documents=frame))
    assert pii.find_pii(docs, ["doc_id"]).count() == docs.count()
    assert pii.find_pii(docs.limit(0), ["doc_id"]).collect() == []


def test_added_kinds(spark):
    texts = {
        1: ("pay to DE89 3704 0044 0532 0130 00 now", ["iban"]), 2: ("pay to DE88 3704 0044 0532 0130 00 now", []),
        3: ("GB82WEST12345698765432", ["iban"]), 4: ("amex card 378282246310005 ok", ["short_card"]), 5: ("nothing 378282246310005 near", []),
        6: ("amex card 378282246310006 ok", []), 7: ("my ssn is 078-05-1120", ["ssn"]), 8: ("item 078-05-1120", []),
        12: ("xDE89370400440532013000 bank", []), 13: ("bank DE89370400440532013000x", []), 14: ("my ssn is 1078-05-1120 or 078-05-1120-3", []),
        15: ("social: 078-05-1120.", ["ssn"]), 16: ("tel +0301234567", ["phone"]), 9: ("call 030/12345678 today", ["local_phone"]), 10: ("order no 030/12345678 by phone", []), 11: ("tel a@b.cd 0301234567", ["email", "local_phone"]),
    }
    docs = spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "doc_id int, text string")
    assert sorted_rows(query(docs).collect()) == sorted_rows(oracle_rows(pii.OP3_SQL, documents=docs.toPandas()))
    rows = pii.find_pii(docs, ["doc_id"]).collect()
    assert {r.row.doc_id: [s.kind for s in r.spans] for r in rows} == {i: k for i, (_, k) in texts.items()}


def test_context_changes_the_score(spark):
    docs = spark.createDataFrame([(1, "server ip 10.0.0.1"), (2, "version 10.0.0.1"), (3, "10.0.0.1")], "doc_id int, text string")
    score = {r.row.doc_id: r.base[0].score for r in pii.find_pii(docs, ["doc_id"]).collect()}
    assert score[2] < score[3] < score[1]


def test_checksums(spark):
    rng = random.Random(8)
    numbers = ["".join(rng.choice("0123456789") for _ in range(rng.randrange(12, 20))) for _ in range(300)]
    frame = spark.createDataFrame([(n,) for n in numbers], "n string")
    assert [r.ok for r in frame.select(pii.luhn(pii.F.col("n")).alias("ok")).collect()] == [luhn(n) for n in numbers]
    ibans = ["".join(rng.choice("ABCXYZ") for _ in range(2)) + "".join(rng.choice("0123456789AZ") for _ in range(20)) for _ in range(500)]
    want = [int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1 for x in ibans]
    frame = spark.createDataFrame([(n,) for n in ibans], "n string")
    assert [r.ok for r in frame.select(pii.mod97(pii.F.col("n")).alias("ok")).collect()] == want


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = pii.op3_pii(spark, sf)
    assert not re.search("Python|Arrow|Pandas|Exchange", out._jdf.queryExecution().toString())
    rows = out.collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{b}" for _, a, k, b in want).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(w[2] == k for w in want) for k in PATTERNS)
