"""Line dedup against DuckDB and a brute-force comparison of all places."""

import random

import numpy as np
import pytest
from helpers_llm import odd_documents, oracle_rows, sorted_rows

from basketry.llm import linededup as ld


def brute(rows, min_words=ld.MIN_WORDS):
    """Deleted line numbers of each row: lines in a run of over ``min_words`` words that an earlier place has."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen = []
    for i in order:
        seen += [(i, j, tuple(x.split())) for j, x in enumerate((rows[i][1] or "").split("\n")) if x.split()]
    gone = [set() for _ in rows]
    for a in range(len(seen)):
        for b in range(a + 1, len(seen)):
            if seen[a][2] != seen[b][2] or (a and b and seen[a - 1][0] == seen[a][0] and seen[b - 1][0] == seen[b][0] and seen[a - 1][2] == seen[b - 1][2]):
                continue  # not where a run begins
            n = 0
            while b + n < len(seen) and seen[a + n][2] == seen[b + n][2] and seen[a + n][0] == seen[a][0] and seen[b + n][0] == seen[b][0]:
                n += 1
            if sum(len(seen[b + k][2]) for k in range(n)) > min_words:
                gone[seen[b][0]].update(seen[b + k][1] for k in range(n))
    return [sorted(g) for g in gone]


def run(spark, rows, **more):
    docs = spark.createDataFrame([(i, d, t, "x") for i, (d, t) in enumerate(rows)], "nr int, doc_id long, text string, lines string").coalesce(1)
    return {r.row.nr: r for r in ld.dedup_lines(docs, **more).collect()}


def words(rng, n, kinds=5000):
    return " ".join(f"w{rng.randrange(kinds)}" for _ in range(n))


def test_passages(spark):
    rng = random.Random(1)
    p, q = words(rng, 51), words(rng, 50)
    three = [words(rng, 20) for _ in range(3)]
    own = lambda: words(rng, 10)
    rows = [
        (5, f"{own()}\n{p}\n{own()}"), (3, f"{p}"), (7, q), (8, q), (9, "\n".join([own(), *three, own()])), (10, "\n".join([*three[:1], "", " ", *three[1:], own()])),
        (11, "\n".join(three[:2])), (None, f"{p}\n{own()}"), (12, f"  {p.replace(' ', '  ')}\t"), (13, None), (14, ""), (15, "\n\n"), (16, f"{p}\n{own()}\n{p}"), (3, p),
    ]
    got = run(spark, rows)
    assert [got[i].deleted for i in range(len(rows))] == brute(rows)
    assert got[0].text == rows[0][1].replace(p + "\n", "") and got[1].text == p
    assert got[2].text == got[3].text == q  # 50 words aren't over 50
    assert got[5].text.strip() == rows[5][1].split("\n")[-1] and got[8].text == "" and got[13].text == ""
    assert got[9].text is None and got[9].n_lines == 0 and got[10].text == "" and got[11].text == "\n\n"
    assert all(got[i].row.lines == "x" for i in got)


@pytest.mark.parametrize("seed", range(6))
def test_random_runs(spark, seed):
    rng = random.Random(seed)
    pool = [words(rng, rng.choice([1, 2, 3, 8, 20]), 50) for _ in range(25)]
    rows = []
    for i in range(40):
        lines = [rng.choice(pool + [""]) if rng.random() < 0.5 else words(rng, 3, 9000) for _ in range(rng.randrange(25))]
        if rows and rng.random() < 0.6:
            other = rng.choice(rows)[1].split("\n")
            k = rng.randrange(len(other))
            lines[2:2] = other[k:k + rng.randrange(12)]
        rows.append((rng.choice([None, *range(30)]), "\n".join(lines)))
    got = run(spark, rows, min_words=12)
    assert [got[i].deleted for i in range(len(rows))] == brute(rows, 12)


def test_periodic_text(spark):
    rows = [(1, "\n".join(["a b c d e f"] * 3000)), (2, "\n".join(["a b c d e f"] * 20))]
    got = run(spark, rows)
    assert len(got[1].deleted) == 20 and got[1].text == ""
    # what stays is shorter than a run and its first copy
    assert 0 < 3000 - len(got[0].deleted) <= 9


def test_windows_cover_every_run():
    rng = np.random.default_rng(3)
    for _ in range(200):
        n = rng.integers(1, 9, rng.integers(1, 30))
        h = rng.integers(-2**62, 2**62, len(n))
        found = ld.windows(h, n, 15)
        for _, first, size, anchor in found:
            inner = n[first:first + size]
            assert inner.sum() > 15 and min(inner[1:].sum(), inner[:-1].sum()) <= 15 and first <= anchor < first + size
        a, b = sorted(rng.integers(0, len(n) + 1, 2))
        if n[a:b].sum() > 15:
            covered = {i for _, f, s, _ in found if a <= f and f + s <= b for i in range(f, f + s)}
            assert covered == set(range(a, b))


def test_common_run():
    a, b = np.array([1, 2, 3, 4, 5, 6, 7] * 20), np.array([9, 2, 3, 4, 5, 6, 7] + [1, 2, 3, 4, 5, 6, 7] * 19)
    assert ld.common_run(a, b, 3, 3) == (1, 140) and ld.common_run(a, b, 0, 0) == (0, 0)


def test_odd_rows_against_sql(spark):
    docs = odd_documents(spark).coalesce(1)
    out = ld.dedup_lines(docs, keep=["doc_id"]).collect()
    got = [(r.row.doc_id, r.text, r.n_lines, len(r.deleted)) for r in out]
    frame = docs.toPandas().astype(object).where(lambda x: x.notna(), None)
    assert sorted_rows(got) == sorted_rows(oracle_rows(ld.OP4_SQL, documents=frame))
    assert ld.dedup_lines(docs.limit(0)).collect() == []


def test_query(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf}/documents.parquet'")
    rows = ld.op4_line_dedup(spark, sf).collect()
    assert sorted_rows(rows) == sorted_rows(con.sql(ld.OP4_SQL).fetchall()) and any(r.n_deleted for r in rows)
