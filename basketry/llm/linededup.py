"""Line dedup by hashes of windows of lines.

A line is known by the hash of its words; lines without words are looked through
and never deleted. From every line a window runs down to where it first holds more
than MIN_WORDS words, and another runs up likewise. The line of least hash in a
window is its anchor, a name for its place; the hash of the whole window is the
fingerprint. All windows are taken, none is selected by its minimum: the earliest
occurrence of a minimum alone may share that line and not the run around it. Any
run of lines of over MIN_WORDS words contains a whole window for each of its
lines, so two texts that share such a run share fingerprints that cover it.

Fingerprints are joined by position: each one with its earliest occurrence, by
document id, then row, then line. From the anchors the match is extended up and
down while the lines agree, and the lines of the later run are deleted. The
earliest occurrence of a run has nothing before it to match, so one copy of
everything stays. Later runs may be in other documents or in the same one. The
lines deleted are just those in runs of over MIN_WORDS words that an earlier place
has.

Nothing is made for pairs of occurrences: a window that a million documents share
gives a million rows, each matched with one other. Hot windows spread by row:
the join has nothing above it that would need a window's rows together.

The texts are stored once with row numbers, because rows need names that don't
change between reads.

Defined cases: null texts stay null, empty texts stay empty; a text whose lines
with words all repeat becomes empty; texts (and repeated rows) of at most MIN_WORDS
words are left alone; of repeated rows one, of equal ids the row read first,
counts as the earlier one; null ids count as last; lines are equal if their words
are. An empty table gives an empty one. All columns are carried in ``row``,
whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import SPACES, documents, numbered, stored, text_slices

#: A run is repeated if it has more words than this.
MIN_WORDS = 50

LINES = "number long, id string, id_order double, lines array<long>, places array<int>, windows array<struct<hash: long, first: int, size: int, anchor: int>>"


def line_hashes(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each line with words: hash, number of words, and place among all lines."""
    split = [x.split() for x in text.encode("utf-8", "surrogatepass").split(b"\n")]
    place = np.array([i for i, x in enumerate(split) if x], np.int64)
    return (
        np.array([xxhash.xxh3_64_intdigest(b" ".join(x)) for x in split if x], np.uint64).view(np.int64),
        np.array([len(x) for x in split if x], np.int64), place,
    )


def windows(hashes: np.ndarray, words: np.ndarray, min_words: int = MIN_WORDS) -> list[tuple[int, int, int, int]]:
    """(hash, first line, lines, anchor line) of the windows."""
    upto = np.r_[0, np.cumsum(words)]
    n = len(words)
    ends = np.searchsorted(upto, upto[:-1] + min_words, side="right")  # first end with more words
    firsts = np.searchsorted(upto, upto[1:] - min_words, side="left") - 1  # last beginning with more words
    spans = {(a, e) for a, e in enumerate(ends.tolist()) if e <= n} | {(a, e + 1) for e, a in enumerate(firsts.tolist()) if a >= 0}
    out = []
    for first, end in sorted(spans):
        inside = hashes[first:end]
        out.append((xxhash.xxh3_64_intdigest(inside.tobytes()) - 2**63, first, end - first, first + int(inside.argmin())))
    return out


def common_run(later: np.ndarray, earlier: np.ndarray, at: int, other: int) -> tuple[int, int]:
    """Lines [first, end) of ``later`` around ``at`` that equal those of ``earlier`` around ``other``."""
    def same(x: np.ndarray, y: np.ndarray) -> int:
        n, step, done = min(len(x), len(y)), 16, 0
        while done < n:
            unlike = np.flatnonzero(x[done:done + step] != y[done:done + step][:len(x[done:done + step])]) if done + step <= n else np.flatnonzero(x[done:n] != y[done:n])
            if len(unlike):
                return done + int(unlike[0])
            done, step = min(n, done + step), step * 2
        return n

    down = same(later[at:], earlier[other:])
    up = same(later[:at][::-1], earlier[:other][::-1])
    return at - up, at + down


def repeated_lines(later: np.ndarray, earlier: np.ndarray, matches: list[tuple[int, int, int]]) -> np.ndarray:
    """Numbers of the lines of ``later`` in runs found from ``matches``: (line, line of ``earlier``, lines of the window)."""
    gone = np.zeros(len(later) + 1, np.int64)
    runs: list[tuple[int, int]] = []
    for at, other, size in sorted(matches):
        if runs and runs[-1][0] <= at and at + size <= runs[-1][1]:
            continue  # inside the run before
        if not np.array_equal(later[at:at + size], earlier[other:other + size]):
            continue  # the hashes of different windows agree
        runs.append(common_run(later, earlier, at, other))
    for first, end in runs:
        gone[first] += 1
        gone[end] -= 1
    return np.flatnonzero(np.cumsum(gone)[:-1] > 0)


def dedup_lines(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_words: int = MIN_WORDS, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) in a struct ``row``; n_lines; deleted
    (array<int>, sorted line numbers from 0); and ``text`` without those lines."""
    kind = docs.schema[id_col].dataType.typeName()
    number = F.col(id_col).cast("double") if kind in ("byte", "short", "integer", "long", "float", "double", "decimal") else F.lit(0.0)
    base = numbered(docs, keep, text_col, F.col(id_col).cast("string").alias("id"), F.coalesce(number, F.lit(float("inf"))).alias("id_order"))

    def cut(batches):
        for batch, texts in text_slices(batches, "text"):
            hashes, places, found = [], [], []
            for t in texts:
                h, n, at = line_hashes(t)
                hashes.append(h)
                places.append(at)
                found.append([{"hash": w[0], "first": w[1], "size": w[2], "anchor": w[3]} for w in windows(h, n, min_words)])
            own = [batch.column(batch.schema.get_field_index(c)) for c in ("number", "id", "id_order")]
            window = pa.struct([("hash", pa.int64()), ("first", pa.int32()), ("size", pa.int32()), ("anchor", pa.int32())])
            yield pa.RecordBatch.from_arrays([*own, pa.array(hashes, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32())), pa.array(found, pa.list_(window))], names=["number", "id", "id_order", "lines", "places", "windows"])

    lines = stored(base.select("number", "id", "id_order", "text").mapInArrow(cut, LINES))
    prints = lines.select("number", "id", "id_order", F.explode("windows").alias("w"))
    # doubles order integers up to 2^53 exactly; beyond, and for other types, the text decides
    place = F.struct("id_order", F.col("id").isNull().alias("last"), "id", "number", F.col("w.anchor").alias("anchor"))
    earliest = prints.groupBy(F.col("w.hash").alias("hash")).agg(F.min(place).alias("place"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    matched = (
        prints.withColumn("hash", F.col("w.hash")).join(earliest.select("hash", F.col("place").alias("early")), "hash")
        .where(place != F.col("early"))
        .select(
            "number", F.col("early.number").alias("other"),
            F.struct(F.col("w.first").alias("at"), (F.col("early.anchor") - F.col("w.anchor") + F.col("w.first")).alias("other"), F.col("w.size").alias("size")).alias("match"),
        )
    )
    pairs = matched.groupBy("number", "other").agg(F.collect_list("match").alias("matches"))
    earlier = lines.select(F.col("number").alias("other"), F.col("lines").alias("earlier"))
    pairs = pairs.join(earlier, "other").join(lines.select("number", "lines", "places"), "number")

    def extend(batches):
        for batch in batches:
            x = batch.to_pydict()
            gone = [
                np.array(at, np.int64)[repeated_lines(np.array(a, np.int64), np.array(b, np.int64), [(m["at"], m["other"], m["size"]) for m in ms])]
                for a, b, at, ms in zip(x["lines"], x["earlier"], x["places"], x["matches"])
            ]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("number")), pa.array(gone, pa.list_(pa.int32()))], names=["number", "gone"])

    gone = (
        pairs.select("number", "lines", "places", "earlier", "matches").mapInArrow(extend, "number long, gone array<int>")
        .groupBy("number").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"))
    )
    out = base.select("number", "row", "text").join(gone, "number", "left").select("row", "text", F.split("text", "\n").alias("lines"), "gone")
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "gone"), lambda i: F.get("lines", i))
    blank = F.forall("left", lambda x: F.btrim(x, F.lit(SPACES)) == "")
    text = F.when(F.col("left").isNull(), F.col("text")).when(blank, F.lit("")).otherwise(F.array_join("left", "\n"))
    return out.select("*", F.when(F.col("gone").isNotNull(), left).alias("left")).select(
        "row", F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).alias("n_lines"),
        F.coalesce("gone", F.array().cast("array<int>")).alias("deleted"), text.alias("text"),
    )


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    """All documents without the runs of lines that an earlier document, or an earlier place, has."""
    out = dedup_lines(documents(spark, sf_dir), keep=["doc_id"])
    return out.select("row.doc_id", "text", F.col("n_lines").cast("long").alias("n_lines"), F.size("deleted").cast("long").alias("n_deleted"))


OP4_SQL = rf"""
with d as (select row_number() over () r, doc_id, text from documents),
a as (select r, doc_id, unnest(string_split(text, chr(10))) line, generate_subscripts(string_split(text, chr(10)), 1) place from d),
k as (select *, list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') w from a),
l as (select r, doc_id, place, array_to_string(w, ' ') k, len(w) n, row_number() over (partition by r order by place) i from k where len(w) > 0),
c as (select *, sum(n) over (partition by r order by i) upto from l),
p as (select a.r, a.i first, min(b.i) last from c a join c b on a.r = b.r and b.i >= a.i and b.upto - a.upto + a.n > {MIN_WORDS} group by 1, 2
      union select b.r, max(a.i), b.i from c a join c b on a.r = b.r and b.i >= a.i and b.upto - a.upto + a.n > {MIN_WORDS} group by b.r, b.i),
w as (select p.r, first, last, any_value(doc_id) doc_id, md5(string_agg(k, chr(10) order by i)) h from p join c on p.r = c.r and c.i between first and last group by all),
o as (select *, row_number() over (partition by h order by doc_id nulls last, r, first) copy from w),
g as (select distinct c.r, c.place from o join c on o.copy > 1 and o.r = c.r and c.i between first and last),
t as (select a.r, count(*) n_lines, count(g.r) n_deleted, string_agg(line, chr(10) order by a.place) filter (g.r is null) text,
      count(*) filter (g.r is null and regexp_matches(line, '[^\x20\x09-\x0D]')) worded from a left join g on a.r = g.r and a.place = g.place group by a.r)
select d.doc_id, case when n_deleted > 0 and worded = 0 then '' else coalesce(t.text, d.text) end as text,
       coalesce(n_lines, 0)::bigint n_lines, coalesce(n_deleted, 0)::bigint n_deleted from d left join t on d.r = t.r
"""
