"""Benchmark decontamination by one Aho-Corasick automaton.

Texts of benchmark items are normalised to lists of words (ASCII letters in
lower case; everything else in ASCII but digits separates words; all other
characters belong to words). Every run of ``window`` words of an item, or the
whole item if it is shorter, is a pattern. The patterns of all items form one
automaton over words joined and framed by single spaces, so that a match is
always of whole words. A document is normalised the same way and scanned once;
matches are mapped back to word numbers and, for the spans, to code points of
the original text.

The items are read onto the driver in blocks of bounded size (hash blocks of
about MAX_BLOCK_CHARS characters). A benchmark of one block, the usual case,
takes one scan. A larger one takes a scan for each block, so that no automaton
outgrows a task, and the scans of a document are merged by its row number.

Defined cases: null texts have no words and no matches; items without words
have no windows; an item that occurs twice under one id is one item; null item
ids don't take part; a document of any length is scanned whole; extra columns
are not read. An empty table gives an empty result, an empty benchmark one
without hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import documents, row_of, stored, text_slices, with_row_id
from basketry.sources.tables import table

WINDOW = 13
#: Characters of benchmark text that one automaton holds.
MAX_BLOCK_CHARS = 4_000_000
#: A document is contaminated from this share of hit words on: hit * SHARE >= words.
SHARE = 20

#: Bytes of words stay (letters in lower case, digits, all of a non-ASCII character), others become spaces.
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


def windows_of(text: str, window: int = WINDOW) -> set[bytes]:
    words = words_of(text)
    if not words:
        return set()
    return {b" ".join(words[i:i + window]) for i in range(max(1, len(words) - window + 1))}


def build_automaton(items: list[tuple], window: int = WINDOW):
    """Automaton of all windows; each holds its number of words and its items."""
    import ahocorasick

    owners: dict[bytes, set] = {}
    for item, text in items:
        for w in windows_of(text or "", window):
            owners.setdefault(w, set()).add(item)
    if not owners:
        return None
    automaton = ahocorasick.Automaton()
    for w, own in owners.items():
        automaton.add_word(f" {w.decode('latin-1')} ", (w.count(b" ") + 1, tuple(own)))
    automaton.make_automaton()
    return automaton


def scan(text: str, automaton) -> tuple[int, list[int], list, set]:
    """Number of words, runs of hit words (flat start, end), their code point spans, and items."""
    words = words_of(text)
    if automaton is None or not words:
        return len(words), [], [], set()
    line = b" " + b" ".join(words) + b" "
    hits, items = [], set()
    for end, (n, own) in automaton.iter(line.decode("latin-1")):
        hits.append((end, n))
        items.update(own)
    if not hits:
        return len(words), [], [], items
    # a match ends on the space behind its last word; so many spaces stand before that word
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
    last = np.searchsorted(spaces, [e for e, _ in hits]) - 1
    mark = np.zeros(len(words) + 1, np.int64)
    np.add.at(mark, last + 1 - np.array([n for _, n in hits]), 1)
    np.add.at(mark, last + 1, -1)
    on = np.r_[0, (np.cumsum(mark)[:-1] > 0).astype(np.int8), 0]
    starts, ends = np.flatnonzero(np.diff(on) == 1), np.flatnonzero(np.diff(on) == -1)
    return len(words), np.stack([starts, ends], 1).ravel().tolist(), original_spans(text, starts, ends), items


def original_spans(text: str, starts, ends) -> list[tuple[int, int]]:
    """Code point spans in the original text of runs of words [start, end)."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    inside = np.r_[False, np.frombuffer(_TO_WORDS, np.uint8)[data] != 32, False]
    begin, stop = np.flatnonzero(~inside[:-1] & inside[1:]), np.flatnonzero(inside[:-1] & ~inside[1:])
    points = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]  # code points before each byte
    return [(int(points[begin[s]]), int(points[stop[e - 1]])) for s, e in zip(starts, ends)]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, max_chars: int) -> tuple[int, Iterator[list[tuple]]]:
    """How many blocks, and the items as (id as text, text), in hash blocks of about
    ``max_chars`` characters that are read one by one."""
    items = (
        benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
        .where("item is not null and text is not null").distinct()
    )
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = 1 + total // max_chars
    return n, ([tuple(r) for r in items.where(F.pmod(F.xxhash64("item"), F.lit(n)) == b).collect()] for b in range(n))


HITS = "n_words long, runs array<int>, spans array<struct<start: int, end: int>>, items array<string>"


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, share: int = SHARE, max_block_chars: int = MAX_BLOCK_CHARS, keep: list[str] | None = None,
) -> DataFrame:
    """A row for each document: the columns ``keep`` (all by default) in a struct
    ``row``, then n_words, n_hit, runs (of hit words), spans (code points), items
    (sorted as strings) and contaminated."""
    spark = docs.sparkSession
    n_blocks, blocks = _blocks(benchmark, item_col, item_text_col, max_block_chars)
    one = n_blocks == 1
    base = docs.select(row_of(docs, keep), F.col(text_col).alias("text"))
    if not one:
        base = stored(with_row_id(base, "number"))

    def scanned(sent) -> DataFrame:
        def run(batches):
            automaton = build_automaton(sent.value, window)
            for batch, texts in text_slices(batches, "text"):
                found = [scan(t, automaton) for t in texts]
                own = [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.list_(pa.int32())),
                       pa.array([[{"start": s, "end": e} for s, e in f[2]] for f in found], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                       pa.array([sorted(f[3]) for f in found], pa.list_(pa.string()))]
                head = [batch.column(i) for i, c in enumerate(batch.schema.names) if c != "text"]
                yield pa.RecordBatch.from_arrays([*head, *own], names=[*[c for c in batch.schema.names if c != "text"], "n_words", "runs", "spans", "items"])

        head = base.drop("text").schema
        schema = spark.createDataFrame([], HITS).schema
        return base.mapInArrow(run, type(schema)([*head.fields, *schema.fields]))

    if one:
        hits = scanned(spark.sparkContext.broadcast(next(blocks)))
    else:
        # the driver and the tasks hold one block at a time: its hits are stored before the next one is read
        parts = None
        for block in blocks:
            sent = spark.sparkContext.broadcast(block)
            del block
            found = scanned(sent)
            found = stored(found if parts is None else found.where(F.size("runs") > 0))
            sent.destroy()
            parts = found if parts is None else parts.unionByName(found)
        merged = parts.groupBy("number").agg(
            F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("runs")).alias("runs"), F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
        hits = base.drop("text").join(merged, "number").drop("number")
        # runs of several blocks may overlap: take their union
        pairs = F.transform(F.sequence(F.lit(1), (F.size("runs") / 2).cast("int")), lambda i: F.struct(F.element_at("runs", 2 * i - 1).alias("start"), F.element_at("runs", 2 * i).alias("end")))
        hits = hits.withColumn("runs", F.when(F.size("runs") == 0, F.array().cast("array<int>")).otherwise(F.flatten(F.transform(_union(pairs), lambda p: F.array(p["start"], p["end"])))))
        hits = hits.withColumn("spans", _union(F.col("spans")))
    even = F.filter("runs", lambda x, i: i % 2 == 0)
    odd = F.filter("runs", lambda x, i: i % 2 == 1)
    n_hit = F.aggregate(F.zip_with(odd, even, lambda e, s: (e - s).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    hits = hits.withColumn("n_hit", n_hit)
    return hits.withColumn("contaminated", (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words")))


def _union(spans):
    """Sorted, overlapping or touching spans made one."""
    def add(done, s):
        touches = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= s["start"])
        grown = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(F.try_element_at(done, F.lit(-1))["start"].alias("start"), F.greatest(F.try_element_at(done, F.lit(-1))["end"], s["end"]).alias("end"))))
        return F.when(touches, grown).otherwise(F.concat(done, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))))

    return F.aggregate(F.array_sort(spans), F.array().cast("array<struct<start:int,end:int>>"), add)


def op7_decontamination(spark, sf_dir: str) -> DataFrame:
    """All documents against all windows of all benchmark items."""
    out = decontaminate(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return out.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OP7_SQL = rf"""
with d as (select row_number() over () r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from documents),
b as (select item_id::varchar item, regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w from benchmark where text is not null and item_id is not null),
i as (select distinct item, k, array_to_string(w[pos:pos + k - 1], ' ') g from (select item, w, least(len(w), {WINDOW}) k, unnest(range(1, len(w) - least(len(w), {WINDOW}) + 2)) pos from b where len(w) > 0)),
x as (select r, k, pos, array_to_string(w[pos:pos + k - 1], ' ') g from (select r, w, k, unnest(range(1, len(w) - k + 2)) pos from d, (select distinct k from i))),
h as (select x.r, x.pos, x.k, i.item from x join i on x.k = i.k and x.g = i.g),
n as (select r, count(distinct place) n_hit from (select r, unnest(range(pos, pos + k)) place from h) group by r),
t as (select r, count(distinct item) n_items, array_to_string(list_sort(list(distinct item)), ',') items from h group by r)
select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
       sha256(coalesce(items, '')) items_sha256, coalesce(n_hit > 0 and {SHARE} * n_hit >= len(w), false) contaminated
from d left join n using (r) left join t using (r)
"""
