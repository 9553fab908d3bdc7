"""Audit of how the sources of a language diverge in their terms.

Terms are runs of ASCII letters and of code points from U+0080 on, A-Z lower-cased. A
language keeps the V terms that at least LEAST_DOCS of its documents have. A term
that occurs c times in a group (a source's documents of one language, or the
language) has there p = 1 + floor(UNIT (c + 2) / (N + 2 V)), where N is the sum of c
over the kept terms, and two groups diverge at it by f = floor((p - q)^2 / (p + q)).
The audit has the divergence of each two sources of a language, summed over all
kept terms, and for each source the TOP terms that it has more of than its language.
All of it is in integers.

1. Tasks count terms and the documents that have them for each (language, source),
   a bounded number before they pass them on. One shuffle by (language, term) adds them
   up and makes a row for each kept term with its counts by source.
2. f depends on counts alone. The terms of a group are cells (count in the group,
   count in the language) with a multiplicity; f is found once a cell. Cells of equal
   f are one value; the TOP greatest values of a group are enough, since each has a
   term, and so are those of them before which fewer than TOP terms stand. The cells of
   these values are expanded to their terms, in UTF-8 order within a value. Both
   rankings keep TOP rows within each task before they are shuffled.
3. For two sources a and b the cells are (count in a, count in b). Cells where both
   counts are over 0 come from the terms' rows; the others follow from the histogram
   of each source's counts: with f(x, y) of counts x and y, the sum over all terms is
     V f(0, 0) + sum over terms of a of (f(x, 0) - f(0, 0))
               + sum over terms of b of (f(0, y) - f(0, 0))
               + sum over terms of both of (f(x, y) - f(x, 0) - f(0, y) + f(0, 0)),
   so that no term costs a row for sources that don't have it.

A term's row holds a count for each source of the language, and each two sources
of a language are a row of the result: what grows with the square of the
number of sources is the result itself.

Defined cases: null languages, sources and texts count as empty ones, and the
empty language and source are a language and a source like any other. Repeated
rows are documents of their own. A group without terms diverges from others like
any group with all counts 0; a language without kept terms has value 0 for all pairs
and no terms. Of equal values the item that is less in UTF-8 comes first. A source
without others has no pairs. An empty table gives an empty result. Only the three named
columns are read, so clashing names don't matter.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.llm.common import documents, quoted, stored, text_slices
from basketry.plans.guards import broadcast_checked

LEAST_DOCS = 10
UNIT = 1_000_000_000
TOP = 10
#: Distinct (group, term) that a task holds before it passes them on.
FLUSH_TERMS = 400_000
#: Pairs of sources that one task should make.
PAIRS_PER_TASK = 2_000_000

#: Bytes of UTF-8 that are in terms, lower-cased; all others become blanks.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode("utf-8").translate(_LETTERS).split()


def _counts(base: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of terms, as tasks counted them."""
    def run(batches):
        seen: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def passed_on():
            rows = [(g, t, n, docs[t]) for g, (occurrences, docs) in seen.items() for t, n in occurrences.items()]
            columns = [pa.array([r[0][0] for r in rows], pa.string()), pa.array([r[0][1] for r in rows], pa.string()),
                       pa.array([r[1] for r in rows], pa.binary()).cast(pa.string()), pa.array([r[2] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])

        for batch, texts in text_slices(batches, "text"):
            langs, sources = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("lang", "source"))
            for group, text in zip(zip(langs, sources), texts):
                found = terms_of(text)
                occurrences, docs = seen.get(group) or seen.setdefault(group, (Counter(), Counter()))
                occurrences.update(found)
                docs.update(set(found))
            if sum(len(docs) for _, docs in seen.values()) > FLUSH_TERMS:
                yield passed_on()
                seen = {}
        if seen:
            yield passed_on()

    return base.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def kept_terms(base: DataFrame, least_docs: int) -> DataFrame:
    """(lang, term, count, sources): the kept terms and the sources that have them, in order, with their counts; stored."""
    # one shuffle: rows of a term are in one partition for both groupings
    counts = _counts(base).repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    each = F.array_sort(F.collect_list(F.struct("source", "n"))).alias("sources")
    terms = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("count"), each)
    return stored(terms.where(F.col("docs") >= least_docs).drop("docs"))


def _p(count: Column | str, total: Column | str, kept: Column | str) -> Column:
    count, total, kept = (F.col(x) if isinstance(x, str) else x for x in (count, total, kept))
    exact = (count.cast("decimal(38,0)") + 2) * UNIT
    return F.call_function("div", exact, F.greatest(total + 2 * kept, F.lit(1).cast("long"))) + 1


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _term_part(terms: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """(lang, source, item, value, rank): the terms that a source has more of than its language."""
    each = terms.select("lang", "term", F.col("count").alias("all"), F.explode("sources").alias("s")).select("lang", "s.source", "term", "s.n", "all")
    cells = each.groupBy("lang", "source", "n", "all").agg(F.count(F.lit(1)).alias("terms")).join(groups, ["lang", "source"])
    p, q = _p("n", "total", "kept"), _p("all", "lang_total", "kept")
    cells = stored(cells.where(p > q).select("lang", "source", "n", "all", "terms", _f(p, q).alias("value")))
    by_value = W.partitionBy("lang", "source").orderBy(F.desc("value"))
    values = cells.groupBy("lang", "source", "value").agg(F.sum("terms").alias("terms"))
    values = values.withColumn("place", F.row_number().over(by_value)).where(F.col("place") <= top)
    before = F.coalesce(F.sum("terms").over(by_value.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    values = values.withColumn("before", before).where(F.col("before") < top).select("lang", "source", "value")
    found, _ = broadcast_checked(stored(cells.join(values, ["lang", "source", "value"]).drop("terms")))
    items = each.join(found, ["lang", "source", "n", "all"]).select("lang", "source", F.col("term").alias("item"), "value")
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return items.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _pair_part(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value, rank): the divergence of a source from each other one of its language."""
    size = F.size("sources").cast("long")
    made = terms.agg(F.coalesce(F.sum(size * (size - 1) / 2), F.lit(0)).cast("long")).first()[0]
    shared = terms.where(size > 1).select("lang", "sources")
    if made > PAIRS_PER_TASK:
        # rows are small, but a row makes many pairs
        shared = shared.repartition(-(-made // PAIRS_PER_TASK))
    firsts = shared.select("lang", F.posexplode("sources").alias("at", "a"), "sources")
    both = firsts.select("lang", "a", F.explode(F.slice("sources", F.col("at") + 2, F.size("sources"))).alias("b"))
    both = both.select("lang", F.col("a.source").alias("a"), F.col("b.source").alias("b"), F.col("a.n").alias("n_a"), F.col("b.n").alias("n_b"))
    both = both.groupBy("lang", "a", "b", "n_a", "n_b").agg(F.count(F.lit(1)).alias("terms"))
    side = lambda k: groups.select("lang", F.col("source").alias(k), F.col("total").alias(f"total_{k}"), *(["kept"] if k == "a" else []))
    cells = both.join(side("a"), ["lang", "a"]).join(side("b"), ["lang", "b"])

    def at(x, y):
        count = lambda c: F.lit(c) if isinstance(c, int) else F.col(c)
        return _f(_p(count(x), "total_a", "kept"), _p(count(y), "total_b", "kept"))

    gain = at("n_a", "n_b") - at("n_a", 0) - at(0, "n_b") + at(0, 0)
    shares = cells.select("lang", "a", "b", (F.col("terms") * gain).alias("value"))
    shares = shares.unionByName(shares.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    # each source's counts against 0 in every other source, both ways round
    counts = terms.select("lang", F.explode("sources").alias("s")).groupBy("lang", F.col("s.source").alias("a"), F.col("s.n").alias("n_a")).agg(F.count(F.lit(1)).alias("terms"))
    alone = counts.join(side("a"), ["lang", "a"]).join(side("b"), "lang").where("a <> b")
    alone = alone.select("lang", "a", "b", (F.col("terms") * (at("n_a", 0) - at(0, 0))).alias("value"))
    alone = alone.unionByName(alone.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    none = side("a").join(side("b"), "lang").where("a <> b").select("lang", "a", "b", (F.col("kept") * at(0, 0)).alias("value"))
    sums = shares.unionByName(alone).unionByName(none).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    order = W.partitionBy("lang", "a").orderBy(F.desc("value"), "b")
    return sums.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value", F.row_number().over(order).alias("rank"))


def divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): parts ``pair`` and ``term``."""
    text = lambda c, name: F.coalesce(quoted(c).cast("string"), F.lit("")).alias(name)
    base = docs.select(text(text_col, "text"), text(lang_col, "lang"), text(source_col, "source"))
    terms = kept_terms(base, least_docs)
    langs = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("count").alias("lang_total"))
    totals = terms.select("lang", F.explode("sources").alias("s")).groupBy("lang", F.col("s.source").alias("source")).agg(F.sum("s.n").alias("total"))
    all_groups = base.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups, _ = broadcast_checked(stored(all_groups.na.fill(0, ["total", "kept", "lang_total"])))
    parts = [_pair_part(terms, groups).withColumn("part", F.lit("pair")), _term_part(terms, groups, top).withColumn("part", F.lit("term"))]
    return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", "rank")


def op12_divergence(spark, sf_dir: str) -> DataFrame:
    """The audit of all documents."""
    return divergence(documents(spark, sf_dir))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _sql_p(count: str, total: str) -> str:
    return f"(1 + {UNIT}::hugeint * ({count} + 2) // ({total} + 2 * kept))"


def _sql_f(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) // ({p} + {q}))"


OP12_SQL = rf"""
with d as (
    select row_number() over () r, coalesce(lang, '') lang, coalesce(source, '') source,
           regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') w from documents),
o as (select r, lang, source, t, count(*) n from (select r, lang, source, unnest(w) t from d) group by all),
k as (select lang, t, sum(n) total from o group by lang, t having count(*) >= {LEAST_DOCS}),
v as (select lang, count(*) kept, sum(total) lang_total from k group by lang),
g as (select distinct lang, source from d),
c as (select g.lang, g.source, k.t, coalesce(sum(o.n), 0) n, any_value(k.total) lang_n
      from g join k on k.lang = g.lang left join o on o.lang = g.lang and o.source = g.source and o.t = k.t group by all),
p as (select c.*, {_sql_p("n", "sum(n) over (partition by c.lang, c.source)")} p, {_sql_p("lang_n", "lang_total")} q from c join v on v.lang = c.lang),
s as (select a.lang, a.source, b.source item, sum({_sql_f("a.p", "b.p")}) value from p a join p b on a.lang = b.lang and a.t = b.t and a.source <> b.source group by all),
u as (
    select a.lang, a.source, 'pair' part, b.source item, coalesce(s.value, 0)::bigint as value
    from g a join g b on a.lang = b.lang and a.source <> b.source left join s on s.lang = a.lang and s.source = a.source and s.item = b.source
    union all
    select lang, source, 'term' part, t item, {_sql_f("p", "q")}::bigint as value from p where n > 0 and p > q),
x as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int rank from u)
select * from x where part = 'pair' or rank <= {TOP}
"""
