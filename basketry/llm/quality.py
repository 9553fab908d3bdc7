"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Four rates of a document are judged: mean word length, symbols, repeated lines
and words in repeated 3-word windows. Instead of fixed cutoffs, each (language,
source) gets limits from its own documents, FENCE widths outside two quantiles of
the rate, whose distance is the width: the quartiles for word length, where both
tails fail, and the median and the 90th percentile for the others, where only high
values do. Symbols are an outlier wherever the group's texts have few, so all
documents count there. Repetition occurs in clean text, but in few documents; how
much is usual is learned from those that have any. The least width is one rounding
step of the rate, and a document fails only if FENCE steps of its own (one more
symbol, repeated line, repeated window, or ten letters) would not bring it inside:
a short text's rates are coarse.

The quantiles come from sketches: counts of
logarithmic buckets with SUB_BUCKETS steps per power of two (a relative error
of 1 / SUB_BUCKETS at most). Sketches merge by adding counts, so one pass makes
those of (language, source), and sums of them those of a language and of all
documents. A rate for which a group has too few documents (MIN_GROUP, or MIN_SOME
with repetition) uses the next wider sketch; if fewer than MIN_SOME documents of
all have repetition, the limit is 0 and the document's own steps. Limits are
joined back to the documents by group, salted because one source may hold a third
of them.

Only DataFrame functions run. All steps are in integers, so the result doesn't
depend on order or partitioning. Documents are never shuffled with their text:
the counts are stored once, and sketches and the join read those.

Defined cases: a null or empty text has no words and fails the base rule; null
languages or sources form groups of their own; a document that fails the base
rule isn't part of a sketch; if no document passes the base rule nothing is kept;
equal rows get equal results; an empty table gives an empty one. Only the named
columns are read, so other columns can have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.llm.common import documents, row_of, SPACE_CLASS, SPACES, stored

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
#: Steps of a sketch per power of two.
SUB_BUCKETS = 32
#: Documents that a group needs for limits of its own, and those with repetition that it needs for limits of repetition.
MIN_GROUP = 200
MIN_SOME = 50
#: Fences stand so many widths outside the quantiles.
FENCE = 3
#: Copies of the limits that hot groups are spread over.
SALTS = 16
@dataclass(frozen=True)
class Rate:
    """``scale * over / under``, judged by the quantiles ``low`` and ``high`` (percent) of all
    documents or of those where it isn't 0; ``step`` is the least change of ``over`` that counts."""

    over: str
    under: str
    scale: int
    step: int
    low: int
    high: int
    some: bool = False
    both: bool = False

    @property
    def least(self) -> int:
        return MIN_SOME if self.some else MIN_GROUP


RATES = {
    "word_length": Rate("word_chars", "n_words", 100, 10, 25, 75, both=True),
    "symbols": Rate("n_symbols", "n_words", 1000, 1, 50, 90),
    "dup_lines": Rate("n_dup_lines", "n_lines", 1000, 1, 50, 90, some=True),
    "repeat_words": Rate("n_repeat_words", "n_words", 1000, 2 * WINDOW, 50, 90, some=True),
}


def _repeat_positions(words: str) -> list[tuple[str, Column]]:
    """Steps (column name, expression) to the sorted starts of the windows of
    ``words`` that occur twice or more in it.

    Hash and start of a window share a 64-bit integer (as many low bits as the
    number of words needs); sorted, windows of equal hash bits stand side by side.
    The few so found are compared word by word."""
    at = lambda i, k: F.get(words, i + k)
    window = lambda i: [at(i, k) for k in range(WINDOW)]
    bits = F.length(F.bin(F.size(words)))
    low = lambda x: F.call_function("shiftright", x, F.col("bits"))
    near = lambda a, i, same: F.coalesce(same(F.get(a, i - 1)), F.lit(False)) | F.coalesce(same(F.get(a, i + 1)), F.lit(False))
    packed = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.call_function("shiftleft", low(F.xxhash64(*window(i))), F.col("bits")).bitwiseOR(i.cast("long")),
    )
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bits")) - 1
    found = F.transform(
        F.filter("packed", lambda x, i: near("packed", i, lambda y: low(x) == low(y))),
        lambda x: x.bitwiseAND(F.col("mask")).cast("int"),
    )
    spelled = F.sort_array(F.transform("found", lambda i: F.struct(F.array(*window(i)).alias("w"), i.alias("i"))))
    true = F.sort_array(F.transform(
        F.filter("spelled", lambda x, i: near("spelled", i, lambda y: x["w"] == y["w"])), lambda x: x["i"],
    ))
    none = F.array().cast("array<bigint>")
    return [
        ("bits", bits), ("mask", mask),
        ("packed", F.when(F.size(words) >= WINDOW, F.sort_array(packed)).otherwise(none)),
        ("found", found), ("spelled", spelled), ("repeats", true),
    ]


def text_counts(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` and n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words (long)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.select(F.struct(*keep).alias("keep"), text.alias("text"))
    out = out.select(
        "keep",
        F.array_remove(F.split("text", f"[{SPACE_CLASS}]+"), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("lines"),
        F.length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
    )
    out = out.select(
        "keep", "words", "n_symbols", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
    )
    for name, step in _repeat_positions("words"):
        out = out.withColumn(name, step)
    # a window adds the words that the one before it doesn't cover
    covered = F.aggregate(
        F.transform("repeats", lambda x, i: F.least(F.lit(WINDOW), x - F.coalesce(F.get("repeats", i - 1), F.lit(-WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x,
    )
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    return out.select("keep.*", *names, covered.alias("n_repeat_words"))


def bucket(value: Column) -> Column:
    """Least value of the sketch bucket of a non-negative integer."""
    shift = F.greatest(F.length(F.bin(value)) - F.lit(SUB_BUCKETS.bit_length()), F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def rate(name: str) -> Column:
    r = RATES[name]
    return F.coalesce(F.expr(f"{r.scale} * `{r.over}` div nullif(`{r.under}`, 0)"), F.lit(0)).cast("long")


def outside(name: str, limits: str) -> Column:
    """Whether a document's rate is outside its limits, with FENCE steps of its own to spare."""
    r = RATES[name]
    over, under, spare = r.scale * F.col(r.over), F.col(r.under), F.lit(FENCE * r.scale * r.step)
    high = over - F.col(f"{limits}.{name}_high") * under > spare
    return high | (F.col(f"{limits}.{name}_low") * under - over > spare) if r.both else high


def sketches(counts: DataFrame) -> DataFrame:
    """(level, lang, source, rate, bucket, n): level 2 for a language and source, 1 for a language, 0 for all."""
    cells = [F.when(rate(k) > 0 if r.some else F.lit(True), F.struct(F.lit(k).alias("rate"), bucket(rate(k)).alias("bucket"))) for k, r in RATES.items()]
    fine = (
        counts.where("not base_failed").select("lang", "source", F.explode(F.array_compact(F.array(*cells))).alias("r"))
        .groupBy("lang", "source", "r.rate", "r.bucket").agg(F.count(F.lit(1)).alias("n"))
    )
    levels = F.explode(F.array(
        F.struct(F.lit(2).alias("level"), F.col("lang"), F.col("source")),
        F.struct(F.lit(1).alias("level"), F.col("lang"), F.lit(None).cast("string").alias("source")),
        F.struct(F.lit(0).alias("level"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source")),
    ))
    return (
        fine.select(levels.alias("g"), "rate", "bucket", "n")
        .groupBy("g.level", "g.lang", "g.source", "rate", "bucket").agg(F.sum("n").alias("n"))
    )


def limits(sketch: DataFrame) -> DataFrame:
    """(level, lang, source, limits): limits is a struct of ``<rate>_n``, the documents in the
    sketch, ``<rate>_low`` and ``<rate>_high``, null where the sketch is empty."""
    group = ["level", "lang", "source", "rate"]
    upto = W.partitionBy(*group).orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    ranked = sketch.select("*", F.sum("n").over(upto).alias("upto"), F.sum("n").over(W.partitionBy(*group)).alias("total"))
    percent = F.create_map(*[x for k, r in RATES.items() for x in (F.lit(k), F.struct(F.lit(r.low).alias("low"), F.lit(r.high).alias("high")))])
    quantile = lambda k: F.min(F.when(F.col("upto") * 100 >= F.col("total") * percent[F.col("rate")][k], F.col("bucket"))).alias(k)
    quantiles = ranked.groupBy(*group).agg(F.max("total").alias("total"), quantile("low"), quantile("high"))
    spread = FENCE * F.greatest(F.col("high") - F.col("low"), F.lit(1))
    columns = []
    for name in RATES:
        for k, x in {"n": F.col("total"), "low": F.col("low") - spread, "high": F.col("high") + spread}.items():
            columns.append(F.max(F.when(F.col("rate") == name, x)).alias(f"{name}_{k}"))
    return quantiles.groupBy("level", "lang", "source").agg(F.struct(*columns).alias("limits"))


def group_limits(counts: DataFrame) -> DataFrame:
    """(lang, source, limits), a row for each group: the limits (``<rate>_low``, ``<rate>_high``) of
    each rate are those of the narrowest sketch with enough documents."""
    found = stored(limits(sketches(counts)))
    level = lambda k, *names: found.where(F.col("level") == k).select(*names, F.col("limits").alias(f"limits{k}"))
    whole = found.where("level = 0").select("limits").first()  # one row of twelve numbers
    joined = level(2, "lang", "source").join(level(1, F.col("lang").alias("l_lang")), F.col("lang").eqNullSafe(F.col("l_lang")))
    columns = []
    for name, r in RATES.items():
        last = whole.limits if whole else {f"{name}_{k}": None for k in ("n", "low", "high")}
        enough = not r.some or (last[f"{name}_n"] or 0) >= r.least
        for k in ("low", "high"):
            x = F.lit(last[f"{name}_{k}"] if enough else 0).cast("long")
            for i in (1, 2):
                x = F.when(F.col(f"limits{i}.{name}_n") >= r.least, F.col(f"limits{i}.{name}_{k}")).otherwise(x)
            columns.append(x.alias(f"{name}_{k}"))
    return joined.select("lang", "source", F.struct(*columns).alias("limits"))


def judge(docs: DataFrame, keep: list[str], text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``keep`` in a struct ``row``, the counts, base_failed, failed (names of the
    adaptive rules that failed) and kept, for every row of ``docs``."""
    named = docs.select(
        row_of(docs, keep), F.col(lang_col).cast("string").alias("lang"),
        F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    counts = stored(text_counts(named, ["row", "lang", "source"]).withColumn("base_failed", failed))
    salted = group_limits(counts).select(
        F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), "limits",
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("g_salt"),
    )
    numbers = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    salt = F.pmod(F.xxhash64("row", *numbers), F.lit(SALTS)).cast("int")
    joined = counts.withColumn("salt", salt).join(
        salted,
        F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source")) & (F.col("salt") == F.col("g_salt")),
        "left",
    )
    judged = joined.withColumn("failed", F.array_compact(F.array(*[F.when(outside(k, "limits"), F.lit(k)) for k in RATES])))
    kept = ~F.col("base_failed") & F.col("limits").isNotNull() & (F.size("failed") == 0)
    return judged.select("row", *numbers, "base_failed", "failed", kept.alias("kept"))


def op2_quality(spark, sf_dir: str) -> DataFrame:
    """All documents, judged by the sketches of all documents."""
    out = judge(documents(spark, sf_dir), ["doc_id"])
    return out.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def _oracle() -> str:
    value = {k: f"coalesce({r.scale} * {r.over} // nullif({r.under}, 0), 0)" for k, r in RATES.items()}
    cells = " union all ".join(f"select lang, source, '{k}' rate, {value[k]} v from c where not base_failed" + (f" and {value[k]} > 0" if r.some else "") for k, r in RATES.items())
    top = SUB_BUCKETS.bit_length()
    percent = lambda k: "case rate " + " ".join(f"when '{n}' then {getattr(r, k)}" for n, r in RATES.items()) + " end"
    numbers = {"n": "total", "low": "low - spread", "high": "high + spread"}
    pick = ", ".join(f"max(case when rate = '{k}' then {x} end) {k}_{n}" for k in RATES for n, x in numbers.items())
    last = lambda k, r, n: f"case when z.{k}_n >= {r.least} then z.{k}_{n} else 0 end" if r.some else f"z.{k}_{n}"
    chosen = ", ".join(
        f"case when g.{k}_n >= {r.least} then g.{k}_{n} when h.{k}_n >= {r.least} then h.{k}_{n} else {last(k, r, n)} end {k}_{n}"
        for k, r in RATES.items() for n in ("low", "high")
    )
    test = " and ".join(
        f"{r.scale} * {r.over} - l.{k}_high * {r.under} <= {FENCE * r.scale * r.step}" + (f" and l.{k}_low * {r.under} - {r.scale} * {r.over} <= {FENCE * r.scale * r.step}" if r.both else "")
        for k, r in RATES.items()
    )
    return rf"""
with d as (select row_number() over () r, doc_id, lang, source, coalesce(text, '') t from documents),
w as (select r, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') w,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) l from d),
g as (select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] g from (select r, w, unnest(range(1, len(w) - 1)) i from w)),
p as (select r, count(distinct i + k) n from (select r, i, count(*) over (partition by r, g) n from g), (select unnest([0, 1, 2]) k) where n > 1 group by r),
b as (select d.r, doc_id, lang, source, len(w)::bigint n_words, length(array_to_string(w, ''))::bigint word_chars,
      length(regexp_replace(t, '[^{SYMBOLS}]+', '', 'g'))::bigint n_symbols, len(l)::bigint n_lines,
      (len(l) - len(list_distinct(l)))::bigint n_dup_lines, coalesce(p.n, 0)::bigint n_repeat_words
      from d join w using (r) left join p using (r)),
c as (select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words base_failed from b),
v as ({cells}),
s as (select lang, source, rate, (v >> greatest(length(bin(v)) - {top}, 0)) << greatest(length(bin(v)) - {top}, 0) bucket from v),
k as (select 2 lev, lang, source, rate, bucket from s union all select 1, lang, null, rate, bucket from s union all select 0, null, null, rate, bucket from s),
n as (select lev, lang, source, rate, bucket, count(*) n from k group by all),
u as (select *, sum(n) over (partition by lev, lang, source, rate order by bucket) upto, sum(n) over (partition by lev, lang, source, rate) total from n),
q as (select lev, lang, source, rate, max(total) total, min(case when 100 * upto >= total * ({percent("low")}) then bucket end) low, min(case when 100 * upto >= total * ({percent("high")}) then bucket end) high from u group by all),
f as (select *, {FENCE} * greatest(high - low, 1) spread from q),
m as (select lev, lang, source, {pick} from f group by all),
e as (select g.lang dl, g.source ds, {chosen} from m g join m h on g.lev = 2 and h.lev = 1 and g.lang is not distinct from h.lang join m z on z.lev = 0)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and coalesce({test}, false) kept
from c left join e l on c.lang is not distinct from l.dl and c.source is not distinct from l.ds
"""


OP2_SQL = _oracle()
