"""Secret scan: three patterns, and a randomness test battery for bare keys.

Patterns find assigned values, access key ids and long hexadecimal strings. Keys
without such marks are found because they are random: every run of MIN_RUN or
more base64 characters outside the pattern spans is a candidate, its encoding is
inferred from the characters in it, and three statistics of its symbols are
compared with what names, words and paths of that encoding show at least:

* chi-squared of the symbol counts against an even alphabet: of a text whose
  symbol shares differ from even ones by the effect w2 it has a mean of
  ``k - 1 + n * w2`` and a variance of ``2 * (k - 1 + 2 * n * w2)``;
* runs: the share of neighbours from different halves of the alphabet, which is
  1/2 for random strings and differs by RUNS_EFFECT in ordinary ones;
* serial correlation: that of neighbouring symbols, 0 against SERIAL_EFFECT.

Each gives a z value, low for what is more even than ordinary strings get by
chance; they are added by Stouffer's rule. The null hypothesis is "ordinary
string", so short strings, which chance makes look even, have no low values. The
Benjamini-Hochberg procedure then bounds the share of false discoveries at
FALSE_SHARE, over all candidates of the corpus with the same encoding and length
class: common long words don't use up what rare long keys can get, and the other
way round. It works on a histogram of z values in steps of 1/100, which partial
aggregation merges.

Only DataFrame functions run. Candidates stay in the row of their document, and a
stored table without texts is read twice: for the histogram and for the result.

Defined cases: a null text counts as empty; an empty text has no spans; a text of
any length is searched whole; equal rows give equal results; an empty table gives
an empty one. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.llm.common import documents, row_of, stored
from basketry.llm.native_spans import add_matches, run_start, spelled

# Fixed patterns of the contract; groups without alternatives inside are possessive or plain classes.
KINDS = {
    "assign": "(?i)(?:password|passwd|secret|token|api_?key)[\"']?\\x20*+[:=]\\x20*+[\"']?[A-Za-z0-9+/_.=-]++",
    # runs of at least the wanted length: a shorter run has no part that is long enough
    "access": "AKIA[A-Z0-9]{16,}+",
    "hex": "(?<![0-9a-f])[0-9a-f]{24,}+",
}
#: Behind it comes the value of an assignment.
ASSIGN_HEAD = "(?i)^(?:password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?"
MIN_VALUE = 6

RUN_CLASS = "A-Za-z0-9+/_-"
MIN_RUN = 20
#: Encodings by what they consist of, the first that fits: pattern, alphabet size, effect of ordinary strings.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = {
    "decimal": ("^[0-9]+$", "0123456789", 0.0),
    "hex": ("^(?=.*[0-9])(?:[0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef", 1.0),
    "letters": ("^(?:[a-z]+|[A-Z]+|[A-Z][a-z]+)$", LETTERS, 0.7),
    "base32": ("^(?=.*[2-7])[A-Z2-7]+$", LETTERS + "234567", 1.0),
    "base36": ("^(?:[a-z0-9]+|[A-Z0-9]+)$", "0123456789" + LETTERS, 1.0),
    "base64": ("", "0123456789" + LETTERS + LETTERS.upper() + "+/", 2.0),
}
#: Not tested: numbers are ids and amounts.
UNTESTED = {"decimal"}
RUNS_EFFECT = 0.2
SERIAL_EFFECT = 0.3
FALSE_SHARE = 0.01


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _tested(candidates: Column) -> list[tuple[str, Column]]:
    """Steps from array<struct<start, stop, value>> to one with stratum and z (in 1/100)."""
    def encoding(v: Column) -> Column:
        out = F.lit("base64")
        for name, (pattern, _, _) in reversed(ENCODINGS.items()):
            out = F.when(v.rlike(pattern), F.lit(name)).otherwise(out) if pattern else out
        return out

    def of(name: Column, values: dict) -> Column:
        out = F.lit(values["base64"])
        for k, x in values.items():
            out = F.when(name == k, F.lit(x)).otherwise(out)
        return out

    with_encoding = F.transform(candidates, lambda c: F.struct(c["start"].alias("start"), c["stop"].alias("stop"), c["value"].alias("value"), encoding(c["value"]).alias("encoding")))
    tested = F.filter("c1", lambda c: ~c["encoding"].isin(*UNTESTED))
    # case carries no information but in base64; url-safe signs are the plain ones
    folded = lambda c: F.when(c["encoding"] == "base64", F.translate(c["value"], "_-", "/+")).otherwise(F.lower(c["value"]))
    with_text = F.transform("c2", lambda c: F.struct(
        c["start"].alias("start"), c["stop"].alias("stop"), c["encoding"].alias("encoding"), folded(c).alias("value"),
        of(c["encoding"], {k: a for k, (_, a, _) in ENCODINGS.items()}).alias("alphabet"),
        of(c["encoding"], {k: float(len(a)) for k, (_, a, _) in ENCODINGS.items()}).alias("k"),
        of(c["encoding"], {k: e for k, (_, _, e) in ENCODINGS.items()}).alias("w2"),
    ))
    with_symbols = F.transform("c3", lambda c: F.struct(
        *[c[x].alias(x) for x in ("start", "stop", "encoding", "k", "w2")],
        F.length(c["value"]).cast("double").alias("n"),
        F.transform(F.sequence(F.lit(1), F.length(c["value"])), lambda i: F.call_function("instr", c["alphabet"], F.substring(c["value"], i, F.lit(1))).cast("double") - 1).alias("s"),
    ))
    with_sums = F.transform("c4", lambda c: F.struct(
        *[c[x].alias(x) for x in ("start", "stop", "encoding", "k", "w2", "n")],
        # squares of the symbol counts: equal symbols stand together once sorted
        _sum(F.transform(F.array_distinct(c["s"]), lambda x: F.pow(c["n"] - F.size(F.array_remove(c["s"], x)), F.lit(2.0)))).alias("squares"),
        _sum(F.transform(c["s"], lambda x, i: ((x * 2 >= c["k"]) != (F.coalesce(F.get(c["s"], i - 1), x) * 2 >= c["k"])).cast("double"))).alias("changes"),
        (_sum(c["s"]) / c["n"]).alias("mean"), c["s"].alias("s"),
    ))
    with_serial = F.transform("c5", lambda c: F.struct(
        *[c[x].alias(x) for x in ("start", "stop", "encoding", "k", "w2", "n", "squares", "changes")],
        F.coalesce(F.try_divide(
            _sum(F.transform(c["s"], lambda x, i: F.when(i > 0, (x - c["mean"]) * (F.get(c["s"], i - 1) - c["mean"])).otherwise(0.0))),
            _sum(F.transform(c["s"], lambda x: (x - c["mean"]) * (x - c["mean"]))),
        ), F.lit(1.0)).alias("serial"),
    ))

    def z(c: Column) -> Column:
        free, lift = c["k"] - 1, c["n"] * c["w2"]
        chi = (c["k"] * c["squares"] / c["n"] - c["n"] - free - lift) / F.sqrt(2 * (free + 2 * lift))
        runs = (F.abs(c["changes"] / (c["n"] - 1) - 0.5) - RUNS_EFFECT) * 2 * F.sqrt(c["n"] - 1)
        serial = (F.abs(c["serial"]) - SERIAL_EFFECT) * F.sqrt(c["n"])
        return (chi + runs + serial) / F.sqrt(F.lit(3.0))

    with_z = F.transform("c6", lambda c: F.struct(
        c["start"].alias("start"), c["stop"].alias("stop"),
        # lengths within half a power of two make a class
        F.concat_ws(" ", c["encoding"], F.floor(2 * F.log2(c["n"])).cast("string")).alias("stratum"),
        F.greatest(F.lit(-3000), F.least(F.lit(3000), F.floor(100 * z(c)))).cast("int").alias("z"),
    ))
    return [("c1", with_encoding), ("c2", tested), ("c3", with_text), ("c4", with_symbols), ("c5", with_sums), ("c6", with_serial), ("candidates", with_z)]


def _normal_tail(z: Column) -> Column:
    """Upper bound to 1e-7 of the normal distribution's lower tail, exact enough far out."""
    x = F.abs(z)
    density = F.exp(-x * x / 2) / 2.5066282746310002
    # Abramowitz and Stegun 26.2.17, and its continued fraction far out
    t = 1 / (1 + 0.2316419 * x)
    near = density * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    far = density * (1 / x) * (1 - 1 / (x * x + 2))
    tail = F.when(x > 5, far).otherwise(near)
    return F.when(z > 0, 1 - tail).otherwise(tail)


def discovery_limits(candidates: DataFrame, share: float = FALSE_SHARE) -> dict[str, int]:
    """For each stratum the largest z (in 1/100) that Benjamini-Hochberg accepts; strata
    without discovery are left out. A few hundred strata at most: encodings by length classes."""
    found = candidates.select(F.explode("candidates").alias("c")).groupBy("c.stratum", "c.z").agg(F.count(F.lit(1)).alias("n"))
    upto = W.partitionBy("stratum").orderBy("z").rowsBetween(W.unboundedPreceding, 0)
    ranked = found.select("stratum", "z", F.sum("n").over(upto).alias("upto"), F.sum("n").over(W.partitionBy("stratum")).alias("total"))
    accepted = ranked.where(_normal_tail((F.col("z") + 1) / 100) * F.col("total") <= share * F.col("upto"))
    return {r.stratum: r.z for r in accepted.groupBy("stratum").agg(F.max("z").alias("z")).collect()}


def find_secrets(docs: DataFrame, keep: list[str], text_col: str = "text", share: float = FALSE_SHARE) -> DataFrame:
    """``keep`` in a struct ``row``, and base and spans: array<struct<start, kind_order, kind, stop>>
    sorted by start, then kind. ``spans`` are the base spans and the random strings."""
    # A row for every text; only those with a match go through the steps below
    frame = docs.select(row_of(docs, keep), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    runs = run_start(RUN_CLASS) + f"[{RUN_CLASS}]{{{MIN_RUN},}}+"
    frame = add_matches(frame, "text", {**KINDS, "run": runs}).drop("text")
    frame = frame.withColumn("assign", F.filter("assign", lambda s: F.length(F.regexp_replace(s["value"], ASSIGN_HEAD, "")) >= MIN_VALUE))
    plain = lambda k, i: F.transform(k, lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("kind_order"), F.lit(k).alias("kind"), s["stop"].alias("stop")))
    frame = frame.select("row", "run", F.array_sort(F.concat(*[plain(k, i) for i, k in enumerate(KINDS)])).alias("base"))
    outside = F.filter("run", lambda c: ~F.exists("base", lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"])))
    frame = frame.select("row", "base", outside.alias("c0"))
    for name, step in _tested(F.col("c0")):
        frame = frame.select("row", "base", step.alias(name))
    frame = stored(frame)
    limits = discovery_limits(frame, share)
    limit = F.lit(None).cast("int")
    if limits:
        pairs = F.create_map(*[F.lit(x) for pair in sorted(limits.items()) for x in pair])
        random = F.filter("candidates", lambda c: c["z"] <= F.try_element_at(pairs, c["stratum"]))
    else:
        random = F.filter("candidates", lambda c: c["z"] <= limit)
    added = F.transform(random, lambda c: F.struct(c["start"].alias("start"), F.lit(len(KINDS)).alias("kind_order"), F.lit("random").alias("kind"), c["stop"].alias("stop")))
    return frame.select("row", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def op1_secrets(spark, sf_dir: str) -> DataFrame:
    """All documents; false discoveries are bounded over all of them."""
    out = find_secrets(documents(spark, sf_dir), ["doc_id"])
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return out.select(
        F.col("row.doc_id").alias("doc_id"), *[count(k) for k in KINDS],
        F.sha2(spelled(F.col("base")), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans"),
    )


def _oracle() -> str:
    """The same in SQL; its engine knows neither look-around nor ASCII-only case folding, and
    needs no possessive repeats."""
    either = lambda word: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    head = "(" + "|".join(map(either, ("password", "passwd", "secret", "token", "api_?key"))) + ")[\"'']?\\x20*[:=]\\x20*[\"'']?"
    patterns = {"assign": head + "[A-Za-z0-9+/_.=-]+", "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+", "run": f"[{RUN_CLASS}]{{{MIN_RUN},}}"}
    matches = " union all ".join(f"select r, {i} o, '{k}' kind, regexp_extract_all(t, '{p}') m, string_split_regex(t, '{p}') g from d" for i, (k, p) in enumerate(patterns.items()))
    encoding = f"""case when regexp_full_match(v, '[0-9]+') then 'decimal'
        when regexp_full_match(v, '[0-9a-f]+|[0-9A-F]+') then 'hex' when regexp_full_match(v, '[a-z]+|[A-Z]+|[A-Z][a-z]+') then 'letters'
        when regexp_full_match(v, '[A-Z2-7]+') and regexp_matches(v, '[2-7]') then 'base32' when regexp_full_match(v, '[a-z0-9]+|[A-Z0-9]+') then 'base36' else 'base64' end"""
    of = lambda values: "case encoding " + " ".join(f"when '{k}' then {v}" for k, v in values.items()) + " end"
    alphabet, size, effect = (of({k: f(e) for k, e in ENCODINGS.items()}) for f in (lambda e: f"'{e[1]}'", lambda e: f"{len(e[1])}::double", lambda e: f"{e[2]}::double"))
    density = "exp(-x * x / 2) / 2.5066282746310002"
    near = f"{density} * u * (0.319381530 + u * (-0.356563782 + u * (1.781477937 + u * (-1.821255978 + u * 1.330274429))))"
    far = f"{density} * (1 / x) * (1 - 1 / (x * x + 2))"
    return rf"""
with d as (select row_number() over () r, doc_id, coalesce(text, '') t from documents),
m as ({matches}),
i as (select r, o, kind, m, g, unnest(range(1, len(m) + 1)) i from m),
e as (select r, o, kind, m[i] v, (list_sum(list_transform(g[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0))::bigint s from i
      where case kind when 'assign' then length(regexp_replace(m[i], '^{head}', '')) >= {MIN_VALUE} when 'access' then length(m[i]) >= 20 when 'hex' then length(m[i]) >= 24 else true end),
f as (select r, o, kind, v, s, s + length(v) e from e),
b as (select * from f where kind <> 'run'),
c as (select row_number() over () id, r, s, e, v, {encoding} encoding from f where kind = 'run' and not exists (select 1 from b where b.r = f.r and b.s < f.e and f.s < b.e)),
a as (select id, r, s, e, encoding, {size} k, {effect} w2, length(v)::double n,
      list_transform(string_split(case encoding when 'base64' then translate(v, '_-', '/+') else lower(v) end, ''), lambda x: (strpos({alphabet}, x) - 1)::double) y
      from c where encoding not in ({", ".join(f"'{u}'" for u in UNTESTED)})),
q as (select *, list_sum(list_transform(list_distinct(y), lambda x: pow(len(list_filter(y, lambda z: z = x)), 2)))::double squares,
      coalesce(list_sum(list_transform(range(2, len(y) + 1), lambda j: ((y[j] * 2 >= k) <> (y[j - 1] * 2 >= k))::int)), 0)::double changes, list_sum(y) / n mean from a),
h as (select *, coalesce(list_sum(list_transform(range(2, len(y) + 1), lambda j: (y[j] - mean) * (y[j - 1] - mean))) / nullif(list_sum(list_transform(y, lambda x: (x - mean) * (x - mean))), 0), 1.0) serial from q),
z as (select id, r, s, e, encoding || ' ' || floor(2 * log2(n))::bigint stratum,
      greatest(-3000, least(3000, floor(100 * (((k * squares / n - n - (k - 1) - n * w2) / sqrt(2 * (k - 1 + 2 * n * w2))
      + (abs(changes / (n - 1) - 0.5) - {RUNS_EFFECT}) * 2 * sqrt(n - 1) + (abs(serial) - {SERIAL_EFFECT}) * sqrt(n)) / sqrt(3.0)))))::int z from h),
n as (select stratum, z, count(*) n from z group by all),
u as (select stratum, z, sum(n) over (partition by stratum order by z) upto, sum(n) over (partition by stratum) total, abs((z + 1) / 100.0) x, 1 / (1 + 0.2316419 * abs((z + 1) / 100.0)) u from n),
p as (select *, case when x > 5 then {far} else {near} end tail from u),
l as (select stratum, max(z) z from p where (case when z + 1 > 0 then 1 - tail else tail end) * total <= {FALSE_SHARE} * upto group by stratum),
x as (select r, o, kind, s, e from b union all select z.r, {len(KINDS)}, 'random', s, e from z join l on z.stratum = l.stratum and z.z <= l.z),
k as (select r, string_agg(kind || ':' || s || ':' || e, ',' order by s, o) spelled, {", ".join(f"count(*) filter (kind = '{n}') n_{n}" for n in KINDS)} from b group by r),
w as (select r, string_agg(kind || ':' || s || ':' || e, ',' order by s, o) spelled from x group by r)
select doc_id, {", ".join(f"coalesce(n_{n}, 0)::bigint n_{n}" for n in KINDS)}, sha256(coalesce(k.spelled, '')) base_sha256, coalesce(w.spelled, '') spans
from d left join k on k.r = d.r left join w on w.r = d.r
"""


OP1_SQL = _oracle()
