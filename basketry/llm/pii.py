"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Base kinds (email, ip, card, phone) are reported wherever their pattern and test
hold. Further kinds are weaker by themselves: short card numbers and account
numbers in groups (which need a checksum: Luhn, or mod-97 for IBANs) and local
phone or social security numbers (which have none). They start with a score of
their kind, get CONTEXT_GAIN if a word of their kind stands within CONTEXT_CHARS
before or behind them, lose CONTEXT_LOSS if a word does that names another sort of
number, and are reported from ACCEPT on. Base spans also carry a score for use in
ranking, but are always reported.

Only DataFrame functions run, over each row by itself: nothing is shuffled. An
added span that overlaps a base span is left out, and of overlapping added spans
of one kind the pattern finds the leftmost.

Defined cases: a null text counts as empty and has no spans; digits of other
scripts aren't digits; a text of any length is searched whole; equal rows give
equal results; an empty table gives an empty one. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import documents, row_of
from basketry.llm.native_spans import add_matches, run_start, spelled

# Fixed patterns of the contract, with possessive groups (see native_spans).
_LOCAL = "A-Za-z0-9._%+-"
BASE = {
    "email": run_start(_LOCAL) + f"[{_LOCAL}]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": run_start("0-9") + "[0-9]++(?:\\.[0-9]++){3}+",
    "card": "[0-9](?:[\\x20-]?[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
}
# Further kinds: pattern, score in hundredths, words that support them, characters that mustn't stand beside them.
MORE = {
    "iban": ("[A-Z]{2}[0-9]{2}(?:[A-Z0-9]++|(?:\\x20[A-Z0-9]{4})++(?:\\x20[A-Z0-9]{1,3})?)", 60, "iban|account|konto|bank|compte|cuenta|sepa", "A-Za-z0-9"),
    "short_card": (BASE["card"], 30, "card|visa|credit|debit|amex|karte|carte|tarjeta", "0-9.,-"),
    "local_phone": ("\\(?0[0-9](?:[\\x20()/.-]?[0-9])++", 20, "phone|tel|call|mobile|fax|telefon|anruf|appel|llama|handy", "A-Za-z0-9+"),
    "ssn": (run_start("0-9") + "[0-9]++-[0-9]++-[0-9]++", 30, "ssn|social|security|taxpayer", "0-9-"),
}
BASE_SCORE = {"email": 90, "ip": 60, "card": 70, "phone": 60}
BASE_CONTEXT = {"email": "mail|contact|kontakt|correo|courriel", "ip": "ip|address|host|server|adresse", "card": MORE["short_card"][2], "phone": MORE["local_phone"][2]}
OTHER_NUMBERS = "order|invoice|isbn|version|serial|sku|part|ticket|article|bestell|rechnung|commande|pedido"
CONTEXT_CHARS = 40
CONTEXT_GAIN = 30
CONTEXT_LOSS = 30
ACCEPT = 50


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes Luhn's test."""
    def add(a, i):
        x = F.ascii(F.substring(number, -i, F.lit(1))) - 48
        twice = F.when(x >= 5, 2 * x - 9).otherwise(2 * x)
        return a + F.when(i % 2 == 0, twice).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), add) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an IBAN passes: first four characters moved last, A..Z read as 10..35, remainder 1 of 97."""
    plain = F.replace(iban, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))

    def add(a, i):
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code >= 65, (a * 100 + code - 55) % 97).otherwise((a * 10 + code - 48) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add) == 1


def small_parts(address: Column) -> Column:
    """Whether the four numbers are at most 255, leading zeros aside."""
    return F.forall(F.split(address, "\\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.substring(F.ltrim(p, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255))


def _valid(kind: str, value: Column) -> Column:
    n = F.length(digits(value))
    plain = F.length(F.replace(value, F.lit(" "), F.lit("")))
    checked = lambda low, high, size, test: F.when(size.between(low, high), test).otherwise(False)
    return {
        "ip": lambda: small_parts(value),
        "card": lambda: checked(16, 19, n, luhn(digits(value))),
        "phone": lambda: n.between(8, 15),
        "iban": lambda: checked(15, 34, plain, mod97(value)),
        "short_card": lambda: checked(12, 15, n, luhn(digits(value))),
        "local_phone": lambda: n.between(8, 13),
        "ssn": lambda: value.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
    }.get(kind, lambda: F.lit(True))()


def find_pii(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` in a struct ``row``, and base and spans: array<struct<kind_order, start, kind, stop, score>>
    sorted by kind, then start; scores are in hundredths."""
    patterns = {**BASE, **{k: m[0] for k, m in MORE.items() if m[0] not in BASE.values()}}
    order = {k: i for i, k in enumerate([*BASE, *MORE])}
    frame = docs.select(row_of(docs, keep), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    frame = add_matches(frame, "text", patterns)

    def found(kind: str) -> Column:
        return F.col(kind if kind in patterns else next(k for k, p in BASE.items() if p == MORE[kind][0]))

    def beside(s: Column, kind: str) -> Column:
        """Whether a character stands beside the span that shows it to be part of something else."""
        if kind in BASE:
            return F.lit(False)
        last = F.when(s["start"] > 0, F.substring(F.col("text"), s["start"], F.lit(1))).otherwise("")
        return F.concat(last, F.substring(F.col("text"), s["stop"] + 1, F.lit(1))).rlike(f"[{MORE[kind][3]}]")

    def scored(kind: str) -> Column:
        start, words = (MORE[kind][1:3] if kind in MORE else (BASE_SCORE[kind], BASE_CONTEXT[kind]))

        def one(s):
            before = F.substring(F.col("text"), F.greatest(s["start"] + 1 - CONTEXT_CHARS, F.lit(1)), F.least(s["start"], F.lit(CONTEXT_CHARS)))
            around = F.concat(before, F.lit(" "), F.substring(F.col("text"), s["stop"] + 1, F.lit(CONTEXT_CHARS)))
            gain = F.when(around.rlike(f"(?i)(^|[^A-Za-z])({words})"), CONTEXT_GAIN).otherwise(0)
            loss = F.when(around.rlike(f"(?i)(^|[^A-Za-z])({OTHER_NUMBERS})"), CONTEXT_LOSS).otherwise(0)
            return F.struct(
                F.lit(order[kind]).alias("kind_order"), s["start"].alias("start"), F.lit(kind).alias("kind"),
                s["stop"].alias("stop"), (F.lit(start) + gain - loss).alias("score"),
            )

        return F.transform(F.filter(found(kind), lambda s: _valid(kind, s["value"]) & ~beside(s, kind)), one)

    frame = frame.select(
        "row", F.array_sort(F.concat(*[scored(k) for k in BASE])).alias("base"),
        F.concat(*[scored(k) for k in MORE]).alias("more"),
    )
    added = F.filter("more", lambda m: (m["score"] >= ACCEPT) & ~F.exists("base", lambda b: (b["start"] < m["stop"]) & (m["start"] < b["stop"])))
    return frame.select("row", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def op3_pii(spark, sf_dir: str) -> DataFrame:
    """All documents."""
    out = find_pii(documents(spark, sf_dir), ["doc_id"])
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return out.select(
        F.col("row.doc_id").alias("doc_id"), *[count(k) for k in BASE],
        F.sha2(spelled(F.col("base")), 256).alias("base_sha256"), spelled(F.col("spans")).alias("spans"),
    )


def _oracle() -> str:
    """The same in SQL. Its engine matches in linear time and has no possessive
    repeats or look-around, and needs none: the patterns are those of the contract."""
    # Fixed patterns of the contract, as it spells them, and the added ones.
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": r"[A-Z]{2}[0-9]{2}([A-Z0-9]+|(\x20[A-Z0-9]{4})+(\x20[A-Z0-9]{1,3})?)", "short_card": r"[0-9]([\x20-]?[0-9])+",
        "local_phone": r"\(?0[0-9]([\x20()/.-]?[0-9])+", "ssn": "[0-9]+-[0-9]+-[0-9]+",
    }
    matches = " union all ".join(f"select r, {i} o, '{k}' kind, regexp_extract_all(t, '{p}') m, string_split_regex(t, '{p}') g from d" for i, (k, p) in enumerate(patterns.items()))
    case = lambda values: "case kind " + " ".join(f"when '{k}' then {v}" for k, v in values.items()) + " end"
    luhn = "list_sum(list_transform(range(1, n + 1), lambda i: case when i % 2 = 1 then d[n - i + 1]::int when d[n - i + 1]::int >= 5 then 2 * d[n - i + 1]::int - 9 else 2 * d[n - i + 1]::int end)) % 10 = 0"
    mod97 = "list_reduce(list_transform(string_split(x[5:] || x[:4], ''), lambda c: unicode(c)::bigint), lambda a, c: case when c >= 65 then (a * 100 + c - 55) % 97 else (a * 10 + c - 48) % 97 end, 0::bigint) = 1"
    valid = case({
        "email": "true", "ip": "len(list_filter(string_split(v, '.'), lambda p: not (length(ltrim(p, '0')) <= 3 and coalesce(try_cast(left(ltrim(p, '0'), 3) as int), 0) <= 255))) = 0",
        "card": f"case when n between 16 and 19 then {luhn} else false end", "phone": "n between 8 and 15",
        "iban": f"case when length(x) between 15 and 34 then {mod97} else false end", "short_card": f"case when n between 12 and 15 then {luhn} else false end",
        "local_phone": "n between 8 and 13", "ssn": "regexp_full_match(v, '[0-9]{3}-[0-9]{2}-[0-9]{4}')",
    })
    beside = case({**{k: "false" for k in BASE}, **{k: f"regexp_matches(b, '[{m[3]}]')" for k, m in MORE.items()}})
    words = case({**{k: f"regexp_matches(c, '(?i)(^|[^A-Za-z])({w})')" for k, w in BASE_CONTEXT.items()}, **{k: f"regexp_matches(c, '(?i)(^|[^A-Za-z])({m[2]})')" for k, m in MORE.items()}})
    counts = ", ".join(f"coalesce(n_{k}, 0)::bigint n_{k}" for k in BASE)
    return rf"""
with d as (select row_number() over () r, doc_id, coalesce(text, '') t from documents),
m as ({matches}),
i as (select r, o, kind, m, g, unnest(range(1, len(m) + 1)) i from m),
s as (select r, o, kind, m[i] v, (list_sum(list_transform(g[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[:i - 1], lambda x: length(x))), 0))::bigint s from i),
e as (select s.r, o, kind, v, s, s + length(v) e, regexp_replace(v, '[^0-9]+', '', 'g') d, replace(v, ' ', '') x, t from s join d on s.r = d.r),
f as (select *, length(d) n, case when s > 0 then substr(t, s, 1) else '' end || substr(t, e + 1, 1) b,
      substr(t, greatest(s + 1 - {CONTEXT_CHARS}, 1), least(s, {CONTEXT_CHARS})) || ' ' || substr(t, e + 1, {CONTEXT_CHARS}) c from e),
v as (select r, o, kind, s, e, {case({**BASE_SCORE, **{k: m[1] for k, m in MORE.items()}})} + case when {words} then {CONTEXT_GAIN} else 0 end
      - case when regexp_matches(c, '(?i)(^|[^A-Za-z])({OTHER_NUMBERS})') then {CONTEXT_LOSS} else 0 end score from f where {valid} and not {beside}),
b as (select * from v where o < {len(BASE)}),
a as (select * from v where o >= {len(BASE)} and score >= {ACCEPT} and not exists (select 1 from b where b.r = v.r and b.s < v.e and v.s < b.e)),
x as (select r, string_agg(kind || ':' || s || ':' || e, ',' order by o, s) spelled, {", ".join(f"count(*) filter (kind = '{k}') n_{k}" for k in BASE)} from b group by r),
y as (select r, string_agg(kind || ':' || s || ':' || e, ',' order by o, s) spelled from (select * from b union all select * from a) group by r)
select doc_id, {counts}, sha256(coalesce(x.spelled, '')) base_sha256, coalesce(y.spelled, '') spans
from d left join x on x.r = d.r left join y on y.r = d.r
"""


OP3_SQL = _oracle()
