"""Language ID by interpolated Kneser-Ney character language models.

Each language has a model of order ORDER over lower-case letters, with every run
of other characters as one space. Highest-order counts are raw, lower orders count
distinct left neighbours; each order is discounted by ``n1 / (n1 + 2 n2)`` and
interpolated with the next. All languages share one sorted array of 64-bit n-gram
hashes for each order, with a row of log probabilities (a column for each
language) already interpolated, and one of contexts with their back-off weights.
A character costs a binary search in the highest order; only n-grams that no
language has seen go down an order.

The language of lowest cross-entropy for each character wins. Its score is the
posterior share of the winner if MAX_EVIDENCE characters at most count as
evidence. A calibration part of the sample, on which no n-gram is counted, gives
each language the middle and spread of the cross-entropy of its own texts, and the
least middle of other languages' texts. A text is rejected as none of the
languages if its lowest cross-entropy lies both REJECT_SPREADS spreads and
REJECT_WAY of the way to the foreign texts above the own ones; for texts under
MAX_EVIDENCE characters the distance grows as chance does.

The models are fitted on a bounded sample: of each language the different rows with
the smallest hashes of id and text, SAMPLE_DOCS texts and SAMPLE_CHARS characters at
most, whole texts only; one that doesn't fit any more is passed over. A language that
has only longer texts learns from the beginning of one. What is sent to the tasks is
bounded by the number of languages times that.

Defined cases: a null text or one without letters is ``und`` with score 0 and
rejected; null languages teach nothing; without any labelled text all are
``und``; texts of any length are read whole, in pieces; equal rows get equal
results; an empty table gives an empty one. Other columns pass through untouched
in ``row``. Equal cross-entropies go to the language first in order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import documents, row_of, stored, text_slices, training_remainder

ORDER = 4
SAMPLE_DOCS = 1500
SAMPLE_CHARS = 1_500_000
CANDIDATES = 3
#: One text of the sample in so many is for calibration.
CALIBRATE = 8
MAX_EVIDENCE = 100
REJECT_SPREADS = 6.0
REJECT_WAY = 0.8
#: Characters of an alphabet that a model may meet; its inverse is the lowest order's probability.
ALPHABET = 1000
#: Characters scored at once.
PIECE = 1_000_000
UNDETERMINED = "und"

_STEP = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier of the rolling hash


def letter_table() -> np.ndarray:
    """For each code point its lower case if that is one letter, itself if it has none, and 0 for no letter."""
    out = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


def symbols(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of letters and 0 for what lies between, ORDER - 1 zeros
    before each text and one behind; and where each text begins (its first zero)."""
    parts, pad = [], np.zeros(ORDER - 1, np.uint32)
    for t in texts:
        x = table[np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)]
        keep = (x != 0) | np.r_[False, x[:-1] != 0]
        x = x[keep]
        parts += [pad, x[:-1] if len(x) and not x[-1] else x, pad[:1]]
    lengths = np.array([len(p) for p in parts], np.int64).reshape(-1, 3).sum(1) if parts else np.zeros(0, np.int64)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32), np.cumsum(lengths) - lengths


def hashes(x: np.ndarray) -> list[np.ndarray]:
    """For each order 1.. the hash of the n-gram that ends at each place; places before the first whole one are meaningless."""
    one = x.astype(np.uint64) + np.uint64(1)
    out = [one]
    for _ in range(ORDER - 1):
        out.append(np.r_[np.uint64(0), out[-1][:-1]] * _STEP + one)
    return out


def find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a sorted array, and whether they hold what is wanted."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def train(texts: dict[str, list[str]], table: np.ndarray) -> dict:
    """Models of all languages: ``grams`` and ``contexts``, for each order sorted hashes and rows of logarithms."""
    langs = sorted(texts)
    seen = []  # of each language, for each order: hash, hash without last, without first, count
    for lang in langs:
        x, starts = symbols(texts[lang], table)
        scored = np.ones(len(x), bool)
        for k in range(ORDER - 1):
            scored[starts + k] = False
        h = hashes(x)
        tables = []
        for n in range(1, ORDER + 1):
            inner = h[n - 2] if n > 1 else np.zeros(len(x), np.uint64)
            keys, first, count = np.unique(h[n - 1][scored], return_index=True, return_counts=True)
            where = np.flatnonzero(scored)[first]
            tables.append([keys, inner[np.maximum(where - 1, 0)] if n > 1 else np.zeros(len(keys), np.uint64), inner[where], count])
        for n in range(1, ORDER):  # lower orders count the distinct n-grams that end in theirs
            longer = tables[n]
            keys, count = np.unique(longer[2], return_counts=True)
            at, _ = find(keys, tables[n - 1][0])
            tables[n - 1][3] = np.where(keys[at] == tables[n - 1][0], count[at], 1)
        seen.append(tables)
    model = {"langs": langs, "grams": [], "contexts": [], "floor": np.full(len(langs), -np.log(ALPHABET), np.float32)}
    for n in range(1, ORDER + 1):
        keys = np.unique(np.concatenate([t[n - 1][0] for t in seen])) if seen else np.zeros(0, np.uint64)
        contexts = np.unique(np.concatenate([t[n - 1][1] for t in seen])) if seen else np.zeros(0, np.uint64)
        before = np.zeros(len(keys), np.uint64)
        shorter = np.zeros(len(keys), np.uint64)
        kept = np.zeros((len(keys), len(langs)))
        weight = np.ones((len(contexts), len(langs)))
        for j, tables in enumerate(seen):
            own, ctx, tail, count = tables[n - 1]
            at = np.searchsorted(keys, own)
            before[at], shorter[at] = ctx, tail
            n1, n2 = (count == 1).sum(), (count == 2).sum()
            discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            where = np.searchsorted(contexts, ctx)
            total = np.bincount(where, count, len(contexts))
            kinds = np.bincount(where, minlength=len(contexts))
            with np.errstate(invalid="ignore", divide="ignore"):
                weight[:, j] = np.where(total > 0, discount * kinds / total, 1.0)
                kept[at, j] = (count - discount) / total[where]
        if n == 1:
            lower = np.exp(np.tile(model["floor"].astype(float), (len(keys), 1)))
        else:
            at, _ = find(model["grams"][-1][0], shorter)
            lower = np.exp(model["grams"][-1][1][at].astype(float))
        rows = kept + weight[np.searchsorted(contexts, before)] * lower
        model["grams"].append((keys, np.log(rows).astype(np.float32)))
        model["contexts"].append((contexts, np.log(weight).astype(np.float32)))
    return model


def log_probabilities(model: dict, h: list[np.ndarray], at: np.ndarray) -> np.ndarray:
    """A row of log probabilities for each place ``at``, of the highest order that any language has seen."""
    out = np.zeros((len(at), len(model["langs"])), np.float32)
    left = np.arange(len(at))
    for n in range(ORDER, 0, -1):
        keys, rows = model["grams"][n - 1]
        where, hit = find(keys, h[n - 1][at[left]])
        out[left[hit]] += rows[where[hit]]
        left = left[~hit]
        if not len(left):
            return out
        contexts, weights = model["contexts"][n - 1]
        before = h[n - 2][at[left] - 1] if n > 1 else np.zeros(len(left), np.uint64)
        where, hit = find(contexts, before)
        out[left[hit]] += weights[where[hit]]
    out[left] += model["floor"]
    return out


def cross_entropies(model: dict, texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters of each text, and nats for each character under each language's model."""
    x, starts = symbols(texts, table)
    counts = np.diff(np.r_[starts, len(x)]) - ORDER  # without padding; a text without letters has none
    sums = np.zeros((len(texts), len(model["langs"])))
    text = np.repeat(np.arange(len(texts)), counts + ORDER)
    for begin in range(0, len(x), PIECE):
        low = max(0, begin - ORDER)
        h = hashes(x[low:begin + PIECE])
        place = np.arange(begin, min(len(x), begin + PIECE))
        owner = text[place]
        scored = (place - starts[owner] >= ORDER - 1) & (counts[owner] > 0)
        place, owner = place[scored], owner[scored]
        if len(place):
            rows = log_probabilities(model, h, place - low)
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sums[owner[first]] += np.add.reduceat(rows, first, axis=0, dtype=np.float64)
    return counts, -sums / (counts + 1)[:, None]


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> dict:
    """Models and calibration from the labelled rows of ``docs``, on its bounded sample."""
    labelled = docs.select(
        F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col), F.col(text_col), F.lit("sample")).alias("order"), F.col(text_col).alias("text"),
    ).where("lang is not null and text is not null")
    # repeated rows count once
    sized = stored(labelled.groupBy("lang", "order").agg(F.min(F.length("text")).alias("size")))
    fits = F.col("size") <= SAMPLE_CHARS
    langs = {r.lang: r for r in sized.groupBy("lang").agg(F.count_if(fits).alias("n"), F.min("order").alias("first")).collect()}
    chosen = [(lang, r["first"]) for lang, r in langs.items() if not r.n]
    # of a language's rows only about CANDIDATES times the wanted ones, by hash, come together to be put in order
    cuts = [x for lang, r in sorted(langs.items()) if r.n for x in (lang, min(2**63 - 1, 2**64 * CANDIDATES * SAMPLE_DOCS // r.n - 2**63))]
    taken: dict[str, int] = {}
    room: dict[str, int] = {}
    if cuts:
        near = sized.where(fits & (F.col("order") <= F.try_element_at(F.create_map(*map(F.lit, cuts)), F.col("lang"))))
        for lang, order, size in sorted(near.select("lang", "order", "size").collect()):
            if taken.get(lang, 0) < SAMPLE_DOCS and size <= room.get(lang, SAMPLE_CHARS):
                taken[lang] = taken.get(lang, 0) + 1
                room[lang] = room.get(lang, SAMPLE_CHARS) - size
                chosen.append((lang, order))
    wanted = F.broadcast(docs.sparkSession.createDataFrame(chosen, "lang string, order long"))
    sample = labelled.join(wanted, ["lang", "order"]).groupBy("lang", "order").agg(F.min(F.substring("text", 1, SAMPLE_CHARS)).alias("text"))
    table = letter_table()
    fitting: dict[str, list[str]] = {}
    held: dict[str, list[str]] = {}
    for i, r in enumerate(sample.orderBy("lang", "order").toLocalIterator()):
        (held if i % CALIBRATE == CALIBRATE - 1 else fitting).setdefault(r.lang, []).append(r.text)
    for lang in held:
        fitting.setdefault(lang, held[lang])
    model = train(fitting, table)
    model["letters"] = table
    found = {lang: cross_entropies(model, held.get(lang, []) or fitting[lang], table) for lang in model["langs"]}
    middle = {lang: np.median(h[n > 0], 0) if (n > 0).any() else np.full(len(model["langs"]), np.log(ALPHABET)) for lang, (n, h) in found.items()}
    model["own"] = np.zeros((len(model["langs"]), 2))  # middle, and what a text may lie above
    for j, lang in enumerate(model["langs"]):
        n, h = found[lang]
        # robust, because a few texts may bear a wrong label
        away = np.abs(h[:, j] - middle[lang][j]) * np.sqrt(np.clip(n, 1, MAX_EVIDENCE) / MAX_EVIDENCE)
        spread = 1.4826 * float(np.median(away[n > 0])) if (n > 0).any() else 1.0
        foreign = min([middle[k][j] for k in model["langs"] if k != lang], default=np.log(ALPHABET))
        model["own"][j] = middle[lang][j], max(REJECT_SPREADS * spread, REJECT_WAY * (foreign - middle[lang][j]))
    return model


def predict(model: dict, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and whether rejected, for each text."""
    langs = model["langs"]
    if not langs or not texts:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
    n, h = cross_entropies(model, texts, model["letters"])
    best = h.argmin(1)
    lowest = h[np.arange(len(texts)), best]
    evidence = np.minimum(n, MAX_EVIDENCE)[:, None]
    score = 1 / np.exp(-(h - lowest[:, None]) * evidence).sum(1)
    room = model["own"][best, 1] * np.sqrt(MAX_EVIDENCE / np.clip(n, 1, MAX_EVIDENCE))
    rejected = (n == 0) | (lowest > model["own"][best, 0] + room)
    names = [langs[b] if k else UNDETERMINED for b, k in zip(best.tolist(), (n > 0).tolist())]
    return names, np.where(n > 0, score, 0.0), rejected


def identify(docs: DataFrame, model: dict, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) in a struct ``row``, and lang_pred, score and rejected."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    frame = docs.select(row_of(docs, keep), F.col(text_col).alias("text"))
    schema = T.StructType([frame.schema["row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    def run(batches):
        for batch, texts in text_slices(batches, "text", 1_000_000):
            names, score, rejected = predict(sent.value, texts)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("row")), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())], names=schema.names)

    return frame.mapInArrow(run, schema)


#: Rows whose id has this remainder are held out.
HELD_OUT = (4, 2)


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    """All documents, by models of those whose id isn't held out."""
    docs = documents(spark, sf_dir)
    held = training_remainder(F.col("doc_id"), HELD_OUT[0]) == HELD_OUT[1]
    model = fit(docs.where(~held))
    out = identify(docs.withColumn("held_out", held), model, keep=["doc_id", "held_out"])
    return out.select("row.doc_id", "row.held_out", "lang_pred", "score", "rejected")
