"""Language-model scoring with Elias-Fano n-gram tries.

``score_whole`` keeps every word of the training texts and every pair and triple from
LEAST occurrences on, at any size of the corpus. Words go by a 64-bit hash, pairs and
triples by a 64-bit hash of their parts' (two of 10^8 share one with a chance of about 1
in 4,000; what shares one is counted as one). Texts are cut into blocks of BLOCK_CHARS,
and a block is one stored row: its own dictionary of hashes, and its texts as places in it.
Rows are stored in buckets by block, so the rounds below shuffle what is asked and answered only.

Blocks ask for whole counts, level by level. A block sends its different keys sorted, in
packed rows by range of hash; the task of a range adds up and answers each block in the
order it asked in, so answers carry no keys. Triples are asked for only where both of their
pairs are kept, which loses none that could be kept. One of the blocks that hold a kept
n-gram, the first, is told to report it to its context, and a last round adds up what kept
n-grams take from each context. A range is asked for RANGE keys on average: a frequent
n-gram comes once from each block, whatever its count. No task, broadcast or driver
holds the model of the corpus; the driver gets N, V and the number of tokens.

With absolute discounting D the probabilities interpolate:

    p(w)      = (c(w) + 1) / (N + V + 1)
    p(w | u)  = max(c(u w) - D, 0) / c(u) + a(u) p(w)
    p(w | t u) = max(c(t u w) - D, 0) / c(t u) + a(t u) p(w | u)

where a is the mass that kept n-grams leave. They sum to 1 over the V known
words and one unknown. Each block builds a trie of those of its n-grams that are kept,
with counts and masses of the whole corpus. The levels hold, for each word its kept
successors and for each kept pair those of its second word's successors that follow the
pair, numbered relative to that context. Pointers and ids are Elias-Fano sequences,
logarithms of probabilities and back-off weights are rounded to steps of 1 / GRID, so
that scores don't depend on the blocks. A token is looked up by successor search in its
context's range.

A text begins behind an end token and ends with one; only the latter is scored.

Defined cases: a null text is empty and has the one token; without training rows
N and V are 0 and every probability is 1; null ids count as the empty text for the
hold-out; long texts are read whole, and one over BLOCK_CHARS is a block of its own;
equal rows give equal results; an empty table gives an empty one. All columns asked for
are carried in ``row``.
"""

from __future__ import annotations

from hashlib import blake2b
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import documents, row_of, stored, text_slices, training_remainder
from basketry.llm.eliasfano import EliasFano, children, find_child, mapped, packed
from basketry.plans.lineage import scratch_folder

DISCOUNT = 0.75
END = b""
#: Occurrences that a pair or triple needs, at any size of the corpus.
LEAST = 2
#: Characters of a block of texts, but for a longer text.
BLOCK_CHARS = 8_000_000
#: Keys of all blocks that a range of hashes is asked for, on average.
RANGE = 4_000_000
#: Buckets that a Spark table may have by default.
MAX_BUCKETS = 100_000
#: Steps of a logarithm's unit.
GRID = 2048
#: Numbers of ranges carry the level above these bits: words, pairs, triples, and words and pairs as contexts.
LEVEL_BITS = 40
CONTEXTS = 4


def tokens(text: str) -> list[bytes]:
    """Words, with A-Z in lower case, then the end."""
    return [*text.encode("utf-8", "surrogatepass").lower().split(), END]


def on_grid(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the code book of all multiples of 1 / GRID that 16 bits hold, and the book."""
    return np.clip(np.rint(-values * GRID), 0, 65535).astype(np.uint16), np.arange(65536) / -GRID


def build_trie(counts: np.ndarray, total: int, kinds: int, pairs: tuple, triples: tuple, lefts: tuple) -> dict[str, np.ndarray]:
    """All arrays of the model. ``counts``: of the words, by id; ``pairs`` and ``triples``: sorted codes
    (``first * W + second`` and ``pair * W + third``) and counts; ``lefts``: the mass left behind each word and pair."""
    n_words = len(counts)
    unigram = (counts + 1) / (total + kinds + 1)
    code, n = pairs
    u, w = code // n_words, code % n_words
    own = np.maximum(n - DISCOUNT, 0)
    left, left3 = lefts
    second = own / counts[u] + left[u] * unigram[w] if len(u) else np.zeros(0)
    code3, n3 = triples
    pair, x = code3 // n_words, code3 % n_words
    own3 = np.maximum(n3 - DISCOUNT, 0)
    # the third word as the second of the pair (second, third), relative to where such pairs begin
    next_pair = np.searchsorted(code, w[pair] * n_words + x) if len(pair) else np.zeros(0, np.int64)
    begin = np.searchsorted(u, np.arange(n_words + 1))
    third = own3 / n[pair] + left3[pair] * second[next_pair] if len(pair) else np.zeros(0)
    pointers2, ids2 = children(n_words, u, w)
    pointers3, ids3 = children(max(len(code), 1), pair, next_pair - begin[w[pair]] if len(pair) else pair)
    out = {"unigram": np.log10(unigram)}
    for name, values in (("left1", left), ("prob2", second), ("left2", left3), ("prob3", third)):
        out[name], out[f"{name}_book"] = on_grid(np.log10(np.maximum(values, 1e-300)))
    for name, ef in (("pointers2", pointers2), ("ids2", ids2), ("pointers3", pointers3), ("ids3", ids3)):
        out |= {f"{name}.{f}": getattr(ef, f) for f in EliasFano.FIELDS}
    return out


class Trie:
    def __init__(self, arrays: dict[str, np.ndarray]):
        self.a = arrays
        self.ef = {k: EliasFano(*[arrays[f"{k}.{f}"] for f in EliasFano.FIELDS]) for k in ("pointers2", "ids2", "pointers3", "ids3")}

    def value(self, name: str, at: np.ndarray) -> np.ndarray:
        return self.a[f"{name}_book"][self.a[name][at]]

    def log_probabilities(self, s: np.ndarray, starts: np.ndarray, u: np.ndarray, w: np.ndarray, which: np.ndarray) -> np.ndarray:
        """log10 of each token's probability (of words without id, only the back-off weights before their
        unigram probability); 0 at the places where texts begin. ``u`` and ``w`` are the different pairs of
        neighbours, ``which`` of them ends at each place that doesn't begin a text."""
        out = np.zeros(len(s))
        known = s >= 0
        out[known] = self.a["unigram"][s[known]]
        pair, relative = np.full(len(s), -1), np.zeros(len(s), np.int64)
        at = np.ones(len(s), bool)
        at[starts] = False
        # each pair of words is looked up once
        both = (u >= 0) & (w >= 0)
        if both.any():
            found, begin = np.full(len(u), -1), np.zeros(len(u), np.int64)
            found[both], begin[both] = find_child(self.ef["pointers2"], self.ef["ids2"], u[both], w[both])
            pair[at], relative[at] = found[which], (found - begin)[which]
        # back off from the word before, or take the pair
        before = np.r_[-1, s[:-1]]
        before[starts] = -1
        back = (before >= 0) & (pair < 0)
        out[back] += self.value("left1", before[back])
        hit = pair >= 0
        out[hit] = self.value("prob2", pair[hit])
        context = np.r_[-1, pair[:-1]]
        context[starts] = -1
        triple = np.full(len(s), -1)
        at = np.flatnonzero(hit & (context >= 0))
        wide = len(self.a["unigram"])
        code, where = np.unique(context[at] * wide + relative[at], return_inverse=True)
        if len(code):
            found, _ = find_child(self.ef["pointers3"], self.ef["ids3"], code // wide, code % wide)
            triple[at] = found[where]
        back = (context >= 0) & (triple < 0)
        out[back] += self.value("left2", context[back])
        hit = triple >= 0
        out[hit] = self.value("prob3", triple[hit])
        out[starts] = 0
        return out


def packed_ints(x: np.ndarray) -> bytes:
    """Non-negative integers by planes of their bytes, which compress well where most are small."""
    x = np.ascontiguousarray(x, "<u8")
    width = (int(x.max()).bit_length() + 7) // 8 if len(x) else 0
    planes = x.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return len(x).to_bytes(8, "little") + bytes([width]) + pa.compress(planes, "zstd", asbytes=True)


def unpacked_ints(raw: bytes) -> np.ndarray:
    n, width = int.from_bytes(raw[:8], "little"), raw[8]
    out = np.zeros((n, 8), np.uint8)
    if n and width:
        out[:, :width] = np.frombuffer(pa.decompress(raw[9:], n * width, "zstd", asbytes=True), np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<u8")


def packed_keys(sorted_keys: np.ndarray) -> bytes:
    return packed_ints(np.diff(sorted_keys, prepend=np.uint64(0)))


def unpacked_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(unpacked_ints(raw), dtype=np.uint64)


def word_keys(words) -> np.ndarray:
    return np.array([int.from_bytes(blake2b(w, digest_size=8).digest(), "little") for w in words], np.uint64)


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hashes of two rows of hashes."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xBF58476D1CE4E5B9)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(32))


class Places(dict):
    """Words to their places in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def blocked(frame: DataFrame) -> DataFrame:
    """(block, rows, train, lengths, words, ids, n) of (row, train, text), stored: a row for each block of texts."""
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("rows", T.ArrayType(frame.schema["row"].dataType)),
        *[T.StructField(c, T.BinaryType()) for c in ("train", "lengths", "words", "ids")], T.StructField("n", T.LongType()),
    ])

    def run(batches):
        block = TaskContext.get().partitionId() << 32
        for batch, texts in text_slices(batches, "text", BLOCK_CHARS):
            if not texts:
                continue
            places, found, lengths = Places(), [], []
            for t in texts:
                own = tokens(t)
                lengths.append(len(own))
                found.append(np.fromiter(map(places.__getitem__, own), np.int64, len(own)))
            words, place = np.unique(word_keys(places), return_inverse=True)
            ids = place[np.concatenate(found)]
            rows, train = (batch.column(batch.schema.get_field_index(c)) for c in ("row", "train"))
            train = np.asarray(train.to_pylist(), np.uint64)
            packs = [packed_ints(train), packed_ints(np.array(lengths)), packed_keys(words), packed_ints(ids)]
            yield pa.RecordBatch.from_arrays([
                pa.array([block]), pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), rows),
                *[pa.array([x], pa.binary()) for x in packs], pa.array([len(ids)]),
            ], names=schema.names)
            block += 1

    # rows stay in buckets of the blocks' numbers, so that only answers are shuffled to them; the files are all that is needed
    spark, name = frame.sparkSession, f"basketry_blocks_{uuid4().hex}"
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_BUCKETS)
    files = frame.mapInArrow(run, schema).write.format("parquet").option("compression", "zstd").option("path", scratch_folder(spark))
    files.bucketBy(buckets, "block").saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"drop table {name}")
    return out


class Block:
    """A block's texts and n-grams. ``kinds[k]`` are the codes of its different words, pairs
    (``first * W + second``) and triples (``pair * W + third``), ``where`` which of them are at ``at``."""

    def __init__(self, texts: pa.RecordBatch | pa.Table):
        train, lengths, ids = (unpacked_ints(texts.column(c)[0].as_py()).astype(np.int64) for c in ("train", "lengths", "ids"))
        self.number = texts.column("block")[0].as_py()
        self.words = unpacked_keys(texts.column("words")[0].as_py())
        self.wide = len(self.words)
        self.lengths, self.starts = lengths, np.cumsum(lengths + 1) - lengths - 1
        self.end = int(np.searchsorted(self.words, word_keys([END])[0]))
        # each text behind an end token
        self.s = np.insert(ids, np.cumsum(lengths) - lengths, self.end)
        self.weight = np.repeat(train, lengths + 1)
        self.inside = np.ones(len(self.s), bool)
        self.inside[self.starts] = False
        self.at = np.flatnonzero(self.inside)
        self.kinds, self.keys, self.counts = {1: np.arange(self.wide)}, {1: self.words}, {1: self._sums(self.s[self.at], self.at, self.wide)}
        self.kinds[2], self.where2 = np.unique(self.s[self.at - 1] * self.wide + self.s[self.at], return_inverse=True)
        self.keys[2] = mixed(self.words[self.kinds[2] // self.wide], self.words[self.kinds[2] % self.wide])
        self.counts[2] = self._sums(self.where2, self.at, len(self.kinds[2]))

    def _sums(self, where: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(where, self.weight[at], n).astype(np.int64)

    def add_triples(self, kept: np.ndarray) -> None:
        """Triples both of whose pairs are ``kept``."""
        pair = np.full(len(self.s), -1)
        pair[self.at] = np.where(kept[self.where2], self.where2, -1)
        at = self.at[self.inside[self.at - 1]]
        at = at[(pair[at] >= 0) & (pair[at - 1] >= 0)]
        self.kinds[3], where = np.unique(pair[at - 1] * self.wide + self.s[at], return_inverse=True)
        self.keys[3] = mixed(self.keys[2][self.kinds[3] // self.wide], self.words[self.kinds[3] % self.wide])
        self.counts[3] = self._sums(where, at, len(self.kinds[3]))

    def contexts(self, level: int, n: dict[int, np.ndarray]) -> np.ndarray:
        """Which words or pairs have a kept one's mass to divide; nothing follows the end of a text."""
        return np.flatnonzero((n[level] > 0) & ((self.kinds[level] % self.wide != self.end) | (level == 1)))


ASKED = "block long, part long, keys binary, first binary, second binary"
ANSWERED = "block long, part long, first binary, second binary, total long, kinds long"


def asked(block: int, level: int, ranges: int, keys: np.ndarray, *values: np.ndarray) -> pa.RecordBatch:
    """The keys and one or two values of each, sorted and cut by ranges of hash."""
    order = np.argsort(keys)
    keys = keys[order]
    part = ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
    cuts = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(part)] if len(part) else np.zeros(1, np.int64)
    bounds = list(zip(cuts[:-1], cuts[1:]))
    pack = lambda f, x: pa.array([f(x[a:b]) for a, b in bounds], pa.binary())
    columns = [pack(packed_ints, v[order]) for v in values]
    columns += [pa.array([b""] * len(bounds), pa.binary())] * (2 - len(columns))
    return pa.RecordBatch.from_arrays([
        pa.array([block] * len(bounds), pa.int64()), pa.array([(level << LEVEL_BITS) + int(part[a]) for a, _ in bounds], pa.int64()),
        pack(packed_keys, keys), *columns,
    ], names=["block", "part", "keys", "first", "second"])


def answers(replies: pa.Table, level: int, keys: np.ndarray, column: str = "first") -> np.ndarray:
    """What was answered for ``keys``, in their order."""
    part = np.asarray(replies.column("part").combine_chunks())
    rows = np.flatnonzero(part >> LEVEL_BITS == level)
    rows = rows[np.argsort(part[rows])]
    values = [unpacked_ints(replies.column(column)[int(i)].as_py()) for i in rows]
    out = np.zeros(len(keys), np.int64)
    if values:
        # equal keys have equal counts, so their order doesn't matter
        out[np.argsort(keys)] = np.concatenate(values)
    return out


def counts_of(replies: pa.Table, block: Block, level: int) -> tuple[np.ndarray, np.ndarray]:
    """How often each n-gram of the block occurs in all training texts, 0 if it isn't kept, and whether this block reports it."""
    v = answers(replies, level, block.keys[level])
    return v >> 1, (v & 1).astype(bool)


def summed(requests: pa.Table) -> pa.Table:
    """A range's answers: for n-grams twice the whole count (0 if not kept), and one more for the
    first block that has it; for contexts the sums of both values."""
    # the same rows give the same answers, however often a task is run
    requests = requests.sort_by("block")
    part = requests.column("part")[0].as_py()
    level = part >> LEVEL_BITS
    held = [unpacked_keys(x.as_py()) for x in requests.column("keys")]
    ends = np.cumsum([len(x) for x in held])[:-1]
    found, first, where = np.unique(np.concatenate(held), return_index=True, return_inverse=True)
    del held

    def total(column):
        values = np.concatenate([unpacked_ints(x.as_py()) for x in requests.column(column)])
        return np.bincount(where, values, len(found)).astype(np.int64)

    pack = lambda x: pa.array([packed_ints(v) for v in np.split(x, ends)], pa.binary())
    n = total("first")
    zero = [0] * (len(ends) + 1)
    totals, kinds = list(zero), list(zero)
    if level > CONTEXTS:
        columns = [pack(n[where]), pack(total("second")[where])]
    else:
        kept = n >= (1 if level == 1 else LEAST)
        out = np.where(kept, 2 * n, 0)[where]
        out[first[kept]] += 1
        totals[0], kinds[0] = int(n.sum()), int(kept.sum())
        columns = [pack(out), pa.array([b""] * len(zero), pa.binary())]
    return pa.Table.from_arrays([requests.column("block"), requests.column("part"), *columns, pa.array(totals), pa.array(kinds)],
                                names=["block", "part", "first", "second", "total", "kinds"])


def answered(requests: DataFrame) -> DataFrame:
    return stored(requests.groupBy("part").applyInArrow(summed, ANSWERED))


def taken(replies: pa.Table, level: int, block: Block, n: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The mass left behind each word or pair of the block; 1 where none was asked for."""
    sums, kinds = (answers(replies, level + CONTEXTS, block.keys[level][at], c) for c in ("first", "second"))
    left = np.ones(len(n))
    left[at] -= (sums - DISCOUNT * kinds) / n[at]
    return left


def block_trie(block: Block, replies: pa.Table, total: int, kinds: int) -> tuple[np.ndarray, Trie]:
    """Ids of the block's words among the known ones (-1 for others), and the trie."""
    n = {}
    for level in (1, 2):
        n[level], _ = counts_of(replies, block, level)
    block.add_triples(n[2] > 0)
    n[3], _ = counts_of(replies, block, 3)
    left = {level: taken(replies, level, block, n[level], block.contexts(level, n)) for level in (1, 2)}
    known, two, three = (n[k] > 0 for k in (1, 2, 3))
    word, pair = np.cumsum(known) - 1, np.cumsum(two) - 1
    wide = int(known.sum())
    code2, code3 = block.kinds[2][two], block.kinds[3][three]
    # codes keep their order, as ids do
    pairs = word[code2 // block.wide] * wide + word[code2 % block.wide]
    triples = pair[code3 // block.wide] * wide + word[code3 % block.wide]
    arrays = build_trie(n[1][known], total, kinds, (pairs, n[2][two]), (triples, n[3][three]), (left[1][known], left[2][two]))
    return np.where(known, word, -1), Trie(mapped(*packed(arrays)))


def score_whole(docs: DataFrame, train: Column, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` in a struct ``row``; n_tokens, n_known, train_tokens, base_score and score of
    every row of ``docs`` under the model of the rows where ``train`` holds."""
    frame = docs.select(row_of(docs, keep), F.coalesce(train, F.lit(False)).alias("train"), F.col(text_col).alias("text"))
    whole = blocked(frame)
    texts = whole.drop("rows", "n")
    ranges = max(1, -(-(whole.agg(F.sum("n")).first()[0] or 0) // RANGE))

    def ask_two(batches):
        for batch in batches:
            for i in range(len(batch)):
                block = Block(batch.slice(i, 1))
                for level in (1, 2):
                    yield asked(block.number, level, ranges, block.keys[level], block.counts[level])

    def ask_triples(texts: pa.Table, replies: pa.Table) -> pa.Table:
        block = Block(texts)
        block.add_triples(counts_of(replies, block, 2)[0] > 0)
        return pa.Table.from_batches([asked(block.number, 3, ranges, block.keys[3], block.counts[3])])

    def ask_contexts(texts: pa.Table, replies: pa.Table) -> pa.Table:
        block, n, own = Block(texts), {}, {}
        for level in (1, 2, 3):
            if level == 3:
                block.add_triples(n[2] > 0)
            n[level], own[level] = counts_of(replies, block, level)
        out = []
        for level in (1, 2):
            context, at = block.kinds[level + 1][own[level + 1]] // block.wide, block.contexts(level, n)
            sums, kinds = (np.bincount(context, x, len(n[level])).astype(np.int64)[at] for x in (n[level + 1][own[level + 1]], None))
            out.append(asked(block.number, level + CONTEXTS, ranges, block.keys[level][at], sums, kinds))
        return pa.Table.from_batches(out)

    def score(texts: pa.Table, replies: pa.Table) -> pa.Table:
        block = Block(texts)
        ids, trie = block_trie(block, replies, total, kinds)
        s = ids[block.s]
        has = s >= 0
        base = np.where(has, trie.a["unigram"][s] if len(trie.a["unigram"]) else 0.0, unknown)
        log = trie.log_probabilities(s, block.starts, ids[block.kinds[2] // block.wide], ids[block.kinds[2] % block.wide], block.where2) + np.where(has, 0.0, unknown)
        had = has.astype(np.int64)
        for x in (base, log, had):
            x[block.starts] = 0
        sums = [np.add.reduceat(x, block.starts) for x in (had, base, log)]
        rows = texts.column("rows").combine_chunks().flatten()
        return pa.Table.from_arrays([rows, pa.array(block.lengths), *map(pa.array, sums)], names=schema.names)

    with_replies = lambda blocks, replies: blocks.groupBy("block").cogroup(replies.select("block", "part", "first", "second").groupBy("block"))
    replies = answered(texts.mapInArrow(ask_two, ASKED))
    total, kinds = replies.where(F.shiftright("part", LEVEL_BITS) == 1).agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    unknown = -np.log10(total + kinds + 1)
    replies = replies.unionByName(answered(with_replies(texts, replies.where(F.shiftright("part", LEVEL_BITS) == 2)).applyInArrow(ask_triples, ASKED)))
    replies = replies.unionByName(answered(with_replies(texts, replies).applyInArrow(ask_contexts, ASKED)))
    schema = T.StructType([
        frame.schema["row"], T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
    ])
    out = with_replies(whole.drop("n"), replies).applyInArrow(score, schema)
    return out.select("row", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


#: Rows whose id has this remainder are held out.
HELD_OUT = (7, 2)


def op5_lm_score(spark, sf_dir: str) -> DataFrame:
    """All documents, by models of those whose id isn't held out."""
    held = training_remainder(F.col("doc_id"), HELD_OUT[0]) == HELD_OUT[1]
    docs = documents(spark, sf_dir).withColumn("held_out", held)
    out = score_whole(docs, ~F.col("held_out"), ["doc_id", "held_out"])
    return out.select("row.doc_id", "row.held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
