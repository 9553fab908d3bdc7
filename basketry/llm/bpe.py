"""BPE encoding and decoding by batched numpy merge rounds.

Words are encoded, not texts: a slice of texts is split into words, and the
words not met before in the task go through the merge rounds together. All
their symbols lie in one flat array. A round forms the key of each pair of
neighbours within a word, finds its rank by binary search in the sorted pair
keys, and merges, in every word, all pairs of the word's lowest rank from left to
right. Words without a known pair leave the array. Long words (over LONG_WORD
symbols) would need many rounds of their own and go through a heap instead.

The model is a ``tokenizers`` JSON file with NFC, lower case and white space
normalisation, a splitting pattern, byte-level symbols and an end-of-word
suffix. The file is read on the driver; its pair table (about 50,000 entries,
fixed by the file) is what is sent to the tasks.

Defined cases: null and empty texts have no ids and decode to the empty text;
special tokens found in a text get their ids, as the library does; texts of any
length are cut at word bounds only for working, never in the result. Other
columns pass through untouched; columns of the new names, in whatever case, are
replaced. Repeated rows give repeated results; an empty table gives
an empty one. Unicode tables are pinned to those of the library: texts with a code
point that Python's tables (classes of ``regex``, lower case and NFC of Python)
know otherwise take a path of their own.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import documents, quoted, text_slices

#: Symbols from which on a word is merged by the heap.
LONG_WORD = 400
#: Words that a task remembers before it starts anew.
CACHE_WORDS = 400_000


# Where the library's Unicode tables differ from Python's and the ``regex`` module's.
#: Letters to the ``regex`` module (Unicode 17 and later), unassigned to the library.
NO_LETTERS = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DF1, 0x11DF1), (0x16EA0, 0x16EB8),
    (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF3), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF),
    (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4),
    (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479),
    (0x3D000, 0x3FC3F),
]
#: The same of numbers.
NO_NUMBERS = [(0x11DE0, 0x11DE9), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16FF4, 0x16FF6)]
#: Lower case that the library knows and Python doesn't: first and last capital, first small letter.
LOWER = [
    (0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF),
    (0xA7D2, 0xA7D2, 0xA7D3), (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x19B),
    (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB),
]
#: Combining marks to Python that the library's NFC neither orders nor composes with what is before.
NO_MARKS = [
    (0x7FD, 0x7FD), (0x898, 0x89F), (0x8CA, 0x8D3), (0x9FE, 0x9FE), (0xC3C, 0xC3C), (0xD3B, 0xD3C), (0xEBA, 0xEBA),
    (0x1715, 0x1715), (0x1ABF, 0x1ACE), (0x1DF6, 0x1DFA), (0xA82C, 0xA82C), (0x10D24, 0x10D27), (0x10EAB, 0x10EAC),
    (0x10EFD, 0x10EFF), (0x10F46, 0x10F50), (0x10F82, 0x10F85), (0x11070, 0x11070), (0x1133B, 0x1133B),
    (0x1145E, 0x1145E), (0x11839, 0x1183A), (0x11930, 0x11930), (0x1193D, 0x1193E), (0x11943, 0x11943),
    (0x119E0, 0x119E0), (0x11A34, 0x11A34), (0x11A47, 0x11A47), (0x11A99, 0x11A99), (0x11D42, 0x11D42),
    (0x11D44, 0x11D45), (0x11D97, 0x11D97), (0x11F41, 0x11F42), (0x16FF0, 0x16FF1), (0x1E08F, 0x1E08F),
    (0x1E130, 0x1E136), (0x1E2AE, 0x1E2AE), (0x1E2EC, 0x1E2EF), (0x1E4EC, 0x1E4EF),
]


def _ranges(pairs: list[tuple[int, int]]) -> str:
    """The inside of a character class."""
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in pairs)


def byte_symbols() -> list[str]:
    """The printable character that byte-level vocabularies use for each byte:
    itself for printable Latin-1, and code points from 256 on for the rest."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


def load_model(path: str) -> dict:
    """The parts of a tokenizer file that encoding needs, as arrays."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, suffix = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"] or ""
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    size = 1 + max([*vocab.values(), *special.values()])
    left = np.array([vocab[a] for a, _ in merges], np.int64)
    right = np.array([vocab[b] for _, b in merges], np.int64)
    keys = left * size + right
    order = np.argsort(keys)
    tokens = [""] * size
    for token, i in [*vocab.items(), *special.items()]:
        tokens[i] = token
    symbols = byte_symbols()
    split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    return {
        "size": size, "keys": keys[order], "ranks": order.astype(np.int64),
        "merged": np.array([vocab[a + b] for a, b in merges], np.int64),
        "inner": np.array([vocab[c] for c in symbols], np.int64),
        "last": np.array([vocab[c + suffix] for c in symbols], np.int64),
        "tokens": tokens, "special": special, "split": split,
    }


class Encoder:
    """Encodes lists of texts; remembers words."""

    def __init__(self, model: dict):
        import regex

        self.m = model
        self.none = len(model["merged"])
        self.words = regex.compile(model["split"])
        classes = {r"\p{L}": NO_LETTERS, r"\p{N}": NO_NUMBERS}
        pinned = model["split"]
        for name, pairs in classes.items():
            pinned = pinned.replace(name, f"[{name}--[{_ranges(pairs)}]]")
        self.pinned_words = regex.compile(pinned, regex.V1)
        self.lower = {c: chr(to + c - a) for a, b, to in LOWER for c in range(a, b + 1)}
        self.marks = re.compile(f"([{_ranges(NO_MARKS)}])")
        pairs = [*NO_LETTERS, *NO_NUMBERS, *NO_MARKS, *[(c, c) for c in sorted(self.lower)]]
        # most texts have nothing from the first such code point on, which is faster to see
        self.may_differ = re.compile(f"[{_ranges([(min(a for a, _ in pairs), 0x10FFFF)])}]")
        self.differs = re.compile(f"[{_ranges(pairs)}]")
        names = sorted(model["special"], key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.reset()

    def reset(self) -> None:
        self.index: dict[str, int] = {}
        self.flat: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.pieces: list[str] = []
        for name, i in self.m["special"].items():
            self.index["\0" + name] = len(self.pieces)
            self.pieces.append(name)
            self.flat.append(np.array([i], np.int64))
            self.lengths.append(np.array([1], np.int64))

    def ranks(self, pairs: np.ndarray) -> np.ndarray:
        """The rank of each pair key; ``none`` where it isn't merged."""
        keys = self.m["keys"]
        if not len(keys):
            return np.full(len(pairs), self.none)
        at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
        return np.where(keys[at] == pairs, self.m["ranks"][at], self.none)

    def split(self, text: str) -> list[str]:
        """The words of a text; special tokens are marked by a leading NUL."""
        if self.special is None or "<" not in text:
            return self.plain(text)
        out: list[str] = []
        for k, part in enumerate(self.special.split(text)):
            out += ["\0" + part] if k % 2 else self.plain(part)
        return out

    def plain(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if text.isascii():
            return self.words.findall(text.lower())
        # each character on its own: a final sigma isn't special
        high = self.may_differ.search(text)
        if not high or not self.differs.search(text, high.start()):
            return self.words.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
        # an unknown mark stands for itself, between texts normalised apart
        text = "".join(part if k % 2 else unicodedata.normalize("NFC", part) for k, part in enumerate(self.marks.split(text)))
        return self.pinned_words.findall(text.translate(self.lower).replace("Σ", "σ").lower())

    def learn(self, words: list[str]) -> None:
        """Encode words not met before."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.array([len(r) for r in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        symbols = self.m["inner"][data]
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.m["last"][data[ends]]
        word = np.repeat(np.arange(len(words)), sizes)
        long = sizes > LONG_WORD
        apart = {}
        if long.any():
            for i in np.flatnonzero(long):
                apart[i] = self.by_heap(symbols[ends[i] + 1 - sizes[i]:ends[i] + 1])
            symbols, word = symbols[~long[word]], word[~long[word]]
        symbols, lengths = self.by_rounds(symbols, word, len(words))
        if apart:
            starts = np.cumsum(lengths) - lengths
            symbols = np.concatenate([apart[i] if i in apart else symbols[starts[i]:starts[i] + lengths[i]] for i in range(len(words))])
            for i, x in apart.items():
                lengths[i] = len(x)
        tokens, at = self.m["tokens"], 0
        named = [tokens[i] for i in symbols.tolist()]
        for w, n in zip(words, lengths.tolist()):
            self.index[w] = len(self.pieces)
            self.pieces.append(" ".join(named[at:at + n]))
            at += n
        self.flat.append(symbols)
        self.lengths.append(lengths)

    def by_rounds(self, symbols: np.ndarray, word: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Merge all words, given as one array with the word of each symbol, until
        no pair has a rank. Returns symbols by word and the lengths."""
        done_symbols, done_word = [], []
        size, merged = self.m["size"], self.m["merged"]
        while len(symbols) > 1:
            rank = np.full(len(symbols), self.none)
            inside = np.flatnonzero(word[1:] == word[:-1])
            rank[inside] = self.ranks(symbols[inside] * size + symbols[inside + 1])
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, first)
            count = np.diff(np.r_[first, len(symbols)])
            over = np.repeat(lowest == self.none, count)
            low = np.repeat(lowest, count)
            done_symbols.append(symbols[over])
            done_word.append(word[over])
            hit = (rank == low) & ~over
            # of overlapping equal pairs (a a a) every other one, from the left
            run_start = hit & ~np.r_[False, hit[:-1]]
            pos = np.arange(len(hit))
            since = pos - np.maximum.accumulate(np.where(run_start, pos, 0))
            hit &= since % 2 == 0
            at = np.flatnonzero(hit)
            symbols = symbols.copy()
            symbols[at] = merged[rank[at]]
            keep = ~over
            keep[at + 1] = False
            symbols, word = symbols[keep], word[keep]
        done_symbols.append(symbols)
        done_word.append(word)
        symbols, word = np.concatenate(done_symbols), np.concatenate(done_word)
        order = np.argsort(word, kind="stable")
        return symbols[order], np.bincount(word, minlength=n_words).astype(np.int64)

    def by_heap(self, symbols: np.ndarray) -> np.ndarray:
        """One long word: a linked list of symbols and a heap of (rank, place)."""
        n, size = len(symbols), self.m["size"]
        value, after, before = symbols.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        rank = self.ranks(symbols[:-1] * size + symbols[1:])
        heap = [(r, i, value[i], value[i + 1]) for i, r in enumerate(rank.tolist()) if r < self.none]
        heapq.heapify(heap)
        table = dict(zip(self.m["keys"].tolist(), self.m["ranks"].tolist()))
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or value[i] != a or value[j] != b:
                continue
            value[i] = int(self.m["merged"][r])
            alive[j], after[i] = False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (k := table.get(value[x] * size + value[y])) is not None:
                    heapq.heappush(heap, (k, x, value[x], value[y]))
        return np.array([v for v, on in zip(value, alive) if on], np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Flat ids, the number of ids of each text, and each text decoded again."""
        if len(self.index) > CACHE_WORDS:
            self.reset()
        split = [self.split(t) for t in texts]
        new = list({w for words in split for w in words if w not in self.index})
        if new:
            self.learn(new)
        if len(self.flat) > 1:
            self.flat, self.lengths = [np.concatenate(self.flat)], [np.concatenate(self.lengths)]
        flat, lengths = self.flat[0] if self.flat else np.zeros(0, np.int64), self.lengths[0] if self.lengths else np.zeros(0, np.int64)
        starts = np.cumsum(lengths) - lengths
        get, pieces = self.index.__getitem__, self.pieces
        at = [list(map(get, words)) for words in split]
        decoded = [" ".join([pieces[i] for i in x]) for x in at]
        n = np.array([len(x) for x in at], np.int64)
        which = np.fromiter((i for x in at for i in x), np.int64, int(n.sum()))
        size = lengths[which]
        ends = np.cumsum(size)
        ids = flat[np.repeat(starts[which] - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)]
        bounds = np.r_[0, ends][np.cumsum(n)] if len(n) else n
        return ids, np.diff(np.r_[0, bounds]), decoded


def without(docs: DataFrame, *names: str) -> DataFrame:
    """``docs`` without columns of these names in any case."""
    low = {n.lower() for n in names}
    return docs.select(*[quoted(c) for c in docs.columns if c.lower() not in low])


def numbered_names(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns named c0, c1, ...: any name may pass through a Python step so."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])


def bpe_round_trip(docs: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """All rows and columns of ``docs`` with ``ids`` (array<int>) and ``decoded``
    (the tokens joined by one space, what the library gives for a file without decoder)."""
    docs = without(docs, ids_col, decoded_col)
    model = docs.sparkSession.sparkContext.broadcast(load_model(model_path))
    frame, text = numbered_names(docs), f"c{docs.columns.index(text_col)}"
    own = [T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.StringType())]

    def run(batches):
        encoder = Encoder(model.value)
        for batch, texts in text_slices(batches, text, 2_000_000):
            ids, counts, decoded = encoder.encode(texts)
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, pa.array(decoded, pa.string())], names=[*batch.schema.names, "ids", "decoded"])

    return frame.mapInArrow(run, T.StructType([*frame.schema.fields, *own])).toDF(*docs.columns, ids_col, decoded_col)


def bpe_decode(docs: DataFrame, model_path: str, ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """Decode an ids column: the tokens joined by one space. Null ids decode to the empty text;
    ids outside the vocabulary are skipped, as the library does."""
    docs = without(docs, decoded_col)
    model = docs.sparkSession.sparkContext.broadcast(load_model(model_path)["tokens"])
    frame, place = numbered_names(docs), f"c{docs.columns.index(ids_col)}"

    def run(batches):
        tokens = model.value
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(place)).to_pylist()
            texts = [" ".join([tokens[i] for i in x or () if i is not None and 0 <= i < len(tokens) and tokens[i]]) for x in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return frame.mapInArrow(run, T.StructType([*frame.schema.fields, T.StructField("decoded", T.StringType())])).toDF(*docs.columns, decoded_col)


def default_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op6_bpe(spark, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = bpe_round_trip(docs, default_model_path())
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
