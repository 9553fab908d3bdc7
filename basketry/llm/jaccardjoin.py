"""N-gram Jaccard join by count-vector R-trees.

The set of a document is its distinct 5-word shingles; two documents link when
their sets have a Jaccard similarity of THRESHOLD or more. The result is the
connected components of the links (``jaccard_components``, which looks for as many
links as connect them) or all links between different sets (``jaccard_links``).
Nothing is approximate: no link is lost in either, and no other is made.

1. Equal sets are one class from the start (128-bit hash of the sorted set), so
   copies cost one row each.
2. Sets that link share many of their first shingles, in any order that all sets
   agree on. The order here puts shingles of long words first, which unrelated texts
   hardly share, and the first 2/5 of each set are looked at: two sets that
   link share at least 15 in 100 of the larger set's number there. A set of which
   fewer are in any other set's first part can't link. Of the others, each may leave
   out almost half of that number and still share one with whatever it links to; it
   leaves out its most common ones, so that passages which many documents share
   don't bring them together. Documents that share one that is left are linked in a
   star to the least of them; the components of the stars are blocks outside of
   which no link can be. First shingles travel packed, by hash, in ranges of
   bounded size; no range, and no table after it, holds pairs.
3. In a block, shingles are hashed into groups; the counts of its groups make a
   document a point. An R-tree over the points holds in each node the largest
   counts and the least size below it. The overlap of two sets is at most the sum
   of the lesser of their counts, and that of a set and a node's sets at most the
   sum of the lesser of its counts and the node's largest: where that is too little
   for a link with sets of the node's size, the node is passed over. Points that
   stay are verified on the sets. Points that are in one component already aren't
   compared, and the sets with the most common shingles, the likely originals of
   the others, ask first, so that a family of n near copies costs about n
   comparisons.
4. The links found join the classes into components.

A block over TILE_SHINGLES shingles or TILE_SETS sets is cut into tiles by hash,
within bands of size of which only neighbours can link, and each pair of tiles is
worked on by itself; so a task holds two tiles at most, whatever the block.

The tree alone can't be the index of all documents: hashed counts of unrelated
texts of one size lie too close together for nodes of any fan-out to be passed
over. So step 2 stands before it.

Defined cases: null texts, empty texts and texts without words have empty sets and
link with nothing; shorter texts than five words are one shingle; repeated rows
and repeated ids are rows of their own, in one class if their sets are equal;
component ids are the least non-null document id. An empty table gives an empty
result. All columns are carried in ``row``, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import documents, numbered, stored, text_slices
from basketry.llm.components import connected_components

SHINGLE = 5
#: Least similarity in percent.
THRESHOLD = 75
#: Percent of a set that aren't first shingles; must be less than the threshold.
REST = 60
#: First shingles that one task compares with each other.
RANGE_ENTRIES = 2**18
#: First shingles that a task holds before it passes them on.
FLUSH_ENTRIES = 1_000_000
TILE_SETS = 1024
TILE_SHINGLES = 1_500_000
#: Words whose hash a task remembers.
CACHE_WORDS = 1_000_000
FAN_OUT = 16
#: Copies of what a group's rows are told, so that they needn't meet in one task.
SALTS = 16
#: Bits for each member in the filter that spares most texts the way to the blocks, and bits at most.
FILTER_BITS, MAX_FILTER_BITS = 16, 2**28

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers evenly."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: str, words: WordHashes) -> np.ndarray:
    """Sorted distinct shingles: 4 bits that are less the longer their words are, and 60 of hash."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    if not len(h):
        return h
    k = min(SHINGLE, len(h))
    n = len(h) - k + 1
    total = np.full(n, k, np.uint64)
    for i in range(k):
        total += h[i:i + n] * _ODD[i]
    upto = np.r_[0, np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))]
    short = (15 - np.minimum((upto[k:] - upto[:n]) // 4, 15)).astype(np.uint64)
    out = (mixed(total) >> np.uint64(4)) | (short << np.uint64(60))
    out.sort()
    keep = np.ones(n, bool)
    np.not_equal(out[1:], out[:-1], out=keep[1:])
    return out[keep]


def needed(a, b, threshold: int = THRESHOLD):
    """Least overlap of sets of sizes ``a`` and ``b`` that link: 100 i >= threshold (a + b - i)."""
    return -(-threshold * (a + b) // (100 + threshold))


def first_shingles(shingles: np.ndarray) -> np.ndarray:
    """The part of a sorted set in which it meets the sets that it links with."""
    return shingles[:len(shingles) - REST * len(shingles) // 100]


def _met(n: Column, threshold: int) -> Column:
    """So many of the first shingles of a set of ``n`` are among those of each set that it links with."""
    return F.ceil(n * (threshold - REST) / 100).cast("int")


class CountTree:
    """R-tree over points of group counts; entries are in one given order, nodes hold FAN_OUT of the level below."""

    def __init__(self, sets: list[np.ndarray], groups: int):
        self.groups = groups
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.points = np.zeros((len(sets), groups), np.uint16 if self.sizes.max() < 2**16 else np.int64)
        for i, s in enumerate(sets):
            self.points[i] = np.bincount((s & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
        self.levels = [(self.points, self.sizes, self.sizes)]
        while len(self.levels[-1][0]) > FAN_OUT:
            high, small, large = self.levels[-1]
            cut = np.arange(0, len(high), FAN_OUT)
            self.levels.append((np.maximum.reduceat(high, cut, axis=0), np.minimum.reduceat(small, cut), np.maximum.reduceat(large, cut)))

    def candidates(self, point: np.ndarray, size: int, among: np.ndarray, threshold: int) -> np.ndarray:
        """Entries whose overlap with the point may suffice for a link; ``among`` marks the entries asked for."""
        marks = [among]
        for _ in self.levels[1:]:
            marks.append(np.logical_or.reduceat(marks[-1], np.arange(0, len(marks[-1]), FAN_OUT)))
        at = np.flatnonzero(marks[-1])
        for level in range(len(self.levels) - 1, -1, -1):
            high, small, large = self.levels[level]
            # a partner has between threshold and 100 / threshold times the size
            at = at[(100 * large[at] >= threshold * size) & (100 * size >= threshold * small[at])]
            bound = np.minimum(high[at], point).sum(1, dtype=np.int64)
            least = np.maximum(small[at], -(-threshold * size // 100))
            at = at[bound >= needed(size, least, threshold)]
            if level:
                at = (at[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
                at = at[at < len(marks[level - 1])]
                at = at[marks[level - 1][at]]
        return at


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def links_within(names: list[int], sets: list[np.ndarray], side: np.ndarray, threshold: int = THRESHOLD, every: bool = False) -> list[tuple[int, int]]:
    """A forest of links that connects what links connect, or ``every`` link once. With
    two sides (tiles 0 and 1) only links between them are asked for; with one, all."""
    n = len(sets)
    if n < 2:
        return []
    # near copies share their least shingles: a good order for the tree's nodes
    order = sorted(range(n), key=lambda i: (int(sets[i][0]), len(sets[i])))
    names, sets, side = [names[i] for i in order], [sets[i] for i in order], side[order]
    groups = 1 << int(np.clip(2 * max(map(len, sets)) - 1, 64, 4096)).bit_length()
    tree = CountTree(sets, groups)
    everything, where = np.unique(np.concatenate(sets), return_inverse=True)
    copies = np.bincount(where, minlength=len(everything))
    bounds = np.r_[0, np.cumsum(tree.sizes)]
    # those whose shingles are the most common ask first
    common = np.add.reduceat((copies[where] > 1).astype(np.int64), bounds[:-1]) / tree.sizes
    usual = np.add.reduceat(copies[where], bounds[:-1]) / tree.sizes
    root, asked = np.arange(n), np.zeros(n, bool)
    two = bool(side.any() and not side.all())
    out = []
    for i in np.lexsort((-usual, -common)).tolist():
        if 100 * common[i] < threshold:
            continue  # too few of its shingles are in any other set here
        asked[i] = True
        among = ~asked if every else root != root[i]
        if two:
            among &= side != side[i]
        if not among.any():
            continue
        for j in tree.candidates(tree.points[i], len(sets[i]), among, threshold).tolist():
            if (every or root[j] != root[i]) and overlap(sets[i], sets[j]) >= needed(len(sets[i]), len(sets[j]), threshold):
                out.append((names[i], names[j]))
                root[root == root[j]] = root[i]
    return out


def _packed(x: np.ndarray) -> bytes:
    """Numbers with equal bytes side by side, which compresses well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes()


def _unpacked(x: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _with_least(frame: DataFrame, key: str, least: Column) -> DataFrame:
    """``frame`` with ``least``, an aggregate over the rows of its key; null for keys of one row.

    A key may hold a third of all rows: the aggregate combines them within tasks, and
    comes back in SALTS copies by row number, for keys of several rows only."""
    groups = frame.groupBy(key).agg(least.alias("least"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    copies = groups.select(key, "least", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    return frame.withColumn("salt", F.pmod(F.xxhash64("number"), F.lit(SALTS)).cast("int")).join(copies, [key, "salt"], "left").drop("salt")


def _classes(base: DataFrame) -> DataFrame:
    """(number, n, class) of all rows."""
    def run(batches):
        words = WordHashes()
        for batch, texts in text_slices(batches, "text"):
            sets = [shingle_set(t, words) for t in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column(batch.schema.get_field_index("number")), pa.array([len(s) for s in sets], pa.int32()),
                pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
            ], names=["number", "n", "class"])

    return stored(base.select("number", "text").mapInArrow(run, "number long, n int, class binary"))


def _shared(base: DataFrame, entries: int) -> DataFrame:
    """(number, key, copies): the first shingles of rows that other rows have among theirs."""
    parts = 1 << max(0, entries // RANGE_ENTRIES).bit_length()

    def cut(batches):
        words, seen, keys, owners, size = WordHashes(), set(), [], [], 0

        def passed_on():
            key, owner = np.concatenate(keys), np.repeat(np.array([o for o, _ in owners], np.int64), [k for _, k in owners])
            part = (key & np.uint64(parts - 1)).astype(np.int64)
            order = np.lexsort((key, part))
            key, owner, part = key[order], owner[order], part[order]
            cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            ends = np.r_[cuts[1:], len(part)]
            low = int(owner.min())
            kind = np.uint16 if int(owner.max()) - low < 2**16 else np.uint32 if int(owner.max()) - low < 2**32 else np.uint64
            rows = [(int(part[a]), low, _packed(np.diff(key[a:b], prepend=np.uint64(0))), _packed((owner[a:b] - low).astype(kind))) for a, b in zip(cuts, ends)]
            names = ["part", "low", "keys", "owners"]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.binary(), pa.binary()))], names=names)

        for batch, texts in text_slices(batches, "text"):
            for number, t in zip(batch.column(batch.schema.get_field_index("number")).to_pylist(), texts):
                s = shingle_set(t, words)
                name = xxhash.xxh3_128_digest(s.tobytes())
                if not len(s) or name in seen:
                    continue  # a copy within the task
                seen.add(name)
                first = first_shingles(s)
                keys.append(first)
                owners.append((number, len(first)))
                size += len(first)
                if size > FLUSH_ENTRIES:
                    yield passed_on()
                    keys, owners, size, seen = [], [], 0, set()
        if keys:
            yield passed_on()

    def met(part: pa.Table) -> pa.Table:
        keys = [np.cumsum(_unpacked(k, np.uint64), dtype=np.uint64) for k in part.column("keys").to_pylist()]
        owners = [
            _unpacked(x, {2: np.uint16, 4: np.uint32, 8: np.uint64}[len(x) // len(k)]).astype(np.int64) + low
            for low, x, k in zip(part.column("low").to_pylist(), part.column("owners").to_pylist(), keys)
        ]
        key, owner = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(key)
        key, owner = key[order], owner[order]
        begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        copies = np.diff(np.r_[begin, len(key)])
        copies = np.repeat(copies, copies)
        more = copies > 1
        return pa.table({"number": pa.array(owner[more]), "key": pa.array(key[more].view(np.int64)), "copies": pa.array(copies[more], pa.int32())})

    packs = base.select("number", "text").mapInArrow(cut, "part int, low long, keys binary, owners binary")
    return packs.groupBy("part").applyInArrow(met, "number long, key long, copies int")


def _stars(base: DataFrame, own: DataFrame, entries: int, threshold: int) -> DataFrame:
    """(a, b) nodes that may be connected by links, in stars."""
    shared = _shared(base, entries).groupBy("number").agg(F.sort_array(F.collect_list(F.struct("copies", "key"))).alias("keys"))
    least = _met(F.col("n"), threshold)
    enough = shared.join(own, "number").where(F.size("keys") >= least)
    left = F.slice("keys", F.lit(1), F.size("keys") - F.floor((least - 1) / 2).cast("int"))
    kept = stored(enough.select("node", F.explode(left).alias("k")).select("node", "k.key"))
    stars = kept.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub < top").select("key", "hub")
    # a node has a hub for each key: it goes to the least of them, and so do the others, which many nodes share
    hubs = kept.join(stars, "key").select("node", "hub").distinct().groupBy("node").agg(F.collect_list("hub").alias("hubs"))
    met = hubs.select(F.explode(F.array_append("hubs", F.col("node"))).alias("a"), F.array_min("hubs").alias("b"))
    return met.where("a <> b").distinct()


def _only(frame: DataFrame, members: DataFrame) -> DataFrame:
    """Rows of ``frame`` (number, text) that may be ``members``: a Bloom filter of one hash, of bounded size."""
    bits = 1 << min(max(10, (FILTER_BITS * members.count()).bit_length()), MAX_FILTER_BITS.bit_length() - 1)
    place = F.pmod(F.xxhash64("number"), F.lit(bits))
    words = members.select(F.floor(place / 64).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int")).alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("set")).toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[np.asarray(words.column("word").combine_chunks())] = np.asarray(words.column("set").combine_chunks())
    sent = frame.sparkSession.sparkContext.broadcast(table.view(np.uint64))

    def run(batches):
        for batch in batches:
            place = np.asarray(batch.column(batch.schema.get_field_index("place")))
            on = sent.value[place // 64] >> (place % 64).astype(np.uint64) & np.uint64(1)
            yield batch.drop_columns(["place"]).filter(pa.array(on.astype(bool)))

    return frame.select("*", place.alias("place")).mapInArrow(run, frame.schema)


def _links(base: DataFrame, members: DataFrame, threshold: int, every: bool = False) -> DataFrame:
    """(a, b) links that connect the ``members`` (number, n, block) of each block, or ``every`` link once."""
    # the width of a band: sizes of linked sets are the same or neighbouring powers of 4/3
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / threshold)) + F.lit(1e-9)).cast("int")
    weight = members.groupBy("block").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
    whole = (F.col("sets") <= TILE_SETS) & (F.col("shingles") <= TILE_SHINGLES)
    # one frame for both sorts of block, so that the texts are read once
    sized = members.join(weight.select("block", whole.alias("whole")), "block").withColumn("band", F.when(F.col("whole"), -1).otherwise(band))
    tiles = F.greatest(F.ceil(F.count(F.lit(1)) / TILE_SETS), F.ceil(F.sum("n") / TILE_SHINGLES)).cast("int")
    bands = stored(sized.where("not whole").groupBy("block", "band").agg(tiles.alias("tiles")))
    above = bands.select("block", (F.col("band") - 1).alias("band"), F.col("tiles").alias("above"))
    below = bands.select("block", (F.col("band") + 1).alias("band"), F.col("tiles").alias("below"))
    shape = bands.join(above, ["block", "band"], "left").join(below, ["block", "band"], "left")
    placed = sized.join(shape, ["block", "band"], "left").withColumn("tile", F.when(F.col("whole"), 0).otherwise(F.pmod(F.xxhash64("number"), F.col("tiles")).cast("int")))
    # a tile meets itself, the other tiles of its band, and all tiles of the bands beside it
    job = lambda low_band, low, high_band, high, side: F.struct(low_band.alias("band"), low.alias("low"), high_band.alias("other"), high.alias("high"), F.lit(side).alias("side") if isinstance(side, int) else side.alias("side"))
    upto = lambda n: F.filter(F.sequence(F.lit(-1), n - 1), lambda t: t >= 0)  # noqa: E731  empty for 0
    me, mine = F.col("band"), F.col("tile")
    own = F.transform(upto(F.coalesce("tiles", F.lit(1))), lambda t: job(me, F.least(mine, t), me, F.greatest(mine, t), (t < mine).cast("int")))
    up = F.transform(upto(F.coalesce("above", F.lit(0))), lambda t: job(me, mine, me + 1, t, 0))
    down = F.transform(upto(F.coalesce("below", F.lit(0))), lambda t: job(me - 1, t, me, mine, 1))
    jobs = placed.select("number", "block", F.concat(own, up, down).alias("jobs"))

    def sets(batches):
        words = WordHashes()
        for batch, texts in text_slices(batches, "text"):
            found = [shingle_set(t, words).view(np.int64) for t in texts]
            rest = [batch.column(batch.schema.get_field_index(c)) for c in ("number", "block", "jobs")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(found, pa.list_(pa.int64()))], names=["number", "block", "jobs", "shingles"])

    read = _only(base.select("number", "text"), members).join(jobs, "number")
    schema = read.select("number", "block", "jobs").schema.add("shingles", T.ArrayType(T.LongType()))
    dealt = read.mapInArrow(sets, schema).select("block", F.explode("jobs").alias("job"), "number", "shingles")
    dealt = dealt.select("block", "job.band", "job.low", "job.other", "job.high", "job.side", "number", "shingles")

    def linked(part: pa.Table) -> pa.Table:
        held = [np.asarray(x.values).view(np.uint64) for x in part.column("shingles")]
        side, job = np.asarray(part.column("side")), part.slice(0, 1).to_pylist()[0]
        alone = (job["band"], job["low"]) != (job["other"], job["high"]) and len(set(side.tolist())) < 2
        # a tile whose partner is empty has met itself elsewhere
        out = [] if every and alone else links_within(part.column("number").to_pylist(), held, side, threshold, every)
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})

    return dealt.groupBy("block", "band", "low", "other", "high").applyInArrow(linked, "a long, b long")


def _prepared(docs: DataFrame, text_col: str, id_col: str, threshold: int, keep: list[str] | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The numbered rows, (number, node, n) of those with shingles, and (number, n, block) of the nodes that may link."""
    base = numbered(docs, keep, text_col, F.col(id_col).alias("id"))
    classes = _classes(base)
    entries = classes.agg(F.coalesce(F.sum(F.col("n") - F.floor(F.col("n") * REST / 100)), F.lit(0))).first()[0]
    filled = classes.where("n > 0")
    own = _with_least(filled, "class", F.min("number"))
    own = stored(own.select("number", F.coalesce("least", "number").alias("node"), "n"))
    blocks = connected_components(_stars(base, own, int(entries), threshold))
    members = stored(own.where("number = node").join(blocks.withColumnRenamed("root", "block"), "node").select("number", "n", "block"))
    return base, own, members


def jaccard_components(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", threshold: int = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) in a struct ``row``; n_shingles;
    component_id (the least id of the component; the own id for empty sets); and
    ``first``: whether the row is the one of the component to keep (least id, then row)."""
    base, own, members = _prepared(docs, text_col, id_col, threshold, keep)
    roots = connected_components(_links(base, members, threshold))

    # rows of a class share its node, nodes of a component its root; the rows themselves join last, and once
    placed = own.join(roots, "node", "left").select("number", "n", F.coalesce("root", "node").alias("root"))
    placed = stored(placed.join(base.select("number", "id"), "number"))
    order = F.struct(F.col("id").isNull().alias("last"), F.col("id"), F.col("number"))
    found = _with_least(placed, "root", F.min(order)).select(
        "number", "n", F.when(F.col("least").isNull(), F.col("id")).otherwise(F.col("least.id")).alias("component_id"),
        (F.col("least").isNull() | (F.col("number") == F.col("least.number"))).alias("first"),
    )
    empty = F.col("n").isNull()
    return base.select("number", "row", "id").join(found, "number", "left").select(
        "row", F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"),
        F.when(empty, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        (empty | F.col("first")).alias("first"),
    )


def jaccard_links(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", threshold: int = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """Each two different sets that link, once: the first row of each set (``row_a`` and
    ``row_b``, with the columns ``keep``) and how many rows have it (``copies_a``, ``copies_b``)."""
    base, own, members = _prepared(docs, text_col, id_col, threshold, keep)
    links = stored(_links(base, members, threshold, every=True))
    linked = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    copies = own.groupBy("node").agg(F.count(F.lit(1)).alias("copies")).join(linked, "node")
    sets = stored(copies.join(base.select(F.col("number").alias("node"), "row"), "node"))
    side = lambda k: sets.select(F.col("node").alias(k), F.col("row").alias(f"row_{k}"), F.col("copies").alias(f"copies_{k}"))
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return ordered.join(side("a"), "a").join(side("b"), "b").drop("a", "b")


def op8_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """All documents with the component that links of at least 0.75 join them in."""
    out = jaccard_components(documents(spark, sf_dir), keep=["doc_id"])
    return out.select("row.doc_id", "n_shingles", "component_id")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OP8_SQL = rf"""
with recursive d as (
    select row_number() over () r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') w from documents),
s as (select distinct r, len(w[pos:pos + {SHINGLE - 1}]) k, array_to_string(w[pos:pos + {SHINGLE - 1}], ' ') g from (select r, w, unnest(range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1)) pos from d where len(w) > 0)),
n as (select r, count(*) n from s group by r),
o as (select a.r a, b.r b, count(*) o from s a join s b on a.k = b.k and a.g = b.g and a.r < b.r group by all),
l as (select a, b from o join n x on x.r = a join n y on y.r = b where 100 * o >= {THRESHOLD} * (x.n + y.n - o)),
e as (select a, b from l union all select b, a from l),
c as (select r a, r b from d union select c.a, e.b from c join e on c.b = e.a)
select d.doc_id, coalesce(n.n, 0)::bigint n_shingles, (select min(y.doc_id) from c join d y on y.r = c.b where c.a = d.r) component_id
from d left join n on n.r = d.r
"""
