"""Near-duplicate documents by b-bit MinHash.

The set of a document is its distinct 4-word shingles; two documents link when their
sets have a Jaccard similarity of THRESHOLD percent or more, and the result is the
connected components of the links.

1. Equal sets are one class (128-bit hash of the sorted set), and its first row stands
   for it. One pass takes BANDS x ROWS minima of each set. A band's key is a hash
   of its ROWS whole minima; of each minimum the BITS low bits (mixed) stay, packed
   into a signature of 64 bytes.
2. Sets with a key in common are candidates of each other. Keys with the same members
   are one group. The members of a group are compared with its hub, the one that
   shares most keys with others, by signature: with m of the K minima equal in
   their low bits, the similarity is about (m / K - c) / (1 - c), where c = 2^-BITS is
   the chance that different minima collide. Members that look similar to their hub
   are in one block with it. Those that don't are compared with all members of
   the group by signature, in pairs of tiles of bounded size. No pairs but such
   that connect members are passed on.
3. Links are confirmed on the full sets inside the blocks. A block over TILE_SETS or
   TILE_SHINGLES is cut into tiles by hash, each with a copy of the block's hub. In
   a tile a set is compared with all others at once, by marking its shingles among
   those of the tile, and only with sets of other components. Where the tiles
   of a block leave several components, whatever isn't in the greatest of them meets
   all tiles. A family of n near copies that link with their original thus costs about
   n rows and n comparisons, however large it is.
4. The links join the classes into components.

What may be lost: two sets of similarity s share no key with a chance of
(1 - s^ROWS)^BANDS, which is 1.3e-7 at s = 0.8 and 6.6e-11 at 0.85, and look less
similar than they are allowed to with one of less than CHANCE; beside that, no link is
lost, and as every link is confirmed no other is made. A group of sets that share a key
without being similar to its hub costs comparisons of signatures in the square of its
size, in bounded tasks.

Defined cases: null texts, empty texts and texts without words have empty sets and
link with nothing; shorter texts than four words are one shingle; repeated rows and
repeated ids are rows of their own, in one class if their sets are equal; component
ids are the least non-null document id. A row without id is kept if its component
has no id either. An empty table gives an empty result. All columns are carried in
``row``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import documents, numbered, stored, text_slices
from basketry.llm.components import connected_components
from basketry.llm.jaccardjoin import WordHashes, _only, mixed

SHINGLE = 4
#: Least similarity in percent.
THRESHOLD = 80
BANDS, ROWS, BITS = 40, 5, 2
MINIMA = BANDS * ROWS
#: Chance that a link looks too dissimilar by signature.
CHANCE = 1e-9
#: Words of 64 bits that one bit of all minima takes.
PLANE = -(-MINIMA // 64)
#: Shingles that are hashed at once.
BLOCK_SHINGLES = 128
#: Texts whose set a task remembers, to pass over copies.
SEEN_SETS = 100_000
#: Members of a group that are compared by signature at once, and rows that a task gets.
TILE_SIGNATURES, PART_SIGNATURES = 1024, 2**11
TILE_SETS, TILE_SHINGLES = 1024, 1_000_000
#: Copies of what a group's rows are told, so that they needn't meet in one task.
SALTS = 16

_MULTIPLIERS = mixed(np.arange(1, MINIMA + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_PLACES = _MULTIPLIERS[:SHINGLE]


def shingle_set(text: str, words: WordHashes) -> np.ndarray:
    """Sorted hashes of the distinct shingles."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    h = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    if not len(h):
        return h
    k = min(SHINGLE, len(h))
    n = len(h) - k + 1
    total = np.full(n, k, np.uint64)
    for i in range(k):
        total += mixed(h[i:i + n] + np.uint64(i)) * _PLACES[i]
    return np.unique(mixed(total))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least product of a set's shingles with each multiplier, modulo 2^64."""
    out = np.full(MINIMA, 2**64 - 1, np.uint64)
    for k in range(0, len(shingles), BLOCK_SHINGLES):
        np.minimum(out, (shingles[k:k + BLOCK_SHINGLES, None] * _MULTIPLIERS).min(0), out=out)
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    """A 64-bit key for the minima of each band."""
    part = mixed(least * _MULTIPLIERS).reshape(BANDS, ROWS).sum(1, dtype=np.uint64)
    return mixed(part + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def signature(least: np.ndarray) -> np.ndarray:
    """The low BITS of each minimum, a plane of PLANE words for each."""
    bits = np.zeros((BITS, PLANE * 64), np.uint8)
    low = mixed(least)
    for b in range(BITS):
        bits[b, :MINIMA] = (low >> np.uint64(b)) & np.uint64(1)
    return np.packbits(bits, axis=1, bitorder="little").view(np.int64).ravel()


def least_matches(threshold: int, chance: float = CHANCE) -> int:
    """So many minima of sets that link have equal low bits, but for a chance of ``chance``."""
    c = 2.0**-BITS
    p = c + (1 - c) * threshold / 100
    below = 0.0
    for m in range(MINIMA + 1):
        below += comb(MINIMA, m) * p**m * (1 - p) ** (MINIMA - m)
        if below > chance:
            return m
    return MINIMA


def estimate(matches: float) -> float:
    """Similarity by the number of minima with equal low bits, corrected for collisions."""
    c = 2.0**-BITS
    return (matches / MINIMA - c) / (1 - c)


def _matches(a: str, b: str) -> Column:
    """Minima of two signatures with equal low bits."""
    unequal = F.lit(0)
    for w in range(PLANE):
        bits = F.lit(0).cast("long")
        for plane in range(BITS):
            at = plane * PLANE + w
            bits = bits.bitwiseOR(F.get(a, F.lit(at)).bitwiseXOR(F.get(b, F.lit(at))))
        unequal = unequal + F.bit_count(bits)
    return F.lit(MINIMA) - unequal


def _equal(signatures: np.ndarray, one: np.ndarray) -> np.ndarray:
    """The same in a task, of many signatures with one."""
    differ = (signatures ^ one).reshape(len(signatures), BITS, PLANE)
    return MINIMA - np.bitwise_count(np.bitwise_or.reduce(differ, axis=1).view(np.uint64)).sum(1, dtype=np.int64)


def _told(frame: DataFrame, key: str, *what: Column) -> DataFrame:
    """``frame`` with aggregates over the rows of its key, null for keys of one row.

    A key may hold a third of all rows: the aggregates combine them within tasks, and
    come back in SALTS copies by row number, for keys of several rows only."""
    groups = frame.groupBy(key).agg(F.count(F.lit(1)).alias("members"), *what).where("members > 1")
    copies = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return frame.withColumn("salt", F.pmod(F.xxhash64("number"), F.lit(SALTS)).cast("int")).join(copies, [key, "salt"], "left").drop("salt")


def _signed(base: DataFrame) -> DataFrame:
    """(number, n, class, signature, keys) of all rows with shingles; the last two are null where a task had the set before."""
    def run(batches):
        words, seen = WordHashes(), set()
        for batch, texts in text_slices(batches, "text"):
            numbers, rows = batch.column(batch.schema.get_field_index("number")).to_pylist(), []
            for number, text in zip(numbers, texts):
                s = shingle_set(text, words)
                if not len(s):
                    continue
                name, least = xxhash.xxh3_128_digest(s.tobytes()), None
                if name not in seen:
                    if len(seen) >= SEEN_SETS:
                        seen.clear()
                    seen.add(name)
                    least = minima(s)
                rows.append((number, len(s), name, None if least is None else signature(least), None if least is None else band_keys(least)))
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["number", "n", "class", "signature", "keys"])

    return stored(base.select("number", "text").mapInArrow(run, "number long, n int, class binary, signature array<long>, keys array<long>"))


def _groups(nodes: DataFrame) -> DataFrame:
    """(key, number) of keys with two members and more; keys with the same members once."""
    each = nodes.select("number", F.explode("keys").alias("key"))
    shared = stored(each.groupBy("key").agg(F.min("number").alias("low"), F.max("number").alias("high")).where("low < high").select("key"))
    # most keys are of one set: a filter of bounded size spares them the way to the join
    some = _only(each.select(F.col("key").alias("number"), F.col("number").alias("member")), shared.select(F.col("key").alias("number")))
    groups = stored(some.select(F.col("number").alias("key"), F.col("member").alias("number")).join(shared, "key"))
    name = F.xxhash64("number")
    members = [F.count(F.lit(1)).alias("members"), F.bit_xor(name).alias("name"), F.bit_xor(F.xxhash64(name, F.lit(1))).alias("other"), F.min("number").alias("low"), F.max("number").alias("high")]
    once = groups.groupBy("key").agg(*members).groupBy("members", "name", "other", "low", "high").agg(F.min("key").alias("key"))
    return stored(groups.join(once.select("key"), "key"))


def _candidates(nodes: DataFrame, threshold: int) -> DataFrame:
    """(a, b) that connect all sets with a common key which look similar."""
    least = least_matches(threshold)
    groups = _groups(nodes)
    sizes = _told(groups, "key").groupBy("number").agg(F.sum("members").alias("degree"))
    rows = stored(groups.join(sizes, "number").join(nodes.select("number", "signature"), "number"))
    hub = F.max(F.struct("degree", F.col("number").alias("hub"), F.col("signature").alias("hub_signature")))
    near = _told(rows, "key", hub.alias("h")).select("key", "number", "signature", "members", "h.hub", F.col("h.degree").alias("hub_degree"), (_matches("signature", "h.hub_signature") >= least).alias("near"))
    near = stored(near.where("number <> hub"))
    # a set has a hub for each key: it goes to the one that shares most keys, and so do its other hubs, which many sets have in common
    hubs = near.where("near").groupBy("number").agg(F.collect_set("hub").alias("hubs"), F.max(F.struct("hub_degree", "hub")).getField("hub").alias("b"))
    stars = hubs.select(F.explode(F.array_append("hubs", F.col("number"))).alias("a"), "b").where("a <> b").distinct()

    # groups of three and more with members that don't look like the hub: those meet all members
    tiles = lambda n: F.ceil(n / TILE_SIGNATURES).cast("int")
    left = near.where("members > 2").groupBy("key").agg(tiles(F.count_if(~F.col("near"))).alias("others"), tiles(F.count(F.lit(1))).alias("all")).where("others > 0")
    left = stored(left)
    copies = left.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = near.withColumn("salt", F.pmod(F.xxhash64("number"), F.lit(SALTS)).cast("int")).join(copies, ["key", "salt"])
    place = lambda n: F.pmod(F.xxhash64("number"), F.col(n)).cast("int")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    asked = met.where(~F.col("near")).select("key", place("others").alias("other"), F.explode(upto("all")).alias("tile"), F.lit(True).alias("asks"), "number", "signature")
    asking = met.select("key", F.explode(upto("others")).alias("other"), place("all").alias("tile"), F.lit(False).alias("asks"), "number", "signature")
    jobs = stored(asked.unionByName(asking))
    parts = max(1, -(-jobs.count() // PART_SIGNATURES))

    def forest(part: pa.Table) -> pa.Table:
        out = []
        for rows in _jobs(part, ["key", "other", "tile"]):
            number, asks = np.asarray(rows.column("number")), np.asarray(rows.column("asks"))
            signatures = np.asarray(rows.column("signature").combine_chunks().flatten()).reshape(len(number), -1)
            _, node = np.unique(number, return_inverse=True)
            root = np.arange(len(number))[:node.max() + 1]
            for i in np.flatnonzero(asks).tolist():
                found = np.flatnonzero((root[node] != root[node[i]]) & ~asks)
                for j in found[_equal(signatures[found], signatures[i]) >= least].tolist():
                    if root[node[j]] != root[node[i]]:
                        out.append((number[i], number[j]))
                        root[root == root[node[j]]] = root[node[i]]
        return _pairs(out)

    met = jobs.withColumn("part", F.pmod(F.xxhash64("key", "other", "tile"), F.lit(parts))).groupBy("part").applyInArrow(forest, "a long, b long")
    return stored(stars.unionByName(met))


def _jobs(part: pa.Table, keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each job that a task got."""
    part = part.sort_by([(k, "ascending") for k in keys]).combine_chunks()
    new = np.zeros(part.num_rows, bool)
    for k in keys:
        v = np.asarray(part.column(k))
        new[1:] |= v[1:] != v[:-1]
    cuts = np.r_[0, np.flatnonzero(new), part.num_rows]
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        yield part.slice(a, b - a)


def _pairs(out: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([int(x) for x, _ in out], pa.int64()), "b": pa.array([int(x) for _, x in out], pa.int64())})


def links_within(names: np.ndarray, sets: list[np.ndarray], root: np.ndarray, asks: np.ndarray, threshold: int = THRESHOLD) -> list[tuple[int, int]]:
    """Links that connect, beyond what ``root`` connects already, the sets that link with one that ``asks``."""
    sizes = np.array([len(s) for s in sets], np.int64)
    everything, where = np.unique(np.concatenate(sets), return_inverse=True)
    begin = np.r_[0, np.cumsum(sizes)[:-1]]
    usual = np.add.reduceat(np.bincount(where)[where], begin) / sizes
    marks, root, out = np.zeros(len(everything), bool), root.copy(), []
    # those whose shingles are the most common ask first: the likely originals of the others
    for i in sorted(np.flatnonzero(asks).tolist(), key=lambda i: -usual[i]):
        if (root == root[i]).all():
            continue
        mine = where[begin[i]:begin[i] + sizes[i]]
        marks[mine] = True
        both = np.add.reduceat(marks[where].astype(np.int64), begin)
        marks[mine] = False
        linked = (100 * both >= threshold * (sizes + sizes[i] - both)) & (root != root[i])
        for j in np.flatnonzero(linked).tolist():
            if root[j] != root[i]:
                out.append((names[i], names[j]))
                root[root == root[j]] = root[i]
    return out


def _confirmed(base: DataFrame, jobs: DataFrame, threshold: int) -> DataFrame:
    """(a, b) links found in jobs: rows (number, n, block, other, tile, asks, root)."""
    work = jobs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(1, -(-int(work) // TILE_SHINGLES))
    jobs = jobs.groupBy("number").agg(F.collect_list(F.struct("block", "other", "tile", "asks", "root")).alias("jobs"))

    def sets(batches):
        words = WordHashes()
        for batch, texts in text_slices(batches, "text"):
            found = [shingle_set(t, words).view(np.int64) for t in texts]
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in ("number", "jobs")), pa.array(found, pa.list_(pa.int64()))], names=["number", "jobs", "shingles"])

    read = _only(base.select("number", "text"), jobs.select("number")).join(jobs, "number")
    dealt = read.mapInArrow(sets, read.select("number", "jobs").schema.add("shingles", T.ArrayType(T.LongType())))
    dealt = dealt.select("number", "shingles", F.explode("jobs").alias("job")).select("number", "shingles", "job.*")

    def linked(part: pa.Table) -> pa.Table:
        out = []
        for rows in _jobs(part, ["block", "other", "tile"]):
            lists = rows.column("shingles").combine_chunks()
            flat = np.asarray(lists.flatten()).view(np.uint64)
            held = np.split(flat, np.cumsum(np.asarray(lists.value_lengths()))[:-1])
            out += links_within(np.asarray(rows.column("number")), held, np.asarray(rows.column("root")), np.asarray(rows.column("asks")), threshold)
        return _pairs(out)

    spread = dealt.withColumn("part", F.pmod(F.xxhash64("block", "other", "tile"), F.lit(parts)))
    return stored(spread.groupBy("part").applyInArrow(linked, "a long, b long"))


def _links(base: DataFrame, nodes: DataFrame, edges: DataFrame, threshold: int) -> DataFrame:
    """(a, b) links that connect the sets of each component of ``edges``."""
    blocks = connected_components(edges).select(F.col("node").alias("number"), F.col("root").alias("block"))
    members = nodes.select("number", "n").join(blocks, "number")
    tiles = F.greatest(F.ceil(F.count(F.lit(1)) / TILE_SETS), F.ceil(F.sum("n") / TILE_SHINGLES)).cast("int")
    # the hub of a block is the one that most candidates look like
    asked = edges.groupBy(F.col("b").alias("number")).agg(F.count(F.lit(1)).alias("stars"))
    members = stored(members.join(asked, "number", "left").withColumn("stars", F.coalesce("stars", F.lit(0))))
    shape = members.groupBy("block").agg(tiles.alias("tiles"), F.max(F.struct("stars", F.col("number").alias("hub"), F.col("n").alias("hub_n"))).alias("h"))
    shape = stored(shape.select("block", "tiles", "h.hub", "h.hub_n"))
    copies = shape.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = lambda frame: frame.withColumn("salt", F.pmod(F.xxhash64("number"), F.lit(SALTS)).cast("int"))
    placed = salted(members).join(copies, ["block", "salt"]).withColumn("tile", F.pmod(F.xxhash64("number"), F.col("tiles")).cast("int"))
    placed = stored(placed.select("number", "n", "block", "tiles", "tile", "hub"))
    plain = lambda root: (F.lit(0).alias("other"), "tile", F.lit(True).alias("asks"), root.alias("root"))
    own = placed.where("tiles = 1 or number <> hub").select("number", "n", "block", *plain(F.col("number")))
    sent = shape.where("tiles > 1").select(F.col("hub").alias("number"), F.col("hub_n").alias("n"), "block", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile"))
    first = _confirmed(base, own.unionByName(sent.select("number", "n", "block", *plain(F.col("number")))), threshold)
    large = placed.where("tiles > 1")
    if large.limit(1).count() == 0:
        return first

    # blocks of several tiles: what isn't in the greatest component of its block meets all tiles
    roots = connected_components(first).withColumnRenamed("node", "number")
    large = stored(large.join(roots, "number", "left").withColumn("root", F.coalesce("root", "number")))
    greatest = large.groupBy("block", "root").agg(F.count(F.lit(1)).alias("sets")).groupBy("block").agg(F.max(F.struct("sets", F.col("root").alias("most"))).alias("g"))
    copies = greatest.select("block", "g.most").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    large = stored(salted(large).join(copies, ["block", "salt"]).withColumn("out", F.col("root") != F.col("most")))
    others = large.where("out").groupBy("block").agg(tiles.alias("others"))
    copies = stored(others).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = large.join(copies, ["block", "salt"])
    place = F.pmod(F.xxhash64("number"), F.col("others")).cast("int")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    asked = met.where("out").select("number", "n", "block", place.alias("other"), F.explode(upto("tiles")).alias("tile"), F.lit(True).alias("asks"), "root")
    # those that ask are members of their tiles, too
    asking = met.select("number", "n", "block", F.explode(upto("others")).alias("other"), "tile", F.lit(False).alias("asks"), "root")
    return first.unionByName(_confirmed(base, asked.unionByName(asking), threshold))


def minhash_components(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", threshold: int = THRESHOLD, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) in a struct ``row``; n_shingles; and
    component_id (the least id of the component; the own id for empty sets)."""
    base = numbered(docs, keep, text_col, F.col(id_col).alias("id"))
    signed = _signed(base)
    # the row that stands for a class is one that has a signature: the first of each task has
    named = signed.select("number", "n", "class", F.when(F.col("keys").isNotNull(), F.col("number")).alias("signed"))
    own = _told(named, "class", F.min("signed").alias("least"))
    own = stored(own.select("number", F.coalesce("least", "number").alias("node"), "n"))
    # the filter lets few rows pass that don't stand for their class: they are sets like any other, equal to the one that does
    nodes = stored(_only(signed.where("keys is not null").select("number", "n", "signature", "keys"), own.where("number = node").select("number")))
    links = _links(base, nodes, _candidates(nodes, threshold), threshold)
    roots = connected_components(links)

    # rows of a class share its node, nodes of a component its root; the rows themselves join last, and once
    placed = own.join(roots, "node", "left").select("number", "n", F.coalesce("root", "node").alias("root"))
    placed = stored(placed.join(base.select("number", "id"), "number"))
    found = _told(placed, "root", F.min("id").alias("component")).select(
        "number", "n", F.when(F.col("members").isNull(), F.col("id")).otherwise(F.col("component")).alias("component_id"))
    return base.select("number", "row", "id").join(found, "number", "left").select(
        "row", F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"), F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


def op11_minhash(spark, sf_dir: str) -> DataFrame:
    """All documents with the component that links of at least 0.8 join them in."""
    out = minhash_components(documents(spark, sf_dir), keep=["doc_id"])
    return out.select("row.doc_id", "n_shingles", "component_id", F.col("row.doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OP11_SQL = rf"""
with recursive d as (
    select row_number() over () r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') w from documents),
s as (select distinct r, len(w[pos:pos + {SHINGLE - 1}]) k, array_to_string(w[pos:pos + {SHINGLE - 1}], ' ') g from (select r, w, unnest(range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1)) pos from d where len(w) > 0)),
n as (select r, count(*) n from s group by r),
o as (select a.r a, b.r b, count(*) o from s a join s b on a.k = b.k and a.g = b.g and a.r < b.r group by all),
l as (select a, b from o join n x on x.r = a join n y on y.r = b where 100 * o >= {THRESHOLD} * (x.n + y.n - o)),
e as (select a, b from l union all select b, a from l),
c as (select r a, r b from d union select c.a, e.b from c join e on c.b = e.a),
i as (select d.doc_id, coalesce(n.n, 0)::bigint n_shingles, (select min(y.doc_id) from c join d y on y.r = c.b where c.a = d.r) component_id
      from d left join n on n.r = d.r)
select *, doc_id is not distinct from component_id kept from i
"""
