"""Whitening of embeddings by the eigenvectors of their covariance.

Every entry c of a vector becomes the integer floor(64 c) + 1,000,000. The distinct
integer vectors (the fit list) have n members, sums S and the covariance V, divisor
n. A vector's whitened coordinate k is its distance from S / n along eigenvector k of
V over the root of eigenvalue k, so that the fit list's whitened covariance is the
identity.

1. Vectors are packed in the narrowest integers that hold them and grouped, which
   combines copies within tasks first; the distinct ones are stored with the number of
   rows that have them.
2. One pass sums them in integers; a second one centres them (n x - S in integers,
   then over n) and multiplies blocks of them with themselves. Tasks add what they
   have with the rounding error beside it, and hand on one matrix each, which further
   tasks add in two steps: the driver gets one matrix of d x d, whatever the rows.
3. The driver solves V in float32. Ogita-Aishima steps (four matrix products each)
   correct these eigenvectors in float64 and at last in extended precision, where
   each step squares the error. Eigenvalues too close together for a step are a
   cluster: V is projected on the cluster's eigenvectors, shifted by its mean, which
   makes the differences large beside the rounding, and solved there.
4. A last pass over the fit list takes the covariance of its whitened vectors; the
   rows of the table are projected as they are read.

Defined cases: null vectors and vectors with a null, NaN or infinite entry are
dropped. Vectors should be of one length; if they aren't, those of the most
frequent length (of the longest of these) stay and the others are dropped. Repeated
rows and ids stay rows of their own and count once in the fit. Eigenvalues that are
0 but for rounding have no whitened coordinate and give no rows: a table of one
distinct vector gives none. An empty table gives an empty result. Equal
eigenvalues have eigenvectors that are one choice of many, the same for all rows;
signs are such that an eigenvector's largest entry is positive. Entries beyond 2^33,
deviations beyond 64 bits and vectors over MAX_DIMENSIONS are an error that says so.
All columns are carried in ``row``, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.common import quoted, row_of, stored
from basketry.sources.tables import table

#: Fixed by the contract: entries are rounded down to 1 / SCALE and moved by OFFSET.
SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: The covariance of so many dimensions (128 MB) is what the driver holds at most.
MAX_DIMENSIONS = 4096
#: Vectors that are multiplied at once, and tasks that add up what the first ones found.
BLOCK_ROWS, ADDING_TASKS = 4096, 16
#: An eigenvalue of this share of the largest one, for each dimension, is none but rounding.
NO_VALUE = 1e-15
#: Values nearer to each other than so many times the error of a step are a cluster.
SURE = 16
_KINDS = (np.int8, np.int16, np.int32, np.int64)


def _matrices(values: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of the lists: their places, and a matrix of their entries."""
    flat = np.asarray(values.flatten())
    lengths = np.asarray(values.value_lengths()).astype(np.int64)
    begin = np.cumsum(lengths) - lengths
    for n in np.unique(lengths):
        at = np.flatnonzero(lengths == n)
        yield at, flat[begin[at][:, None] + np.arange(n)]


def integers(entries: np.ndarray) -> np.ndarray:
    """floor(64 c) + 1,000,000 of finite entries."""
    x = np.floor(SCALE * entries)
    if len(x) and x.size and np.abs(x).max() > 2.0**39:
        raise ValueError("whitening: an entry is beyond 2^33")
    return x.astype(np.int64) + OFFSET


def packed(x: np.ndarray) -> list[bytes]:
    """Rows of integers, each in the narrowest type that holds it; equal rows have equal bytes."""
    y = x - OFFSET
    low, high = y.min(1), y.max(1)
    out: list[bytes] = [b""] * len(y)
    kind = np.searchsorted([np.iinfo(k).max for k in _KINDS], np.maximum(high, -1 - low))
    for k in np.unique(kind):
        at = np.flatnonzero(kind == k)
        width = x.shape[1] * np.dtype(_KINDS[k]).itemsize
        together = y[at].astype(_KINDS[k]).tobytes()
        for i, p in enumerate(at.tolist()):
            out[p] = together[i * width:(i + 1) * width]
    return out


def unpacked(rows: list[bytes], d: int) -> np.ndarray:
    """The integers of ``packed`` rows of ``d`` entries."""
    out = np.empty((len(rows), d), np.int64)
    widths = np.array([len(r) // d for r in rows])
    for w in np.unique(widths):
        at = np.flatnonzero(widths == w)
        out[at] = np.frombuffer(b"".join([rows[i] for i in at]), f"<i{w}").reshape(-1, d)
    return out + OFFSET


def _clean(vectors: DataFrame, vector_col: str, keep: list[str] | None) -> DataFrame:
    """(row, vector) of the rows whose entries are all there and finite."""
    vector = quoted(vector_col).cast("array<double>")
    finite = F.forall("vector", lambda c: c.isNotNull() & (F.abs(c) < F.lit(math.inf)))
    return vectors.select(row_of(vectors, keep), vector.alias("vector")).where(F.col("vector").isNotNull() & finite)


def fit_list(vectors: DataFrame, vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """(packed, rows): the distinct integer vectors of the most frequent length, stored, and that length (0: none)."""
    def run(batches):
        for batch in batches:
            column = batch.column(0)
            size, rows = np.zeros(len(column), np.int32), [b""] * len(column)
            for at, entries in _matrices(column):
                size[at] = entries.shape[1]
                if entries.shape[1]:
                    for p, r in zip(at.tolist(), packed(integers(entries))):
                        rows[p] = r
            yield pa.RecordBatch.from_arrays([pa.array(size), pa.array(rows, pa.binary())], names=["size", "packed"])

    each = _clean(vectors, vector_col, []).select("vector").mapInArrow(run, "size int, packed binary")
    fit = stored(each.groupBy("size", "packed").agg(F.count(F.lit(1)).alias("rows")))
    most = fit.groupBy("size").agg(F.sum("rows").alias("rows")).orderBy(F.desc("rows"), F.desc("size")).limit(1).collect()
    d = most[0]["size"] if most else 0
    if d > MAX_DIMENSIONS:
        raise ValueError(f"whitening: {d} dimensions are over {MAX_DIMENSIONS}")
    return fit.where(F.col("size") == d).select("packed", "rows"), d


def _plus(total: np.ndarray, error: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Add ``more`` and keep what rounding lost."""
    new = total + more
    part = new - total  # of integers, all of ``more``: the error stays 0
    return new, error + ((total - (new - part)) + (more - part))


def _summed(fit: DataFrame, per_block, shape: tuple[int, ...], kind) -> np.ndarray:
    """The sum of ``per_block`` over the fit list, in blocks: by tasks, then by fewer, then by one."""
    d_total, d_error = np.zeros(shape, kind), np.zeros(shape, kind)

    def handed(total, error):
        return pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary()), pa.array([error.tobytes()], pa.binary())], names=["total", "error"])

    def first(batches):
        total, error, some = d_total, d_error, False
        for batch in batches:
            rows = batch.column(0).to_pylist()
            for k in range(0, len(rows), BLOCK_ROWS):
                total, error, some = *_plus(total, error, per_block(rows[k:k + BLOCK_ROWS])), True
        if some:
            yield handed(total, error)

    def then(batches):
        total, error, some = d_total, d_error, False
        for batch in batches:
            for a, b in zip(batch.column(0), batch.column(1)):
                read = [np.frombuffer(x.as_buffer(), kind).reshape(shape) for x in (a, b)]
                total, error = _plus(total, error, read[0])
                error, some = error + read[1], True
        if some:
            yield handed(total, error)

    schema = "total binary, error binary"
    sums = fit.select("packed").mapInArrow(first, schema)
    for tasks in (ADDING_TASKS, 1):
        sums = sums.repartition(tasks).mapInArrow(then, schema)
    got = sums.collect()  # one row
    if not got:
        return d_total
    total, error = (np.frombuffer(x, kind).reshape(shape) for x in got[0])
    return total if kind is np.int64 else total.astype(np.longdouble) + error


def _clusters(values: np.ndarray, least: float) -> list[np.ndarray]:
    """Places of values, each within ``least`` of the next one; groups of two and more."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > least) + 1
    return [c for c in np.split(order, cuts) if len(c) > 1]


def _slices(m: np.ndarray, axis: int, bits: int) -> list[np.ndarray]:
    """``m`` as a sum of three float64 matrices, each of so many bits below the largest entry along ``axis``."""
    out = []
    for _ in range(3):
        top = np.abs(m).max(axis, keepdims=True)
        unit = np.ldexp(np.ones_like(top), np.frexp(top)[1] - bits)
        part = np.rint(m / unit) * unit
        out.append(part.astype(np.float64))
        m = m - part
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Matrix product; in extended precision by float64 products of slices, short enough to have no rounding."""
    if a.dtype == np.float64:
        return a @ b
    bits = (53 - a.shape[1].bit_length()) // 2
    rows, columns = _slices(a, 1, bits), _slices(b, 0, bits)
    out = np.zeros((a.shape[0], b.shape[1]), a.dtype)
    for i, j in ((2, 0), (1, 1), (0, 2), (1, 0), (0, 1), (0, 0)):  # small ones first
        out += rows[i] @ columns[j]
    return out


def refined(a: np.ndarray, x: np.ndarray, steps: int, enough: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and corrected eigenvectors (columns) of ``a`` from approximate ones, in the precision of ``a``."""
    one, size = np.eye(len(a), dtype=a.dtype), np.sqrt((a * a).sum())
    x = x.astype(a.dtype)
    for _ in range(steps):
        r = one - product(x.T, x)
        s = product(x.T, product(a, x))
        s = (s + s.T) / 2  # else a step over a small gap turns rounding into lost orthogonality
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        least = SURE * (np.sqrt((off * off).sum()) + size * np.sqrt((r * r).sum()))
        close, apart = _clusters(values, least), ~np.eye(len(a), dtype=bool)
        for at in close:
            apart[np.ix_(at, at)] = False
        gap = np.where(apart, values[None, :] - values[:, None], 1)
        step = np.where(apart, (s + values[None, :] * r) / gap, r / 2)
        x = x + product(x, step)
        for at in close:
            part = x[:, at]
            shift = values[at].mean()
            small = product(part.T, product(a, part) - shift * part)
            small = (small + small.T) / 2
            most = np.abs(small).max()
            if most > 0:
                x[:, at] = product(part, np.linalg.eigh((small / most).astype(np.float64))[1].astype(a.dtype))
        if not close and np.abs(step).max() < enough:
            break
    return (x * product(a, x)).sum(0) / (x * x).sum(0), x


def eigen(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors (columns) of a symmetric matrix, to double precision."""
    most = np.abs(v).max()
    if not most > 0:
        return np.zeros(len(v)), np.eye(len(v))
    a = (v / most).astype(np.longdouble)
    a = (a + a.T) / 2
    x = np.linalg.eigh(a.astype(np.float32))[1]
    x = refined(a.astype(np.float64), x, 8, 1e-9)[1]
    values, x = refined(a, x, 16, 1e-16)
    order = np.argsort(-values, kind="stable")
    values, x = values[order], x[:, order] / np.sqrt((x[:, order] ** 2).sum(0))
    signs = np.sign(x[np.abs(x).argmax(0), np.arange(len(x))])
    return (values * most).astype(np.float64), (x * signs).astype(np.float64)


@dataclass(frozen=True)
class Whitening:
    """What rows are whitened with: count and integer sums of the fit list, eigenvalues, eigenvectors by column."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n: the difference in integers, rounded once."""
        return self._scaled(x) / self.n

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        """n x - S, as n (x - c) + (n c - S) with c the mean rounded down, so that it fits 64 bits for long."""
        if not x.size:
            return x
        c = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([self.n * (s // self.n) - s for s in self.sums], np.int64)
        y = x - c
        if (max(int(y.max()), -int(y.min())) + 1) * self.n >= 2**63:
            y = y.astype(object)
        return self.n * y + rest

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x).astype(np.float64) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """Sums of (n x - S)^2, exact."""
        y = self._scaled(x)
        if y.size and max(int(y.max()), -int(y.min())) >= math.isqrt(2**63 // x.shape[1]):
            y = y.astype(object)
        out = (y * y).sum(1)
        if len(out) and int(out.max()) >= 2**63:
            raise ValueError("whitening: a deviation is over 64 bits")
        return out.astype(np.int64)


def fit(vectors: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Learn from the distinct integer vectors of a table."""
    found, d = fit_list(vectors, vector_col)
    n = found.count() if d else 0
    none = Whitening(n, [0] * d, np.zeros(0), np.zeros((d, 0)), np.zeros(0), 0.0)
    if n < 2:
        return none

    def halves(rows):
        y = unpacked(rows, d) - OFFSET
        return np.stack([(y >> 20).sum(0), (y & (2**20 - 1)).sum(0)])

    high, low = _summed(found, halves, (2, d), np.int64).tolist()
    sums = [(h << 20) + x + n * OFFSET for h, x in zip(high, low)]
    base = Whitening(n, sums, *[np.zeros(0)] * 3, 0.0)

    def squares(rows):
        y = base.centred(unpacked(rows, d)).astype(np.float64)
        return y.T @ y

    v = _summed(found, squares, (d, d), np.float64) / n
    values, x = eigen(v)
    k = min(components, int((values > NO_VALUE * d * values[0]).sum()))
    if not k:
        return none
    model = Whitening(n, sums, values[:k], x[:, :k], values[:k] / float(np.trace(v)), 0.0)

    def whitened_squares(rows):
        w = model.project(unpacked(rows, d))
        return np.vstack([w.sum(0), w.T @ w])

    got = _summed(found, whitened_squares, (k + 1, k), np.float64) / n
    error = np.abs(got[1:] - np.outer(got[0], got[0]) - np.eye(k)).max()
    return Whitening(n, sums, model.values, model.vectors, model.explained, float(error))


def whiten(vectors: DataFrame, model: Whitening, vector_col: str = "embedding", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) in a struct ``row``; ``deviation``; and ``whitened``, the list of coordinates."""
    d = len(model.sums)
    base = _clean(vectors, vector_col, keep).where(F.size("vector") == d)

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(k, BLOCK_ROWS)
                x = integers(np.asarray(part.column(1).flatten()).reshape(-1, d)) if d else np.zeros((part.num_rows, 0), np.int64)
                w = np.ascontiguousarray(model.project(x))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.deviations(x)), lists], names=["row", "deviation", "whitened"])

    schema = T.StructType([base.schema["row"], T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    return base.mapInArrow(run, schema)


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    """All clean embeddings by their first 16 components."""
    vectors = table(spark, sf_dir, "embeddings")
    model = fit(vectors)
    out = whiten(vectors, model, keep=["vec_id"]).select("row.vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*[F.lit(float(e)) for e in model.explained]).cast("array<double>")
    return out.select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )
