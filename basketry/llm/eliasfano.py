"""Elias-Fano sequences over numpy arrays, and the n-gram trie made of them.

A monotone sequence of n values below u is kept as the low ``log2(u / n)`` bits of
each, packed, and the high parts in unary: bit ``(value >> low) + index`` is set. A
directory counts the set bits before each block of BLOCK bits. All operations take
arrays of arguments and work on them at once.
"""

from __future__ import annotations

import mmap
import tempfile

import numpy as np

#: Bits that the directory counts together: those of one word.
BLOCK = 64
_PLACES = np.array([[k for k in range(8) if b >> k & 1] + [8] * (8 - bin(b).count("1")) for b in range(256)], np.int64)
_BYTES, _TOPS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
_HALVES = [np.uint64(int(x * 8, 16)) for x in ("55", "33", "0f")]


def _select(words: np.ndarray, before: np.ndarray, k: np.ndarray, flip: bool) -> np.ndarray:
    """Place of the k-th (from 0) set bit, or with ``flip`` of the k-th clear one; ``before`` counts them at each word."""
    at = np.searchsorted(before, k, side="right") - 1
    left = (k - before[at]).astype(np.uint64)
    word = ~words[at] if flip else words[at]
    # set bits of each byte, then of all bytes up to each
    upto = word - ((word >> np.uint64(1)) & _HALVES[0])
    upto = (upto & _HALVES[1]) + ((upto >> np.uint64(2)) & _HALVES[1])
    upto = ((upto + (upto >> np.uint64(4))) & _HALVES[2]) * _BYTES
    # bytes that end before the bit
    shift = np.bitwise_count(((left * _BYTES) | _TOPS) - upto & _TOPS).astype(np.uint64) << np.uint64(3)
    left -= ((upto << np.uint64(8)) >> shift) & np.uint64(255)
    byte = (word >> shift) & np.uint64(255)
    return at * 64 + shift.astype(np.int64) + _PLACES.ravel()[(byte << np.uint64(3) | left).astype(np.int64)]


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The value of each run of equal neighbours, and the run of each place."""
    new = np.r_[True, x[1:] != x[:-1]] if len(x) else np.zeros(0, bool)
    return x[new], np.cumsum(new) - 1


class EliasFano:
    """A monotone sequence; made with ``build`` or from its arrays."""

    FIELDS = ("shape", "high", "ones", "low")

    def __init__(self, shape, high, ones, low):
        self.shape, self.high, self.ones, self.low = shape, high, ones, low
        self.before = ones.astype(np.int64)
        self.zeros = np.arange(len(ones)) * BLOCK - self.before
        self.n, self.bits, self.buckets = (int(x) for x in shape)

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n, top = len(values), int(values[-1]) + 1 if len(values) else 1
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        buckets = (top >> bits) + 1
        size = -(-(n + buckets + 1) // BLOCK) * BLOCK
        flags = np.zeros(size, np.uint8)
        flags[(values >> bits) + np.arange(n)] = 1
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        count = flags.reshape(-1, BLOCK).sum(1, dtype=np.int64)
        ones = np.r_[0, np.cumsum(count)].astype(np.uint32 if size < 2**32 else np.int64)
        low = np.zeros(-(-n * bits // 64) + 1, np.uint64)
        if bits:
            part = (values & ((1 << bits) - 1)).astype(np.uint64)
            start = np.arange(n) * bits
            shift = (start % 64).astype(np.uint64)
            np.bitwise_or.at(low, start // 64, part << shift)
            over = np.flatnonzero(start % 64 + bits > 64)
            np.bitwise_or.at(low, start[over] // 64 + 1, part[over] >> (np.uint64(64) - shift[over]))
        return cls(np.array([n, bits, buckets], np.int64), high, ones, low)

    def low_part(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.int64)
        start = i * self.bits
        shift = (start % 64).astype(np.uint64)
        word = self.low[start // 64] >> shift
        # a shift by 64 isn't defined: two steps
        word |= (self.low[np.minimum(start // 64 + 1, len(self.low) - 1)] << (np.uint64(63) - shift)) << np.uint64(1)
        return (word & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def access(self, i: np.ndarray) -> np.ndarray:
        """The values at ``i``."""
        return ((_select(self.high, self.before, i, False) - i) << self.bits) | self.low_part(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Index of the first value of at least ``x``; n if there is none."""
        return self.located(x)[0]

    def located(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``successor``, and whether the value there is ``x``."""
        h, where = _runs(x >> self.bits)
        inside = h < self.buckets
        h = np.where(inside, h, 0)
        # values with high part h stand between the zeros h - 1 and h
        first = np.where(h > 0, _select(self.high, self.zeros, np.maximum(h - 1, 0), True) + 1 - h, 0)
        end = _select(self.high, self.zeros, h, True) - h
        inside, found, end = inside[where], first[where], end[where]
        last, wanted = end, x & ((1 << self.bits) - 1)
        open_ = np.flatnonzero(found < end)
        while len(open_):  # binary search among the low parts
            mid = (found[open_] + end[open_]) >> 1
            less = self.low_part(mid) < wanted[open_]
            found[open_[less]] = mid[less] + 1
            if last is end:
                end = end.copy()
            end[open_[~less]] = mid[~less]
            open_ = open_[found[open_] < end[open_]]
        equal = inside & (found < last)
        equal[equal] = self.low_part(found[equal]) == wanted[equal]
        return np.where(inside, found, self.n), equal


def children(parents: int, parent: np.ndarray, child: np.ndarray) -> tuple[EliasFano, EliasFano]:
    """A level of a trie from its nodes, sorted by (parent, child): where each parent's children begin, and the
    children, made monotone by adding the last value before their parent's first one."""
    begin = np.searchsorted(parent, np.arange(parents + 1))
    has = np.flatnonzero(np.diff(begin))
    last = child[begin[has + 1] - 1] + 1
    base = np.zeros(parents, np.int64)
    base[has] = np.r_[0, np.cumsum(last)[:-1]]
    return EliasFano.build(begin), EliasFano.build(base[parent] + child + 1)


def find_child(pointers: EliasFano, values: EliasFano, parent: np.ndarray, child: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each (parent, child) its node or -1, and where the parent's children begin."""
    own, where = _runs(parent)
    begin, end = pointers.access(own), pointers.access(own + 1)
    base = np.zeros(len(own), np.int64)
    some = begin > 0
    base[some] = values.access(begin[some] - 1)
    begin, end = begin[where], end[where]
    at, equal = values.located(base[where] + child + 1)
    return np.where(equal & (at >= begin) & (at < end), at, -1), begin


def packed(arrays: dict[str, np.ndarray]) -> tuple[bytes, list[tuple]]:
    """Arrays one after the other, and (name, type, start, length) of each."""
    out, index, at = [], [], 0
    for name, x in arrays.items():
        raw = np.ascontiguousarray(x).tobytes()
        raw += b"\0" * (-len(raw) % 64)
        index.append((name, x.dtype.str, at, len(x)))
        out.append(raw)
        at += len(raw)
    return b"".join(out) or b"\0", index


def mapped(raw: bytes, index: list[tuple]) -> dict[str, np.ndarray]:
    """The arrays on a memory-mapped file of the task, which has no name any more and goes with the mapping."""
    with tempfile.TemporaryFile() as f:
        f.write(raw)
        f.flush()
        view = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    return {name: np.frombuffer(view, kind, n, start) for name, kind, start, n in index}
