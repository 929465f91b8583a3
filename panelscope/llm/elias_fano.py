"""Elias-Fano sequences and the n-gram trie made of them.

A sequence of n non-decreasing numbers up to u keeps the low log2(u / n) bits of each
packed, and the high bits as a bit vector with a one for each number and a zero
for each step of the high part: some 2 + log2(u / n) bits a number. Everything is an array in one stretch
of bytes, read in place (a file can be memory-mapped, a Spark binary value is used as it
lies), and every query works on whole arrays of arguments.
"""

from __future__ import annotations

import mmap
from collections.abc import Sequence

import numpy as np

_POPULATION = np.array([bin(b).count("1") for b in range(256)], np.int64)
#: Of each byte: where its k-th one is.
_NTH = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[:8] for b in range(256)], np.int64)


def _aligned(data: bytes) -> bytes:
    return data + bytes(-len(data) % 8)


def encoded(values: np.ndarray) -> bytes:
    """Bytes of the sequence: n, low bits of each, words of high bits; the low bits; the high bits; ones before each word of them."""
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    top = int(values[-1]) if n else 0
    low = max(0, (top // n).bit_length() - 1) if n else 0
    bits = np.zeros(n * low + 7 >> 3, np.uint8)
    if low:
        part = (values & np.uint64((1 << low) - 1))[:, None] >> np.arange(low, dtype=np.uint64) & np.uint64(1)
        bits = np.packbits(part.astype(np.uint8).ravel(), bitorder="little")
    words = (n + (top >> low) + 64) // 64
    high = np.zeros(words * 64, np.uint8)
    high[(values >> np.uint64(low)).astype(np.int64) + np.arange(n)] = 1
    upper = np.packbits(high, bitorder="little")
    ones = np.concatenate([[0], np.cumsum(high.reshape(-1, 64).sum(axis=1, dtype=np.int64))[:-1]]).astype(np.uint32 if n < 1 << 32 else np.uint64)
    head = np.array([n, low, words, len(bits), ones.itemsize], np.uint64).tobytes()
    return b"".join(_aligned(x) for x in (head, bits.tobytes() + bytes(8), upper.tobytes(), ones.tobytes()))


class Sequence64:
    """A sequence read from bytes that stay where they are."""

    def __init__(self, data: memoryview, at: int = 0):
        self.n, self.low, words, n_bits, item = (int(x) for x in np.frombuffer(data, np.uint64, 5, at))
        at += 40
        self.bits = np.frombuffer(data, np.uint8, n_bits + 8, at)
        at += n_bits + 8 + -(n_bits + 8) % 8
        self.upper = np.frombuffer(data, np.uint8, words * 8, at).reshape(-1, 8)
        at += words * 8
        self.ones = np.frombuffer(data, np.uint32 if item == 4 else np.uint64, words, at)
        self.end = at + words * item + -(words * item) % 8
        self._zeros: np.ndarray | None = None

    def _select(self, before: np.ndarray, flip: int, k: np.ndarray) -> np.ndarray:
        """Where the k-th one (flip 0) or zero (flip 255) of the high bits is."""
        word = np.searchsorted(before, k.astype(before.dtype), "right") - 1
        rest = k - before[word].astype(np.int64)
        row = self.upper[word] ^ np.uint8(flip)
        upto = np.cumsum(_POPULATION[row], axis=1)
        byte = np.minimum((upto <= rest[:, None]).sum(axis=1), 7)
        at = np.arange(len(k))
        rest -= np.where(byte > 0, upto[at, byte - 1], 0)
        return word * 64 + byte * 8 + _NTH[row[at, byte], np.clip(rest, 0, 7)]

    def _low_of(self, i: np.ndarray) -> np.ndarray:
        if not self.low:
            return np.zeros(len(i), np.uint64)
        bit = i * self.low
        byte = bit >> 3
        out = np.zeros(len(i), np.uint64)
        for k in range((self.low + 14) // 8):
            out |= self.bits[byte + k].astype(np.uint64) << np.uint64(8 * k) if k < 8 else np.uint64(0)
        return (out >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.low) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at places i."""
        i = np.asarray(i, np.int64)
        high = self._select(self.ones, 0, i) - i
        return high.astype(np.uint64) << np.uint64(self.low) | self._low_of(i)

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Place of the first value that is not below x (n if there is none)."""
        x = np.asarray(x, np.uint64)
        if not self.n:
            return np.zeros(len(x), np.int64)
        if self._zeros is None:
            self._zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones.astype(np.int64)
        most = len(self.ones) * 64 - self.n  # zeros in all
        high = (x >> np.uint64(self.low)).astype(np.int64)
        beyond = high >= most
        high = np.where(beyond, 0, high)
        lo = np.where(high > 0, self._select(self._zeros, 255, np.maximum(high - 1, 0)) - high + 1, 0)
        hi = self._select(self._zeros, 255, high) - high
        want = x & np.uint64((1 << self.low) - 1)
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            mid = (lo[open_] + hi[open_]) >> 1
            less = self._low_of(mid) < want[open_]
            lo[open_] = np.where(less, mid + 1, lo[open_])
            hi[open_] = np.where(less, hi[open_], mid)
            open_ = open_[lo[open_] < hi[open_]]
        return np.where(beyond, self.n, np.minimum(lo, self.n))


def on_grid(values: np.ndarray, floor: float, codes: int) -> tuple[np.ndarray, np.ndarray]:
    """A code for each value between `floor` and 0 and the value of each code: the nearest of as many evenly spaced ones, the same for everyone."""
    book = np.linspace(0.0, floor, codes)
    step = floor / (codes - 1) or -1.0
    return np.clip(np.rint(np.asarray(values, np.float64) / step), 0, codes - 1).astype(np.uint8), book


class Trie:
    """Levels of n-grams. A node's children are a range of the next level, between two monotone pointers.

    A level's ids are made non-decreasing by adding, in each range of siblings, the last number of the range before;
    an id is found as the successor of id plus that number, relative to its context's range.
    Each level has quantised values: a code for each node and a book of the codes' values."""

    def __init__(self, data: bytes | memoryview | mmap.mmap):
        data = memoryview(data)
        depth = int(np.frombuffer(data, np.uint64, 1)[0])
        at = 8
        self.ids: list[Sequence64] = []
        self.pointers: list[Sequence64] = []
        self.codes: list[np.ndarray] = []
        self.books: list[np.ndarray] = []
        for k in range(depth):
            self.ids.append(Sequence64(data, at))
            at = self.ids[-1].end
            if k + 1 < depth:
                self.pointers.append(Sequence64(data, at))
                at = self.pointers[-1].end
            n, m = self.ids[-1].n, int(np.frombuffer(data, np.uint64, 1, at)[0])
            self.books.append(np.frombuffer(data, np.float64, m, at + 8))
            at += 8 + 8 * m
            self.codes.append(np.frombuffer(data, np.uint8, n, at))
            at += n + -n % 8

    @staticmethod
    def mapped(path: str) -> Trie:
        """A trie in a file, memory-mapped."""
        with open(path, "rb") as f:
            return Trie(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    @staticmethod
    def image(ids: Sequence[np.ndarray], starts: Sequence[np.ndarray], values: Sequence[tuple[np.ndarray, np.ndarray]]) -> bytes:
        """Bytes of a trie. Of each level: ids, ascending in each range of siblings; of each but the last: where the children of each of
        its nodes start in the next, and the end; the nodes' codes and the book of their values."""
        out = [np.array([len(ids)], np.uint64).tobytes()]
        for k, own in enumerate(ids):
            own = np.asarray(own, np.uint64)
            cuts = np.array([0, len(own)]) if k == 0 else np.asarray(starts[k - 1], np.int64)
            some = np.flatnonzero(np.diff(cuts) > 0)
            last = own[cuts[some + 1] - 1]
            base = np.concatenate([[0], np.cumsum(last, dtype=np.uint64)[:-1]]).astype(np.uint64) if len(some) else np.zeros(0, np.uint64)
            out.append(encoded(own + np.repeat(base, np.diff(cuts)[some])))
            if k + 1 < len(ids):
                out.append(encoded(np.asarray(starts[k], np.uint64)))
            code, book = values[k]
            out += [np.array([len(book)], np.uint64).tobytes(), book.astype(np.float64).tobytes(), _aligned(code.tobytes())]
        return b"".join(out)

    def find(self, *ids: np.ndarray) -> list[np.ndarray]:
        """Nodes on the path of each n-gram, one array for each id given; -1 from the first id that is not there."""
        nodes: list[np.ndarray] = []
        for k, want in enumerate(ids):
            want = np.asarray(want, np.uint64)
            level, found = self.ids[k], np.full(len(want), -1, np.int64)
            alive = np.arange(len(want)) if k == 0 else np.flatnonzero(nodes[-1] >= 0)
            if len(alive) and level.n:
                if k == 0:
                    lo, hi = np.zeros(len(alive), np.int64), np.full(len(alive), level.n)
                else:
                    up, of = np.unique(nodes[-1][alive], return_inverse=True)
                    lo, hi = (self.pointers[k - 1].get(up + d).astype(np.int64)[of] for d in (0, 1))
                base = np.zeros(len(alive), np.uint64)
                later = np.flatnonzero(lo > 0)
                if len(later):
                    edge, of = np.unique(lo[later], return_inverse=True)
                    base[later] = level.get(edge - 1)[of]
                target = base + want[alive]
                at = np.maximum(level.successor(target), lo)
                inside = np.flatnonzero(at < hi)
                hit = inside[level.get(at[inside]) == target[inside]]
                found[alive[hit]] = at[hit]
            nodes.append(found)
        return nodes

    def value(self, level: int, nodes: np.ndarray) -> np.ndarray:
        return self.books[level][self.codes[level][nodes]]
