"""Hierarchical multi-length packing of tokenised documents.

A document's ids are those of a public tokenizer, then END. Full windows of the
longest tier (2048 ids) are cut off first and are sequences as they are. What is
left routes the document to the smallest of the tiers 256, 512, 1024 and 2048
that holds it. Each task packs the remainders of what it has gathered (POOL ids or so
with the windows, then again): the longest tier first, largest piece first; the gap of each window
is filled with the longest waiting pieces of the shorter tiers that fit, and a
last gap by cutting one piece in two. What then remains of a shorter tier is
packed into full windows of that tier. Sequences of a tier's length are full or
shorter than 2048 by no more than what one task has left at its end; that rest
is cut at powers of two, so it needs no padding either.

The sequences of each tier of a pool are dealt into step groups of at most
GROUP_TOKENS ids, as many as the pool's total asks for: the heaviest first to the
group with the fewest ids of that tier, so that a training step reads equally many
ids of each tier from every group of a pool, but for one sequence of the tier.

A task packs its own rows, so no text or id is shuffled, and a lost task packs
the same rows again into the same sequences. Sequence ids hold the partition.

Tokenising goes word by word (runs without ASCII white space; the tokenizer
drops white space and joins nothing across it) through a cache of words that is bounded in bytes.

Edge cases: a null or empty text, or one without words, is the single id END.
Repeated rows are documents of their own. Other columns are not read.
"""

from __future__ import annotations

import heapq
import json
import os
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscope.llm.memory import giving_back

TIERS = (2048, 1024, 512, 256)
END = 1
POOL = 1 << 20  # ids that a task gathers before it packs; at 4 bytes each
CACHE_BYTES = 88 << 20  # of words and their ids, kept by a worker over its tasks
WORD_BYTES = 200  # of a word in it, besides its bytes and ids
GROUP_TOKENS = 1 << 17


def _byte_letters() -> dict[int, int]:
    """Byte-level BPE's letter for each byte: printable Latin-1 stands for itself, the others for 256, 257, ... in order."""
    itself = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in itself]
    return {**{b: b for b in itself}, **{b: 256 + k for k, b in enumerate(other)}}


class Words:
    """Ids of words (runs without ASCII white space) from a bounded cache.

    Words of plain Latin letters, digits and signs are lower-cased and split
    here by the tokenizer file's own pattern, and the tokenizer's model encodes
    the parts; any other word goes through the whole tokenizer.
    """

    _plain = regex.compile(r"[\x21-\x7e\xa1-\u017f]+")

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            steps = json.load(f)
        kinds = [s["type"] for s in steps["normalizer"].get("normalizers", [])] if steps["normalizer"] else []
        splits = steps["pre_tokenizer"].get("pretokenizers", [])
        same = kinds == ["NFC", "Replace", "Lowercase"] and [s["type"] for s in splits] == ["Split", "ByteLevel"] and splits[0]["behavior"] == "Removed"
        self.parts = regex.compile(splits[0]["pattern"]["Regex"]) if same else None
        self.special = tuple(t["content"] for t in steps["added_tokens"])
        self.letters = _byte_letters()
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 12, np.int64)  # of each word's ids
        self.uses = np.zeros(1 << 12, np.int64)  # of each word since the cache was last full
        self.n = 0
        self.held = 0  # bytes

    def shrink(self) -> None:
        """Only the words stay that were used again, and of those none if they fill half the cache."""
        again = self.uses[1 : self.n + 1] > 1
        words = [w for w, stays in zip(self.number, again.tolist(), strict=True) if stays]
        at = np.flatnonzero(again) + 1
        sizes = self.ends[at] - self.ends[at - 1]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(self.ends[at - 1] - upto[:-1], sizes) + np.arange(upto[-1])]
        self.clear()
        if sum(map(len, words)) + 4 * len(ids) + WORD_BYTES * len(words) <= CACHE_BYTES // 2:
            self.put(words, ids, sizes)
            self.uses[1 : self.n + 1] = 1

    def encoded(self, words: list[str]) -> Iterator[list[int]]:
        """Ids of each word."""
        together = "".join(words)
        plain = self.parts is not None and not any(t in together for t in self.special)
        all_plain = plain and self._plain.fullmatch(together) is not None
        tokenize, split = self.tokenizer.model.tokenize, self.parts and self.parts.findall
        for word in words:
            if not all_plain and not (plain and self._plain.fullmatch(word)):
                yield self.tokenizer.encode(word, add_special_tokens=False).ids
                continue
            low = word.lower()
            if low.isascii():
                if low.isalpha():
                    yield [t.id for t in tokenize(low)]
                else:
                    yield [t.id for part in split(low) for t in tokenize(part)]
            else:
                yield [t.id for part in split(low) for t in tokenize(part if part.isascii() else part.encode().decode("latin-1").translate(self.letters))]

    def add(self, words: list[bytes]) -> None:
        ids = list(self.encoded(b" ".join(words).decode().split(" ")))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        self.put(words, np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes)

    def put(self, words: list[bytes], flat: np.ndarray, sizes: np.ndarray) -> None:
        used = int(self.ends[self.n])
        while used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.n + len(words) + 1 > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
            self.uses = np.concatenate([self.uses, np.zeros_like(self.uses)])
        self.ids[used : used + len(flat)] = flat
        self.ends[self.n + 1 : self.n + len(words) + 1] = used + np.cumsum(sizes)
        self.number.update(zip(words, range(self.n + 1, self.n + len(words) + 1), strict=True))
        self.n += len(words)
        self.held += sum(map(len, words)) + 4 * len(flat) + WORD_BYTES * len(words)

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each text, END last."""
        if self.held > CACHE_BYTES:
            self.shrink()
        split = [t.split() for t in texts]
        flat = list(chain.from_iterable(split))
        get = self.number.get
        at = np.fromiter((get(w, 0) for w in flat), np.int64, len(flat))
        new = np.flatnonzero(at == 0)
        if len(new):
            missed = [flat[k] for k in new.tolist()]
            self.add(list(dict.fromkeys(missed)))
            at[new] = [get(w) for w in missed]
        self.uses[: self.n + 1] += np.bincount(at, minlength=self.n + 1)
        sizes = self.ends[at] - self.ends[at - 1]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.repeat(self.ends[at - 1] - upto[:-1], sizes) + np.arange(upto[-1])] if len(at) else np.zeros(0, np.uint32)
        cuts = upto[np.concatenate([[0], np.cumsum([len(w) for w in split])]).astype(np.int64)]
        return [np.append(ids[a:b], np.uint32(END)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


_words: dict[str, Words] = {}  # of this worker process, over its tasks


Piece = tuple[int, int, int]  # number of the remainder, first id, past last id


def packed(sizes: list[int], last: bool) -> tuple[list[list[Piece]], list[int]]:
    """Sequences (pieces in order) of remainders of the given sizes, and the remainders kept for the next pool.

    Only the last pool may leave a sequence that is not full; it is cut at powers of two.
    """
    tiers: dict[int, list[tuple[int, int]]] = {t: [] for t in TIERS}
    for k, n in enumerate(sizes):
        tiers[min(t for t in TIERS if n <= t)].append((n, k))
    short = sorted(x for t in TIERS[1:] for x in tiers[t])  # ascending; the longest is last
    begun: dict[int, int] = {}  # where a cut remainder goes on
    out: list[list[Piece]] = []

    def take(n: int, k: int, most: int) -> Piece:
        start = begun.get(k, 0)
        used = min(n, most)
        if used < n:
            begun[k] = start + used
            insort(short, (n - used, k))
        return k, start, start + used

    def fill(sequence: list[Piece], gap: int) -> int:
        while gap and short:
            i = bisect_right(short, (gap, len(sizes))) - 1
            n, k = short.pop(max(i, 0))  # the longest that fits, else the shortest, cut
            sequence.append(take(n, k, gap))
            gap -= sequence[-1][2] - sequence[-1][1]
        return gap

    open_windows = []
    for n, k in sorted(tiers[TIERS[0]], reverse=True):
        sequence = [(k, 0, n)]
        gap = fill(sequence, TIERS[0] - n)
        if gap:
            open_windows.append((gap, sequence))
        else:
            out.append(sequence)
    rest: list[tuple[int, int, int]] = [p for _, s in open_windows for p in s]
    for tier in TIERS[1:]:
        total = sum(n for n, _ in short)
        # Windows of a shorter tier take the pieces routed to it; the shortest tier takes what fills none.
        mine = sum(n for n, _ in short if n > tier // 2) if tier != TIERS[-1] else total
        for _ in range(min(mine, total) // tier):
            sequence: list[Piece] = []
            if fill(sequence, tier):
                raise AssertionError("a counted window is full")
            out.append(sequence)
    rest += [(k, begun.get(k, 0), begun.get(k, 0) + n) for n, k in short]
    whole = {k for k, a, b in rest if a == 0 and b == sizes[k]}
    keep = [] if last else sorted(whole)
    rest = [p for p in rest if last or p[0] not in whole]
    while rest:  # powers of two, longest first
        left = sum(b - a for _, a, b in rest)
        room = TIERS[0] if left >= TIERS[0] else 1 << (left.bit_length() - 1)
        sequence = []
        while room:
            k, a, b = rest.pop(0)
            used = min(room, b - a)
            sequence.append((k, a, a + used))
            if used < b - a:
                rest.insert(0, (k, a + used, b))
            room -= used
        out.append(sequence)
    return out, keep


class Writer:
    """Numbers sequences and makes result rows; deals the sequences of a pool into step groups."""

    def __init__(self, partition: int):
        self.next = partition << 32
        self.rows: list[tuple] = []
        self.first_group = partition << 32

    def pool(self, sequences: list[list[tuple[int, int, np.ndarray, int]]]) -> None:
        totals = [sum(len(p[2]) for p in pieces) for pieces in sequences]
        tiers = [min((t for t in TIERS if n <= t), default=TIERS[0]) for n in totals]
        n_groups = -(-sum(totals) // (GROUP_TOKENS - sum(TIERS)))  # the lightest group of a tier is below its mean, so none passes GROUP_TOKENS
        loads, groups = [0] * n_groups, [0] * len(sequences)
        for tier in TIERS:
            lightest = [(0, load, g) for g, load in enumerate(loads)]  # ids of this tier, of all so far
            heapq.heapify(lightest)
            for k in sorted((k for k, t in enumerate(tiers) if t == tier), key=lambda k: -totals[k]):
                mine, load, g = lightest[0]
                heapq.heapreplace(lightest, (mine + totals[k], load + totals[k], g))
                loads[g] += totals[k]
                groups[k] = self.first_group + g
        self.first_group += n_groups
        for pieces, tier, group in zip(sequences, tiers, groups, strict=True):
            offset = 0
            for doc_id, start, ids, doc_tokens in pieces:
                self.rows.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), doc_tokens, self.next, offset, tier, group))
                offset += len(ids)
            self.next += 1

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [[]] * len(NAMES)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, KINDS, strict=True)], names=NAMES)


NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]
KINDS = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"


def packer(path: str, pool: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words.get(path) or _words.setdefault(path, Words(path))
        context = TaskContext.get()
        out = Writer(context.partitionId() if context else 0)
        waiting: list[tuple[int, int, np.ndarray, int]] = []  # remainders
        windows: list[list[tuple[int, int, np.ndarray, int]]] = []  # full ones, for the next pool
        gathered = 0
        long = TIERS[0]

        def pack(last: bool) -> None:
            nonlocal waiting, windows, gathered
            sequences, keep = packed([len(w[2]) for w in waiting], last)
            out.pool(windows + [[(waiting[k][0], waiting[k][1] + a, waiting[k][2][a:b], waiting[k][3]) for k, a, b in sequence] for sequence in sequences])
            windows = []
            waiting = [waiting[k] for k in keep]
            gathered = sum(len(w[2]) for w in waiting)

        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1)
            lo = 0
            while lo < len(ids):
                hi, size, part = lo, 0, []
                while hi < len(ids) and size < 1 << 19:
                    part.append((texts[hi].as_py() or "").encode())
                    size += len(part[-1])
                    hi += 1
                for doc_id, tokens in zip(ids[lo:hi], words.encode(part), strict=True):
                    full = len(tokens) // long * long
                    for a in range(0, full, long):
                        windows.append([(doc_id, a, tokens[a : a + long], len(tokens))])
                    if full < len(tokens):
                        waiting.append((doc_id, full, tokens[full:].copy(), len(tokens)))
                    gathered += len(tokens)
                if gathered >= pool:
                    pack(False)
                lo = hi
                if len(out.rows) > 20_000:
                    yield out.batch()
        pack(True)
        yield out.batch()

    return run


def packs(docs: DataFrame, tokenizer: str, pool: int = POOL) -> DataFrame:
    """A row for each piece of each row of `docs` (doc_id, text), by the tokenizer file at the path `tokenizer`."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(giving_back(packer(tokenizer, pool)), SCHEMA)
