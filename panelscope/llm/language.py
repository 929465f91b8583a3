"""Language of a text by hyperdimensional profiles.

Each letter has a random vector of +1 and -1 (the space that bounds a word is a
letter too). A trigram is the product of its letters' vectors, the first
permuted (rotated) twice and the second once; a text is the sum of its
trigrams' vectors, a language the sum over its training texts. The predicted
language is the prototype with the greatest cosine, with the mean of all
prototypes taken off so that what all languages share does not count.

Prototypes come from text and non-null lang of rows whose crc32(doc_id as text)
mod 4 is not 2, all of them. Sums are integers, so reruns agree.

Edge cases: text that is null or has no letter is `und` with score 0, as is
every text when nothing was learned; equal cosines go to the least name. Rows
with a null doc_id are not held out. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelscope.llm.words import SLICE_BYTES, slices

DIMENSIONS = 1024
LETTERS = 128  # letter vectors; slot 0 is the space. Latin letters have slots of their own, others share slots by code point.
PART = SLICE_BYTES // 2

_rng = np.random.default_rng(20240607)
_VECTORS = (_rng.integers(0, 2, (LETTERS, DIMENSIONS)) * 2 - 1).astype(np.int8)
_SECOND, _FIRST = np.roll(_VECTORS, 1, axis=1), np.roll(_VECTORS, 2, axis=1)


def _slot_table() -> np.ndarray:
    """Slot of each code point: letters by their lower-case form, all else 0."""
    table = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        if 0xD800 <= c < 0xE000 or not chr(c).isalpha():
            continue
        low = ord(chr(c).lower()[0])
        table[c] = low - 96 if 97 <= low <= 122 else 27 + low % 101
    return table


_SLOTS = _slot_table()


def letters(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all code points with a 0 before and after each row, and the rows' offsets into them."""
    text = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    slots = _SLOTS[text]
    lead = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    at = lead[offsets]
    return np.insert(slots, at[:-1], 0), at + np.arange(len(at))


#: Rows bundled at once: their counts are a matrix of rows by distinct trigrams.
ROWS = 256


def trigrams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigram codes around a letter, runs of spaces as one, and each one's row."""
    slots, cuts = letters(raw, offsets)
    rows = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    slots, rows = np.append(slots, 0), np.append(rows, len(cuts) - 2)
    stay = np.ones(len(slots), bool)
    stay[1:] = (slots[1:] != 0) | (slots[:-1] != 0)
    slots, rows = slots[stay].astype(np.int64), rows[stay]
    code = (slots[:-2] * LETTERS + slots[1:-1]) * LETTERS + slots[2:]
    ok = slots[1:-1] != 0
    return code[ok], rows[1:-1][ok]


def bound(codes: np.ndarray) -> np.ndarray:
    """Trigram vectors."""
    a, b, c = codes // (LETTERS * LETTERS), codes // LETTERS % LETTERS, codes % LETTERS
    return _FIRST[a] * _SECOND[b] * _VECTORS[c]


def bundles(codes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of the trigram vectors of each row (n x DIMENSIONS, float32 holding integers)."""
    seen = np.flatnonzero(np.bincount(codes, minlength=LETTERS**3))
    if not len(seen):
        return np.zeros((n, DIMENSIONS), np.float32)
    place = np.zeros(LETTERS**3, np.int32)
    place[seen] = np.arange(len(seen))
    counts = np.bincount(rows * len(seen) + place[codes], minlength=n * len(seen)).reshape(n, len(seen))
    return counts.astype(np.float32) @ bound(seen).astype(np.float32)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % 4 == 2, F.lit(False))


def _learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        for lo, hi, raw, offsets in slices(batch.column(1), PART):
            names, of = np.unique(langs[lo:hi].astype(str), return_inverse=True)
            codes, rows = trigrams(raw, offsets)
            for name, vector in zip(names, bundles(codes, of[rows], len(names)), strict=True):
                sums[name] = sums.get(name, 0) + vector.astype(np.int64)
    names = sorted(sums)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(names, DIMENSIONS) if names else [], pa.string()), pa.array(np.tile(np.arange(DIMENSIONS), len(names)), pa.int32()), pa.array(np.concatenate([sums[n] for n in names]) if names else [], pa.int64())],
        names=["lang", "at", "value"],
    )


def prototypes(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Learned languages and their unit vectors, centred; DIMENSIONS numbers for each language."""
    train = docs.where(~held_out(F.col("doc_id"))).where("lang is not null and text is not null").select(F.col("lang").cast("string").alias("lang"), "text")
    rows = train.mapInArrow(_learn, "lang string, at int, value long").groupBy("lang", "at").agg(F.sum("value")).collect()
    names = sorted({r[0] for r in rows})
    out = np.zeros((len(names), DIMENSIONS))
    for name, at, value in rows:
        out[names.index(name), at] = value
    keep = np.linalg.norm(out, axis=1) > 0
    names, out = [n for n, k in zip(names, keep, strict=True) if k], out[keep]
    if len(names):
        out /= np.linalg.norm(out, axis=1, keepdims=True)
    if len(names) > 1:
        out -= out.mean(0)
        out /= np.linalg.norm(out, axis=1, keepdims=True) + 1e-12
    return names, out


def predictor(names: list[str], vectors: np.ndarray):
    choice = pa.array([*names, "und"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw, offsets in slices(batch.column(2), PART):
                every, of = trigrams(raw, offsets)  # in order of the rows
                best, score = np.full(hi - lo, len(names)), np.zeros(hi - lo)
                for first in range(0, hi - lo if names else 0, ROWS):
                    n = min(ROWS, hi - lo - first)
                    i, j = np.searchsorted(of, (first, first + n))
                    some = np.bincount(of[i:j] - first, minlength=n) > 0
                    docs = bundles(every[i:j], of[i:j] - first, n).astype(np.float64)
                    cosine = docs @ vectors.T / np.maximum(np.linalg.norm(docs, axis=1, keepdims=True), 1e-12)
                    cosine = np.round(cosine, 9)
                    best[first : first + n] = np.where(some, cosine.argmax(1), len(names))
                    score[first : first + n] = np.where(some, np.clip((1 + cosine.max(1)) / 2, 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(lo, hi - lo) for k in (0, 1)), choice.take(pa.array(best)), pa.array(score)],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    return run


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row of `docs` (doc_id, text, lang)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(predictor(*prototypes(docs)), "doc_id long, held_out boolean, lang_pred string, score double")
