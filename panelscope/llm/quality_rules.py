"""Quality rules: word and line statistics, and a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed byte 4-grams: a trusted target
(documents labelled good and not toxic) and the raw corpus (every document). A
text's score is the mean log ratio of its n-grams, so it is in nats for each
n-gram whatever the length. Every text is then held against fixed thresholds.

Raw counts cover all documents, target counts all trusted ones; what is
collected is a row for each bucket. Counts are integers, so reruns agree.

Edge cases: null text is empty. A text without words has zero counts and score
0, and fails the base rules (fewer than 20 words). Without any trusted document
both multinomials are the raw one and every score is 0. Repeated rows and ids
are judged row by row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscope.llm.memory import giving_back
from panelscope.llm.words import code_points, not_space, slices, window_hashes, word_bounds, word_hashes
from panelscope.operators.util import broadcast_if_small

GRAM = 4  # bytes
BUCKETS = 1 << 16
SMOOTHING = 1.0
LEAST_SCORE = -0.5  # nats for each n-gram
LEAST_WORDS = 20
MOST_REPEATED = 30  # per cent of words in repeated windows
WINDOW = 8

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def gram_buckets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each n-gram that lies in one row, and the rows' offsets into them."""
    n = max(0, len(raw) - GRAM + 1)
    x = np.zeros(n, np.uint32)
    for k in range(GRAM):
        x |= raw[k : k + n].astype(np.uint32) << np.uint32(8 * k)
    x = (x * np.uint32(0x9E3779B1)) >> np.uint32(16)
    counts = np.maximum(np.diff(offsets) - GRAM + 1, 0)
    cuts = np.concatenate([[0], np.cumsum(counts)])
    if len(counts) == 1:
        return x, cuts
    inside = np.zeros(n + 1, np.int32)
    has = counts > 0
    np.add.at(inside, offsets[:-1][has], 1)
    np.add.at(inside, offsets[:-1][has] + counts[has], -1)
    return x[np.cumsum(inside[:-1]) > 0], cuts


def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map function over (trusted, text): n-gram counts of a partition, of all rows and of the trusted ones."""
    every, good = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        trusted = batch.column(0).to_numpy(zero_copy_only=False)
        for lo, hi, raw, offsets in slices(batch.column(1)):
            x, cuts = gram_buckets(raw, offsets)
            every += np.bincount(x, minlength=BUCKETS)
            mine = trusted[lo:hi]
            if mine.any():
                good += np.bincount(x[np.repeat(mine, np.diff(cuts))], minlength=BUCKETS)
    seen = np.flatnonzero(every)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(every[seen]), pa.array(good[seen])], names=["bucket", "every", "good"])


def trusted_flags(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """trusted, text of each row of `docs`: whether its document is labelled good and not toxic. Ids that are few are broadcast, so no text is shuffled."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0").select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    marked = broadcast_if_small(good.withColumn("trusted", F.lit(True)), row_bytes=64)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(marked, "doc_id", "left")
    return rows.select(F.coalesce("trusted", F.lit(False)).alias("trusted"), "text")


def log_ratios(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """log p(bucket | target) - log p(bucket | raw), for each of BUCKETS buckets."""
    counted = trusted_flags(docs, labels).mapInArrow(giving_back(count), "bucket int, every long, good long")
    rows = counted.groupBy("bucket").agg(F.sum("every"), F.sum("good")).collect()  # BUCKETS rows at most
    every, good = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for bucket, n, m in rows:
        every[bucket], good[bucket] = n, m
    if not good.sum():
        return np.zeros(BUCKETS)
    p, q = good + SMOOTHING, every + SMOOTHING
    return np.log(p / p.sum()) - np.log(q / q.sum())


def repeated_lines(texts: pa.Array) -> list[int]:
    """Lines with a word that equal an earlier line of their text."""
    out = []
    for text in texts.to_pylist():
        if not text or "\n" not in text:
            out.append(0)
            continue
        lines = [line for line in text.split("\n") if line.strip(" \t\n\v\f\r")]
        out.append(len(lines) - len(set(lines)))
    return out


def statistics(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    n = len(offsets) - 1
    starts, ends, rows = word_bounds(raw, offsets)
    shingles, at = window_hashes(word_hashes(raw, starts, ends), rows, WINDOW)
    of = rows[at]
    order = np.lexsort((shingles, of))
    same = (shingles[order][1:] == shingles[order][:-1]) & (of[order][1:] == of[order][:-1])
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(starts) + 1, np.int64)
    first = at[twice]
    np.add.at(cover, first, 1)
    np.add.at(cover, first + WINDOW, -1)
    repeated = np.cumsum(cover[:-1]) > 0
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[raw], dtype=np.int64)])
    return {
        "n_words": np.bincount(rows, minlength=n),
        "word_chars": code_points(raw, offsets, not_space(raw)),
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_repeat_words": np.bincount(rows[repeated], minlength=n),
    }


def judge(ratios: np.ndarray, least_score: float):
    """Map function over (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw, offsets in slices(batch.column(1)):
                s = statistics(raw, offsets)
                x, cuts = gram_buckets(raw, offsets)
                score = np.zeros(len(cuts) - 1)
                has = np.flatnonzero(np.diff(cuts))
                if len(has):  # each text summed by itself: its score does not depend on its neighbours in the slice
                    score[has] = np.add.reduceat(ratios[x], cuts[:-1][has]) / np.diff(cuts)[has]
                failed = (s["n_words"] < LEAST_WORDS) | (100 * s["n_repeat_words"] > MOST_REPEATED * s["n_words"])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        *(pa.array(s[c], pa.int64()) for c in ("n_words", "word_chars", "n_symbols")),
                        pa.array(repeated_lines(batch.column(1).slice(lo, hi - lo)), pa.int64()),
                        pa.array(s["n_repeat_words"], pa.int64()),
                        pa.array(failed),
                        pa.array(~failed & (score >= least_score)),
                        pa.array(score),
                    ],
                    names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr"],
                )

    return run


SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, llr double"


def quality_rules(docs: DataFrame, labels: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """Statistics, base verdict, final verdict and score (llr) of each row of `docs` (doc_id, text); `labels` has doc_id, quality, toxic."""
    run = judge(log_ratios(docs, labels), least_score)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(giving_back(run), "doc_id long, " + SCHEMA)


def kept(docs: DataFrame, labels: DataFrame, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of `docs`, with all their columns, that quality_rules() keeps. Judged where they lie: nothing is shuffled."""
    run = judge(log_ratios(docs, labels), least_score)
    names = docs.columns
    at = [names.index("doc_id"), names.index("text")]

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pair = pa.RecordBatch.from_arrays([batch.column(k) for k in at], names=["doc_id", "text"])
            verdicts = [v.column(7) for v in run(iter([pair]))]
            if verdicts:
                yield batch.filter(pa.concat_arrays(verdicts))

    return docs.mapInArrow(giving_back(keep), docs.schema)
