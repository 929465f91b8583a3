"""Quality scores by Bradley-Terry pairwise ranking.

A document's strength is a linear function of features of its text. Preference
pairs (a document labelled 1 beats one labelled 0) give the weights by logistic
loss on feature differences, with Newton's method and a small L2 penalty. The
decision threshold is the score quantile at the share of label 0 among the
labelled documents, and a score is the chance, under the same model, that the
document beats one that lies on the threshold.

Only labels whose crc32(doc_id as text) mod 3 is not 1 are learned from: the
weights from at most SAMPLE for each label (least hash of the id), a bounded
sample; the threshold, an exact quantile, from all of them. Inputs of a score
are functions of the text alone.

Edge cases: a null or empty text has all-zero counts and gets a score from
them. Without labels of both kinds every score is 0.5. Repeated rows are scored
row by row; rows with a null doc_id are scored and count as not held out. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelscope.llm.quality_rules import statistics
from panelscope.llm.store import released, stored
from panelscope.llm.words import code_points, slices, word_bounds, word_hashes
from panelscope.operators.prefix import BUCKET_ROWS
from panelscope.operators.quantiles import exact_quantiles
from panelscope.operators.util import broadcast_if_small

SAMPLE = 3000  # most labelled documents of either label that the weights are fitted on
OPPONENTS = 8  # pairs for each document of the sample
PENALTY = 1e-2
STEPS = 25
DIRECT, RANGES = 250, 64  # the threshold's scores are sorted in this many ranges, or more when a range passes BUCKET_ROWS; up to DIRECT scores in one


def _mask(lo: str, hi: str) -> np.ndarray:
    m = np.zeros(256, bool)
    m[ord(lo) : ord(hi) + 1] = True
    return m


_UPPER, _LOWER, _DIGIT = _mask("A", "Z"), _mask("a", "z"), _mask("0", "9")
_ENDS = np.zeros(256, bool)
_ENDS[list(b".?")] = True
_LOUD = np.zeros(256, bool)
_LOUD[list(b"!")] = True
_PAUSE = np.zeros(256, bool)
_PAUSE[list(b",;:")] = True
_LINE = np.zeros(256, bool)
_LINE[10] = True


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows x features: lengths on a log scale, shares of kinds of characters, and repetition."""
    n = len(offsets) - 1
    s = statistics(raw, offsets)
    starts, ends, rows = word_bounds(raw, offsets)
    words = word_hashes(raw, starts, ends)

    def share(of: np.ndarray, base: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(of[raw], dtype=np.int64)])
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(base, 1)

    n_words, chars = s["n_words"], code_points(raw, offsets)
    twin = np.zeros(len(words), bool)
    twin[1:] = (words[1:] == words[:-1]) & (rows[1:] == rows[:-1])
    order = np.lexsort((words, rows))
    new = np.ones(len(words), bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (rows[order][1:] != rows[order][:-1])
    distinct = np.bincount(rows[order][new], minlength=n)
    per_word = np.maximum(n_words, 1)
    upper, lower = share(_UPPER, chars), share(_LOWER, chars)
    return np.stack(
        [
            np.log1p(n_words),
            np.log1p(chars),
            s["word_chars"] / per_word / 10,
            np.minimum(s["n_symbols"] / per_word, 2),
            upper,
            upper / (upper + lower + 1e-3),
            share(_DIGIT, chars),
            share(_LOUD, n_words).clip(0, 2),
            share(_PAUSE, n_words).clip(0, 2),
            share(_ENDS, n_words).clip(0, 2),
            share(_LINE, n_words).clip(0, 2),
            s["n_repeat_words"] / per_word,
            np.bincount(rows[twin], minlength=n) / per_word,
            np.sqrt(np.bincount(rows[twin], minlength=n) / per_word),
            distinct / per_word,
            distinct / np.sqrt(per_word) / 10,
            (n_words < 20).astype(float),
            (n_words < 8).astype(float),
        ],
        1,
    ).round(9)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


class Ranking:
    """Weights, scaling and threshold; the threshold is that of the sample until `fit` sets the one of all labelled documents."""

    def __init__(self, good: np.ndarray, bad: np.ndarray, share_bad: float):
        both = np.concatenate([good, bad])
        self.mean, self.scale = both.mean(0), both.std(0) + 1e-9
        g, b = (good - self.mean) / self.scale, (bad - self.mean) / self.scale
        rng = np.random.default_rng(0)
        m = max(len(g), len(b)) * OPPONENTS
        d = g[rng.integers(0, len(g), m)] - b[rng.integers(0, len(b), m)]
        w = np.zeros(d.shape[1])
        for _ in range(STEPS):
            p = _sigmoid(d @ w)
            slope = d.T @ (p - 1) / m + PENALTY * w
            curve = (d * (p * (1 - p))[:, None]).T @ d / m + PENALTY * np.eye(len(w))
            w -= np.linalg.solve(curve, slope)
        self.weights = w
        scores = np.concatenate([g @ w, b @ w])
        weight = np.concatenate([np.full(len(g), (1 - share_bad) / len(g)), np.full(len(b), share_bad / len(b))])
        order = np.argsort(scores, kind="stable")
        at = int(np.searchsorted(np.cumsum(weight[order]), share_bad))
        after = scores[order][min(at + 1, len(order) - 1)]
        self.threshold = (scores[order][min(at, len(order) - 1)] + after) / 2

    def margin(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale * self.weights).sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.margin(x) - self.threshold)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % 3 == 1, F.lit(False))


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, raw, offsets in slices(batch.column(1)):
            x = features(raw, offsets)
            rows = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), rows], names=["doc_id", "x"])


def threshold(model: Ranking, docs: DataFrame, known: DataFrame, n_known: int) -> float:
    """The score half way between the last of label 0's share and the next, over all documents of `known` (doc_id, quality)."""

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw, offsets in slices(batch.column(2)):
                margin = np.round(model.margin(features(raw, offsets)), 9)
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(lo, hi - lo) for k in (0, 1)), pa.array(margin)], names=["doc_id", "quality", "margin"])

    labelled = broadcast_if_small(known, n_known, row_bytes=64)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(labelled, "doc_id").select("doc_id", "quality", "text")
    scored = rows.mapInArrow(margins, "doc_id long, quality int, margin double").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.min("margin").alias("margin"))
    scored = stored(scored, "rank-margins")
    n, bad = scored.agg(F.count(F.lit(1)), F.sum(1 - F.col("quality"))).first()
    at = min(max((bad - 0.5) / (n - 1), 0.0), 1.0)
    value = exact_quantiles(scored, "margin", [at], names=["cut"], direct_limit=min(BUCKET_ROWS, max(DIRECT, n // RANGES)), size_bound=n).first()["cut"]
    released(scored)
    return value


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ranking | None:
    """Weights from at most `sample` documents of each label, threshold from all labelled ones; None without both labels."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
    )
    counts = dict(known.groupBy("quality").count().collect())
    if len(counts) < 2:
        return None
    picked = None
    for label in (0, 1):
        one = known.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        picked = one if picked is None else picked.union(one)
    chosen = dict(picked.collect())  # 2 * sample ids at most
    ids = docs.sparkSession.createDataFrame(list(chosen.items()), "doc_id long, quality int")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids.select("doc_id")), "doc_id", "left_semi")
    rows = texts.mapInArrow(_features_of, "doc_id long, x array<double>").groupBy("doc_id").agg(F.min("x")).collect()
    x = {label: np.array([r[1] for r in sorted(rows) if chosen[r[0]] == label]) for label in (0, 1)}
    if not len(x[0]) or not len(x[1]):
        return None
    n_known = counts[0] + counts[1]
    model = Ranking(x[1], x[0], counts[0] / n_known)
    model.threshold = threshold(model, docs, known, n_known)
    return model


def scorer(model: Ranking | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw, offsets in slices(batch.column(2)):
                score = np.round(model.score(features(raw, offsets)), 9) if model else np.full(hi - lo, 0.5)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(lo, hi - lo) for k in (0, 1)), pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                    names=["doc_id", "held_out", "score", "predicted"],
                )

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted of each row of `docs` (doc_id, text); `labels` has doc_id, quality."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(scorer(fit(docs, labels, sample)), "doc_id long, held_out boolean, score double, predicted int")
