"""Document fingerprints: quartile bucket digests of byte triplets.

Every window of five bytes gives three triplets (bytes 0 1 2, 0 2 3 and 0 1 4);
each is hashed into one of 128 buckets. The digest holds, in hex, a checksum
byte, the length on a log scale, where the first and second quartile of the
bucket counts lie relative to the third, and two bits for each bucket: the
quartile that its count falls into. So two texts that share most of their
passages have most bucket codes alike, wherever the passages stand.

The difference of two digests is the sum of the bucket codes' differences (a
step of three counts six) and of bounded terms for length and quartile ratios;
likeness is 1 - difference / WORST, between 0 and 1. Equal digests have
likeness 1; empty texts have a digest of their own, alike only to itself.

The edited text of a document is its text with the last floor(n / 3) code points
replaced by as many first ones (or all) of the next document, by descending id;
after the last comes the first. Rows with equal ids follow each other by text.
A table of one row is its own next. Null text is empty, null ids come last.

To meet its next, each document goes to a range of ids (bounds from approximate
quantiles), sorted; the first row of a range is also sent to the range before.
Texts so move once. Tasks stream through their range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscope.llm.words import SLICE_BYTES

BUCKETS = 128
TRIPLETS = ((0, 1, 2), (0, 2, 3), (0, 1, 4))
WINDOW = 5
LENGTH_STEP = 1.1  # of the log scale of lengths
#: Texts a range should hold; ranges are sorted and streamed, so this only sets parallelism.
RANGE_ROWS = 2_000
MOST_RANGES = 20_000

_SALTS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)
_STEPS = np.array([[0, 1, 2, 6], [1, 0, 1, 2], [2, 1, 0, 1], [6, 2, 1, 0]])
WORST = BUCKETS * 6 + 2 * 12 + 3 * 12


def bucket_counts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows x BUCKETS: counts of hashed triplets; a text of 1 to 4 bytes is padded with zeros to a window."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    padded = np.concatenate([raw, np.zeros(WINDOW, np.uint8)])
    lengths = np.where(sizes > 0, np.maximum(sizes - WINDOW + 1, 1), 0)
    rows = np.repeat(np.arange(n), lengths)
    at = np.arange(len(rows)) + np.repeat(offsets[:-1] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) if len(rows) else np.zeros(0, np.int64)
    short = (sizes > 0) & (sizes < WINDOW)
    b = [padded[at + k].astype(np.uint32) for k in range(WINDOW)]
    if short.any():
        for k in range(1, WINDOW):
            b[k][(short & (sizes <= k))[rows]] = 0
    out = np.zeros(n * BUCKETS, np.int64)
    base = rows * BUCKETS
    for (i, j, k), salt in zip(TRIPLETS, _SALTS, strict=True):
        x = (b[i] | b[j] << np.uint32(8) | b[k] << np.uint32(16)) * salt
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        out += np.bincount(base + (x >> np.uint32(25)), minlength=n * BUCKETS)
    return out.reshape(n, BUCKETS)


def digests(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows x (3 + BUCKETS / 4) bytes: checksum, length, quartile ratios, bucket codes."""
    counts = bucket_counts(raw, offsets)
    sizes = np.diff(offsets)
    ordered = np.sort(counts, axis=1)
    q1, q2, q3 = (ordered[:, BUCKETS * k // 4 - 1][:, None] for k in (1, 2, 3))
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    packed = codes[:, 0::4] | codes[:, 1::4] << 2 | codes[:, 2::4] << 4 | codes[:, 3::4] << 6
    length = np.minimum(np.round(np.log(np.maximum(sizes, 1)) / np.log(LENGTH_STEP)), 254).astype(np.uint8) + (sizes > 0)
    ratio = [np.minimum(q * 16 // np.maximum(q3, 1), 15).astype(np.uint8)[:, 0] for q in (q1, q2)]
    check = ((counts * np.arange(1, BUCKETS + 1)).sum(1) % 251).astype(np.uint8)
    return np.concatenate([np.stack([check, length, ratio[0] | ratio[1] << 4], 1), packed.astype(np.uint8)], axis=1).astype(np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness (0 to 1) of digests row by row."""
    codes = [np.stack([d[:, 3:] >> s & 3 for s in (0, 2, 4, 6)]).astype(np.int64) for d in (a, b)]
    total = _STEPS[codes[0], codes[1]].sum((0, 2))
    length = np.abs(a[:, 1].astype(int) - b[:, 1])
    total = total + np.minimum(length, 12) * 2
    for shift in (0, 4):
        x, y = (d[:, 2].astype(int) >> shift & 15 for d in (a, b))
        ring = np.minimum(np.abs(x - y), 16 - np.abs(x - y))
        total = total + np.minimum(ring, 8)
    total = total + np.where((a[:, 0] != b[:, 0]) & (total > 0), 1, 0)
    empty = (a[:, 1] == 0) != (b[:, 1] == 0)
    return np.where(empty, 0.0, np.round(np.clip(1 - total / WORST, 0, 1), 9))


def _packed(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return np.frombuffer(b"".join(texts), np.uint8), offsets


def edited(text: str, following: str) -> str:
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def _compared(rows: list[tuple], following: tuple) -> pa.RecordBatch:
    """Result rows of consecutive documents (id, text), `following` being the one after the last."""
    texts = [r[1] for r in rows] + [following[1]]
    edits = [edited(a, b) for a, b in zip(texts[:-1], texts[1:], strict=True)]
    coded = [e.encode() for e in edits]
    plain = digests(*_packed([t.encode() for t in texts]))
    changed = digests(*_packed(coded))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(e).hexdigest() for e in coded], pa.string()),
            pa.array([d.tobytes().hex() for d in plain[:-1]], pa.string()),
            pa.array([d.tobytes().hex() for d in changed], pa.string()),
            pa.array(likeness(plain[:-1], changed)),
            pa.array(likeness(plain[:-1], plain[1:])),
        ],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, extra, doc_id, text) in order; the last of each part is the next range's first row and only looked at."""
    waiting, part, size = [], None, 0
    for batch in batches:
        for p, extra, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            row = (doc_id, text or "")
            if p != part:
                part, waiting, size = p, [], 0
            if waiting and (size > SLICE_BYTES // 2 or extra):
                yield _compared(waiting, row)
                waiting, size = [], 0
            if not extra:
                waiting.append(row)
                size += len(row[1])


def _range_of(cuts: np.ndarray):
    """Range numbers ascend while ids descend; a null id is in the last range."""

    @F.pandas_udf("int")
    def part(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        above = len(cuts) - np.searchsorted(cuts, ids.fillna(0).to_numpy(np.int64), "right")
        return pd.Series(np.where(known, above, len(cuts))).astype("int32")

    return part


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """A row for each row of `docs` (doc_id, text): digests of the text and its edited text, and their likenesses."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    n = docs.count()
    parts = int(min(max(1, -(-n // range_rows)), MOST_RANGES))
    cuts = sorted(set(docs.select(F.col("doc_id").cast("long").alias("doc_id")).stat.approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.2 / parts))) if parts > 1 else []
    rows = rows.withColumn("part", _range_of(np.array(cuts, np.int64))("doc_id"))
    heads = rows.groupBy("part").agg(F.max("doc_id").alias("head")).collect()  # one row for each range
    used = sorted(r[0] for r in heads)
    if not used:
        return spark.createDataFrame([], SCHEMA)
    head = dict(heads)
    before = {p: used[k - 1] for k, p in enumerate(used)}  # the first range's head follows the last range's rows
    table = spark.createDataFrame([(p, head[p], before[p]) for p in used], "part int, head long, before int")
    # A range's first row: its greatest id, least text.
    first = rows.join(F.broadcast(table), "part").where(F.col("doc_id").eqNullSafe(F.col("head")))
    first = first.groupBy("before").agg(F.min("text").alias("text"), F.max("doc_id").alias("doc_id"))
    extra = first.select(F.col("before").alias("part"), F.lit(1).alias("extra"), "doc_id", "text")
    every = rows.select("part", F.lit(0).alias("extra"), "doc_id", "text").union(extra)
    ordered = every.repartition(parts, "part").sortWithinPartitions("part", "extra", F.col("doc_id").desc_nulls_last(), "text")
    return ordered.mapInArrow(_streamed, SCHEMA)
