"""Near-duplicate documents: signature-coordinate inverted join.

1. Each text becomes its set of hashed 5-word shingles and a MinHash signature of
   192 coordinates. Texts with equal sets are one *node* from here on.
2. Nodes are posted under coordinate-value pairs. A pair here covers four
   neighbouring coordinates (48 postings a node), so texts that merely share a
   passage rarely meet, while two texts at similarity 0.75 miss all 48 lists
   with probability (1 - 0.75**4)**48 = 1.2e-8.
3. Prefix rule: a coordinate-value pair held by one node alone is never joined;
   a node whose pairs are all its own drops out.
4. Skip merging, first pass: a posting list is merged against its hub (its least
   node) only, one candidate per posting, however long the list is. Candidates
   that agree in at least 111 of 192 coordinates (six standard deviations below
   similarity 0.75) are confirmed on the full sets, and linked nodes form
   components.
5. Second pass: lists whose members are all in one component are skipped. In the
   others each member still meets each member of another component, in blocks
   of bounded size, sorted by set size, and skipping blocks whose set sizes rule
   a link out; only pairs above the match threshold leave a block.
   So no link between components is lost, and no list is expanded into pairs.

Components are found by least-label propagation with pointer jumping; each round
is a table in the shared folder.

Edge cases: a null or empty text, or one without words, has the empty set: it is
alone in its component and kept. Rows with equal ids are separate documents with
that id. Documents without an id are linked with nothing, have a null component
and are kept. Other columns are not read, so their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from panelscope.llm.memory import giving_back
from panelscope.llm.store import fresh, released, stored
from panelscope.llm.words import lower_ascii, mix, slices, window_hashes, word_bounds, word_hashes

WIDTH = 5  # words in a shingle
PERCENT = 75  # least similarity of a link
COORDINATES = 192
TOGETHER = 4  # coordinates of one posting
MATCHES = 111  # least equal coordinates of a candidate pair
TASK_EDGES = 200_000  # links that one task turns into stars
BLOCK = 512  # nodes of a block

_rng = np.random.default_rng(20240501)
_FACTORS = _rng.integers(0, 1 << 31, COORDINATES).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_MASKS = _rng.integers(0, 1 << 32, COORDINATES).astype(np.uint32)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, sorted within each row, and the rows' offsets into them."""
    n = len(offsets) - 1
    raw = lower_ascii(raw)
    starts, ends, rows = word_bounds(raw, offsets)
    words = word_hashes(raw, starts, ends)
    shingles, at = window_hashes(words, rows, width)
    of = rows[at]
    counts = np.bincount(rows, minlength=n)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        first = np.searchsorted(rows, short)
        whole = np.zeros(len(short), np.uint64)
        for k in range(width - 1):  # the whole sequence, with its length
            has = counts[short] > k
            whole[has] = whole[has] * np.uint64(0xA0761D6478BD642F) + words[first[has] + k]
        shingles = np.concatenate([shingles, mix(whole + counts[short].astype(np.uint64))])
        of = np.concatenate([of, short])
        order = np.argsort(of, kind="stable")
        shingles, of = shingles[order], of[order]
    cuts = np.searchsorted(of, np.arange(n + 1))
    sets = [np.unique(shingles[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if n else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])


def minima(sets: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """MinHash coordinates (rows x COORDINATES); rows with an empty set hold zeros."""
    out = np.zeros((len(cuts) - 1, COORDINATES), np.uint32)
    has = np.flatnonzero(np.diff(cuts))
    if len(has):
        x = (sets >> np.uint64(32)).astype(np.uint32)
        for k in range(COORDINATES):
            out[has, k] = np.minimum.reduceat((x * _FACTORS[k]) ^ _MASKS[k], cuts[:-1][has])
    return out


def posting_keys(least: np.ndarray) -> np.ndarray:
    """One 64-bit key for each run of TOGETHER coordinates, the run's number included."""
    key = np.broadcast_to(np.arange(COORDINATES // TOGETHER, dtype=np.uint64), (len(least), COORDINATES // TOGETHER)).copy()
    for k in range(TOGETHER):
        key = key * _STEP + least[:, k::TOGETHER].astype(np.uint64)
    return mix(key)


def _binary(values: np.ndarray) -> pa.Array:
    """Rows of a 2-d uint8 array as binary values."""
    flat = np.ascontiguousarray(values)
    ends = np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(flat), [None, pa.py_buffer(ends), pa.py_buffer(flat)])


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(0)
        for lo, hi, raw, offsets in slices(batch.column(1)):
            sets, cuts = shingle_sets(raw, offsets)
            least = minima(sets, cuts)
            keys = posting_keys(least).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(lo, hi - lo),
                    pa.array(np.diff(cuts), pa.int64()),
                    _binary(_names(sets, cuts)),
                    pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1) * keys.shape[1], pa.int32()), pa.array(keys.ravel())),
                    _binary((least & 0xFF).astype(np.uint8)),
                ],
                names=["doc_id", "n_shingles", "node", "keys", "sketch"],
            )


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, node (128-bit name of the set), keys (postings), sketch (a byte of each coordinate)."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        giving_back(_signed), "doc_id long, n_shingles long, node binary, keys array<long>, sketch binary"
    )


def _names(sets: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """128-bit name of each set, whatever the order of its members."""
    sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(sets ^ np.uint64(s)), dtype=np.uint64)]) for s in (0x2545F491, 0x5851F42D)]
    return np.stack([s[cuts[1:]] - s[cuts[:-1]] for s in sums], 1).view(np.uint8).reshape(len(cuts) - 1, 16)


def _sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, raw, offsets in slices(batch.column(0)):
            sets, cuts = shingle_sets(raw, offsets)
            yield pa.RecordBatch.from_arrays(
                [_binary(_names(sets, cuts)), pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(sets.view(np.int64)))],
                names=["node", "members"],
            )


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs whose sketches and set sizes allow a link."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, COORDINATES) for c in ("sketch_a", "sketch_b"))
        n, m = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
        ok = ((a == b).sum(1) >= MATCHES) & (100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m))
        yield batch.select(["a", "b"]).filter(pa.array(ok))


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs linked by their full sets."""
    for batch in batches:
        ok = []
        for x, y in zip(batch.column("members_a"), batch.column("members_b"), strict=True):
            x, y = x.values.to_numpy(), y.values.to_numpy()
            both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
            ok.append(100 * both >= PERCENT * (len(x) + len(y) - both))
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def _candidates_kept(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    small = nodes.select("node", "n_shingles", "sketch")
    return (
        pairs.join(small.toDF("a", "n_a", "sketch_a"), "a")
        .join(small.toDF("b", "n_b", "sketch_b"), "b")
        .mapInArrow(giving_back(_alike), "a binary, b binary")
    )


def _sets(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, members) of the nodes of the documents with the ids `root` in `rows`; no other text is read into a set."""
    roots = rows.select(F.col("root").alias("doc_id")).distinct()
    found = docs.join(roots, "doc_id", "left_semi").select("text").mapInArrow(giving_back(_sets_of), "node binary, members array<long>")
    return stored(found.join(rows.select("node").distinct(), "node", "left_semi"), "shingle-sets")


def _links(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (a, b) confirmed on the full sets."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = _sets(wanted.join(nodes.select("node", "root"), "node"), docs)
    links = stored(
        pairs.join(sets.toDF("a", "members_a"), "a").join(sets.toDF("b", "members_b"), "b").mapInArrow(giving_back(_confirmed), "a binary, b binary"), "links"
    )
    released(sets)
    return links


def _stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The edges of a task as stars: each node with the least node of its local component."""
    parent: dict[bytes, bytes] = {}

    def find(x: bytes) -> bytes:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch["a"], batch["b"], strict=True):
            a, b = find(parent.setdefault(a, a)), find(parent.setdefault(b, b))
            parent[max(a, b)] = min(a, b)
    found = [(root, node) for node in parent if (root := find(node)) != node]
    yield pd.DataFrame(found, columns=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, label): label is the least node reachable over `links` (a, b); nodes without a link are absent.

    Each task first turns at most about TASK_EDGES links into stars, so that what is
    propagated has few edges for each node and short ways; then least labels spread
    over all stars until none changes.
    """
    given = stored(links, "given-links")
    tasks = max(1, -(-given.count() // TASK_EDGES))
    stars = given.coalesce(tasks).mapInPandas(giving_back(_stars), "a binary, b binary")
    stars = stored(stars, "stars")
    edges = stored(stars.union(stars.select("b", "a")).distinct(), "edges")
    released(given, stars)
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).withColumn("label", F.least("node", "label")), "labels")
    while True:
        near = edges.join(labels.toDF("b", "near"), "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        lower = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        jump = lower.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = stored(lower.join(jump, "label").select("node", "was", F.least("label", "next").alias("label")), "labels")
        released(labels)
        labels = new.select("node", "label")
        if not new.where("was <> label").limit(1).count():
            released(edges)
            return labels


class _Forest:
    """Union-find over the rows of a cell."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def joined(self, x: int, y: int) -> bool:
        """Join two trees; False if they were one."""
        x, y = self.find(x), self.find(y)
        self.parent[x] = y
        return x != y


def _sides(rows: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """Each row of the left block with the rows to compare it to: of another component and of a size that allows a link."""
    label, size, side = (rows[c].to_numpy() for c in ("label", "n_shingles", "side"))
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    for k, i in enumerate(left):
        fit = right if len(right) else left[k + 1 :]
        yield i, fit[(label[fit] != label[i]) & (100 * np.minimum(size[i], size[fit]) >= PERCENT * np.maximum(size[i], size[fit]))]


def _edges(node: np.ndarray, found: list[tuple[int, int]]) -> list[tuple[bytes, bytes]]:
    return [(min(node[i], node[j]), max(node[i], node[j])) for i, j in found]


def _alike_cell(rows: pd.DataFrame) -> list[tuple[bytes, bytes]]:
    """A spanning forest of the pairs that are alike by sketch."""
    sketches = np.frombuffer(b"".join(rows["payload"]), np.uint8).reshape(-1, COORDINATES)
    forest = _Forest(len(rows))
    found = [(i, j) for i, fit in _sides(rows) for j in fit[(sketches[fit] == sketches[i]).sum(1) >= MATCHES] if forest.joined(i, j)]
    return _edges(rows["node"].to_numpy(), found)


def _linked_cell(rows: pd.DataFrame) -> list[tuple[bytes, bytes]]:
    """A spanning forest of the links, by intersection counts over an inverted list of the cell's shingles."""
    sets, size = rows["payload"].tolist(), rows["n_shingles"].to_numpy()
    cuts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    owner = (np.searchsorted(cuts, order, "right") - 1).astype(np.int64)
    new = np.concatenate([[True], flat[order][1:] != flat[order][:-1]])
    start = np.flatnonzero(new)
    length = np.diff(np.append(start, len(flat)))
    place = np.empty(len(flat), np.int64)
    place[order] = np.cumsum(new) - 1
    forest, found = _Forest(len(rows)), []
    for i, fit in _sides(rows):
        if not len(fit):
            continue
        at = place[cuts[i] : cuts[i + 1]]
        many = length[at]
        upto = np.cumsum(many)
        both = np.bincount(owner[np.repeat(start[at] - upto + many, many) + np.arange(upto[-1])], minlength=len(rows))
        fit = fit[100 * both[fit] >= PERCENT * (size[i] + size[fit] - both[fit])]
        found += [(i, j) for j in fit if forest.joined(i, j)]
    return _edges(rows["node"].to_numpy(), found)


def _cells(of_cell):
    """Map function over rows sorted by cell; a cell may span batches and holds two blocks at most."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: list[pd.DataFrame] = []  # of the cell that is not complete
        last = None
        for batch in batches:
            if not len(batch):
                continue
            cell = list(zip(batch["key"], batch["block"], batch["block_2"], strict=True))
            cuts = [0, *(k for k in range(1, len(cell)) if cell[k] != cell[k - 1]), len(cell)]
            found = []
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if parts and cell[a] != last:
                    found += of_cell(pd.concat(parts, ignore_index=True))
                    parts = []
                parts.append(batch.iloc[a:b])
                last = cell[a]
            yield pd.DataFrame(sorted(set(found)), columns=["a", "b"])
        if parts:
            yield pd.DataFrame(sorted(set(of_cell(pd.concat(parts, ignore_index=True)))), columns=["a", "b"])

    return run


def _compared(rows: DataFrame, of_cell) -> DataFrame:
    """Pairs (a, b) that `of_cell` finds among the rows (node, label, n_shingles, payload) of each key; n is the key's row count.

    The rows of a key are cut into blocks of about BLOCK by set size, and every two
    blocks whose sizes allow a link meet in a cell: no task holds a whole key.
    """
    rows = stored(rows, "members")
    sizes = rows.where(F.col("n") > 2 * BLOCK).groupBy("key", "n_shingles").agg(F.count("*").alias("m"))
    by_size = Window.partitionBy("key").orderBy("n_shingles").rowsBetween(Window.unboundedPreceding, 0)
    upto = sizes.select("key", "n_shingles", (F.sum("m").over(by_size) - F.col("m")).alias("before"), "m")
    spread = F.floor((F.col("before") + F.pmod(F.xxhash64("node"), F.col("m"))) / BLOCK)
    long = rows.where(F.col("n") > 2 * BLOCK).join(upto, ["key", "n_shingles"]).withColumn("block", spread.cast("int"))
    reach = long.groupBy("key", "block").agg(F.min("n_shingles").alias("lo"), F.max("n_shingles").alias("hi"))
    other = reach.toDF("key", "block_2", "lo_2", "hi_2")
    meet = reach.join(other, "key").where((F.col("block") <= F.col("block_2")) & (100 * F.col("hi") >= PERCENT * F.col("lo_2"))).select("key", "block", "block_2")
    wide = long.select("key", "block", "node", "label", "n_shingles", "payload")
    left = wide.join(meet, ["key", "block"]).withColumn("side", F.lit(0))
    right = wide.withColumnRenamed("block", "block_2").join(meet.where("block <> block_2"), ["key", "block_2"]).withColumn("side", F.lit(1))
    short = rows.where(F.col("n") <= 2 * BLOCK).select("key", "node", "label", "n_shingles", "payload", F.lit(0).alias("block"), F.lit(0).alias("block_2"), F.lit(0).alias("side"))
    cells = left.unionByName(right).unionByName(short)
    together = cells.repartition("key", "block", "block_2").sortWithinPartitions("key", "block", "block_2")
    found = stored(together.mapInPandas(giving_back(_cells(of_cell)), "a binary, b binary").distinct(), "compared")
    released(rows)
    return found


def _later_links(postings: DataFrame, nodes: DataFrame, labels: DataFrame, docs: DataFrame) -> DataFrame:
    """Links between components, out of the lists that still hold more than one (of two nodes, one is the hub: done).

    Nodes of such a list that are alike by sketch across components form families;
    within a family, links are found on the full sets.
    """
    members = (
        postings.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        .join(nodes.select("node", "n_shingles", F.col("sketch").alias("payload")), "node")
    )
    live = members.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n")).where("low <> high and n > 2").select("key", "n")
    alike = _compared(members.join(live, "key"), _alike_cell)
    families = components(alike).toDF("node", "key")
    families = families.join(families.groupBy("key").agg(F.count("*").alias("n")), "key")
    sets = _sets(families.join(nodes.select("node", "root"), "node"), docs)
    whole = (
        families.join(nodes.select("node", "n_shingles"), "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        .join(sets.withColumnRenamed("members", "payload"), "node")
    )
    links = _compared(whole, _linked_cell)
    released(sets, alike)
    return links


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable), kept (doc_id = component_id); `docs` has doc_id and text."""
    signed = stored(signatures(docs), "signatures")
    per_text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    nodes = stored(
        signed.where("n_shingles > 0 and doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("root"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"), F.first("sketch").alias("sketch")),
        "nodes",
    )
    every = nodes.select(F.explode("keys").alias("key"), "node")
    shared = every.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("hub")).where("n > 1")
    postings = stored(every.join(shared.select("key", "hub"), "key"), "postings")
    first = postings.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    pairs = stored(_candidates_kept(first, nodes), "pairs")
    linked = _links(pairs, nodes, per_text)
    labels = components(linked)
    more = _later_links(postings.select("key", "node"), nodes, labels, per_text)
    released(postings, pairs)
    labels = components(linked.union(more))
    named = labels.join(nodes.select("node", "root"), "node")
    least = named.groupBy("label").agg(F.min("root").alias("component_id"))
    of_node = nodes.select("node", "root").join(named.select("node", "label"), "node", "left").join(least, "label", "left")
    of_node = of_node.select("node", F.coalesce("component_id", "root").alias("component_id"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return signed.select("doc_id", "n_shingles", "node").join(of_node, "node", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )


def kept(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, that near_duplicates() keeps; of rows with equal id and text one stays."""
    stays, nth = fresh("__kept", docs.columns), fresh("__n", docs.columns)
    ids = near_duplicates(docs).where("kept and doc_id is not null").select(F.col("doc_id").alias(stays)).distinct()
    stay = docs.join(ids, F.col("doc_id").cast("long") == F.col(stays), "left_semi")
    first = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("doc_id")
    stay = stay.withColumn(nth, F.row_number().over(first)).where(F.col(nth) == 1).drop(nth)
    return stay.union(docs.where("doc_id is null"))
