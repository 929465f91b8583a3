"""Merkle manifest of a dataset, its nodes stored in van Emde Boas layout.

A leaf is the hash of a document's fields; every source is a tree of runs of 16
over its leaves in order of doc_id, and the sources' roots are the leaves of one
more such tree. The trees are cut into aligned blocks of LEVELS levels of nodes.
A block is one row: its digests, laid out by splitting the block at half its
height into a top and bottoms that are each laid out likewise. An address is plain arithmetic
on (levels, depth, index); building a block and finding the siblings of a
path both use it. The roots of a round's blocks are the leaves of
the next round, until every tree has one block; then proofs go the
other way, block by block: a block gets the siblings above its root and hands them, with its own,
to the blocks below, and the lowest blocks to their documents.

Nothing is gathered by source. Documents are ordered by a range sort whose keys
end in a row number, so neither a hot source nor repeated ids meet in one task;
their positions are counts within a partition plus the counts of the partitions before.
A task holds one block (16 ** (LEVELS - 1) leaves) at a time.

Edge cases: a null field hashes as "-". Documents with a null doc_id come first,
equal ids are ordered by their leaves, and rows that are wholly equal have equal leaves. Null and empty
sources are two sources. A tree of one leaf is that leaf. An empty table gives no rows.
Only the five fields and a row number of our own are read; other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelscope.llm.runs import changes, fixed_rows, runs
from panelscope.llm.store import released, stored
from panelscope.operators.util import broadcast_if_small

ARITY = 16
LEVELS = 4  # of nodes in a block, leaves and root among them
DIGEST = 32
TAMPERED = 5  # documents whose crc32 this divides are tampered with
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# ------------------------------------------------------------- layout ----

def nodes_of(levels: int) -> int:
    """Nodes of a full tree of so many levels."""
    return (ARITY**levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, index: np.ndarray | int) -> np.ndarray | int:
    """Place of the index-th node at a depth below the root, in the layout of a tree of so many levels."""
    if levels == 1:
        return index * 0
    top = levels // 2
    if depth < top:
        return address(top, depth, index)
    below = ARITY ** (depth - top)
    return nodes_of(top) + index // below * nodes_of(levels - top) + address(levels - top, depth - top, index % below)


@lru_cache(maxsize=16)
def layout(levels: int) -> tuple[np.ndarray, ...]:
    """Addresses of all nodes of a full tree, from the leaves up."""
    return tuple(address(levels, depth, np.arange(ARITY**depth)) for depth in range(levels - 1, -1, -1))


def levels_over(leaves: int) -> int:
    """Levels of nodes of the whole tree over so many leaves."""
    n = 1
    while leaves > 1:
        leaves, n = -(-leaves // ARITY), n + 1
    return n


def hashed(text: str) -> bytes:
    return hashlib.sha256(text.encode()).digest()


def build(digests: np.ndarray, levels: int) -> bytes:
    """Nodes of a block over the digests of its leaves, in layout order up to the last that is used."""
    where = layout(levels)
    rows = [digests]
    while len(rows) < levels:
        text = rows[-1].tobytes().hex()
        run = 2 * DIGEST * ARITY
        above = b"".join(hashed(text[i : i + run]) for i in range(0, len(text), run))
        rows.append(np.frombuffer(above, np.uint8).reshape(-1, DIGEST))
    out = np.zeros((1 + max(int(a[len(r) - 1]) for a, r in zip(where, rows, strict=True)), DIGEST), np.uint8)
    for a, r in zip(where, rows, strict=True):
        out[a[: len(r)]] = r
    return out.tobytes()


class Block:
    """A stored block: its runs of siblings by level, read where the layout has them."""

    def __init__(self, nodes: bytes, leaves: int, levels: int):
        held = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST)
        self.runs: list[list[str]] = []
        for where in layout(levels)[:-1]:
            text = held[where[:leaves]].tobytes().hex()
            run = 2 * DIGEST * ARITY
            self.runs.append([text[i : i + run] for i in range(0, len(text), run)])
            leaves = -(-leaves // ARITY)

    def path(self, leaf: int) -> list[tuple[int, str]]:
        """For each level from the leaf's run up: place in the run, and the whole run."""
        out = []
        for level in self.runs:
            out.append((leaf % ARITY, level[leaf // ARITY]))
            leaf //= ARITY
        return out


def siblings(step: tuple[int, str]) -> str:
    k, run = step
    return run[: 64 * k] + run[64 * (k + 1) :]


def folded(digest: str, steps: Sequence[tuple[int, str]]) -> str:
    """Root that a digest gives with the siblings along its path."""
    for k, run in steps:
        digest = hashlib.sha256((run[: 64 * k] + digest + run[64 * (k + 1) :]).encode()).hexdigest()
    return digest


def packed(steps: Sequence[tuple[int, str]]) -> bytes:
    """A path as bytes: of each step the place, the length of the run and its digests."""
    return b"".join(bytes((k, len(run) // 64)) + bytes.fromhex(run) for k, run in steps)


def unpacked(data: bytes) -> list[tuple[int, str]]:
    out, at = [], 0
    while at < len(data):
        end = at + 2 + DIGEST * data[at + 1]
        out.append((data[at], data[at + 2 : end].hex()))
        at = end
    return out


# -------------------------------------------------------------- trees ----

def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition's number and each row's number among its group's rows of the partition; rows are sorted by group, the first column."""
    part, last, n = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        group = batch.column(0)
        first = np.ones(batch.num_rows, bool)
        first[1:] = changes(group)
        first[0] = n == 0 or group[0] != last
        at = np.arange(batch.num_rows)
        start = np.maximum.accumulate(np.where(first, at, -n))
        nth = at - start
        last, n = group[-1], int(nth[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, part), pa.int32()), pa.array(nth, pa.int64())], names=[*batch.schema.names, "part", "nth"])


def positions(rows: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """`rows` (its first column is the group) with position in the group by `order`, and the group's size; and the table to release when that is read."""
    group = rows.columns[0]
    keys = [group, *order]
    spread = rows.repartitionByRange(*(F.col(c).asc_nulls_first() for c in keys)).sortWithinPartitions(*(F.col(c).asc_nulls_first() for c in keys))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    ordered = stored(spread.mapInArrow(_numbered, kinds + ", part int, nth long"), "merkle-ordered")
    counts = ordered.groupBy("part", group).agg(F.count("*").alias("n"))  # a row for each group, and one more for each partition at most
    of_group = Window.partitionBy(group)
    before = of_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col("part").alias("p"), F.col(group).alias("g"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(of_group).alias("size"))
    on = (F.col("part") == F.col("p")) & F.col(group).eqNullSafe(F.col("g"))
    placed = ordered.join(broadcast_if_small(starts, row_bytes=512), on)
    return placed.select(*rows.columns, (F.col("start") + F.col("nth")).alias("position"), "size"), ordered


def _blocks(levels: int, payload: Sequence[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map function over (group, block, size, position, digest, payload ...) sorted by the first four: a row for each block."""
    for run in runs(batches, (0, 1)):
        run = run.combine_chunks()
        size = run.column(2)[0].as_py()
        height = min(levels, levels_over(size))  # the only block of a tree is no higher than the tree
        nodes = build(fixed_rows(run.column(4), DIGEST), height)
        root = nodes[DIGEST * int(address(height, 0, 0)) :][:DIGEST]
        lists = [pa.ListArray.from_arrays(pa.array([0, run.num_rows], pa.int32()), run.column(c).combine_chunks()) for c in payload]
        yield pa.RecordBatch.from_arrays(
            [run.column(0).slice(0, 1).combine_chunks(), *(run.column(k).slice(0, 1).combine_chunks() for k in (1, 2)), pa.array([run.num_rows], pa.int32()), pa.array([nodes], pa.binary()), pa.array([root], pa.binary()), *lists],
            names=["group", "block", "size", "leaves", "nodes", "root", *payload],
        )


def forest(leaves: DataFrame, payload: Sequence[str] = (), levels: int = LEVELS) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of the trees over `leaves` (group, position, size, digest, payload ...), round by round, and (group, root) of every tree."""
    width = ARITY ** (levels - 1)
    rounds: list[DataFrame] = []
    kept: list[str] = list(payload)
    while True:
        kind = leaves.schema["group"].dataType.simpleString()
        lists = "".join(f", `{c}` array<{leaves.schema[c].dataType.simpleString()}>" for c in kept)
        spread = leaves.select("group", F.expr(f"position div {width}").alias("block"), "size", "position", "digest", *kept).repartition("group", "block")
        built = spread.sortWithinPartitions("group", "block", "position").mapInArrow(
            partial(_blocks, levels, kept), f"group {kind}, block long, size long, leaves int, nodes binary, root binary{lists}"
        )
        rounds.append(stored(built, "merkle-blocks"))
        if (rounds[-1].agg(F.max("size")).first()[0] or 0) <= width:
            break
        up = rounds[-1].where(F.col("size") > width)
        leaves, kept = up.select("group", F.col("block").alias("position"), F.expr(f"(size + {width - 1}) div {width}").alias("size"), F.col("root").alias("digest")), []
    roots = [r.where(F.col("size") <= width).select("group", "root") for r in rounds]
    every = roots[0]
    for r in roots[1:]:
        every = every.unionByName(r)
    return rounds, every


def _steps(levels: int, row: dict) -> tuple[Block, list[tuple[int, str]]]:
    return Block(row["nodes"], row["leaves"], min(levels, levels_over(row["size"]))), unpacked(row["above"])


def _handed_down(levels: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map function over blocks with `above`, the path above their roots: (group, position, above, subroot) of each leaf."""
    width = ARITY ** (levels - 1)
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in ("block", "size", "leaves", "nodes", "above", "subroot")}
            block, above = _steps(levels, row)
            n = row["leaves"]
            tail = packed(above)
            paths = [packed(block.path(k)) + tail for k in range(n)]
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([batch.column("group").slice(i, 1)] * n), pa.array(np.arange(n) + row["block"] * width, pa.int64()), pa.array(paths, pa.binary()), pa.array([row["subroot"]] * n, pa.binary())],
                names=["group", "position", "above", "subroot"],
            )


def _with_paths(blocks: DataFrame, paths: DataFrame) -> DataFrame:
    """`blocks` with above and subroot of the path (group, position) to each block."""
    of = broadcast_if_small(paths.select(F.col("group").alias("g"), F.col("position").alias("p"), "above", "subroot"), row_bytes=8 << 10)
    return blocks.join(of, F.col("group").eqNullSafe(F.col("g")) & (F.col("block") == F.col("p"))).drop("g", "p")


def descend(rounds: Sequence[DataFrame], paths: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Paths (group, position, above, subroot) to the blocks of the lowest round, from those to the trees' roots."""
    width = ARITY ** (levels - 1)
    single = paths
    for k in range(len(rounds) - 1, 0, -1):
        # trees whose only block is in this round get their path here, others from the round above
        here = _with_paths(rounds[k], paths if k == len(rounds) - 1 else paths.unionByName(_first_in(rounds[k], single, width)))
        kind = rounds[k].schema["group"].dataType.simpleString()
        paths = stored(here.mapInArrow(partial(_handed_down, levels), f"group {kind}, position long, above binary, subroot binary"), "merkle-paths")
    return paths if len(rounds) == 1 else paths.unionByName(_first_in(rounds[0], single, width))


def _first_in(blocks: DataFrame, roots: DataFrame, width: int) -> DataFrame:
    """Of the paths to trees' roots, those of the trees that are one block of this round."""
    lone = blocks.where(F.col("size") <= width).select(F.col("group").alias("g"))
    return roots.join(broadcast_if_small(lone, row_bytes=512), F.col("group").eqNullSafe(F.col("g")), "left_semi")


# ----------------------------------------------------------- documents ----

def encoded(column: Column) -> Column:
    """A field as it is hashed: byte count, colon, value; "-" if null."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*(encoded(c) for c in (doc_id, source, lang, n_chars, text))), 256))


def document_leaves(docs: DataFrame) -> DataFrame:
    """group (the source), doc_id, digest, row (a number of its own), and the tampered leaf where a document is tampered with."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string")) % TAMPERED == 0
    return docs.select(
        F.col("source").alias("group"), F.col("doc_id").cast("long").alias("doc_id"), leaf(*fields, F.col("text")).alias("digest"),
        F.monotonically_increasing_id().alias("row"),
        F.when(tampered, leaf(*fields, F.translate("text", _UPPER, _LOWER))).alias("tampered"),
    )


def _proofs(levels: int, root: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in ("size", "leaves", "nodes", "above", "subroot")}
            block, above = _steps(levels, row)
            ids, tampered = batch.column("doc_id")[i].values, batch.column("tampered")[i].values.to_pylist()
            held = np.frombuffer(row["nodes"], np.uint8).reshape(-1, DIGEST)
            own = held[layout(min(levels, levels_over(row["size"])))[0][: row["leaves"]]].tobytes().hex()
            leaves, proofs, ends = [], [], []
            for k in range(row["leaves"]):
                steps = [*block.path(k), *above]
                mine = own[64 * k : 64 * (k + 1)]
                leaves.append(mine)
                proofs.append(hashlib.sha256("".join(map(siblings, steps)).encode()).hexdigest())
                ends.append(folded(tampered[k].hex() if tampered[k] else mine, steps))
            n = len(leaves)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(leaves), pa.array([row["subroot"].hex()] * n), pa.array([root] * n), pa.array(proofs), pa.array(ends), pa.array([e == root for e in ends])],
                names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
            )


SCHEMA = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Leaf, subroot, root, proof and check of every document of `docs` (doc_id, source, lang, n_chars, text)."""
    leaves = stored(document_leaves(docs), "merkle-leaves")
    placed, ordered = positions(leaves, ["doc_id", "digest", "row"])
    rounds, subroots = forest(placed, ["doc_id", "tampered"], levels)
    released(leaves, ordered)
    tops = subroots.select(F.lit(0).alias("group"), F.col("group").alias("source"), F.col("root").alias("digest"))
    of_top, top_ordered = positions(tops, ["source"])
    top_rounds, top_root = forest(of_top, ["source"], levels)
    root = [r[0] for r in top_root.select("root").collect()]  # one tree
    if not root:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    start = docs.sparkSession.createDataFrame([(0, 0, b"", b"")], "group int, position long, above binary, subroot binary")
    to_blocks = descend(top_rounds, start, levels)
    below = _with_paths(top_rounds[0], to_blocks)
    names = below.mapInArrow(partial(_sources, levels), f"group {leaves.schema['group'].dataType.simpleString()}, position long, above binary, subroot binary")
    paths = stored(names, "merkle-paths")
    released(top_ordered, *top_rounds)
    to_leaves = descend(rounds, paths, levels)
    return _with_paths(rounds[0], to_leaves).mapInArrow(partial(_proofs, levels, bytes(root[0]).hex()), SCHEMA)


def _sources(levels: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map function over the lowest blocks of the tree of sources: the path to each source's root, and that root."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in ("size", "leaves", "nodes", "above")}
            block, above = _steps(levels, row)
            tail = packed(above)
            held = np.frombuffer(row["nodes"], np.uint8).reshape(-1, DIGEST)
            own = held[layout(min(levels, levels_over(row["size"])))[0][: row["leaves"]]]
            n = row["leaves"]
            yield pa.RecordBatch.from_arrays(
                [batch.column("source")[i].values, pa.array(np.zeros(n), pa.int64()), pa.array([packed(block.path(k)) + tail for k in range(n)], pa.binary()), pa.array([d.tobytes() for d in own], pa.binary())],
                names=["group", "position", "above", "subroot"],
            )


#: DuckDB SQL for the rows of manifest(): both trees level by level, then every leaf folded up its runs.
ORACLE = """
WITH RECURSIVE docs AS (
  SELECT CAST(doc_id AS BIGINT) AS doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s,
         [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR), text] AS fields,
         [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR),
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')] AS changed
  FROM documents
), checked AS (
  SELECT *, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ord(c) AS BIGINT))),
             lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(8)), lambda x, k: xor(x >> 1, 3988292384::BIGINT * (x & 1))))) % 5 = 0 AS tampered
  FROM docs
), hashed AS (
  SELECT doc_id, s, coalesce(tampered, false) AS tampered,
         sha256(list_reduce(list_transform(fields, lambda f: coalesce(strlen(f) || ':' || f, '-')), lambda a, b: a || b)) AS leaf,
         sha256(list_reduce(list_transform(changed, lambda f: coalesce(strlen(f) || ':' || f, '-')), lambda a, b: a || b)) AS changed
  FROM checked
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY s) AS n FROM hashed
), nodes AS (
  SELECT s, 0 AS level, i, n, leaf AS digest FROM placed
  UNION ALL
  SELECT s, level + 1, i // 16, any_value((n + 15) // 16), sha256(string_agg(digest, '' ORDER BY i)) FROM nodes WHERE n > 1 GROUP BY s, level, i // 16
), subroots AS (SELECT s, digest AS subroot FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, s AS i, count(*) OVER () AS n, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, i // 16, any_value((n + 15) // 16), sha256(string_agg(digest, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY level, i // 16
), runs AS (
  SELECT s, level, i // 16 AS run, string_agg(digest, '' ORDER BY i) AS txt FROM nodes WHERE n > 1 GROUP BY s, level, i // 16
  UNION ALL
  SELECT -1, level, i // 16, string_agg(digest, '' ORDER BY i) FROM tops WHERE n > 1 GROUP BY level, i // 16
), lower_paths AS (
  SELECT s, i AS place, doc_id, 0 AS level, i, CASE WHEN tampered THEN changed ELSE leaf END AS digest, '' AS proof FROM placed
  UNION ALL
  SELECT p.s, p.place, p.doc_id, p.level + 1, p.i // 16,
         sha256(txt[1 : 64 * (p.i % 16)] || digest || txt[64 * (p.i % 16) + 65 :]), proof || txt[1 : 64 * (p.i % 16)] || txt[64 * (p.i % 16) + 65 :]
  FROM lower_paths p JOIN runs r ON r.s = p.s AND r.level = p.level AND r.run = p.i // 16
), arrived AS (
  SELECT s, place, max(level) AS level, max_by(digest, level) AS digest, max_by(proof, level) AS proof FROM lower_paths GROUP BY s, place
), upper_paths AS (
  SELECT s, place, 0 AS level, s AS i, digest, proof FROM arrived
  UNION ALL
  SELECT p.s, p.place, p.level + 1, p.i // 16,
         sha256(txt[1 : 64 * (p.i % 16)] || digest || txt[64 * (p.i % 16) + 65 :]), proof || txt[1 : 64 * (p.i % 16)] || txt[64 * (p.i % 16) + 65 :]
  FROM upper_paths p JOIN runs r ON r.s = -1 AND r.level = p.level AND r.run = p.i // 16
), ends AS (
  SELECT s, place, max_by(digest, level) AS folded_root, max_by(proof, level) AS proof FROM upper_paths GROUP BY s, place
)
SELECT p.doc_id, p.leaf, u.subroot, t.digest AS root, sha256(e.proof) AS proof_sha256, e.folded_root, e.folded_root = t.digest AS verified
FROM placed p JOIN subroots u USING (s) JOIN ends e ON e.s = p.s AND e.place = p.i CROSS JOIN (SELECT digest FROM tops WHERE n = 1) t
"""
