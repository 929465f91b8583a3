"""Bigram language model in Elias-Fano tries, trained on and scoring a whole corpus.

Tokens are a document's words with A-Z lower-cased, then one end; the first token's context is the end as
well. With counts c over the training documents, N their sum and V known tokens,

    p(w) = (c(w) + 1) / (N + V + 1)
    p(w | v) = (c(v w) + MU p(w)) / (c(v) + MU)

a Dirichlet prior around the unigrams, so the probabilities of a context add up to one. The trie
has contexts on its first level, monotone pointers, and each context's successors on the second; log p(w | v) of
what was seen and log MU / (c(v) + MU) for the rest are quantised to a byte. A bigram is looked up as a
successor within its context's range.

How it is spread. A task gathers documents into packets of about PACKET tokens; a
packet is a row with its distinct words and the token sequence as numbers of them. Two
exchanges follow, each of packed slices, (packet, shard) -> bytes, of what is distinct in a packet:

1. words, sharded by hash: a shard adds up the counts, numbers the known words by falling
   count, and answers every slice with numbers and counts;
2. bigrams of these numbers: a shard adds up the counts, builds its trie, looks
   every asked bigram up in it and answers with a byte for each, on a grid that all shards share.

The answers meet the packets, which are bucketed so that they never move, and become sums by document. A
frequent word is as long as any other in a slice, as it is there once; bigrams of a frequent context are
dealt to several shards, as many as its count calls for. The number of shards
follows the number of tokens, so a shard's memory stays the same as the input grows.

A word is known by a 64-bit hash of its bytes and length (two of a billion words agree with probability 0.03).

Edge cases: a null text is empty and has one token, the end. A null doc_id is not held out. Without training documents every
probability is 1 and both scores 0. An empty table gives no rows. Repeated rows and ids are scored and counted row by row; a long text
makes its packet longer. Only doc_id and text are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelscope.llm.elias_fano import Trie, on_grid
from panelscope.llm.runs import runs
from panelscope.llm.store import released, shared_folder, stored
from panelscope.llm.words import lower_ascii, mix, slices, word_bounds, word_hashes

MU = 8.0
#: Tokens of a packet, distinct words asked of a shard and tokens whose bigrams are asked of a shard, about.
PACKET, WORDS_OF_SHARD, TOKENS_OF_SHARD = 1 << 20, 1 << 20, 1 << 21
#: A context of so many occurrences is spread over one shard more.
SPREAD = 1 << 17
SEEN_CODES, WEIGHT_CODES = 192, 64
_END = np.uint64(0x656E64206F662074)


# ------------------------------------------------------------ packing ----

def packed(values: np.ndarray) -> bytes:
    """Numbers as planes of bytes, as many as the largest needs; behind a byte that says how many."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpacked(data: pa.Scalar | bytes) -> np.ndarray:
    raw = np.frombuffer(data.as_buffer() if isinstance(data, pa.Scalar) else data, np.uint8)
    width = int(raw[0])
    out = np.zeros(((len(raw) - 1) // width, 8), np.uint8)
    out[:, :width] = raw[1:].reshape(width, -1).T
    return out.view("<u8").ravel().astype(np.int64)


def _binary(items: list[bytes]) -> pa.Array:
    return pa.array(items, pa.binary())


# ------------------------------------------------------------ packets ----

def _tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a slice's tokens, and each row's number of tokens."""
    starts, ends, rows = word_bounds(lower_ascii(raw), offsets)
    n = np.bincount(rows, minlength=len(offsets) - 1)
    words = word_hashes(lower_ascii(raw), starts, ends)
    return np.insert(words, np.cumsum(n), _END), n + 1


PACKETS = "packet long, tokens long, n_words long, doc_id array<long>, train array<boolean>, lengths array<int>, sequence binary, words binary, counts binary"


def _packets(most: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map function over (doc_id, train, text)."""
    first = TaskContext.get().partitionId() << 32
    held: list[tuple] = []
    size = 0

    def packet() -> pa.RecordBatch:
        nonlocal first, held, size
        ids, train, lengths, tokens = (np.concatenate(x) if k else pa.concat_arrays(x) for k, x in enumerate(zip(*held, strict=True)))
        words, sequence = np.unique(tokens, return_inverse=True)
        counts = np.bincount(sequence[np.repeat(train, lengths)], minlength=len(words))
        cut = pa.array([0, len(lengths)], pa.int32())
        row = pa.RecordBatch.from_arrays(
            [pa.array([first]), pa.array([len(tokens)]), pa.array([len(words)]), pa.ListArray.from_arrays(cut, ids), pa.ListArray.from_arrays(cut, pa.array(train)), pa.ListArray.from_arrays(cut, pa.array(lengths, pa.int32())), _binary([packed(sequence)]), _binary([words.tobytes()]), _binary([packed(counts)])],
            names=["packet", "tokens", "n_words", "doc_id", "train", "lengths", "sequence", "words", "counts"],
        )
        first, held, size = first + 1, [], 0
        return row

    for batch in batches:
        train = batch.column(1).to_numpy(zero_copy_only=False)
        for lo, hi, raw, offsets in slices(batch.column(2)):
            tokens, lengths = _tokens(raw, offsets)
            held.append((batch.column(0).slice(lo, hi - lo), train[lo:hi], lengths, tokens))
            size += len(tokens)
            if size >= most:
                yield packet()
    if held:
        yield packet()


# -------------------------------------------------------------- words ----

def _word_slices(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map function over (packet, words, counts): the slice of each shard, which are ranges of the sorted hashes."""
    edges = (np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.zeros(0, np.uint64)
    for batch in batches:
        for i in range(batch.num_rows):
            words = np.frombuffer(batch.column(1)[i].as_buffer(), np.uint64)
            counts = unpacked(batch.column(2)[i])
            cuts = np.concatenate([[0], np.searchsorted(words, edges), [len(words)]])
            some = np.flatnonzero(np.diff(cuts))
            ranges = [slice(cuts[s], cuts[s + 1]) for s in some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int64()), pa.array(np.full(len(some), batch.column(0)[i].as_py())), _binary([words[r].tobytes() for r in ranges]), _binary([packed(counts[r]) for r in ranges])],
                names=["shard", "packet", "words", "counts"],
            )


def _numbered(shards: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map function over the words' slices by shard: number (0: unknown) and count of each, and a row without packet of the shard's totals."""
    for run in runs(batches, (0,)):
        shard = run.column(0)[0].as_py()
        parts = [np.frombuffer(x.as_buffer(), np.uint64) for x in run.column(2)]
        words, of = np.unique(np.concatenate(parts), return_inverse=True)
        counts = np.zeros(len(words), np.int64)
        np.add.at(counts, of, np.concatenate([unpacked(x) for x in run.column(3)]))
        order = np.lexsort((words, -counts))
        number = np.empty(len(words), np.int64)
        number[order] = np.arange(len(words)) * shards + shard + 1
        number[counts == 0] = 0
        cuts = np.cumsum([0, *map(len, parts)])
        mine = [of[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        n = len(mine)
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard] * (n + 1)), pa.array([*run.column(1).to_pylist(), None], pa.int64()), _binary([*(packed(number[m]) for m in mine), None]), _binary([*(packed(counts[m]) for m in mine), None]),
             pa.array([None] * n + [int(counts.sum())], pa.int64()), pa.array([None] * n + [int((counts > 0).sum())], pa.int64())],
            names=["shard", "packet", "numbers", "counts", "total", "known"],
        )


# ------------------------------------------------------------ bigrams ----

def _pairs(sequence: np.ndarray, lengths: np.ndarray, end: int, numbers: np.ndarray, counts: np.ndarray, shards: int, each: int):
    """The packet's distinct bigrams with a known context, in order of shard, context and word; each token's place among them (-1: unknown context), and the shards' cuts."""
    before = np.empty(len(sequence), np.int64)
    before[1:] = sequence[:-1]
    before[np.concatenate([[0], np.cumsum(lengths)[:-1]])] = end
    known = numbers[before] > 0
    word = numbers[sequence]
    # all unknown words are number 0: one of them stands for the others
    same = np.where(word > 0, sequence, -1)
    keys, of = np.unique((before[known] << 32) | (same[known] + 1), return_inverse=True)
    v, w = keys >> 32, (keys & 0xFFFFFFFF) - 1
    v_number, w_number = numbers[v], np.where(w >= 0, numbers[w], 0)
    spread = counts[v] // each + 1
    salt = (mix(w_number.astype(np.uint64)) % spread.astype(np.uint64)).astype(np.int64)
    shard = ((mix(v_number.astype(np.uint64)) % np.uint64(shards)).astype(np.int64) + salt) % shards
    order = np.lexsort((w_number, v_number, shard))
    place = np.empty(len(keys), np.int64)
    place[order] = np.arange(len(keys))
    where = np.full(len(sequence), -1, np.int64)
    where[known] = place[of]
    v, w, shard = v[order], w[order], shard[order]
    return v, w, where, np.searchsorted(shard, np.arange(shards + 1))


def _answers(parts: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and counts of a packet's words from the shards' answers, which come in order of the hashes."""
    return np.concatenate([unpacked(p["numbers"]) for p in parts]), np.concatenate([unpacked(p["counts"]) for p in parts])


def _end_of(words: np.ndarray) -> int:
    return int(np.searchsorted(words, _END))


def _pair_slices(shards: int, each: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map function over packets with the words' answers: the bigram slices of each shard."""
    for batch in batches:
        for i in range(batch.num_rows):
            sequence = unpacked(batch.column("sequence")[i])
            lengths = batch.column("lengths")[i].values.to_numpy(zero_copy_only=False).astype(np.int64)
            train = batch.column("train")[i].values.to_numpy(zero_copy_only=False)
            numbers, counts = _answers(batch.column("answers")[i].as_py())
            end = _end_of(np.frombuffer(batch.column("words")[i].as_buffer(), np.uint64))
            v, w, where, cuts = _pairs(sequence, lengths, end, numbers, counts, shards, each)
            counted = where[np.repeat(train, lengths) & (where >= 0)]
            n = np.bincount(counted, minlength=len(v))
            v_number, w_number = numbers[v], np.where(w >= 0, numbers[w], 0)
            w_count = np.where(w >= 0, counts[w], 0)
            some = np.flatnonzero(np.diff(cuts))
            rows: list[list[bytes]] = [[] for _ in range(6)]
            for s in some:
                a, b = cuts[s], cuts[s + 1]
                heads = np.flatnonzero(np.concatenate([[True], v[a + 1 : b] != v[a : b - 1]]))
                for out, x in zip(rows, (v_number[a:b][heads], counts[v[a:b][heads]], np.diff(np.append(heads, b - a)), w_number[a:b], w_count[a:b], n[a:b]), strict=True):
                    out.append(packed(x))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int64()), pa.array(np.full(len(some), batch.column("packet")[i].as_py())), *map(_binary, rows)],
                names=["shard", "packet", "v", "v_count", "fan", "w", "w_count", "n"],
            )


def smoothed(n: np.ndarray, v_count: np.ndarray, w_count: np.ndarray, total: int, known: int) -> np.ndarray:
    """log10 p(w | v) of bigrams seen n times."""
    return np.log10((n + MU * (w_count + 1) / (total + known + 1)) / (v_count + MU))


def back_off(v_count: np.ndarray) -> np.ndarray:
    """log10 of what is left for each unit of p(w) in a context."""
    return np.log10(MU / (v_count + MU))


def _grids(total: int, weights: np.ndarray, chances: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Codes and books of back-off weights and of probabilities, on grids that depend on the tokens' number alone."""
    return [on_grid(weights, float(back_off(np.float64(total))), WEIGHT_CODES), on_grid(chances, float(-np.log10(total + MU)), SEEN_CODES)]


def _tries(total: int, known: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map function over the bigram slices by shard: the shard's trie (a row without packet) and a code for each asked bigram, with the book of codes."""
    for run in runs(batches, (0,)):
        shard = run.column(0)[0].as_py()
        v, v_count, fan, w, w_count, n = ([unpacked(x) for x in run.column(k)] for k in range(2, 8))
        cuts = np.cumsum([0, *map(len, w)])
        contexts, first, of = np.unique(np.concatenate(v), return_index=True, return_inverse=True)
        context_count = np.concatenate(v_count)[first]
        w, w_count, n = np.concatenate(w), np.concatenate(w_count), np.concatenate(n)
        base = int(w.max()) + 1
        keys, first, of = np.unique(np.repeat(of, np.concatenate(fan)) * base + w, return_index=True, return_inverse=True)
        seen = np.bincount(of, n).astype(np.int64)
        context, word, w_count = keys // base, keys % base, w_count[first]
        there = np.flatnonzero(seen)
        chance = smoothed(seen[there], context_count[context[there]], w_count[there], total, known)
        starts = np.searchsorted(context[there], np.arange(len(contexts) + 1))
        (weights, weight_book), (chances, chance_book) = _grids(total, back_off(context_count), chance)
        image = Trie.image([contexts, word[there]], [starts], [(weights, weight_book), (chances, chance_book)])
        trie = Trie(image)
        above, found = trie.find(contexts[context], word)
        code = np.where(found >= 0, trie.codes[1][found] if len(there) else 0, SEEN_CODES + trie.codes[0][above]).astype(np.uint8)
        code = code[of]
        packets = run.column(1).to_pylist()
        m = len(packets)
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard] * (m + 1)), pa.array([*packets, None], pa.int64()), _binary([*(code[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)), None]), _binary([None] * m + [image])],
            names=["shard", "packet", "codes", "trie"],
        )


# ------------------------------------------------------------- scores ----

SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scores(total: int, known: int, shards: int, each: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Map function over packets with both exchanges' answers."""
    nothing = np.zeros(0)
    (_, weight_book), (_, chance_book) = _grids(total, nothing, nothing)
    book = np.concatenate([chance_book, weight_book])
    for batch in batches:
        for i in range(batch.num_rows):
            sequence = unpacked(batch.column("sequence")[i])
            lengths = batch.column("lengths")[i].values.to_numpy(zero_copy_only=False).astype(np.int64)
            numbers, counts = _answers(batch.column("answers")[i].as_py())
            end = _end_of(np.frombuffer(batch.column("words")[i].as_buffer(), np.uint64))
            _, _, where, _ = _pairs(sequence, lengths, end, numbers, counts, shards, each)
            parts = batch.column("coded")[i].as_py() or []
            codes = np.concatenate([np.frombuffer(p["codes"], np.uint8) for p in parts]) if parts else np.zeros(0, np.uint8)
            values = book[codes]
            alone = np.log10((counts + 1) / (total + known + 1))[sequence]
            chance = alone.copy()
            asked = np.flatnonzero(where >= 0)
            place = where[asked]
            chance[asked] = values[place] + np.where(codes[place] < SEEN_CODES, 0.0, alone[asked])
            cuts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            n = len(lengths)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id")[i].values,
                    pa.array(~batch.column("train")[i].values.to_numpy(zero_copy_only=False)),
                    pa.array(lengths),
                    pa.array(np.add.reduceat((counts > 0)[sequence].astype(np.int64), cuts)),
                    pa.array(np.full(n, total)),
                    pa.array(np.add.reduceat(alone, cuts)),
                    pa.array(np.add.reduceat(chance, cuts)),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )


def _by_packet(answers: DataFrame, columns: list[str], out: str) -> DataFrame:
    """The answers to each packet in order of the shards; a packet bounds their number and size."""
    parts = F.sort_array(F.collect_list(F.struct("shard", *columns)))
    return answers.where("packet is not null").groupBy("packet").agg(parts.alias(out))


def held_out(doc_id: F.Column, parts: int = 7, part: int = 2) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(False))


def _stored_packets(docs: DataFrame, most: int) -> tuple[str, str]:
    """Name and folder of the packets' table, in buckets by packet, so that joins leave them where they are."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (~held_out(F.col("doc_id"))).alias("train"), "text")
    name = "ngram_packets_" + uuid.uuid4().hex
    path = f"{shared_folder(spark)}/{name}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.mapInArrow(partial(_packets, most), PACKETS).write.bucketBy(buckets, "packet").option("path", path).option("compression", "zstd").saveAsTable(name)
    return name, path


def scored(docs: DataFrame, packet_tokens: int = PACKET, words_of_shard: int = WORDS_OF_SHARD, tokens_of_shard: int = TOKENS_OF_SHARD, spread: int = SPREAD) -> tuple[DataFrame, DataFrame | None]:
    """Scores of every row of `docs` (doc_id, text), and the model's tries (shard, trie), a stored table; None if there are no rows."""
    spark = docs.sparkSession
    name, path = _stored_packets(docs, packet_tokens)
    packets = spark.table(name)
    tokens, n_words = packets.agg(F.sum("tokens"), F.sum("n_words")).first()
    if not tokens:
        spark.sql(f"DROP TABLE {name}")
        return spark.createDataFrame([], SCHEMA), None
    bits = max(0, (n_words // words_of_shard).bit_length())
    asked = packets.select("packet", "words", "counts").mapInArrow(partial(_word_slices, bits), "shard long, packet long, words binary, counts binary")
    by_shard = asked.repartition("shard").sortWithinPartitions("shard")
    answers = stored(by_shard.mapInArrow(partial(_numbered, 1 << bits), "shard long, packet long, numbers binary, counts binary, total long, known long"), "ngram-words")
    total, known = answers.agg(F.sum("total"), F.sum("known")).first()
    shards = -(-tokens // tokens_of_shard)
    words = _by_packet(answers, ["numbers", "counts"], "answers")
    of_words = packets.select("packet", "lengths", "train", "sequence", "words").join(words, "packet")
    pairs = of_words.mapInArrow(partial(_pair_slices, shards, spread), "shard long, packet long, v binary, v_count binary, fan binary, w binary, w_count binary, n binary")
    built = pairs.repartition("shard").sortWithinPartitions("shard").mapInArrow(partial(_tries, total, known), "shard long, packet long, codes binary, trie binary")
    tries = stored(built, "ngram-tries")
    coded = _by_packet(tries, ["codes"], "coded")
    met = packets.select("packet", "doc_id", "lengths", "train", "sequence", "words").join(words, "packet").join(coded, "packet", "left")
    scores = stored(met.mapInArrow(partial(_scores, total, known, shards, spread), SCHEMA), "ngram-scores")
    spark.sql(f"DROP TABLE {name}")
    released(answers, spark.read.schema(PACKETS).parquet(path))
    return scores, tries.where("trie is not null").select("shard", "trie")
