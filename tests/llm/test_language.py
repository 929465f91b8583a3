import zlib

import numpy as np

from panelscope.llm import language as L


def test_held_out_accuracy(documents):
    rows = L.languages(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 20 and sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_bundles_are_sums_of_bound_permuted_letters():
    text = "Ab, Éa"
    raw = np.frombuffer(text.encode(), np.uint8)
    codes, rows = L.trigrams(raw, np.array([0, len(raw)]))
    slots = [0, 1, 2, 0, int(L._SLOTS[ord("é")]), 1, 0]
    want = np.zeros(L.DIMENSIONS, int)
    for a, b, c in zip(slots, slots[1:], slots[2:]):
        if b:
            want += np.roll(L._VECTORS[a], 2) * np.roll(L._VECTORS[b], 1) * L._VECTORS[c]
    assert (L.bundles(codes, rows, 1)[0] == want).all()


def test_odd_rows(odd, nothing):
    rows = {(r.doc_id, r.lang_pred, r.score > 0) for r in L.languages(odd).collect()}
    assert {(1, "und", False), (2, "und", False), (3, "und", False)} <= rows
    assert L.languages(odd).count() == 9 and L.languages(nothing).count() == 0
    untaught = L.languages(odd.withColumn("lang", odd.lang.substr(1, 0).cast("string")).where("lang is null"))
    assert {r.lang_pred for r in untaught.collect()} <= {"und"}


def test_signs_beyond_the_basic_plane_are_no_letters(spark):
    taught = [(k, "plain words of one language", "en") for k in range(20)] + [(k, "andere Wörter hier im Satz", "de") for k in range(20, 40)]
    docs = spark.createDataFrame([*taught, (100, "🎉😀 12 🚀!", None), (101, "🎉", None), (102, "𐐀𐐁𐐂 𐐨𐐩", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.languages(docs).collect()}
    assert got[100] == got[101] == ("und", 0.0)
    assert got[102][0] in ("en", "de") and L._SLOTS[0x10400] == L._SLOTS[0x10428] > 0
    raw = np.frombuffer("a🎉b".encode(), np.uint8)
    assert L.letters(raw, np.array([0, len(raw)]))[0].tolist() == [0, 1, 0, 2]


def test_only_text_counts(documents):
    """Ids that are held out change nothing about a prediction."""
    one = documents.orderBy("doc_id").limit(60)
    vectors = L.prototypes(documents)
    again = L.prototypes(documents.withColumnRenamed("source", "x").withColumn("n_chars", documents.n_chars * 2))
    assert vectors[0] == again[0] and (vectors[1] == again[1]).all()
    assert one.count() == 60


def test_many_short_texts_take_little_memory(documents):
    import random
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    names, vectors = L.prototypes(documents)
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzäöüß   ") for _ in range(50)) for _ in range(10_000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(10_000)), pa.array([False] * 10_000), pa.array(texts)], names=["doc_id", "held_out", "text"])
    tracemalloc.start()
    many = pa.Table.from_batches(list(L.predictor(names, vectors)(iter([batch]))))
    assert tracemalloc.get_traced_memory()[1] < 200 << 20
    tracemalloc.stop()
    one = pa.concat_tables([pa.Table.from_batches(list(L.predictor(names, vectors)(iter([batch.slice(k, 1)])))) for k in range(0, 10_000, 97)])
    assert one.equals(many.take(np.arange(0, 10_000, 97)).combine_chunks()) or one.to_pylist() == many.take(np.arange(0, 10_000, 97)).to_pylist()
