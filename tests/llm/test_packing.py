import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelscope.llm import packing as P
from panelscope.llm.queries import tokenizer_path


def ids_of(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    return [np.array([*t.encode(x or "", add_special_tokens=False).ids, P.END], "<u4") for x in texts]


def check(rows, docs):
    """Round trip: the pieces of each document cover its ids once; sequences have no gaps and little padding."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for doc_id, ids in docs.items():
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048 and at & (at - 1) == 0  # no padding at all
    return sequences


def test_round_trip(documents):
    rows = P.packs(documents, tokenizer_path()).collect()
    texts = documents.select("doc_id", "text").collect()
    sequences = check(rows, dict(zip([t.doc_id for t in texts], ids_of([t.text for t in texts]))))
    full = sum(1 for s in sequences.values() if sum(r.length for r in s) in P.TIERS)
    assert full > 0.7 * len(sequences)
    loads = defaultdict(int)
    for r in rows:
        loads[r.step_group] += r.length
    assert max(loads.values()) <= P.GROUP_TOKENS


def test_groups_of_a_pool_hold_equally_many_ids_of_each_tier(spark):
    sizes = [2100 + 173 * (k % 40) if k % 3 == 0 else 20 + 37 * (k % 50) for k in range(400)]
    docs = spark.createDataFrame([(k, "the " * n) for k, n in enumerate(sizes)], "doc_id long, text string").coalesce(1)
    rows = P.packs(docs, tokenizer_path()).collect()
    loads = defaultdict(lambda: defaultdict(int))
    for r in rows:
        loads[r.tier][r.step_group] += r.length
    groups = {r.step_group for r in rows}
    assert len(groups) > 4 and len(loads) > 2
    for tier, load in loads.items():
        assert max(load.values()) - min(load.get(g, 0) for g in groups) <= tier
    assert max(sum(load.get(g, 0) for load in loads.values()) for g in groups) <= P.GROUP_TOKENS


def test_small_pools(documents):
    texts = documents.select("doc_id", "text").collect()
    check(P.packs(documents, tokenizer_path(), pool=5000).collect(), dict(zip([t.doc_id for t in texts], ids_of([t.text for t in texts]))))


def test_odd_rows(spark, odd, nothing):
    rows = P.packs(odd, tokenizer_path()).collect()
    assert sum(r.length for r in rows if r.doc_id in (1, 2, 3)) == 3
    assert sum(r.length for r in rows if r.doc_id == 4) == sum(map(len, ids_of(["one two three"] * 2 + ["other words here"])))
    assert max(r.doc_tokens for r in rows if r.doc_id == 5) == 60_001
    assert P.packs(nothing, tokenizer_path()).count() == 0


@pytest.mark.parametrize("text", ["it's IT'S we've a1b22 x²½ «é» ﬁ Å ï İstanbul ẞ", "<|endoftext|> a<|startoftext|>b", "\x1ca\x1fb \x85 \xa0nbsp\xa0 　c", "日本語 テスト 🎉🎉 é", "!!!'s don't 'sa '' 'll", "Σ ΟΔΟΣ"])
def test_words_as_the_tokenizer(text):
    assert P.Words(tokenizer_path()).encode([text.encode()])[0].tolist() == ids_of([text])[0].tolist()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_any_text_as_the_tokenizer(text):
    words = P._words.get(tokenizer_path()) or P._words.setdefault(tokenizer_path(), P.Words(tokenizer_path()))
    assert words.encode([text.encode()])[0].tolist() == ids_of([text])[0].tolist()


def test_cache_may_be_cleared(monkeypatch):
    monkeypatch.setattr(P, "CACHE_BYTES", 700)
    words = P.Words(tokenizer_path())
    texts = [f"alpha{k} beta gamma{k % 2} delta" for k in range(9)]
    for t in texts:
        assert words.encode([t.encode()])[0].tolist() == ids_of([t])[0].tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 2047), max_size=60), st.booleans())
def test_packed_covers_every_id_once(sizes, last):
    out, keep = P.packed(sizes, last)
    seen = defaultdict(list)
    for sequence in out:
        total = sum(b - a for _, a, b in sequence)
        assert 0 < total <= 2048 and total & (total - 1) == 0
        for k, a, b in sequence:
            seen[k].append((a, b))
    for k, n in enumerate(sizes):
        spans = sorted(seen[k])
        assert (k in keep) == (not spans)
        if spans:
            assert spans[0][0] == 0 and spans[-1][1] == n and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
    assert not (last and keep)
