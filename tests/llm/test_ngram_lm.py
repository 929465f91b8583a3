import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from panelscope.llm import ngram_lm
from panelscope.llm.elias_fano import Trie

_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
END = object()


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(_FOLD)), END]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def brute(rows):
    """(doc_id, text) rows to doc_id, held_out, n_tokens, n_known, train_tokens, base_score and the score without quantisation."""
    one, two = Counter(), Counter()
    for i, text in rows:
        if not held(i):
            words = tokens(text)
            one.update(words)
            two.update(zip([END, *words], words, strict=False))
    total, known = sum(one.values()), len(one)
    out = []
    for i, text in rows:
        words = tokens(text)
        alone = [(one[w] + 1) / (total + known + 1) for w in words]
        both = [(two[v, w] + ngram_lm.MU * p) / (one[v] + ngram_lm.MU) for v, w, p in zip([END, *words], words, alone, strict=False)]
        out.append((i, held(i), len(words), sum(one[w] > 0 for w in words), total, sum(map(math.log10, alone)), sum(map(math.log10, both))))
    return sorted(out, key=lambda r: str(r[:3]) + f"{r[5]:.6f}")


def held_against(df, rows):
    got = sorted((tuple(r) for r in df.collect()), key=lambda r: str(r[:3]) + f"{r[5]:.6f}")
    want = brute(rows)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-12, atol=1e-9)
    for g, w in zip(got, want, strict=True):  # half a step of the coarser grid for each token at most
        step = math.log10(w[4] / ngram_lm.MU + 1) / (ngram_lm.WEIGHT_CODES - 1)
        assert abs(g[6] - w[6]) <= g[2] * step / 2 + 1e-6
    return got, want


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, documents, small):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sizes = (3000, 500, 2000) if small else ()
    scores, tries = ngram_lm.scored(df, *sizes)
    got, want = held_against(scores, rows)
    assert abs(sum(g[6] for g in got) / sum(w[6] for w in want) - 1) < 2e-3
    assert (tries.count() > 20) == small
    out = [g for g in got if g[1]]
    assert sum(g[6] for g in out) > sum(g[5] for g in out)  # the held-out texts are likelier than by words alone


def test_hot_context_is_spread(spark):
    rows = [(i, " ".join(f"the w{(i * 7 + k) % 300}" for k in range(40))) for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    scores, tries = ngram_lm.scored(df, 1000, 100, 1000, 200)
    sizes = [Trie(bytes(r.trie)).ids[1].n for r in tries.collect()]
    assert max(sizes) < 4 * sum(sizes) / len(sizes)
    held_against(scores, rows)


def test_odd_rows(spark, odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    held_against(ngram_lm.scored(odd)[0], rows)
    assert ngram_lm.scored(nothing)[0].collect() == []
    only = [i for i in range(60) if held(i)]
    df = spark.createDataFrame([(i, "nothing was learnt") for i in only], "doc_id long, text string")
    assert {(r.train_tokens, r.n_known, r.base_score, r.score) for r in ngram_lm.scored(df)[0].collect()} == {(0, 0, 0.0, 0.0)}


def test_planes_round_trip():
    for x in ([], [0], [255, 256], [1 << 40, 3]):
        assert ngram_lm.unpacked(ngram_lm.packed(np.array(x, np.int64))).tolist() == x
