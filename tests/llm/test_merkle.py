import hashlib
import zlib

import numpy as np
import pytest

from panelscope.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def up(levels, i):
    """Siblings of each level, and what the leaf's place in each run is."""
    out = []
    for level in levels[:-1]:
        lo = i // 16 * 16
        run = level[lo : lo + 16]
        out.append((i - lo, run[: i - lo] + run[i - lo + 1 :]))
        i //= 16
    return out


def brute(rows):
    """Rows (doc_id, source, lang, n_chars, text) to the expected rows, sorted."""
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    of = {}
    for r in rows:
        of.setdefault(r[1], []).append((h(*map(field, r)), r))
    names = sorted(of, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        of[s].sort(key=lambda x: (x[1][0] is not None, x[1][0] or 0, x[0]))
    trees = {s: tree([d for d, _ in of[s]]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for j, s in enumerate(names):
        for i, (d, r) in enumerate(of[s]):
            steps = up(trees[s], i) + up(top, j)
            now = d
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                now = h(*map(field, (*r[:4], r[4] if r[4] is None else r[4].translate(fold))))
            for k, others in steps:
                now = h(*others[:k], now, *others[k:])
            proof = h(*(x for _, others in steps for x in others))
            out.append((r[0], d, trees[s][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


FIELDS = "doc_id", "source", "lang", "n_chars", "text"


@pytest.mark.parametrize("levels", [2, 4])
def test_equals_brute_force(spark, documents, levels):
    docs = documents.limit(90) if levels == 2 else documents  # two levels: 16 leaves a block, so several rounds
    rows = [tuple(r) for r in docs.select(*FIELDS).collect()]
    got = merkle.manifest(spark.createDataFrame(rows, documents.select(*FIELDS).schema).repartition(5), levels)
    assert rows_of(got) == brute(rows)


def test_many_rounds_and_a_hot_source(spark):
    rows = [(i, "hot" if i % 3 else f"s{i % 40}", "en", i, f"Text {i}") for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    assert rows_of(merkle.manifest(df, 2)) == brute(rows)


def test_odd_rows(spark, odd, nothing):
    rows = [tuple(r) for r in odd.select(*FIELDS).collect()]
    assert rows_of(merkle.manifest(odd)) == brute(rows)
    assert merkle.manifest(nothing).collect() == []
    one = odd.where("doc_id = 1")
    (only,) = merkle.manifest(one).collect()
    assert only.leaf == only.subroot == only.root and only.proof_sha256 == h()


def test_tampering_shows_only_where_the_text_changes(spark):
    rows = [(i, "a", "en", 3, "ABC" if i % 2 else "abc") for i in range(60)]
    got = {r.doc_id: r for r in merkle.manifest(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")).collect()}
    for i, r in got.items():
        assert r.verified == (not (i % 2 and zlib.crc32(str(i).encode()) % 5 == 0))


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_layout_is_a_permutation_with_whole_subtrees(levels):
    places = np.concatenate([np.atleast_1d(a) for a in merkle.layout(levels)])
    assert sorted(places.tolist()) == list(range(merkle.nodes_of(levels)))
    if levels > 1:  # every bottom tree lies in one stretch
        top = levels // 2
        size = merkle.nodes_of(levels - top)
        leaves = merkle.layout(levels)[0]
        for k in range(0, len(leaves), 16 ** (levels - top - 1)):
            inside = leaves[k : k + 16 ** (levels - top - 1)]
            assert {int(x - merkle.nodes_of(top)) // size for x in inside} == {k // 16 ** (levels - top - 1)}
