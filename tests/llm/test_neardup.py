import random
import re
from collections import Counter, defaultdict

import pytest

from panelscope.llm import neardup as N


def brute(rows):
    """Least reachable id and set size by comparing all sets that share a shingle."""
    sets = {}
    for i, t in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = re.findall("[^\x20\x09-\x0d]+", low)
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    posts = defaultdict(list)
    for i in sorted(sets):
        shared = Counter(j for s in sets[i] for j in posts[s])
        for s in sets[i]:
            posts[s].append(i)
        for j, n in shared.items():
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in N.near_duplicates(df).collect()}


def test_equals_brute_force(spark, documents):
    assert result(documents) == brute([tuple(r) for r in documents.select("doc_id", "text").collect()])


@pytest.fixture(scope="module")
def family(spark):
    """A large group of near copies, edited more and more, documents around one passage, and exact copies."""
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(4000)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for k in range(220):
        copy = list(base)
        for _ in range(k % 9):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        rows.append((1000 - k, " ".join(copy)))
    for k in range(150):
        rows.append((2000 + k, " ".join([*passage, *(rng.choice(vocabulary) for _ in range(rng.randrange(5, 60)))])))
    rows += [(3000 + k, "Exactly the same words in these texts") for k in range(40)] + [(4000, "exactly THE same words in these  texts"), (4001, "two words"), (4002, "Two words")]
    return rows


def test_hot_groups_equal_brute_force(spark, family, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 16)  # several blocks for each long list
    assert result(spark.createDataFrame(family, "doc_id long, text string")) == brute(family)


def test_odd_rows(spark, odd, nothing):
    rows = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in N.near_duplicates(odd).collect()), key=str)
    assert rows == sorted(
        [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (4, 1, 4, True), (4, 1, 4, True), (5, 1, 5, True), (None, 1, None, True), (6, *brute([(6, "ÉÈ 你好 Ω" * 30)])[6])], key=str
    )
    assert N.near_duplicates(nothing).count() == 0
    kept = N.kept(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "4", "5", "6", "None"]
    assert N.kept(nothing).count() == 0


def test_names_that_clash_with_our_own_columns(spark):
    rows = [(1, "one two three four five six", 7, 8), (1, "one two three four five six", 7, 8), (2, "one two three four five six", 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __n int, __KEPT int")
    assert [tuple(r) for r in N.kept(docs).collect()] == [rows[0]]
