import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelscope.llm.elias_fano import Sequence64, Trie, encoded, on_grid


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1 << 45), max_size=300), st.integers(0, 40))
def test_round_trip_and_successors(values, shift):
    values = np.sort(np.array([v >> shift for v in values], np.uint64))
    s = Sequence64(memoryview(encoded(values)))
    assert s.n == len(values) and np.array_equal(s.get(np.arange(s.n)), values)
    asked = np.concatenate([values, values + np.uint64(1), values // np.uint64(2), np.array([0, 1, (1 << 46)], np.uint64)])
    assert np.array_equal(s.successor(asked), np.searchsorted(values, asked, "left"))


def test_size_is_near_two_bits_and_the_log():
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 34, 1 << 16).astype(np.uint64))
    assert len(encoded(values)) * 8 / len(values) < 18 + 2 * 1.5 + 1  # the high bits carry half as much again of counts


@pytest.mark.parametrize("seed", range(4))
def test_trie_of_three_levels_against_a_dict(seed, tmp_path):
    rng = np.random.default_rng(seed)
    grams = np.unique(rng.integers(0, [8, 30, 50], (600, 3)), axis=0)
    firsts, at1 = np.unique(grams[:, :1], axis=0, return_index=True)
    pairs, at2 = np.unique(grams[:, :2], axis=0, return_index=True)
    one = np.append(np.searchsorted(at2, at1), len(pairs))
    two = np.append(at2, len(grams))
    values = [-rng.random(len(x)) * 5 for x in (firsts, pairs, grams)]
    path = tmp_path / "trie"
    path.write_bytes(Trie.image([firsts[:, 0], pairs[:, 1], grams[:, 2]], [one, two], [on_grid(v, -5.0, 256) for v in values]))
    trie = Trie.mapped(str(path))
    asked = np.unique(np.concatenate([grams, rng.integers(0, [10, 32, 55], (500, 3))]), axis=0)
    nodes = trie.find(*asked.T)
    for k, known in enumerate(({tuple(g[: j + 1]): i for i, g in enumerate(rows)} for j, rows in enumerate((firsts, pairs, grams)))):
        assert nodes[k].tolist() == [known.get(tuple(g[: k + 1]), -1) for g in asked]
    there = nodes[1] >= 0
    assert np.abs(trie.value(1, nodes[1][there]) - values[1][nodes[1][there]]).max() < 0.0099


def test_empty_levels_and_ranges():
    trie = Trie(Trie.image([np.array([3, 9]), np.array([], np.uint64)], [np.array([0, 0, 0])], [on_grid(np.zeros(n), -1.0, 4) for n in (2, 0)]))
    assert [n.tolist() for n in trie.find(np.array([3, 4]), np.array([1, 1]))] == [[0, -1], [-1, -1]]
    trie = Trie(Trie.image([np.array([0, 1, 2]), np.array([0, 5, 0])], [np.array([0, 2, 2, 3])], [on_grid(np.zeros(3), -1.0, 4)] * 2))
    assert trie.find(np.array([0, 0, 1, 2, 2]), np.array([0, 5, 0, 0, 5]))[1].tolist() == [0, 1, -1, 2, -1]


def test_grid_takes_the_nearest_value():
    x = -np.random.default_rng(3).random(5000) * 7
    code, book = on_grid(x, -7.0, 192)
    assert len(book) == 192 and np.abs(book[code] - x).max() <= 7 / 191 / 2 + 1e-12
    assert on_grid(np.zeros(2), 0.0, 64)[1].tolist() == [0.0] * 64
