import re

import numpy as np
import pyarrow as pa

from panelscope.llm import words as W

TEXTS = ["a b  c", "", None, " lead trail ", "x y z w", "\x1cfs\x1f us", "same same", "b", "ab", "a" * 5000, "é é\n\vé"]


def test_words_and_hashes_match_python():
    by_word = {}
    for most in (1, 7, 1 << 20):
        for lo, hi, raw, offsets in W.slices(pa.array(TEXTS), most):
            starts, ends, rows = W.word_bounds(raw, offsets)
            got = [raw[a:b].tobytes().decode() for a, b in zip(starts, ends)]
            want = [re.findall("[^\x20\x09-\x0d]+", t or "") for t in TEXTS[lo:hi]]
            assert got == [w for ws in want for w in ws]
            assert rows.tolist() == [k for k, ws in enumerate(want) for _ in ws]
            for w, h in zip(got, W.word_hashes(raw, starts, ends)):
                by_word.setdefault(w, set()).add(int(h))
            assert W.code_points(raw, offsets).tolist() == [len(t or "") for t in TEXTS[lo:hi]]
    assert all(len(h) == 1 for h in by_word.values())
    assert len({next(iter(h)) for h in by_word.values()}) == len(by_word)


def test_powers_are_exact():
    assert pow(W._BASE, W.SLICE_BYTES, 1 << 64) == int(W._POWERS[-1])
    with np.errstate(over="ignore"):
        assert (W._POWERS * W._INVERSES == 1).all()


def test_hashes_of_long_words(monkeypatch):
    word = "abcdefghij" * 50
    raw = np.frombuffer(f"x {word} y".encode(), np.uint8)
    whole = W.word_hashes(raw, *W.word_bounds(raw, np.array([0, len(raw)]))[:2])
    monkeypatch.setattr(W, "SLICE_BYTES", 64)
    assert (W.word_hashes(raw, *W.word_bounds(raw, np.array([0, len(raw)]))[:2]) == whole).all()


def test_windows_stay_in_their_row():
    _, _, raw, offsets = next(W.slices(pa.array(["a b c", "a b c d", "a"])))
    starts, ends, rows = W.word_bounds(raw, offsets)
    hashes, at = W.window_hashes(W.word_hashes(raw, starts, ends), rows, 3)
    assert rows[at].tolist() == [0, 1, 1]
    assert hashes[0] == hashes[1] != hashes[2]
