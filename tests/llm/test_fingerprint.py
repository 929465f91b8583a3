import hashlib

import numpy as np

from panelscope.llm import fingerprint as P


def plain_counts(data):
    """Triplets of each five-byte window, one by one."""
    out = np.zeros(P.BUCKETS, int)
    window = data + bytes(max(0, P.WINDOW - len(data))) if data else b""
    for i in range(len(window) - P.WINDOW + 1):
        for (a, b, c), salt in zip(P.TRIPLETS, P._SALTS.tolist()):
            x = (window[i + a] | window[i + b] << 8 | window[i + c] << 16) * salt % 2**32
            x ^= x >> 15
            out[x * 0x2C1B3C6D % 2**32 >> 25] += 1
    return out


def test_counts_one_by_one():
    texts = [b"", b"a", b"abcd", b"abcde", b"hello world", b"\x00\x00", bytes(range(256))]
    raw, offsets = P._packed(texts)
    assert (P.bucket_counts(raw, offsets) == np.array([plain_counts(t) for t in texts])).all()


def test_equals_brute_force(documents):
    rows = {r.doc_id: r for r in P.fingerprints(documents, range_rows=30).collect()}
    texts = sorted(((r.doc_id, r.text) for r in documents.collect()), reverse=True)
    for k, (doc_id, text) in enumerate(texts):
        following = texts[(k + 1) % len(texts)][1]
        n = len(text) // 3
        changed = text[: len(text) - n] + following[:n]
        a, b, c = (P.digests(*P._packed([t.encode()])) for t in (text, changed, following))
        r = rows[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (a.tobytes().hex(), b.tobytes().hex())
        assert (r.near_edited, r.near_next) == (P.likeness(a, b)[0], P.likeness(a, c)[0])
    whole = {r.doc_id: tuple(r) for r in P.fingerprints(documents).collect()}
    assert whole == {k: tuple(r) for k, r in rows.items()}


def test_edited_texts_are_nearer_than_others(documents):
    rows = P.fingerprints(documents).collect()
    assert np.mean([r.near_edited for r in rows]) > np.mean([r.near_next for r in rows]) + 0.05


def test_likeness_bounds():
    d = P.digests(*P._packed([b"", b"", b"a", b"some words in a row", b"\xff" * 100]))
    for x in d:
        for y in d:
            assert 0 <= P.likeness(x[None], y[None])[0] <= 1
            assert (P.likeness(x[None], y[None])[0] == 1) == (x.tobytes() == y.tobytes())


def test_odd_rows(odd, nothing):
    rows = sorted(((r.doc_id, r.n_chars) for r in P.fingerprints(odd, range_rows=2).collect()), key=str)
    assert rows == sorted([(1, 0), (2, 0), (3, 3), (4, 13), (4, 13), (4, 16), (5, 300_000), (None, 12), (6, 210)], key=str)
    assert P.fingerprints(nothing).count() == 0
    (only,) = P.fingerprints(odd.where("doc_id = 6")).collect()
    text = "ÉÈ 你好 Ω" * 30
    assert only.near_next == 1.0
    assert only.edited_sha256 == hashlib.sha256((text[: len(text) - len(text) // 3] + text[: len(text) // 3]).encode()).hexdigest()
