import zlib
from collections import defaultdict

import corpus_pipeline as C
from panelscope.llm import quality_rules, secret_scan
from panelscope.llm.queries import ORACLES, QUERIES
from test_mixture_and_hosts import plain_mix, words
from test_neardup import brute
from test_packing import ids_of

SF = "/root/testdata/sf0.001"


def test_registered():
    import __spark_entry__ as entry

    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_equals_brute_force(spark, documents, labels):
    docs = {r.doc_id: r for r in documents.collect()}
    good = {r.doc_id for r in quality_rules.quality_rules(documents, labels).where("kept").collect()}
    groups = brute([(i, docs[i].text) for i in sorted(good)])
    kept = {i: docs[i].text for i in sorted(good) if groups[i][2]}
    clean = [(i, secret_scan.redacted_text(t), docs[i].source) for i, t in kept.items()]
    want = defaultdict(int)
    for i, _, _, _, taken in plain_mix(clean):
        want[i] += taken
    text = {i: t for i, t, _ in clean}
    rows = C.run(spark, SF).collect()
    got = defaultdict(int)
    for r in rows:
        if r.start == 0:
            got[r.doc_id] += 1
    assert set(got) == {i for i, n in want.items() if n}
    assert all(got[i] == -(-n // words(text[i])) for i, n in want.items() if n)
    whole = {i: ids_of([text[i]])[0] for i, n in want.items() if n % words(text[i]) == 0 and n == words(text[i])}
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    for i, ids in whole.items():
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].astype("<u4").tobytes())
            at += r.length
        assert at == len(ids)


def test_stages_return_the_columns(spark, documents, odd, nothing):
    for name, stage in C.STAGES[:-1]:
        for docs in (odd, nothing):
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            out.collect()
    assert C.STAGES[-1][1](spark, nothing, SF).count() == 0
    assert 4 <= len(C.STAGES) <= 5
