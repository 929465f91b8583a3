import re
import zlib

import numpy as np

from panelscope.llm import quality_rank as R
from panelscope.llm import quality_rules as Q


def test_held_out_quality(spark):
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = R.quality_scores(documents, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.quality for r in held) >= 0.93 * len(held)


def test_pairwise_fit_orders_and_cuts_at_the_quantile():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(1, 1, (600, 3)), rng.normal(-1, 1, (200, 3))
    model = R.Ranking(good, bad, 0.25)
    both = model.score(np.concatenate([good, bad]))
    assert abs((both < 0.5).mean() - 0.25) < 0.01
    assert (model.score(good).mean() > 0.8) and (model.score(bad).mean() < 0.2)


def test_threshold_covers_all_labelled_documents(spark):
    """A small fit sample does not set the cut: as many labelled documents fall below it as have label 0."""
    documents, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = R.fit(documents, labels, sample=20)
    known = labels.where("quality in (0, 1)").where(~R.held_out(labels.doc_id)).select("doc_id", "quality")
    rows = R.quality_scores(documents, labels, sample=20).join(known, "doc_id").collect()
    bad = sum(r.quality == 0 for r in rows)
    texts = sorted(documents.join(known, "doc_id", "left_semi").select("text").collect())
    raw = [(t.text or "").encode() for t in texts]
    margins = np.sort(np.round(model.margin(R.features(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))), 9))
    assert len(margins) == len(rows) > 250 and 20 < bad < len(rows)
    assert abs(model.threshold - (margins[bad - 1] + margins[bad]) / 2) < 1e-8
    assert abs(sum(r.predicted == 0 for r in rows) - bad) <= 2


def test_scores_ignore_order_and_neighbours(spark, documents, labels):
    a = {r.doc_id: r.score for r in R.quality_scores(documents, labels).collect()}
    b = {r.doc_id: r.score for r in R.quality_scores(documents.repartition(7), labels).collect()}
    assert a == b


def test_rank_odd_rows(odd, nothing, labels, no_labels):
    assert R.quality_scores(odd, labels).count() == 9
    assert {r.score for r in R.quality_scores(odd, no_labels).collect()} == {0.5}
    assert R.quality_scores(nothing, labels).count() == 0


def plain_statistics(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    hit = {j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(k, k + 8)}
    seen, twice = set(), 0
    for line in (text or "").split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            twice += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")), twice, len(hit)


def test_rules_equal_plain_counts(documents, odd, labels):
    for docs in (documents.where("n_chars < 12000"), odd.where("doc_id <> 5")):
        rows = Q.quality_rules(docs, labels).collect()
        want = sorted(((d, *plain_statistics(t)) for d, t in docs.select("doc_id", "text").collect()), key=str)
        assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows), key=str) == want
        for r in rows:
            assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
            assert r.kept == (not r.base_failed and r.llr >= Q.LEAST_SCORE)


def test_scores_equal_plain_log_ratios(documents, labels):
    def buckets(text):
        data = (text or "").encode()
        return [(int.from_bytes(data[k : k + 4], "little") * 0x9E3779B1 % 2**32) >> 16 for k in range(len(data) - 3)]

    docs = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    trusted = {r.doc_id for r in labels.where("quality = 1 and toxic = 0").collect()}
    every, good = np.zeros(Q.BUCKETS), np.zeros(Q.BUCKETS)
    for doc_id, text in docs:
        for b in buckets(text):
            every[b] += 1
            good[b] += doc_id in trusted
    ratio = np.log((good + 1) / (good + 1).sum()) - np.log((every + 1) / (every + 1).sum())
    got = {r.doc_id: r.llr for r in Q.quality_rules(documents, labels).collect()}
    for doc_id, text in docs:
        b = buckets(text)
        assert abs(got[doc_id] - (ratio[b].mean() if b else 0)) < 1e-6


def test_every_trusted_document_counts(spark):
    """More trusted documents than any fit samples, each with n-grams of its own kind."""
    n = 24_000
    docs = spark.range(2 * n).selectExpr("id as doc_id", "concat('w', id % 7, if(id % 2 = 0, ' good ', ' poor '), id % 11) as text")
    labels = spark.range(2 * n).selectExpr("id as doc_id", "cast(id % 2 = 0 as int) as quality", "0 as toxic").union(spark.createDataFrame([(None, 1, 0), (0, 1, 0)], "doc_id long, quality int, toxic int"))
    every, good = np.zeros(Q.BUCKETS), np.zeros(Q.BUCKETS)
    for i in range(2 * n):
        data = f"w{i % 7}{' poor ' if i % 2 else ' good '}{i % 11}".encode()
        for k in range(len(data) - 3):
            b = (int.from_bytes(data[k : k + 4], "little") * 0x9E3779B1 % 2**32) >> 16
            every[b] += 1
            good[b] += i % 2 == 0
    want = np.log((good + 1) / (good + 1).sum()) - np.log((every + 1) / (every + 1).sum())
    assert np.allclose(Q.log_ratios(docs, labels), want, atol=1e-12)
    unknown = docs.union(spark.createDataFrame([(None, "no id")], "doc_id long, text string"))
    assert Q.trusted_flags(unknown, labels).where("trusted").count() == n


def test_rules_keep_good_and_drop_bad(documents, labels):
    rows = Q.quality_rules(documents, labels).where("not base_failed").join(labels, "doc_id").collect()
    assert all(r.kept for r in rows if r.quality == 1)
    bad = [r for r in rows if r.quality == 0]
    assert sum(not r.kept for r in bad) >= 0.7 * len(bad)


def test_rules_odd_rows(odd, nothing, labels, no_labels):
    assert {r.llr for r in Q.quality_rules(odd, no_labels).collect()} == {0.0}
    assert Q.quality_rules(nothing, labels).count() == 0
    stay = Q.kept(odd, no_labels)
    assert stay.columns == odd.columns
    assert {r.doc_id for r in stay.collect()} == {r.doc_id for r in Q.quality_rules(odd, no_labels).where("kept").collect()}
    assert Q.kept(nothing, labels).count() == 0
