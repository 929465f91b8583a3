import random
import re
import tempfile
import unicodedata

from panelscope.operators import resolve as RS
from panelscope.plans import jobs as JB


def lookup(spark):
    rows = [
        ("Doña Ana", "NM", "35013", 1), ("Anaheim City", "CA", "06059", 2), ("Santa Ana", "CA", "06060", 3),
        ("Orleans Parish", "LA", "22071", 4), ("Ana", None, "00000", 5), ("Kansas City", "MO", "29095", 6),
        *[(f"Banana {i}", "XX", f"9{i:04d}", 10 + i) for i in range(20)],
    ]
    return spark.createDataFrame(rows, "name string, group_code string, key string, ord long")


def test_normalize_and_display(spark):
    df = spark.createDataFrame([("  Doña  Ana! ",), ("Kansas City",), ("Cityville",), ("Orleans Parish",)], "x string")
    out = df.select(RS.normalize_text("x").alias("n"), RS.display_name("x").alias("d")).collect()
    assert [r.n for r in out] == ["dona ana", "kansas city", "cityville", "orleans parish"]
    assert [r.d for r in out] == ["Doña  Ana! County", "Kansas City", "Cityville County", "Orleans Parish"]


def test_prefix_first_then_contains_in_file_order(spark):
    q = spark.createDataFrame([(1, "ana"), (2, "x"), (3, " a ")], "query_id long, query_text string")
    out = RS.resolve_names(lookup(spark), q).orderBy("query_id", "rank").collect()
    assert {r.query_id for r in out} == {1}  # short queries give nothing
    keys = [r.key for r in out]
    assert len(keys) == 12
    assert keys[:3] == ["06059", "35013", "06060"]  # prefix match first, then file order
    assert out[0].match == "prefix" and all(r.match == "contains" for r in out[1:])
    assert "00000" not in keys  # record with a missing field is dropped


def test_hot_query_ships_partial_top_k(spark):
    # "an" matches every name: still 12 results, and the limit runs per task before the shuffle
    q = spark.createDataFrame([(1, "an")], "query_id long, query_text string")
    out = RS.resolve_names(lookup(spark), q)
    assert out.count() == 12
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_folding_of_marks_and_widths(spark):
    from panelscope.operators.resolve import normalize_text

    names = ["Doña Ana", "Nguyễn", "Ａbc", "Straße", "ﬁord", "O’Brien 2²"]
    df = spark.createDataFrame([(n,) for n in names], "x string")
    assert [r[0] for r in df.select(normalize_text("x")).collect()] == ["dona ana", "nguyen", "abc", "stra e", "fiord", "o brien 22"]


def test_characters_that_spell_several(spark):
    names = ["№ 5", "Ⅻ Oaks", "20㎏", "½ Moon", "𝐀𝐧a 𝟚", "ﬃ", "①⑴", "℡x", "", "Ǆ Ǉ"]
    df = spark.createDataFrame([(n,) for n in names], "x string")
    assert [r[0] for r in df.select(RS.normalize_text("x")).collect()] == [folded(n) for n in names]
    assert folded("Ⅻ Oaks") == "xii oaks" and folded("𝐀𝐧a 𝟚") == "na 2"


def folded(text):
    """Lower case, NFKD, marks away, all else than letters and digits a blank: one text, by Python."""
    t = re.sub("[\u0300-\u036f]", "", unicodedata.normalize("NFKD", text.lower()))
    return re.sub(r"\s+", " ", re.sub(r"[^a-z0-9\s]", " ", t)).strip()


def brute_force(records, queries):
    out = []
    for qid, text in queries:
        q = folded(text or "")
        if len((text or "").strip()) < 2 or len(q) < 2:
            continue
        hits = [(0 if folded(n).startswith(q) else 1, o, k) for n, g, k, o in records if None not in (n, g, k) and q in folded(n)]
        out += [(qid, rank, k, "contains" if tier else "prefix") for rank, (tier, _, k) in enumerate(sorted(hits)[:12], 1)]
    return sorted(out)


def test_index_equals_brute_force(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abán ") for _ in range(rng.randint(0, 9)))
    records = [(word(), "G", str(i), i) for i in range(300)] + [("banana ban", "G", str(i), i) for i in range(300, 400)]
    records += [(None, "G", "900", 900), ("banana", None, "901", 901), ("", "G", "902", 902), ("b", "G", "903", 903), ("a" * 5000 + " end", "G", "904", 904)]
    texts = [word() for _ in range(120)] + ["an", "ban", "ana", "banana ban", "a end", "zz", "zzz", "banz", None, "", "  ", "!!", "an", "BÁN", "a" * 4000]
    queries = list(enumerate(texts))
    q = spark.createDataFrame(queries, "query_id long, query_text string")
    names = spark.createDataFrame(records, "name string, group_code string, key string, ord long")
    want = brute_force(records, queries)
    assert len(want) > 200
    folder = tempfile.mkdtemp(prefix="names-")
    JB.write_name_index(names, folder)
    for out in (RS.resolve_names(names, q), RS.resolve_indexed(*JB.name_index(spark, folder), q)):
        assert sorted((r.query_id, r["rank"], r.key, r.match) for r in out.collect()) == want


def test_stored_index_is_read_in_the_wanted_buckets_only(spark):
    folder = tempfile.mkdtemp(prefix="names-")
    JB.write_name_index(lookup(spark), folder)
    out = RS.resolve_indexed(*JB.name_index(spark, folder), spark.createDataFrame([(1, "anaheim")], "query_id long, query_text string"))
    assert [r.key for r in out.collect()] == ["06059"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    kept = re.search(r"PartitionFilters: \[([^\]]*bucket[^\]]*)\]", plan)
    assert kept and re.search(r"bucket#\d+ (=|IN)", kept.group(1))


def test_empty_lookup_and_empty_queries(spark):
    q = spark.createDataFrame([(1, "ana")], "query_id long, query_text string")
    assert RS.resolve_names(lookup(spark).limit(0), q).count() == 0
    assert RS.resolve_names(lookup(spark), q.limit(0)).count() == 0
