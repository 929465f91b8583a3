"""Name lookup: text normalisation, display names and batch name resolution.

The lookup side is an index of postings: each normalised name under its trigrams, one row
for each position, with the gram's bucket, the name and its record (a covering index, so a
match is verified where it lies). A query text looks up one gram only, the one with the fewest
postings of all its grams; the others are implied by comparing the name with the text. A text
of two characters looks up the grams that begin with it. So the cost follows the postings of the
rarest grams, not the lengths of the queries, and a stored index (`plans/jobs.write_name_index`:
folders by bucket, files sorted by gram) is read only in the buckets asked for.

Position 0 is a prefix match (tier 0), any other position a contained match (tier 1). The first
`max_results` of a text by (tier, file order) come from a `row_number() <= k` filter, which Spark
turns into a per-task partial top-k before the shuffle, so a text matching a third of all names
still ships only k rows per task. Equal texts of several queries are looked up once.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .util import broadcast_if_small, materialize

# Minimum query length, result count and the suffix words that
# already make a display name complete.
MIN_QUERY_LENGTH = 2
MAX_RESULTS = 12
GRAM = 3
BUCKETS = 64  # folders of a stored index
SUFFIX_PATTERN = r"(?i)(county|parish|borough|census area|municipality|city and borough|city|municipio)\b"
DEFAULT_SUFFIX = " County"
# Code points of the JavaScript `\s` class beyond ASCII white space.
_EXTRA_WS_CODEPOINTS = [0x00A0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]
_EXTRA_WS = "".join(chr(c) for c in _EXTRA_WS_CODEPOINTS)


def _folds() -> tuple[str, str, dict[str, str]]:
    """Characters whose NFKD, without marks, has small letters or digits of ASCII, by rule:
    those that give one character (for translate), and those that give several."""
    src, dst, longer = [], [], {}
    for cp in range(0x00A0, 0x20000):  # no character beyond has such a form
        ch = chr(cp)
        if not unicodedata.decomposition(ch):
            continue
        folded = re.sub(_MARKS, "", unicodedata.normalize("NFKD", ch))
        if not re.search("[a-z0-9]", folded):
            continue
        if len(folded) == 1:
            src.append(ch)
            dst.append(folded)
        else:
            longer[ch] = folded
    return "".join(src), "".join(dst), longer


# Fixed value: the combining marks that folding removes.
_MARKS = "[\u0300-\u036f]"
ACCENTS_FROM, ACCENTS_TO, LONGER_FOLDS = _folds()


def _ranges(chars: Iterable[str]) -> str:
    """Body of a character class, neighbours joined to ranges."""
    points = sorted(map(ord, chars))
    firsts = [p for p in points if p - 1 not in points]
    lasts = [p for p in points if p + 1 not in points]
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(firsts, lasts, strict=True))


def _spelled(t: F.Column) -> F.Column:
    """Characters that stand for several, replaced; only texts that have one are taken apart."""
    table = F.str_to_map(F.lit("\n".join(f"{ch}\t{folded}" for ch, folded in LONGER_FOLDS.items())), F.lit("\n"), F.lit("\t"))
    spread = F.array_join(F.transform(F.split(t, ""), lambda ch: F.coalesce(F.try_element_at(table, ch), ch)), "")
    return F.when(t.rlike(f"[{_ranges(LONGER_FOLDS)}]"), spread).otherwise(t)


def normalize_text(c) -> F.Column:
    """Lower case, fold to base letters (NFKD without marks), non-alphanumerics to blanks, collapse blanks, trim."""
    c = F.lower(F.col(c) if isinstance(c, str) else c)
    folded = _spelled(F.translate(F.regexp_replace(c, _MARKS, ""), ACCENTS_FROM, ACCENTS_TO))
    t = F.when(c.rlike(r"[^\x00-\x7F]"), folded).otherwise(c)
    t = F.regexp_replace(t, f"[^a-z0-9\\s{_EXTRA_WS}]", " ")
    t = F.regexp_replace(t, f"[\\s{_EXTRA_WS}]+", " ")
    return F.regexp_replace(t, "^ | $", "")


def display_name(c) -> F.Column:
    """The trimmed name, with ' County' appended unless it has a suffix word."""
    c = F.col(c) if isinstance(c, str) else c
    t = F.trim(c)
    return F.when(t.rlike(SUFFIX_PATTERN), t).otherwise(F.concat(t, F.lit(DEFAULT_SUFFIX)))


def clean_lookup(lookup: DataFrame) -> DataFrame:
    """Keep records whose three text fields are present; trim them; add the match key."""
    kept = lookup.where(F.col("name").isNotNull() & F.col("group_code").isNotNull() & F.col("key").isNotNull())
    return kept.select(
        F.trim("name").alias("name"), F.trim("group_code").alias("group_code"), F.trim("key").alias("key"), "ord",
        normalize_text("name").alias("norm_name"),
    )


def _bucket(gram: str) -> F.Column:
    return F.pmod(F.xxhash64(gram), F.lit(BUCKETS)).cast("int").alias("bucket")


def name_postings(lookup: DataFrame) -> DataFrame:
    """Postings of the lookup's names: bucket, gram, pos (from 0), norm_name and the record."""
    names = clean_lookup(lookup).where(F.length("norm_name") >= MIN_QUERY_LENGTH)
    at = F.transform(
        F.sequence(F.lit(1), F.length("norm_name") - 1),
        lambda i: F.struct(F.substring("norm_name", i, F.lit(GRAM)).alias("gram"), (i - 1).alias("pos")),
    )
    each = names.select(F.inline(at), "norm_name", "key", "name", "group_code", "ord")
    return each.select(_bucket("gram"), "*")


def gram_counts(postings: DataFrame) -> DataFrame:
    """Postings of each gram. Names have 37 characters after folding, so there are at most 37^3 + 37^2 grams."""
    return postings.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


def _wanted(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """(q_norm, gram, offset, bucket): where each text is looked up."""
    counts = F.broadcast(counts)  # bounded by the alphabet, see gram_counts
    size = F.length("q_norm")
    grams = F.transform(F.sequence(F.lit(1), size - (GRAM - 1)), lambda i: F.substring("q_norm", i, F.lit(GRAM)))
    every = texts.where(size >= GRAM).select("q_norm", F.posexplode(grams).alias("offset", "gram")).join(counts, "gram")
    rarest = (
        every.groupBy("q_norm").agg(F.count(F.lit(1)).alias("found"), F.min(F.struct("n", "offset", "gram")).alias("best"))
        .where(F.col("found") == size - (GRAM - 1))  # a gram without postings: no name has the text
        .select("q_norm", "best.gram", "best.offset")
    )
    short = texts.where(size < GRAM).join(counts.withColumn("q_norm", F.substring("gram", 1, MIN_QUERY_LENGTH)), "q_norm")
    return rarest.unionByName(short.select("q_norm", "gram", F.lit(0).alias("offset"))).select("*", _bucket("gram"))


def resolve_indexed(postings: DataFrame, counts: DataFrame, queries: DataFrame, max_results: int = MAX_RESULTS) -> DataFrame:
    """R2: for each query (`query_id`, `query_text`), the first matches: prefix matches
    first, then contained matches, each in file order (`ord`). `counts` are the postings' gram_counts().

    Texts that are null, shorter than two characters or without letters and digits give nothing."""
    q = queries.select("query_id", "query_text", normalize_text("query_text").alias("q_norm")).where(
        (F.length(F.trim("query_text")) >= MIN_QUERY_LENGTH) & (F.length("q_norm") >= MIN_QUERY_LENGTH)
    )
    wanted = materialize(_wanted(q.select("q_norm").distinct(), counts))
    many, buckets = wanted.agg(F.count(F.lit(1)), F.collect_set("bucket")).first()  # at most BUCKETS numbers
    found = postings.where(F.col("bucket").isin(buckets)).join(broadcast_if_small(wanted, many), ["bucket", "gram"])
    # of a name that has the text more than once, the posting of its first place counts
    found = found.where((F.col("pos") >= F.col("offset")) & (F.instr("norm_name", F.col("q_norm")) - 1 == F.col("pos") - F.col("offset")))
    best = found.withColumn("tier", F.when(F.col("pos") == F.col("offset"), 0).otherwise(1))
    w = Window.partitionBy("q_norm").orderBy("tier", "ord", "key", "name", "group_code")
    top = best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= max_results)
    return top.join(broadcast_if_small(q), "q_norm").select(
        "query_id", "query_text", "rank", "key", "name", "group_code",
        F.when(F.col("tier") == 0, F.lit("prefix")).otherwise(F.lit("contains")).alias("match"),
        display_name("name").alias("display_name"),
    )


def resolve_names(lookup: DataFrame, queries: DataFrame, max_results: int = MAX_RESULTS) -> DataFrame:
    """resolve_indexed() over postings made for this one batch of queries."""
    postings = name_postings(lookup)
    return resolve_indexed(postings, gram_counts(postings), queries, max_results)
