"""Ranks, top-share flags and ROC AUC without gathering a group in one task.

All count per (group, score) first, so hot scores collapse to one row, and build
on `ordered_prefix_sums`: within-period percentiles (W10), top-share flags with
an exact tie rule (W8, W9), and exact ROC AUC with ties counted half (A6).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .hot_keys import split_join
from .prefix import limit_of, max_group_size, ordered_prefix_sums
from .util import materialize


def percentile_in_group(df: DataFrame, by: Sequence[str], score: str, out: str = "risk_percentile",
                        size_bound: int | None = None, direct_limit: int | None = None) -> DataFrame:
    """100 x share of the group's scores that are <= this row's score (`cume_dist`).

    A NULL group is a group. Scores that many rows share join where the rows lie."""
    counts = df.groupBy(*by, score).agg(F.count(F.lit(1)).alias("__cnt"))
    values, weights = size_bound, None
    if size_bound is None or size_bound > limit_of(direct_limit):
        counts = counts.persist()  # read by its profile and by each read of the running counts
        values, weights = _profile(counts, by)
    pre = ordered_prefix_sums(counts, by, score, ["__cnt"], direct_limit, values)
    pct = pre.select(
        *by, score, ((F.col("__cnt_before") + F.col("__cnt")) / F.col("__cnt_total") * F.lit(100.0)).alias(out), "__cnt"
    )
    return split_join(df, pct, [*by, score], "__cnt", size_bound, weights, direct_limit=direct_limit)


def _profile(counts: DataFrame, by: Sequence[str]) -> tuple[int, tuple[int, int]]:
    """Most values of a group, and sum and largest of the counts."""
    groups = counts.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum("__cnt").alias("s"), F.max("__cnt").alias("m"))
    values, total, most = groups.agg(F.max("n"), F.sum("s"), F.max("m")).first()
    return values or 0, (total or 0, most or 0)


def top_share_flags(
    df: DataFrame,
    by: Sequence[str],
    score: str,
    tiebreak: Sequence[str],
    out: str = "predicted_top_quartile",
    share: float = 0.25,
    direct_limit: int | None = None,
    size_bound: int | None = None,
) -> DataFrame:
    """Per group flag the `max(1, ceil(share * n))` highest scores; ties at the
    cut are resolved by `tiebreak` ascending (NULLs first). Only rows tied at the cut
    score are ranked; all others are decided by running counts. Rows with a NULL score
    are not ranked and get a NULL flag; a NULL group is a group of its own."""
    by = list(by)
    neg = "__neg_score"
    unranked = df.where(F.col(score).isNull()).withColumn(out, F.lit(None).cast("int"))
    df = df.where(F.col(score).isNotNull())
    counts = df.groupBy(*by, score).agg(F.count(F.lit(1)).alias("__cnt")).withColumn(neg, -F.col(score))
    pre = ordered_prefix_sums(counts, by, neg, ["__cnt"], direct_limit, size_bound).select(
        *by, score, "__cnt", F.col("__cnt_before").alias("__above"),
        F.greatest(F.lit(1), F.ceil(F.col("__cnt_total") * F.lit(share))).cast("long").alias("__k"),
    )
    same = F.col(f"l.{score}") == F.col(f"r.{score}")
    for b in by:
        same = same & F.col(f"l.{b}").eqNullSafe(F.col(f"r.{b}"))
    rows = df.alias("l").join(pre.alias("r"), same).select("l.*", "r.__cnt", "r.__above", "r.__k")
    decided = F.when(F.col("__above") + F.col("__cnt") <= F.col("__k"), F.lit(1)).when(
        F.col("__above") >= F.col("__k"), F.lit(0)
    )
    clear = rows.where(decided.isNotNull()).withColumn(out, decided)
    cut = rows.where(decided.isNull()).withColumn("__need", F.col("__k") - F.col("__above"))
    cols = [*df.columns, out]
    limit = limit_of(direct_limit)
    if (size_bound is not None and size_bound <= limit) or max_group_size(cut, by) <= limit:
        w = Window.partitionBy(*by, score).orderBy(*tiebreak)
        cut = cut.withColumn(out, (F.row_number().over(w) <= F.col("__need")).cast("int"))
    else:
        cut = _flag_first_by_ranges(cut, by, tiebreak, out)
    return clear.select(*cols).unionByName(cut.select(*cols)).unionByName(unranked.select(*cols))


def _flag_first_by_ranges(cut: DataFrame, by: list[str], tiebreak: Sequence[str], out: str) -> DataFrame:
    """Per group, flag the `__need` first rows by tie-break: rows are dealt to ranges of
    (group, tie-break), a running count over a group's ranges gives each range its first
    rank, and rows are ranked inside their range only."""
    dealt = cut.repartitionByRange(*by, *tiebreak).withColumn("__range", F.spark_partition_id())
    dealt = materialize(dealt)  # a range's number must not change between the two reads
    sizes = dealt.groupBy(*by, "__range").agg(F.count(F.lit(1)).alias("__rows"))
    earlier = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(*by, "__range", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__first"))
    inside = Window.partitionBy(*by, "__range").orderBy(*tiebreak)
    ranked = dealt.withColumn("__rank", F.row_number().over(inside)).alias("l")
    same = F.col("l.__range") == F.col("r.__range")
    for b in by:
        same = same & F.col(f"l.{b}").eqNullSafe(F.col(f"r.{b}"))
    ranked = ranked.join(first.alias("r"), same).select("l.*", "r.__first")
    return ranked.withColumn(out, (F.col("__first") + F.col("__rank") <= F.col("__need")).cast("int"))


def roc_auc(df: DataFrame, by: Sequence[str], label: str = "y", score: str = "risk_score",
            size_bound: int | None = None) -> DataFrame:
    """Exact ROC AUC per group, ties counted half; NULL when a group has one class.

    AUC = sum over scores of pos * (2 * negatives_below + neg) / (2 * P * N): integer
    sums and one division, so every engine gives the same double."""
    by = list(by)
    counts = df.groupBy(*by, score).agg(
        F.count_if(F.col(label) == 1).alias("__pos"), F.count_if(F.col(label) == 0).alias("__neg")
    )
    pre = ordered_prefix_sums(counts, by, score, ["__pos", "__neg"], size_bound=size_bound)
    keys = by if by else []
    # Decimals: positives times negatives pass 2**63 from a few billion rows on.
    pos, pairs = F.col("__pos").cast("decimal(18,0)"), (F.lit(2) * F.col("__neg_before") + F.col("__neg")).cast("decimal(19,0)")
    agg = pre.groupBy(*keys).agg(
        F.sum((pos * pairs).cast("decimal(38,0)")).alias("__num"),
        F.first("__pos_total").alias("__p"),
        F.first("__neg_total").alias("__n"),
    )
    auc = F.when((F.col("__p") > 0) & (F.col("__n") > 0),
                 F.col("__num").cast("double") / (F.lit(2.0) * F.col("__p") * F.col("__n")))  # doubles from here on
    return agg.select(*keys, auc.alias("auc"))


def roc_points(df: DataFrame, by: Sequence[str], label: str = "y", score: str = "risk_score",
               size_bound: int | None = None) -> DataFrame:
    """A10: (fpr, tpr) at every distinct score used as threshold (`score >= threshold`)."""
    by = list(by)
    counts = df.groupBy(*by, score).agg(
        F.count_if(F.col(label) == 1).alias("__pos"), F.count_if(F.col(label) == 0).alias("__neg")
    ).withColumn("__neg_score", -F.col(score))
    pre = ordered_prefix_sums(counts, by, "__neg_score", ["__pos", "__neg"], size_bound=size_bound)
    tp = F.col("__pos_before") + F.col("__pos")
    fp = F.col("__neg_before") + F.col("__neg")
    return pre.select(
        *by,
        F.col(score).alias("threshold"),
        tp.alias("true_positives"),
        fp.alias("false_positives"),
        F.when(F.col("__neg_total") > 0, fp / F.col("__neg_total")).alias("fpr"),
        F.when(F.col("__pos_total") > 0, tp / F.col("__pos_total")).alias("tpr"),
    )
