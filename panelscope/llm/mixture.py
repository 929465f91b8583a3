"""Mixing sources to target weights along a time-varying curriculum.

Each source has a target of words and a weight schedule over training time u in
[0, 1]: weight * (1 + slope * (2u - 1)). The schedule's integral over [0, u] is
the source's cumulative demand; its inverse turns the number of words taken so
far into a training position. A source's documents queue in the order of the
md5 of their id; the queue is read from its start, twice over if the target is
larger than the source, until the target's whole words are taken. So every
source takes exactly floor(target) words, each document at most twice its size,
and the last document of a pass may be taken in part.

Running sums over a source are made in two steps, within 4,096 hash buckets of
it and over the buckets, so that a source with a third of all rows is spread
over the tasks.

Targets: sources by name (code points, null last) weigh 5, 2, 1, repeating, and
share 150 % of all words by weight; none gets more than twice its size, and the
excess is shared by weight among the others (the water level is the largest of
the levels that fill the k smallest cap-to-weight ratios).

Edge cases: null text has size 0, takes nothing and keeps its place in the
queue. Rows with equal ids follow each other, smaller first; equal rows may
swap, which changes no column. A null source is a source of its own. Without
words all targets are 0 and positions null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelscope.llm.store import fresh, stored

SHARE = 1.5  # of all words
MOST = 2  # passes over a source
WEIGHTS = (5, 2, 1)
SLOPES = (0.5, -0.5)  # of the sources' schedules, repeating: rising, falling
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target, slope: a row for each source of `sizes` (source, size)."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int"))
    slope = F.element_at(F.array(*map(F.lit, SLOPES)), (place % len(SLOPES) + 1).cast("int"))
    per = per.select("source", "source_size", weight.alias("weight"), slope.alias("slope"))
    everything = Window.partitionBy()
    filled = Window.orderBy(F.col("source_size") * MOST / F.col("weight"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    after = filled.rowsBetween(0, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) * SHARE - F.coalesce(F.sum(F.col("source_size") * MOST).over(before), F.lit(0))) / F.sum("weight").over(after)
    level = per.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    return level.select("source", "source_size", F.least(F.col("source_size") * F.lit(float(MOST)), F.col("weight") * F.col("level")).alias("target"), "slope")


def position(first: Column, target: Column, slope: Column) -> Column:
    """Training time at which a source's demand reaches `first` words; past 1 for words that it never reaches."""
    q = first / target
    root = (F.sqrt((1 - slope) * (1 - slope) + 4 * slope * q) - (1 - slope)) / (2 * slope)
    return F.when(target > 0, F.round(F.when(q <= 1, root).otherwise(q), 9))


def mixed(docs: DataFrame, carry: list[str] = ()) -> DataFrame:
    """doc_id, size, source_size, target, taken, first_pass, second_pass (words) and position of each row of `docs`.

    `docs` has doc_id, text and source; columns in `carry` come along as fields of a struct `row`.
    """
    row = [F.struct(*[F.col(c) for c in carry]).alias("row")] if carry else []
    place = F.coalesce(F.md5(F.col("doc_id").cast("long").cast("string")), F.lit(""))
    part = F.concat(F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")), F.lit("/"), F.substring(place, 1, 3))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size_of(F.col("text")).alias("size"), place.alias("place"), part.alias("part"), *row)
    sums = stored(
        docs.select("source", part.alias("part"), size_of(F.col("text")).alias("size")).groupBy("source", "part").agg(F.sum("size").alias("size")), "bucket-sums"
    )
    until = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    known = sums.withColumn("offset", F.coalesce(F.sum("size").over(until), F.lit(0))).drop("size").alias("o")
    known = known.join(targets(sums).alias("t"), F.col("o.source").eqNullSafe(F.col("t.source"))).select("o.part", "offset", "source_size", "target", "slope")
    inside = Window.partitionBy("part").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    queue = rows.withColumn("within", F.sum("size").over(inside) - F.col("size"))
    queue = queue.join(known, "part").withColumn("first", F.col("offset") + F.col("within"))
    words = F.floor("target")
    one = F.greatest(F.lit(0), F.least("size", words - F.col("first")))
    two = F.greatest(F.lit(0), F.least("size", words - F.col("source_size") - F.col("first")))
    return queue.select(
        "doc_id", "size", "source_size", "target", (one + two).alias("taken"), one.alias("first_pass"), two.alias("second_pass"),
        position(F.col("first"), F.col("target"), F.col("slope")).alias("position"),
        position(F.col("source_size") + F.col("first"), F.col("target"), F.col("slope")).alias("second_position"), *(["row"] if carry else []),
    )


def curriculum(docs: DataFrame) -> DataFrame:
    """`docs` as training reads them: a row for each pass over a document that takes words of it, range-sorted by position.

    The text of a document taken in part is its first words, joined by one space; n_chars, if there is one, follows.
    """
    columns = docs.columns
    rows = mixed(docs, columns)
    passes = rows.select("row", "size", F.explode(F.array(F.struct(F.col("first_pass").alias("words"), "position"), F.struct(F.col("second_pass").alias("words"), F.col("second_position").alias("position")))).alias("pass"))
    words, place, size = (fresh(c, columns) for c in ("__words", "__position", "__size"))
    passes = passes.where("pass.words > 0").select("row.*", F.col("pass.words").alias(words), F.col("pass.position").alias(place), F.col("size").alias(size))
    pieces = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    partly = F.col(words) < F.col(size)
    passes = passes.withColumn("text", F.when(partly, F.array_join(F.slice(pieces, F.lit(1), F.col(words).cast("int")), " ")).otherwise(F.col("text")))
    if "n_chars" in columns:
        passes = passes.withColumn("n_chars", F.when(partly, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return passes.orderBy(place, "doc_id").select(*columns)


def report(docs: DataFrame) -> DataFrame:
    """The mix, a row for each document, in the order of training positions."""
    return mixed(docs).select("doc_id", "size", "source_size", "target", "taken", "position").orderBy("position", "doc_id")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(doc_id::VARCHAR) AS place FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source),
w AS (
  SELECT source, source_size, CASE i % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
         CASE i % 2 WHEN 0 THEN 0.5::DOUBLE ELSE -0.5::DOUBLE END AS slope FROM s),
l AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE
      - coalesce(sum(2 * source_size) OVER (ORDER BY source_size * 2 / weight::DOUBLE, source NULLS LAST
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
      / (sum(weight) OVER (ORDER BY source_size * 2 / weight::DOUBLE, source NULLS LAST
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM w),
t AS (
  SELECT source, source_size, slope, least(source_size * 2.0::DOUBLE, weight * max(level) OVER ()) AS target FROM l),
q AS (
  SELECT d.*, t.source_size, t.slope, t.target,
         (sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS first
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, floor(target)::BIGINT - first))
        + greatest(0, least(size, floor(target)::BIGINT - source_size - first)))::BIGINT AS taken,
       CASE WHEN target > 0 THEN round(CASE WHEN first / target <= 1
         THEN (sqrt((1 - slope) * (1 - slope) + 4 * slope * (first / target)) - (1 - slope)) / (2 * slope)
         ELSE first / target END, 9) END AS position
FROM q
"""
