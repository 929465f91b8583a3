"""URL filter: fixed rules, else the host's reputation by empirical Bayes.

A page's outcome is the label of the document whose number ends its path: bad
if labelled low quality. Outcomes are counted for each host. A host's rate of
bad pages is shrunk towards its registered domain's, that towards its suffix's,
and that towards the rate of all pages, each by a beta-binomial prior:
rate = (bad + M * parent's rate) / (n + M). The strength M = 1/rho - 1 of each
level comes from the spread of the children's rates (method of moments, rho
within [RHO_LOW, RHO_HIGH]). A host's posterior is the beta distribution with
bad + M * p and good + M * (1 - p); its pages are blocked if the lower bound
mean - Z * sd is over MOST_BAD, so a host is blocked on evidence, never for
want of it.

Edge cases: null urls and urls without :// have empty host and path and are
allowed, as are hosts without outcomes. Labels with a null quality or id don't
count; of several labels of a document the lowest quality counts. Repeated rows
are pages of their own. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelscope.llm.store import released, stored

# The rules (host, path, verdict) of the filter.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Suffixes of more than one label under which names are registered.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in", "co.nz")
MOST_BAD = 0.5
Z = 1.645
RHO_LOW, RHO_HIGH = 0.001, 0.5


def host_of(url: Column) -> Column:
    raw = F.coalesce(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*LONG_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    return F.when(F.substring_index(host, ".", -2).isin(*LONG_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def rule_columns(host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    rule = verdict = F.lit(None).cast("string")
    for name, start, says in sorted(RULES, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule, verdict = F.when(fits, F.lit(name + start)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def reputations(hosts: DataFrame) -> DataFrame:
    """host, rate, bound (lower posterior bound of the bad rate) from outcomes `hosts` (host, n, bad)."""
    hosts = hosts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = suffixes.agg(F.sum("n"), F.sum("bad")).first()
    if not total[0]:
        return hosts.select("host", F.lit(0.0).alias("rate"), F.lit(0.0).alias("bound"))

    def shrunk(children: DataFrame) -> DataFrame:
        """Rate of each child, given `parent` (its parent's rate)."""
        p = F.col("parent")
        fair = children.where((p > 0) & (p < 1))
        off = F.col("n") * (F.col("bad") / F.col("n") - p) * (F.col("bad") / F.col("n") - p) / (p * (1 - p))
        spread, free = fair.agg(F.sum(off - 1), F.sum(F.col("n") - 1)).first()
        rho = min(max((spread or 0.0) / free if free else RHO_LOW, RHO_LOW), RHO_HIGH)
        m = F.lit(round(1 / rho - 1, 6))
        return children.withColumn("m", m).withColumn("rate", (F.col("bad") + m * p) / (F.col("n") + m))

    suffixes = shrunk(suffixes.withColumn("parent", F.lit(total[1] / total[0])))
    domains = shrunk(domains.join(suffixes.select("suffix", F.col("rate").alias("parent")), "suffix"))
    hosts = shrunk(hosts.join(domains.select("domain", "suffix", F.col("rate").alias("parent")), ["domain", "suffix"]))
    spread = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + F.col("m") + 1))
    return hosts.select("host", "rate", (F.col("rate") - Z * spread).alias("bound"))


def judged(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, bad_rate and bad_bound (null without outcomes) of each row of `pages` (page_id, url); `labels` has doc_id, quality."""
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    number = F.expr("try_cast(nullif(regexp_extract(path, '([0-9]{1,18})[^0-9]*$', 1), '') AS bigint)")
    outcome = labels.where("doc_id is not null and quality in (0, 1)").groupBy(F.col("doc_id").cast("long").alias("number")).agg((1 - F.min("quality")).alias("bad"))
    hosts = (
        parts.where("host <> ''").select("host", number.alias("number")).groupBy("host", "number").agg(F.count("*").alias("pages"))
        .join(outcome, "number").groupBy("host").agg(F.sum("pages").alias("n"), F.sum(F.col("pages") * F.col("bad")).alias("bad"))
    )
    hosts = stored(hosts, "host-outcomes")  # read by each level's sums and by the result
    bounds = stored(reputations(hosts), "host-bounds")
    released(hosts)
    rule, verdict = rule_columns(F.col("host"), F.col("path"))
    by_method = F.when(F.col("bound") > MOST_BAD, "block").otherwise("allow")
    return parts.join(bounds, "host", "left").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_method).alias("verdict"), F.round("rate", 6).alias("bad_rate"), F.round("bound", 6).alias("bad_bound"))


def _level(name: str, source: str, parent: str) -> str:
    """CTEs that shrink the rates of `source` (n, bad, parent: its parent's rate)."""
    return f"""
{name}_in AS ({parent}),
{name}_m AS (
  SELECT round(1 / greatest(least(coalesce(
      sum(n * (bad / n - parent) * (bad / n - parent) / (parent * (1 - parent)) - 1) / nullif(sum(n - 1), 0),
      {RHO_LOW}::DOUBLE), {RHO_HIGH}::DOUBLE), {RHO_LOW}::DOUBLE) - 1, 6) AS m
  FROM {name}_in WHERE parent > 0 AND parent < 1),
{name} AS (
  SELECT i.*, m, (bad + m * parent) / (n + m) AS rate FROM {source} i, {name}_m)"""


_NAMES = ", ".join(f"'{s}'" for s in LONG_SUFFIXES)
_CASES = [
    (f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{start}')", name + start, says)
    for name, start, says in sorted(RULES, key=lambda r: -len(r[0] + r[1]))
]
ORACLE = rf"""
WITH u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^(?s).*?://([^/?#]*)', 1), ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?s).*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
o AS (
  SELECT doc_id::BIGINT AS number, 1 - min(quality) AS bad FROM labels
  WHERE doc_id IS NOT NULL AND quality IN (0, 1) GROUP BY 1),
h AS (
  SELECT host, count(*)::DOUBLE AS n, sum(o.bad)::DOUBLE AS bad FROM u
  JOIN o ON o.number = try_cast(nullif(regexp_extract(path, '([0-9]{{1,18}})[^0-9]*$', 1), '') AS BIGINT)
  WHERE host <> '' GROUP BY 1),
hosts AS (
  SELECT *, CASE WHEN array_to_string(string_split(host, '.')[-2:], '.') IN ({_NAMES})
           THEN array_to_string(string_split(host, '.')[-3:], '.') ELSE array_to_string(string_split(host, '.')[-2:], '.') END AS domain,
         CASE WHEN array_to_string(string_split(host, '.')[-2:], '.') IN ({_NAMES})
           THEN array_to_string(string_split(host, '.')[-2:], '.') ELSE string_split(host, '.')[-1] END AS suffix FROM h),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY 1, 2),
suffixes AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT sum(bad) / sum(n) FROM hosts) AS parent FROM hosts GROUP BY 1),{
    _level("s", "s_in", "SELECT * FROM suffixes")},{
    _level("d", "d_in", "SELECT domains.*, s.rate AS parent FROM domains JOIN s USING (suffix)")},{
    _level("r", "r_in", "SELECT hosts.*, d.rate AS parent FROM hosts JOIN d USING (domain, suffix)")}
SELECT page_id, u.host, path,
  CASE {" ".join(f"WHEN {fits} THEN '{rule}'" for fits, rule, _ in [(c.replace("host", "u.host"), n, v) for c, n, v in _CASES])} END AS rule,
  CASE {" ".join(f"WHEN {fits} THEN '{says}'" for fits, _, says in [(c.replace("host", "u.host"), n, v) for c, n, v in _CASES])}
    WHEN rate - {Z}::DOUBLE * sqrt(rate * (1 - rate) / (r.n + m + 1)) > {MOST_BAD}::DOUBLE THEN 'block' ELSE 'allow' END AS verdict,
  round(rate, 6) AS bad_rate, round(rate - {Z}::DOUBLE * sqrt(rate * (1 - rate) / (r.n + m + 1)), 6) AS bad_bound
FROM u LEFT JOIN r ON r.host = u.host
"""
