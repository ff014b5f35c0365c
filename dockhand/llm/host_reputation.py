"""URL filter: explicit rules, then empirical-Bayes host reputation.

Every URL is cut into host and path.  The longest rule that fits decides; for
the rest, the reputation of the host does:

* A labelled page is an outcome of its host (good or bad).  Outcomes are
  counted per host, then per registered domain (one label more than the suffix)
  and per suffix (the longest of ``SUFFIXES`` that the host ends with, else its last label).
* Each level's rate has a beta prior whose mean is its parent's posterior mean
  and whose weight is estimated from the data by the moments of the
  beta-binomial distribution of that level's counts about their parents.  A host with
  few labels thus takes after its domain, one with many stands for itself.
* A host is blocked when the upper posterior bound of its good rate, mean + ``Z``
  standard deviations, is below ``BLOCK_SHARE`` of the good rate of the whole corpus; otherwise
  it is allowed.  The bound follows the corpus: where one page in ten is good, so is the yardstick.

The label of a page is the ``quality`` of the labelled row with the page's id.
Counts are partial aggregates; only one row of sums per level (its prior
weight) reaches the driver.  All of it is DataFrame functions.

A null URL, or one without ``://``, has an empty host and path; all such pages share the
empty host's reputation.  A page id with several label rows counts its lowest;
null ids and labels other than 0 and 1 teach nothing.  Without any label, all unruled pages are
allowed.  Repeated pages are judged (and counted) once per row.  Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockhand.llm.common import settle

#: verdict, host, path: fits the host and its subdomains where the path starts so
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
# Public suffixes of two labels, below which domains are registered.
SUFFIXES = ("ac.jp", "ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.hk", "com.mx",
            "com.pl", "com.sg", "com.tr", "com.tw", "com.ua", "gov.au", "gov.uk", "ne.jp", "net.au", "net.uk", "or.jp", "org.au", "org.uk")
BLOCK_SHARE = 0.9
Z = 1.645
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_host_path(pages: DataFrame) -> DataFrame:
    """``host`` and ``path`` columns from ``url``."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substring(F.col("url"), at + 3, F.length("url"))).otherwise(F.lit(""))
    return (pages.withColumn("host", F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER))
            .withColumn("path", F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)))


def longest_rule(rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits ``host`` and
    ``path``, or null: one expression, for lists of up to a few hundred rules."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        best = F.when(fits, F.struct(F.lit(host + path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


def _weight(level: DataFrame) -> float:
    """Prior weight (a + b of the beta) of a level's counts (good, n) about
    their prior means (mean): from the within-group correlation rho, by moments."""
    row = level.where("n > 0").agg(
        F.sum(F.pow(F.col("good") / F.col("n") - F.col("mean"), F.lit(2)) * F.col("n") / (F.col("mean") * (1 - F.col("mean")))).alias("spread"),
        F.count(F.lit(1)).alias("groups"), F.sum(F.col("n") - 1).alias("free")).first()
    if not row["groups"] or not row["free"]:
        return 1.0
    rho = min(0.5, max(1e-4, (row["spread"] - row["groups"]) / row["free"]))
    return 1.0 / rho - 1.0


def suffix_of(host: str, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """The longest listed suffix of a host, else its last label."""
    out = F.substring_index(host, ".", -1)
    for labels in sorted({s.count(".") + 1 for s in suffixes}):
        tail = F.substring_index(host, ".", -labels)
        out = F.when(tail.isin([s for s in suffixes if s.count(".") + 1 == labels]), tail).otherwise(out)
    return out


def domain_of(host: str, suffix: str) -> Column:
    """The suffix and one label more; a host that is a suffix is its own domain."""
    return F.call_function("substring_index", F.col(host), F.lit("."), -(F.size(F.split(suffix, r"\.")) + 1))


def host_reputation(outcomes: DataFrame, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """(host, good, n, rate, upper, corpus_rate) from (host, good, n) counts, one row per host."""
    hosts = settle(outcomes.withColumn("suffix", suffix_of("host", suffixes)).withColumn("domain", domain_of("host", "suffix")))
    domains = settle(hosts.groupBy("domain", "suffix").agg(F.sum("good").alias("good"), F.sum("n").alias("n")))
    suffixes = settle(domains.groupBy("suffix").agg(F.sum("good").alias("good"), F.sum("n").alias("n")))
    good, n = suffixes.agg(F.sum("good"), F.sum("n")).first()
    root = ((good or 0) + 1.0) / ((n or 0) + 2.0)

    suffixes = suffixes.withColumn("mean", F.lit(root))
    domains = domains.join(_posterior(suffixes).select("suffix", F.col("rate").alias("mean")), "suffix")
    hosts = hosts.join(_posterior(domains).select("domain", F.col("rate").alias("mean")), "domain")
    return _posterior(hosts).select("host", "good", "n", "rate", "upper", F.lit(root).alias("corpus_rate"))


def _posterior(level: DataFrame) -> DataFrame:
    level = settle(level)
    weight = _weight(level)
    total = F.col("n") + F.lit(weight)
    rate = (F.col("good") + F.lit(weight) * F.col("mean")) / total
    return (level.withColumn("rate", rate)
            .withColumn("upper", F.col("rate") + Z * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (total + 1))))


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]] = RULES, block_share: float = BLOCK_SHARE,
          suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per row of ``pages``."""
    cut = settle(with_host_path(pages.select("page_id", "url")).select("page_id", "host", "path"))
    known = (labels.where(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").alias("page_id")).agg(F.min("quality").alias("good")))
    outcomes = (cut.join(known, "page_id", "left").groupBy("host")
                .agg(F.coalesce(F.sum("good"), F.lit(0)).cast("long").alias("good"), F.count("good").alias("n")))
    bad = settle(host_reputation(outcomes, suffixes).where(F.col("upper") < block_share * F.col("corpus_rate")).select("host", F.lit("block").alias("method")))
    ruled = cut.join(bad, "host", "left").withColumn("best", longest_rule(rules))
    return ruled.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                        F.coalesce("best.verdict", "method", F.lit("allow")).alias("verdict"))
