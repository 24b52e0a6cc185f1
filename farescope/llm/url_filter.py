"""URL verdicts from a rule list and from host reputations shrunk by empirical Bayes.

Labelled page outcomes (good or bad) are counted for each host. A host's rate is shrunk towards
that of its registered domain, which is shrunk towards that of its suffix, which starts from a
uniform prior: at each level a beta-binomial posterior, whose mean is the prior mean of the level
below. How strongly a level shrinks is estimated from how much the rates of its members differ.
A host is blocked when a lower posterior bound of its rate of bad pages passes a threshold.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.5
DEVIATIONS = 1.64
# Bounds of the weight, in pages, that a level's prior has.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 200.0

# Public suffixes of two labels that registries sell names under. Others are the last label.
SUFFIXES = tuple(
    "ac.jp ac.uk co.id co.il co.in co.jp co.kr co.nz co.uk co.za com.ar com.au com.br com.cn com.hk com.mx com.my com.pl com.sg "
    "com.tr com.tw com.ua edu.au gov.au gov.uk me.uk ne.jp net.au net.cn net.uk or.jp or.kr org.au org.br org.cn org.il org.in "
    "org.nz org.uk".split()
)


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return _lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def registered_domain(host: Column, suffixes: tuple[str, ...] = ()) -> Column:
    """The last label before the public suffix, and the suffix; a suffix itself stays as it is.

    A suffix is one of ``suffixes`` (such as ``co.uk``), longest first, or else the last label.
    """
    found = F.regexp_extract(host, r"([^.]*\.)?[^.]*$", 0)
    for s in sorted(suffixes, key=len):
        fits = (host == s) | host.endswith("." + s)
        found = F.when(fits, F.regexp_extract(host, r"([^.]+\.)?" + s.replace(".", r"\.") + "$", 0)).otherwise(found)
    return found


def suffix_of(host: Column, suffixes: tuple[str, ...] = ()) -> Column:
    found = F.regexp_extract(host, r"[^.]*$", 0)
    for s in sorted(suffixes, key=len):
        found = F.when((host == s) | host.endswith("." + s), F.lit(s)).otherwise(found)
    return found


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest of the (verdict, host, path) rules that fits, or nulls.

    Of rules with equal length, block comes first, then the order of their texts.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1] + r[2]))
    for word, rule_host, rule_path in reversed(ranked):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(word)).otherwise(verdict)
    return rule, verdict


def _weight(counts: DataFrame, parent: str) -> DataFrame:
    """(parent, weight): pages that the prior of a parent's members is worth.

    Moment estimate of the beta-binomial: the more the rates of the members differ beyond chance,
    the less the prior weighs. With one member, or no difference beyond chance, it weighs most.
    """
    sums = counts.groupBy(parent).agg(
        F.count(F.lit(1)).alias("m"),
        F.sum("n").alias("pages"),
        F.sum("bad").alias("bads"),
        F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("squares"),
        F.sum(F.col("n") * F.col("n")).alias("n_squares"),
    )
    p = F.col("bads") / F.col("pages")
    spread = F.col("squares") - F.col("pages") * p * p
    noise = p * (1 - p)
    inner = spread - noise * (F.col("m") - 1)
    outer = noise * (F.col("pages") - F.col("n_squares") / F.col("pages") - (F.col("m") - 1))
    rho = F.when((outer > 0) & (inner > 0), inner / outer)
    weight = F.least(F.greatest(1 / F.round(rho, 9) - 1, F.lit(LEAST_WEIGHT)), F.lit(MOST_WEIGHT))
    return sums.select(parent, F.coalesce(weight, F.lit(MOST_WEIGHT)).alias("weight"))


def reputations(outcomes: DataFrame, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """(host, domain, suffix, n, bad, rate, bound) for every host of ``outcomes`` (host, bad).

    bad is 0 or 1 for a labelled page, or null for one without a label; such pages give a host
    its row and no weight. rate is the posterior mean of the share of bad pages, bound its lower
    bound, DEVIATIONS posterior standard deviations below.
    """
    hosts = outcomes.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum(F.col("bad").cast("bigint")), F.lit(0)).alias("bad")
    )
    hosts = hosts.withColumn("domain", registered_domain(F.col("host"), suffixes)).withColumn("suffix", suffix_of(F.col("host"), suffixes))
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    tops = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    seen = F.col("n") > 0
    tops = tops.select("suffix", ((F.col("bad") + 1) / (F.col("n") + 2)).alias("prior"))
    tops = tops.join(_weight(domains.where(seen), "suffix"), "suffix", "left").withColumn("weight", F.coalesce("weight", F.lit(MOST_WEIGHT)))
    rate = (F.col("weight") * F.col("prior") + F.col("bad")) / (F.col("weight") + F.col("n"))
    domains = domains.join(tops, "suffix").select("domain", rate.alias("prior"))
    domains = domains.join(_weight(hosts.where(seen), "domain"), "domain", "left").withColumn("weight", F.coalesce("weight", F.lit(MOST_WEIGHT)))
    total = F.col("weight") + F.col("n")
    found = hosts.join(domains, "domain").withColumn("rate", rate)
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (total + 1))
    bound = F.greatest(F.col("rate") - F.lit(DEVIATIONS) * deviation, F.lit(0.0))
    return found.select("host", "domain", "suffix", "n", "bad", "rate", bound.alias("bound"))


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: list[tuple[str, str, str]],
    suffixes: tuple[str, ...] = (),
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, bound) for every row of ``pages`` (page_id, url).

    ``outcomes`` (host, bad) are the labelled pages. A rule decides before the host's reputation
    does; a host without labelled pages has that of its domain or suffix, and where these have
    none the page is allowed. A null url, or one without ``://``, has an empty host and path, fits
    no rule and is judged like any host. Repeated rows are judged alike; other columns are
    ignored; an empty table gives no rows.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    pages = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = outcomes.select("host", F.col("bad").cast("int").alias("bad"))
    unknown = pages.select("host", F.lit(None).cast("int").alias("bad"))
    found = reputations(known.unionByName(unknown), suffixes).select("host", "bound")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") > threshold, F.lit("block")).otherwise(F.lit("allow"))
    return pages.join(found, "host").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "bound")
