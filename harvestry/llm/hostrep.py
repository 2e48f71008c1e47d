"""URL filter: empirical-Bayes reputation of hosts, with rules that overrule it. DataFrame functions only.

A labelled page has an outcome: bad if its document (the number that ends its path is the document's id) is toxic or of low quality. The share of
bad outcomes is shrunk by beta-binomial priors from the top down: all pages, suffix, registered domain, host. Each level's prior strength comes from
the spread among its members (method of moments), and a member's own outcomes are taken out of the parent that it is shrunk to. A host is blocked if
the lower posterior bound of its bad share exceeds ``most_bad``. A rule that fits the url decides instead; the longest one wins.

Hosts are aggregated map-side; the host table is written before it is joined, so that a host with a third of all pages can be split.

Defined results: a null url, or one without ``://``, has empty host and path, and forms a host of its own. Hosts without outcomes get their domain's
posterior, and so on up; with no outcomes at all the share is 0.5 and nothing is blocked. Repeated pages count as often as they occur, and repeated
labels of a document count once, as bad if any is. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules as (verdict, host, beginning of the path).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Suffixes of two labels under which domains are registered. Fixed values.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp", "com.br", "com.cn", "com.tr", "com.mx", "co.in", "co.nz", "co.za", "co.kr")
#: One-sided 95 % of a normal distribution; prior strengths stay between these.
Z, WEAKEST, STRONGEST = 1.6449, 2.0, 1000.0


def url_parts(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict."""
    text = verdict = F.lit(None).cast("string")
    for action, own, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        text, verdict = F.when(fits, own + start).otherwise(text), F.when(fits, action).otherwise(verdict)
    return text, verdict


def domain_of(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host without its port; an address is its own domain."""
    bare = F.regexp_replace(F.regexp_replace(host, r":[0-9]*$", ""), r"\.$", "")
    two = F.substring_index(bare, ".", -2)
    labels = F.when(two.isin(*TWO_LABEL_SUFFIXES), 2).otherwise(1)
    address = bare.rlike(r"^[0-9.]+$|^\[")
    domain = F.when(address, bare).when(labels == 2, F.substring_index(bare, ".", -3)).otherwise(two)
    return domain, F.when(address, F.lit("")).when(labels == 2, two).otherwise(F.substring_index(bare, ".", -1))


def outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``host, n, bad``: the labelled pages of every host, and how many of them are bad."""
    number = F.regexp_extract(F.col("path"), r"/([0-9]{1,18})(?:\.[A-Za-z]+)?/?$", 1)
    asked = pages.select("host", "path").withColumn("doc_id", F.when(number != "", number.cast("long")))
    bad = F.max(F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).when(F.col("toxic").isNotNull() | F.col("quality").isNotNull(), 0))
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(bad.alias("bad")).where(F.col("doc_id").isNotNull() & F.col("bad").isNotNull())
    return asked.join(stored(known, "outcomes"), "doc_id", "left").groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))


def _strength(groups: DataFrame, mean: float) -> float:
    """Prior strength by the method of moments from ``n`` and ``k`` of the members."""
    row = groups.where("n > 0").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("n2"), F.count("*").alias("members"), F.sum(F.col("n") * F.pow(F.col("k") / F.col("n") - mean, 2)).alias("spread")).first()
    noise = mean * (1 - mean)
    if not row["members"] or row["members"] < 2 or noise <= 0:
        return STRONGEST
    between = (row["spread"] - (row["members"] - 1) * noise) / (row["n"] - row["n2"] / row["n"])
    return min(STRONGEST, max(WEAKEST, noise / between - 1)) if between > 0 else STRONGEST


def reputation(hosts: DataFrame) -> DataFrame:
    """``host, share, low``: posterior mean of the bad share of each host, and its lower bound."""
    domain, suffix = domain_of(F.col("host"))
    hosts = stored(hosts.withColumn("domain", domain).withColumn("suffix", suffix), "hosts")
    domains = stored(hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k")), "domains")
    suffixes = stored(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")), "suffixes")
    whole = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k")).first()
    mean = whole["k"] / whole["n"] if whole["n"] else 0.5
    s0, s1, s2 = (_strength(g, mean) for g in (suffixes, domains, hosts))

    def shrunk(k: Column, n: Column, prior: Column, strength: float) -> Column:
        return (k + strength * prior) / (n + strength)

    of_suffix = suffixes.select("suffix", F.col("n").alias("ns"), F.col("k").alias("ks"))
    of_domain = domains.select("suffix", "domain", F.col("n").alias("nd"), F.col("k").alias("kd"))
    joined = hosts.join(of_domain, ["suffix", "domain"]).join(of_suffix, "suffix")
    rest = shrunk(F.col("ks") - F.col("kd"), F.col("ns") - F.col("nd"), F.lit(mean), s0)
    prior = shrunk(F.col("kd") - F.col("k"), F.col("nd") - F.col("n"), rest, s1)
    share, weight = shrunk(F.col("k"), F.col("n"), prior, s2), F.col("n") + s2
    low = share - Z * F.sqrt(share * (1 - share) / (weight + 1)) if whole["n"] else F.lit(0.0)
    return joined.select("host", share.alias("share"), low.alias("low"))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, most_bad: float = 0.4) -> DataFrame:
    """Per row: ``page_id, host, path, rule, verdict``."""
    host, path = url_parts(F.col("url").cast("string"))
    parted = pages.select(F.col("page_id").cast("long"), host.alias("host"), path.alias("path"))
    known = stored(reputation(outcomes(parted, labels)), "reputation")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("low") > most_bad, "block").otherwise("allow")
    return parted.join(known, "host").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"))
