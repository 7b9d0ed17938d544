"""URL filter: explicit rules, else the host's reputation by empirical Bayes.

A page's outcome is bad if its label says low quality or toxic. The rate of bad
outcomes of a host shrinks towards that of its registered domain, the domain's
towards its suffix's, the suffix's towards that of all pages. At each level the
strength of the beta prior comes from the spread of the rates below it
(method of moments of the beta-binomial). A host is blocked when even the lower
posterior bound of its bad rate exceeds ``max_bad``. Built-in functions only;
counts are aggregated before the shuffle, so a hot host is one row of each task.

Null url, or none with ``://``: empty host and path, judged by the method as one
host without a name. A page without a label counts for no rate and is still
judged. Repeated pages repeat in the result. No labels: everything that no
rule names is allowed. An empty table gives no row. A very long url is handled whole.
Ties: of rules as long the first counts. Only the columns named are read, so no other
name can clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossarion.llm._shared import Workspace

#: Contract of the registered query: (verdict, host, path).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Suffixes of two labels below which names are registered.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br")


@dataclass(frozen=True)
class Bound:
    """Posterior bound: ``z`` standard deviations below the mean must exceed ``max_bad``."""

    max_bad: float = 0.4
    z: float = 1.645
    least_strength: float = 1.0
    most_strength: float = 1000.0


def split_url(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls if none does."""
    name = said = None
    for verdict, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        test = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(test, h + p) if name is None else name.when(test, h + p)
        said = F.when(test, verdict) if said is None else said.when(test, verdict)
    return (F.lit(None).cast("string"),) * 2 if name is None else (name, said)


def registered(host: Column, long_suffixes=LONG_SUFFIXES) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host. ``long_suffixes``: the suffixes of two labels, such as a public list has."""
    two = F.substring_index(host, ".", -2)
    long = two.isin(*long_suffixes)
    return F.when(long, F.substring_index(host, ".", -3)).otherwise(two), F.when(long, two).otherwise(F.substring_index(host, ".", -1))


def _strength(groups: DataFrame, bound: Bound) -> float:
    """Prior strength from groups with n, bad and the prior mean, at most the number of labels: one row to the driver."""
    got = groups.where("n > 0").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.count("*").alias("g"),
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("prior"), 2)).alias("s"), F.sum(F.col("n") * F.col("prior") * (1 - F.col("prior"))).alias("v"),
    ).first()
    most = max(bound.least_strength, min(bound.most_strength, got.n or 0))
    if not got.n or got.v <= 0:
        return most
    v = got.v / got.n
    spread = (got.s - (got.g - 1) * v) / max(got.n - got.nn / got.n, 1e-9)
    return min(most, max(bound.least_strength, v / spread - 1)) if spread > 0 else most


def reputations(outcomes: DataFrame, bound: Bound = Bound(), long_suffixes=LONG_SUFFIXES) -> DataFrame:
    """``outcomes``: host, n (labelled pages), bad. Returns host, n, bad, mean, low, verdict."""
    domain, suffix = registered(F.col("host"), long_suffixes)
    hosts = outcomes.withColumn("domain", domain).withColumn("suffix", suffix)
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = (total.bad + 0.5) / (total.n + 1) if total.n else 0.5
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn("prior", F.lit(overall))

    def shrunk(groups: DataFrame) -> tuple[DataFrame, float]:
        k = _strength(groups, bound)
        return groups.withColumn("mean", (F.col("bad") + k * F.col("prior")) / (F.col("n") + k)), k

    suffixes, _ = shrunk(suffixes)
    domains, _ = shrunk(domains.join(suffixes.select("suffix", F.col("mean").alias("prior")), "suffix"))
    hosts, k = shrunk(hosts.join(domains.select("domain", F.col("mean").alias("prior")), "domain"))
    mean = F.col("mean")
    hosts = hosts.withColumn("low", mean - bound.z * F.sqrt(mean * (1 - mean) / (F.col("n") + k + 1)))
    return hosts.select("host", "n", "bad", "mean", "low", F.when(F.col("low") > bound.max_bad, "block").otherwise("allow").alias("verdict"))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, bound: Bound = Bound(), long_suffixes=LONG_SUFFIXES) -> DataFrame:
    """page_id, host, path, rule, verdict and the host's mean and lower bound, for every page."""
    host, path = split_url(F.col("url"))
    at = pages.select("page_id", host.alias("host"), path.alias("path"))
    seen = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max(((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).cast("long")).alias("bad"))
    known = at.select("page_id", "host").join(seen, F.col("page_id") == F.col("doc_id"), "left")
    outcomes = known.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    # one row a host, written once: the four levels read it, not pages and labels
    outcomes = Workspace(pages.sparkSession, "hosts").write(outcomes, "outcomes")
    name, said = fitting_rule(F.col("host"), F.col("path"), rules)
    rated = reputations(outcomes, bound, long_suffixes).select("host", "mean", "low", F.col("verdict").alias("own"))
    return at.join(rated, "host", "left").select("page_id", "host", "path", name.alias("rule"), F.coalesce(said, "own").alias("verdict"), "mean", "low")
