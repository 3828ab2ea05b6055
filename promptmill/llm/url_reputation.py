"""Host reputation by empirical Bayes, and URL rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.staging import stage

#: Suffixes of several labels under which names are registered; others have one label.
LONG_SUFFIXES = ("ac.uk", "co.jp", "co.uk", "com.au", "com.br", "gov.uk", "org.uk")


@dataclass(frozen=True)
class Rule:
    """Allow or block what lies under a host (subdomains included) and a path prefix."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z in lower case; else empty."""
    rest = F.substring_index(F.substring_index(F.substring_index(_rest(url), "/", 1), "?", 1), "#", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without a host mark."""
    rest = _rest(url)
    plain = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    at = F.instr(plain, "/")
    return F.when(at > 0, plain.substr(at, F.length(plain))).otherwise("")


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def suffix_of(host: Column) -> Column:
    """The public suffix: the last label, or one of the known longer ones."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*LONG_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """The registered domain: the suffix and one label more, as far as the host has it."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*LONG_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def fitting_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as a struct ``name, verdict``; NULL if none does. Rules are a short list."""
    found = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host))):
        inside = (host == rule.host) | host.endswith("." + rule.host)
        entry = F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(inside & path.startswith(rule.path), entry).otherwise(found)
    return found


def _level(stats: DataFrame, least: float, most: float) -> DataFrame:
    """Posterior means and strengths of one level, shrunk towards the level above.

    The strength of the prior is the beta-binomial one that explains how far the
    children of all parents scatter around them (method of moments), held between
    ``least`` and ``most`` outcomes.
    """
    n, bad, mean = F.col("n"), F.col("bad"), F.col("prior")
    spread = F.sum(F.pow(bad - n * mean, 2))
    noise = F.sum(n * mean * (1 - mean))
    scale = F.sum(n * (n - 1) * mean * (1 - mean))
    moments = stats.filter("n > 0").agg((spread - noise).alias("extra"), scale.alias("scale")).first()
    rho = (moments["extra"] or 0.0) / moments["scale"] if moments["scale"] else 0.0
    strength = min(max((1 - rho) / rho if rho > 0 else most, least), most)
    alpha = F.lit(float(strength)) * mean + bad
    beta = F.lit(float(strength)) * (1 - mean) + (n - bad)
    return stats.withColumns({"alpha": alpha, "beta": beta, "posterior": alpha / (alpha + beta)})


def host_reputation(
    outcomes: DataFrame, base: float = 1.0, least: float = 2.0, most: float = 1000.0
) -> DataFrame:
    """One row per host: ``host, n, bad, posterior, lower`` from ``host, n, bad`` (summed per host).

    Outcomes are pooled per suffix, registered domain and host. The suffix is
    shrunk towards all outcomes (with ``base`` good and bad ones added), the
    domain towards its suffix, the host towards its domain. ``lower`` lies 1.645
    posterior deviations under the mean: the host is worse than that with 95 per cent.
    Without any outcome it is 0.
    """
    hosts = outcomes.select(
        "host", "n", "bad", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix")
    )
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    known_at_all = F.lit(bool(total["n"]))
    overall = ((total["bad"] or 0) + base) / ((total["n"] or 0) + 2 * base)
    counts = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    above = hosts.groupBy("suffix").agg(*counts).withColumn("prior", F.lit(overall))
    above = _level(above, least, most).select("suffix", F.col("posterior").alias("prior"))
    domains = hosts.groupBy("suffix", "domain").agg(*counts).join(above, "suffix")
    domains = _level(domains, least, most).select("domain", F.col("posterior").alias("prior"))
    known = _level(hosts.join(domains, "domain"), least, most)
    a, b = F.col("alpha"), F.col("beta")
    deviation = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    lower = F.when(known_at_all, F.greatest(a / (a + b) - 1.645 * deviation, F.lit(0.0))).otherwise(0.0)
    return known.select("host", "n", "bad", "posterior", lower.alias("lower"))


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: list[Rule],
    limit: float = 0.25,
    url: str = "url",
    page_id: str = "page_id",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, reputation``: a rule's verdict, or else the host's.

    ``outcomes`` has a row ``host, bad`` (0 or 1) per labelled page. A host is blocked
    if the lower bound of its posterior share of bad pages is over ``limit``. Hosts
    without outcomes rest on their domain and suffix, as far as known, and else on
    all outcomes together; without any outcome nothing is blocked by reputation. A NULL url, or one
    without ``://``, has an empty host and path and no rule. Repeated rows are judged each.
    """
    parts = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    parts = parts.withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))})
    labelled = outcomes.filter("host is not null and bad is not null").groupBy("host")
    seen = labelled.agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("bigint")).alias("bad"))
    none = F.lit(0).cast("bigint")
    hosts = parts.select("host").distinct().join(seen, "host", "full_outer")
    hosts = stage(hosts.select("host", F.coalesce("n", none).alias("n"), F.coalesce("bad", none).alias("bad")), "hosts")
    known = host_reputation(hosts).select("host", F.col("lower").alias("reputation"))
    judged = parts.join(known, "host", "left").withColumn("_rule", fitting_rule(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("reputation") > limit, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", F.col("_rule.name").alias("rule"), F.coalesce("_rule.verdict", own).alias("verdict"), "reputation"
    )
