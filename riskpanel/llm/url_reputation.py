"""URL filter by empirical-Bayes reputation of hosts.

Labelled outcomes of pages are counted per host, registered domain and suffix. At each level
the rate of bad pages has a beta prior around the rate of the level above, and the strength of
that prior is fitted to how much the groups of the level really differ (beta-binomial
moments), but never more than the pages behind the level above. A host with few labels is judged by its domain, a domain with few by its suffix. A
page is blocked if even the lower bound of its host's posterior rate is above a limit. Rules of
an operator go first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskpanel.functions import splittable_join
from riskpanel.llm.common import lower_ascii, stored


@dataclass(frozen=True)
class Rule:
    """A host, which stands for its subdomains too, and the beginning of a path."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the registered query.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


@dataclass(frozen=True)
class ReputationConfig:
    """``limit``: bad pages a host may have for sure; ``deviations``: how far below the mean the bound lies.

    ``least`` and ``most`` strength keep a fitted prior from vanishing and from drowning every host.
    """

    rules: tuple[Rule, ...] = RULES
    limit: float = 0.3
    deviations: float = 1.96
    least: float = 2.0
    most: float = 1000.0


def address(url: str = "url") -> dict[str, Column]:
    """host and path of a url; both empty without a scheme mark or for null."""
    rest = F.expr(f"CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) ELSE '' END")
    whole = F.regexp_extract(rest, r"(?s)^([^/?#]*)([^?#]*)", 0)
    host = F.regexp_extract(whole, r"(?s)^([^/]*)", 0)
    return {"host": lower_ascii(host), "path": F.substr(whole, F.length(host) + 1)}


def fitting_rule(rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits host and path, else null. The list is short: an expression."""
    if len(rules) > 500:
        raise ValueError("more than 500 rules need a table and a join, not an expression")
    text = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):  # the last one set wins
        fits = ((F.col("host") == rule.host) | F.endswith("host", F.lit(f".{rule.host}"))) & F.startswith("path", F.lit(rule.path))
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def with_levels(hosts: DataFrame) -> DataFrame:
    """``domain``, the last two labels of a host without its port, and ``suffix``, the last one."""
    bare = F.regexp_replace("host", ":[0-9]*$", "")
    return hosts.withColumn("domain", F.substring_index(bare, ".", -2)).withColumn("suffix", F.substring_index(bare, ".", -1))


def strength(groups: DataFrame, config: ReputationConfig) -> float:
    """Size of the beta prior, from the variance of ``bad / seen`` around ``prior`` beyond that of chance."""
    chance = "prior * (1 - prior)"
    row = groups.filter("seen > 0").selectExpr(
        "sum(seen * pow(bad / seen - prior, 2)) AS found", f"sum({chance}) AS chance", f"sum((seen - 1) * {chance}) AS room"
    ).first()  # one row
    if not row.room or row.found <= row.chance:
        return config.most  # the groups differ no more than by chance
    return min(config.most, max(config.least, row.room / (row.found - row.chance) - 1))


def shrunk(groups: DataFrame, size: float) -> DataFrame:
    """Posterior of each group: the prior counts as ``size`` pages at its rate, or as many as support it."""
    return (
        groups.withColumn("size", F.least(F.lit(size), F.col("support")))
        .withColumn("alpha", F.col("bad") + F.col("size") * F.col("prior"))
        .withColumn("beta", F.col("seen") - F.col("bad") + F.col("size") * (1 - F.col("prior")))
        .withColumn("mean", F.col("alpha") / (F.col("alpha") + F.col("beta")))
    )


def reputations(pages: DataFrame, config: ReputationConfig) -> DataFrame:
    """One row per host of ``pages`` (host, bad, seen): host, seen, mean, bound. Each level is a partial aggregation."""
    hosts = stored(with_levels(pages.groupBy("host").agg(F.sum("bad").alias("bad"), F.sum("seen").alias("seen"))), "hosts")

    def level(*keys: str) -> DataFrame:
        return hosts.groupBy(*keys).agg(F.sum("bad").alias("bad"), F.sum("seen").alias("seen"))

    total = hosts.agg(F.sum("bad").alias("bad"), F.sum("seen").alias("seen")).first()
    overall = ((total.bad or 0) + 1) / ((total.seen or 0) + 2)
    support = F.lit((total.seen or 0) + 2.0)
    suffixes = level("suffix").withColumns({"prior": F.lit(overall), "support": support})
    suffixes = stored(shrunk(suffixes, strength(suffixes, config)), "suffixes")
    above = [F.col("mean").alias("prior"), (F.col("alpha") + F.col("beta")).alias("support")]
    domains = level("domain", "suffix").join(suffixes.select("suffix", *above), "suffix")
    domains = stored(shrunk(domains, strength(domains, config)), "domains")
    priors = domains.select("domain", "suffix", *above)
    known = stored(splittable_join(hosts, priors, ["domain", "suffix"]), "priors")
    size = F.col("alpha") + F.col("beta")
    spread = F.sqrt(F.col("alpha") * F.col("beta") / (size * size * (size + 1)))
    return shrunk(known, strength(known, config)).select(
        "host", "seen", "mean", (F.col("mean") - config.deviations * spread).alias("bound")
    )


def judge_urls(pages: DataFrame, labels: DataFrame, config: ReputationConfig = ReputationConfig()) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, and the host's seen, mean and bound.

    ``labels`` has the outcome of the page of the same id (doc_id, quality): bad if any of its labels is 0. Null
    urls and urls without a scheme mark have the empty host, which has a reputation like any other. Without labels
    every host has the even prior. Repeated pages count and are judged each; a null page_id has no label. Only
    page_id and url are read.
    """
    split = stored(pages.select("page_id", "url").withColumns(address()).drop("url"), "addresses")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), "quality").dropna().groupBy("page_id").agg(
        F.min("quality").alias("quality")
    )
    seen = split.join(outcomes, "page_id", "left").select(
        "host", F.coalesce((F.col("quality") == 0).cast("long"), F.lit(0)).alias("bad"),
        F.col("quality").isNotNull().cast("long").alias("seen"),
    )
    known = stored(reputations(seen, config), "reputations")
    rule, verdict = fitting_rule(config.rules)
    own = F.when(F.col("bound") > config.limit, "block").otherwise("allow")
    return splittable_join(split, known, ["host"], "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "seen", "mean", "bound"
    )
