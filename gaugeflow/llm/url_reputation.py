"""URL filter by empirical-Bayes host reputation.

Labelled page outcomes (good / bad) are counted per host and shrunk through
beta-binomial priors: global -> public suffix -> registered domain -> host.
The prior of a node has the posterior mean of its parent and a strength
fitted by the method of moments over all siblings (one strength per level).
A url is allowed when the lower posterior bound of its host reaches the
threshold. Explicit allow / block rules go first; the longest fitting wins.

Scale: outcomes are pre-aggregated per host before any shuffle of counts; the
reputation table (one row per host) is written once, so the final join has
plain exchanges on both sides and a hot host is split by AQE. Only three
fitted strengths and the global mean (one row) reach the driver.

Defined cases: a url that is null or has no ``://`` has empty host and path
and the reputation of the empty host; a null label counts for nothing; a host
without labels gets its domain's prior; repeated rows are judged each;
without any labels the prior is Beta(1, 1). Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.base import ASCII_LOWER, ASCII_UPPER, materialize

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Suffixes of two labels; any other host's suffix is its last label.
TWO_LABEL_SUFFIXES = (
    "ac.uk", "co.in", "co.jp", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx", "gov.uk", "ne.jp",
    "net.au", "or.jp", "org.au", "org.uk",
)


@dataclass(frozen=True)
class Rule:
    """``verdict`` for ``host`` and its subdomains, paths from ``path`` on."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Reputation:
    """Parameters: threshold on the lower bound, its normal quantile, and the
    range and default of the intra-class correlation (strength = 1/rho - 1)."""

    threshold: float = 0.6
    quantile: float = 1.645
    rho_low: float = 0.001
    rho_high: float = 0.5
    rho_default: float = 0.1


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1)
    return F.translate(host, ASCII_UPPER, ASCII_LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def with_domain(hosts: DataFrame) -> DataFrame:
    """Adds ``suffix`` and registered ``domain``; addresses and hosts without
    a dot are their own domain (suffix ``''`` and the host itself)."""
    bare = F.regexp_replace(F.regexp_replace("host", "^.*@", ""), ":[0-9]*$", "")
    two = F.substring_index(bare, ".", -2)
    numeric = bare.rlike("^[0-9.]*$") | bare.startswith("[")
    suffix = F.when(numeric, "").when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(bare, ".", -1))
    labels = F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(bare, ".", -3)).otherwise(two)
    return hosts.withColumns({"suffix": suffix, "domain": F.when(numeric, bare).otherwise(labels)})


def rule_columns(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits ``host`` and ``path``,
    nulls if none. The list is a bounded parameter, tried longest first."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path)
        text, verdict = F.when(fits, r.text).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def _strength(children: DataFrame, parent: str | None, p: Reputation) -> Column:
    """One-row frame's ``strength``: method of moments over siblings.

    With k good of n per child and K of N per parent, the chi-square excess
    sum((n * (k/n - K/N)^2) / (K/N * (1 - K/N))) - (children - 1) over
    sum(N - sum(n^2)/N - (children - 1)) estimates rho."""
    by = [parent] if parent else []
    sums = (
        children.filter("n > 0")
        .groupBy(*by)
        .agg(
            F.sum("n").cast("double").alias("nn"),
            F.sum("k").cast("double").alias("kk"),
            F.count(F.lit(1)).cast("double").alias("m"),
            F.sum(F.col("k") * F.col("k") / F.col("n")).alias("k2"),
            F.sum((F.col("n") * F.col("n")).cast("double")).alias("n2"),
        )
        .filter("kk > 0 AND kk < nn")
    )
    rate = F.col("kk") / F.col("nn")
    fitted = sums.agg(
        F.sum((F.col("k2") - F.col("kk") * rate) / (rate * (1 - rate)) - (F.col("m") - 1)).alias("excess"),
        F.sum(F.col("nn") - F.col("n2") / F.col("nn") - (F.col("m") - 1)).alias("room"),
    )
    rho = F.when(F.col("room") > 0, F.greatest(F.lit(p.rho_low), F.least(F.lit(p.rho_high), F.col("excess") / F.col("room"))))
    return fitted.select((1 / F.coalesce(rho, F.lit(p.rho_default)) - 1).alias("strength"))


def _shrunk(children: DataFrame, prior: Column, strength: float, name: str) -> DataFrame:
    mean = (F.lit(strength) * prior + F.col("k")) / (F.lit(strength) + F.col("n"))
    return children.withColumn(name, mean)


def host_reputation(outcomes: DataFrame, params: Reputation = Reputation()) -> DataFrame:
    """``(host, domain, suffix, n, k, mean, low)`` for every host.

    ``outcomes``: ``host``, ``n`` labels and ``k`` good ones (0 and 0 if none)."""
    counts = outcomes.groupBy("host").agg(F.sum("n").cast("long").alias("n"), F.sum("k").cast("long").alias("k"))
    hosts = materialize(with_domain(counts), "hosts")
    total = F.sum("n").alias("n"), F.sum("k").alias("k")
    domains = hosts.groupBy("domain", "suffix").agg(*total)
    suffixes = hosts.groupBy("suffix").agg(*total)
    # Three strengths and the global mean: four rows, whatever the input's size.
    mean = (F.coalesce(F.sum("k"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)
    rows = (
        _strength(hosts, "domain", params).select(F.lit("host").alias("level"), "strength")
        .union(_strength(domains, "suffix", params).select(F.lit("domain"), "strength"))
        .union(_strength(suffixes, None, params).select(F.lit("suffix"), "strength"))
        .union(hosts.agg(mean.alias("strength")).select(F.lit("mean"), "strength"))
    )
    fit = {r["level"]: r["strength"] for r in rows.collect()}
    top = _shrunk(suffixes, F.lit(fit["mean"]), fit["suffix"], "above").select("suffix", "above")
    mid = _shrunk(domains.join(top, "suffix"), F.col("above"), fit["domain"], "prior").select("domain", "suffix", "prior")
    own = _shrunk(hosts.join(mid, ["domain", "suffix"]), F.col("prior"), fit["host"], "mean")
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.lit(fit["host"]) + F.col("n") + 1))
    return own.withColumn("low", F.col("mean") - F.lit(params.quantile) * spread)


def judge_urls(
    pages: DataFrame, labels: DataFrame, rules: Sequence[Rule] = (), params: Reputation = Reputation()
) -> DataFrame:
    """One row per page: ``page_id, url, host, path, rule, verdict, mean, low``.

    ``pages``: ``page_id``, ``url``; ``labels``: ``page_id``, ``good``."""
    urls = pages.select("page_id", "url").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    marks = labels.groupBy("page_id").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("k"))
    seen = urls.select("page_id", "host").join(marks, "page_id", "left").na.fill(0, ["n", "k"])
    reputation = materialize(host_reputation(seen, params).select("host", "mean", "low"), "reputation")
    text, verdict = rule_columns(rules)
    own = F.when(F.col("low") >= params.threshold, "allow").otherwise("block")
    return urls.join(reputation, "host", "left").withColumns({"rule": text, "verdict": F.coalesce(verdict, own)})
