"""URL filter: rules first, then empirical-Bayes host reputation.

Labelled page outcomes are counted by host, once. Three beta-binomial levels (suffix under the whole, registered
domain under its suffix, host under its domain) each get a prior strength from the method of moments, in which a group
counts by its labels less one, so that a hot host decides no more than its share of labels; a host's posterior is a
beta distribution about its domain's mean, that about its suffix's, and that about the mean of all. A host is blocked
if its share of good pages is below `least` with a posterior probability above `sure`, that is, if the upper `sure`
quantile of the beta posterior is below `least`.

Nulls and ties: a null url, or one without "://", has host '' and path ''; very long urls are read whole; hosts without
outcomes take their domain's prior; null outcomes don't count. Empty tables give empty results. Columns of the input
other than those named are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, scratch

#: A country suffix with a generic second label counts as one suffix (co.uk).
_SUFFIX = r"(?:^|\.)((?:co|com|ac|gov|org|net)\.[a-z]{2}|[^.]+)$"
_DOMAIN = r"(?:^|\.)([^.]+\.(?:(?:co|com|ac|gov|org|net)\.[a-z]{2}|[^.]+))$"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): the host after the first "://" up to / ? # or the end, A-Z lower-cased; the path then up
    to ? # or the end."""
    rest = F.coalesce(F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))), F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def registered_domain(host: Column) -> Column:
    found = F.regexp_extract(host, _DOMAIN, 1)
    return F.when(found == "", host).otherwise(found)


def suffix(host: Column) -> Column:
    return F.regexp_extract(host, _SUFFIX, 1)


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str  # host, then the path from its first slash

    def fits(self, host: Column, path: Column) -> Column:
        name, _, rest = self.text.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)


def match_rules(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. Among rules of one length the first counts."""
    rule = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        rule, verdict = F.when(r.fits(host, path), r.text).otherwise(rule), F.when(r.fits(host, path), r.verdict).otherwise(verdict)
    return rule, verdict


def beta_below(x: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """P(theta < x) of beta distributions, by the continued fraction of the incomplete beta function, taken from the side
    where it ends soon."""
    a, b = np.asarray(a, float), np.asarray(b, float)
    far = x > (a + 1) / (a + b + 2)
    p, q, at = np.where(far, b, a), np.where(far, a, b), np.where(far, 1 - x, x)
    logs = np.array([math.lgamma(i + j) - math.lgamma(i) - math.lgamma(j) for i, j in zip(p.tolist(), q.tolist(), strict=True)]).reshape(p.shape)
    front = np.exp(logs + p * np.log(at) + q * np.log1p(-at)) / p
    tiny = 1e-300
    c, d = np.ones_like(p), 1 - (p + q) * at / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    out = d.copy()
    for m in range(1, 100_000):
        change = np.ones_like(out)
        for term in (m * (q - m) * at / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * at / ((p + 2 * m) * (p + 2 * m + 1))):
            d, c = 1 + term * d, 1 + term / c
            d, c = 1 / np.where(np.abs(d) < tiny, tiny, d), np.where(np.abs(c) < tiny, tiny, c)
            change = change * d * c
            out = out * (d * c)
        if not np.any(np.abs(change - 1) > 1e-14):
            break
    found = front * out
    return np.where(far, 1 - found, found)


def _strength(df: DataFrame, mean: str) -> float:
    """Prior strength k = (1 - rho) / rho, rho from each group's second moment about its prior mean, weighted by n - 1."""
    m, n, x = F.col(mean), F.col("n"), F.col("x")
    row = df.where((n > 1) & (m > 0) & (m < 1)).agg(
        F.sum(((x - n * m) * (x - n * m) / (m * (1 - m)) - n) / n).alias("a"), F.sum(n - 1).alias("b")
    ).first()
    rho = row.a / row.b if row.b else 0.0
    rho = min(max(rho, 1e-3), 0.999)
    return (1 - rho) / rho


def host_reputation(outcomes: DataFrame, least: float = 0.5) -> DataFrame:
    """outcomes(host, good 0/1/null): one row per host with n, x, the posterior mean and `bad`, the posterior probability
    that the share of good pages is below `least`. Outcomes are read once; what follows reads a row per host."""
    hosts = outcomes.groupBy("host").agg(F.count("good").cast("double").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).cast("double").alias("x"))
    hosts = scratch(hosts.withColumns({"domain": registered_domain(F.col("host")), "suffix": suffix(F.col("host"))}), "reputation-hosts")
    domains = scratch(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("x").alias("x")), "reputation-domains")
    suffixes = scratch(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("x").alias("x")), "reputation-suffixes")
    row = suffixes.agg(F.sum("n").alias("n"), F.sum("x").alias("x")).first()
    whole = ((row.x or 0.0) + 0.5) / ((row.n or 0.0) + 1.0)

    def shrunk(df: DataFrame, prior: str, name: str, k: float) -> DataFrame:
        return df.withColumn(name, (F.col(prior) * k + F.col("x")) / (F.col("n") + k))

    suffixes = suffixes.withColumn("m0", F.lit(whole))
    suffixes = shrunk(suffixes, "m0", "m1", _strength(suffixes, "m0"))
    domains = domains.join(suffixes.select("suffix", "m1"), "suffix")
    domains = shrunk(domains, "m1", "m2", _strength(domains, "m1"))
    hosts = hosts.join(domains.select("domain", "suffix", "m2"), ["domain", "suffix"])
    k = _strength(hosts, "m2")
    posterior = shrunk(hosts, "m2", "mean", k).withColumn("size", F.col("n") + k).select("host", "n", "x", "mean", "size")

    def below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mean, size = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("mean", "size"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(beta_below(least, mean * size, (1 - mean) * size))], names=[*batch.schema.names, "bad"])

    return posterior.mapInArrow(below, "host string, n double, x double, mean double, size double, bad double")


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], least: float = 0.5, sure: float = 0.95) -> DataFrame:
    """pages(page_id, url) with host, path, rule, verdict, and the posterior that the verdict rests on.
    outcomes(host, good) may name hosts that no page has. The join is on host: AQE splits a hot one."""
    host, path = url_parts(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"))
    seen = judged.select("host", F.lit(None).cast("int").alias("good")).unionByName(outcomes.select("host", F.col("good").cast("int")))
    reputation = scratch(host_reputation(seen, least).select("host", "mean", "bad"), "reputation")
    rule, verdict = match_rules(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("bad") > sure, "block").otherwise("allow")
    return judged.join(reputation, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"),
        F.round("mean", 6).alias("posterior_mean"), F.round("bad", 6).alias("posterior_bad"),
    )
