"""URL filtering by rules, and by host reputations from labelled pages.

A host's share of bad pages has a beta prior around the share of its registered domain, which has
one around that of its suffix, which has one around that of all pages. How tight the priors of a
level are is estimated from how much its shares scatter (beta-binomial moments), together with a
prior on that scatter: where nothing is known of it, shares are taken to scatter widely. A host is
blocked when the lower quantile of its posterior is above the limit. Uncertainty about the mean of
all pages goes down to the hosts, so little evidence blocks nothing, and many bad pages do.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import lgamma

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelbench.shared import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# Frequent suffixes of several labels, under which anyone can register: kinds of names under country
# codes, and hosts of pages of many owners.
KINDS = r"(?:ac|co|com|edu|gob|gov|ne|net|or|org|go)\.(?:ar|au|br|cn|hk|id|il|in|jp|kr|mx|my|nz|sg|th|tr|tw|ua|uk|za)"
SHARED = r"(?:github|gitlab)\.io|(?:blogspot|wordpress|herokuapp)\.com|(?:pages|workers)\.dev|(?:netlify|vercel)\.app"
LONG_SUFFIX = rf"(?:^|\.)(?:{KINDS}|{SHARED}|(?:ltd|me|nhs|plc|sch)\.uk)$"
ADDRESS = r"^[0-9]+(?:\.[0-9]+){3}$"
# The prior on the scatter inside a level: this spread, with the weight of one pair of pages.
USUAL_SPREAD, LEAST_SPREAD, MOST_SPREAD = 0.1, 0.001, 0.5
LEAST_STRENGTH = 2  # no prior is wider than one that knows nothing
LIMIT, DOUBT = 0.3, 0.05


def host_of(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#``; A-Z lower-cased; empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER)


def path_of(url: str | Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def site_of(host: str | Column) -> Column:
    """The host without user and port: whose reputation it is."""
    host = F.col(host) if isinstance(host, str) else host
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")


def _last_labels(site: str | Column, n: int) -> Column:
    site = F.col(site) if isinstance(site, str) else site
    labels = F.when(site.rlike(LONG_SUFFIX), F.substring_index(site, ".", -n - 1)).otherwise(
        F.substring_index(site, ".", -n)
    )
    return F.when(site.rlike(ADDRESS), site).otherwise(labels)


def domain_of(site: str | Column) -> Column:
    """The suffix of the site and one label before it; the whole of an IPv4 address."""
    return _last_labels(site, 2)


def suffix_of(site: str | Column) -> Column:
    """The last label of the site, or the last two where these are a frequent public suffix; the
    whole of an IPv4 address."""
    return _last_labels(site, 1)


def rule_for(rules: Sequence[tuple[str, str]], host: str, path: str) -> Column:
    """(rule, verdict) of the longest rule that fits, or null. Rules are (verdict, host/path)."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, start = rule.partition("/")
        own = (F.col(host) == name) | F.col(host).endswith("." + name)
        fits = own & F.col(path).startswith(slash + start)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(
            found
        )
    return found


def _with_prior(children: DataFrame) -> DataFrame:
    """``children`` (``n``, ``bad``, ``above``, ``below``) with their prior, ``a`` and ``b``.

    ``above`` and ``below`` are the beta posterior of the parent's share without the child's own
    pages. The child's share has the same mean, and its variance more by what shares scatter here.
    """
    size = F.col("above") + F.col("below")
    mean = F.col("above") / size
    odds = mean * (1 - mean)
    vague = odds / (size + 1)
    pairs = F.col("n") * (F.col("n") - 1)
    over = (F.col("bad") - F.col("n") * mean) ** 2 - F.col("n") * odds - pairs * vague
    seen = children.agg(
        F.sum(over).alias("over"), F.sum(pairs * (odds - vague)).alias("room")
    ).first()
    spread = ((seen["over"] or 0.0) + USUAL_SPREAD) / ((seen["room"] or 0.0) + 1)
    spread = min(MOST_SPREAD, max(LEAST_SPREAD, spread))
    strength = F.greatest(F.lit(float(LEAST_STRENGTH)), odds / (vague + spread * (odds - vague)) - 1)
    return children.withColumns({"a": strength * mean, "b": strength * (1 - mean)}).drop("above", "below")


def _beneath(children: DataFrame, parents: DataFrame, name: str) -> DataFrame:
    """``children`` with the posterior of their parent without what they ``gave`` to it."""
    whole = parents.select(name, *[F.col(c).alias(f"_{c}") for c in ("n", "bad", "a", "b")])
    others, bad = F.col("_n") - F.col("gave.n"), F.col("_bad") - F.col("gave.bad")
    return cut(
        children.join(whole, name)
        .withColumn("above", F.col("_a") + bad)
        .withColumn("below", F.col("_b") + others - bad)
        .drop("_n", "_bad", "_a", "_b", "gave")
    )


def _merged(children: DataFrame, *names: str) -> DataFrame:
    """Each parent's ``n`` and ``bad``, the sums of what its children ``gave``: for one with
    outcomes 1 and the share of bad ones, as pages of one host say little about other hosts."""
    whole = children.groupBy(*names).agg(F.sum("gave.n").alias("n"), F.sum("gave.bad").alias("bad"))
    return cut(whole.withColumn("gave", _one_share()))


def _one_share() -> Column:
    share = F.when(F.col("n") > 0, F.col("bad") / F.col("n")).otherwise(0.0)
    return F.struct((F.col("n") > 0).cast("int").alias("n"), share.alias("bad"))


def beta_share(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of a beta distribution up to ``x``, by its continued fraction."""
    turned = x > (a + 1) / (a + b + 2)
    a, b, x = np.where(turned, b, a), np.where(turned, a, b), np.where(turned, 1 - x, x)
    of_both, of_a, of_b = (np.array([lgamma(v) for v in values]) for values in (a + b, a, b))
    with np.errstate(divide="ignore"):
        front = np.exp(of_both - of_a - of_b + a * np.log(x) + b * np.log1p(-x)) / a
    tiny = 1e-300
    c, d = np.ones_like(a), 1 / np.maximum(1 - (a + b) * x / (a + 1), tiny)
    value = d.copy()
    for m in range(1, 10_000):
        before = value
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d, c = 1 + step * d, 1 + step / c
            d, c = np.where(np.abs(d) < tiny, tiny, d), np.where(np.abs(c) < tiny, tiny, c)
            d = 1 / d
            value = value * (d * c)
        if np.all(np.abs(value - before) <= 1e-14 * np.abs(value)):
            break
    return np.where(turned, 1 - front * value, front * value)


def lower_quantile(doubt: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where the share of a beta distribution is ``doubt``, by halving."""
    low, high = np.zeros(len(a)), np.ones(len(a))
    for _ in range(48):
        middle = (low + high) / 2
        above = beta_share(middle, a, b) > doubt
        low, high = np.where(above, low, middle), np.where(above, middle, high)
    return (low + high) / 2


def host_reputations(pages: DataFrame, outcomes: DataFrame, doubt: float = DOUBT) -> DataFrame:
    """``site``, ``n``, ``bad``, ``mean``, ``bound`` for every site of ``pages``.

    ``pages`` has ``page_id`` and ``site``; ``outcomes`` has ``page_id`` and ``bad`` (0 or 1, null
    ones are left out; several of one page all count). ``bound`` is the quantile at ``doubt`` of the
    posterior of the share of bad pages. A site's prior comes from the other sites of its domain, that
    one's from the other domains of its suffix, that one's from the domains of all other suffixes, and
    the last one is uniform. So without outcomes every site has a wide posterior and a low bound.
    """
    known = outcomes.where(F.col("bad").isNotNull()).select("page_id", "bad")
    seen = (
        pages.join(known, "page_id", "left")
        .groupBy("site")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    )
    sites = seen.withColumns({"domain": domain_of("site"), "suffix": suffix_of("site"), "gave": _one_share()})
    sites = cut(sites)
    domains = _merged(sites, "domain", "suffix")
    suffixes = _merged(domains, "suffix")
    suffixes = suffixes.withColumns({"whole": F.lit(1), "gave": F.struct("n", "bad")})
    everything = suffixes.groupBy("whole").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    everything = everything.withColumns({"a": F.lit(1.0), "b": F.lit(1.0)})
    suffixes = _with_prior(_beneath(suffixes, everything, "whole"))
    domains = _with_prior(_beneath(domains, suffixes, "suffix"))
    shrunk = _with_prior(_beneath(sites, domains, "domain"))

    @F.pandas_udf("double")
    def bound(alpha: pd.Series, beta: pd.Series) -> pd.Series:
        return pd.Series(lower_quantile(doubt, alpha.to_numpy(), beta.to_numpy()))

    alpha, beta = F.col("a") + F.col("bad"), F.col("b") + F.col("n") - F.col("bad")
    return shrunk.select(
        "site", "n", "bad", (alpha / (alpha + beta)).alias("mean"), bound(alpha, beta).alias("bound")
    )


def judged(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str]],
    limit: float = LIMIT,
    doubt: float = DOUBT,
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``bound`` for every row of ``pages``.

    ``pages`` has ``page_id`` and ``url``. The longest rule that fits decides; without one a host
    whose ``bound`` is above ``limit`` is blocked. Null urls and those without ``://`` have an empty
    host and path and are judged like any host. User and port belong to the host, but hosts that
    differ in them only share a reputation. Null page_ids have no outcomes. Without any outcome no host
    is blocked but by a rule. No rows give no rows. Outcomes shrink to one row per host before anything
    is joined with the pages.
    """
    places = pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"))
    places = places.withColumn("site", site_of("host"))
    hosts = host_reputations(places.select("page_id", "site"), outcomes, doubt)
    found = rule_for(rules, "host", "path")
    learned = F.when(F.col("bound") > limit, "block").otherwise("allow")
    return places.join(hosts.select("site", "bound"), "site").select(
        "page_id",
        "host",
        "path",
        found["rule"].alias("rule"),
        F.coalesce(found["verdict"], learned).alias("verdict"),
        "bound",
    )
