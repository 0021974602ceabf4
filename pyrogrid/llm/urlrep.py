"""URL filtering by rules and by empirical-Bayes reputation of hosts.

Outcomes of labelled pages are counted by host, registered domain and suffix.  Each level's rate is
shrunk towards the level above through a beta prior whose strength is fitted to the spread of the
level's own units (method of moments): suffix towards the whole, domain towards its suffix, host towards its domain.
A host is blocked where even the upper bound of its posterior (mean plus ``z`` standard deviations) lies under ``least``.

Pages are read into a table of one row per host once; everything else is worked out from that, and from one row per
distinct (host, path) that a rule may fit.  Three numbers a level (sums over its units) come to the driver.

Defined results: a null url or one without ``://`` has an empty host and path and is judged by the
prior of the empty suffix; a port and what stands before an ``@`` belong to the host but not to its domain; a host of digits
and dots alone, or in brackets, is its own domain with an empty suffix; pages without labelled relatives get the overall prior; very long urls are split like others;
repeated pages get equal verdicts, and several outcomes of one page count as its greatest; null outcomes and null page ids of outcomes are
not counted; an empty table gives an empty result; columns beside page_id and url are not read and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import looked_up, written

#: Up to so many rules the table of rules is broadcast; beyond it is joined by a shuffle.
BROADCAST_RULES = 100_000
#: Up to so many lengths of rules' paths a url's path is cut at these alone; beyond, at every length up to the longest.
PATH_LENGTHS = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Common public suffixes of two labels, a parameter of judge().
SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "com.tw", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk")
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1000.0


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", text)
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def registered_domain(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix: the suffix is the last label, or a listed one of two; the domain is one label more."""
    name = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), r":\d*$", "")
    labels = F.split(name, r"\.")
    tail = lambda k: F.array_join(F.slice(labels, -F.least(k, F.size(labels)), F.least(k, F.size(labels))), ".")
    n = F.when(tail(F.lit(2)).isin(*suffixes), 2).otherwise(1) if suffixes else F.lit(1)
    address = name.rlike(r"^([0-9.]+|\[.*\])$")
    return F.when(address, name).otherwise(tail(n + 1)), F.when(address, "").otherwise(tail(n))


def rule_matches(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Per distinct (host, path) of urls that a rule fits: rule and action of the longest.

    rules: host, path, action.  A rule fits its host and all subdomains if the path starts with the
    rule's.  Host endings and path beginnings are matched by an equality join on (ending, beginning).
    """
    own = rules.select(F.col("host").alias("r_host"), F.col("path").alias("r_path"), "action").distinct()
    n = F.length("r_path")
    longest, *lengths = own.agg(F.max(n), F.slice(F.sort_array(F.collect_set(F.when(n < PATH_LENGTHS, n))), 1, PATH_LENGTHS)).first()
    longest, lengths = longest or 0, lengths[0]
    labels = F.split("host", r"\.")
    endings = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    at = F.array(*[F.lit(x) for x in lengths]).cast("array<int>")
    if longest >= PATH_LENGTHS:
        at = F.when(F.length("path") >= PATH_LENGTHS, F.concat(at, F.sequence(F.lit(PATH_LENGTHS), F.least(F.length("path"), F.lit(longest))))).otherwise(at)
    begins = F.array_distinct(F.transform(at, lambda k: F.substring("path", F.lit(1), k)))
    tried = urls.select("host", "path", F.explode(endings).alias("r_host")).select("*", F.explode(begins).alias("r_path"))
    if own.limit(BROADCAST_RULES + 1).count() <= BROADCAST_RULES:
        own = F.broadcast(own)
    size = F.length("rule")
    return (
        tried.join(own, ["r_host", "r_path"])
        .withColumn("rule", F.concat("r_host", "r_path"))
        .groupBy("host", "path")
        .agg(F.max(F.struct(size.alias("n"), F.length("r_host").alias("h"), "rule", "action")).alias("best"))
        .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.action").alias("action"))
    )


def _strength(units: DataFrame, mean: Column) -> float:
    """The beta prior's strength (pseudo-outcomes) by moments of units (n, k) about their own means."""
    n, k = F.col("n"), F.col("k")
    sums = units.filter("n > 0").agg(
        F.sum((k - n * mean) ** 2 / n), F.sum(mean * (1 - mean)), F.sum((n - 1) * mean * (1 - mean))
    )
    spread, expected, within = (x or 0.0 for x in sums.first())
    # Var(k) = n m (1 - m) (1 + (n - 1) rho), so rho = (spread - expected) / within, and strength = 1 / rho - 1
    if within <= 0 or spread <= expected:
        return MOST_STRENGTH
    return min(MOST_STRENGTH, max(LEAST_STRENGTH, within / (spread - expected) - 1))


def reputation(hosts: DataFrame, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """Of hosts (host, n, k: labelled pages and good ones among them): host, domain, suffix, n, posterior alpha, beta, mean and sd.

    A hot domain or suffix is counted by partial sums before any shuffle, and met by broadcast or salted.
    """
    domain, suffix = registered_domain(F.col("host"), suffixes)
    every = hosts.select("host", "n", "k", domain.alias("domain"), suffix.alias("suffix"))
    by = lambda df, *c: df.groupBy(*c).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    domains = written(by(every, "domain", "suffix"))
    tops = written(by(domains, "suffix"))
    n, k = (x or 0 for x in tops.agg(F.sum("n"), F.sum("k")).first())
    whole = F.lit((k + 1) / (n + 2))
    shrunk = lambda mean, s: (F.col("k") + s * mean) / (F.col("n") + s)
    tops = tops.select("suffix", shrunk(whole, _strength(tops, whole)).alias("top"))
    domains = looked_up(domains, tops, "suffix")
    domains = domains.select("domain", shrunk(F.col("top"), _strength(domains, F.col("top"))).alias("mid"))
    units = looked_up(every, domains, "domain")
    s = _strength(units, F.col("mid"))
    a, b = F.col("k") + s * F.col("mid"), F.col("n") - F.col("k") + s * (1 - F.col("mid"))
    return (
        units.select("host", "domain", "suffix", "n", "k", a.alias("alpha"), b.alias("beta"))
        .withColumn("mean", F.col("alpha") / (F.col("alpha") + F.col("beta")))
        .withColumn("sd", F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("alpha") + F.col("beta") + 1)))
    )


def judge(pages: DataFrame, outcomes: DataFrame, rules: DataFrame, z: float = 1.645, least: float = 0.5, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """Per page (page_id, url): page_id, host, path, rule, verdict, n_labelled, posterior_mean.

    outcomes: page_id, good.  Rules come first; without one, a host is blocked if mean + z sd < least.
    """
    host, path = split_url(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = outcomes.filter(F.col("page_id").isNotNull() & F.col("good").isNotNull()).groupBy("page_id").agg(F.max(F.col("good").cast("long")).alias("good"))
    # one row per host; a hot host is counted by partial sums before the shuffle
    hosts = written(looked_up(split, known, "page_id", "left").groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("k")))
    matched = rule_matches(split.select("host", "path").distinct(), rules)
    # null urls and a page that is fetched again and again are one pair of host and path
    ruled = looked_up(split, written(matched), ["host", "path"], "left")
    judged = looked_up(ruled, written(reputation(hosts, suffixes).select("host", "mean", "sd", "n")), "host")
    own = F.when(F.col("mean") + z * F.col("sd") < least, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("action", own).alias("verdict"), F.col("n").alias("n_labelled"), F.round("mean", 6).alias("posterior_mean"))
