"""URL filter: fixed rules first, then empirical-Bayes host reputation.

Labelled page outcomes (1 bad, 0 good) are counted per host, registered domain
and public suffix.  At each level the units are draws from a beta whose mean is
their parent's posterior mean; its weight (pseudo-pages) comes from the spread
of the units of that level by the method of moments.  So a host without labels
has its domain's rate, a domain without labels its suffix's.  A host is blocked
if the lower bound of its bad rate (posterior mean minus ``z`` standard
deviations) is over ``max_bad``.  Only DataFrame functions run; the three
weights are single rows, joined as such.

A rule (host, path) fits its host and all subdomains if the url's path starts
with the rule's path; of several, the longest host + path wins (then the longer
host, then block).  Rules are a short configuration list, compiled into one
expression.

Cases: a null url or one without ``://`` has an empty host and path; the empty
host is a host like any other, under the empty domain and suffix; a page
labelled twice is bad if one label says so; labels of unknown pages are
ignored; without labels every rate is 1/2 and its bound stays under it; a
repeated page row is judged as often as it stands.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabline.llm._common import cut

MAX_RULES = 500
#: suffixes of more than one label (fixed values); extend by the parameter
LONG_SUFFIXES = ("ac.uk", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au",
                 "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "ne.jp", "net.au", "or.jp",
                 "org.au", "org.uk")
WEIGHT_RANGE = (0.5, 1e4)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*long_suffixes), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*long_suffixes), F.substring_index(host, ".", -3)).otherwise(two)


def rule_columns(host: Column, path: Column,
                 rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the winning rule, null where none fits."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules: more than {MAX_RULES}; join a rule table instead")
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0] != "block", r))
    rule = verdict = None
    for kind, rule_host, rule_path in order:
        fits = (((host == rule_host) | host.endswith("." + rule_host))
                & path.startswith(rule_path))
        text = F.lit(rule_host + rule_path)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, F.lit(kind)) if verdict is None else verdict.when(fits, F.lit(kind))
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def _weight(units: DataFrame) -> DataFrame:
    """One row ``w``: the beta's weight from units (n, k, parent mean p)."""
    spread = F.sum((F.col("k") - F.col("n") * F.col("p")) ** 2 / (F.col("p") * (1 - F.col("p"))))
    rho = (spread - F.sum("n")) / F.sum(F.col("n") * (F.col("n") - 1.0))
    low, high = WEIGHT_RANGE
    weight = F.when(F.sum(F.col("n") * (F.col("n") - 1.0)) > 0,
                    F.when(rho > 0, 1 / F.greatest(rho, F.lit(1e-9)) - 1).otherwise(F.lit(high)))
    return units.agg(F.least(F.lit(high), F.greatest(F.lit(low), F.coalesce(
        weight, F.lit(low)))).alias("w"))


def host_reputation(outcomes: DataFrame, z: float,
                    long_suffixes: Sequence[str] = LONG_SUFFIXES) -> tuple:
    """(hosts, domains, suffixes, all): posterior tables of ``outcomes(host, bad)``."""
    per_host = outcomes.groupBy("host").agg(F.count("bad").cast("double").alias("n"),
                                            F.sum("bad").cast("double").alias("k"))
    per_host = per_host.select("host", domain_of(F.col("host"), long_suffixes).alias("domain"),
                               suffix_of(F.col("host"), long_suffixes).alias("suffix"), "n", "k")
    # each level is read twice by the next: cut, or plans double level by level
    per_host = cut(per_host, "host-outcomes")
    total = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    per_domain = per_host.groupBy("domain", "suffix").agg(*total)
    per_suffix = per_domain.groupBy("suffix").agg(*total)
    whole = per_suffix.agg(((F.coalesce(F.sum("k"), F.lit(0.0)) + 0.5)
                            / (F.coalesce(F.sum("n"), F.lit(0.0)) + 1)).alias("p"))
    posterior = (F.col("k") + F.col("w") * F.col("p")) / (F.col("n") + F.col("w"))

    def shrunk(units: DataFrame) -> DataFrame:
        return units.join(F.broadcast(_weight(units)))      # one row

    suffixes = shrunk(per_suffix.join(F.broadcast(whole)))
    suffixes = cut(suffixes.select("suffix", posterior.alias("p_suffix")), "suffix-rates")
    domains = shrunk(per_domain.join(suffixes, "suffix").withColumnRenamed("p_suffix", "p"))
    domains = cut(domains.select("domain", posterior.alias("p_domain")), "domain-rates")
    hosts = cut(shrunk(per_host.join(domains, "domain").withColumnRenamed("p_domain", "p")),
                "host-rates")
    return hosts, domains, suffixes, whole, posterior


def judge_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]],
               max_bad: float = 0.3, z: float = 1.645,
               long_suffixes: Sequence[str] = LONG_SUFFIXES, id_col: str = "page_id",
               url_col: str = "url", label_id_col: str = "page_id",
               bad_col: str = "bad") -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, and ``bad_rate`` and ``bad_bound``
    (posterior mean and lower bound of its host)."""
    url = F.col(url_col)
    pages = pages.select(F.col(id_col).cast("long").alias("page_id"), host_of(url).alias("host"),
                         path_of(url).alias("path"))
    bad = (labels.select(F.col(label_id_col).cast("long").alias("page_id"),
                         F.col(bad_col).cast("int").alias("bad"))
           .where("page_id is not null and bad in (0, 1)")
           .groupBy("page_id").agg(F.max("bad").alias("bad")))
    outcomes = pages.select("page_id", "host").join(bad, "page_id").select("host", "bad")
    hosts, domains, suffixes, whole, posterior = host_reputation(outcomes, z, long_suffixes)
    a = F.col("k") + F.col("w") * F.col("p")
    b = F.col("n") - F.col("k") + F.col("w") * (1 - F.col("p"))
    weights = hosts.agg(F.max("w").alias("w"))              # one row; null without labels

    # every host that occurs, with or without labels
    seen = pages.groupBy("host").agg(F.lit(1).alias("one")).select(
        "host", domain_of(F.col("host"), long_suffixes).alias("domain"),
        suffix_of(F.col("host"), long_suffixes).alias("suffix"))
    every = (seen.join(hosts.select("host", "n", "k"), "host", "left")
             .join(domains, "domain", "left").join(suffixes, "suffix", "left")
             .join(F.broadcast(whole)).join(F.broadcast(weights))
             .select("host", F.coalesce("n", F.lit(0.0)).alias("n"),
                     F.coalesce("k", F.lit(0.0)).alias("k"),
                     F.coalesce("p_domain", "p_suffix", "p").alias("p"),
                     F.coalesce("w", F.lit(WEIGHT_RANGE[0])).alias("w")))
    spread = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    every = every.select("host", posterior.alias("bad_rate"),
                         (posterior - z * spread).alias("bad_bound"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("bad_bound") > max_bad, F.lit("block")).otherwise(F.lit("allow"))
    return (pages.join(every, "host", "left")
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(verdict, method).alias("verdict"), "bad_rate", "bad_bound"))
