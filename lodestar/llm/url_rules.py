"""URL filters: host rules and empirical-Bayes host reputation.

``host`` is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the
end, A-Z lower-cased; ``path`` what follows up to ``?``, ``#`` or the end.
A rule (host, path) fits its host and all subdomains if the path starts with
the rule's; the longest fitting rule decides. For other pages the labelled
outcomes of the host decide: good rates are shrunk by beta-binomial priors
from suffix to registered domain to host, each level's prior mean being its
parent's posterior mean and its strength estimated by moments. A host is
blocked if the upper bound of its posterior good rate is below ``min_good``.

Defined cases: a null url or one without ``://`` has empty host and path and
belongs to the empty host; pages without a label count in no rate; several
labels of one page count once, the worst; repeated page rows are each judged
and each counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UP, _LOW), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def last_labels(host: Column, n: int) -> Column:
    return F.substring_index(host, ".", -n)


def _level(child: DataFrame, parent: DataFrame | None, key: str, up: str | None) -> DataFrame:
    """Posterior (``rate``, ``weight``) per ``key`` given rows (key, up, good,
    n) and the parent's posterior rates."""
    rows = child.groupBy(*[c for c in (key, up) if c]).agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    if parent is None:
        # weak uniform-like root: the overall rate with one pseudo-observation of either kind
        root = child.agg(((F.coalesce(F.sum("good"), F.lit(0)) + 1.0)
                          / (F.coalesce(F.sum("n"), F.lit(0)) + 2.0)).alias("mean"))
        rows = rows.crossJoin(F.broadcast(root))
    else:
        rows = rows.join(parent.select(F.col(up), F.col("rate").alias("mean")), up)
    g, n, m = F.col("good"), F.col("n"), F.col("mean")
    sums = rows.agg(F.sum(F.when(n > 0, g * g / n - 2 * g * m + n * m * m)).alias("sq"),
                    F.sum(F.when(n > 0, m * (1 - m))).alias("within"),
                    F.sum(n * m * (1 - m)).alias("room"))
    between = F.coalesce(F.col("sq") - F.col("within"), F.lit(0.0))
    strength = sums.select(F.least(F.lit(1e4), F.greatest(F.lit(1.0), F.coalesce(
        F.col("room"), F.lit(0.0)) / F.greatest(between, F.lit(1e-9)) - 1)).alias("strength"))
    rows = rows.crossJoin(F.broadcast(strength))
    total = n + F.col("strength")
    return rows.select(key, ((g + m * F.col("strength")) / total).alias("rate"), total.alias("weight"))


def reputation(hosts: DataFrame, min_good: float = 0.5, z: float = 2.0) -> DataFrame:
    """``(host, rate, bound, blocked)`` from one row ``(host, good, n)`` per
    host (good and n as doubles)."""
    h = hosts.select("host", "good", "n", last_labels(F.col("host"), 2).alias("domain"),
                     last_labels(F.col("host"), 1).alias("suffix"))
    suffix = _level(h, None, "suffix", None)
    domain = _level(h, suffix, "domain", "suffix")
    host = _level(h, domain, "host", "domain")
    r = F.col("rate")
    bound = r + z * F.sqrt(r * (1 - r) / (F.col("weight") + 1))
    return host.select("host", "rate", bound.alias("bound"), (bound < min_good).alias("blocked"))


def rules_frame(spark, rules=RULES) -> DataFrame:
    """``(rule, r_host, r_path, r_verdict)`` from ``(host/path, verdict)``."""
    rows = [(r, r.split("/", 1)[0], "/" + r.split("/", 1)[1], v) for r, v in rules]
    return spark.createDataFrame(rows, T.StructType([
        T.StructField(c, T.StringType()) for c in ("rule", "r_host", "r_path", "r_verdict")]))


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``(host, fits)``: the rules whose host is the host or a parent of it,
    longest first. Joined on the host's own suffixes, so no pair of a host and
    an unrelated rule is made."""
    labels = F.split("host", r"\.")
    tails = hosts.select("host", F.explode(F.transform(labels, lambda _, i: F.array_join(
        F.slice(labels, i + 1, F.size(labels)), "."))).alias("r_host"))
    found = tails.join(rules, "r_host")
    order = F.struct((-F.length("rule")).alias("l"), "rule", "r_path", "r_verdict")
    return found.groupBy("host").agg(F.sort_array(F.collect_set(order)).alias("fits"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: DataFrame, id_col: str = "page_id",
                url_col: str = "url", min_good: float = 0.5, z: float = 2.0) -> DataFrame:
    """``(id, host, path, rule, verdict, rate)`` for every page row.

    ``outcomes`` is ``(id, good)`` with good 1 or 0. All statistics are one
    row per host after a partial aggregation; they join back to the pages on
    the host, where a hot host is split by the skew join.
    """
    p = pages.select(F.col(id_col), F.col(url_col).alias("url"))
    p = p.select(id_col, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    o = outcomes.where(F.col("good").isNotNull()).groupBy(F.col(id_col).alias("o_id")) \
                .agg(F.min("good").cast("double").alias("good"))
    seen = p.select(F.col(id_col).alias("o_id"), "host").join(o, "o_id", "left")
    hosts = seen.groupBy("host").agg(F.coalesce(F.sum("good"), F.lit(0.0)).alias("good"),
                                     F.count("good").cast("double").alias("n"))
    table = reputation(hosts, min_good, z).join(host_rules(hosts, rules), "host", "left")
    j = p.join(table, "host", "left")
    first = F.get(F.filter("fits", lambda r: F.startswith(F.col("path"), r["r_path"])), F.lit(0))
    j = j.withColumn("fit", first)
    return j.select(id_col, "host", "path", F.col("fit")["rule"].alias("rule"),
                    F.coalesce(F.col("fit")["r_verdict"], F.when(F.col("blocked"), "block").otherwise("allow"))
                    .alias("verdict"), F.round("rate", 9).alias("host_rate"))
