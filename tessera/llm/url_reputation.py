"""URL filter: path rules first, then an empirical-Bayes reputation of hosts.

Labelled pages vote on their host: good (``quality = 1`` and ``toxic = 0``) or
bad.  Bad shares are shrunk in three steps of beta-binomial priors: suffixes
(last label) towards the whole, registered domains towards their suffix, hosts
towards their domain.  A child with ``bad`` of ``n`` outcomes and its parent's
mean ``m`` has the posterior ``Beta(bad + k*m, n - bad + k*(1 - m))``.  The
prior weight ``k`` of a level is estimated from its units by the method of
moments and kept within ``K_RANGE``.  A host is blocked if the lower bound of
its bad share (posterior mean less ``Z`` standard deviations) is at least
``BLOCK_SHARE``: the labels must be bad, and there must be enough of them.

Hosts without labelled pages get their domain's, suffix's or the whole's
posterior.  Reputations are tables of one row for each host, domain and suffix,
made by map-side aggregates; pages meet them in equi-joins, in which Spark
splits a hot host's pages (adaptive skew join).

Rules ``(action, host, path)`` fit their host and all subdomains, if the
url's path starts with the rule's path; the longest fitting rule wins
(length of host, then of path).  The rule decides before the reputation.

Defined cases: a null url, or one without ``://``, has empty host and path; no
rule fits and the verdict is the whole's.  Labels with a null id or a null
quality are ignored; null toxic counts as 0; a repeated label or page row
counts as often as it is there.  No labels at all: every page is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Suffixes of two labels under which names are registered.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in")
MAX_SUFFIX_LABELS = 5
BLOCK_SHARE, Z, K_RANGE = 0.5, 1.645, (2.0, 200.0)


def parsed(url: Column) -> Column:
    """Struct ``host, path`` of a url."""
    found = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    lower = F.translate(F.regexp_extract(url, found, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    has = F.coalesce(url.contains("://"), F.lit(False))
    return F.struct(F.when(has, lower).otherwise("").alias("host"), F.when(has, F.regexp_extract(url, found, 2)).otherwise("").alias("path"))


def without_port(host: Column) -> Column:
    return F.regexp_replace(host, ":[0-9]*$", "")


def with_domains(hosts: DataFrame, suffixes: DataFrame | tuple[str, ...] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """Adds ``domain`` and ``suffix`` to rows with ``host`` (ports left out): the
    longest of ``suffixes`` that the host ends in, else its last label, and that
    with one label more.  ``suffixes`` is a table ``suffix`` of any length, such as
    a public list, which is joined; or a few names of two labels."""
    bare = without_port(F.col("host"))
    if isinstance(suffixes, tuple):
        two, known = F.substring_index(bare, ".", -2), F.substring_index(bare, ".", -2).isin(*suffixes)
        return hosts.withColumns({"domain": F.when(known, F.substring_index(bare, ".", -3)).otherwise(two),
                                  "suffix": F.when(known, two).otherwise(F.substring_index(bare, ".", -1))})
    listed = suffixes.select(F.lower(F.trim("suffix")).alias("_end")).filter("_end <> ''").distinct()
    ends = hosts.select("host", F.explode(F.expr(f"sequence(1, least(size(split(host, '[.]')), {MAX_SUFFIX_LABELS}))")).alias("_k"), bare.alias("_bare"))
    longest = ends.withColumn("_end", F.expr("substring_index(_bare, '.', -_k)")).join(listed, "_end").groupBy("host").agg(F.max("_k").alias("_k"))
    k = "coalesce(_k, 1)"
    return hosts.join(longest, "host", "left").withColumn("_bare", bare).withColumns(
        {"domain": F.expr(f"substring_index(_bare, '.', -({k}) - 1)"), "suffix": F.expr(f"substring_index(_bare, '.', -({k}))")}).drop("_k", "_bare")


def rule_struct(host: Column, path: Column, rules=RULES) -> Column:
    """Struct ``rule, action`` of the longest rule that fits, else null."""
    ranked = sorted(rules, key=lambda r: (-len(r[1]), -len(r[2])))
    whens = [((host == h) | host.endswith(f".{h}")) & path.startswith(p) for _, h, p in ranked]
    values = [F.struct(F.lit(h + p).alias("rule"), F.lit(a).alias("action")) for a, h, p in ranked]
    return F.coalesce(*[F.when(w, v) for w, v in zip(whens, values, strict=True)]) if ranked else F.lit(None).cast("struct<rule: string, action: string>")


def _prior_weight(units: DataFrame) -> DataFrame:
    """One row ``k``: the method of moments over units ``n, bad, m`` (``m``: the
    parent's mean).  Between-unit variance is what the units' weighted squared
    deviations hold beyond sampling noise."""
    noise = F.col("m") * (1 - F.col("m"))
    s = units.agg(
        F.sum(F.col("n")).alias("w"), F.sum(F.col("n") * noise).alias("wv"), F.count("*").alias("units"),
        F.sum(F.pow(F.col("bad") - F.col("n") * F.col("m"), 2) / F.col("n")).alias("ss"), F.sum(noise).alias("v"),
    )
    # E[ss] = v + rho * (wv - v), rho = 1 / (k + 1)
    rho = (F.col("ss") - F.col("v")) / F.nullif(F.col("wv") - F.col("v"), F.lit(0.0))
    k = F.when(rho <= 0, F.lit(K_RANGE[1])).otherwise(F.least(F.greatest(1 / rho - 1, F.lit(K_RANGE[0])), F.lit(K_RANGE[1])))
    return s.select(F.coalesce(k, F.lit(K_RANGE[1])).alias("k"))


def reputation(pages: DataFrame, labels: DataFrame, suffixes: DataFrame | tuple[str, ...] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """``host, n, bad, mean, bound`` for each host of ``pages``."""
    outcome = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).select(
        F.col("doc_id").cast("long").alias("page_id"),
        F.when((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0), 0).otherwise(1).alias("bad"),
    ).groupBy("page_id").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    seen = pages.select(F.col("page_id").cast("long").alias("page_id"), parsed(F.col("url")).host.alias("host"))
    hosts = seen.join(outcome, "page_id", "left").groupBy("host").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"),
    )
    hosts = with_domains(hosts, suffixes)

    whole = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).select(
        F.coalesce((F.col("bad") + 1) / (F.col("n") + 2), F.lit(0.5)).alias("m"), (F.col("n") > 0).alias("any"))
    m = whole.select("m").scalar()

    def shrunk(units: DataFrame, mean: str) -> DataFrame:
        """Adds ``mean`` and replaces ``m`` and ``k`` (the level's prior)."""
        k = _prior_weight(units.filter("n > 0")).scalar()
        return units.withColumn("k", k).withColumn(mean, (F.col("bad") + F.col("k") * F.col("m")) / (F.col("n") + F.col("k")))

    suffixes = shrunk(hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn("m", m), "suffix_mean")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = domains.join(suffixes.select("suffix", F.col("suffix_mean").alias("m")), "suffix")
    domains = shrunk(domains, "domain_mean")
    units = hosts.join(domains.select("domain", F.col("domain_mean").alias("m")), "domain")
    units = shrunk(units, "mean")
    total = F.col("n") + F.col("k")
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (total + 1))
    return units.withColumn("any", whole.select("any").scalar()).select(
        "host", "n", "bad", "mean", F.when(F.col("any"), F.col("mean") - F.lit(Z) * sd).otherwise(F.lit(0.0)).alias("bound"))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, block_share: float = BLOCK_SHARE,
          suffixes: DataFrame | tuple[str, ...] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """``page_id, host, path, rule, verdict, bound`` for each row of ``pages``."""
    known = pages.select("page_id", parsed(F.col("url")).alias("u")).select("page_id", "u.host", "u.path")
    ruled = known.withColumn("r", rule_struct(F.col("host"), F.col("path"), rules))
    scored = ruled.join(reputation(pages, labels, suffixes).select("host", "bound"), "host", "left")
    verdict = F.coalesce(F.col("r.action"), F.when(F.col("bound") >= block_share, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"), "bound")
