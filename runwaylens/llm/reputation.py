"""URL filters: explicit rules, and an empirical-Bayes reputation of hosts for all other pages.

Each level of names is a beta-binomial with the level above as its prior: a host is drawn towards its registered
domain, the domain towards its suffix, the suffix towards all pages. How strongly is estimated from the spread of
the rates at that level. A page is blocked when even the upper bound of its host's posterior rate is low.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runwaylens.sources.scratch import Workspace

# Suffixes of two labels; others have one.
LONG_SUFFIXES = ["ac.uk", "co.jp", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "org.au", "org.uk"]
# Standard deviations of the posterior bound, and the rate of good pages that a host must be able to reach.
DEVIATIONS = 2.0
LEAST_RATE = 0.5
LEVELS = ["suffix", "domain", "host"]


def host_of(url: Column) -> Column:
    """After the first :// up to /, ? or #, A-Z lower-cased; empty for NULL and for urls without ://."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(after, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ? or #; empty for NULL and for urls without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]], part: int) -> Column:
    """Text (part 1) or verdict (part 0) of the longest rule that fits; NULL where none does.

    A rule is host/path; it fits its host and all subdomains if the path starts with /path.
    """
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, start = rule[1].partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        chosen = F.when(fits, F.lit(rule[part])).otherwise(chosen)
    return chosen


def names(host: Column) -> dict[str, Column]:
    """Suffix and registered domain of a host; a host of as few labels is its own domain."""
    labels = F.split(host, r"\.")
    two = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2)), ".")
    long = two.isin(LONG_SUFFIXES)
    three = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(1)), F.lit(3)), ".")
    return {
        "suffix": F.when(long, two).otherwise(F.element_at(labels, -1)),
        "domain": F.when(long, three).otherwise(two),
    }


def reputations(outcomes: DataFrame, hosts: DataFrame, work: Workspace) -> DataFrame:
    """(host, rate, bound): posterior mean and upper bound of the rate of good pages, for every host of ``hosts``.

    ``outcomes`` holds (host, good boolean). Hosts, domains and suffixes without outcomes have the rate of the level
    above; without any outcome at all the rate is 1/2.
    """
    told = outcomes.filter("good is not null and host is not null").groupBy("host").agg(
        F.sum(F.col("good").cast("double")).alias("g"), F.count("*").cast("double").alias("n")
    )
    every = hosts.select("host").distinct().join(told, "host", "left").na.fill(0.0, ["g", "n"])
    every = every.unionByName(told.join(hosts.select("host").distinct(), "host", "left_anti"))
    every = work.save(every.withColumns(names(F.col("host"))), "hosts")
    total = every.agg(F.sum("g"), F.sum("n")).first()
    rate = (total[0] + 0.5) / (total[1] + 1) if total[1] else 0.5
    above: DataFrame | None = None
    for level in LEVELS:
        keys = LEVELS[: LEVELS.index(level) + 1]
        here = every.groupBy(*keys).agg(F.sum("g").alias("g"), F.sum("n").alias("n"))
        if above is None:
            here = here.withColumn("prior", F.lit(float(rate)))
        else:
            here = here.join(above, keys[:-1])
        here = work.save(here, f"level-{level}")
        strength = _strength(here)
        mean = (F.col("g") + F.col("prior") * strength) / (F.col("n") + strength)
        above = here.select(*keys, mean.alias("prior"), (F.col("n") + strength).alias("mass"))
        last = above
        above = above.drop("mass")
    deviation = F.sqrt(F.col("prior") * (1 - F.col("prior")) / (F.col("mass") + 1))
    return last.select("host", F.col("prior").alias("rate"), (F.col("prior") + deviation * DEVIATIONS).alias("bound"))


def _strength(level: DataFrame) -> float:
    """Pseudo-observations of the prior, by moments of the rates around their priors; 1 to 10,000."""
    some = level.filter("n > 0").withColumn("p", F.col("g") / F.col("n"))
    x = some.agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("n") * F.pow(F.col("p") - F.col("prior"), 2)).alias("spread"),
        F.sum(F.col("prior") * (1 - F.col("prior"))).alias("noise"),
        F.sum(F.col("n") * F.col("prior") * (1 - F.col("prior"))).alias("v"),
    ).first()
    if not x.n:
        return 1.0
    within = x.v / x.n
    between = (x.spread - x.noise) / x.n
    if between <= 0:
        return 10_000.0
    return min(10_000.0, max(1.0, within / between - 1))


def judge(pages: DataFrame, rules: list[tuple[str, str]], outcomes: DataFrame | None = None) -> DataFrame:
    """Every row and column of ``pages`` (with ``url``) with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` is a short list of (allow or block, host/path). A page that some rule fits has the verdict of the
    longest. Other pages have the verdict of their host's reputation: ``block`` if the upper bound of its posterior
    rate is below LEAST_RATE, else ``allow``. The labelled outcomes are ``outcomes`` (host, good), by default the
    pages that rules decide. Urls that are NULL or have no :// have an empty host, which has a reputation like any
    other. Repeated pages count as often as they are there. Columns of these names are replaced.
    """
    spark = pages.sparkSession
    plain = pages.drop("host", "path", "rule", "verdict")
    split = plain.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    ruled = split.withColumns(
        {
            "rule": rule_of(F.col("host"), F.col("path"), rules, 1),
            "__told": rule_of(F.col("host"), F.col("path"), rules, 0),
        }
    )
    with Workspace(spark, "reputation") as work:
        slim = work.save(ruled.select("host", "__told"), "slim")
        told = slim.filter("__told is not null").select("host", (F.col("__told") == "allow").alias("good"))
        known = reputations(told if outcomes is None else outcomes, slim, work)
        bounds = work.save(known.select(F.col("host").alias("__host"), (F.col("bound") < LEAST_RATE).alias("__low")), "bounds")
        work.keep("bounds")
    open_pages = ruled.filter("__told is null").join(bounds, F.col("host") == F.col("__host"), "left")
    verdict = F.when(F.coalesce("__low", F.lit(False)), "block").otherwise("allow")
    told = ruled.filter("__told is not null").withColumn("verdict", F.col("__told"))
    judged = open_pages.withColumn("verdict", verdict).drop("__host", "__low")
    return told.unionByName(judged).drop("__told")
