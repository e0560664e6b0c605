"""URL filter by rules and by the reputation of hosts.

Labelled pages are outcomes: bad when their label says low quality or toxic. Beta-binomial
priors pass them down: all pages to a suffix, a suffix to its registered domains, a domain to
its hosts. How strongly a level keeps to its parent is estimated from the level itself, by the
spread of its children's rates beyond that of binomial draws (method of moments). A host with
few labels thus leans on its domain. A host is blocked when even the lower bound of its bad
rate is above `max_bad`; without evidence it is allowed.

Rules go before the method. They are matched per distinct host, not per page: a host's suffixes
are joined with the rules' hosts, and pages get both reputation and rules by one join on host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gondola.sources.shared import materialize

RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
)
# Public suffixes of two labels that are known here; any other suffix is the last label.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "co.nz", "com.br", "co.in")
# Share of the parent in a level whose labels say nothing about the spread, as a correlation.
DEFAULT_RHO = 0.1
RHO_RANGE = (0.001, 0.5)
# One-sided 95 % bound of a normal approximation to the posterior.
Z = 1.645
MAX_BAD = 0.5


def _ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_url_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path; both empty for a null url or one without `://`."""
    full = F.coalesce(F.col(url).cast("string"), F.lit(""))
    at = F.locate("://", full)
    rest = F.when(at > 0, F.substring(full, at + 3, F.length(full))).otherwise("")
    return pages.withColumns(
        {
            "host": _ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)),
            "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
        }
    )


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """The registered domain: the suffix and one label before it, where there is one."""
    two, three = F.substring_index(host, ".", -2), F.substring_index(host, ".", -3)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), three).otherwise(two)


def outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Per host of the pages: n, its labelled pages, and y, the bad ones. A page's label is
    that of the same id; several labels of one id count once, bad if any says so."""
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    by_id = (
        labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("page_id"))
        .agg(F.max(F.coalesce(bad, F.lit(False)).cast("long")).alias("bad"))
    )
    return (
        pages.select("page_id", "host").join(by_id, "page_id", "left").groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("y"))
    )


def _strength(level: DataFrame) -> float:
    """How many labels the parent's rate is worth at this level: 1 / rho - 1."""
    n, y, m = F.col("n"), F.col("y"), F.col("m")
    row = level.where("n > 0").agg(
        F.sum((y - n * m) ** 2 / (m * (1 - m))), F.sum(n), F.sum(n * (n - 1))
    ).first()
    spread, total, pairs = (float(x or 0) for x in row)
    rho = (spread - total) / pairs if pairs else DEFAULT_RHO
    return 1 / min(max(rho, RHO_RANGE[0]), RHO_RANGE[1]) - 1


def _posterior(level: DataFrame, strength: float) -> DataFrame:
    """Adds p, the posterior mean under a prior of that strength around m."""
    return level.withColumn("p", (F.col("y") + strength * F.col("m")) / (F.col("n") + strength))


def reputations(hosts: DataFrame) -> DataFrame:
    """Per host: n_labels, n_bad, bad_mean, bad_bound (the lower bound of its bad rate). An
    action: the strength of each level is one number read by the driver."""
    hosts = hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    total = hosts.agg(F.sum("n"), F.sum("y")).first()
    n, y = (int(x or 0) for x in total)
    m = (y + 0.5) / (n + 1)
    counts = [F.sum("n").alias("n"), F.sum("y").alias("y")]
    domains = hosts.groupBy("domain", "suffix").agg(*counts)
    suffixes = domains.groupBy("suffix").agg(*counts).withColumn("m", F.lit(m))
    suffixes = _posterior(suffixes, _strength(suffixes))
    domains = domains.join(suffixes.select("suffix", F.col("p").alias("m")), "suffix")
    domains = _posterior(domains, _strength(domains))
    hosts = hosts.join(domains.select("domain", "suffix", F.col("p").alias("m")), ["domain", "suffix"])
    strength = _strength(hosts)
    p, weight = F.col("p"), F.col("n") + strength
    bound = p - Z * F.sqrt(p * (1 - p) / (weight + 1))
    return _posterior(hosts, strength).select(
        "host", F.col("n").alias("n_labels"), F.col("y").alias("n_bad"),
        F.round(p, 6).alias("bad_mean"), F.round(bound, 6).alias("bad_bound"),
    )


def rules_by_host(hosts: DataFrame, rules) -> DataFrame:
    """Per host that any rule's host fits: its rules as (length, path, rule, verdict)."""
    spark = hosts.sparkSession
    rows = [(rule.partition("/")[0], "/" + rule.partition("/")[2], rule, verdict, len(rule)) for verdict, rule in rules]
    table = spark.createDataFrame(rows, "rule_host string, rule_path string, rule string, rule_verdict string, size int")
    labels = F.split("host", r"\.", -1)
    ends = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, -k, k), ".")
    )
    return (
        hosts.select("host", F.explode(ends).alias("rule_host")).join(table, "rule_host")
        .groupBy("host").agg(F.collect_list(F.struct("size", "rule", "rule_path", "rule_verdict")).alias("rules"))
    )


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, max_bad: float = MAX_BAD) -> DataFrame:
    """The pages with host, path, rule (null where none fits), verdict and the host's
    reputation. Columns of the pages with these names are replaced.

    The longest fitting rule wins, the first in order of text on a tie. A url without a host
    is judged as the host ''. Repeated pages are each an outcome; ids that are null have no
    label; without any label every host has the prior rate of one half and is allowed. An
    action: per-host counts are written to the shared folder."""
    made = ("n_labels", "n_bad", "bad_mean", "bad_bound", "rules", "rule", "verdict")
    pages = with_url_parts(pages.drop(*made))
    counted = materialize(outcomes(pages, labels), "host-outcomes")
    known = reputations(counted).join(rules_by_host(counted.select("host"), rules), "host", "left")
    fits = F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"]))
    best = F.array_min(F.transform(fits, lambda r: F.struct(-r["size"], r["rule"], r["rule_verdict"].alias("v"))))
    return (
        pages.join(known, "host")
        .withColumn("_best", best)
        .withColumns(
            {
                "rule": F.col("_best.rule"),
                "verdict": F.coalesce(
                    F.col("_best.v"),
                    F.when(F.col("bad_bound") > max_bad, "block").otherwise("allow"),
                ),
            }
        )
        .drop("_best", "rules")
    )
