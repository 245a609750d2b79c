"""URL rules, and trust and distrust that spread over the links between hosts.

A rule allows or blocks a host with all its subdomains, below a path. The
longest rule that fits a URL decides. Hosts of URLs that no rule fits are judged
by the links of their pages: personalised PageRank from the hosts with allowed
URLs gives trust, and the same over reversed links from the hosts with blocked
URLs gives distrust, since it is those who link to a bad host that are suspect.
A host is blocked when its distrust is above ``threshold`` times its trust plus
distrust; one that neither reaches is allowed.

Links are host pairs that differ, counted once per page. A host counts without
user, port and case, as source and as target alike. Both walks are joins
and grouped sums over the host edges, repeated until a step reaches no new
host and changes no score by more than ``tolerance`` times itself. So it does
not matter how large the corpus is or what other hosts do. The number of steps
has no limit of its own; nothing but the largest change reaches the driver.

Defined cases: a null URL or one without ``://`` has empty host and path, fits
no rule and is allowed. Null or empty html has no links. Repeated rows are
judged alike. An empty table gives an empty result. Only the named columns are
read, so extra ones cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from devmetrics.llm.staging import Workspace

DAMPING = 0.85
TOLERANCE = 1e-6
THRESHOLD = 0.5

LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


class UrlRule(NamedTuple):
    host: str
    path: str
    verdict: str


RULES = (
    UrlRule("org", "/", "allow"),
    UrlRule("example.org", "/es/", "block"),
    UrlRule("example.org", "/en/1", "block"),
    UrlRule("com", "/fr/", "allow"),
    UrlRule("com", "/de/", "block"),
)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for null or without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = lower_ascii(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_table(spark: SparkSession, rules: Sequence[UrlRule]) -> DataFrame:
    """One row per rule host with its rules, the longest first."""
    schema = "rule_host string, path string, verdict string"
    each = spark.createDataFrame([tuple(r) for r in rules], schema)
    length = (F.length("rule_host") + F.length("path")).alias("length")
    name = F.concat("rule_host", "path").alias("rule")
    return each.groupBy("rule_host").agg(F.collect_list(F.struct(length, name, "path", "verdict")).alias("rules"))


def _suffixes(host: Column) -> Column:
    """The host and every domain above it."""
    labels = F.split(host, r"\.", -1)
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."),
    )


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """Per host all rules of it and the domains above it, the longest first."""
    each = hosts.select("host", F.explode(_suffixes(F.col("host"))).alias("rule_host"))
    met = each.join(rules, "rule_host").groupBy("host").agg(F.flatten(F.collect_list("rules")).alias("rules"))
    return met.select("host", F.sort_array("rules", asc=False).alias("rules"))


def with_rule(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict``; in: host, path. Null where no rule fits."""
    hosts = pages.filter("host <> ''").groupBy("host", F.xxhash64("host").alias("_h")).count().select("host")
    met = pages.join(host_rules(hosts, rules), "host", "left")
    fits = F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"])), F.lit(0))
    return met.withColumn("best", fits).select(
        *pages.columns, F.col("best.rule").alias("rule"), F.col("best.verdict").alias("rule_verdict")
    )


def node_name(host: Column) -> Column:
    """The host as a node of the link graph: without a user before it, a port behind it, and case."""
    return lower_ascii(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", ""))


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): pages of one node that link to another; in: host, html."""
    found = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), 1)
    to = F.explode(F.array_distinct(F.transform(found, node_name))).alias("dst")
    each = pages.select(node_name(F.col("host")).alias("src"), to)
    each = each.filter("src <> '' AND dst <> '' AND dst <> src")
    return each.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def page_rank(
    edges: DataFrame,
    seeds: DataFrame,
    work: Workspace,
    name: str,
    damping: float = DAMPING,
    tolerance: float = TOLERANCE,
    max_steps: int | None = None,
) -> DataFrame:
    """(host, score) of a walk along ``edges`` that restarts in ``seeds`` (host, mass).

    Mass at hosts without links goes back to the seeds, so the scores add up to
    the mass of the seeds. What goes back restarts like everything else: it
    raises all scores by one factor, which is applied at the end. Hosts that
    the walk does not reach have no row. A
    host reached for the first time counts as changed by all of its score. The
    walk ends by itself, since what moves shrinks by ``damping`` each step;
    ``max_steps`` ends it earlier.
    """
    out = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    share = work.write(
        edges.join(out, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("share")),
        f"{name}-share",
    )
    base = seeds.select("host", ((1 - damping) * F.col("mass")).alias("score"))
    score = work.write(base, f"{name}-0")
    for step in count(1) if max_steps is None else range(1, max_steps + 1):
        moved = share.join(score, share.src == score.host).select(
            F.col("dst").alias("host"), (damping * F.col("share") * F.col("score")).alias("score")
        )
        new = base.unionByName(moved).groupBy("host").agg(F.sum("score").alias("score"))
        new = work.write(new, f"{name}-{step}")
        old = score.select("host", F.col("score").alias("old"))
        change = new.join(old, "host", "left").agg(
            F.max(F.try_divide(F.abs(F.col("score") - F.coalesce("old", F.lit(0.0))), F.col("score")))
        )
        largest = change.first()[0] or 0.0
        work.drop(f"{name}-{step - 1}")
        score = new
        if largest < tolerance:
            break
    work.drop(f"{name}-share")
    lost = F.try_divide(seeds.agg(F.sum("mass")).scalar(), score.agg(F.sum("score")).scalar())
    return score.select("host", (F.col("score") * lost).alias("score"))


def _seeds(judged: DataFrame, verdict: str, total: int) -> DataFrame:
    """Hosts with pages of this verdict, by their share of all ``total`` pages that a rule judged."""
    per = judged.filter(F.col("rule_verdict") == verdict).groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    return per.select("host", (F.col("n") / total).alias("mass"))


def host_verdicts(
    judged: DataFrame,
    edges: DataFrame,
    work: Workspace,
    threshold: float = THRESHOLD,
    **walk,
) -> DataFrame:
    """(host, trust, distrust, host_verdict) of every host that either walk reaches."""
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    total = max(1, judged.filter("rule_verdict IS NOT NULL").count())
    trust = page_rank(edges, _seeds(judged, "allow", total), work, "trust", **walk)
    distrust = page_rank(back, _seeds(judged, "block", total), work, "distrust", **walk)
    both = trust.select("host", F.col("score").alias("trust")).join(
        distrust.select("host", F.col("score").alias("distrust")), "host", "full"
    )
    both = both.na.fill(0.0, ["trust", "distrust"])
    bad = F.col("distrust") > threshold * (F.col("trust") + F.col("distrust"))
    return both.withColumn("host_verdict", F.when(bad, "block").otherwise("allow"))


def url_verdicts(
    pages: DataFrame,
    rules: Sequence[UrlRule] = RULES,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    threshold: float = THRESHOLD,
    **walk,
) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every row of ``pages``."""
    spark = pages.sparkSession
    work = Workspace(spark)
    host, path = url_parts(F.col(url))
    named = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    judged = work.write(with_rule(named, rule_table(spark, rules)), "judged")
    edges = work.write(host_links(pages.select(host.alias("host"), F.col(html).alias("html"))), "edges")
    nodes = judged.select(node_name(F.col("host")).alias("host"), "rule_verdict")
    hosts = work.write(host_verdicts(nodes, edges, work, threshold, **walk), "hosts")
    met = judged.withColumn("node", node_name(F.col("host"))).join(
        hosts.withColumnRenamed("host", "node"), "node", "left"
    )
    return met.select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", "host_verdict", F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
