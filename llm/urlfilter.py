"""URL filters: rules by host and path, and trust that spreads over links between hosts.

A rule judges the urls of its host and subdomains whose path starts with the
rule's; the longest wins. Where no rule fits, the host's standing decides.
Trust flows from hosts with allowed pages along links (personalised PageRank),
distrust from hosts with blocked pages against them: who links to a blocked host
is suspect. Links are those in the pages, and those between a host and the
domain it belongs to. A host is blocked when its distrust exceeds its trust by
more than a threshold times the mean score of a host.

Edges are counted per task before they are shuffled; both flows take one join
and one aggregation a step, over tables as large as the host graph.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import ascii_lower, staged

#: (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Characters of a host name, at most.
NAME_LENGTH = 253
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)(?:href|src|action)\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class Settings:
    """steps: PageRank rounds. damping: share of a score that moves on. threshold: in mean scores.
    domain_links: weight of a link between a host and its domain, in page links (0: none)."""

    steps: int = 10
    damping: float = 0.85
    threshold: float = 0.25
    domain_links: float = 1.0


def host_of(url: Column) -> Column:
    """What follows the first ://, up to /, ?, # or the end, A-Z in lower case; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ?, # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def labels(host: Column) -> Column:
    """How many parts between dots a host has."""
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def domain(host: Column, k: Column) -> Column:
    """The last k labels of a host that has so many."""
    return F.call_function("substring_index", host, F.lit("."), -k)


def host_rules(hosts: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(host, rules): the rules that may fit a host's urls, the longest first; of equally long ones the longer host."""
    spark = hosts.sparkSession
    table = spark.createDataFrame(
        [(h, p, h + p, v) for v, h, p in rules], "domain string, rule_path string, rule string, rule_verdict string"
    )
    host = F.col("host")
    deepest = max((h.count(".") + 1 for _, h, _ in rules), default=1)  # longer domains have no rule
    ends = F.transform(F.sequence(F.lit(1), F.least(labels(host), F.lit(deepest))), lambda k: domain(host, k))
    each = hosts.select("host", F.explode(ends).alias("domain")).join(table, "domain")
    order = F.struct(
        (-F.length("rule")).alias("shorter"),
        (-F.length("domain")).alias("wider"),
        F.col("rule_path").alias("path"),
        F.col("rule").alias("rule"),
        F.col("rule_verdict").alias("verdict"),
    )
    return each.groupBy("host").agg(F.sort_array(F.collect_list(order)).alias("rules"))  # no more than there are rules


def links(pages: DataFrame, hosts: DataFrame, domain_links: float) -> DataFrame:
    """(src, dst, n): links between different hosts, with (host, html) of pages and (host) of hosts.

    Hosts of links, like those of pages, have A-Z in lower case and no other letter
    changed. A host longer than any name can be (NAME_LENGTH) is linked with no domain.
    """
    found = F.transform(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1)), ascii_lower)
    written = pages.filter("host != '' AND html IS NOT NULL").select(F.col("host").alias("src"), F.explode(found).alias("dst"))
    written = written.filter("src != dst").groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("n"))
    if not domain_links:
        return written
    host = F.col("host")
    deep = hosts.select("host").filter((F.length("host") <= NAME_LENGTH) & (labels(host) > 2))
    steps = F.transform(F.sequence(F.lit(2), labels(host) - 1), lambda k: F.struct(domain(host, k + 1).alias("low"), domain(host, k).alias("high")))
    pairs = deep.select(F.explode(steps).alias("s")).select("s.low", "s.high").distinct()
    owned = pairs.select(F.col("low").alias("src"), F.col("high").alias("dst"), F.lit(domain_links).alias("n"))
    owning = pairs.select(F.col("high").alias("src"), F.col("low").alias("dst"), F.lit(domain_links).alias("n"))
    return written.unionByName(owned).unionByName(owning).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def spread(edges: DataFrame, seeds: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(flow, host, score) after ``steps`` rounds; seeds (flow, host, share) add up to 1 in each flow.

    flow is ``trust``, along links, or ``distrust``, against them. What reaches a
    host without a way on ends there.
    """
    both = edges.select(F.lit("trust").alias("flow"), F.col("src").alias("host"), F.col("dst").alias("to"), "n").unionByName(
        edges.select(F.lit("distrust").alias("flow"), F.col("dst").alias("host"), F.col("src").alias("to"), "n")
    )
    both = staged(both, "links")
    totals = staged(both.groupBy("flow", "host").agg(F.sum("n").alias("all")), "link-totals")
    shares = both.join(totals, ["flow", "host"]).select("flow", "host", "to", (F.col("n") / F.col("all")).alias("share"))
    shares = staged(shares, "link-shares")
    start = staged(seeds.select("flow", "host", ((1 - s.damping) * F.col("share")).alias("score")), "seeds")
    scores = start
    for _ in range(s.steps):
        moved = scores.join(shares, ["flow", "host"]).select(
            "flow", F.col("to").alias("host"), (s.damping * F.col("score") * F.col("share")).alias("score")
        )
        scores = staged(moved.unionByName(start).groupBy("flow", "host").agg(F.sum("score").alias("score")), "scores")
    return scores


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, s: Settings = Settings()) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, trust, distrust.

    ``verdict`` is the rule's, or without a rule its host's. Null urls and those
    without :// have an empty host and path, which no rule fits and no link
    reaches; they are allowed, like hosts that neither flow reaches. Rules fit hosts
    of any length and any number of labels; for links with domains see ``links``.
    Missing html has no links. Repeated rows each give a row. An empty table gives no rows.
    """
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    hosts = staged(parsed.groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "hosts")
    fitting = staged(host_rules(hosts.filter("host != ''"), rules), "host-rules")
    judged = parsed.select("page_id", "host", "path").join(fitting, "host", "left")
    fits = F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"]))
    judged = judged.withColumn("found", F.when(F.size(fits) > 0, fits[0]))
    judged = staged(judged.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("by_rule")), "by-rule")

    flow = F.when(F.col("by_rule") == "allow", "trust").otherwise("distrust").alias("flow")
    counted = judged.filter("by_rule IS NOT NULL").groupBy(flow, "host").agg(F.count(F.lit(1)).alias("n"))
    counted = staged(counted, "seed-pages")
    all_seeds = counted.groupBy("flow").agg(F.sum("n").alias("all"))  # two rows
    seeds = counted.join(F.broadcast(all_seeds), "flow").select("flow", "host", (F.col("n") / F.col("all")).alias("share"))
    scores = spread(links(parsed, hosts.filter("host != ''"), s.domain_links), seeds, s)

    mean = 1.0 / max(1, hosts.count())
    score = lambda f: F.coalesce(F.sum(F.when(F.col("flow") == f, F.col("score"))), F.lit(0.0))
    standing = staged(scores.groupBy("host").agg(score("trust").alias("trust"), score("distrust").alias("distrust")), "standing")
    bad = F.coalesce(F.col("distrust") - F.col("trust") > s.threshold * mean, F.lit(False))
    by_host = F.when(bad, "block").otherwise("allow")
    return judged.join(standing, "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("by_rule", by_host).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
