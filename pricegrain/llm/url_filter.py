"""Operator 6: URL filters by rules and link-graph propagation. DataFrame and SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricegrain.llm.common import materialize

#: Verdict, host, path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
#: Share of a node's score that follows its edges, rounds, and the share of distrust from which a host is blocked.
DAMPING, ROUNDS, BLOCK_FROM = 0.85, 12, 0.5
#: Weight of the edge between a host and the domain above it, in links.
PARENT_LINKS = 1.0


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_fits(host: Column, path: Column, rule: tuple[str, str, str]) -> Column:
    _, rule_host, rule_path = rule
    return ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null where none does."""
    ordered = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    pick = lambda value: F.coalesce(*[F.when(rule_fits(host, path, r), F.lit(value(r))) for r in ordered], F.lit(None).cast("string"))
    return pick(lambda r: r[1] + r[2]), pick(lambda r: r[0])


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """src, dst, links between different hosts: absolute links in the HTML, and a host with the domain above it."""
    links = (
        pages.select(host_of(F.col("url")).alias("src"), F.explode(F.regexp_extract_all(F.col("html"), F.lit(r"""(?i)(?:href|src)\s*=\s*["']?(https?://[^"'\s>]+)"""), 1)).alias("link"))
        .select("src", host_of(F.col("link")).alias("dst"), F.lit(1.0).alias("links"))
        .filter((F.col("src") != F.col("dst")) & (F.col("src") != "") & (F.col("dst") != ""))
    )
    labels = F.split("host", r"\.")
    chains = hosts.select(F.explode(F.transform(F.sequence(F.lit(0), F.greatest(F.size(labels) - 2, F.lit(0))), lambda i: F.struct(F.array_join(F.slice(labels, i + 1, F.size(labels)), ".").alias("child"), F.array_join(F.slice(labels, i + 2, F.size(labels)), ".").alias("above")))).alias("c")).select("c.*")
    above = chains.filter(F.size(F.split("above", r"\.")) >= 2).distinct()
    ties = above.select(F.explode(F.array(F.struct(F.col("child").alias("src"), F.col("above").alias("dst")), F.struct(F.col("above").alias("src"), F.col("child").alias("dst")))).alias("e")).select("e.src", "e.dst", F.lit(PARENT_LINKS).alias("links"))
    return links.unionByName(ties).groupBy("src", "dst").agg(F.sum("links").alias("links"))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Personalised PageRank of every (kind, host): trust along edges, distrust against them.

    ``seeds`` has kind, host, share, the shares of a kind summing to 1. What reaches a host without edges
    of that kind is lost, which leaves all ratios on one host as they are.
    """
    directed = edges.select(F.lit("trust").alias("kind"), "src", "dst", "links").unionByName(edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links"))
    out = directed.groupBy("kind", "src").agg(F.sum("links").alias("all_links"))
    steps = materialize(directed.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.lit(DAMPING) * F.col("links") / F.col("all_links")).alias("step")), "steps")
    start = materialize(seeds.select("kind", "host", ((1 - F.lit(DAMPING)) * F.col("share")).alias("score")), "seeds")
    scores = start
    for r in range(rounds):
        moved = scores.withColumnRenamed("host", "src").join(steps, ["kind", "src"]).select("kind", F.col("dst").alias("host"), (F.col("score") * F.col("step")).alias("score"))
        scores = moved.unionByName(start).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if r % 4 == 3:
            scores = materialize(scores, "scores")
    return scores


def judge_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """Rule and verdict of each page's url.

    Returns page_id, host, path, rule, verdict, trust, distrust. The longest rule that fits decides. Other
    pages follow their host: trust starts from hosts with pages that a rule allows, distrust from hosts with
    pages that a rule blocks, each by number of pages; both spread over the host graph, and a host is
    blocked where distrust is more than half of both. Hosts that neither reaches are allowed, as are urls
    that are null or have no ``://`` (empty host and path). Null html has no links; repeated rows stay.
    """
    url, html = F.col("url").cast("string"), F.col("html").cast("string")
    judged = pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    judged = judged.withColumns({"rule": rule, "by_rule": verdict})
    per_host = materialize(judged.groupBy("host").agg(F.count_if(F.col("by_rule") == "allow").alias("trust"), F.count_if(F.col("by_rule") == "block").alias("distrust")).filter(F.col("host") != ""), "hosts")
    edges = host_edges(pages.select(url.alias("url"), html.alias("html")), per_host)
    marks = per_host.select("host", F.explode(F.create_map(F.lit("trust"), "trust", F.lit("distrust"), "distrust")).alias("kind", "n")).filter("n > 0")
    sums = marks.groupBy("kind").agg(F.sum("n").alias("all"))
    scores = propagate(edges, marks.join(sums, "kind").select("kind", "host", (F.col("n") / F.col("all")).alias("share")))
    one = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)).alias(kind)
    hosts = materialize(scores.groupBy("host").agg(one("trust"), one("distrust")), "host-scores")
    by_host = F.when(F.col("distrust") > BLOCK_FROM * (F.col("trust") + F.col("distrust")), "block").otherwise("allow")
    return judged.join(hosts, "host", "left").select("page_id", "host", "path", "rule", F.coalesce("by_rule", by_host).alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
