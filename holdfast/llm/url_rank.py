"""URL filter: rules by host and path, and trust and distrust spread over links between hosts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.session import stage_table

#: Fixed values: (verdict, rule).
RULES = (
    ("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"),
)
DAMPING, ROUNDS, THRESHOLD = 0.85, 20, 0.5
LINK = r"(?i)\bhref\s*=\s*[\"']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#\"'\s>]+)"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _plain_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host and path of a url; both empty if it is null or has no ``://``."""
    text = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.instr(text, "://") > 0, F.substring(text, F.instr(text, "://") + 3, F.length(text)))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return _plain_lower(host), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _fits(rule: str, host: Column, path: Column) -> Column:
    name, _, start = rule.partition("/")
    return ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)


def judged_by_rules(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``pages`` (page_id, url) with host, path, rule and the rule's verdict; the longest rule wins."""
    host, path = host_and_path("url")
    split = pages.withColumn("host", host).withColumn("path", path)
    longest = sorted(rules, key=lambda r: -len(r[1]))
    first = F.coalesce(*[
        F.when(_fits(rule, F.col("host"), F.col("path")), F.struct(
            F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"),
        )) for verdict, rule in longest
    ])
    return split.withColumn("_r", first).select(
        *[c for c in pages.columns], "host", "path", F.col("_r.rule").alias("rule"),
        F.col("_r.verdict").alias("ruled"),
    )


def host_edges(pages: DataFrame, host: str = "host") -> DataFrame:
    """(src, dst, links): absolute links in ``html`` to other hosts."""
    linked = F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))))
    return (
        pages.select(F.col(host).alias("src"), linked.alias("to"))
        .select("src", _plain_lower(F.col("to")).alias("dst"))
        .filter("src != '' and dst != '' and src != dst")
        .groupBy("src", "dst").agg(F.count("*").alias("links"))
    )


def host_scores(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS,
                every: int = 5) -> DataFrame:
    """(host, trust, distrust) from ``seeds`` (host, allowed, blocked: shares of its pages) and ``edges``.

    Trust is personalised PageRank from the allowed seeds along the links; distrust runs against them
    from the blocked seeds. Both are kept in units in which a seed alone has its own share, so they compare across
    graphs of any size. Both walks go in one table; it is written to the shared folder ``every``
    rounds. Hosts that nothing reaches have no row.
    """
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "links").union(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"),
                     F.col("src").alias("dst"), "links")
    )
    out = both.groupBy("kind", "src").agg(F.sum("links").alias("_out"))
    ways = stage_table(
        both.join(out, ["kind", "src"])
        .select("kind", F.col("src").alias("host"), "dst", (F.col("links") / F.col("_out")).alias("share")), "host_edges",
    )
    start = seeds.select(F.lit("trust").alias("kind"), "host", F.col("allowed").alias("rank")).union(
        seeds.select(F.lit("distrust").alias("kind"), "host", F.col("blocked").alias("rank"))
    ).filter("rank > 0")
    base = stage_table(start, "host_seeds")
    rank = base
    for i in range(rounds if ways.take(1) else 0):
        moved = rank.join(ways, ["kind", "host"]).select(
            "kind", F.col("dst").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank")
        )
        rank = moved.union(base).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if (i + 1) % every == 0:
            rank = stage_table(rank, "host_ranks")
    value = {k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("rank"))), F.lit(0.0)).alias(k)
             for k in ("trust", "distrust")}
    return rank.groupBy("host").agg(*value.values())


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, threshold: float = THRESHOLD,
                damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust): one row for every row of ``pages`` (page_id, url, html).

    A url that a rule fits gets the rule's verdict. Others are blocked where the distrust of their host
    is more than ``threshold`` above its trust. A host's seeds are the shares of its pages that rules
    allow or block. Urls without a host and hosts that nothing reaches are allowed. Null html has no links.
    """
    ruled = judged_by_rules(pages.select("page_id", "url", "html"), rules)
    narrow = stage_table(ruled.select("page_id", "host", "path", "rule", "ruled"), "ruled_pages")
    share = {k: F.avg(F.when(F.col("ruled") == k, 1.0).otherwise(0.0)) for k in ("allow", "block")}
    seeds = narrow.filter("host != ''").groupBy("host").agg(
        share["allow"].alias("allowed"), share["block"].alias("blocked")
    )
    scores = stage_table(host_scores(seeds, host_edges(ruled), damping, rounds), "host_scores")
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust"))
    method = F.when(distrust - trust > threshold, "block").otherwise("allow")
    return narrow.join(scores, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"),
    )
