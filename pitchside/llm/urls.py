"""URL filters: rules decide what they fit, and trust spread over the links between hosts decides the rest.

A rule ``(verdict, host, path)`` fits its host and all subdomains where the url's path starts with
the rule's path; the longest fitting rule (host and path together, block before allow on a tie)
wins.  For the pages that no rule fits, hosts are scored by personalised PageRank:

* seeds are the hosts of which rules decide at least half of the pages, trusted if they allow more
  of them than they block, blocked if they block more;
* trust starts at trusted seeds and follows links, distrust starts at blocked seeds and follows
  links backwards (who links to a blocked host is suspect); every step passes ``damping`` of a
  host's score on, split over its links by their number of pages;
* a host is blocked where distrust is positive and at least ``threshold`` times its trust.

Both scores live in one table and one join per step.  Links are counted per pair of hosts
before anything is shuffled by host, so a host with a third of all pages or links costs one row per
linked host; AQE splits a skewed host in the join.  Iteration stops when no score moves by more than ``tolerance`` in
sum; as every step shrinks what moves to ``damping`` of it, that takes a number of steps known before, which is
the bound unless ``max_steps`` sets another.

Cases: a null url or one without ``://`` has an empty host and path, takes no part in the graph
and is allowed; null html has no links; repeated pages count once each; hosts without seeds in
reach have no score and are allowed; empty input gives empty output; other columns travel along
unless they bear the name of an added column, which is then replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, cut, table, unused

#: The rules of the registered query.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
ADDED = ("host", "path", "rule", "verdict")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(url.contains("://"), F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """``(verdict, rule)`` of the longest rule that fits, else null."""
    out = None
    for verdict, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block")):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        value = F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return F.lit(None).cast("struct<verdict:string,rule:string>") if out is None else out


def host_links(pages: DataFrame) -> DataFrame:
    """``(src, dst, n)``: on how many pages of ``src`` a link leads to the other host ``dst``."""
    found = F.array_distinct(F.transform(
        F.regexp_extract_all("html", F.lit(r"""(?i)href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*+:)?//([^/?#"'\s<>]++)"""), F.lit(1)),
        lambda h: F.translate(h, _UPPER, _LOWER)))
    links = pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(found).alias("dst"))
    return links.where("src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def host_scores(seeds: DataFrame, links: DataFrame, damping: float = 0.85, tolerance: float = 1e-6,
                max_steps: int | None = None) -> DataFrame:
    """``(host, trust, distrust)`` from ``(host, side)`` seeds, side 0 trusted and 1 blocked.

    ``trust`` of all trusted seeds sums to 1 at the start, and so does ``distrust`` of the blocked.
    """
    if max_steps is None:  # the two sides' first change is at most 4 * damping
        max_steps = max(1, math.ceil(math.log(tolerance / 4) / math.log(damping))) + 1
    per = seeds.groupBy("side").agg(F.count("*").alias("_n"))
    start = cut(seeds.join(F.broadcast(per), "side").select("host", "side", (1 / F.col("_n")).alias("seed")))  # two rows
    ways = links.selectExpr("src as f", "dst as t", "n", "0 as side").union(links.selectExpr("dst as f", "src as t", "n", "1 as side"))
    out = ways.groupBy("f", "side").agg(F.sum("n").alias("_sum"))
    ways = cut(ways.join(out, ["f", "side"]).select("f", "t", "side", (F.col("n") / F.col("_sum")).alias("w")))
    now = start.select("host", "side", F.col("seed").alias("score"))
    for _ in range(max_steps):
        passed = (now.join(ways, (now["host"] == ways["f"]) & (now["side"] == ways["side"]))
                  .select(F.col("t").alias("host"), ways["side"], (damping * F.col("score") * F.col("w")).alias("score")))
        following = (start.select("host", "side", ((1 - damping) * F.col("seed")).alias("score")).union(passed)
                     .groupBy("host", "side").agg(F.sum("score").alias("score")))
        both = cut(following.join(now.withColumnRenamed("score", "old"), ["host", "side"], "full")
                   .selectExpr("host", "side", "coalesce(score, 0D) as score", "coalesce(old, 0D) as old"))
        now = both.select("host", "side", "score")
        if (both.agg(F.sum(F.abs(F.col("score") - F.col("old")))).first()[0] or 0.0) <= tolerance:
            break
    return now.groupBy("host").agg(F.sum(F.when(F.col("side") == 0, F.col("score")).otherwise(0.0)).alias("trust"),
                                   F.sum(F.when(F.col("side") == 1, F.col("score")).otherwise(0.0)).alias("distrust"))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, threshold: float = 1.0,
               **rank) -> DataFrame:
    """The pages with ``host, path, rule, verdict``."""
    host, path = host_and_path(F.col("url"))
    pages = pages.drop(*ADDED)
    decided, bad, salt = unused(pages, "_rule", "_host", "_salt")
    judged = pages.withColumns({"host": host, "path": path})
    judged = judged.withColumn(decided, rule_of(F.col("host"), F.col("path"), rules))
    hosts = judged.where("host <> ''").groupBy("host").agg(
        F.count("*").alias("n"), F.count_if(F.col(f"{decided}.verdict") == "allow").alias("allowed"),
        F.count_if(F.col(f"{decided}.verdict") == "block").alias("blocked"))
    seeds = hosts.where("2 * (allowed + blocked) >= n and allowed <> blocked").selectExpr(
        "host", "if(allowed > blocked, 0, 1) as side")
    scores = host_scores(seeds, cut(host_links(judged)), **rank)
    blocked = (scores.where((F.col("distrust") > 0) & (F.col("distrust") >= threshold * F.col("trust")))
               .select(F.col("host").alias(bad), F.explode(F.sequence(F.lit(0), F.lit(63))).alias(salt)))
    # a host may hold a third of all pages: its pages are spread over the salts
    judged = judged.withColumn(salt, F.pmod(F.xxhash64("url"), F.lit(64)).cast("int"))
    judged = judged.join(blocked, (judged["host"] == blocked[bad]) & (judged[salt] == blocked[salt]), "left")
    method = F.when(F.col(bad).isNotNull(), "block").otherwise("allow")
    return judged.select(*[column(c) for c in pages.columns], "host", "path", F.col(f"{decided}.rule").alias("rule"),
                         F.coalesce(f"{decided}.verdict", method).alias("verdict"))


def op10_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages", "page_id", "url", "html")).select(
        "page_id", "host", "path", "rule", "verdict")
