"""URL filter: rules where one fits, else trust and distrust carried over the host link graph.

Hosts that rules allow are trusted seeds, hosts that rules block are distrusted ones, each with the share
of its pages that the rules judge so. Trust is a personalised PageRank from the trusted seeds along the
links; distrust is one from the blocked seeds against them, so a host that links to bad hosts takes a part
of their distrust. Both run as rounds of joins and grouped sums over the distinct host edges. A host is
blocked where its distrust reaches the threshold and is more than its trust.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursematch.llm.common import Store

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: An absolute or scheme-relative link; its host is the first group.
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s<>]+)"""
DAMPING = 0.85
#: After 60 rounds 6e-5 of a seed's mass is still on its way.
ROUNDS = 60
#: Ranks are compared with 6 decimals; rounds that change none by more than this end early.
SETTLED = 1e-8
EVERY = 5


class Rule(NamedTuple):
    """Judges the urls of ``host`` and its subdomains whose path starts with ``path``."""

    host: str
    path: str
    verdict: str


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url. The host stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end,
    A-Z in lower case; the path after it up to ``?``, ``#`` or the end. Null or without ``://``: both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.substring_index(F.substring_index(F.substring_index(rest, "/", 1), "?", 1), "#", 1)
    tail = F.substring(rest, F.length(host) + 1, F.length(rest))
    path = F.substring_index(F.substring_index(tail, "?", 1), "#", 1)
    return F.translate(host, UPPER, LOWER), path


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, or null; of equal length, the one of the longer host, then a block."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    order = sorted({Rule(r.host.translate(str.maketrans(UPPER, LOWER)), r.path, r.verdict) for r in rules},
                   key=lambda r: (len(r.host + r.path), len(r.host), r.verdict == "block", r))
    for r in order:
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links from pages of one host to another host, counted. Links within a host and relative
    ones are the host's own and carry nothing. Counts are added before the shuffle, so a hub's links shrink to one row a host."""
    host, _ = url_parts(F.col("url"))
    found = pages.select(host.alias("src"), F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("dst"))
    found = found.select("src", F.translate("dst", UPPER, LOWER).alias("dst"))
    return found.where("src != '' and dst != '' and src != dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def personalised_rank(seeds: DataFrame, edges: DataFrame, store: Store, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, rank) with rank = seed + damping * sum of the neighbours' ranks by the edges' shares.

    ``seeds`` is (host, mass), one row a host with a mass over 0; ``edges`` (a, b, share) carries rank from a to b. The mass of
    hosts without edges stays where it is. Every five rounds the ranks are written, which cuts the lineage, and
    the rounds end early when none changes. Hosts that no seed reaches have no row.
    """
    rank = store.put(seeds.select("host", F.col("mass").alias("rank")), "rank")
    for start in range(0, rounds, EVERY):
        now = rank
        for _ in range(min(EVERY, rounds - start)):
            moved = edges.join(now, edges["a"] == now["host"]).select(F.col("b").alias("host"), (F.col("rank") * F.col("share") * damping).alias("rank"))
            now = seeds.select("host", F.col("mass").alias("rank")).unionAll(moved).groupBy("host").agg(F.sum("rank").alias("rank"))
        now = store.put(now, "rank")
        change = now.join(rank.select("host", F.col("rank").alias("before")), "host", "left").where(F.col("rank") - F.coalesce("before", F.lit(0.0)) > SETTLED)
        done = change.isEmpty()
        store.drop(rank)
        rank = now
        if done:
            break
    return rank


def judge(pages: DataFrame, rules: Sequence[Rule], threshold: float = 0.5, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """Rows of ``pages`` (page_id, url, html) as page_id, host, path, rule, verdict, trust, distrust.

    ``rules`` is a list of the caller's, part of the plan (some hundreds at most). The verdict is that of the
    longest rule that fits; else a host whose distrust is ``threshold`` or more, and over its trust, is blocked
    and any other allowed. A seed's mass is the share of its host's rows that the rules allow or block, so
    the threshold reads as: distrust like that of a host of which so large a part is blocked. Every row gives one row: repeated rows repeat, a null or
    hostless url has an empty host, no trust or distrust, and is allowed unless a rule fits. Null html has no links. Only
    page_id, url and html are read; an empty table gives an empty one.
    """
    spark = pages.sparkSession
    store = Store(spark, "linkgraph")
    host, path = url_parts(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn("_fit", fitting_rule(F.col("host"), F.col("path"), rules))
    share = lambda verdict: F.avg(F.coalesce(F.col("_fit.verdict") == verdict, F.lit(False)).cast("double"))
    hosts = store.put(judged.where("host != ''").groupBy("host").agg(share("allow").alias("allow"), share("block").alias("block")), "hosts")
    links = store.put(host_links(pages), "links")
    ranks = {}
    for name, seed, a, b in (("trust", "allow", "src", "dst"), ("distrust", "block", "dst", "src")):
        seeds = hosts.where(F.col(seed) > 0).select("host", F.col(seed).alias("mass"))
        if links.isEmpty():
            ranks[name] = seeds.select("host", F.col("mass").alias(name))
            continue
        out = links.groupBy(F.col(a).alias("a")).agg(F.sum("n").alias("all"))
        edges = store.put(links.select(F.col(a).alias("a"), F.col(b).alias("b"), "n").join(out, "a").select("a", "b", (F.col("n") / F.col("all")).alias("share")), "edges")
        ranks[name] = personalised_rank(seeds, edges, store, damping, rounds).select("host", F.col("rank").alias(name))
    value = lambda c: F.round(F.coalesce(c, F.lit(0.0)), 6).alias(c)
    known = store.put(ranks["trust"].join(ranks["distrust"], "host", "full").select("host", value("trust"), value("distrust")), "known")
    found = judged.join(known, "host", "left")
    blocked = F.coalesce((F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust")), F.lit(False))
    return found.select("page_id", "host", "path", F.col("_fit.rule").alias("rule"),
                        F.coalesce(F.col("_fit.verdict"), F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
                        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
