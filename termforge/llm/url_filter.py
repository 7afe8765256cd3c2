"""URL verdicts: longest matching rule first, link-graph propagation for the rest.

Hosts form a graph of the links between their pages. Trust flows from hosts with allowed pages along links (personalised
PageRank); distrust flows from hosts with blocked pages against the links (the same walk on the reversed graph). A host is
blocked when its distrust exceeds its trust by the threshold. A walk ends at a host without onward links, so no step needs
a global sum. It goes on until no host's score moves by more than TOLERANCE of itself, so far hosts, whose scores are small, get
theirs too: about as many rounds as the longest shortest path has links, and some 85 more where there
are cycles. Edges are counted per pair of hosts before any join; a page is never joined with another page.

A null url, or one without ``://``, has an empty host and path; no rule fits it and it is allowed. Null html has no links.
Repeated rows each get the same verdict, and each counts as a page. Of rules of equal length that fit, the first stated wins; a host whose trust
equals its distrust is allowed. An empty table gives an empty result. Extra columns are not read; a long page is scanned whole by
Spark's own expressions.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termforge.llm.common import hot_join, materialize

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
DAMPING, TOLERANCE, THRESHOLD = 0.85, 1e-6, 0.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HREF = r"(?is)<a\s(?:[^>]*?\s)?href\s*=\s*[\"']?([^\"'\s>]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, else null."""
    case = None
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        hit = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        case = F.when(fits, hit) if case is None else case.when(fits, hit)
    return case if case is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts, counted; relative links stay on their host and add nothing."""
    links = pages.select(host_of(F.col("url")).alias("src"), F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(HREF), 1)).alias("to"))
    to = F.when(F.col("to").startswith("//"), F.concat(F.lit("x:"), "to")).otherwise(F.col("to"))
    links = links.where(F.col("to").contains("//")).select("src", host_of(to).alias("dst"))
    return links.where("src != '' and dst != '' and src != dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, rounds: int | None = None, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, score): personalised PageRank from ``seeds`` (host, seed; summing to 1) along edges (src, dst, share); at the fixed point, or after ``rounds``."""
    start = seeds.select("host", (F.col("seed") * (1 - damping)).alias("seed"))
    rank = materialize(start.select("host", F.col("seed").alias("score")), "rank")
    for _ in count() if rounds is None else range(rounds):
        flow = rank.join(edges, rank.host == edges.src).groupBy(F.col("dst").alias("host")).agg((damping * F.sum(F.col("score") * F.col("share"))).alias("flow"))
        new = start.join(flow, "host", "full").select("host", (F.coalesce("seed", F.lit(0.0)) + F.coalesce("flow", F.lit(0.0))).alias("score"))
        new = materialize(new, "rank")
        moved = new.join(rank.withColumnRenamed("score", "old"), "host", "full").agg(F.count_if(F.abs(F.coalesce("score", F.lit(0.0)) - F.coalesce("old", F.lit(0.0))) > tolerance * F.coalesce("score", F.lit(0.0)))).first()[0]
        rank = new
        if not moved:
            break
    return rank


def judge_urls(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD, damping: float = DAMPING, rounds: int | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, and the host's trust and distrust."""
    url = F.col("url")
    judged = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path")).withColumn("hit", rule_of(F.col("host"), F.col("path"), rules))
    edges = materialize(host_edges(pages), "edges")
    pageful = materialize(
        judged.where("host != ''").groupBy("host").agg(F.count_if(F.col("hit.verdict") == "allow").alias("good"), F.count_if(F.col("hit.verdict") == "block").alias("bad"), F.count("*").alias("pages")), "hosts"
    )
    good, bad, total = pageful.agg(F.sum("good"), F.sum("bad"), F.sum("pages")).first()

    def walk(marked: str, total, a: str, b: str, name: str) -> DataFrame:
        out = edges.groupBy(a).agg(F.sum("n").alias("all"))
        share = edges.join(out, a).select(F.col(a).alias("src"), F.col(b).alias("dst"), (F.col("n") / F.col("all")).alias("share"))
        seeds = pageful.where(F.col(marked) > 0).select("host", (F.col(marked) / F.lit(float(total or 1))).alias("seed"))
        return propagate(seeds, materialize(share, "shares"), damping, rounds).withColumnRenamed("score", name)

    scores = walk("good", good, "src", "dst", "trust").join(walk("bad", bad, "dst", "src", "distrust"), "host", "full")
    # Every host that has pages is in this table, so the pages of a hot one meet it by broadcast; those without a host meet none.
    known = materialize(pageful.select("host", "pages").join(scores, "host", "left"), "scores")
    out = hot_join(judged.where("host != ''"), known, "host", "pages", total or 0).unionByName(judged.where("host = ''"), allowMissingColumns=True)
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    return out.select(
        "page_id",
        "host",
        "path",
        F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", F.when(distrust - trust > threshold, "block").otherwise("allow")).alias("verdict"),
        trust.alias("trust"),
        distrust.alias("distrust"),
    )
