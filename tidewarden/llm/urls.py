"""URL filters: host and path rules, and for all other URLs a verdict from the link graph.

Rules bind a host with its subdomains and a path prefix; the longest that fits decides. Where none
fits, the host decides: trust spreads by personalised PageRank along links from hosts whose pages
the rules mostly allow, mixed with a little trust for every host; distrust spreads against the links
from hosts whose pages the rules mostly block, onto those that link to them. A host with more
distrust than trust is blocked.

Edges are the absolute links of the pages, added up to one weighted edge per pair of hosts before
any join, so a hot host is as many rows as it has neighbours. Ranks are written to the shared folder
after each few rounds.

Null URLs and those without '://' have an empty host and path, fit no rule and are allowed. Null or
empty html has no links; long html is searched whole. Repeated rows count as often as they occur and
get a row each. Of rules of one length the one with the longer host, then the first in order, wins;
a rule given twice counts once. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewarden.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Links with a host of their own in html.
LINK = "(?i)\\b(?:href|src)\\s*=\\s*[\"']?\\s*((?:https?:)?//[^\"'\\s<>]+)"
DAMPING = 0.85
#: The ranks are done when none moves by more than this share of an even rank, 1 / hosts, in a round.
TOLERANCE = 1e-3
#: Rounds between two writes of the ranks and looks at their changes.
STRIDE = 4
#: Share of the trust that starts at every host alike.
EVEN = 0.5


def _rest(url: Column) -> Column:
    """What follows the first '://'; the empty text if there is none."""
    before = F.substring_index(url, "://", 1)
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.length(before) + 4)).otherwise("")


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(_rest(url), "^([^/?#]*)", 1), F.lit("")),
                       UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Rules as (verdict, 'host/path') rows."""
    return spark.createDataFrame(list(rules), "verdict string, rule string")


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """Per host, the rules of it and its parent domains as an array, the longest first."""
    parts = rules.dropDuplicates(["rule"]).select(
        "verdict", "rule", F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER)
        .alias("bound"), F.substr(F.col("rule"), F.instr("rule", "/")).alias("prefix"))
    suffixes = hosts.select("host", F.explode(F.transform(
        F.sequence(F.lit(1), F.size(F.split("host", "\\."))),
        lambda n: F.call_function("substring_index", F.col("host"), F.lit("."), -n))).alias("bound"))
    fits = suffixes.join(parts, "bound").groupBy("host").agg(F.sort_array(F.collect_list(F.struct(
        (-F.length("rule")).alias("length"), (-F.length("bound")).alias("host_length"), "rule",
        "prefix", "verdict"))).alias("rules"))
    return fits


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Columns src, dst, links: one row for each pair of different hosts that links join."""
    links = F.explode(F.array_distinct(F.regexp_extract_all(
        F.coalesce(F.col(html), F.lit("")), F.lit(LINK), F.lit(1))))
    found = pages.select(host_of(F.col(url)).alias("src"), links.alias("link"))
    absolute = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")) \
        .otherwise(F.col("link"))
    return found.select("src", host_of(absolute).alias("dst")).filter(
        "src <> '' AND dst <> '' AND src <> dst").groupBy("src", "dst").agg(
        F.count("*").alias("links"))


def spread(nodes: DataFrame, edges: DataFrame, tolerance: float = TOLERANCE,
           damping: float = DAMPING) -> DataFrame:
    """Personalised PageRank of several kinds at once: columns kind, host and rank, of ``nodes``
    (kind, host, and a seed that sums to 1 for a kind, or to 0 if it has no seeds) over ``edges``
    (kind, src, dst, share: each source's shares sum to 1). What a host without links would pass on is
    lost. Changes shrink by the damping at least, so the rounds end, after about (log hosts + 7) / 0.16
    of them."""
    ranks = nodes.select("kind", "host", "seed", F.col("seed").alias("rank"))
    bound = tolerance / max(nodes.select("host").distinct().count(), 1)
    moved = float("inf")
    while moved > bound:
        for _ in range(STRIDE):
            passed = ranks.join(edges.withColumnRenamed("src", "host"), ["kind", "host"]).groupBy(
                "kind", F.col("dst").alias("host")).agg(F.sum(F.col("rank") * F.col("share")).alias("got"))
            ranks = ranks.join(passed, ["kind", "host"], "left").select(
                "kind", "host", "seed", F.col("rank").alias("old"),
                (damping * F.coalesce("got", F.lit(0.0)) + (1 - damping) * F.col("seed")).alias("rank"))
        ranks = written(ranks, "ranks")
        moved = ranks.agg(F.max(F.abs(F.col("rank") - F.col("old")))).first()[0] or 0.0
    return ranks.select("kind", "host", "rank")


def _shares(edges: DataFrame, src: str, dst: str) -> DataFrame:
    totals = edges.groupBy(F.col(src).alias("of")).agg(F.sum("links").alias("total"))
    return edges.join(totals, F.col(src) == F.col("of")).select(
        F.col(src).alias("src"), F.col(dst).alias("dst"),
        (F.col("links") / F.col("total")).alias("share"))


def host_scores(hosts: DataFrame, edges: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Columns host, trust, distrust of hosts (host, pages, allowed, blocked)."""
    linked = edges.select(F.col("src").alias("host")).union(edges.select("dst")).distinct()
    known = linked.join(hosts.select("host"), "host", "left_anti").select(
        "host", F.lit(0).alias("pages"), F.lit(0).alias("allowed"), F.lit(0).alias("blocked"))
    marked = hosts.union(known).filter("host <> ''").select(
        "host", (2 * F.col("allowed") > F.col("pages")).cast("double").alias("good"),
        (2 * F.col("blocked") > F.col("pages")).cast("double").alias("bad"))
    # One row of three sums.
    goods, bads, n = marked.agg(F.sum("good"), F.sum("bad"), F.count("*")).first()
    even = 1.0 / max(n, 1)
    good = F.col("good") / goods if goods else F.lit(even)
    bad = F.col("bad") / bads if bads else F.lit(0.0)
    seeds = F.array(F.struct(F.lit("trust").alias("kind"), ((1 - EVEN) * good + EVEN * even).alias("seed")),
                    F.struct(F.lit("distrust").alias("kind"), bad.alias("seed")))
    nodes = written(marked.select("host", F.inline(seeds)), "seeds")
    links = written(_shares(edges, "src", "dst").withColumn("kind", F.lit("trust")).unionByName(
        _shares(edges, "dst", "src").withColumn("kind", F.lit("distrust"))), "links")
    return spread(nodes, links, tolerance).groupBy("host").agg(*[
        F.max(F.when(F.col("kind") == kind, F.col("rank"))).alias(kind)
        for kind in ("trust", "distrust")])


def url_verdicts(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url",
                 html: str = "html", tolerance: float = TOLERANCE) -> DataFrame:
    """Columns page_id, host, path, rule, verdict, trust and distrust; a row for each page."""
    placed = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"),
                          path_of(F.col(url)).alias("path"))
    fits = written(host_rules(placed.select("host").distinct(), rules), "host-rules")
    first = F.filter("rules", lambda r: F.startswith(F.col("path"), r.prefix))
    ruled = placed.join(fits.withColumnRenamed("host", "of"), F.col("host") == F.col("of"), "left") \
        .withColumn("fit", F.get(first, F.lit(0)))
    hosts = written(ruled.groupBy("host").agg(
        F.count("*").alias("pages"), F.count_if(F.col("fit.verdict") == "allow").alias("allowed"),
        F.count_if(F.col("fit.verdict") == "block").alias("blocked")), "hosts")
    edges = written(link_edges(pages, url, html), "edges")
    scores = written(host_scores(hosts, edges, tolerance), "scores").withColumnRenamed(
        "host", "scored")
    own = F.when(F.col("distrust") > F.col("trust"), "block").otherwise("allow")
    return ruled.join(scores, F.col("host") == F.col("scored"), "left").select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), own).alias("verdict"), "trust", "distrust")
