"""URL filters: path rules, and trust and distrust propagated over the link graph of hosts.

Trust starts at hosts whose pages the rules allow and follows links; distrust starts at hosts whose pages the rules block
and goes against the links, as a page that links to bad ones is suspect. Both are personalised PageRank in whole numbers:
every share is floored, so sums don't depend on their order. Pages meet only in sums per host and per pair of hosts,
which collapse before they are shuffled, so a host with most of the pages is one row.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from .shared import ascii_lower, stored

#: A score of one: a host all of whose pages the rules judge alike starts with (1 - damping) times this.
ONE = 1_000_000_000
#: The host of an absolute or scheme-relative link of an anchor.
LINK = r"""<[aA]\s[^>]*?[hH][rR][eE][fF]\s*=\s*["']?\s*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#"'\s>]+)"""


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) and path; both empty for null and for text without ``://``."""
    rest = F.when(F.contains(url, F.lit("://")), url.substr(F.locate("://", url) + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def first_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, nulls where none does. Equally long: block first, then by text."""
    ordered = sorted(rules, key=lambda r: (-len(r.host + r.path), r.verdict != "block", r.host + r.path))
    text = verdict = F.lit(None).cast("string")
    for rule in reversed(ordered):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.host + rule.path).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, links of pages (host, html): links between different hosts, counted."""
    targets = F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))
    found = pages.where("host <> '' AND html IS NOT NULL").select(F.col("host").alias("src"), targets.alias("dst"))
    found = found.withColumn("dst", ascii_lower(F.col("dst"))).where("dst <> src")
    return found.groupBy("src", "dst").agg(F.count("*").alias("links"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = 0.85, rounds: int = 20) -> DataFrame:
    """host, trust, distrust from seeds (host, trust, distrust in parts of ONE) over edges (src, dst, links).

    The number of rounds is fixed, so scores are those of walks of at most that many links. What reaches a host without links
    to go on along is not dealt back to the seeds: it stays counted there and leaves the next round.
    """
    out = edges.groupBy("src").agg(F.sum("links").alias("of_src"))
    into = edges.groupBy("dst").agg(F.sum("links").alias("of_dst"))
    edges = stored(edges.join(out, "src").join(into, "dst"), "edges")
    start = seeds.select("host", *(F.floor((1 - damping) * F.col(x)).alias(x) for x in ("trust", "distrust")))
    start = scores = stored(start, "seeds")
    if edges.isEmpty():
        return scores
    none = F.lit(0).cast("long")
    for i in range(rounds):
        # a link hands trust on in proportion to the source's links, and distrust back in proportion to the target's
        ahead = edges.join(scores.withColumnRenamed("host", "src"), "src").select(
            F.col("dst").alias("host"), F.floor(damping * F.col("trust") * F.col("links") / F.col("of_src")).alias("trust"), none.alias("distrust")
        )
        back = edges.join(scores.withColumnRenamed("host", "dst"), "dst").select(
            F.col("src").alias("host"), none.alias("trust"), F.floor(damping * F.col("distrust") * F.col("links") / F.col("of_dst")).alias("distrust")
        )
        scores = start.unionAll(ahead).unionAll(back).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        if i % 4 == 3 or i == rounds - 1:
            scores = stored(scores, "scores")
    return scores


def judge_urls(
    pages: DataFrame,
    rules: list[Rule],
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    damping: float = 0.85,
    rounds: int = 20,
    threshold: float = 0.5,
) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust, one row for each page; verdict is ``allow`` or ``block``.

    The longest rule that fits decides. Other pages are blocked where distrust exceeds trust by threshold times what an
    unlinked host with blocked pages only has; a host starts with the shares of its pages that rules allow and block.

    Defined cases: a null url and one without ``://`` have an empty host and path, no rule, and are allowed; null html
    has no links; links of a page to its own host don't count; a host known from links only takes part in the graph.
    Repeated pages count as often as they occur, each gets its row. A null id stays null. Extra columns are not read.
    """
    host, path = host_and_path(F.col(url_column))
    pages = pages.select(F.col(id_column).alias("page_id"), host.alias("host"), path.alias("path"), F.col(html_column).alias("html"))
    rule, verdict = first_rule(F.col("host"), F.col("path"), rules)
    ruled = pages.withColumns({"rule": rule, "ruled": verdict})
    share = lambda what: F.floor(F.lit(float(ONE)) * F.count_if(F.col("ruled") == what) / F.count("*"))
    seeds = ruled.where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    scores = propagate(seeds, host_edges(pages), damping, rounds)
    limit = int(threshold * (1 - damping) * ONE)
    judged = ruled.drop("html").join(scores, "host", "left")
    bad = F.coalesce(F.col("distrust") - F.col("trust") >= limit, F.lit(False))
    return judged.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("ruled", F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0)).alias("trust"),
        F.coalesce("distrust", F.lit(0)).alias("distrust"),
    )
