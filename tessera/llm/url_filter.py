"""URL filters: rules, and for hosts without one link-graph propagation.

Rules decide first (the longest that fits).  The other hosts are judged by two
personalised PageRanks over host edges: trust flows along links from the hosts
of allowed pages, distrust flows against them from the hosts of blocked pages.
A host is blocked when its distrust exceeds its trust by more than `MARGIN`.

Host edges are the links of the pages' html that name a host (with a scheme or
as `//host`), weighted by the number of pages, and an edge both ways between a
host and the domain above it (down to two labels), since a site and its
subdomains vouch for each other.  All work is on host-level tables except one
scan of the pages; hubs are joined apart and every iteration is written to the
shared folder.

A rank is the sum of what arrives over paths of 0, 1, 2, ... edges, so it only
grows.  A round sends on what the last one brought; rounds go on until no host's
rank grows by more than `SETTLED` of itself, so hosts far from every seed are
reached too.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import join_to_groups, written

ALLOW, BLOCK = "allow", "block"
DAMPING = 0.85
ITERATIONS = 12  # rounds between two looks at whether ranks have settled
SETTLED = 1e-4  # settled when a round adds no more than this share to any host's rank
ROUNDS = 6000  # safety bound: by then any path's rank is under LEAST
LEAST = 1e-300  # what arrives below this is beyond a double's full precision
MARGIN = 0.0
HUB_SHARE = 1000
LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s<>]+)"""


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased;
    empty for null or without `://`."""
    at = F.instr(url, "://")
    host = F.regexp_extract(F.substring(url, at + 3, F.length(url)), r"^[^/?#]*", 0)
    return F.when(at > 0, F.translate(host, string.ascii_uppercase, string.ascii_lowercase)).otherwise("")


def path_of(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.regexp_extract(F.substring(url, at + 3, F.length(url)), r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def fitting(rules: list[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else nulls.  `rules`
    is a list of (host/path, verdict); a rule fits its host and all subdomains
    where the path starts with the rule's."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), r[0].index("/"))):
        name = text[:text.index("/")]
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(text[len(name):])
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight) between different hosts, from pages (host, html)."""
    links = pages.where(F.instr("html", "//") > 0).select("host", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)))).alias("to"))
    to = F.when(F.col("to").startswith("//"), F.concat(F.lit("http:"), F.col("to"))).otherwise(F.col("to"))
    links = links.select(F.col("host").alias("src"), host_of(to).alias("dst"))
    labels = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(0), F.size(labels) - 2), lambda k: F.array_join(F.slice(labels, k + 1, F.size(labels)), "."))
    names = pages.select("host").distinct().where(F.size(labels) > 2)
    chain = names.select(above.alias("chain")).select(F.posexplode(F.slice("chain", F.lit(1), F.size("chain") - 1)).alias("k", "src"), "chain")
    up = chain.select("src", F.get("chain", F.col("k") + 1).alias("dst")).distinct()
    tree = up.unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    both = links.withColumn("n", F.lit(1)).unionByName(tree.withColumn("n", F.lit(1)))
    return both.where("src != dst AND src != '' AND dst != ''").groupBy("src", "dst").agg(F.sum("n").alias("weight"))


def ranks(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(host, trust, distrust): personalised PageRank of `seeds` (host, good,
    bad; each adds up to 1 or 0), trust along and distrust against `edges`."""
    forth = edges.select("src", "dst", "weight", F.lit(0).alias("kind"))
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight", F.lit(1).alias("kind"))
    both = forth.unionByName(back)
    out = both.groupBy("src", "kind").agg(F.sum("weight").alias("all"), F.count("*").alias("degree"))
    n = 2 * edges.count()
    both = written(join_to_groups(both.withColumn("key", F.struct("src", "kind")), out.select(F.struct("src", "kind").alias("key"), "all", "degree"), "key", "degree", n)
                   .select("src", "dst", "kind", (F.col("weight") / F.col("all")).alias("share")), "host-edges")
    # hosts with over 1/HUB_SHARE of the edges number fewer than HUB_SHARE, so what they send is broadcast
    hubs = F.broadcast(written(both.groupBy("src").count().where(F.col("count") * HUB_SHARE > n).select(F.col("src").alias("host")), "hubs"))
    of_hubs = written(both.join(hubs, both["src"] == hubs["host"], "left_semi"), "hub-edges")
    others = written(both.join(hubs, both["src"] == hubs["host"], "left_anti"), "other-edges")

    def sent_on(arrived: DataFrame) -> DataFrame:
        from_hubs = of_hubs.join(F.broadcast(arrived.join(hubs, "host", "left_semi")), F.col("src") == F.col("host"))
        sent = from_hubs.unionByName(others.join(arrived, F.col("src") == F.col("host")))
        flow = lambda kind, rank: F.sum(F.when(F.col("kind") == kind, F.col("share") * F.col(rank)).otherwise(0.0)) * DAMPING
        return sent.groupBy(F.col("dst").alias("host")).agg(flow(0, "trust").alias("trust"), flow(1, "distrust").alias("distrust")).where(
            F.greatest("trust", "distrust") >= LEAST)

    arrived = written(seeds.select("host", (F.col("good") * (1 - DAMPING)).alias("trust"), (F.col("bad") * (1 - DAMPING)).alias("distrust")), "arrived")
    now, rounds = arrived, 0
    while rounds < ROUNDS:
        parts = now
        for _ in range(ITERATIONS):
            arrived = written(sent_on(arrived), "arrived")
            parts, rounds = parts.unionByName(arrived), rounds + 1
        now = written(parts.groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")), "ranks")
        grown = [F.when(F.col(f"b.{c}") >= LEAST, F.col(f"b.{c}") / F.col(f"a.{c}")) for c in ("trust", "distrust")]
        most = now.alias("a").join(arrived.alias("b"), "host").agg(F.max(F.greatest(*grown))).first()[0]
        if most is None or most <= SETTLED:
            return now
    raise RuntimeError(f"host ranks still grow by {most:g} of themselves after {rounds} rounds")


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url",
                html_col: str = "html") -> DataFrame:
    """Per row: page_id, host, path, rule (null if none fits), verdict (`allow`
    or `block`), trust, distrust of the host.

    A null url, or one without `://`, has an empty host and path.  A host that
    neither trust nor distrust reaches is allowed.  Rows that repeat count as
    that many pages; null html has no links; an empty table gives no rows.
    Only the three columns are read."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    rule, verdict = fitting(rules, F.col("host"), F.col("path"))
    judged = rows.select("page_id", F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"), F.coalesce(path_of(F.col("url")), F.lit("")).alias("path"))
    judged = written(judged.select("*", rule.alias("rule"), verdict.alias("verdict")), "judged-pages")
    n = judged.count()
    count = lambda says: F.count(F.when(F.col("verdict") == says, 1))
    hosts = written(judged.groupBy("host").agg(F.count("*").alias("size"), count(ALLOW).alias("allowed"), count(BLOCK).alias("blocked")), "hosts")
    total = hosts.agg(F.sum("allowed"), F.sum("blocked")).first()
    seeds = hosts.where("allowed + blocked > 0").select(
        "host", (F.col("allowed") / max(1, total[0] or 0)).alias("good"), (F.col("blocked") / max(1, total[1] or 0)).alias("bad"))
    edges = host_edges(pages.select(F.coalesce(host_of(F.col(url_col)), F.lit("")).alias("host"), F.col(html_col).alias("html")))
    rank = ranks(written(edges, "links"), seeds)
    by_host = hosts.select("host", "size").join(rank, "host", "left").na.fill(0.0, ["trust", "distrust"])
    out = join_to_groups(judged, by_host, "host", "size", n)
    method = F.when(F.col("distrust") > F.col("trust") + MARGIN, BLOCK).otherwise(ALLOW)
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", method).alias("verdict"), "trust", "distrust")
