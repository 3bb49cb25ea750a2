"""URL filters: path rules, then link-graph propagation over hosts.

Rules name a host with its subdomains and a path prefix; the longest rule that fits decides. For other urls the host decides:
personalised PageRank carries trust from hosts with allowed pages along the links, and the same walk over the reversed links carries
distrust from hosts with blocked pages to those that link to them. A host is blocked if its distrust is at least MARGIN times its trust and at least FLOOR
times its even share of all distrust (one over the number of nodes); hosts that neither walk reaches are allowed.

Nodes are hosts without user and port, and the domains above them down to two labels, with pages or without. Edges are the absolute links in the
pages (weighted by their number, links inside a host left out) and one edge each way between a node and the domain above it (weight 1), so that subdomains
of one domain are neighbours. Ranks live in tables keyed by node; a step is a join and an aggregate. Relative links stay inside their host and make no edge.

Cases: null url, or one without ://, has empty host and path, which no rule fits and no walk reaches (allowed); null html has no links; repeated
rows are judged alike and weigh as often as they occur; an empty table gives an empty result; columns other than page_id, url and html are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auralith.llm.common import HEAVY, SMALL, brief, checkpointed, compact, heavy_keys, join_skewed, join_small, tidied, tidy

#: (verdict, host, path) as the contract states them.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
DAMPING, EVERY, ENOUGH = 0.85, 6, 1e-6
MARGIN, FLOOR = 1.0, 0.25
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def parse(pages: DataFrame) -> DataFrame:
    """page_id, url, html, host, path."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return pages.select("page_id", "url", "html", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))


def with_rule(parsed: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """Adds rule and by_rule (allow or block): the longest rule that fits, null without one."""
    fits = lambda r: ((F.col("host") == r[1]) | F.col("host").endswith("." + r[1])) & F.col("path").startswith(r[2])
    longest = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    pick = lambda value: reduce(lambda c, r: c.when(fits(r), value(r)), longest[1:], F.when(fits(longest[0]), value(longest[0])))
    return parsed.withColumn("rule", pick(lambda r: F.lit(r[1] + r[2]))).withColumn("by_rule", pick(lambda r: F.lit(r[0])))


def _node(host: Column) -> Column:
    """A host without user and port."""
    return F.regexp_replace(host, r"^[^@]*@|:\d*$", "")


def host_edges(parsed: DataFrame) -> DataFrame:
    """src, dst, weight."""
    links = parsed.where("host <> ''").select(_node(F.col("host")).alias("src"), F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), 1)).alias("dst"))
    links = links.select("src", _node(F.lower("dst")).alias("dst")).where("src <> dst AND src <> '' AND dst <> ''")
    links = links.groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    # every host and every domain above it, each with the next one; numbers are addresses without domains
    parts = F.split("host", r"\.")
    chain = F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    hosts = parsed.select(_node(F.col("host")).alias("host")).union(links.select("src")).union(links.select("dst")).where(r"host <> '' AND NOT host RLIKE '^[0-9.]*$|^\\['").distinct()
    chains = hosts.select(F.when(F.size(parts) > 2, chain).otherwise(F.array("host")).alias("chain"))
    above = chains.select(F.explode(F.expr("transform(sequence(1, greatest(size(chain) - 1, 1)), i -> struct(chain[i - 1] AS host, get(chain, i) AS parent))")).alias("x")).select("x.*").where("parent IS NOT NULL").distinct()
    both = above.select(F.col("host").alias("src"), F.col("parent").alias("dst")).union(above.select("parent", "host")).withColumn("weight", F.lit(1.0))
    return links.union(both).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """walk, host, rank: personalised PageRank, one or several walks side by side. edges: walk, src, dst, weight; seeds: walk, host, seed (sum 1 a walk, or none).

    What a host without edges holds goes back to the seeds. All that goes back goes to the seeds alike, so the ranks are in proportion to what one start brings
    to each host, the sum of its steps; each step is at most DAMPING of the one before. The walks end when all steps to come are below ENOUGH of the
    sum. Hosts that only those reach (85 links or more) have no rank.
    The edges of a hub are dealt over several salts, and its sums go to each of them, so that no task holds a hub. A small graph's tables are one partition each (compact),
    and its moves are broadcast: a walk is some 15 times EVERY steps, and each exchange would be as many tasks as the session has partitions.
    """
    edges, seeds = compact(edges), compact(seeds)
    outs = edges.groupBy("walk", "src").agg(F.sum("weight").alias("out"), F.count("*").alias("n")).withColumn("salts", F.ceil(F.col("n") / HEAVY).cast("int"))
    outs = compact(outs)
    moves = join_skewed(edges, outs, ["walk", "src"], heavy_keys(outs, ["walk", "src"], "n"))
    moves = moves.select("walk", "src", F.pmod(F.xxhash64("dst"), "salts").cast("int").alias("salt"), "dst", (DAMPING * F.col("weight") / F.col("out")).alias("share"))
    # an edge to itself without a share takes a host's sum on
    hosts = seeds.select("walk", "host").union(edges.select("walk", "src")).union(edges.select("walk", "dst")).distinct()
    moves = compact(moves.union(hosts.select("walk", "host", F.lit(0), F.col("host").alias("dst"), F.lit(None).cast("double"))))
    to = outs.select("walk", F.col("src").alias("dst"), "salts")
    into = moves.groupBy("walk", "dst").agg(F.count("*").alias("n"))
    moves = compact(join_skewed(moves, to, ["walk", "dst"], heavy_keys(into, ["walk", "dst"], "n"), "left").select("walk", "src", "salt", "dst", "share", F.coalesce("salts", F.lit(1)).alias("salts")))
    walk = seeds.select("walk", "host", F.col("seed").alias("step"), F.lit(0.0).alias("sum")).join(outs.select("walk", F.col("src").alias("host"), "salts"), ["walk", "host"], "left")
    size = moves.count()
    walk = compact(walk.select("walk", "host", "step", "sum", F.coalesce("salts", F.lit(1)).alias("salts")))
    while True:
        for _ in range(EVERY):
            stays = F.col("share").isNull()
            sent = walk.select("walk", F.col("host").alias("src"), "step", "sum", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
            moved = join_small(sent, moves, ["walk", "src", "salt"], size, "inner").select("walk", F.col("dst").alias("host"), F.when(stays, 0.0).otherwise(F.col("step") * F.col("share")).alias("step"), F.when(stays, F.col("sum") + F.col("step")).otherwise(0.0).alias("sum"), "salts")
            walk = moved.groupBy("walk", "host").agg(F.sum("step").alias("step"), F.sum("sum").alias("sum"), F.max("salts").alias("salts"))
        walk = checkpointed(walk)
        walk = walk.coalesce(1) if size <= SMALL else walk  # tells the planner that it is one partition still; moves has a row for each host at least
        tidy(walk.sparkSession)  # the steps before have left their checkpoint
        totals = checkpointed(walk.groupBy(F.col("walk").alias("__w")).agg(F.sum("step").alias("left"), F.sum("sum").alias("total")))
        if totals.where((F.col("left") / (1 - DAMPING) > ENOUGH * F.col("total"))).isEmpty():
            # a row a walk
            rank = F.try_divide(F.col("sum") + F.col("step"), F.col("total") + F.col("left"))
            return walk.join(F.broadcast(totals), F.col("walk") == F.col("__w")).select("walk", "host", rank.alias("rank")).where("rank > 0")


def _seeds(judged: DataFrame, verdict: str) -> DataFrame:
    """Hosts with pages that rules judge so, by the logarithm of their number, so that one large host isn't all of the seed."""
    some = judged.where((F.col("by_rule") == verdict) & (F.col("host") != "")).groupBy(_node(F.col("host")).alias("host")).agg(F.log1p(F.count("*")).alias("n"))
    some = checkpointed(some)
    total = some.agg(F.sum("n")).first()[0] or 1.0
    return some.select("host", (F.col("n") / total).alias("seed"))


def filtered(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust: one row a page."""
    judged = with_rule(parse(pages), rules)
    named = lambda walk, df: df.select(F.lit(walk).alias("walk"), "*")
    # a step of a large graph is two exchanges, whose files go when the action that made them ends
    with tidied(pages.sparkSession), brief(pages.sparkSession):
        edges = checkpointed(host_edges(judged))
        both = named("trust", edges).union(named("distrust", edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")))
        ranks = propagate(both, named("trust", _seeds(judged, "allow")).union(named("distrust", _seeds(judged, "block"))))
    of = lambda walk: F.coalesce(F.max(F.when(F.col("walk") == walk, F.col("rank"))), F.lit(0.0)).alias(walk)
    ranks = ranks.groupBy(F.col("host").alias("node")).agg(of("trust"), of("distrust"))
    nodes = edges.select("src").union(edges.select("dst")).union(judged.select(_node(F.col("host")))).where("src <> ''").distinct().count()
    rows = judged.select("page_id", "host", "path", "rule", "by_rule", _node(F.col("host")).alias("node"))
    out = join_skewed(rows, checkpointed(ranks), ["node"], heavy_keys(rows.groupBy("node").agg(F.count("*").alias("n")), ["node"], "n"), "left")
    blocked: Column = (F.col("distrust") > 0) & (F.col("distrust") * nodes >= FLOOR) & (F.col("distrust") >= MARGIN * F.col("trust"))
    verdict = F.coalesce("by_rule", F.when(F.coalesce(blocked, F.lit(False)), "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
