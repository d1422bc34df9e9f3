"""URL filters: rules by host and path, and link-graph propagation for the rest.

Trust flows along links from trusted hosts, distrust flows backwards from
blocked hosts to those that link to them; both are personalised PageRanks over
distinct host edges, thresholded per host.  Everything is DataFrame functions.

Edges are the absolute (or scheme-relative) links of a page's HTML, and each
host is tied both ways to its parent domains below the public suffix, which are
nodes whether a page has them as host or not, so that sibling hosts are linked;
a host passes up little of what it has, and a parent deals it equally to the hosts
below it, so that a share of bad siblings counts, not one among many.  A host is a
seed if the rules decide more than half of its pages one way, with the share of its
pages so ruled as mass.  A host's pages without a rule are blocked if its distrust is
above its trust and above a floor, in units of wholly ruled-out hosts.

Cases: a url that is null or has no ``://`` has an empty host and path and no
rule; null HTML has no links; ties between trust and distrust allow; repeated
rows repeat; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catrec.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMPING = 0.85
#: Share of the rank of a kind by which the last round of STEPS steps may still have raised it.
TOLERANCE = 1e-6
STEPS = 6
#: Distrust that blocks a host, against its trust plus distrust.
BLOCK_SHARE = 0.5
#: Distrust that blocks is over this, where a host with all pages ruled out brings in one.
FLOOR = 0.0045
#: Rank that a host passes up to a parent domain, against a link's.
TIE_WEIGHT = 0.03
#: Edges of a graph that one task holds.
SMALL_EDGES = 200_000
#: Names of two labels under which anybody registers (one label always is a suffix).
SUFFIX = r"^(?:ac|co|com|edu|go|gob|gouv|gov|gv|ltd|mil|ne|net|nom|or|org|plc|sch)\.[a-z]{2}$"
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/"'?#\s<>]+)"""


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): after the first ``://`` up to / ? # and from there up to ? or #; both empty without it."""
    has = F.coalesce(url.contains("://"), F.lit(False))
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return (F.when(has, lower_ascii(host)).otherwise(F.lit("")), F.when(has, path).otherwise(F.lit("")))


def rule_column(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, as a chain of tests, longest first; nulls where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda x: (len(x[1]), x[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """Distinct (src, dst) host links of ``pages`` (host, html), loops left out."""
    return (pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(F.array_distinct(
        F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)))).alias("dst"))
        .select("src", lower_ascii(F.col("dst")).alias("dst")).where("src <> dst").distinct())


def parent_edges(hosts: DataFrame) -> DataFrame:
    """Both ways between each host and its parent domains below the public suffix; addresses have none."""
    name = F.rtrim(F.regexp_replace("host", r"^.*@|:\d*$", ""), F.lit("."))
    named = (hosts.select("host", F.split(name, r"\.").alias("labels"))
             .where(F.col("host").contains(".") & ~F.col("host").rlike(r"^[0-9.]+(?::\d*)?$|[\[\]]")))
    up = (named.select("host", F.explode(F.transform(
        F.slice("labels", 1, F.size("labels") - 1), lambda _, at: F.array_join(F.slice("labels", at + 1, 10_000), ".")))
        .alias("up")).where((F.col("up") != F.col("host")) & ~F.col("up").rlike(SUFFIX)).distinct()
        .select(F.col("host").alias("src"), F.col("up").alias("dst")))
    return up.union(up.select("dst", "src"))


def weighted_ties(ties: DataFrame) -> DataFrame:
    """``ties`` between hosts and parents with the weights that trust (along) and distrust (back) pass by."""
    up = F.length("src") > F.length("dst")
    below = ties.where(up).groupBy(F.col("dst").alias("parent")).agg((1 / F.count("*")).alias("share"))
    named = ties.withColumn("parent", F.when(up, F.col("dst")).otherwise(F.col("src"))).join(below, "parent")
    return named.select("src", "dst", F.when(up, F.lit(TIE_WEIGHT)).otherwise(F.col("share")).alias("along"),
                        F.when(up, F.col("share")).otherwise(F.lit(TIE_WEIGHT)).alias("back"))


def propagate(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(host, trust, distrust): two personalised PageRanks, one along and one against the edges.

    ``seeds`` (kind, host, mass) with kind ``trust`` or ``distrust``; ``edges`` (src, dst) may have
    weights for trust (``along``) and distrust (``back``).  A node shares its rank by weight; weights that sum
    to less than one pass on that much.  Ranks grow
    from the seeds' shares, so the L1 change of a round is that of their sums; rounds
    end when it is below the tolerance and no further host was reached.  The ranks
    of a kind are then scaled to one, which returns the mass of nodes without way
    out, and what weak edges hold back, to the seeds.
    """
    along, back = (F.col(c) if c in edges.columns else F.lit(1.0) for c in ("along", "back"))
    flows = edges.select(F.lit("trust").alias("kind"), "src", "dst", along.alias("weight")).union(
        edges.select(F.lit("distrust"), F.col("dst"), F.col("src"), back))
    degree = flows.groupBy("kind", "src").agg(F.greatest(F.lit(1.0), F.sum("weight")).alias("degree"))
    # Adaptive execution splits a hub's edges in this join and those of the steps; sums combine map-side.
    flows = stored(flows.join(degree, ["kind", "src"]).select(
        "kind", F.col("src").alias("host"), "dst", (F.col("weight") / F.col("degree")).alias("passes")))
    # Measured: a graph that one task can hold takes one task a step.
    small = flows.limit(SMALL_EDGES + 1).count() <= SMALL_EDGES
    if small:
        flows = F.broadcast(stored(flows.coalesce(1)))
    total = seeds.groupBy("kind").agg(F.sum("mass").alias("all"))  # two rows
    start = seeds.join(F.broadcast(total), "kind").select(
        "kind", "host", (F.col("mass") / F.col("all") * (1 - DAMPING)).alias("rank"))
    start = stored(start.coalesce(1) if small else start)
    ranks, before = start, {}
    while True:
        for _ in range(STEPS):
            passed = ranks.join(flows, ["kind", "host"]).select(
                "kind", F.col("dst").alias("host"), (F.col("rank") * DAMPING * F.col("passes")).alias("rank"))
            ranks = passed.unionByName(start).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
            ranks = ranks.coalesce(1) if small else ranks
        ranks = stored(ranks)
        now = {r["kind"]: (r["hosts"], r["mass"]) for r in ranks.groupBy("kind").agg(
            F.count("*").alias("hosts"), F.sum("rank").alias("mass")).collect()}  # two rows
        if all(kind in before and hosts == before[kind][0] and mass - before[kind][1] <= TOLERANCE * mass
               for kind, (hosts, mass) in now.items()):
            break
        before = now

    def scaled(kind: str) -> Column:
        mass = now.get(kind, (0, 1.0))[1]
        return F.sum(F.when(F.col("kind") == kind, F.col("rank") / F.lit(mass)).otherwise(0.0)).alias(kind)

    return ranks.groupBy("host").agg(scaled("trust"), scaled("distrust"))


def judge(pages: DataFrame, rules: list[tuple[str, str]], id_column: str = "page_id") -> DataFrame:
    """(id, host, path, rule, verdict, trust, distrust) of every page."""
    host, path = url_parts(F.col("url"))
    parted = pages.select(F.col(id_column).alias("id"), host.alias("host"), path.alias("path"), "html")
    rule, verdict = rule_column(F.col("host"), F.col("path"), rules)
    ruled = parted.select("id", "host", "path", rule.alias("rule"), verdict.alias("ruled"))
    hosts = stored(ruled.where("host <> ''").groupBy("host").agg(
        F.count("*").alias("pages"), F.count(F.when(F.col("ruled") == "allow", 1)).alias("allowed"),
        F.count(F.when(F.col("ruled") == "block", 1)).alias("blocked")))
    edges = stored(host_edges(parted).select("src", "dst", F.lit(1.0).alias("along"), F.lit(1.0).alias("back"))
                   .union(weighted_ties(parent_edges(hosts.select("host"))))
                   .groupBy("src", "dst").agg(F.max("along").alias("along"), F.max("back").alias("back")))
    seeds = hosts.select(F.when(F.col("allowed") * 2 > F.col("pages"), F.lit("trust"))
                         .when(F.col("blocked") * 2 > F.col("pages"), F.lit("distrust")).alias("kind"), "host",
                         (F.greatest("allowed", "blocked") / F.col("pages")).alias("mass")).where("kind is not null")
    ruled_out = seeds.where("kind = 'distrust'").agg(F.coalesce(F.sum("mass"), F.lit(0.0))).first()[0]
    ranks = propagate(edges, seeds)
    # One row per host, so that the pages of a hot host meet one row each.
    scored = stored(hosts.select("host").join(ranks, "host", "left").select(
        "host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")))
    bad = (F.col("distrust") * F.lit(float(ruled_out)) > FLOOR) & (F.col("distrust") > BLOCK_SHARE * (F.col("trust") + F.col("distrust")))
    return ruled.join(scored, "host", "left").select(
        F.col("id").alias(id_column), "host", "path", "rule",
        F.coalesce("ruled", F.when(bad, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
