"""Rank that flows between hosts: over parent domains, to its limit."""

from __future__ import annotations

import pytest

from catrec.llm import linkgraph

RULES = [("block", "bad.site.com/"), ("allow", "good.home.org/")]


def verdicts(spark, pages):
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return {r["host"]: r for r in linkgraph.judge(frame, RULES).collect()}


def test_parent_edges(spark):
    hosts = ["a.b.site.com", "site.com", "x.co.uk", "y.x.co.uk", "10.0.0.1", "host", "w.site.com:81", "v.site.com."]
    got = {tuple(r) for r in linkgraph.parent_edges(spark.createDataFrame([(h,) for h in hosts], "host string")).collect()}
    up = {("a.b.site.com", "b.site.com"), ("a.b.site.com", "site.com"), ("y.x.co.uk", "x.co.uk"),
          ("w.site.com:81", "w.site.com"), ("w.site.com:81", "site.com"), ("v.site.com.", "v.site.com"),
          ("v.site.com.", "site.com")}
    assert got == up | {(b, a) for a, b in up}


@pytest.mark.parametrize("small_edges", [200_000, 0])
def test_rank_reaches_siblings_over_a_parent_without_pages(spark, monkeypatch, small_edges):
    monkeypatch.setattr(linkgraph, "SMALL_EDGES", small_edges)
    got = verdicts(spark, [(f"http://{h}/1", None) for h in (
        "bad.site.com", "near.site.com", "far.site.com", "good.home.org", "www.home.org", "www.other.net")])
    assert got["near.site.com"]["distrust"] > 0 and got["near.site.com"]["trust"] == 0
    assert got["near.site.com"]["distrust"] == pytest.approx(got["far.site.com"]["distrust"])
    assert [got[h]["verdict"] for h in ("near.site.com", "far.site.com", "www.home.org", "www.other.net")] == [
        "block", "block", "allow", "allow"]
    assert got["www.home.org"]["trust"] > 0 and got["www.other.net"]["trust"] == got["www.other.net"]["distrust"] == 0


def reference(edges, seeds, rounds=600):
    """PageRank by dense power iteration; nodes without way out jump to the seeds."""
    nodes = sorted({x for e in edges for x in e} | set(seeds))
    out = {n: [b for a, b in edges if a == n] for n in nodes}
    jump = {n: (1 / len(seeds) if n in seeds else 0.0) for n in nodes}
    rank = dict(jump)
    for _ in range(rounds):
        stuck = sum(rank[n] for n in nodes if not out[n])
        new = {n: (0.15 + 0.85 * stuck) * jump[n] for n in nodes}
        for n in nodes:
            for b in out[n]:
                new[b] += 0.85 * rank[n] / len(out[n])
        rank = new
    return rank


def test_ranks_match_power_iteration(spark):
    edges = [("a", "b"), ("a", "c"), ("b", "c"), ("c", "a"), ("c", "stop"), ("lone", "a"), ("d", "bad"), ("a", "d"), ("e", "bad")]
    trusted, blocked = {"a", "lone"}, {"bad", "stop"}
    seeds = [("trust", h, 1.0) for h in trusted] + [("distrust", h, 1.0) for h in blocked]
    got = {r["host"]: r for r in linkgraph.propagate(
        spark.createDataFrame(edges, "src string, dst string"),
        spark.createDataFrame(seeds, "kind string, host string, mass double")).collect()}
    trust, distrust = reference(edges, trusted), reference([(b, a) for a, b in edges], blocked)
    for host, row in got.items():
        assert row["trust"] == pytest.approx(trust[host], abs=1e-5)
        assert row["distrust"] == pytest.approx(distrust[host], abs=1e-5)
    assert sum(r["trust"] for r in got.values()) == pytest.approx(1.0)
    assert sum(r["distrust"] for r in got.values()) == pytest.approx(1.0)


def test_distrust_reaches_hosts_many_links_away(spark):
    chain = [(f"http://h{i}.test/", f'<a href="http://{f"h{i + 1}.test" if i < 20 else "bad.site.com"}/">') for i in range(21)]
    got = verdicts(spark, [*chain, ("http://bad.site.com/", None)])
    assert {got[f"h{i}.test"]["verdict"] for i in range(21)} == {"block"}
