"""Connected components of a graph too large for the driver.

Alternating large-star and small-star steps: a large-star step hangs all larger
neighbours of a node below its smallest one, a small-star step does so for the
smaller ones.  Both are an aggregate and a join on edges, so a node with very
many edges is pre-aggregated, and its join can be split.  Edges are written after
each turn; the number of turns grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortry.llm.stash import stash


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.selectExpr("count(*)", "bit_xor(xxhash64(hi, lo))").first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node reachable.

    Repeated edges and loops are harmless; edges with a null end are ignored.
    """
    links = stash(
        edges.where("a <> b").selectExpr("greatest(a, b) AS hi", "least(a, b) AS lo").distinct(),
        "edges",
    )
    before = _state(links)
    while before[0]:
        both = links.selectExpr("inline(array(struct(hi AS u, lo AS v), struct(lo AS u, hi AS v)))")
        least = both.groupBy("u").agg({"v": "min"}).selectExpr("u AS _u", "least(u, `min(v)`) AS m")
        large = (
            both.where("v > u")
            .join(least, both["u"] == least["_u"])
            .where("v <> m")
            .selectExpr("v AS hi", "m AS lo")
            .distinct()
        )
        large = stash(large, "edges")
        least = large.groupBy("hi").agg({"lo": "min"}).selectExpr("hi AS _u", "`min(lo)` AS m")
        small = (
            large.join(least, large["hi"] == least["_u"])
            .selectExpr("inline(array(struct(lo AS hi, m AS lo), struct(hi, m AS lo)))")
            .where("hi <> lo")
            .distinct()
        )
        links = stash(small, "edges")
        after = _state(links)
        if after == before:
            break
        before = after
    nodes = links.selectExpr("hi AS node", "lo AS component")
    return nodes.union(links.selectExpr("lo", "lo").distinct())
