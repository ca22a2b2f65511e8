"""Connected components of an undirected graph of links, as rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.common import discard, materialize


def _to_smallest(edges: DataFrame) -> DataFrame:
    """(u, v, m) for each edge (u, v): m is the least of u and its neighbours."""
    least = edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return edges.join(least, "u")


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, root) for every end of a link (a, b); root is the least id that links reach.

    Each round first hangs larger neighbours on the least one, then smaller ones,
    until nothing changes: about log n rounds. Rows are only grouped to a minimum
    and joined back, so a node with very many neighbours never gathers them. More
    than max_rounds raise an error: no half-joined component is returned.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges, before = materialize(edges, "edges"), None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_smallest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        found = _to_smallest(large)
        small = found.select("u", F.col("m").alias("v")).unionByName(
            found.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        edges, last = materialize(small.distinct(), "edges"), edges
        discard(last)
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"components still change after {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("root")).unionByName(roots)
