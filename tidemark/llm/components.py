"""Connected components of an edge table, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of ``edges`` (a, b); component: the smallest node that links reach.

    Each round, every node joins its neighbour of least hash, if that is below its own, and the edges are contracted.
    Hash order makes chains collapse in a logarithmic number of rounds. Neighbours are reduced by partial aggregates, so
    a node with very many edges is no task of its own. Edges with a null end and loops are left out; repeated edges count
    once. No edges give no rows.
    """
    edges = edges.select("a", "b").filter(F.col("a") != F.col("b")).distinct()
    edges = stored(edges, "edges")
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        rank = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
        best = both.groupBy("u").agg(F.min(rank("v")).alias("best"))
        parents = stored(best.select(F.col("u").alias("node"), F.least(F.col("best"), rank("u"))["id"].alias("parent")), "parents")
        maps.append(parents)
        of = lambda name: parents.select(F.col("node").alias(name), F.col("parent").alias(f"p{name}"))
        edges = edges.join(of("a"), "a").join(of("b"), "b").filter(F.col("pa") != F.col("pb"))
        edges = stored(edges.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = maps[-1].select("node", F.col("parent").alias("root"))
    for step in reversed(maps[:-1]):
        later = roots.select(F.col("node").alias("parent"), F.col("root"))
        roots = step.join(later, "parent", "left").select("node", F.coalesce("root", "parent").alias("root"))
    roots = stored(roots, "roots")
    least = roots.groupBy("root").agg(F.min("node").alias("component"))
    return roots.join(least, "root").select("node", "component")
