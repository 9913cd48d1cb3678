"""Consolidating pairwise matches into groups: union-find in edge partitions, merged hierarchically."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldreel.operators.forest import spanning_forests
from fieldreel.operators.joins import lookup
from fieldreel.session import cut_lineage, release

#: Edges that one task merges at most; 64-character ids then take about 200 MB in Python.
EDGE_BOUND = 400_000


def connected_components(pairs: DataFrame, left: str, right: str, *, edge_bound: int = EDGE_BOUND) -> DataFrame:
    """One row (id, group_id) for each id of a pair; group_id is the smallest id linked with it directly or indirectly.

    A pair with a null end links nothing and is left out, also its other end; a pair of equal ends gives that id a
    group of its own; repeated and swapped pairs count once; no pairs give no rows. Other columns are ignored.

    Every input partition is reduced to its spanning forest where it lies. Forests then merge in partitions of at most
    ``edge_bound`` edges. While more than one partition is needed, each node is replaced by the neighbour (or itself)
    with the least hash of the level, which removes a constant share of the nodes in expectation, and the nodes'
    replacements are kept to be followed back at the end; so no task ever holds a whole large component.
    """
    kind = pairs.schema[left].dataType
    schema = f"a {kind.simpleString()}, b {kind.simpleString()}"
    edges = pairs.select(F.col(left).alias("a"), F.col(right).alias("b")).dropna()
    edges = cut_lineage(edges.mapInPandas(spanning_forests, schema))
    steps: list[DataFrame] = []
    while (n := edges.count()) > edge_bound:
        level = len(steps)
        forest = cut_lineage(edges.repartition(-(-n // edge_bound)).mapInPandas(spanning_forests, schema))
        release(edges)
        ends = forest.select("a", "b").union(forest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(level), c).alias("h"), F.col(c).alias("id"))
        step = ends.groupBy(F.col("a").alias("node")).agg(F.least(F.min(rank("b")), F.first(rank("a")))["id"].alias("to"))
        step = cut_lineage(step)
        steps.append(step)
        # the node that a hub's edges share is one key with many rows
        to = lambda c: step.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to"))
        edges = lookup(lookup(forest.where("a <> b"), to("a"), "a", "b", hot=edge_bound), to("b"), "b", "a", hot=edge_bound).select(F.col("a_to").alias("a"), F.col("b_to").alias("b"))
        edges = cut_lineage(edges.where("a <> b").mapInPandas(spanning_forests, schema))
        release(forest)
    top = edges.coalesce(1).mapInPandas(spanning_forests, schema).select(F.col("a").alias("node"), F.col("b").alias("to"))
    if not steps:
        return top.select(F.col("node").alias("id"), F.col("to").alias("group_id"))

    def follow(above: DataFrame, step: DataFrame) -> DataFrame:
        nxt = above.select(F.col("node").alias("to"), F.col("to").alias("far"))
        return cut_lineage(lookup(step, nxt, "to", "node", "left", hot=edge_bound).select("node", F.coalesce("far", "to").alias("to")))

    found = reduce(follow, reversed(steps), top)
    release(*steps, edges)
    least = found.groupBy("to").agg(F.min("node").alias("group_id"))
    return lookup(found, least, "to", "node", hot=edge_bound).select(F.col("node").alias("id"), "group_id")
