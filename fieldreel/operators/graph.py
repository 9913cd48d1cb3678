"""Link graphs: components, reach along directed edges, tiers and trees."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldreel.operators.forest import spanning_forests
from fieldreel.operators.joins import symmetric_edges
from fieldreel.session import cut_lineage, release

#: Edges of spanning forests that one task merges at most.
EDGE_BOUND = 400_000


def components(edges: DataFrame, src: str, dst: str, *, edge_bound: int = EDGE_BOUND) -> DataFrame:
    """Rows (id, component): the smallest id that each is linked with, either way.

    Every partition's edges first reduce to their spanning forest. Forests of at most ``edge_bound`` edges are merged in
    one task. More go on as alternating stars: each node hangs its greater neighbours on the least of its neighbourhood,
    then its smaller ones, until nothing changes; minima are combined before shuffles, so hubs cost no more than others.
    """
    own = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).dropna()
    kind = own.schema["a"].dataType.simpleString()
    forest = cut_lineage(own.mapInPandas(spanning_forests, f"a {kind}, b {kind}"))
    if forest.count() <= edge_bound:
        return forest.coalesce(1).mapInPandas(spanning_forests, f"a {kind}, b {kind}").select(F.col("a").alias("id"), F.col("b").alias("component"))
    nodes = forest.select(F.col("a").alias("id")).distinct()
    star = cut_lineage(forest.where("a <> b").distinct())

    def hang(e: DataFrame, both_ways: bool) -> DataFrame:
        around = e.union(e.select("b", "a")) if both_ways else e
        low = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        far = around.join(low, "a")
        if both_ways:
            return far.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        return far.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct()

    signature = None
    while True:
        before, star = star, cut_lineage(hang(hang(star, True), False))
        release(before)
        now = tuple(star.agg(F.count("*"), F.expr("coalesce(bit_xor(xxhash64(a, b)), 0)")).first())
        if now == signature:
            break
        signature = now
    return nodes.join(star.groupBy("a").agg(F.min("b").alias("m")), F.col("id") == F.col("a"), "left").select("id", F.coalesce("m", "id").alias("component"))


def directed_reach(edges: DataFrame, src: str, dst: str, seeds: DataFrame, seed: str) -> DataFrame:
    """Rows (seed, id): what can be reached from each seed along the edges, the seed included. Rounds go on while something new is reached."""
    steps = cut_lineage(edges.select(F.col(src).alias("from"), F.col(dst).alias("to")).dropna().distinct())
    found = cut_lineage(seeds.select(F.col(seed).alias("seed"), F.col(seed).alias("id")).dropna().distinct())
    rounds, new = [found], found
    while not new.isEmpty():
        more = new.join(steps, F.col("id") == F.col("from")).select("seed", F.col("to").alias("id")).distinct()
        # every pair is in the round that found it first, so rounds need no rewriting
        known = reduce(DataFrame.union, rounds)
        new = cut_lineage(more.join(known, ["seed", "id"], "left_anti"))
        rounds.append(new)
    return reduce(DataFrame.union, rounds)


def edge_tiers(edges: DataFrame, src: str, dst: str, seeds: DataFrame, seed: str) -> DataFrame:
    """Edges with tier 1 if both ends are seeds, 2 if the opposite edge exists, else 3."""
    known = seeds.select(F.col(seed).alias("id")).distinct()
    both = symmetric_edges(edges, src, dst)
    both = both.join(known.select(F.col("id").alias("src"), F.lit(True).alias("_s")), "src", "left").join(known.select(F.col("id").alias("dst"), F.lit(True).alias("_d")), "dst", "left")
    return both.select("src", "dst", F.when(F.col("_s") & F.col("_d"), 1).when(F.col("symmetric"), 2).otherwise(3).alias("tier"))


def ancestors(nodes: DataFrame, id: str, parent: str, depth: int) -> DataFrame:
    """Rows (id, ancestor, level) up to ``depth`` levels above; stops at a missing parent and before an id met already."""
    up = nodes.select(F.col(id).alias("_i"), F.col(parent).alias("_p")).where("_i IS NOT NULL").groupBy("_i").agg(F.min("_p").alias("_p"))
    level = up.where("_p IS NOT NULL").select(F.col("_i").alias("id"), F.col("_p").alias("ancestor"), F.array("_i").alias("seen"))
    level = level.join(up.select(F.col("_i").alias("ancestor")), "ancestor", "left_semi").where(~F.array_contains("seen", F.col("ancestor")))
    out = level.select("id", "ancestor", F.lit(1).alias("level"))
    for n in range(2, depth + 1):
        level = level.join(up, F.col("ancestor") == F.col("_i")).where("_p IS NOT NULL").select("id", F.col("_p").alias("ancestor"), F.array_append("seen", F.col("ancestor")).alias("seen"))
        level = level.join(up.select(F.col("_i").alias("ancestor")), "ancestor", "left_semi").where(~F.array_contains("seen", F.col("ancestor")))
        out = out.union(level.select("id", "ancestor", F.lit(n).alias("level")))
    return out


def cycles(nodes: DataFrame, id: str, parent: str) -> DataFrame:
    """Ids (id) that come back to themselves along their parents.

    Ids without a parent, and those to which no id points, are on no cycle; they are peeled off round by round until
    nothing changes. Where ids have several parents, what remains may lie between cycles, and is checked by reach.
    """
    up = cut_lineage(nodes.select(F.col(id).alias("id"), F.col(parent).alias("to")).dropna().distinct())
    before, left = -1, up.count()
    while left and left != before:
        inner = up.join(up.select(F.col("id").alias("to")).distinct(), "to", "left_semi").join(up.select(F.col("to").alias("id")).distinct(), "id", "left_semi")
        peeled = cut_lineage(inner.select("id", "to"))
        release(up)
        up, before, left = peeled, left, peeled.count()
    if left == up.select("id").distinct().count():
        return up.select("id")  # one parent each: all of them lie on cycles
    return directed_reach(up, "id", "to", up.select(F.col("to").alias("seed"), F.col("id").alias("home")), "seed").join(up.select(F.col("to").alias("seed"), F.col("id").alias("home")), "seed").where("id = home").select("id").distinct()


def resolve_merges(merges: DataFrame, loser: str, winner: str) -> DataFrame:
    """Rows (id, final): the last winner of each loser's chain; a chain that runs in a circle ends at its smallest id."""
    step = merges.select(F.col(loser).alias("id"), F.col(winner).alias("to")).dropna().where("id <> to").groupBy("id").agg(F.min("to").alias("to"))
    now = cut_lineage(step.withColumn("low", F.least("id", "to")))
    for _ in range(64):
        nxt = now.select(F.col("id").alias("to"), F.col("to").alias("far"), F.col("low").alias("flow"))
        jumped = cut_lineage(now.join(nxt, "to", "left").select("id", F.coalesce("far", "to").alias("to"), F.least("low", F.coalesce("flow", "low")).alias("low"), F.col("far").isNotNull().alias("moved")))
        going = jumped.where("moved").count()
        now = jumped.drop("moved")
        if not going:
            break
    open_ends = now.join(now.select(F.col("id").alias("to")), "to", "left_semi").select("id", F.lit(True).alias("circle"))
    return now.join(open_ends, "id", "left").select("id", F.when(F.col("circle"), F.col("low")).otherwise(F.col("to")).alias("final"))
