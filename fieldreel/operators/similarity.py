"""Exact vector search, group means, agreement, margins and cut deltas."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldreel.functions.columns import cosine, dot, norm, usable_vector
from fieldreel.operators.graph import components
from fieldreel.operators.joins import nearest
from fieldreel.operators.ranking import margin_gate, top_k_per
from fieldreel.session import cut_lineage, steady

# About as many queries and rows are in a block when all meet all.
QUERY_BLOCK, ROW_BLOCK = 500, 10_000

# Grades of a cut by the likeness of the frames on both sides.
CLEAN, SOFT = 0.85, 0.55


def literal(vector: list[float]) -> Column:
    return F.array(*(F.lit(float(x)) for x in vector))


def cosine_top_k(df: DataFrame, vector: str, query: list[float] | Column, k: int, ties: list[Column], allowed: DataFrame | None = None, key: str | None = None) -> DataFrame:
    """The k rows most similar to the query with their cosine; unusable vectors never match. ``allowed`` (key) restricts before scoring; empty, it gives nothing. Each task keeps only its own best k."""
    rows = df.where(usable_vector(F.col(vector)))
    if allowed is not None:
        rows = rows.join(allowed, key, "left_semi")
    q = query if isinstance(query, Column) else literal(query)
    return rows.withColumn("cosine", cosine(F.col(vector), q)).where("cosine IS NOT NULL").orderBy(F.desc("cosine"), *ties).limit(k)


def cosine_top_k_each(df: DataFrame, id: str, vector: str, queries: DataFrame, query_id: str, query: str, k: int, *, apart: tuple[str, str] | None = None) -> DataFrame:
    """Rows (query_id, id, cosine, rank): the k rows most similar to each query, equal ones by id; unusable vectors never match.

    Rows and queries meet in blocks, all with all, and each meeting keeps the best k of its queries. ``apart`` names a
    column of the queries and one of the rows; rows that are equal in them don't meet, as a query and itself. Ids and
    query ids are distinct, and all vectors of one length.
    """
    steady(df.sparkSession)
    mine, other = apart or (None, None)
    sides = []
    for rows, i, v, extra, size in ((queries, query_id, query, mine, QUERY_BLOCK), (df, id, vector, other, ROW_BLOCK)):
        own = F.col(extra).cast("string") if extra else F.lit(None).cast("string")
        rows = rows.where(usable_vector(F.col(v)) & F.col(i).isNotNull()).select(F.col(i).alias("i"), F.transform(v, lambda x: x.cast("double")).alias("v"), own.alias("x"))
        n = -(-max(1, rows.count()) // size)
        sides.append((n, rows.groupBy(F.pmod(F.xxhash64("i"), F.lit(n)).alias("_n")).agg(F.collect_list(F.struct("i", "v", "x")).alias("r"))))
    (na, a), (nb, b) = sides
    a, b = (s.select(F.col("_n").alias(f"_{p}"), F.col("r.i").alias(f"{p}i"), F.flatten("r.v").alias(f"{p}v"), F.transform("r", lambda r: r["x"]).alias(f"{p}x")) for s, p in ((a, "q"), (b, "r")))
    met = a.crossJoin(b).repartition(min(10_000, na * nb), "_q", "_r").drop("_q", "_r")
    schema = T.StructType([T.StructField(query_id, queries.schema[query_id].dataType), T.StructField(id, df.schema[id].dataType), T.StructField("cosine", T.DoubleType())])

    def best(batches):
        for batch in batches:
            for qi, qv, qx, ri, rv, rx in zip(*(batch[c] for c in ("qi", "qv", "qx", "ri", "rv", "rx")), strict=True):
                q, r = (np.asarray(v, float).reshape(len(i), -1) for v, i in ((qv, qi), (rv, ri)))
                q, r = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (q, r))
                names = np.asarray(ri)
                likeness = q @ r.T
                if apart:
                    qx, rx = (np.array(["" if v is None else "=" + v for v in x], object) for x in (qx, rx))
                    likeness[(qx[:, None] == rx[None, :]) & (qx != "")[:, None]] = -np.inf
                out = []
                for n, row in enumerate(likeness):
                    # a product of matrices may give equal vectors unequal last digits, so near ones are summed again
                    edge = np.partition(row, -k)[-k] - 1e-9 if len(row) > k else -np.inf
                    near = np.flatnonzero((row >= edge) & (row > -np.inf))
                    exact = (r[near] * q[n]).sum(axis=1)
                    out += [(qi[n], names[near[m]], exact[m]) for m in np.lexsort((names[near], -exact))[:k]]
                yield pd.DataFrame(out, columns=[query_id, id, "cosine"])

    return top_k_per(met.mapInPandas(best, schema), [query_id], [F.desc("cosine"), F.col(id)], k)


def group_means(df: DataFrame, group: str, vector: str) -> DataFrame:
    """Rows (group, vector, n): mean of each group's usable vectors, not normalised again. Values are summed by place before the shuffle."""
    rows = df.where(usable_vector(F.col(vector)) & F.col(group).isNotNull()).select(group, F.posexplode(vector).alias("i", "x"))
    means = rows.groupBy(group, "i").agg(F.avg(F.col("x").cast("double")).alias("m"), F.count("*").alias("n"))
    gathered = means.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("v"), F.max("n").alias("n"))
    return gathered.select(group, F.transform("v", lambda s: s["m"]).alias("vector"), "n")


def centroids(df: DataFrame, group: str, vector: str) -> DataFrame:
    """Group means at length one."""
    means = group_means(df, group, vector).withColumn("_n", norm(F.col("vector")) + 1e-9)
    return means.withColumn("vector", F.transform("vector", lambda x: x / F.col("_n"))).drop("_n")


def agreement(df: DataFrame, group: str, id: str, vector: str, above: float = 0.4) -> DataFrame:
    """Rows (group, id, agreeing): vectors of the group with cosine above the bound, itself included. Groups must be small by nature, as one person's exemplars are."""
    rows = df.where(usable_vector(F.col(vector))).select(group, id, F.transform(vector, lambda x: x / norm(F.col(vector))).alias("v"))
    pairs = rows.join(rows.select(group, F.col(id).alias("_o"), F.col("v").alias("_w")), group)
    return pairs.where(dot(F.col("v"), F.col("_w")) > above).groupBy(group, id).agg(F.count("*").alias("agreeing"))


def nearest_centroid(df: DataFrame, id: str, vector: str, centres: DataFrame, group: str, least: float = 0.55, margin: float = 0.10, most_centres: int = 10_000) -> DataFrame:
    """Rows (id, group, cosine, runner_up, passed): the most similar centre of each row. The centres are checked to be few and go along with each row as one array."""
    few = centres.select(group, F.col("vector").alias("w")).limit(most_centres + 1).collect()
    if len(few) > most_centres:
        raise ValueError(f"more than {most_centres} centres; use an index")
    if not few:
        return df.limit(0).select(id, F.lit(None).cast(centres.schema[group].dataType).alias(group), F.lit(None).cast("double").alias("cosine"), F.lit(None).cast("double").alias("runner_up"), F.lit(None).cast("boolean").alias("passed"))
    table = df.sparkSession.createDataFrame(few, centres.select(group, F.col("vector").alias("w")).schema).agg(F.collect_list(F.struct(group, "w")).alias("centres"))
    rows = df.where(usable_vector(F.col(vector))).select(id, vector).join(F.broadcast(table), F.lit(True))  # one row of at most most_centres
    scored = rows.select(id, F.explode(F.transform("centres", lambda c: F.struct(c[group].alias(group), cosine(F.col(vector), c["w"]).alias("cosine")))).alias("c")).select(id, f"c.{group}", "c.cosine")
    return margin_gate(scored, [id], "cosine", [F.col(group)], least, margin)


def cut_deltas(cuts: DataFrame, frames: DataFrame, *, id: str, out_asset: str, out_at: str, in_asset: str, in_at: str, width: float = 600.0) -> DataFrame:
    """``id`` with cosine and grade of the frames nearest to both sides of a cut: clean, soft or hard; no_out or no_in where a side has none.

    ``frames``: asset_id, at, frame_id, vector.
    """
    f = frames.where(usable_vector(F.col("vector"))).select("asset_id", F.col("at").alias("_m"), "frame_id", "vector")
    sides = []
    for asset, at, side in ((out_asset, out_at, "o"), (in_asset, in_at, "i")):
        near = nearest(cuts.select(id, F.col(asset).alias("asset_id"), F.col(at).alias("_at")), f, "asset_id", "_at", id, "_m", id="frame_id", width=width)
        sides.append(near.select(id, F.col("nearest.id").alias("frame_id")).join(f.select("frame_id", F.col("vector").alias(f"_{side}")), "frame_id", "left").drop("frame_id"))
    both = sides[0].join(sides[1], id).withColumn("cosine", F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine(F.col("_o"), F.col("_i")))))
    grade = F.when(F.col("_o").isNull(), "no_out").when(F.col("_i").isNull(), "no_in").when(F.col("cosine") >= CLEAN, "clean").when(F.col("cosine") >= SOFT, "soft").otherwise("hard")
    return both.select(id, "cosine", grade.alias("grade"))


def tag_scores(df: DataFrame, id: str, vector: str, tags: DataFrame, tag: str, most_tags: int = 10_000) -> DataFrame:
    """Rows (id, tag, cosine) of every row with every tag (tag, vector); tags are checked to be few and go along with each row as one array. Unusable vectors give nothing."""
    few = tags.select(tag, F.col("vector").alias("w")).limit(most_tags + 1).collect()
    if len(few) > most_tags:
        raise ValueError(f"more than {most_tags} tags")
    table = df.sparkSession.createDataFrame(few, tags.select(tag, F.col("vector").alias("w")).schema).agg(F.collect_list(F.struct(tag, "w")).alias("tags"))
    rows = df.where(usable_vector(F.col(vector))).select(id, vector).join(F.broadcast(table), F.lit(True))  # one row of at most most_tags
    scored = rows.select(id, F.explode(F.transform("tags", lambda t: F.struct(t[tag].alias(tag), cosine(F.col(vector), t["w"]).alias("cosine")))).alias("t"))
    return scored.select(id, f"t.{tag}", "t.cosine").where("cosine IS NOT NULL")


def density_clusters(df: DataFrame, id: str, vector: str, *, least: float = 0.6, least_neighbours: int = 5, least_size: int = 10, neighbours: int = 30) -> DataFrame:
    """Rows (id, cluster): dense groups of vectors, named by their smallest id; null for noise.

    A vector with ``least_neighbours`` others of cosine ``least`` is a core. Cores that are among each other's
    ``neighbours`` most similar at that cosine belong together, all linked ones are a group, and a vector that is no core
    joins its most similar core. Groups under ``least_size`` are noise. Neighbours are found exactly, in blocks.
    """
    rows = df.where(usable_vector(F.col(vector)) & F.col(id).isNotNull()).select(F.col(id).alias("id"), F.col(vector).alias("v"))
    near = cosine_top_k_each(rows, "id", "v", rows.select(F.col("id").alias("q_id"), F.col("v").alias("q")), "q_id", "q", neighbours, apart=("q_id", "id"))
    near = cut_lineage(near.where(F.col("cosine") >= least).select("q_id", "id", "cosine"))
    core = near.groupBy("q_id").agg(F.count("*").alias("n")).where(F.col("n") >= least_neighbours).select(F.col("q_id").alias("core"))
    links = near.join(core, near["q_id"] == core["core"], "left_semi").join(core.withColumnRenamed("core", "c2"), F.col("id") == F.col("c2"), "left_semi")
    groups = cut_lineage(components(links.union(core.select("core", "core", F.lit(1.0))), "q_id", "id"))
    edge = near.join(core, near["q_id"] == core["core"], "left_anti").join(groups.withColumnRenamed("id", "g"), F.col("id") == F.col("g"))
    edge = edge.groupBy("q_id").agg(F.max_by("component", F.struct("cosine", "component")).alias("component")).select(F.col("q_id").alias("id"), "component")
    every = groups.select("id", "component").union(edge)
    big = every.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") >= least_size).select("component")
    return rows.select("id").join(every.join(big, "component", "left_semi"), "id", "left").select(F.col("id").alias(id), F.col("component").alias("cluster"))
