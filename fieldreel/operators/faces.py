"""Persons by faces: appearance reports, exemplars and suggestions for clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldreel.functions.columns import cosine
from fieldreel.operators.ranking import top_k_per
from fieldreel.operators.similarity import agreement, centroids

#: Seconds between two sampled frames.
FRAME_SEC = 7


def by_person(faces: DataFrame, p_id: str, limit: int = 50) -> DataFrame:
    """Assets in which a person is seen, most frames first."""
    return faces.where(F.col("p_id") == p_id).groupBy("asset_id").agg(F.count("*").alias("n_faces")).orderBy(F.desc("n_faces"), "asset_id").limit(limit)


def co_appearance(faces: DataFrame, a: str, b: str) -> DataFrame:
    """Assets in which both are seen, with the frames of each."""
    count = lambda p, n: F.countDistinct(F.when(F.col("p_id") == p, F.struct("frame_idx"))).alias(n)
    return faces.where(F.col("p_id").isin(a, b)).groupBy("asset_id").agg(count(a, "n_a"), count(b, "n_b")).where("n_a > 0 AND n_b > 0")


def screen_time(faces: DataFrame) -> DataFrame:
    """Rows (p_id, minutes): distinct frames of each person times the frames' distance."""
    return faces.where("p_id IS NOT NULL").groupBy("p_id").agg((F.countDistinct("asset_id", "frame_idx") * FRAME_SEC / 60.0).alias("minutes"))


def alone(faces: DataFrame, p_id: str) -> DataFrame:
    """Assets in which a person is the only known one."""
    people = faces.where("p_id IS NOT NULL").groupBy("asset_id").agg(F.countDistinct("p_id").alias("n"), F.min("p_id").alias("only"))
    return people.where((F.col("n") == 1) & (F.col("only") == p_id)).select("asset_id")


def mine_exemplars(faces: DataFrame, tagged: DataFrame, *, least_score: float = 0.7, least_area: float = 1_600.0, k: int = 8) -> DataFrame:
    """Rows (p_id, face_pk, agreeing, rank): the k faces of each person that agree with most others, from assets tagged with one person.

    ``faces``: face_pk, asset_id, det_score, area, vector. ``tagged``: asset_id, p_id. Of equals the surer and larger face comes first.
    """
    single = tagged.where("p_id IS NOT NULL").groupBy("asset_id").agg(F.countDistinct("p_id").alias("n"), F.min("p_id").alias("p_id")).where("n = 1").select("asset_id", "p_id")
    good = faces.where((F.col("det_score") >= least_score) & (F.col("area") >= least_area)).join(single, "asset_id")
    found = agreement(good, "p_id", "face_pk", "vector").join(good.select("face_pk", (F.col("det_score") * F.sqrt("area")).alias("_q")), "face_pk")
    return top_k_per(found, ["p_id"], [F.desc("agreeing"), F.desc("_q"), F.col("face_pk")], k).drop("_q")


def suggest_labels(faces: DataFrame, *, least: float = 0.5, margin: float = 0.05) -> DataFrame:
    """Rows (cluster_id, p_id, cosine): for clusters without a person the person whose clusters are most alike.

    ``faces``: asset_id, cluster_id, p_id, vector. A person that already occurs in an asset of the cluster is passed
    over; the best must be ahead of the next person. Clusters meet by their centres, of which there are few.
    """
    label = faces.where("cluster_id IS NOT NULL").groupBy("cluster_id").agg(F.max("p_id").alias("p_id"))
    centre = centroids(faces, "cluster_id", "vector").join(label, "cluster_id").select("cluster_id", "vector", "p_id")
    named = centre.where("p_id IS NOT NULL").agg(F.collect_list(F.struct("p_id", "vector")).alias("named"))
    if centre.where("p_id IS NOT NULL").limit(10_001).count() > 10_000:
        raise ValueError("more than 10000 named clusters; use an index")
    asked = centre.where("p_id IS NULL").select("cluster_id", "vector").join(F.broadcast(named), F.lit(True))  # one row
    scored = asked.select("cluster_id", F.explode(F.transform("named", lambda n: F.struct(n["p_id"].alias("p_id"), cosine(F.col("vector"), n["vector"]).alias("c")))).alias("x")).groupBy("cluster_id", "x.p_id").agg(F.max("x.c").alias("cosine"))
    there = faces.where("cluster_id IS NOT NULL").select("cluster_id", "asset_id").distinct().join(faces.where("p_id IS NOT NULL").select("asset_id", "p_id").distinct(), "asset_id").select("cluster_id", "p_id").distinct()
    free = scored.join(there, ["cluster_id", "p_id"], "left_anti").where("cosine IS NOT NULL")
    best = top_k_per(free, ["cluster_id"], [F.desc("cosine"), F.col("p_id")], 2)
    both = best.groupBy("cluster_id").agg(F.max(F.when(F.col("rank") == 1, F.struct("cosine", "p_id"))).alias("b"), F.max(F.when(F.col("rank") == 2, F.col("cosine"))).alias("second"))
    return both.where((F.col("b.cosine") >= least) & (F.col("second").isNull() | (F.col("b.cosine") - F.col("second") >= margin))).select("cluster_id", "b.p_id", "b.cosine")
