"""Speakers by overlap: votes, gates, time offsets and propagation between linked transcripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldreel.functions.columns import overlap
from fieldreel.functions.python import ratio
from fieldreel.operators.joins import interval_join
from fieldreel.operators.ranking import margin_gate, top_k_per

WIDTH = 60.0


def majority_speaker(windows: DataFrame, segments: DataFrame) -> DataFrame:
    """Rows (id, speaker, seconds): for each window (id, asset_id, start, end) the speaker heard longest, the smallest of equals. ``segments``: asset_id, s, e, speaker."""
    met = interval_join(windows.select("id", "asset_id", "start", "end"), segments.where("speaker IS NOT NULL"), "asset_id", ("start", "end"), ("s", "e"), width=WIDTH, half_open=True)
    sums = met.groupBy("id", "speaker").agg(F.sum(overlap(F.col("start"), F.col("end"), F.col("s"), F.col("e"))).alias("seconds"))
    return top_k_per(sums, ["id"], [F.desc("seconds"), F.col("speaker")], 1).select("id", "speaker", "seconds")


def split_votes(human: DataFrame, machine: DataFrame, persons: str, weights: Column) -> DataFrame:
    """Rows (asset_id, cluster, p_id, seconds): seconds that labelled spans share with clusters, divided among the label's persons by weight.

    ``human``: asset_id, start, end, an array column ``persons``. ``machine``: asset_id, s, e, cluster. ``weights`` is an
    array of the same length; weights that are all zero count as equal.
    """
    total = F.aggregate("_w", F.lit(0.0), lambda s, x: s + x)
    rows = human.withColumn("_w", weights).withColumn("_t", total)
    rows = rows.select("asset_id", "start", "end", F.explode(F.arrays_zip(F.col(persons).alias("p"), F.col("_w").alias("w"))).alias("x"), "_t", F.size(persons).alias("_n"))
    rows = rows.select("asset_id", "start", "end", F.col("x.p").alias("p_id"), F.when(F.col("_t") > 0, F.col("x.w") / F.col("_t")).otherwise(1 / F.col("_n")).alias("share"))
    met = interval_join(rows, machine, "asset_id", ("start", "end"), ("s", "e"), width=WIDTH, half_open=True)
    return met.groupBy("asset_id", "cluster", "p_id").agg(F.sum(F.col("share") * overlap(F.col("start"), F.col("end"), F.col("s"), F.col("e"))).alias("seconds"))


def map_clusters(votes: DataFrame, *, support: float = 20.0, lead: float = 10.0, times: float = 1.8, one_each: bool = False) -> DataFrame:
    """Rows (asset_id, cluster, p_id, seconds) of clusters whose best person has the support, the lead and the ratio over the next; ties map nothing. ``one_each`` keeps a person's best cluster only."""
    best = margin_gate(votes, ["asset_id", "cluster"], "seconds", [F.col("p_id")], support, 0.0)
    second = F.coalesce("runner_up", F.lit(0.0))
    good = best.where(F.col("passed") & (F.col("seconds") > second) & (F.col("seconds") - second >= lead) & (F.col("seconds") >= times * second)).select("asset_id", "cluster", "p_id", "seconds")
    return top_k_per(good, ["asset_id", "p_id"], [F.desc("seconds"), F.col("cluster")], 1).drop("rank") if one_each else good


def time_offsets(receiver: DataFrame, donor: DataFrame, *, reach: int = 24, step: int = 2, least: float = 0.72) -> DataFrame:
    """Rows (pair, offset): for each pair the shift of the donor that lets most alike speech overlap; 0 if none does.

    ``receiver``: pair, r_id, start, end, text. ``donor``: pair, s, e, said. Shifts are tried from -reach to reach; of
    equals the first is kept. Segments meet by stretches of time for every shift.
    """
    shifted = donor.withColumn("offset", F.explode(F.sequence(F.lit(-reach), F.lit(reach), F.lit(step)))).select(F.struct("pair", "offset").alias("k"), (F.col("s") + F.col("offset")).alias("s"), (F.col("e") + F.col("offset")).alias("e"), "said")
    mine = receiver.withColumn("offset", F.explode(F.sequence(F.lit(-reach), F.lit(reach), F.lit(step)))).select(F.struct("pair", "offset").alias("k"), "r_id", "start", "end", "text")
    met = interval_join(mine, shifted, "k", ("start", "end"), ("s", "e"), width=WIDTH, half_open=True).withColumn("like", ratio("text", "said")).where(F.col("like") >= least)
    best = met.groupBy("k", "r_id").agg(F.max(F.col("like") * overlap(F.col("start"), F.col("end"), F.col("s"), F.col("e"))).alias("v"))
    sums = best.groupBy("k").agg(F.sum("v").alias("v")).select("k.pair", "k.offset", "v")
    found = top_k_per(sums.where("v > 0"), ["pair"], [F.desc("v"), F.col("offset")], 1).select("pair", "offset")
    return receiver.select("pair").distinct().join(found, "pair", "left").select("pair", F.coalesce("offset", F.lit(0)).alias("offset"))


def propagate(receiver: DataFrame, donor: DataFrame, offsets: DataFrame, *, least: float = 0.82, margin: float = 0.04) -> DataFrame:
    """Rows (pair, r_id, p_id, likeness): persons of the donor's most alike overlapping speech, if alike enough and ahead of other persons. ``donor`` has p_id too."""
    moved = donor.where("p_id IS NOT NULL").join(offsets, "pair").select("pair", (F.col("s") + F.col("offset")).alias("s"), (F.col("e") + F.col("offset")).alias("e"), "said", "p_id")
    met = interval_join(receiver.select("pair", "r_id", "start", "end", "text"), moved, "pair", ("start", "end"), ("s", "e"), width=WIDTH, half_open=True)
    by_person = met.withColumn("likeness", ratio("text", "said")).groupBy("pair", "r_id", "p_id").agg(F.max("likeness").alias("likeness"))
    return margin_gate(by_person, ["pair", "r_id"], "likeness", [F.col("p_id")], least, margin).where("passed").select("pair", "r_id", "p_id", "likeness")
