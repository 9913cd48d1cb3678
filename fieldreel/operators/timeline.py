"""Clips on a timeline: chunks under them, linked starts, speech and track shares, cuts inside words."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldreel.functions.columns import overlap
from fieldreel.operators.joins import interval_join
from fieldreel.operators.ranking import top_k_per

WIDTH = 60.0


def best_chunk(clips: DataFrame, chunks: DataFrame) -> DataFrame:
    """Rows (id, chunk_id, how): the chunk of the asset that a clip overlaps most, else that whose edge is nearest to the clip's middle; the smallest id of equals.

    ``clips``: id, asset_id, start, end. ``chunks``: asset_id, chunk_id, s, e.
    """
    met = interval_join(clips.select("id", "asset_id", "start", "end"), chunks, "asset_id", ("start", "end"), ("s", "e"), width=WIDTH, half_open=True)
    over = top_k_per(met.withColumn("v", overlap(F.col("start"), F.col("end"), F.col("s"), F.col("e"))), ["id"], [F.desc("v"), F.col("chunk_id")], 1).select("id", "chunk_id", F.lit("overlap").alias("how"))
    rest = clips.join(over.select("id"), "id", "left_anti").withColumn("m", (F.col("start") + F.col("end")) / 2)
    near = rest.join(chunks, "asset_id").withColumn("d", F.least(F.abs(F.col("s") - F.col("m")), F.abs(F.col("e") - F.col("m"))))
    near = near.groupBy("id").agg(F.min(F.struct("d", "chunk_id")).alias("b")).select("id", "b.chunk_id", F.lit("nearest").alias("how"))
    return over.union(near)


def resolve_starts(clips: DataFrame) -> DataFrame:
    """``clips`` (sequence, clip_id, track, start, links) with start_resolved: a start of -1 takes that of the first linked clip on V1 that has one."""
    asked = clips.where("start = -1").select("sequence", "clip_id", F.posexplode("links").alias("n", "to"))
    known = clips.where("start <> -1 AND track = 'V1'").select("sequence", F.col("clip_id").alias("to"), F.col("start").alias("s"))
    found = asked.join(known, ["sequence", "to"]).groupBy("sequence", "clip_id").agg(F.min_by("s", "n").alias("s"))
    return clips.join(found, ["sequence", "clip_id"], "left").withColumn("start_resolved", F.when(F.col("start") == -1, F.col("s")).otherwise(F.col("start"))).drop("s")


def speech_seconds(clips: DataFrame, segments: DataFrame) -> DataFrame:
    """Rows (id, p_id, seconds): speech of each person within a clip; those without an id together as null. ``segments``: asset_id, s, e, p_id."""
    met = interval_join(clips.select("id", "asset_id", "start", "end"), segments, "asset_id", ("start", "end"), ("s", "e"), width=WIDTH, half_open=True)
    return met.groupBy("id", "p_id").agg(F.sum(overlap(F.col("start"), F.col("end"), F.col("s"), F.col("e"))).alias("seconds"))


def shares(df: DataFrame, scene: str, who: str, seconds: str, dominant: float = 0.30) -> DataFrame:
    """Rows (scene, who, seconds, share, rank, dominant) of named shares: dominant is the first, and all from the bound on."""
    rows = df.where(F.col(who).isNotNull()).groupBy(scene, who).agg(F.sum(seconds).alias("seconds"))
    total = rows.groupBy(scene).agg(F.sum("seconds").alias("_t"))
    rows = rows.join(total, scene).withColumn("share", F.when(F.col("_t") > 0, F.col("seconds") / F.col("_t")).otherwise(F.lit(0.0))).drop("_t")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(scene).orderBy(F.desc("seconds"), F.col(who))))
    return ranked.withColumn("dominant", (F.col("rank") == 1) | (F.col("share") >= dominant))


def cuts_inside_words(cuts: DataFrame, words: DataFrame, margin: float = 0.12) -> DataFrame:
    """Rows (id, word, s, e): cuts (id, asset_id, at) that fall inside a word (asset_id, s, e, word), more than the margin from both of its ends."""
    points = cuts.select("id", "asset_id", F.col("at").alias("_a"), F.col("at").alias("_b"))
    met = interval_join(points, words, "asset_id", ("_a", "_b"), ("s", "e"), width=WIDTH)
    return met.where((F.col("_a") > F.col("s") + margin) & (F.col("_a") < F.col("e") - margin)).select("id", "word", "s", "e")


def timeline_members(rows: DataFrame, beats: DataFrame, sequence: str = "sequence") -> DataFrame:
    """Rows joined with the beat (sequence, beat, s, e) in which they start: s <= start < e."""
    points = rows.withColumn("_a", F.col("start")).withColumn("_b", F.col("start"))
    return interval_join(points, beats, sequence, ("_a", "_b"), ("s", "e"), width=1_000.0).where("start < e").drop("_a", "_b")
