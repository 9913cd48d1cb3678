"""Merging, clustering, subtracting and layering of intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldreel.operators.intervals import periods_and_gaps
from fieldreel.operators.joins import interval_join
from fieldreel.session import steady


def merge_hits(df: DataFrame, entity: str, start: str, end: str, value: str, *, pad: float = 0.0, gap: float = 0.0) -> DataFrame:
    """Rows (entity, start, end, score, n): hits padded on both sides, not below 0, merged while one starts at most ``gap`` after the running end; values are summed."""
    rows = df.select(F.col(entity).alias("entity"), F.greatest(F.lit(0.0), F.col(start) - pad).alias("s"), (F.col(end) + pad).alias("e"), F.col(value).alias("v")).dropna(subset=["entity", "s", "e"])
    w = Window.partitionBy("entity").orderBy("s", "e")
    reach = F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("opens", F.when(reach.isNull() | (F.col("s") > reach + gap), 1).otherwise(0)).withColumn("island", F.sum("opens").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy("entity", "island").agg(F.min("s").alias("start"), F.max("e").alias("end"), F.sum("v").alias("score"), F.count("*").alias("n")).drop("island")


def sessions(df: DataFrame, entity: str, at: str, gap_us: int) -> DataFrame:
    """Rows (entity, session_start, session_end, n): moments at most ``gap_us`` after the one before belong together."""
    us = F.unix_micros(F.col(at).cast("timestamp"))
    w = Window.partitionBy(entity).orderBy(at)
    opens = F.coalesce((us - F.lag(us).over(w) > gap_us).cast("int"), F.lit(1))
    rows = df.where(F.col(at).isNotNull()).withColumn("_o", opens).withColumn("_k", F.sum("_o").over(w.rangeBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(entity, "_k").agg(F.min(at).alias("session_start"), F.max(at).alias("session_end"), F.count("*").alias("n")).drop("_k")


def cluster_by_gap(df: DataFrame, entity: str, start: str, end: str, gap: float, out: str = "run") -> DataFrame:
    """``df`` with the number of its run: a row opens a run if it starts more than ``gap`` after the end of the row just before it, not of the longest so far."""
    w = Window.partitionBy(entity).orderBy(start, end)
    opens = F.coalesce((F.col(start) > F.lag(end).over(w) + gap).cast("int"), F.lit(1))
    return df.withColumn("_o", opens).withColumn(out, F.sum("_o").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_o")


def uncovered(frames: DataFrame, df: DataFrame, key: str, frame: tuple[str, str], span: tuple[str, str]) -> DataFrame:
    """Rows (key, start, end): parts of each key's frame that none of its spans covers, edges included. Bounds are whole numbers."""
    steady(df.sparkSession)
    bounds = frames.select(F.col(key).alias("entity"), F.col(frame[0]).alias("f0"), F.col(frame[1]).alias("f1")).dropna().where("f0 < f1")
    inside = df.join(bounds, df[key] == bounds["entity"]).select("entity", F.greatest(F.col(span[0]), F.col("f0")).alias("s"), F.least(F.col(span[1]), F.col("f1")).alias("e"))
    periods = periods_and_gaps(inside, "entity", F.col("s"), F.col("e")).where("kind = 'period'").select("entity", F.col("start").alias("s"), F.col("end").alias("e"))
    ends = bounds.select("entity", F.col("f0").alias("s"), F.col("f0").alias("e")).union(bounds.select("entity", F.col("f1").alias("s"), F.col("f1").alias("e")))
    w = Window.partitionBy("entity").orderBy("s", "e")
    gaps = periods.union(ends).withColumn("reach", F.max("e").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    return gaps.where("s > reach").select(F.col("entity").alias(key), F.col("reach").alias("start"), F.col("s").alias("end"))


def subtract(df: DataFrame, holes: DataFrame, key: str, span: tuple[str, str], hole: tuple[str, str], least: int = 1) -> DataFrame:
    """Rows (key, start, end): merged spans without the holes, if at least ``least`` long. Bounds are whole numbers."""
    steady(df.sparkSession)
    own = periods_and_gaps(df, key, F.col(span[0]), F.col(span[1])).where("kind = 'period'").select(F.col("entity"), F.col("start").alias("s"), F.col("end").alias("e"))
    cut = periods_and_gaps(holes, key, F.col(hole[0]), F.col(hole[1])).where("kind = 'period'").select(F.col("entity"), F.col("start").alias("s"), F.col("end").alias("e"))
    # a boundary sweep: what is inside a span and in no hole between neighbouring boundaries
    marks = own.select("entity", F.explode(F.array(F.struct(F.col("s").alias("t"), F.lit(1).alias("i"), F.lit(0).alias("o")), F.struct(F.col("e").alias("t"), F.lit(-1).alias("i"), F.lit(0).alias("o")))).alias("m"))
    marks = marks.union(cut.select("entity", F.explode(F.array(F.struct(F.col("s").alias("t"), F.lit(0).alias("i"), F.lit(1).alias("o")), F.struct(F.col("e").alias("t"), F.lit(0).alias("i"), F.lit(-1).alias("o")))).alias("m")))
    marks = marks.groupBy("entity", "m.t").agg(F.sum("m.i").alias("i"), F.sum("m.o").alias("o"))
    w = Window.partitionBy("entity").orderBy("t")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    parts = marks.withColumn("inside", F.sum("i").over(upto)).withColumn("outside", F.sum("o").over(upto)).withColumn("next", F.lead("t").over(w))
    return parts.where((F.col("inside") > 0) & (F.col("outside") == 0) & (F.col("next") - F.col("t") >= least)).select(F.col("entity").alias(key), F.col("t").alias("start"), F.col("next").alias("end"))


def visible_layers(df: DataFrame, entity: str, start: str, end: str, layer: Column, label: str, *, width: float) -> DataFrame:
    """Rows (entity, label, start, end): between neighbouring boundaries the label of the highest layer that covers; neighbours of one label joined."""
    rows = df.where(F.col(start) < F.col(end)).select(F.col(entity).alias("entity"), F.col(start).alias("s"), F.col(end).alias("e"), layer.alias("layer"), F.col(label).alias("label"))
    cuts = rows.select("entity", F.explode(F.array("s", "e")).alias("t")).distinct()
    w = Window.partitionBy("entity").orderBy("t")
    parts = cuts.withColumn("u", F.lead("t").over(w)).where("u IS NOT NULL")
    shown = interval_join(parts, rows, "entity", ("t", "u"), ("s", "e"), width=width, half_open=True)
    top = shown.groupBy("entity", "t", "u").agg(F.max_by("label", F.struct("layer", "label")).alias("label"))
    new = F.coalesce(((F.lag("label").over(w) != F.col("label")) | (F.lag("u").over(w) != F.col("t"))).cast("int"), F.lit(1))
    runs = top.withColumn("o", new).withColumn("k", F.sum("o").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("entity", "k").agg(F.first("label").alias("label"), F.min("t").alias("start"), F.max("u").alias("end")).drop("k")


def collapse_stereo(df: DataFrame, key: list[str], track: str) -> DataFrame:
    """Rows of which the one before, of the same key, lies on the track just above are dropped, pair by pair."""
    w = Window.partitionBy(*key).orderBy(track)
    runs = df.withColumn("_g", F.col(track) - F.row_number().over(w))
    place = F.row_number().over(Window.partitionBy(*key, "_g").orderBy(track))
    return runs.withColumn("_p", place).where("_p % 2 = 1").drop("_g", "_p")
