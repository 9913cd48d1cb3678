"""Coverage, consistency and status checks over the flat tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldreel.operators.ranking import index_percentiles


def coverage(assets: DataFrame, layers: dict[str, DataFrame], missing_from: int = 2) -> DataFrame:
    """Rows (asset_id, present, missing, incomplete): layers that hold each asset, sorted, and whether ``missing_from`` or more lack."""
    rows = None
    for name, df in layers.items():
        part = df.select("asset_id").distinct().withColumn("layer", F.lit(name))
        rows = part if rows is None else rows.union(part)
    held = rows.groupBy("asset_id").agg(F.array_sort(F.collect_set("layer")).alias("present"))
    every = F.array(*map(F.lit, sorted(layers)))
    out = assets.select("asset_id").distinct().join(held, "asset_id", "left").withColumn("present", F.coalesce("present", F.array().cast("array<string>")))
    return out.withColumn("missing", F.array_except(every, F.col("present"))).withColumn("incomplete", F.size("missing") >= missing_from)


def boundary_distance(starts: DataFrame, boundaries: DataFrame) -> DataFrame:
    """Share of starts and their median and 90 % distances (by index) to the nearest boundary of the asset: rows (asset_id, id, distance)."""
    from fieldreel.operators.joins import nearest

    near = nearest(starts, boundaries.select("asset_id", F.col("at").alias("_b")).withColumn("_i", F.lit(0)), "asset_id", "at", "id", "_b", id="_i", width=600.0)
    return near.select("asset_id", "id", F.abs(F.col("nearest.moment") - F.col("at")).alias("distance"))


def distance_summary(distances: DataFrame, within: float = 0.5) -> DataFrame:
    tables = distances.where("distance IS NOT NULL").withColumn("_all", F.lit(1))
    return index_percentiles(tables, ["_all"], "distance", {"p50": 0.5, "p90": 0.9}).join(tables.groupBy("_all").agg(F.count("*").alias("n"), F.avg((F.col("distance") <= within).cast("double")).alias("share_within")), "_all").drop("_all")


def dominance(df: DataFrame, entity: str, value: str, weak_below: float = 0.6) -> DataFrame:
    """Rows (entity, top, top_n, total, share, weak): each entity's most frequent value, the smallest of equals."""
    counts = df.where(F.col(value).isNotNull()).groupBy(entity, value).agg(F.count("*").alias("n"))
    best = counts.groupBy(entity).agg(F.min(F.struct((-F.col("n")).alias("neg"), F.col(value).alias("v"))).alias("b"), F.sum("n").alias("total"))
    return best.select(entity, F.col("b.v").alias("top"), (-F.col("b.neg")).alias("top_n"), "total", (-F.col("b.neg") / F.col("total")).alias("share"), (-F.col("b.neg") / F.col("total") < weak_below).alias("weak"))


def contradictions(df: DataFrame, checks: dict[str, Column], id: str) -> DataFrame:
    """Rows (id, check) for each named condition that a row meets."""
    hit = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in sorted(checks.items()))))
    return df.select(id, F.explode(hit).alias("check"))


def status(df: DataFrame, flags: list[str], by: list[str]) -> DataFrame:
    """Rows (by.., n, and sum and percentage of each flag)."""
    parts = [F.count("*").alias("n")]
    for f in flags:
        parts += [F.coalesce(F.sum(F.col(f).cast("int")), F.lit(0)).alias(f), F.round(100.0 * F.coalesce(F.sum(F.col(f).cast("int")), F.lit(0)) / F.count("*"), 1).alias(f"{f}_pct")]
    return df.groupBy(*by).agg(*parts)


def confusion(df: DataFrame, true: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(true).alias("true"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def threshold_sweep(df: DataFrame, value: str, truth: Column, thresholds: list[float]) -> DataFrame:
    """Rows (threshold, tp, fp, fn, tn) if rows with a value of at least the threshold are taken as true; all from one pass."""
    v = F.coalesce(F.col(value), F.lit(float("-inf")))
    aggs = [F.struct(F.lit(t).alias("threshold"), *(F.sum(((v >= t) == p).cast("int") * (truth == a).cast("int")).alias(n) for n, p, a in (("tp", True, True), ("fp", True, False), ("fn", False, True), ("tn", False, False)))) for t in thresholds]
    return df.agg(F.array(*aggs).alias("r")).select(F.inline("r"))


def key_problems(df: DataFrame, key: list[str], out: str = "n") -> DataFrame:
    """Rows (key.., out) of keys that occur more than once or hold a null, with their number."""
    counts = df.groupBy(*key).agg(F.count("*").alias("_count"))
    null = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in key))
    return counts.where((F.col("_count") > 1) | null).withColumnRenamed("_count", out)


def validate(df: DataFrame, id: str, rules: dict[str, tuple[str, Column]]) -> DataFrame:
    """Rows (id, rule, severity) of rules that a row breaks; a rule that gives null is broken."""
    found = F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.struct(F.lit(name).alias("rule"), F.lit(severity).alias("severity"))) for name, (severity, ok) in rules.items())))
    return df.select(id, F.inline(found))


def media_stats(asset: DataFrame) -> DataFrame:
    """Rows (record_kind, n, hours, gigabytes)."""
    return asset.groupBy("record_kind").agg(F.count("*").alias("n"), F.round(F.coalesce(F.sum("duration_sec"), F.lit(0.0)) / 3_600, 2).alias("hours"), F.round(F.coalesce(F.sum("filesize_bytes"), F.lit(0)) / (1 << 30), 2).alias("gigabytes"))
