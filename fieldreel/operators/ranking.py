"""Ranks, margins, caps, budgets, samples and percentiles by index."""

from __future__ import annotations



import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldreel.session import steady


def top_k_per(df: DataFrame, by: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group, with their rank; Spark keeps k rows per group before the shuffle."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= k)


def margin_gate(df: DataFrame, by: list[str], value: str, ties: list[Column], least: float, margin: float) -> DataFrame:
    """The best row of each group with its runner-up's value, and ``passed``: best at least ``least`` and ahead by ``margin``. A group of one is ahead of nothing and passes by ``least`` alone."""
    best = top_k_per(df.where(F.col(value).isNotNull()), by, [F.col(value).desc(), *ties], 2, "_rank")
    w = Window.partitionBy(*by).orderBy("_rank")
    best = best.withColumn("runner_up", F.lead(value).over(w)).where("_rank = 1").drop("_rank")
    return best.withColumn("passed", (F.col(value) >= least) & (F.col("runner_up").isNull() | (F.col(value) - F.col("runner_up") >= margin)))


def diversify(df: DataFrame, group: str, order: list[Column], limit: int, share: int = 5, over_fetch: int | None = None) -> DataFrame:
    """The first ``limit`` rows in order with at most ceil(limit / share) per group; only the first ``over_fetch`` rows are looked at, if given."""
    rows = df.orderBy(*order).limit(over_fetch) if over_fetch else df
    return top_k_per(rows, [group], order, -(-limit // share), "_n").drop("_n").orderBy(*order).limit(limit)


def index_percentiles(df: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """For each group the value at place int(n * share) of the ascending order, counted from 0, not interpolated.

    Values are counted per group first; places come from running counts, so no group's values are gathered.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_c"))
    w = Window.partitionBy(*by).orderBy(value)
    counts = counts.withColumn("_upto", F.sum("_c").over(w)).withColumn("_n", F.sum("_c").over(Window.partitionBy(*by)))
    at = lambda s: F.least(F.floor(F.col("_n") * s), F.col("_n") - 1)
    return counts.groupBy(*by).agg(*(F.min(F.when(F.col("_upto") > at(s), F.col(value))).alias(name) for name, s in shares.items()))


def stratified_sample(df: DataFrame, stratum: str, id: str, n: int, seed: int = 0) -> DataFrame:
    """n rows of each stratum, chosen by a hash of the id; the same for every run and partitioning."""
    return top_k_per(df, [stratum], [F.xxhash64(F.lit(seed), F.col(id)), F.col(id)], n, "_n").drop("_n")


def spaced_sample(df: DataFrame, by: list[str], order: list[str], most: int) -> DataFrame:
    """At most ``most`` rows of each group, evenly spaced in its order, the first included."""
    w = Window.partitionBy(*by)
    rows = df.withColumn("_i", F.row_number().over(w.orderBy(*order)) - 1).withColumn("_n", F.count("*").over(w))
    bucket = lambda i: F.floor(i * most / F.greatest(F.col("_n"), F.lit(most)))
    return rows.where((F.col("_i") == 0) | (bucket(F.col("_i")) != bucket(F.col("_i") - 1))).drop("_i", "_n")


def greedy_budget(df: DataFrame, by: list[str], start: str, end: str, value: str, budget: float) -> DataFrame:
    """Rows taken by value per length, best first, while their lengths fit the group's budget; one that doesn't fit is passed over."""

    def pick(rows: pd.DataFrame) -> pd.DataFrame:
        length = (rows[end] - rows[start]).clip(lower=0)
        order = (rows[value] / length.clip(lower=1e-6)).sort_values(ascending=False, kind="stable").index
        total, kept = 0.0, []
        for i in order:
            if total + length[i] <= budget:
                total += length[i]
                kept.append(i)
        return rows.loc[sorted(kept, key=lambda i: (rows.at[i, start], i))]

    return df.groupBy(*by).applyInPandas(lambda rows: pick(rows.sort_values([start, end], kind="stable").reset_index(drop=True)), df.schema)


def greedy_chunks(df: DataFrame, by: str, start: str, end: str, text: str, most_chars: int = 520, most_sec: float = 75.0) -> DataFrame:
    """Rows (by, chunk_idx, start, end, text): non-blank texts joined in time order until characters or span would exceed the limits."""
    schema = f"{by} {df.schema[by].dataType.simpleString()}, chunk_idx int, start double, end double, text string"

    def chunk(rows: pd.DataFrame) -> pd.DataFrame:
        out: list[list] = []
        for s, e, t in rows.sort_values([start, end, text], kind="stable")[[start, end, text]].itertuples(index=False, name=None):
            if out and sum(map(len, out[-1][2])) + len(t) + 1 <= most_chars and e - out[-1][0] <= most_sec:
                out[-1][1] = e
                out[-1][2].append(t)
            else:
                out.append([s, e, [t]])
        return pd.DataFrame([(rows[by].iloc[0], k, s, e, " ".join(t)) for k, (s, e, t) in enumerate(out)], columns=[by, "chunk_idx", "start", "end", "text"])

    clean = df.select(by, F.col(start).cast("double"), F.col(end).cast("double"), F.trim(text).alias(text)).where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(text) != ""))
    return clean.groupBy(by).applyInPandas(chunk, schema)


def assign_ids(df: DataFrame, key: list[str], prefix: str, order: list[str], prior: DataFrame) -> DataFrame:
    """``df`` with clip_id: the id that ``prior`` (key.., prefix, number) has for the key, else the next free number of the prefix in order."""
    steady(df.sparkSession)
    known = df.join(prior.select(*key, F.col("number").alias("_known")), key, "left")
    taken = prior.select(prefix, "number").distinct()
    fresh = known.where("_known IS NULL").withColumn("_r", F.row_number().over(Window.partitionBy(prefix).orderBy(*order)))
    # the r-th free number is r plus the taken numbers below it
    gaps = taken.withColumn("_free_below", F.col("number") - F.row_number().over(Window.partitionBy(prefix).orderBy("number")))
    shift = fresh.join(gaps.select(prefix, "_free_below"), prefix, "left").groupBy(prefix, "_r").agg(F.count(F.when(F.col("_free_below") < F.col("_r"), 1)).alias("_s"))
    fresh = fresh.join(shift, [prefix, "_r"]).withColumn("_number", F.col("_r") + F.col("_s")).drop("_r", "_s")
    both = fresh.unionByName(known.where("_known IS NOT NULL").withColumn("_number", F.col("_known").cast("bigint")))
    return both.withColumn("clip_id", F.concat_ws("_", F.col(prefix), F.lpad(F.col("_number").cast("string"), 3, "0"))).drop("_known", "_number")


