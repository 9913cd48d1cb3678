"""Splitting oversized items at natural boundaries with overlap."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Boundaries are looked up by stretches of this length, so an item meets only the boundaries near it. Items of more
#: than SPREAD stretches are looked up by stretches SPREAD times as long, and so on.
STRETCH_MS = 60_000
SPREAD = 64
#: Runs are a table of parameters; more than this is an error, not a silent cut.
MOST_RUNS = 10_000


def whole_ms(seconds: Column) -> Column:
    """Milliseconds of seconds with at most three decimals; null for null, NaN and infinite values."""
    return F.when((F.abs(seconds) < 1e12) & ~F.isnan(seconds), F.round(seconds * 1000).cast("bigint"))


def cut_points(start: int, end: int, window: int, overlap: int, ends: np.ndarray) -> list[tuple[int, int]]:
    """Pieces of start..end within the window; ``ends`` are the natural boundaries, ascending."""
    pieces, at = [], start
    while end - at > window:
        k = int(np.searchsorted(ends, at + window, "right")) - 1
        cut = int(ends[k]) if k >= 0 and ends[k] > at + overlap else at + window
        pieces.append((at, cut))
        at = cut - overlap
    return [*pieces, (at, end)]


def bisected(start: int, end: int, window: int, overlap: int, ends: np.ndarray, strength: np.ndarray) -> list[tuple[int, int]]:
    """Pieces of start..end within the window, by recursive bisection: each cut is the strongest boundary in the middle half, of equals the one nearest the midpoint, then the earlier; the midpoint if there is none. Overlaps are attached last."""
    cuts, todo = [], [(start, end)]
    while todo:
        a, b = todo.pop()
        if b - a <= window - overlap:
            continue
        lo, hi = np.searchsorted(ends, a + (b - a) // 4, "left"), np.searchsorted(ends, b - (b - a) // 4, "right")
        inside = np.arange(lo, hi)[(ends[lo:hi] > a) & (ends[lo:hi] < b)]
        cut = int(ends[min(inside, key=lambda k: (-strength[k], abs(2 * int(ends[k]) - a - b), k))]) if inside.size else a + (b - a) // 2
        cuts.append(cut)
        todo += [(a, cut), (cut, b)]
    edges = [start, *sorted(cuts), end]
    return [(a if k == 0 else max(start, a - overlap), b) for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True))]


def _usable_runs(runs: DataFrame) -> list[tuple]:
    found = runs.select("run_id", whole_ms(F.col("window_sec")).alias("w"), whole_ms(F.col("overlap_sec")).alias("o")).distinct().limit(MOST_RUNS + 1).collect()
    usable = [(r.run_id, r.w, r.o) for r in found if r.w is not None and r.o is not None and 0 <= r.o < r.w and r.run_id is not None]
    if len(found) > MOST_RUNS:
        raise ValueError(f"more than {MOST_RUNS} runs")
    return usable


def _split(chunks: DataFrame, boundaries: DataFrame, runs: DataFrame, cut: Callable[..., list[tuple[int, int]]]) -> DataFrame:
    usable = _usable_runs(runs)
    kind = runs.schema["run_id"].dataType
    schema = f"run_id {kind.simpleString()}, chunk_id {chunks.schema['chunk_id'].dataType.simpleString()}, piece_idx int, start_ms bigint, end_ms bigint"
    if not usable:
        return chunks.sparkSession.createDataFrame([], schema)
    items = chunks.select("chunk_id", F.col("parent_asset_id").alias("asset"), whole_ms(F.col("chunk_start_sec")).alias("start"), whole_ms(F.col("chunk_end_sec")).alias("end"))
    items = items.where(F.col("end") - F.col("start") > min(w for _, w, _ in usable)).distinct()
    stretches = F.greatest((F.col("end") - F.col("start")) / STRETCH_MS, F.lit(1.0))
    items = items.withColumn("level", F.greatest(F.lit(0), F.ceil(F.log(stretches) / F.log(F.lit(float(SPREAD)))) - 1).cast("int"))
    levels = sorted(r.level for r in items.select("level").distinct().collect())  # a handful, whatever the items
    width = lambda level: F.lit(STRETCH_MS).cast("bigint") * F.pow(F.lit(float(SPREAD)), level).cast("bigint")
    stretch = lambda c, level: F.floor(c / width(level)).cast("bigint")
    marks = boundaries.select(F.col("asset_id").alias("asset"), whole_ms(F.col("end_sec")).alias("mark")).dropna().groupBy("asset", "mark").agg(F.count("*").alias("strength"))
    marks = marks.withColumn("level", F.explode(F.array(*map(F.lit, levels or [0])))).withColumn("stretch", stretch(F.col("mark"), F.col("level")))
    spread = items.where("asset IS NOT NULL").withColumn("stretch", F.explode(F.sequence(stretch(F.col("start"), F.col("level")), stretch(F.col("end"), F.col("level")))))
    met = spread.join(marks, ["asset", "level", "stretch"]).where("mark > start AND mark < end")
    met = met.groupBy("chunk_id", "start", "end", "asset").agg(F.array_sort(F.collect_list(F.struct("mark", "strength"))).alias("marks"))
    jobs = items.drop("level").join(met, ["chunk_id", "start", "end", "asset"], "left").select("chunk_id", "start", "end", F.col("marks.mark").alias("ends"), F.col("marks.strength").alias("strength"))
    table = F.array(*(F.struct(F.lit(i).cast(kind).alias("run_id"), F.lit(w).cast("bigint").alias("window"), F.lit(o).cast("bigint").alias("overlap")) for i, w, o in usable))
    jobs = jobs.withColumn("run", F.explode(table)).where(F.col("end") - F.col("start") > F.col("run.window"))

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for run, chunk, start, end, window, overlap, ends, strength in batch.itertuples(index=False, name=None):
                known = np.asarray(ends if ends is not None else [], dtype=np.int64)
                force = np.asarray(strength if strength is not None else [], dtype=np.int64)
                out += [(run, chunk, k, a, b) for k, (a, b) in enumerate(cut(start, end, window, overlap, known, force))]
            yield pd.DataFrame(out, columns=["run_id", "chunk_id", "piece_idx", "start_ms", "end_ms"])

    return jobs.select("run.run_id", "chunk_id", "start", "end", "run.window", "run.overlap", "ends", "strength").mapInPandas(pieces, schema)


def split_items(chunks: DataFrame, boundaries: DataFrame, runs: DataFrame) -> DataFrame:
    """Pieces (run_id, chunk_id, piece_idx, start_ms, end_ms) of all chunks longer than a run's window, cut from the front.

    ``chunks``: chunk_id, parent_asset_id, chunk_start_sec, chunk_end_sec. ``boundaries``: asset_id, end_sec.
    ``runs``: run_id, window_sec, overlap_sec. A piece ends at the latest boundary of the parent that lies after the
    overlap and within the window, else at the window's length; the next piece starts the overlap before that end.

    Chunks with a null, NaN or reversed bound, or no longer than the window, give no pieces. Runs with a null window
    or overlap, a negative overlap, or an overlap of the window's length or more are left out. A null parent has no
    boundaries. Repeated rows count once. Empty tables give no rows. Other columns are ignored.

    Boundaries reduce to distinct milliseconds per parent, and are met by stretch of a minute, for long items of an
    hour and so on: a hot parent spreads over as many keys as it has stretches, no item makes more than ``SPREAD`` + 1
    keys, and one item gathers at most its own length in milliseconds.
    """
    return _split(chunks, boundaries, runs, lambda a, b, w, o, ends, _: cut_points(a, b, w, o, ends))


def bisect_items(chunks: DataFrame, boundaries: DataFrame, runs: DataFrame) -> DataFrame:
    """Pieces as ``split_items`` gives them in form, but of even length, by recursive bisection (see ``bisected``).

    Each is within the window, each but the first begins the overlap before the end of the one before, and together
    they cover the chunk. A boundary is the stronger the more rows of the parent end there. Odd rows as in ``split_items``.
    """
    return _split(chunks, boundaries, runs, bisected)
