"""Structured Streaming counterparts of the windowed and ledger operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def tumbling_counts(df: DataFrame, at: str, by: list[str], length: str, late: str = "10 minutes") -> DataFrame:
    """Rows (by.., window_start, window_end, n) of fixed windows; works on batches and streams."""
    return _counts(df, F.window(at, length), at, by, late)


def sliding_counts(df: DataFrame, at: str, by: list[str], length: str, step: str, late: str = "10 minutes") -> DataFrame:
    return _counts(df, F.window(at, length, step), at, by, late)


def session_counts(df: DataFrame, at: str, by: list[str], gap: str, late: str = "10 minutes") -> DataFrame:
    """Sessions that end after a gap; the window ends a gap after its last event."""
    return _counts(df, F.session_window(at, gap), at, by, late)


def _counts(df: DataFrame, window, at: str, by: list[str], late: str) -> DataFrame:
    marked = df.withWatermark(at, late) if df.isStreaming else df
    out = marked.groupBy(window.alias("w"), *by).agg(F.count("*").alias("n"))
    return out.select(*by, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n")


def once_per_key(df: DataFrame, key: list[str], at: str, late: str = "1 hour") -> DataFrame:
    """Each key once within the watermark; batches keep one row per key."""
    return df.withWatermark(at, late).dropDuplicatesWithinWatermark(key) if df.isStreaming else df.dropDuplicates(key)


def append_journal(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a folder of files, exactly once, and stop when all that is there is read."""
    return df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def apply_batches(df: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Call ``work`` for each micro-batch; it must do no harm when a batch is repeated after a failure."""
    return df.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
