"""Row generators: one row to an array of windows or sample times, to be exploded."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _range(n: Column) -> Column:
    """0 .. n-1; empty for n < 1 or null."""
    return F.when(n >= 1, F.sequence(F.lit(0).cast("bigint"), (n - 1).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))


def sliding_windows(duration: Column, window: float, overlap: float) -> Column:
    """Array of structs (start, end) from 0; the first window that reaches the end is the last. Empty for no duration."""
    step = max(window - overlap, 1e-6)
    last = F.ceil(F.greatest(F.lit(0.0), duration - window) / step)
    some = F.when((duration > 0) & F.lit(window > 0), last + 1).otherwise(0)
    return F.transform(_range(some), lambda k: F.struct((k * step).alias("start"), F.least(k * step + window, duration).alias("end")))


def cadence(duration: Column, every: float) -> Column:
    """Times 0, every, 2*every .. below the duration, at least one."""
    return F.transform(_range(F.greatest(F.lit(1), F.ceil(F.coalesce(duration, F.lit(0.0)) / every))), lambda k: k * F.lit(every))


def text_sample_times(start: Column, end: Column) -> Column:
    """Middle of a shot; from 30 s also its quarters; from 120 s also every 30 s up to a second before the end. Rounded, ascending, distinct."""
    length = end - start
    quarters = F.when(length >= 30, F.array(start + length * 0.25, start + length * 0.75)).otherwise(F.array().cast("array<double>"))
    strides = F.filter(F.transform(_range(F.floor(length / 30) + 1), lambda k: start + k * F.lit(30.0)), lambda t: (t > start) & (t < end - 1))
    strides = F.when(length >= 120, strides).otherwise(F.array().cast("array<double>"))
    return F.array_sort(F.array_distinct(F.transform(F.concat(F.array(start + length / 2), quarters, strides), lambda t: F.bround(t, 2))))


def quality_sample_times(start: Column, end: Column) -> Column:
    length = end - start
    at = lambda *shares: F.array(*(start + length * s for s in shares))
    return F.when(length < 2, at(0.5)).when(length < 4, at(0.25, 0.75)).otherwise(at(0.10, 0.35, 0.65, 0.90))


def aesthetic_sample_times(start: Column, end: Column) -> Column:
    length = end - start
    at = lambda *shares: F.array(*(start + length * s for s in shares)) if shares else F.array().cast("array<double>")
    return F.when(length < 0.5, at()).when(length < 5, at(0.5)).otherwise(at(0.25, 0.5, 0.75))


def audio_window_centres(start: Column, end: Column) -> Column:
    """Middle of a shot of 2 s or more; from 30 s also every 15 s, but none within 7.5 s of the middle."""
    length, middle = end - start, (start + end) / 2
    strides = F.filter(F.transform(_range(F.floor(length / 15)), lambda k: start + 7.5 + k * F.lit(15.0)), lambda t: (F.abs(t - middle) > 7.5) & (t < end))
    return F.when(length >= 30, F.concat(F.array(middle), strides)).when(length >= 2, F.array(middle)).otherwise(F.array().cast("array<double>"))


def fixed_parts(duration: Column, limit: float = 3_300.0, part: float = 3_000.0) -> Column:
    """One part up to the limit, else parts of fixed length."""
    n = F.when(duration > limit, F.ceil(duration / part)).when(duration > 0, 1).otherwise(0)
    length = F.when(duration > limit, F.lit(part)).otherwise(duration)
    return F.transform(_range(n), lambda k: F.struct((k * length).alias("start"), F.least((k + 1) * length, duration).alias("end")))


def ripple(start: Column, end: Column, at: float, by: float) -> tuple[Column, Column]:
    """Start and end of a timeline row after ``by`` is inserted at ``at``; a bound of -1 stays, rows that straddle keep both."""
    later = F.when(start == -1, end >= at).otherwise(start >= at)
    move = lambda c: F.when(later & (c != -1), c + by).otherwise(c)
    return move(start), move(end)
