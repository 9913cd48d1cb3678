"""Figures of sound samples and frames, dates and places of recordings, and text rules of the timeline."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldreel.functions.columns import colon_day, usable_day

FLOOR_DB = -120.0


def decibels(value: Column) -> Column:
    """Decibels of full scale of an amplitude; -120 at least."""
    return F.when(value > 0, F.greatest(F.lit(FLOOR_DB), 20 * F.log10(value))).otherwise(F.lit(FLOOR_DB))


@F.pandas_udf(T.DoubleType())
def low_band_share(samples: pd.Series, rate: pd.Series) -> pd.Series:
    """Share of a recording's energy below 80 Hz; 0 for silence, null for null or empty."""

    def share(x: np.ndarray | None, hz: float | None) -> float | None:
        if x is None or hz is None or not len(x):
            return None
        power = np.abs(np.fft.rfft(np.asarray(x, dtype=float))) ** 2
        total = power[1:].sum()
        return float(power[1:][np.fft.rfftfreq(len(x), 1 / hz)[1:] < 80].sum() / total) if total > 0 else 0.0

    return pd.Series([share(x, hz) for x, hz in zip(samples, rate, strict=True)])


def sound_metrics(samples: Column, rate: Column) -> Column:
    """Struct of rms_dbfs, peak_dbfs, clipping_ratio, silence_ratio, dc_offset, low_freq_ratio of samples from -1 to 1; null for none."""
    n = F.size(samples)
    total = lambda f: F.aggregate(samples, F.lit(0.0), lambda s, x: s + f(x.cast("double")))
    count = lambda f: F.size(F.filter(samples, f)) / n
    return F.when(n > 0, F.struct(
        decibels(F.sqrt(total(lambda x: x * x) / n)).alias("rms_dbfs"), decibels(F.array_max(F.transform(samples, F.abs)).cast("double")).alias("peak_dbfs"), count(lambda x: F.abs(x) >= 0.99).alias("clipping_ratio"),
        count(lambda x: F.abs(x) < 0.001).alias("silence_ratio"), (total(lambda x: x) / n).alias("dc_offset"), low_band_share(samples, rate).alias("low_freq_ratio"),
    ))


@F.pandas_udf(T.StructType([T.StructField(n, T.DoubleType()) for n in ("sharpness", "exposure_mean", "clipping_ratio")]))
def frame_metrics(pixels: pd.Series, width: pd.Series) -> pd.DataFrame:
    """Variance of the Laplacian, mean brightness and share of pixels at 5 or less or 250 or more of grey frames given row by row."""

    def of(p: np.ndarray | None, w: float | None) -> tuple[float | None, ...]:
        if p is None or not w or w < 3 or len(p) < 3 * w:
            return None, None, None
        x = np.asarray(p, dtype=float)[: len(p) // int(w) * int(w)].reshape(-1, int(w))
        inner = x[:-2, 1:-1] + x[2:, 1:-1] + x[1:-1, :-2] + x[1:-1, 2:] - 4 * x[1:-1, 1:-1]
        return float(inner.var()), float(x.mean()), float(((x <= 5) | (x >= 250)).mean())

    return pd.DataFrame([of(p, w) for p, w in zip(pixels, width, strict=True)], columns=["sharpness", "exposure_mean", "clipping_ratio"])


def primary_date(folder_day: Column, camera_time: Column, camera_first: Column) -> Column:
    """Struct (date, source): the folder's day, else the camera's, or the other way round; null if neither is usable."""
    camera = F.coalesce(colon_day(camera_time), F.left(camera_time, F.lit(10)))
    choice = lambda c, name: F.when(usable_day(c), F.struct(c.alias("date"), F.lit(name).alias("source")))
    by_folder, by_camera = choice(folder_day, "folder"), choice(camera, "camera")
    return F.when(F.coalesce(camera_first, F.lit(False)), F.coalesce(by_camera, by_folder)).otherwise(F.coalesce(by_folder, by_camera))


def richer_location(old: Column, new: Column) -> Column:
    """The struct (lat, lon, raw) that says more: a position before a raw text before nothing; on a tie the old one."""
    worth = lambda c: F.when(c["lat"].isNotNull() & c["lon"].isNotNull(), 2).when(F.trim(c["raw"]) != "", 1).otherwise(0)
    return F.when(worth(new) > worth(old), new).otherwise(old)


def scale_percent(width: Column, height: Column, frame_width: float, frame_height: float, *, fill: bool = False) -> Column:
    """Percentage by which a picture fits into a frame, or fills it; null without a size."""
    across, down = frame_width / width, frame_height / height
    return F.when((width > 0) & (height > 0), 100 * (F.greatest(across, down) if fill else F.least(across, down)))


def sentences(text: Column) -> Column:
    """Sentences without what stands in brackets."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"\([^)]*\)", "")
    return F.filter(F.transform(F.split(bare, r"(?<=[.!?;])\s+|\n+"), F.trim), lambda s: s != "")


def quoted_windows(text: Column) -> Column:
    """Structs (start, end) in seconds of spans written as 12-18s, 1:02-1:10 or 0:05 to 0:09."""
    clock = r"(?:\d+:)?\d+(?:\.\d+)?"
    pairs = F.regexp_extract_all(text, F.lit(rf"({clock}\s*s?\s*(?:-|–|to)\s*{clock}\s*s?)"), F.lit(1))

    def seconds(c: Column) -> Column:
        parts = F.split(F.regexp_replace(c, r"[^\d:.]", ""), ":")
        return F.when(F.size(parts) > 1, F.get(parts, 0).try_cast("double") * 60 + F.get(parts, 1).try_cast("double")).otherwise(F.get(parts, 0).try_cast("double"))

    def span(p: Column) -> Column:
        sides = F.split(p, r"\s*(?:-|–|to)\s*")
        return F.struct(seconds(F.get(sides, 0)).alias("start"), seconds(F.get(sides, 1)).alias("end"))

    return F.filter(F.transform(pairs, span), lambda w: w["start"] < w["end"])


def avoid_windows(text: Column, note_type: Column, words: tuple[str, ...] = ("avoid", "don't use", "do not use", "skip")) -> Column:
    """Windows quoted in sentences that say to avoid them, or anywhere in a note of type avoid."""
    warns = lambda s: reduce(lambda a, b: a | b, (F.contains(F.lower(s), F.lit(w)) for w in words)) | F.coalesce(F.lower(note_type) == "avoid", F.lit(False))
    return F.flatten(F.transform(F.filter(sentences(text), warns), quoted_windows))


def glossary(text: Column, words: dict[str, str]) -> Column:
    """Struct (text, hits): whole words and phrases replaced without case, longest first, and how many were."""
    order = sorted(words, key=lambda w: (-len(w), w))
    quote = lambda w: "(?i)(?<![\\p{L}\\p{N}])" + "".join("\\" + c if not c.isalnum() and not c.isspace() else c for c in w) + "(?![\\p{L}\\p{N}])"
    hits = reduce(lambda a, b: a + b, (F.regexp_count(text, F.lit(quote(w))) for w in order), F.lit(0))
    return F.struct(reduce(lambda c, w: F.regexp_replace(c, quote(w), words[w].replace("\\", "\\\\").replace("$", "\\$")), order, text).alias("text"), hits.alias("hits"))


def stable_hash(text: Column, volatile: str) -> Column:
    """SHA-256 of a text without the lines that match a pattern."""
    return F.sha2(F.array_join(F.filter(F.split(text, "\n"), lambda line: ~line.rlike(volatile)), "\n"), 256)


def name_tokens(filename: Column) -> Column:
    """Distinct parts of a file name of four letters and digits or more, in lower case, without its extension."""
    stem = F.lower(F.regexp_replace(F.element_at(F.split(F.regexp_replace(filename, r"\\", "/"), "/"), -1), r"\.[^.]*$", ""))
    return F.array_distinct(F.regexp_extract_all(stem, F.lit("([a-z0-9]{4,})"), F.lit(1)))


def excerpt(text: Column, most: int) -> Column:
    """The text, cut at ``most`` letters with an ellipsis."""
    return F.when(F.length(text) > most, F.concat(F.rtrim(F.left(text, F.lit(most - 1))), F.lit("…"))).otherwise(text)


# Factors of a stretch's rank. Lexical: a strong term, the topic with one of its companions, the topic, none.
# Early: a start before so many seconds of a stretch shorter than so many. Late: a midpoint from such a share of the whole.
LEXICAL = (1.0, 0.88, 0.72, 0.58)
EARLY = ((180.0, 130.0, 0.72), (360.0, 200.0, 0.86))
LATE = ((0.92, 0.42), (0.86, 0.68), (0.82, 0.82))
COLD_OPEN_UNTIL, COLD_OPEN, COLD_OPEN_NAMED = 240.0, 0.6, 0.52
COLD_OPEN_WORDS = ("welcome", "joins the pod", "joins the podcast", "special episode", "good morning")
ADVERTS, ADVERT = 0.38, 0.62
LEAST_SPAN = 30.0


def _holds(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(w)) for w in words), F.lit(False))


def lexical_boost(text: Column, strong: tuple[str, ...], topic: str | None = None, companions: tuple[str, ...] = ()) -> Column:
    """Factor of a text in lower case by what it names: a strong term, the topic beside a companion word, the topic alone, or nothing."""
    about = F.contains(text, F.lit(topic)) if topic else F.lit(False)
    return F.when(_holds(text, strong), LEXICAL[0]).when(about & _holds(text, companions), LEXICAL[1]).when(about, LEXICAL[2]).otherwise(LEXICAL[3])


def advert_factor(text: Column, brands: tuple[str, ...] = ()) -> Column:
    """Factor of a text in lower case by how many signs of advertising stand in it."""
    has = lambda w: F.contains(text, F.lit(w))
    signs = (has("brought to you by"), has("official") & has("partner"), has("use code") | has("promo code") | has("discount"), has(".com") & (has("%") | has("off your") | has("hop on")), _holds(text, brands))
    hits = reduce(lambda a, b: a + b, (s.cast("int") for s in signs))
    return F.when(hits >= 2, ADVERTS).when(hits == 1, ADVERT).otherwise(1.0)


def cold_open_factor(text: Column, start: Column, strong: tuple[str, ...], named: tuple[str, ...] = ()) -> Column:
    """Factor of a greeting near the start in which no strong term is spoken yet; lower if one of ``named`` is announced."""
    opening = (start <= COLD_OPEN_UNTIL) & ~_holds(text, strong) & _holds(text, COLD_OPEN_WORDS)
    return F.when(opening & _holds(text, named), COLD_OPEN_NAMED).when(opening, COLD_OPEN).otherwise(1.0)


def relevance_rank(peak: Column, start: Column, end: Column, total: Column, text: Column, *, strong: tuple[str, ...] = (), topic: str | None = None, companions: tuple[str, ...] = (), named: tuple[str, ...] = (), brands: tuple[str, ...] = ()) -> Column:
    """Rank of a stretch of speech: the best likeness in it times the root of its length (half a minute at least), times factors for what it names, for an early start, a cold open, advertising and a late place. ``total`` is the recording's length; null or 0 gives no factor for a late place. Terms are in lower case."""
    span = F.greatest(F.lit(LEAST_SPAN), end - start)
    early = F.when((start < EARLY[0][0]) & (span < EARLY[0][1]), EARLY[0][2]).when((start < EARLY[1][0]) & (span < EARLY[1][1]), EARLY[1][2]).otherwise(1.0)
    place = F.when(total > 0, (start + end) / 2 / total)
    late = reduce(lambda c, x: c.when(place >= x[0], x[1]), LATE[1:], F.when(place >= LATE[0][0], LATE[0][1])).otherwise(1.0)
    low = F.lower(F.coalesce(text, F.lit("")))
    return peak * lexical_boost(low, strong, topic, companions) * early * cold_open_factor(low, start, strong, named) * advert_factor(low, brands) * late * F.sqrt(span)
