"""Small predicates and texts of the catalogue's steps."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def theme_of(tag: Column, themes: dict[str, str]) -> Column:
    """The theme of a tag, '?' for others; null for null."""
    known = F.create_map(*(F.lit(x) for pair in sorted(themes.items()) for x in pair)) if themes else None
    return F.when(tag.isNotNull(), F.coalesce(F.try_element_at(known, tag), F.lit("?")) if themes else F.lit("?"))


def bib_text(text: Column) -> Column:
    """Whether a text is a number of two to four digits, blanks aside."""
    return F.coalesce(F.trim(text).rlike(r"^\d{2,4}$"), F.lit(False))


def noise_path(path: Column, parts: tuple[str, ...]) -> Column:
    """Whether one of the parts stands in a path, without case."""
    low = F.lower(F.coalesce(path, F.lit("")))
    return low.rlike("|".join(re.escape(p.lower()) for p in parts)) if parts else F.lit(False)


def glob_pattern(glob: str) -> str:
    """Regular expression of a file pattern: * for anything, ? for one character, [..] and [!..] for sets."""
    out, at = "", 0
    while at < len(glob):
        c = glob[at]
        close = glob.find("]", at + 2) if c == "[" else -1
        if c == "[" and close > 0:
            body = glob[at + 1 : close].replace("\\", r"\\")
            out += "[" + ("^" + body[1:] if body.startswith("!") else body) + "]"
            at = close
        else:
            out += ".*" if c == "*" else "." if c == "?" else re.escape(c)
        at += 1
    return rf"^(?s:{out})$"


def skipped(path: Column, globs: tuple[str, ...]) -> Column:
    """Whether a path, or its last part, meets one of the file patterns."""
    last = F.element_at(F.split(F.regexp_replace(F.coalesce(path, F.lit("")), r"\\", "/"), "/"), -1)
    hit = F.lit(False)
    for glob in globs:
        hit = hit | F.coalesce(path, F.lit("")).rlike(glob_pattern(glob)) | last.rlike(glob_pattern(glob))
    return hit


def stale_reason(stamp: Column, made_with: Column, current: str, summary: Column) -> Column:
    """Why a record needs processing: missing (no stamp), stale_prompt (made with another prompt) or empty_summary; null if it doesn't."""
    return F.when(stamp.isNull(), "missing").when(~F.coalesce(made_with, F.lit("")).eqNullSafe(current), "stale_prompt").when(F.coalesce(F.trim(summary), F.lit("")) == "", "empty_summary")


def union_ids(a: Column, b: Column) -> Column:
    """Ids of both arrays, sorted and once; null arrays are empty."""
    none = F.array().cast("array<string>")
    return F.array_sort(F.array_compact(F.array_union(F.coalesce(a, none), F.coalesce(b, none))))


def leading_name(text: Column) -> Column:
    """The words in capitals that a text begins with, up to five, after articles and quotes; null if there are none."""
    name = F.regexp_extract(text, r"^[\s\"'“‘(]*(?:(?:The|A|An)\s+)?(\p{Lu}[\p{L}'’.-]*(?:\s+(?:of\s+|the\s+)?\p{Lu}[\p{L}'’.-]*){0,4})", 1)
    return F.nullif(F.rtrim(name, F.lit(".-'’ ")), F.lit(""))


def caption_times(kind: Column, start: Column, end: Column, positions: dict[str, tuple[float, ...]], least: float = 2.0) -> Column:
    """Times in a shot at the shares that its kind of footage is captioned at; none for other kinds and shots under ``least`` seconds."""
    none = F.array().cast("array<double>")
    chain = F.when((end - start < least) | start.isNull() | end.isNull(), none)
    for name, shares in positions.items():
        chain = chain.when(kind == name, F.array(*(start + (end - start) * s for s in shares)) if shares else none)
    return chain.otherwise(none)


def shots_or_whole(shots: Column, duration: Column) -> Column:
    """Shots (array of start, end), or one from 0 to the duration where there are none; null without a duration."""
    return F.when(F.size(shots) > 0, shots).when(duration > 0, F.array(F.struct(F.lit(0.0).alias("start"), duration.cast("double").alias("end"))))
