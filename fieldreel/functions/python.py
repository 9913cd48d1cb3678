"""The few functions that built-in expressions can't give, in Arrow batches."""

from __future__ import annotations

import heapq
import math
import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _each(f, *columns: pd.Series) -> list:
    return [f(*row) if all(x is not None for x in row) else None for row in zip(*columns, strict=True)]


@F.pandas_udf(T.StringType())
def fold(text: pd.Series) -> pd.Series:
    """Text without accents and other signs outside ASCII."""
    return pd.Series(_each(lambda t: unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode(), text))


@F.pandas_udf(T.DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of characters in matching blocks of two texts."""
    return pd.Series(_each(lambda x, y: SequenceMatcher(None, x, y).ratio(), a, b))


def alike_pairs(least: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """For blocks (asked, known) of names the pairs whose ratio reaches ``least``.

    Matching blocks are a common subsequence, so a pair is scored only if its longest one is long enough, and that is
    sought only if the letters alone allow it. Names over 64 letters skip that step.
    """

    def bound(total: np.ndarray) -> np.ndarray:
        return least * total / 2 - 1e-6

    def block(asked: list[str], known: list[str]) -> Iterator[tuple[str, str, float]]:
        code = {c: n for n, c in enumerate(sorted(set("".join(known))))}
        none = len(code)  # letters that no known name has, and the places after an end
        lengths = np.array([len(x) for x in asked])
        order = np.argsort(lengths, kind="stable")
        asked, lengths = [asked[n] for n in order], lengths[order]
        letters = np.full((len(asked), lengths.max()), none)
        for n, x in enumerate(asked):
            letters[n, : len(x)] = [code.get(c, none) for c in x]
        counts = np.stack([(letters == c).sum(axis=1) for c in range(none)], axis=1).astype(np.int16)
        matcher = SequenceMatcher(None)
        for name in known:
            own = np.bincount([code[c] for c in name], minlength=none).astype(np.int16)
            needed = bound(lengths + len(name))
            fit = np.flatnonzero((lengths >= needed) & (len(name) >= needed))
            fit = fit[np.minimum(counts[fit], own).sum(axis=1) >= needed[fit]]
            if len(fit) and len(name) <= 64:
                masks = np.zeros(none + 1, np.uint64)
                for n, c in enumerate(name):
                    masks[code[c]] |= np.uint64(1 << n)
                open_ = np.full(len(fit), 2 ** len(name) - 1, np.uint64)
                full = np.uint64(2 ** len(name) - 1)
                for m in masks[letters[fit, : lengths[fit].max()]].T:
                    open_ = ((open_ + (open_ & m)) | (open_ & ~m)) & full
                fit = fit[len(name) - np.bitwise_count(open_).astype(int) >= needed[fit]]
            if len(fit):
                matcher.set_seq2(name)
                for n in fit:
                    matcher.set_seq1(asked[n])
                    if (score := matcher.ratio()) >= least:
                        yield asked[n], name, score

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for asked, known in zip(batch["asked"], batch["known"], strict=True):
                yield pd.DataFrame(list(block(list(asked), list(known))), columns=["_a", "_b", "ratio"]).astype({"ratio": float})

    return pairs


@F.pandas_udf(T.DoubleType())
def substring_boost(a: pd.Series, b: pd.Series) -> pd.Series:
    """1 if one text holds the other, else the longest common part over the shorter length, taken as 8 at least; 0 if one is empty."""

    def boost(x: str, y: str) -> float:
        if not x or not y:
            return 0.0
        if x in y or y in x:
            return 1.0
        return SequenceMatcher(None, x, y).find_longest_match().size / max(8, min(len(x), len(y)))

    return pd.Series(_each(boost, a, b))


_VOWELS = "aeiou"


def _consonant(w: str, i: int) -> bool:
    return w[i] not in _VOWELS and not (w[i] == "y" and i > 0 and _consonant(w, i - 1))


def _measure(w: str) -> int:
    shape = "".join("c" if _consonant(w, i) else "v" for i in range(len(w)))
    return sum(a == "v" and b == "c" for a, b in zip(shape, shape[1:]))


def _short_end(w: str) -> bool:
    n = len(w)
    return n >= 3 and _consonant(w, n - 3) and not _consonant(w, n - 2) and _consonant(w, n - 1) and w[-1] not in "wxy"


# Suffixes of the published English suffix-stripping algorithm (Porter, 1980), steps 2 to 4.
STEP2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble", "logi": "log"}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def _replace_longest(w: str, table: dict[str, str]) -> str:
    for n in range(min(7, len(w) - 1), 1, -1):
        if (end := w[-n:]) in table:
            return w[:-n] + table[end] if _measure(w[:-n]) > 0 else w
    return w


def stem(w: str) -> str:
    """Stem of a lower-case English word."""
    if len(w) <= 2:
        return w
    if w.endswith(("sses", "ies")):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    if w.endswith("eed"):
        w = w[:-1] if _measure(w[:-3]) > 0 else w
    else:
        for end in ("ed", "ing"):
            if w.endswith(end) and any(not _consonant(w, i) for i in range(len(w) - len(end))):
                w = w[: -len(end)]
                if w.endswith(("at", "bl", "iz")):
                    w += "e"
                elif len(w) > 1 and w[-1] == w[-2] and _consonant(w, len(w) - 1) and w[-1] not in "lsz":
                    w = w[:-1]
                elif _measure(w) == 1 and _short_end(w):
                    w += "e"
                break
    if w.endswith("y") and any(not _consonant(w, i) for i in range(len(w) - 1)):
        w = w[:-1] + "i"
    w = _replace_longest(_replace_longest(w, STEP2), STEP3)
    for n in range(5, 1, -1):
        if (end := w[-n:]) in STEP4 and len(w) > n:
            if _measure(w[:-n]) > 1 and (end != "ion" or w[-n - 1] in "st"):
                w = w[:-n]
            break
    if w.endswith("e") and (_measure(w[:-1]) > 1 or (_measure(w[:-1]) == 1 and not _short_end(w[:-1]))):
        w = w[:-1]
    return w[:-1] if w.endswith("ll") and _measure(w) > 1 else w


@F.pandas_udf(T.ArrayType(T.StringType()))
def stems(words: pd.Series) -> pd.Series:
    known: dict[str, str] = {}

    def of(ws: np.ndarray) -> list[str]:
        return [known.setdefault(w, stem(w)) for w in ws]

    return pd.Series(_each(of, words))


def align(a: np.ndarray, b: np.ndarray) -> tuple[float, int]:
    """Best share of equal bits of two fingerprints over all offsets of the shorter in the longer, and the first such offset (negative if b is the shorter)."""
    if len(a) > len(b):
        similarity, offset = align(b, a)
        return similarity, -offset
    if not len(a):
        return 0.0, 0
    windows = np.lib.stride_tricks.sliding_window_view(b.astype(np.uint32), len(a))
    similarity = 1 - np.bitwise_count(windows ^ a.astype(np.uint32)).sum(axis=1, dtype=np.int64) / (32 * len(a))
    best = int(similarity.argmax())
    return float(similarity[best]), best


@F.pandas_udf(T.StructType([T.StructField("similarity", T.DoubleType()), T.StructField("offset", T.IntegerType())]))
def fingerprint_match(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    found = [align(np.asarray(x), np.asarray(y)) if x is not None and y is not None else (0.0, 0) for x, y in zip(a, b, strict=True)]
    return pd.DataFrame(found, columns=["similarity", "offset"])


def text_score(a: Column, b: Column, jaccard_of: Column, duration_of: Column | None = None) -> Column:
    """Likeness of two normalised transcripts: 0.15 shared words, 0.35 matching blocks, 0.45 common part, and 0.05 likeness of durations if given; 0 if one is empty."""
    base = 0.15 * jaccard_of + 0.35 * ratio(a, b) + 0.45 * substring_boost(a, b)
    full = base if duration_of is None else base + 0.05 * duration_of
    return F.when((F.length(a) > 0) & (F.length(b) > 0), full).otherwise(F.lit(0.0))


class Blocks:
    """Longest matching blocks of texts with one text, the very ones that difflib's SequenceMatcher(None, x, y) finds.

    From 200 letters on it begins blocks at rare letters only, of which no more than one in a hundred is the same. They
    are looked up here by runs of such letters, so the time grows with their number and not with its square.
    """

    def __init__(self, y: str) -> None:
        self.y, self.grams, self.matcher, self.rare = y, None, None, None
        if len(y) >= 200:
            chars = "".join(c for c, k in Counter(y).items() if k <= len(y) // 100 + 1)
            self.rare = re.compile(f"[{re.escape(chars)}]+" if chars else r"(?!)")
            runs = [m.span() for m in self.rare.finditer(y)]
            longest = max((end - start for start, end in runs), default=0)
            if longest <= 64:  # of longer ones, all parts would be too many
                self.grams = [{} for _ in range(longest)]
                for start, end in runs:
                    for n in range(1, end - start + 1):
                        for j in range(start, end - n + 1):
                            self.grams[n - 1].setdefault(y[j : j + n], []).append(j)
        if self.grams is None:
            self.matcher = SequenceMatcher(None, "", y)

    def finder(self, x: str) -> Callable[[int, int, int, int], tuple[int, int, int]]:
        """find_longest_match of x and the text."""
        if self.grams is None:
            self.matcher.set_seq1(x)
            return self.matcher.find_longest_match
        y, grams = self.y, self.grams
        starts: list[list[int]] = []
        for run in self.rare.finditer(x):
            start, end = run.span()
            for n in range(1, min(end - start, len(grams)) + 1):
                hits = [i for i in range(start, end - n + 1) if x[i : i + n] in grams[n - 1]]
                if not hits:
                    break
                if len(starts) < n:
                    starts.append([])
                starts[n - 1] += hits

        def find(alo: int, ahi: int, blo: int, bhi: int) -> tuple[int, int, int]:
            i, j, size = alo, blo, 0
            for n in range(len(starts), 0, -1):
                at = starts[n - 1]
                for k in range(bisect_left(at, alo), len(at)):
                    if at[k] + n > ahi:
                        break
                    places = grams[n - 1][x[at[k] : at[k] + n]]
                    h = bisect_left(places, blo)
                    if h < len(places) and places[h] + n <= bhi:
                        i, j, size = at[k], places[h], n
                        break
                if size:
                    break
            while i > alo and j > blo and x[i - 1] == y[j - 1]:
                i, j, size = i - 1, j - 1, size + 1
            while i + size < ahi and j + size < bhi and x[i + size] == y[j + size]:
                size += 1
            return i, j, size

        return find


def score_from(least: float, x: str, y: Blocks, shared: float) -> float | None:
    """The ``text_score`` of two texts that share that part of their words, or None where it is below ``least``; bounds mostly say so before all blocks are known."""
    b = y.y
    n, total = min(len(x), len(b)), len(x) + len(b)
    if x == b:
        return 0.15 * shared + 0.35 + 0.45 if n else None
    if not n:
        return None
    common = 1.0 if x in b or b in x else None
    if common is None:
        size = (least - 0.15 * shared - 0.35 * 2 * n / total) / 0.45 * max(8, n) - 1e-6
        if size > n:
            return None
        if size > 1:
            # a common part of that size holds one of the shorter text's pieces of half of it
            half = (math.ceil(size) + 1) // 2
            short, long = (x, b) if len(x) <= len(b) else (b, x)
            if not any(short[i : i + half] in long for i in range(0, len(short) - half + 1, half)):
                return None
    find = y.finder(x)
    first = find(0, len(x), 0, len(b))
    if common is None:
        common = first[2] / max(8, n)
    need = (least - 0.15 * shared - 0.45 * common) / 0.35 * total / 2 - 1e-6
    found, left, block, area = 0, n, first, (0, len(x), 0, len(b))
    areas: list[tuple[int, tuple[int, int, int, int]]] = []
    while True:
        i, j, size = block
        alo, ahi, blo, bhi = area
        found += size
        left -= min(ahi - alo, bhi - blo)
        if size:
            for part in ((alo, i, blo, j), (i + size, ahi, j + size, bhi)):
                if (most := min(part[1] - part[0], part[3] - part[2])) > 0:
                    left += most
                    heapq.heappush(areas, (-most, part))
        if found + left < need:
            return None
        if not areas:
            return 0.15 * shared + 0.35 * (2.0 * found / total) + 0.45 * common
        _, area = heapq.heappop(areas)
        block = find(*area)
