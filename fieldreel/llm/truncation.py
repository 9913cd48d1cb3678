"""Texts cut off by field limits: spikes in length histograms, and cuts in transfer."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldreel.session import cut_lineage

#: Lengths on either side that a spike is held against.
AROUND = 12
#: A spike has at least so many texts, and so many times what its surroundings make likely.
LEAST_AT_SPIKE, TIMES = 6, 5.0
#: Where so large a share of a kind's texts ends a sentence or signs off, a text that does neither is cut.
USUAL = 0.6
#: An ending after which the kind's texts go on with another word at least so often is the inside of a sentence.
GOES_ON = 0.9
#: Bits of the filter of endings that is broadcast: 16 for each, within these bounds (128 kB and 32 MB). A fuller filter
#: lets more through, and without any use all; counts stay exact.
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28
#: A word or mark is the torn beginning of a longer one that is so many times as frequent.
TORN_TIMES, LEAST_LONGER = 50, 3
#: Letters up to which the beginnings of words are listed; longer ones are compared one by one.
LISTED_LETTERS = 64
#: Distinct words that a task counts before it hands them on.
COUNTED_WORDS = 200_000

# Padding characters, closing characters, sign-offs and marks of transfer.
PADDING = " \t\r\n  -=_*~"
TERMINAL = r"[.!?。！？][\"'”’»“)\]\s]*$"
NUMBER_LINE = r"(?:^|\n)[ \t]*\d{1,3}[.)]$"
SIGN_OFF = r"(?<!\s)(?:\s*(?:\n\s*[—–]\s?[^\n]{1,40}|\([A-Z]{1,4}/[A-Z]{1,4}\)|#[\p{L}\p{N}_]+|https?://\S+|[\x{1F000}-\x{1FAFF}\x{FE0F}\x{200D}\x{2600}-\x{27BF}]+))+\s*$"
MAYBE_SIGNED = r"#|https?://|\([A-Z]{1,4}/|\n\s*[—–]|[\x{1F000}-\x{1FAFF}\x{FE0F}\x{200D}\x{2600}-\x{27BF}]"
MARK_SAID = r"\s*(?:\.{2,}|…)?\s*(?:\((?:more|mehr|suite|más|continued)\)|\[(?:\+|…|\.\.\.|more)\])\s*$"
MARK_DOTS = r"\s*(?:\.{3,}|…)\s*$"
#: Characters at the end in which signatures and marks are looked for first; where they fill them, the whole text is.
TAIL = 400
CLOSE = 60

_TOKEN = re.compile(r"\n|[^\W_]+|[^\w\s]|_")
_codes: dict[str, int] = {}


def _tokens(text: str) -> list[str]:
    return _TOKEN.findall(text.lower())


def _coded(found: list[str]) -> np.ndarray:
    """Hash of each word, mark and line end; the lowest bit says which are words."""
    missing = list(set(found) - _codes.keys())
    if missing:
        if len(_codes) > 500_000:
            _codes.clear()
            missing = list(set(found))
        hashes = pd.util.hash_array(np.array(missing, dtype=object), categorize=False) & ~np.uint64(1)
        _codes.update(zip(missing, (hashes | np.fromiter((t[0].isalnum() for t in missing), np.uint64, len(missing))).tolist(), strict=True))
    return np.fromiter(map(_codes.__getitem__, found), np.uint64, len(found))


def _mixed(h: np.ndarray, codes: np.ndarray) -> np.ndarray:
    h = (h ^ codes) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(31))


def _grams(codes: np.ndarray, n: int, kind: np.ndarray) -> np.ndarray:
    """Hash of each n following tokens, for the kind of text at each."""
    m = len(codes) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    h = kind[:m] ^ np.uint64(n)
    for k in range(n):
        h = _mixed(h, codes[k : k + m])
    return h


@cache
def _kind_code(kind: str | None) -> int:
    return int(pd.util.hash_array(np.array([kind or ""], dtype=object), categorize=False)[0])


def spikes(df: DataFrame, source: str, text: str) -> DataFrame:
    """Rows (source, unit, length, texts, expected): lengths at which more distinct texts of a source end than chance explains.

    ``unit`` is chars or bytes. A length is held against the mean of the lengths up to ``AROUND`` away on either side,
    without the three next to it, as texts cut after a blank or inside a character fall a little short. Null and empty
    texts are left out; copies of one text within a source count once; an empty table gives no rows.
    """
    lengths = df.select(F.col(source).alias("source"), F.xxhash64(text).alias("h"), F.length(text).alias("chars"), F.octet_length(text).alias("bytes")).where("chars > 0").distinct()
    long = lengths.select("source", F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("length")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("length")))).alias("x"))
    counts = long.groupBy("source", "x.unit", "x.length").agg(F.count("*").alias("texts"))
    near = Window.partitionBy("source", "unit").orderBy("length")
    side = lambda a, b: F.coalesce(F.sum("texts").over(near.rangeBetween(a, b)), F.lit(0))
    out = counts.withColumn("expected", (side(-AROUND, -4) + side(4, AROUND)) / (2 * (AROUND - 3)))
    return out.where((F.col("texts") >= LEAST_AT_SPIKE) & (F.col("texts") >= TIMES * F.greatest("expected", F.lit(0.5))))


def _endings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each text's end: the hashes of its last four and two tokens, its last token, and whether that is a word."""
    for batch in batches:
        last = [_tokens(tail)[-4:] for tail in batch["tail"]]
        codes = _coded([t for found in last for t in found])
        size = np.array([len(found) for found in last], dtype=np.int64)
        kinds = np.array([_kind_code(k) for k in batch["kind"]], np.uint64)
        end = np.cumsum(size)
        out = batch[["kind", "tail"]].reset_index(drop=True)
        for n in (4, 2):
            has = np.flatnonzero(size >= n)
            h = kinds[has] ^ np.uint64(n)
            for k in range(n):
                h = _mixed(h, codes[end[has] - n + k])
            column = pd.array(np.zeros(len(size), np.int64), dtype="Int64")
            column[size < n] = pd.NA
            column[has] = h.view(np.int64)
            out[f"h{n}"] = column
        out["word"] = [found[-1] if found else None for found in last]
        some = size > 0
        out["in_word"] = np.where(some, (codes[np.where(some, end - 1, 0)] & np.uint64(1)) > 0, False) if len(codes) else False
        yield out


def _filter_bits(endings: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, 1 << (16 * endings).bit_length()))


def _corpus_counts(docs: DataFrame, endings: DataFrame) -> DataFrame:
    """Rows (h, word, goes, stops) of one pass over the texts: how often an ending (h) stands inside a text of the kind before a word, and before anything else; and how often a word stands before the end of a text (goes)."""
    size = _filter_bits(endings.count())
    words = endings.select(F.explode(F.array("h4", "h2")).alias("h")).dropna().select(F.expr(f"h & {size - 1}").alias("p")).distinct()
    words = words.groupBy(F.expr("p >> 6").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 AS int)))").alias("bits")).toPandas()
    bits = np.zeros(size // 64, np.uint64)
    bits[words["at"].to_numpy(int)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    sent = docs.sparkSession.sparkContext.broadcast(bits)
    columns = {"h": "Int64", "word": object, "goes": "Int64", "stops": "Int64"}

    def counted(words: Counter) -> pd.DataFrame:
        letters = [(w, n) for w, n in words.items() if n and w.isalpha()]
        return pd.DataFrame({"h": None, "word": [w for w, _ in letters], "goes": [n for _, n in letters], "stops": 0}).astype(columns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = sent.value
        mask = np.uint64(len(bits) * 64 - 1)
        seen: Counter = Counter()
        for batch in batches:
            every: list[str] = []
            lengths, torn = [], []
            for text in batch["text"]:
                found = _tokens(text)
                every += found
                lengths.append(len(found))
                if found and text[-1].isalnum():
                    torn.append(found[-1])
            codes, lengths = _coded(every), np.array(lengths)
            seen.update(every)
            seen.subtract(torn)
            kinds = np.repeat(np.array([_kind_code(k) for k in batch["kind"]], np.uint64), lengths)
            text_no = np.repeat(np.arange(len(lengths)), lengths)
            hashes, goes = [np.empty(0, np.uint64)], [np.empty(0, bool)]
            for n in (4, 2):
                g = _grams(codes, n, kinds)[:-1]
                at = g & mask
                keep = (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0
                keep &= text_no[n : n + len(g)] == text_no[: len(g)]  # the last of a text has nothing after it
                hashes.append(g[keep])
                goes.append((codes[n : n + len(g)][keep] & np.uint64(1)) > 0)
            h, which = np.unique(np.concatenate(hashes), return_inverse=True)
            word = np.bincount(which, weights=np.concatenate(goes), minlength=len(h)).astype(np.int64)
            yield pd.DataFrame({"h": h.view(np.int64), "word": None, "goes": word, "stops": np.bincount(which, minlength=len(h)) - word}).astype(columns)
            if len(seen) >= COUNTED_WORDS:
                yield counted(seen)
                seen.clear()
        yield counted(seen)

    counts = docs.select("kind", "text").mapInPandas(run, "h bigint, word string, goes bigint, stops bigint")
    return counts.groupBy("h", "word").agg(F.sum("goes").alias("goes"), F.sum("stops").alias("stops"))


def _frequencies(asked: DataFrame, known: DataFrame) -> DataFrame:
    """Rows (word, itself, longer): of each asked word, how often it is known, and how often the most frequent longer word is that begins with it. ``known``: (v, n).

    Beginnings of fewer than ``LISTED_LETTERS`` letters meet by equality; longer asked words meet the longer words of
    the same first letters and are compared.
    """
    few = F.least(F.length("v"), F.lit(LISTED_LETTERS - 1))
    begun = known.select(F.explode(F.transform(F.sequence(F.lit(1), few), lambda k: F.struct(F.left("v", k).alias("word"), (k == F.length("v")).alias("itself")))).alias("x"), "n")
    short = begun.select("x.word", "x.itself", "n").join(asked.where(F.length("word") < LISTED_LETTERS), "word", "left_semi")
    head = lambda c: F.left(c, F.lit(LISTED_LETTERS)).alias("head")
    long = asked.where(F.length("word") >= LISTED_LETTERS).select("word", head("word")).join(known.where(F.length("v") >= LISTED_LETTERS).select("v", "n", head("v")), "head").where(F.startswith("v", "word"))
    both = short.union(long.select("word", F.col("v") == F.col("word"), "n"))
    most = lambda c: F.coalesce(F.max(F.when(c, F.col("n"))), F.lit(0))
    return both.groupBy("word").agg(most(F.col("itself")).alias("itself"), most(~F.col("itself")).alias("longer"))


def _torn(itself: Column, longer: Column) -> Column:
    return (F.coalesce(longer, F.lit(0)) >= LEAST_LONGER) & (F.coalesce(itself, F.lit(0)) * TORN_TIMES < F.coalesce(longer, F.lit(0)))


def _ends(df: DataFrame, doc_id: str, text: str, source: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """The documents with a text, and of each whether something was signed and by what last word, its mark, whether it is whole, else its end without padding and dots (tail), and whether its length is at a spike."""
    docs = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(source).alias("source"), F.coalesce(F.col(kind), F.lit("")).alias("kind")).where(F.length(text) > 0)
    found = spikes(docs, "source", "text").groupBy("source").agg(F.collect_set(F.when(F.col("unit") == "chars", F.col("length"))).alias("in_chars"), F.collect_set(F.when(F.col("unit") == "bytes", F.col("length"))).alias("in_bytes"))
    found = found.select(F.col("source").alias("s_source"), "in_chars", "in_bytes")
    # texts are left behind, and of whole ones the ends too; each step below is worked out once, before the exchange
    ends = docs.withColumn("body", F.rtrim("text", F.lit(PADDING))).withColumn("end", F.right("body", F.lit(TAIL)))
    ends = ends.withColumn("bare", F.when(F.col("end").rlike(MAYBE_SIGNED), F.regexp_replace("end", SIGN_OFF, "")).otherwise(F.col("end")))
    # what is signed may reach back before the end that was looked at
    more = (F.length("body") > TAIL) & (F.length("bare") < F.length("end")) & ((F.length("bare") < TAIL // 4) | ~F.col("bare").rlike(r"\s"))
    ends = ends.withColumn("more", more).withColumn("end", F.when(F.col("more"), F.col("body")).otherwise(F.col("end"))).withColumn("bare", F.when(F.col("more"), F.regexp_replace("body", SIGN_OFF, "")).otherwise(F.col("bare")))
    ends = ends.withColumn("signed", F.length("bare") < F.length("end"))
    # the last characters decide, unless all of them only close
    ends = ends.withColumn("close", F.right("bare", F.lit(CLOSE))).withColumn("close", F.when(F.col("close").rlike(r"[^\"'”’»“)\]\s.!?。！？…]"), F.col("close")).otherwise(F.col("bare")))
    ends = ends.withColumn("mark", F.when(F.col("signed"), F.lit("none")).when(F.col("close").rlike(MARK_SAID), F.lit("said")).when(F.col("close").rlike(MARK_DOTS), F.lit("dots")).otherwise(F.lit("none")))
    ends = ends.withColumn("whole", ~F.col("signed") & (F.col("mark") == "none") & F.col("close").rlike(TERMINAL) & ~F.col("close").rlike(NUMBER_LINE))
    tail = F.when(~F.col("whole") & ~F.col("signed"), F.regexp_replace("bare", MARK_DOTS, ""))
    last = F.when(F.col("signed"), F.regexp_replace(F.regexp_extract("end", r"(\S+)$", 1), r"\d", "9"))
    ends = ends.select("doc_id", "source", "kind", F.length("text").alias("chars"), F.octet_length("text").alias("bytes"), (F.length("body") > 0).alias("any"), "signed", "mark", "whole", tail.alias("tail"), last.alias("last")).distinct().where("any").drop("any")
    ends = ends.join(found, F.col("source").eqNullSafe(F.col("s_source")), "left").drop("s_source")
    near: Column = F.coalesce(F.exists("in_chars", lambda x: (x >= F.col("chars")) & (x <= F.col("chars") + 1)) | F.exists("in_bytes", lambda x: (x >= F.col("bytes")) & (x <= F.col("bytes") + 3)), F.lit(False))
    return docs, cut_lineage(ends.withColumn("at_spike", near).drop("in_chars", "in_bytes", "chars", "bytes"))


def _at_spikes(ends: DataFrame) -> DataFrame:
    """Rows (doc_id, source, at_spike, reason): texts at a spike of their source that neither end a sentence nor are signed, or whose sign-off itself is torn."""
    plain = ends.where("at_spike AND NOT whole AND NOT signed AND mark <> 'dots'").select("doc_id", "source", "at_spike", F.when(F.col("mark") == "said", "mark").otherwise("limit").alias("reason"))
    signed = ends.where("signed").withColumn("word", F.col("last"))
    asked = signed.where("at_spike").select("word").distinct()
    known = signed.groupBy(F.col("word").alias("v")).agg(F.count("*").alias("n"))
    torn = _frequencies(asked, known).where(_torn(F.col("itself"), F.col("longer"))).select("word")
    return plain.union(signed.where("at_spike").join(torn, "word", "left_semi").select("doc_id", "source", "at_spike", F.lit("limit").alias("reason")))


def find_truncated_at_spikes(df: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", kind: str = "doc_kind") -> DataFrame:
    """One row (doc_id, source, at_spike, reason) for each document whose length in characters or bytes is, or is up to three below, a spike of its source, and whose text neither ends a sentence nor is signed off; ``reason`` is limit, or mark where it says that there is more.

    A sign-off is torn, and the text cut, if its last word is the beginning of one that is far more frequent among the
    last words of signed texts. Texts that end in dots are left to ``find_truncated``, as writers end in dots too.
    Odd rows as in ``find_truncated``.
    """
    return _at_spikes(_ends(df, doc_id, text, source, kind)[1]).distinct()


def find_truncated(df: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", kind: str = "doc_kind") -> DataFrame:
    """One row (doc_id, source, at_spike, reason) for each document whose text was cut off before its writer's end.

    Padding is taken off the end first, then signatures, hash tags, links and pictographs. What is left is complete if
    it ends a sentence or something was signed off, unless the length is a spike of its source and the sign-off itself
    is torn. Else, by the first reason that holds, it is cut:

    - ``mark``: it ends with a mark for the missing rest, as (more) or [...];
    - ``dots``: it ends with dots, and not where the kind's texts pause of themselves;
    - ``limit``: its length is at a spike of its source (``find_truncated_at_spikes``);
    - ``open``: texts of its kind usually end a sentence or sign off;
    - ``word``, ``sentence``: it ends inside a word, a longer form of which the corpus knows, or inside a sentence,
      after tokens that are nearly always followed by a word in texts of the kind.

    Lengths, shares, words and continuations are counted over all documents. Null, empty and blank texts are not cut.
    A null source or kind is a source or kind of its own. Repeated rows count once; equal texts are judged alike if
    source and kind are. An empty table gives no rows. Other columns are ignored.
    """
    docs, ends = _ends(df, doc_id, text, source, kind)
    shares = ends.where("NOT at_spike").groupBy("kind").agg(F.avg((F.col("whole") | F.col("signed")).cast("double")).alias("usual"))
    open_ends = ends.where("NOT whole AND NOT signed AND NOT (at_spike AND mark <> 'dots')").join(shares, "kind", "left").withColumn("usual", F.coalesce("usual", F.lit(0.0)) >= USUAL)
    asks = (F.col("mark") == "dots") | ((F.col("mark") == "none") & ~F.col("usual"))
    plain = open_ends.where(~asks).select("doc_id", "source", "at_spike", F.when(F.col("mark") == "said", "mark").otherwise("open").alias("reason"))

    # what only the corpus can decide
    unclear = open_ends.where(asks)
    endings = cut_lineage(unclear.select("kind", "tail").distinct().mapInPandas(_endings, "kind string, tail string, h4 bigint, h2 bigint, word string, in_word boolean"))
    counts = cut_lineage(_corpus_counts(docs, endings))
    seen = lambda n: counts.where("h IS NOT NULL").select(F.col("h").alias(f"h{n}"), F.col("goes").alias(f"goes{n}"), F.col("stops").alias(f"stops{n}"))
    vocabulary = counts.where("word IS NOT NULL").select(F.col("word").alias("v"), F.col("goes").alias("n"))
    longer = _frequencies(endings.where("in_word").select("word").distinct(), vocabulary)
    judged = endings.join(seen(4), "h4", "left").join(seen(2), "h2", "left").join(longer, "word", "left")
    both = lambda n: F.coalesce(f"goes{n}", F.lit(0)) + F.coalesce(f"stops{n}", F.lit(0))
    share = F.when(both(4) >= 3, F.col("goes4") / both(4)).when(both(2) >= 3, F.col("goes2") / both(2))
    judged = judged.select("kind", "tail", share.alias("share"), (F.col("in_word") & _torn(F.col("itself"), F.col("longer"))).alias("inside"))
    by_dots = F.when(F.col("inside") | F.col("share").isNull() | (F.col("share") >= 0.5), "dots")
    by_end = F.when(F.col("inside"), "word").when(F.col("share") >= GOES_ON, "sentence")
    judged = unclear.join(judged, ["kind", "tail"]).select("doc_id", "source", "at_spike", F.when(F.col("mark") == "dots", by_dots).otherwise(by_end).alias("reason"))
    return _at_spikes(ends).union(plain).union(judged.where("reason IS NOT NULL")).distinct()


def truncation_rates(df: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source", kind: str = "doc_kind") -> DataFrame:
    """One row (source, texts, cut, share) for each source: documents with a text, those that were cut, and their share. Rules as in find_truncated."""
    total = df.where(F.length(text) > 0).select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source")).distinct().groupBy("source").agg(F.count("*").alias("texts"))
    cut = find_truncated(df, doc_id=doc_id, text=text, source=source, kind=kind).select("doc_id", F.col("source").alias("c_source")).distinct().groupBy("c_source").agg(F.count("*").alias("cut"))
    both = total.join(cut, F.col("source").eqNullSafe(F.col("c_source")), "left").withColumn("cut", F.coalesce("cut", F.lit(0)))
    return both.select("source", "texts", "cut", (F.col("cut") / F.col("texts")).alias("share"))
