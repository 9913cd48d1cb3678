"""Evaluation passages inside training texts: spaced-seed hashing, then verification around each hit."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"[^\W_]+")
#: Spaced seeds: 1 compares a word, 0 ignores it. The spans are at most the least overlap, so each overlap holds a hit.
#: Laid at all places of 13 words, one of the three falls on none of the replaced words in all cases of one replaced
#: word and in 91 % of those of two. Without replaced words each overlap holds every mask, and one is enough.
MASKS = ("1001110010011", "101001100111", "11001011101")
#: Parts in which the texts of one hash meet the items of it, beyond MOST_SENT.
PARTS = 8
#: Hashes of the items that are sent to the workers at most; beyond it, texts and items meet by a shuffled join.
MOST_SENT = 2_000_000
#: Words of the items that are sent beside them, at most.
MOST_SENT_WORDS = 2_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    """Longest runs of letters or digits, without case."""
    return [w.casefold() for w in _WORD.findall(text)] if text else []


_codes: dict[str, int] = {}


def word_codes(text: str | None) -> np.ndarray:
    """64-bit hash of each word; the same in every process. Frequent words are remembered in bounded space."""
    found = words(text)
    missing = [w for w in set(found) if w not in _codes]
    if missing:
        if len(_codes) > 500_000:
            _codes.clear()
            missing = list(set(found))
        _codes.update(zip(missing, pd.util.hash_array(np.array(missing, dtype=object), categorize=False).tolist(), strict=True))
    return np.fromiter((_codes[w] for w in found), np.uint64, len(found))


def seed_hashes(codes: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the compared words at each place where the whole mask fits."""
    n = len(codes) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, len(mask), np.uint64)
    for k, use in enumerate(mask):
        if use == "1":
            h = (h ^ codes[k : k + n]) * _MIX
            h ^= h >> np.uint64(29)
    return h


def overlaps(text: np.ndarray, item: np.ndarray, shift: int, least: int, substitutions: int) -> bool:
    """Whether, with item word i laid on text word i + shift, ``least`` consecutive words hold at most so many substitutions."""
    lo, hi = max(0, -shift), min(len(item), len(text) - shift)
    if hi - lo < least:
        return False
    wrong = np.r_[0, np.cumsum(item[lo:hi] != text[lo + shift : hi + shift])]
    return bool((wrong[least:] - wrong[:-least]).min() <= substitutions)


def find_leaks(
    docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", least: int = 13, substitutions: int = 0, masks: tuple[str, ...] = MASKS, most_sent: int = MOST_SENT
) -> DataFrame:
    """Distinct rows (doc_id, item_id): the text holds ``least`` consecutive words of the item with at most ``substitutions`` replaced.

    Words are the longest runs of letters or digits, compared without case. Items or texts of fewer words, null and
    empty ones match nothing. Repeated rows count once; equal items under several ids are all reported, as are equal
    texts. Empty tables give no rows. Other columns are ignored. Texts are read whole.

    The masks' hashes of the items go to the workers while there are at most ``most_sent``; a text then never leaves
    its partition. With more, the texts' hashes are shuffled against the items' hashes, and only the candidate pairs
    meet their words again. With substitutions, an overlap is found if one mask falls on none of the replaced words.
    """
    if any(len(m) > least or set(m) - {"0", "1"} or "1" not in m for m in masks):
        raise ValueError("a mask compares some words and spans at most the least overlap")
    if not substitutions:
        masks = masks[:1]
    d_kind, i_kind = docs.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    schema = f"doc_id {d_kind}, item_id {i_kind}"

    def seeds_of(kind: str):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                ids, found = [], []
                for k, t in enumerate(batch["text"]):
                    codes = word_codes(t)
                    if len(codes) >= least:
                        for m, mask in enumerate(masks):
                            # where a text repeats itself, its hash is sent once; the places are found again when it is verified
                            h = np.unique(seed_hashes(codes, mask)) ^ np.uint64(m)
                            ids.append(np.full(len(h), k))
                            found.append(h)
                if found:
                    yield pd.DataFrame({"id": batch["id"].to_numpy()[np.concatenate(ids)], "h": np.concatenate(found).view(np.int64)})

        return lambda df: df.mapInPandas(run, f"id {kind}, h bigint")

    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).dropna()
    tests = items.select(F.col(item_id).alias("id"), F.col(text).alias("text")).dropna().distinct()
    wanted = tests.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).first()
    # a mask starts at no more places than the text has characters, halved as words are parted
    if (wanted["chars"] or 0) // 2 * len(masks) <= most_sent and (wanted["chars"] or 0) // 2 <= MOST_SENT_WORDS:
        own = tests.toPandas().sort_values("id", kind="stable")
        codes = [word_codes(t) for t in own["text"]]
        places = [(seed_hashes(c, mask), k, m) for k, c in enumerate(codes) if len(c) >= least for m, mask in enumerate(masks)]
        h = np.concatenate([p for p, _, _ in places]) if places else np.empty(0, np.uint64)
        which = np.concatenate([np.full(len(p), k) for p, k, _ in places]) if places else np.empty(0, int)
        where = np.concatenate([np.arange(len(p)) for p, _, _ in places]) if places else np.empty(0, int)
        mask_no = np.concatenate([np.full(len(p), m) for p, _, m in places]) if places else np.empty(0, int)
        order = np.argsort(h, kind="stable")
        sent = docs.sparkSession.sparkContext.broadcast((own["id"].tolist(), codes, h[order], which[order], where[order], mask_no[order]))

        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, codes, h, which, where, mask_no = sent.value
            for batch in batches:
                out: list[tuple] = []
                for doc, t in zip(batch["id"], batch["text"], strict=True):
                    own = word_codes(t)
                    tried: set[tuple[int, int]] = set()
                    leaked: set[int] = set()
                    for m, mask in enumerate(masks):
                        hashes = seed_hashes(own, mask)
                        lo, hi = np.searchsorted(h, hashes, "left"), np.searchsorted(h, hashes, "right")
                        for at in np.flatnonzero(hi > lo):
                            for e in range(lo[at], hi[at]):
                                if mask_no[e] == m and (pair := (int(which[e]), int(at - where[e]))) not in tried and pair[0] not in leaked:
                                    tried.add(pair)
                                    if overlaps(own, codes[pair[0]], pair[1], least, substitutions):
                                        leaked.add(pair[0])
                    out += [(doc, ids[k]) for k in leaked]
                yield pd.DataFrame(out, columns=["doc_id", "item_id"]).astype({"doc_id": batch["id"].dtype})

        return texts.mapInPandas(search, schema).distinct()

    # a hash may stand in a third of all texts: they meet its items in several parts
    left = seeds_of(d_kind)(texts).select(F.col("id").alias("doc_id"), "h", F.pmod(F.xxhash64("id"), F.lit(PARTS)).alias("part"))
    right = seeds_of(i_kind)(tests).select(F.col("id").alias("item_id"), "h", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    pairs = left.join(right, ["h", "part"]).select("doc_id", "item_id").distinct()
    laid = pairs.join(texts.select(F.col("id").alias("doc_id"), F.col("text").alias("d_text")).distinct(), "doc_id").join(tests.select(F.col("id").alias("item_id"), F.col("text").alias("i_text")), "item_id")

    def leaked(d: np.ndarray, i: np.ndarray) -> bool:
        tried: set[int] = set()
        for mask in masks:
            of_d, of_i = seed_hashes(d, mask), seed_hashes(i, mask)
            order = np.argsort(of_i, kind="stable")
            lo, hi = (np.searchsorted(of_i[order], of_d, side) for side in ("left", "right"))
            for at in np.flatnonzero(hi > lo):
                for e in order[lo[at] : hi[at]]:
                    if (shift := int(at - e)) not in tried:
                        tried.add(shift)
                        if overlaps(d, i, shift, least, substitutions):
                            return True
        return False

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ok = [leaked(word_codes(d), word_codes(i)) for d, i in zip(batch["d_text"], batch["i_text"], strict=True)]
            yield batch.loc[np.array(ok, dtype=bool), ["doc_id", "item_id"]]

    return laid.select("doc_id", "item_id", "d_text", "i_text").mapInPandas(verify, schema).distinct()
