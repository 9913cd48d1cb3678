"""Encoding whole texts with a public byte-level BPE vocabulary; merges are chosen by a segment tree over pair ranks."""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from pathlib import Path

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: the vocabulary's public pattern that splits text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words that a worker remembers with their ids; when full, it starts anew.
REMEMBERED = 200_000
#: Only words up to this many bytes are remembered.
REMEMBERED_BYTES = 64

Merges = dict[tuple[int, int], tuple[int, int]]


def byte_letters() -> dict[str, int]:
    """The letter by which the vocabulary file writes each byte: printable Latin-1 as itself, the others from U+0100 on."""
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def load_vocabulary(path: str) -> tuple[list[int], Merges]:
    """Of a tokenizers JSON file or a .tiktoken rank file: the id of each byte, and for each mergeable pair of ids its rank and the merged id."""
    if path.endswith(".tiktoken"):
        ids = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, Path(path).read_bytes().splitlines())}
        byte_ids = [ids[bytes([b])] for b in range(256)]
        merges: Merges = {}
        for token, rank in ids.items():
            for cut in range(1, len(token)):
                if token[:cut] in ids and token[cut:] in ids:
                    merges[ids[token[:cut]], ids[token[cut:]]] = rank, rank
        return byte_ids, merges
    model = json.loads(Path(path).read_text("utf-8"))["model"]
    vocabulary = model["vocab"]
    byte_ids = [0] * 256
    for letter, byte in byte_letters().items():
        byte_ids[byte] = vocabulary[letter]
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return byte_ids, {(vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b]) for rank, (a, b) in enumerate(pairs)}


def merge_word(ids: list[int], merges: Merges) -> list[int]:
    """Merge the lowest-ranked pair, the leftmost of equals, until no pair can merge.

    Leaf i of the tree holds the rank of the pair that starts at part i, each inner node the smaller of its two
    children; so the root names the next merge, found by walking down, left child first. A merge changes the pairs
    at the part, at its left neighbour and at the part swallowed: three updates along a path to the root each.
    """
    n = len(ids)
    if n < 2:
        return ids
    never = 1 << 40
    size = 1 << (n - 1).bit_length()
    tree = [never] * (2 * size)
    get = merges.get
    none = (never, -1)
    for i in range(n - 1):
        tree[size + i] = get((ids[i], ids[i + 1]), none)[0]
    for node in range(size - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    if tree[1] == never:
        return ids
    ids, after, before = list(ids), list(range(1, n + 1)), list(range(-1, n - 1))

    def put(at: int, rank: int) -> None:
        node = size + at
        tree[node] = rank
        node >>= 1
        while node:
            low = tree[2 * node] if tree[2 * node] <= tree[2 * node + 1] else tree[2 * node + 1]
            if tree[node] == low:
                break
            tree[node] = low
            node >>= 1

    while (low := tree[1]) < never:
        node = 1
        while node < size:
            node = 2 * node if tree[2 * node] == low else 2 * node + 1
        at = node - size
        gone = after[at]
        ids[at] = merges[ids[at], ids[gone]][1]
        put(gone, never)
        after[at] = nxt = after[gone]
        if nxt < n:
            before[nxt] = at
            put(at, get((ids[at], ids[nxt]), none)[0])
        else:
            put(at, never)
        if (left := before[at]) >= 0:
            put(left, get((ids[left], ids[at]), none)[0])
    out, at = [], 0
    while at < n:
        out.append(ids[at])
        at = after[at]
    return out


class Encoder:
    """Encodes texts; frequent words are remembered in bounded space."""

    def __init__(self, byte_ids: list[int], merges: Merges) -> None:
        self.byte_ids, self.merges, self.known = byte_ids, merges, {}
        self.split = regex.compile(SPLIT)

    def encode(self, text: str | None) -> list[int]:
        out: list[int] = []
        if not text:
            return out
        known = self.known
        for word in self.split.findall(text):
            if (ids := known.get(word)) is None:
                raw = word.encode("utf-8", "replace")
                ids = merge_word([self.byte_ids[b] for b in raw], self.merges)
                if len(raw) <= REMEMBERED_BYTES:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[word] = ids
            out += ids
        return out


_encoders: dict[str, Encoder] = {}


def encode_texts(df: DataFrame, key: str, text: str, vocabulary: str) -> DataFrame:
    """One row (key, ids) for each distinct row (key, text): the text's ids, in order, without special tokens.

    Null and empty texts give an empty list; a blank text gives the ids of its white space; names of special tokens
    inside a text are ordinary text. Repeated rows count once; a key with several texts gives one row for each.
    An empty table gives no rows. Other columns are ignored. ``vocabulary`` is a file that the driver reads once and
    broadcasts (some MB, of fixed size); executors need not see it. Texts are encoded where they lie, whole.
    """
    loaded = df.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if vocabulary not in _encoders:
            _encoders[vocabulary] = Encoder(*loaded.value)
        encode = _encoders[vocabulary].encode
        for batch in batches:
            yield pd.DataFrame({key: batch[key], "ids": [encode(t) for t in batch[text]]})

    rows = df.select(key, text).distinct()
    return rows.mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, ids array<int>").select(key, F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))
