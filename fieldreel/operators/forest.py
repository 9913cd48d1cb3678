"""Union-find within partitions: spanning forests that replace the edges of a partition."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd

#: Edges that a task gathers before it reduces them to their forest.
GATHERED = 100_000


def union_find(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest linked number of each of 0..n-1: trees hang under their smaller root, paths are compressed after each round."""
    parent = np.arange(n)
    while a.size:
        ra, rb = parent[a], parent[b]
        apart = ra != rb
        if not apart.any():
            break
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(parent, above := parent[parent]):
            parent = above
    return parent


def _forest(pdf: pd.DataFrame) -> pd.DataFrame:
    codes, ids = pd.factorize(np.concatenate([pdf["a"].to_numpy(), pdf["b"].to_numpy()]), sort=True)
    half = len(pdf)
    return pd.DataFrame({"a": ids, "b": ids[union_find(codes[:half], codes[half:], len(ids))]})


def spanning_forests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The partition's forest as rows (node a, smallest node b of its tree); grows with its distinct nodes, not with its edges."""
    kept: pd.DataFrame | None = None
    waiting: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        if len(batch):
            waiting.append(batch)
            size += len(batch)
        if size >= GATHERED:
            kept, waiting, size = _forest(pd.concat([kept, *waiting] if kept is not None else waiting)), [], 0
    if waiting:
        kept = _forest(pd.concat([kept, *waiting] if kept is not None else waiting))
    if kept is not None:
        yield kept
