"""Most similar vectors for every vector: a hierarchical k-means tree, searched best bin first."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldreel.session import cut_lineage

#: Rows on which one level of the tree is fitted; every row is indexed and searched.
FIT_ROWS = 20_000
#: Children of an inner node.
BRANCHING = 32
#: Rows that a leaf holds at most on average. Smaller tables have leaves of about the square root of their rows.
LEAF_ROWS = 1_000
#: Sample rows that a leaf is fitted on at least.
LEAF_SAMPLE = 32
#: Leaves of the whole tree at most, which bounds what is broadcast; beyond LEAF_ROWS times as many rows, leaves grow.
MOST_LEAVES = 131_072
#: Rows of a leaf that one task compares at most on average; larger leaves are split by key.
BLOCK_ROWS = 8_000
#: Vectors whose true neighbours over all rows calibrate how far the search widens.
PROBES = 1_000
#: Leaves up to which the calibration follows a probe's queue.
FOLLOWED = 64
#: Margin and leaves where no probe has a neighbour to calibrate on.
SAFE_MARGIN, SAFE_VISITS = 0.05, 16
#: Queries that an exact search sends to the workers at once.
SENT_QUERIES = 32_768
#: Numbers of similarities held at once.
CELLS = 2_000_000


def unit_vectors(blobs: list[bytes], dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the usable blobs, and which blobs are usable: of the exact length, all finite, not all zero."""
    ok = np.array([b is not None and len(b) == 4 * dim for b in blobs], dtype=bool)
    x = np.frombuffer(b"".join(bytes(b) for b, good in zip(blobs, ok, strict=True) if good), "<f4").reshape(-1, dim).astype(np.float64)
    fine = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
    ok[np.flatnonzero(ok)[~fine]] = False
    x = x[fine]
    x = x / np.abs(x).max(axis=1, keepdims=True) if len(x) else x
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32) if len(x) else x.astype(np.float32), ok


@dataclass
class Tree:
    """Parents before children; the children of node i are first[i] .. first[i] + children[i] - 1; leaf is -1 inside.

    ``tight`` is the mean cosine of a node's rows with its centre, ``weight`` its share of the rows of its parent.
    """

    centre: np.ndarray
    first: np.ndarray
    children: np.ndarray
    leaf: np.ndarray
    tight: np.ndarray
    weight: np.ndarray

    def __post_init__(self) -> None:
        # what a row gains on average between a node's score and that of its leaf below: inner centres score lower by nature
        below = self.tight.astype(np.float64).copy()
        for at in np.flatnonzero(self.children)[::-1]:
            part = slice(self.first[at], self.first[at] + self.children[at])
            below[at] = np.average(below[part], weights=self.weight[part])
        self.lift = (below - self.tight).astype(np.float32)

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def visits(self, x: np.ndarray, most: int, margin: float = np.inf) -> tuple[np.ndarray, np.ndarray]:
        """The leaves that each row visits, best bin first, and how far below the first leaf's score the queue had fallen at each; -1 where there are no more.

        All rows advance together: each pops the best entry of its own queue; a popped leaf is a visit, a popped inner
        node puts its children in the queue. A row stops after ``most`` leaves, or when its best entry lies more than
        ``margin`` below its first leaf's score.
        """
        n, most = len(x), min(most, self.leaves)
        out = np.full((n, most), -1, dtype=np.int32)
        fell = np.full((n, most), np.inf, dtype=np.float32)
        queue = np.full((n, 2 * BRANCHING), -np.inf, dtype=np.float32)
        node = np.zeros((n, 2 * BRANCHING), dtype=np.int32)
        queue[:, 0] = 1
        fill, done = np.ones(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        home, low = np.full(n, np.nan, dtype=np.float32), np.full(n, np.inf, dtype=np.float32)
        live = np.arange(n)
        while live.size:
            best = queue[live].argmax(axis=1)
            top, score = node[live, best], queue[live, best]
            queue[live, best] = -np.inf
            started = ~np.isnan(home[live])
            low[live] = np.where(started, np.minimum(low[live], score), low[live])
            go = (score > -np.inf) & ~(started & (home[live] - score > margin))
            live, top, score, started = live[go], top[go], score[go], started[go]
            is_leaf = self.leaf[top] >= 0
            rows = live[is_leaf]
            first = rows[~started[is_leaf]]
            home[first], low[first] = score[is_leaf & ~started], score[is_leaf & ~started]
            out[rows, done[rows]] = self.leaf[top[is_leaf]]
            fell[rows, done[rows]] = home[rows] - low[rows]
            done[rows] += 1
            rows, tops = live[~is_leaf], top[~is_leaf]
            order = np.argsort(tops, kind="stable")
            for group in np.split(order, np.flatnonzero(np.diff(tops[order])) + 1) if order.size else []:
                r, parent = rows[group], tops[group[0]]
                lo, k = self.first[parent], self.children[parent]
                at = fill[r][:, None] + np.arange(k)
                if at.max() >= queue.shape[1]:
                    queue = np.pad(queue, ((0, 0), (0, queue.shape[1])), constant_values=-np.inf)
                    node = np.pad(node, ((0, 0), (0, node.shape[1])))
                queue[r[:, None], at] = x[r] @ self.centre[lo : lo + k].T + self.lift[lo : lo + k]
                node[r[:, None], at] = np.arange(lo, lo + k)
                fill[r] += k
            live = live[done[live] < most]
        return out, fell


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    """Group of each row."""
    centre = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        group = (x @ centre.T).argmax(axis=1)
        sums = np.zeros_like(centre)
        np.add.at(sums, group, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centre = np.where(norm > 1e-12, sums / np.maximum(norm, 1e-12), centre)
    return (x @ centre.T).argmax(axis=1)


def fit_tree(x: np.ndarray, leaf_sample: int, seed: int = 7) -> Tree:
    """Split by k-means until a node holds at most ``leaf_sample`` rows or can't be split."""
    rng = np.random.default_rng(seed)
    dim = x.shape[1]
    centre, first, children, leaf, rows = [np.zeros(dim, np.float32)], [0], [0], [-1], [np.arange(len(x))]
    tight, weight = [0.0], [1.0]
    at = leaves = 0
    while at < len(centre):
        own = rows[at]
        groups: list[np.ndarray] = []
        if len(own) > leaf_sample:
            group = _kmeans(x[own], min(BRANCHING, max(2, ceil(len(own) / leaf_sample))), rng)
            groups = [g for k in range(group.max() + 1) if (g := own[group == k]).size]
        if len(groups) > 1:
            first[at], children[at] = len(centre), len(groups)
            for g in groups:
                mean = x[g].mean(axis=0)
                centre.append((mean / max(np.linalg.norm(mean), 1e-12)).astype(np.float32))
                tight.append(float(np.linalg.norm(mean))), weight.append(len(g) / len(own))
                first.append(0), children.append(0), leaf.append(-1), rows.append(g)
        else:
            leaf[at] = leaves
            leaves += 1
        rows[at] = np.empty(0, int)
        at += 1
    return Tree(np.array(centre, np.float32), np.array(first), np.array(children), np.array(leaf, np.int32), np.array(tight, np.float32), np.array(weight, np.float32))


def graft(tree: Tree, below: dict[int, Tree]) -> Tree:
    """The tree with some of its leaves replaced by trees; leaves are numbered anew."""
    centre, first, children, tight, weight = [tree.centre], [tree.first.copy()], [tree.children.copy()], [tree.tight], [tree.weight]
    size = len(tree.first)
    for leaf, sub in sorted(below.items()):
        at = int(np.flatnonzero(tree.leaf == leaf)[0])
        # the root of the subtree is the leaf's node itself
        first[0][at], children[0][at] = sub.first[0] - 1 + size, sub.children[0]
        centre.append(sub.centre[1:]), first.append(sub.first[1:] - 1 + size), children.append(sub.children[1:])
        tight.append(sub.tight[1:]), weight.append(sub.weight[1:])
        size += len(sub.first) - 1
    all_children = np.concatenate(children)
    number = np.where(all_children == 0, np.cumsum(all_children == 0) - 1, -1).astype(np.int32)
    return Tree(np.concatenate(centre), np.concatenate(first), all_children, number, np.concatenate(tight), np.concatenate(weight))


def _best_rows(i: np.ndarray, j_key: np.ndarray, c: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best entries of each i, by c, then key."""
    order = np.lexsort((j_key, -c, i))
    s = i[order]
    start = np.r_[0, np.flatnonzero(np.diff(s)) + 1] if len(s) else np.empty(0, int)
    rank = np.arange(len(s)) - np.repeat(start, np.diff(np.r_[start, len(s)])) if len(s) else np.empty(0, int)
    return order[rank < k]


def nearest(q: np.ndarray, q_key: np.ndarray, x: np.ndarray, x_key: np.ndarray, k: int, least: float, both_ways: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of q, row of x, cosine) of the k most similar x under other keys with cosine >= least; ties go to the smaller key. ``both_ways``: also of the k most similar q of each x."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    back: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    step = max(1, CELLS // max(1, len(x)))
    for at in range(0, len(q), step):
        cos = q[at : at + step] @ x.T
        i, j = np.nonzero(cos >= least)
        i, j = i[(other := q_key[at + i] != x_key[j])], j[other]
        c = cos[i, j]
        keep = _best_rows(i, x_key[j], c, k)
        found.append((at + i[keep], j[keep], c[keep]))
        if both_ways:
            keep = _best_rows(j, q_key[at + i], c, k)
            back.append((at + i[keep], j[keep], c[keep]))
    if back:
        i, j, c = (np.concatenate(part) for part in zip(*back, strict=True))
        keep = _best_rows(j, q_key[i], c, k)
        found.append((i[keep], j[keep], c[keep]))
    return tuple(np.concatenate(part) for part in zip(*found, strict=True)) if found else (np.empty(0, int), np.empty(0, int), np.empty(0))


def _usable(df: DataFrame, key: str, blob: str, dim: int) -> DataFrame:
    """Rows (key, blob) of a key and the right length, not all zero bytes; values are looked at in Python."""
    return df.select(F.col(key).alias("key"), F.col(blob).alias("blob")).where(F.col(key).isNotNull() & (F.length(blob) == 4 * dim) & (F.col(blob) != F.lit(bytes(4 * dim))))


def exact_neighbours(df: DataFrame, key: str, blob: str, dim: int, queries: pd.DataFrame, k: int, least: float) -> DataFrame:
    """Rows (asked, key, cosine, vec): of each query (key, blob) the k most similar other rows of at least ``least``, by a scan of all rows against the queries, which are sent along. Callers bound the queries."""
    q, ok = unit_vectors(list(queries["blob"]), dim)
    sent = df.sparkSession.sparkContext.broadcast((q, queries["key"].to_numpy()[ok]))
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q, q_key = sent.value
        for batch in batches:
            v, good = unit_vectors(list(batch["blob"]), dim)
            keys = batch["key"].to_numpy()[good]
            i, j, c = nearest(q, q_key, v, keys, k, least)
            yield pd.DataFrame({"asked": q_key[i], "key": keys[j], "cosine": c.astype(float), "vec": [r.tobytes() for r in v[j]]})

    near = _usable(df, key, blob, dim).mapInPandas(run, f"asked {kind}, key {kind}, cosine double, vec binary").dropDuplicates(["asked", "key"])
    best: list[Column] = [F.desc("cosine"), F.col("key")]
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("asked").orderBy(*best))).where(F.col("rank") <= k).drop("rank")


def calibrate(tree: Tree, probe: np.ndarray, near: np.ndarray, recall: float) -> tuple[float, int]:
    """The least margin, and leaves, by which the share ``recall`` of pairs (a probe and a true neighbour) is found: one of both visits the other's leaf. Rows of both arrays belong together."""
    if not len(probe):
        return SAFE_MARGIN, SAFE_VISITS
    ways = [tree.visits(x, FOLLOWED) for x in (probe, near)]
    gap, rank = [], []
    for (leaf, fell), (other, _) in (ways, ways[::-1]):
        hit = leaf == other[:, :1]
        at = hit.argmax(axis=1)
        missed = ~hit.any(axis=1)
        gap.append(np.where(missed, np.inf, fell[np.arange(len(at)), at]))
        rank.append(at)
    way = np.argmin(gap, axis=0)
    gap_of, rank_of = np.choose(way, gap), np.choose(way, rank)
    margin = float(np.sort(gap_of)[ceil(recall * len(gap_of)) - 1])
    within = gap_of <= margin
    return margin + 1e-6, int(rank_of[within].max()) + 1


def _refined(rows: DataFrame, kind: str, dim: int, tree: Tree, per_leaf: np.ndarray, leaf_rows: float, fit_rows: int, leaf_sample: int) -> Tree:
    """Each leaf of the tree split further: fitted where its sampled rows meet, at most about ``fit_rows`` of them. Only the centres come to the driver."""
    spark = rows.sparkSession
    rate = np.minimum(min(1.0, leaf_sample / leaf_rows), fit_rows / np.maximum(per_leaf, 1))
    sent = spark.sparkContext.broadcast((tree, rate))

    def sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, rate = sent.value
        for batch in batches:
            draw = pd.util.hash_array(batch["key"].to_numpy(), categorize=False) / 2.0**64
            batch = batch[draw <= rate.max()]
            draw = draw[draw <= rate.max()]
            v, ok = unit_vectors(list(batch["blob"]), dim)
            if len(v):
                leaf = tree.visits(v, 1)[0][:, 0]
                keep = draw[ok] <= rate[leaf]
                yield pd.DataFrame({"leaf": leaf[keep], "vec": [r.tobytes() for r in v[keep]]})

    def fit(part: pd.DataFrame) -> pd.DataFrame:
        v = np.frombuffer(b"".join(part["vec"].sort_values()), np.float32).reshape(-1, dim)
        sub = fit_tree(v, leaf_sample)
        return pd.DataFrame({"leaf": part["leaf"].iloc[0], "node": np.arange(len(sub.first)), "centre": [c.tobytes() for c in sub.centre], "first": sub.first, "children": sub.children, "number": sub.leaf, "tight": sub.tight, "weight": sub.weight})

    parts = rows.mapInPandas(sample, "leaf int, vec binary").groupBy("leaf").applyInPandas(fit, "leaf int, node int, centre binary, first int, children int, number int, tight float, weight float").toPandas()
    below = {}
    for leaf, part in parts.groupby("leaf"):
        part = part.sort_values("node")
        if len(part) > 1:
            below[int(leaf)] = Tree(np.frombuffer(b"".join(part["centre"]), np.float32).reshape(-1, dim), part["first"].to_numpy(), part["children"].to_numpy(), part["number"].to_numpy(np.int32), part["tight"].to_numpy(), part["weight"].to_numpy())
    return graft(tree, below)


def _copies(rows: DataFrame, kind: str, dim: int, k: int) -> tuple[DataFrame, DataFrame]:
    """Rows that the search needs, and the pairs (key, other, cosine) of the rest: of equal blobs only the k + 1 smallest keys can be among the k most similar of any row, so further copies pair with the first k at once."""
    marked = rows.withColumns({"h1": F.xxhash64("blob"), "h2": F.xxhash64(F.lit(1), F.col("blob"))})
    many = marked.groupBy("h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") > k + 1).select("h1", "h2")
    first = marked.join(many, ["h1", "h2"]).select("h1", "h2", "key", "blob").dropDuplicates(["h1", "h2", "key"])
    first = first.withColumn("rank", F.row_number().over(Window.partitionBy("h1", "h2").orderBy("key"))).where(F.col("rank") <= k + 1)
    limits = first.groupBy("h1", "h2").agg(F.array_sort(F.collect_list("key")).alias("least"), F.any_value("blob").alias("blob"))

    def good(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.loc[unit_vectors(list(batch["blob"]), dim)[1], ["h1", "h2", "least"]]

    limits = cut_lineage(limits.where(F.size("least") > k).mapInPandas(good, f"h1 bigint, h2 bigint, least array<{kind}>"))
    both = marked.join(limits, ["h1", "h2"], "left")
    further = F.coalesce(F.col("key") > F.element_at("least", k + 1), F.lit(False))
    pairs = both.where(further).select("key", F.explode(F.slice("least", 1, k)).alias("other"), F.lit(1.0).alias("cosine")).distinct()
    return both.where(~further).select("key", "blob"), pairs


def similar_pairs(
    df: DataFrame, key: str, blob: str, dim: int, *, k: int = 5, least: float = 0.8, recall: float = 0.995, fit_rows: int = FIT_ROWS, leaf_rows: int = LEAF_ROWS, leaf_sample: int = LEAF_SAMPLE, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Distinct rows (key_lo, key_hi, cosine): pairs of different keys with cosine of at least ``least`` in which one is among the ``k`` most similar of the other.

    Blobs are little-endian float32; one that is null, of another length, not finite or all zero is left out, as are
    null keys. Vectors need not have length one. Repeated rows count once. Among equal cosines the smaller key is the
    more similar; equal vectors under different keys are pairs of cosine 1. An empty table, or one without usable
    vectors, gives no rows. Other columns are ignored.

    The tree is fitted on at most ``fit_rows`` rows chosen by hash of the key; where its leaves would hold more than
    ``leaf_rows`` (for small tables, more than about the square root of the rows), each leaf is split further from a
    sample of its own rows where they lie, so leaves stay of one size as the table grows; the whole tree has at most
    about ``MOST_LEAVES`` leaves and is broadcast. Every row goes to its leaf and, best bin first, to further leaves
    until their scores fall more than a margin below the first. The margin is the least by which ``recall`` of the
    true neighbours of ``PROBES`` rows over the whole table is found. What meets in a leaf counts for both sides.

    Copies of one blob beyond the first k + 1 keys skip the search: their k most similar are known. Leaves expected to
    hold or to be visited by more than ``block_rows`` rows are cut by key into a grid of blocks.
    """
    spark = df.sparkSession
    kind = df.schema[key].dataType.simpleString()
    schema = f"key_lo {kind}, key_hi {kind}, cosine double"
    rows = _usable(df, key, blob, dim)
    copied = rows.groupBy(F.xxhash64("blob").alias("h")).agg(F.count("*").alias("n")).agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    total = copied["rows"] or 0
    twins = None
    if total and copied["most"] > k + 1:
        rows, twins = _copies(rows, kind, dim, k)
    share = F.pmod(F.xxhash64(F.lit(7), F.col("key")), F.lit(1 << 30)) < int((1 << 30) * min(1.0, 1.05 * fit_rows / max(1, total)))
    sample = rows.where(share).limit(fit_rows).toPandas().drop_duplicates("key").sort_values("key", kind="stable")
    x, ok = unit_vectors(list(sample["blob"]), dim)
    if len(x) < 2:
        none = spark.createDataFrame([], schema)
        return none if twins is None else none.union(twins.select(F.least("key", "other"), F.greatest("key", "other"), "cosine").distinct())
    own_rows = max(16, min(leaf_rows, isqrt(total)), total / MOST_LEAVES)
    tree = fit_tree(x, max(min(leaf_sample, own_rows), int(len(x) * own_rows / total)))
    if total > 2 * own_rows * tree.leaves:
        per_leaf = np.bincount(tree.visits(x, 1)[0][:, 0], minlength=tree.leaves) * (total / len(x))
        tree = _refined(rows, kind, dim, tree, per_leaf, own_rows, fit_rows, leaf_sample)
    probes = sample[ok].iloc[np.random.default_rng(7).permutation(len(x))[:PROBES]]
    truth = exact_neighbours(rows, "key", "blob", dim, probes, k, least).toPandas()
    at = pd.Series(np.arange(len(x)), index=sample["key"][ok])
    near = np.frombuffer(b"".join(truth["vec"]), np.float32).reshape(-1, dim)
    margin, most = calibrate(tree, x[at[truth["asked"]].to_numpy(int)], near, recall)
    seen = np.concatenate([tree.visits(x[a : a + 4096], most, margin)[0] for a in range(0, len(x), 4096)])
    scale = total / len(x) / block_rows
    cuts = np.maximum(1, np.ceil(np.bincount(seen[:, 0], minlength=tree.leaves) * scale)).astype(int)
    asked = np.maximum(1, np.ceil(np.bincount(seen[seen >= 0], minlength=tree.leaves) * scale)).astype(int)
    shared = spark.sparkContext.broadcast((tree, most, margin, cuts, asked))

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree, most, margin, cuts, asked = shared.value
        for batch in batches:
            batch = batch.drop_duplicates("key")
            v, ok = unit_vectors(list(batch["blob"]), dim)
            keys = batch["key"].to_numpy()[ok]
            if not len(v):
                continue
            raw = np.array([r.tobytes() for r in v] + [None], dtype=object)[:-1]
            salt = pd.util.hash_array(keys).astype(np.uint64)
            leaf = tree.visits(v, most, margin)[0]
            row, nth = np.nonzero(leaf >= 0)
            own = leaf[row, nth]
            # a query goes to every part of the leaf's rows, in one of its parts of queries
            times = cuts[own]
            q_row, q_leaf = np.repeat(row, times), np.repeat(own, times)
            q_part = np.arange(len(q_row)) - np.repeat(np.cumsum(times) - times, times)
            q_ask = (salt[q_row] // np.uint64(65_537) % asked[q_leaf].astype(np.uint64)).astype(int)
            home = leaf[:, 0]
            times = asked[home]
            m_row, m_leaf = np.repeat(np.arange(len(v)), times), np.repeat(home, times)
            m_ask = np.arange(len(m_row)) - np.repeat(np.cumsum(times) - times, times)
            m_part = (salt[m_row] % cuts[m_leaf].astype(np.uint64)).astype(int)
            both = pd.DataFrame({
                "leaf": np.r_[q_leaf, m_leaf], "part": np.r_[q_part, m_part], "ask": np.r_[q_ask, m_ask], "row": np.r_[q_row, m_row], "query": np.r_[np.ones(len(q_row), bool), np.zeros(len(m_row), bool)], "member": np.r_[np.zeros(len(q_row), bool), np.ones(len(m_row), bool)]
            })
            both = both.groupby(["leaf", "part", "ask", "row"], as_index=False, sort=False)[["query", "member"]].max()
            yield pd.DataFrame({"leaf": both["leaf"].astype("int32"), "part": both["part"].astype("int32"), "ask": both["ask"].astype("int32"), "key": keys[both["row"]], "vec": raw[both["row"]], "query": both["query"], "member": both["member"]})

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        block = block.drop_duplicates(["key", "query", "member"]).sort_values("key", kind="stable")
        v = np.frombuffer(b"".join(block["vec"]), np.float32).reshape(-1, dim)
        keys, q, m = block["key"].to_numpy(), block["query"].to_numpy(), block["member"].to_numpy()
        i, j, c = nearest(v[q], keys[q], v[m], keys[m], k, least, both_ways=True)
        a, b, c = keys[q][i], keys[m][j], c.astype(float)
        return pd.DataFrame({"key": np.r_[a, b], "other": np.r_[b, a], "cosine": np.r_[c, c]}).drop_duplicates(["key", "other"])

    met = rows.mapInPandas(spread, f"leaf int, part int, ask int, key {kind}, vec binary, query boolean, member boolean")
    near = met.groupBy("leaf", "part", "ask").applyInPandas(compare, f"key {kind}, other {kind}, cosine double")
    # one exchange by key serves both the removal of repeats and the ranking
    near = near.repartition("key").groupBy("key", "other").agg(F.max("cosine").alias("cosine"))
    order: list[Column] = [F.desc("cosine"), F.col("other")]
    near = near.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy(*order))).where(F.col("rank") <= k).drop("rank")
    if twins is not None:
        near = near.union(twins)
    pairs = near.select(F.least("key", "other").alias("key_lo"), F.greatest("key", "other").alias("key_hi"), "cosine")
    return pairs.groupBy("key_lo", "key_hi").agg(F.max("cosine").alias("cosine"))


def measured_recall(df: DataFrame, key: str, blob: str, dim: int, asked: Column, *, k: int = 5, least: float = 0.8) -> DataFrame:
    """One row (queries, neighbours, found, recall): of the rows where ``asked`` holds, how many of their k most similar others of at least ``least``, by exact search over all rows, ``similar_pairs`` gives.

    Queries are sent in pieces of ``SENT_QUERIES``, one scan each. Recall is null where there is no neighbour.
    """
    spark = df.sparkSession
    pairs = similar_pairs(df, key, blob, dim, k=k, least=least)
    chosen = _usable(df.where(asked), key, blob, dim).dropDuplicates(["key"])
    total = chosen.count()
    pieces = -(-max(1, total) // SENT_QUERIES)
    parts = []
    for piece in range(pieces):
        queries = chosen.where(F.pmod(F.xxhash64("key"), F.lit(pieces)) == piece).toPandas()
        parts.append(exact_neighbours(df, key, blob, dim, queries, k, least).select(F.least("asked", "key").alias("key_lo"), F.greatest("asked", "key").alias("key_hi")))
    truth = parts[0]
    for part in parts[1:]:
        truth = truth.union(part)
    met = truth.join(pairs.select("key_lo", "key_hi", F.lit(1).alias("hit")), ["key_lo", "key_hi"], "left")
    found = met.agg(F.count("*").alias("neighbours"), F.count("hit").alias("found"))
    return found.select(F.lit(total).cast("bigint").alias("queries"), "neighbours", "found", F.try_divide("found", "neighbours").alias("recall"))
