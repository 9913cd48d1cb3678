"""A stored index of vectors: cells around centres, written once and read by cell."""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldreel.functions.columns import usable_vector
from fieldreel.operators.ranking import top_k_per

#: Rows on which the centres are fitted at most; every row is indexed.
FIT_ROWS = 20_000
#: Cells at most, which bounds what is broadcast.
MOST_CELLS = 4_096
#: Cells in one folder of the index: a query reads the folders of its cells only.
FOLDERS = 64


def _unit(x: np.ndarray) -> np.ndarray:
    return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def _centres(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    centre = x[np.random.default_rng(seed).choice(len(x), k, replace=False)]
    for _ in range(rounds):
        cell = (x @ centre.T).argmax(axis=1)
        sums = np.zeros_like(centre)
        np.add.at(sums, cell, x)
        centre = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 1e-9, _unit(sums), centre)
    return centre


def build(df: DataFrame, id: str, vector: str, path: str, *, asset: str | None = None, fit_rows: int = FIT_ROWS) -> None:
    """Write the index of all rows with a usable vector to ``path``: cells (parquet by folder of cells) and centres.

    Centres are fitted by k-means on at most ``fit_rows`` rows chosen by hash of the id; there are about as many as the
    square root of the rows, ``MOST_CELLS`` at most. ``asset`` is kept for searches by distinct asset. An existing index
    at the path is replaced. Null ids are left out.
    """
    rows = df.where(usable_vector(F.col(vector)) & F.col(id).isNotNull()).select(F.col(id).alias("id"), (F.col(asset) if asset else F.lit(None)).cast("string").alias("asset"), F.transform(vector, lambda x: x.cast("float")).alias("v"))
    total = rows.count()
    share = min(1.0, 1.05 * fit_rows / max(1, total))
    sample = rows.where(F.pmod(F.xxhash64(F.lit(3), F.col("id")), F.lit(1 << 30)) < int(share * (1 << 30))).limit(fit_rows).toPandas().sort_values("id")
    x = _unit(np.array(sample["v"].tolist(), np.float32)) if len(sample) else np.zeros((0, 1), np.float32)
    k = max(1, min(MOST_CELLS, isqrt(total), len(x) // 8 or 1))
    centre = _centres(x, k) if len(x) else np.zeros((1, 1), np.float32)
    sent = df.sparkSession.sparkContext.broadcast(centre)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                v = np.array(batch["v"].tolist(), np.float32)
                yield batch.assign(cell=(_unit(v) @ sent.value.T).argmax(axis=1).astype(np.int32))

    placed = rows.mapInPandas(place, f"id {df.schema[id].dataType.simpleString()}, asset string, v array<float>, cell int").withColumn("folder", F.col("cell") % FOLDERS)
    placed.repartition("folder").write.mode("overwrite").partitionBy("folder").parquet(f"{path}/cells")
    spark = df.sparkSession
    spark.createDataFrame([(n, c.tolist()) for n, c in enumerate(centre)], "cell int, v array<float>").coalesce(1).write.mode("overwrite").parquet(f"{path}/centres")


def search(spark: SparkSession, path: str, queries: DataFrame, query_id: str, query: str, k: int, *, probes: int = 16, apart: bool = False, by_asset: bool = False) -> DataFrame:
    """Rows (query_id, id, cosine, rank): the k most similar rows of the index to each query, looked for in its ``probes`` nearest cells; equal ones by id.

    ``apart``: the row with the query's own id is left out. ``by_asset``: only each asset's best row counts. Only the
    folders of the queries' cells are read. The cells' members meet their queries by cell; a cell holds about the square
    root of the rows.
    """
    centre = np.array([r["v"] for r in spark.read.parquet(f"{path}/centres").orderBy("cell").collect()], np.float32)
    sent = spark.sparkContext.broadcast(centre)
    kind = queries.schema[query_id].dataType.simpleString()

    def aim(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                v = np.array(batch["q"].tolist(), np.float32)
                cells = np.argsort(-(_unit(v) @ sent.value.T), axis=1, kind="stable")[:, :probes]
                rows = np.repeat(np.arange(len(batch)), cells.shape[1])
                yield pd.DataFrame({"q_id": batch["q_id"].to_numpy()[rows], "q": batch["q"].to_numpy()[rows], "cell": cells.ravel().astype(np.int32)})

    asked = queries.where(usable_vector(F.col(query))).select(F.col(query_id).alias("q_id"), F.transform(query, lambda x: x.cast("float")).alias("q")).mapInPandas(aim, f"q_id {kind}, q array<float>, cell int").withColumn("folder", F.col("cell") % FOLDERS)
    stored = spark.read.parquet(f"{path}/cells")
    folders = [r["folder"] for r in asked.select("folder").distinct().collect()]
    met = asked.drop("folder").join(stored.where(F.col("folder").isin(folders)).select("id", "asset", "v", "cell"), "cell")
    met = met.where(F.col("q_id") != F.col("id")) if apart else met

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                a, b = (_unit(np.array(batch[c].tolist(), np.float32)).astype(np.float64) for c in ("q", "v"))
                yield batch[["q_id", "id", "asset"]].assign(cosine=(a * b).sum(axis=1))

    scored = met.mapInPandas(score, f"q_id {kind}, id {stored.schema['id'].dataType.simpleString()}, asset string, cosine double")
    if by_asset:
        scored = top_k_per(scored, ["q_id", "asset"], [F.desc("cosine"), F.col("id")], 1).drop("rank")
    best = top_k_per(scored, ["q_id"], [F.desc("cosine"), F.col("id")], k)
    return best.select(F.col("q_id").alias(query_id), "id", "cosine", "rank")


def search_key(spark: SparkSession, path: str, key: object, k: int, **options: object) -> DataFrame:
    """As ``search``, for the stored vector of one id, without itself; an unknown id gives nothing."""
    own = spark.read.parquet(f"{path}/cells").where(F.col("id") == key).select(F.col("id").alias("q_id"), F.col("v").alias("q"))
    return search(spark, path, own, "q_id", "q", k, apart=True, **options)
