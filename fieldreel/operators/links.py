"""Links between recordings by what is said in them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldreel.functions.columns import duration_similarity, jaccard, tokens
from fieldreel.functions.media import name_tokens
from fieldreel.functions.python import Blocks, score_from, text_score
from fieldreel.operators.joins import under_folder
from fieldreel.operators.ranking import margin_gate, top_k_per
from fieldreel.session import cut_lineage

# About as many texts of a block meet in one task's cell, and so many cells are in a task.
CELL, CELLS = 64, 100


def spoken(df: DataFrame, text: str) -> DataFrame:
    """``df`` with words (distinct tokens) and plain (tokens in order) of its text; rows without words are left out."""
    rows = df.withColumn("_w", tokens(F.col(text))).where(F.size("_w") > 0)
    return rows.withColumn("words", F.array_distinct("_w")).withColumn("plain", F.array_join("_w", " ")).drop("_w")


def score_pairs(audio: DataFrame, video: DataFrame, on: list[str]) -> DataFrame:
    """Rows (audio_id, video_id, on.., score) of all pairs that agree in the blocking columns. Both: id, duration, words, plain and ``on``."""
    a = audio.select(*on, F.col("id").alias("audio_id"), F.col("duration").alias("_da"), F.col("words").alias("_wa"), F.col("plain").alias("_pa"))
    b = video.select(*on, F.col("id").alias("video_id"), F.col("duration").alias("_db"), F.col("words").alias("_wb"), F.col("plain").alias("_pb"))
    like: Column = text_score(F.col("_pa"), F.col("_pb"), jaccard(F.col("_wa"), F.col("_wb")), duration_similarity(F.col("_da"), F.col("_db")))
    return a.join(b, on).withColumn("score", like).select("audio_id", "video_id", *on, "score")


def alike_in_blocks(df: DataFrame, keys: list[str], id: str, plain: str, least: float) -> DataFrame:
    """Rows (keys.., a, b, score) of the pairs a < b that share all keys and whose ``text_score`` without durations reaches ``least``. ``plain``: words joined by blanks.

    Equal texts of a block are compared once, and texts travel once for each cell of a block's grid, not for each pair.
    Rows must differ in keys and id; null keys share nothing, and empty texts are like none.
    """
    rows = df.select(*keys, F.col(id).alias("_id"), F.col(plain).alias("_plain")).where("_plain <> ''").dropna(subset=keys)
    texts = cut_lineage(rows.groupBy(*keys, "_plain").agg(F.min("_id").alias("_t"), F.max("_id").alias("_top"), F.array_sort(F.collect_list("_id")).alias("_ids")))
    sizes = texts.groupBy(*keys).agg(F.sum(F.size("_ids")).alias("_n"), F.ceil(F.count("*") / CELL).cast("int").alias("_cuts")).where("_n > 1").drop("_n")
    cells = sizes.agg(F.coalesce(F.sum(F.col("_cuts") * (F.col("_cuts") + 1) / 2), F.lit(0)).cast("bigint").alias("n")).first()["n"]
    each = texts.drop("_ids").join(sizes, keys).withColumn("_cut", F.pmod(F.xxhash64("_t"), F.col("_cuts")).cast("int"))
    each = each.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_cuts") - 1))).withColumn("_lo", F.least("_cut", "_other")).withColumn("_hi", F.greatest("_cut", "_other"))

    def scored(key: tuple, texts: pd.DataFrame) -> pd.DataFrame:
        lo, hi = key[-2:]
        plains, first, top, cut = (texts[c].tolist() for c in ("_plain", "_t", "_top", "_cut"))
        words = [set(p.split(" ")) for p in plains]
        out = []
        for k, p in enumerate(plains):
            blocks = Blocks(p) if len(plains) > 1 else None
            for n, x in enumerate(plains):
                if n == k:
                    if lo == hi and first[k] < top[k]:
                        out.append((first[k], first[k], 0.15 + 0.35 + 0.45))
                elif (lo == hi or cut[n] != cut[k]) and first[n] < top[k]:
                    both = len(words[n] & words[k])
                    score = score_from(least - 1e-9, x, blocks, both / (len(words[n]) + len(words[k]) - both))
                    if score is not None:
                        out.append((first[n], first[k], score))
        return pd.DataFrame(out, columns=["_a", "_b", "score"]).assign(**dict(zip(keys, key))).astype({"score": float})

    kind = rows.schema["_id"].dataType
    schema = T.StructType([T.StructField("_a", kind), T.StructField("_b", kind), T.StructField("score", T.DoubleType()), *(T.StructField(k, rows.schema[k].dataType) for k in keys)])
    cell = [*keys, "_lo", "_hi"]
    found = each.repartition(min(10_000, 1 + cells // CELLS), *cell).groupBy(*cell).applyInPandas(scored, schema)
    found = found.join(texts.select(*keys, F.col("_t").alias("_a"), F.col("_ids").alias("_as")), [*keys, "_a"]).join(texts.select(*keys, F.col("_t").alias("_b"), F.col("_ids").alias("_bs")), [*keys, "_b"])
    pairs = found.select(*keys, F.explode("_as").alias("a"), "_bs", "score").select(*keys, "a", F.explode(F.filter("_bs", lambda b: b > F.col("a"))).alias("b"), "score")
    return pairs.where(F.col("score") >= least)


def primary_links(scored: DataFrame, existing: DataFrame, *, least: float = 0.72, margin: float = 0.12) -> DataFrame:
    """Rows (audio_id, video_id, score, action): the best video of each sound, if good and clear enough. ``existing`` (audio_id, primary_id): another primary link is kept, the same one stays."""
    best = margin_gate(scored, ["audio_id"], "score", [F.col("video_id")], least, margin).where("passed").select("audio_id", "video_id", "score")
    best = best.join(existing.select("audio_id", "primary_id"), "audio_id", "left")
    action = F.when(F.col("primary_id").isNull(), "set").when(F.col("primary_id") == F.col("video_id"), "same").otherwise("kept_other")
    return best.select("audio_id", "video_id", "score", action.alias("action"))


def candidates(scored: DataFrame, k: int = 12) -> DataFrame:
    return top_k_per(scored, ["audio_id"], [F.desc("score"), F.col("video_id")], k)


def folder_links(audio: DataFrame, video: DataFrame, *, least: float = 0.48, margin: float = 0.06) -> DataFrame:
    """Rows (audio_id, video_id, score, passed): sounds below the folder of a video whose name shares a part with theirs. Both: id, path, duration, words, plain."""
    folder = F.regexp_replace(F.regexp_replace("path", r"\\", "/"), "/[^/]*$", "")
    a = audio.select(F.col("id").alias("audio_id"), F.col("path").alias("_pa"), F.col("duration").alias("_da"), F.col("words").alias("_wa"), F.col("plain").alias("_ta"))
    v = video.select(F.col("id").alias("video_id"), folder.alias("_folder"), name_tokens(F.col("path")).alias("_names"), F.col("duration").alias("_dv"), F.col("words").alias("_wv"), F.col("plain").alias("_tv"))
    pairs = under_folder(a, "_pa", v, "_folder").where(F.exists("_names", lambda t: F.contains(F.lower(F.element_at(F.split("_pa", r"[/\\]"), -1)), t)))
    like = text_score(F.col("_ta"), F.col("_tv"), jaccard(F.col("_wa"), F.col("_wv")), duration_similarity(F.col("_da"), F.col("_dv")))
    return margin_gate(pairs.select("audio_id", "video_id", like.alias("score")), ["audio_id"], "score", [F.col("video_id")], least, margin)


def strict_and_relaxed(strict: DataFrame, relaxed: DataFrame) -> DataFrame:
    """Rows (audio_id, strict_id, strict_score, relaxed_id, relaxed_score): best within the label beside best within the day."""
    best = lambda df, n: top_k_per(df, ["audio_id"], [F.desc("score"), F.col("video_id")], 1).select("audio_id", F.col("video_id").alias(f"{n}_id"), F.col("score").alias(f"{n}_score"))
    return best(strict, "strict").join(best(relaxed, "relaxed"), "audio_id", "full_outer")


def add_edges(edges: DataFrame, new: DataFrame, *, both_ways: bool = False) -> DataFrame:
    """Distinct edges (src, dst, kind) with new ones added where absent, and their opposites if asked for."""
    more = new.select("src", "dst", "kind")
    more = more.union(new.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "kind")) if both_ways else more
    return edges.select("src", "dst", "kind").union(more).distinct()


def set_primary(edges: DataFrame, new: DataFrame) -> DataFrame:
    """Edges in which a source's edges of one kind are replaced by its new one."""
    return edges.join(new.select("src", "kind").distinct(), ["src", "kind"], "left_anti").select("src", "dst", "kind").union(new.select("src", "dst", "kind")).distinct()
