"""Stretches of long recordings that speak of a subject, by keywords or by vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldreel.functions.columns import cosine, keyword_score
from fieldreel.functions.media import relevance_rank
from fieldreel.operators.islands import cluster_by_gap, merge_hits
from fieldreel.operators.ranking import greedy_budget, top_k_per
from fieldreel.operators.similarity import literal


def keyword_windows(segments: DataFrame, keywords: dict[str, float], *, pad: float = 45.0, gap: float = 20.0, budget: float = 600.0, least: float = 1.0) -> DataFrame:
    """Rows (entity, start, end, score, n): segments (asset_id, start_sec, end_sec, text) that reach the score, padded, merged, and taken by score per length within the budget."""
    hits = segments.withColumn("_s", keyword_score(F.col("text"), keywords)["score"]).where(F.col("_s") >= least)
    return greedy_budget(merge_hits(hits, "asset_id", "start_sec", "end_sec", "_s", pad=pad, gap=gap), ["entity"], "start", "end", "score", budget)


def similarity_threshold(df: DataFrame, entity: str, value: str, *, floor: float = 0.25, share: float = 0.85) -> DataFrame:
    """Rows (entity, threshold): the floor, or a share of the mean of the entity's best values if higher.

    The best are a twenty-fifth of the values and six, but not under five nor over fourteen of them.
    """
    rows = df.where(F.col(value).isNotNull())
    most = F.greatest(F.lit(5), F.least(F.lit(14), F.floor(F.col("_n") / 25) + 6))
    best = top_k_per(rows, [entity], [F.desc(value)], 14).join(rows.groupBy(entity).agg(F.count("*").alias("_n")), entity).where(F.col("rank") <= most)
    return best.groupBy(entity).agg(F.greatest(F.lit(floor), F.avg(value) * share).alias("threshold"))


def vector_windows(
    chunks: DataFrame, query: list[float], *, gap: float = 30.0, floor: float = 0.25, companions: int = 2, strong: tuple[str, ...] = (), topic: str | None = None, topic_words: tuple[str, ...] = (), named: tuple[str, ...] = (), brands: tuple[str, ...] = ()
) -> DataFrame:
    """Rows (asset_id, start, end, rank_score, role): runs of chunks near a query, the best as ``primary``, further ones as ``companion``.

    ``chunks``: asset_id, start, end, text, vector. Runs begin anew after a gap from the chunk just before. Runs are
    ranked as ``relevance_rank`` says, by the best likeness in each.
    """
    scored = chunks.withColumn("sim", cosine(F.col("vector"), literal(query))).where("sim IS NOT NULL")
    total = chunks.groupBy("asset_id").agg(F.max("end").alias("total"))
    chosen = scored.join(similarity_threshold(scored, "asset_id", "sim", floor=floor), "asset_id").where("sim >= threshold")
    runs = cluster_by_gap(chosen, "asset_id", "start", "end", gap).groupBy("asset_id", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("sim").alias("peak"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "text"))), lambda x: x["text"]), " ").alias("text")).join(total, "asset_id")
    rank = relevance_rank(F.col("peak"), F.col("start"), F.col("end"), F.col("total"), F.col("text"), strong=strong, topic=topic, companions=topic_words, named=named, brands=brands)
    best = top_k_per(runs.withColumn("rank_score", rank), ["asset_id"], [F.desc("rank_score"), F.col("start")], 1 + companions)
    return best.select("asset_id", "start", "end", "rank_score", F.when(F.col("rank") == 1, "primary").otherwise("companion").alias("role"))


def correction_spans(segments: DataFrame, variants: DataFrame, mentioned: DataFrame) -> DataFrame:
    """Rows (asset_id, seg_idx, variant, target): whole-word hits of known misspellings in segments; single words of up to four letters only where the target is known for the asset.

    ``variants``: variant, target. ``mentioned``: asset_id, target.
    """
    from fieldreel.operators.entities import dictionary_matches

    keyed = segments.withColumn("_k", F.struct("asset_id", "seg_idx"))
    hits = dictionary_matches(keyed, "_k", "text", variants.withColumn("_t", F.struct("variant", "target")), "variant", "_t").select("_k.asset_id", "_k.seg_idx", "target.variant", "target.target")
    short = (F.length("variant") <= 4) & ~F.contains(F.col("variant"), F.lit(" "))
    known = mentioned.select("asset_id", "target").distinct()
    return hits.where(~short).union(hits.where(short).join(known, ["asset_id", "target"], "left_semi").select("asset_id", "seg_idx", "variant", "target"))


def registry_scan(people: DataFrame, mentions: DataFrame) -> DataFrame:
    """Rows (category, id, detail) of what looks odd in a registry of persons (id, name, aliases, confidence): titles in names, no short alias, shared surnames, nobody mentions it, noise."""
    words = F.split(F.trim(F.lower("name")), r"\s+")
    title = people.where(F.get(words, 0).isin("mr", "mrs", "ms", "dr", "judge", "officer", "ranger", "prof")).select(F.lit("title").alias("category"), "id", F.col("name").alias("detail"))
    aliasless = people.where((F.size(words) >= 2) & ~F.exists(F.coalesce("aliases", F.array().cast("array<string>")), lambda a: F.lower(a) == F.get(words, 0))).select(F.lit("no_short_alias").alias("category"), "id", F.get(words, 0).alias("detail"))
    surname = people.where(F.size(words) >= 2).select("id", F.element_at(words, -1).alias("s"))
    shared = surname.join(surname.groupBy("s").agg(F.count("*").alias("n")).where("n > 1"), "s").select(F.lit("shared_surname").alias("category"), "id", F.col("s").alias("detail"))
    orphan = people.join(mentions.select("id"), "id", "left_anti").select(F.lit("orphan").alias("category"), "id", F.col("name").alias("detail"))
    noise = people.where(~F.col("name").rlike(r"\p{L}{2}") | F.col("name").rlike(r"\d{3}")).select(F.lit("noise").alias("category"), "id", F.col("name").alias("detail"))
    return title.union(aliasless).union(shared).union(orphan).union(noise)


def unique_names(queue: DataFrame, name: str, aliases: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """Rows (name, id, reason): unmatched names resolved by a rule's exception, else by an alias that one id alone has; reasons: exception, alias, ambiguous, unknown. ``aliases``, ``exceptions``: alias, id."""
    asked = queue.select(F.lower(F.trim(name)).alias("name")).where("name <> ''").distinct()
    one = aliases.select(F.lower(F.trim("alias")).alias("name"), "id").distinct().groupBy("name").agg(F.count("*").alias("n"), F.min("id").alias("by_alias"))
    out = asked.join(one, "name", "left")
    if exceptions is not None:
        out = out.join(exceptions.select(F.lower(F.trim("alias")).alias("name"), F.col("id").alias("by_rule")).dropDuplicates(["name"]), "name", "left")
    else:
        out = out.withColumn("by_rule", F.lit(None).cast("string"))
    reason = F.when(F.col("by_rule").isNotNull(), "exception").when(F.col("n") == 1, "alias").when(F.col("n") > 1, "ambiguous").otherwise("unknown")
    return out.select("name", F.coalesce("by_rule", F.when(F.col("n") == 1, F.col("by_alias"))).alias("id"), reason.alias("reason"))
