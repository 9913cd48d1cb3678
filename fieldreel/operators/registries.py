"""Aggregates and decisions over registries of names, tags and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldreel.functions.columns import normalise
from fieldreel.operators.ranking import top_k_per

# Bounds of groups that are small or huge, and of a tag that is a gap.
SMALL_GROUP, HUGE_GROUP, FEW_RECORDS = 10, 5_000, 5


def names_or_ids(df: DataFrame, id: str, names: DataFrame, key: str, name: str, out: str = "name") -> DataFrame:
    """``df`` with the name of each id, or the id itself where it has none; of several names the first. Null ids stay null."""
    known = names.where(F.col(name).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.min(name).alias("_n"))
    return df.join(known, F.col(id) == F.col("_k"), "left").withColumn(out, F.coalesce("_n", F.col(id))).drop("_k", "_n")


def resolve_labels(labels: DataFrame, label: str, rules: DataFrame, aliases: DataFrame) -> DataFrame:
    """Rows (label, ids, how) of distinct labels: by a rule for the whole label, else each part of a composite by its alias; how is rule, direct, composite, ambiguous or unknown.

    ``rules`` and ``aliases``: alias, id. Parts stand between slashes, commas, ampersands, plus signs and the word and. A
    part that several ids share makes the label ambiguous, one that none has makes it unknown; both give no ids.
    """
    asked = labels.select(F.col(label).alias("label"), normalise(F.col(label)).alias("_q")).where("_q <> ''").distinct()
    rule = rules.groupBy(normalise(F.col("alias")).alias("_q")).agg(F.min("id").alias("_rule"))
    known = aliases.select(normalise(F.col("alias")).alias("_p"), "id").where("_p <> ''").groupBy("_p").agg(F.array_sort(F.collect_set("id")).alias("_ids"))
    split = F.array_distinct(F.filter(F.transform(F.split("label", r"\s*[/,&+]\s*|(?i)\s+and\s+"), normalise), lambda p: p != ""))
    parts = asked.join(rule, "_q", "left").withColumn("_parts", split)
    met = parts.select("label", "_rule", F.size("_parts").alias("_n"), F.explode("_parts").alias("_p")).join(known, "_p", "left")
    size = F.coalesce(F.size("_ids"), F.lit(0))
    found = met.groupBy("label").agg(F.max("_rule").alias("_rule"), F.max("_n").alias("_n"), F.max(size).alias("_most"), F.min(F.when(F.col("_ids").isNull(), 0).otherwise(size)).alias("_least"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("_ids")))).alias("_ids"))
    how = F.when(F.col("_rule").isNotNull(), "rule").when(F.col("_least") < 1, "unknown").when(F.col("_most") > 1, "ambiguous").when(F.col("_n") > 1, "composite").otherwise("direct")
    ids = F.when(how == "rule", F.array("_rule")).when(how.isin("composite", "direct"), F.col("_ids")).otherwise(F.array().cast("array<string>"))
    return found.select("label", ids.alias("ids"), how.alias("how"))


def group_outliers(df: DataFrame, group: str, member: str, value: str, small: int = SMALL_GROUP, huge: int = HUGE_GROUP) -> DataFrame:
    """Rows (group, n, members, mean, size): rows, distinct members and mean value of each group; size is small, huge or usual."""
    out = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count("*").alias("n"), F.count_distinct(member).alias("members"), F.avg(value).alias("mean"))
    return out.withColumn("size", F.when(F.col("n") < small, "small").when(F.col("n") > huge, "huge").otherwise("usual"))


def bucket_statistics(df: DataFrame, bucket: str, value: str, label: str) -> DataFrame:
    """Rows (bucket, n, mean, median, most_common): nulls of the value are left out of mean and median; the most common label is the first of equals."""
    stats = df.groupBy(bucket).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.median(value).alias("median"))
    counts = df.where(F.col(label).isNotNull()).groupBy(bucket, label).agg(F.count("*").alias("_n"))
    top = counts.groupBy(bucket).agg(F.min(F.struct((-F.col("_n")).alias("c"), F.col(label).alias("l")))["l"].alias("most_common"))
    return stats.withColumnRenamed(bucket, "_b").join(top, F.col("_b").eqNullSafe(F.col(bucket)), "left").select(F.col("_b").alias(bucket), "n", "mean", "median", "most_common")


def variant_clusters(df: DataFrame, kind: str, target: str, variant: str, asset: str, distance: str) -> DataFrame:
    """Rows (kind, target, variants, assets, distance, n): of each target its variants with their counts, most frequent first, its assets, and the least distance."""
    counts = df.groupBy(kind, target, variant).agg(F.count("*").alias("_n"), F.min(distance).alias("_d"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("_n")).alias("c"), F.col(variant).alias("v"))))
    variants = counts.groupBy(kind, target).agg(F.transform(order, lambda x: F.struct(x["v"].alias("variant"), (-x["c"]).alias("n"))).alias("variants"), F.min("_d").alias("distance"), F.sum("_n").alias("n"))
    assets = df.groupBy(kind, target).agg(F.array_sort(F.collect_set(asset)).alias("assets"))
    return variants.join(assets, [kind, target])


def candidate_summary(df: DataFrame, name: str, kind: str, id: str, context: str, contexts: int = 5) -> DataFrame:
    """Rows (key, name, n, kinds, ids, contexts): of each normalised name its most frequent spelling, kinds, ids, and the first contexts in their order."""
    rows = df.withColumn("_key", normalise(F.col(name))).where("_key <> ''")
    spelled = rows.groupBy("_key", name).agg(F.count("*").alias("_n")).groupBy("_key").agg(F.min(F.struct((-F.col("_n")).alias("c"), F.col(name).alias("s")))["s"].alias("name"), F.sum("_n").alias("n"))
    sets = rows.groupBy("_key").agg(F.array_sort(F.collect_set(kind)).alias("kinds"), F.array_sort(F.collect_set(id)).alias("ids"))
    shown = top_k_per(rows.where(F.col(context).isNotNull()).select("_key", context).distinct(), ["_key"], [F.col(context)], contexts).groupBy("_key").agg(F.array_sort(F.collect_list(context)).alias("contexts"))
    out = spelled.join(sets, "_key").join(shown, "_key", "left")
    return out.select(F.col("_key").alias("key"), "name", "n", "kinds", "ids", F.coalesce("contexts", F.array().cast("array<string>")).alias("contexts"))


def best_names(df: DataFrame, group: str, name: str, priority: str, confidence: str) -> DataFrame:
    """Rows (group, canonical, aliases, confidence): the name of least priority number, the longest, then the first of equals; all others are aliases; confidence is the highest."""
    best = F.min(F.struct(F.col(priority).alias("p"), (-F.length(name)).alias("l"), F.col(name).alias("v")))["v"]
    out = df.where(F.col(group).isNotNull() & F.col(name).isNotNull()).groupBy(group).agg(best.alias("canonical"), F.array_sort(F.collect_set(name)).alias("_all"), F.max(confidence).alias("confidence"))
    return out.select(group, "canonical", F.array_remove("_all", F.col("canonical")).alias("aliases"), "confidence")


def tag_coverage(tags: DataFrame, tag: str, records: DataFrame, of: str, duration: str, rich: Column, few: int = FEW_RECORDS) -> DataFrame:
    """Rows (tag, n, seconds, rich, gap) of all tags, also of those without records (an array column ``of`` names a record's tags): a tag is a gap with few records or none that is rich."""
    held = records.select(F.explode(F.array_distinct(of)).alias("_t"), F.col(duration).alias("_d"), F.coalesce(rich, F.lit(False)).cast("int").alias("_r")).groupBy("_t").agg(F.count("*").alias("n"), F.coalesce(F.sum("_d"), F.lit(0.0)).alias("seconds"), F.sum("_r").alias("rich"))
    out = tags.select(F.col(tag)).distinct().join(held, F.col(tag) == F.col("_t"), "left").select(tag, *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "seconds", "rich")))
    return out.withColumn("gap", (F.col("n") < few) | (F.col("rich") == 0))


def budget_left(df: DataFrame, cost: str, limit: float) -> DataFrame:
    """One row (spent, remaining, over): the sum of what was spent, 0 for nothing."""
    return df.agg(F.coalesce(F.sum(cost), F.lit(0.0)).alias("spent")).select("spent", (F.lit(limit) - F.col("spent")).alias("remaining"), (F.col("spent") > limit).alias("over"))


def top_mentions(df: DataFrame, terms: str, k: int) -> DataFrame:
    """Rows (term, n): the k terms that the array column names most often, the first of equals."""
    return df.select(F.explode(terms).alias("term")).where("term IS NOT NULL").groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(k)


def carry_over(new: DataFrame, old: DataFrame, at: str, number: str, value: str) -> DataFrame:
    """``new`` with the value that an old row of the same asset, time to the hundredth and number had; the smallest of several."""
    key = lambda: (F.col("asset_id"), F.bround(F.col(at), 2).alias("_t"), F.col(number).alias("_n"))
    known = old.where(F.col(value).isNotNull()).select(*key(), F.col(value).alias("_v")).groupBy("asset_id", "_t", "_n").agg(F.min("_v").alias("_v"))
    out = new.withColumn("_t", F.bround(F.col(at), 2)).withColumn("_n", F.col(number)).join(known, ["asset_id", "_t", "_n"], "left")
    return out.withColumn(value, F.col("_v")).drop("_t", "_n", "_v")


def top_then_threshold(df: DataFrame, window: list[str], score: str, ties: list[Column], k: int, least: float) -> DataFrame:
    """The k best rows of each window, ranked from 1, of which those below the threshold are then left out."""
    return top_k_per(df.where(F.col(score).isNotNull()), window, [F.desc(score), *ties], k).where(F.col(score) >= least)


def distinct_asset_top_k(df: DataFrame, by: list[str], asset: str, score: str, ties: list[Column], k: int) -> DataFrame:
    """The k best rows of each group of which no two are of one asset: each asset's best only."""
    best = top_k_per(df, [*by, asset], [F.desc(score), *ties], 1).drop("rank")
    return top_k_per(best, by, [F.desc(score), *ties], k)


def context_words(words: DataFrame, entity: str, at: list[str], word: str, before: int = 7, after: int = 6) -> DataFrame:
    """``words`` with the words around each, in the order of ``at``: a row reaches back and ahead by so many. One entity's words are ordered in one task."""
    near = Window.partitionBy(entity).orderBy(*at).rowsBetween(-before, after)
    return words.where(F.col(entity).isNotNull()).withColumn("context", F.array_join(F.collect_list(word).over(near), " "))


def signal_rank(df: DataFrame, quotes: str, seconds: str, by: list[str], k: int) -> DataFrame:
    """The k rows of each group with the strongest signal: a hundred for each quote and one for each minute; of equals the longer, then by id columns as they stand."""
    signal = F.coalesce(F.col(quotes), F.lit(0)) * 100 + F.coalesce(F.col(seconds), F.lit(0.0)) / 60
    return top_k_per(df.withColumn("signal", signal), by, [F.desc("signal"), F.desc(seconds), *(F.col(c) for c in df.columns if c.endswith("_id") and c not in by)], k)


def apply_decisions(registry: DataFrame, records: DataFrame, queue: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Registry, records and queue after decisions (name, action, id): ``accept`` adds the name to the aliases of its id, or a new entry, and the id to the records that ask for the name; ``accept`` and ``reject`` take it off the queue.

    ``registry``: id, aliases. ``records``: record_id, ids. ``queue``: name, record_id. Of several decisions on a name the
    first by action, then id, counts. Ids and aliases come out sorted and once.
    """
    decided = decisions.where(F.col("action").isin("accept", "reject")).groupBy("name").agg(F.min(F.struct("action", "id")).alias("d")).select("name", "d.action", "d.id")
    taken = decided.where("action = 'accept' AND id IS NOT NULL")
    more = taken.groupBy("id").agg(F.collect_set("name").alias("_more"))
    none = F.array().cast("array<string>")
    merged = registry.join(more, "id", "full_outer").select("id", F.array_sort(F.array_union(F.coalesce("aliases", none), F.coalesce("_more", none))).alias("aliases"))
    ids = queue.join(taken.select("name", "id"), "name").groupBy("record_id").agg(F.collect_set("id").alias("_ids"))
    filled = records.join(ids, "record_id", "left").select("record_id", F.array_sort(F.array_union(F.coalesce("ids", none), F.coalesce("_ids", none))).alias("ids"))
    return merged, filled, queue.join(decided.select("name"), "name", "left_anti")
