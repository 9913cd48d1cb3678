"""Dictionary, alias, fuzzy and phonetic matching of names, and registry merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldreel.functions.columns import normalise, normalised_distance, phonetic_key
from fieldreel.functions.python import alike_pairs, fold
from fieldreel.operators.ranking import top_k_per
from fieldreel.session import cut_lineage, steady

# About as many distinct names are in a block when all meet all.
BLOCK = 2_000


def folded(name: Column) -> Column:
    """Name in lower case without accents and articles; other signs become single blanks."""
    return F.trim(F.regexp_replace(normalise(fold(name)), r"(?:^| )(?:the|a|an)(?= |$)", ""))


def dictionary_matches(df: DataFrame, id: str, text: str, phrases: DataFrame, phrase: str, target: str) -> DataFrame:
    """Distinct rows (id, target, phrase): phrases that stand in the text as whole words, without case.

    Runs of words meet the phrases by equality, in the lengths that follow the run's first word in some phrase, so the
    dictionary may be of any size and its phrases of any length. A match inside a
    longer match that begins with it, at the same word, is left out.
    """
    known = phrases.select(normalise(F.col(phrase)).alias("_run"), F.col(target).alias("target")).where("_run <> ''").distinct()
    sizes = known.select(F.split("_run", " ").alias("_p")).select(F.col("_p")[0].alias("_first"), F.size("_p").alias("n")).groupBy("_first").agg(F.collect_set("n").alias("_sizes"))
    words = F.filter(F.split(normalise(F.coalesce(F.col(text), F.lit(""))), " "), lambda w: w != "")
    longest = known.agg(F.coalesce(F.max(F.size(F.split("_run", " "))), F.lit(0)).alias("_longest"))
    runs = df.select(F.col(id), words.alias("_w")).select(id, "_w", F.posexplode("_w").alias("_at", "_first")).crossJoin(F.broadcast(longest))  # one row
    runs = runs.select(id, "_at", "_first", F.slice("_w", F.col("_at") + 1, F.col("_longest")).alias("_w")).join(sizes, "_first")
    fit = F.filter("_sizes", lambda n: n <= F.size("_w"))
    runs = runs.select(id, "_at", F.explode(F.transform(fit, lambda n: F.struct(n.alias("n"), F.array_join(F.slice("_w", 1, n), " ").alias("_run")))).alias("r"))
    hits = runs.select(id, "_at", "r.n", "r._run").join(known, "_run")
    best = hits.groupBy(id, "_at").agg(F.max("n").alias("n"))
    return hits.join(best, [id, "_at", "n"]).select(id, "target", F.col("_run").alias("phrase")).distinct()


def contains_matches(df: DataFrame, id: str, text: str, phrases: DataFrame, phrase: str, target: str) -> DataFrame:
    """Rows (id, target, confidence) of word matches of phrases with five letters or more; high from twelve letters on, else medium."""
    long = phrases.where(F.length(normalise(F.col(phrase))) >= 5)
    hits = dictionary_matches(df, id, text, long, phrase, target)
    return hits.groupBy(id, "target").agg(F.max(F.length("phrase")).alias("_n")).select(id, "target", F.when(F.col("_n") >= 12, "high").otherwise("medium").alias("confidence"))


def resolve_aliases(df: DataFrame, id: str, name: str, registry: DataFrame, entity: str, aliases: str) -> DataFrame:
    """Rows (id, entity, n): an alias of one entity resolves to it; else the entities that hold all of the name's words in their aliases. ``entity`` is null unless n is 1.

    Equal names are asked once and entities of equal aliases count together. A name meets the entities of its rarest word
    only, and the others are looked up in their words there, so common words make no pairs. An id of several names meets
    those of so many rare words that its shortest name can't be held without one of them.
    """
    steady(df.sparkSession)
    known = registry.select(F.col(entity).alias("_e"), F.explode(aliases).alias("_a")).select("_e", normalise(F.col("_a")).alias("_a")).where("_a <> ''").distinct()
    asks = df.select(F.col(id), normalise(F.col(name)).alias("_q")).where("_q <> ''").distinct()
    names = cut_lineage(asks.groupBy(id).agg(F.array_sort(F.collect_set("_q")).alias("_names")))
    # the least entity names a class; a null one stands for no entity among exact aliases, and for one among words
    alike = known.groupBy("_e").agg(F.array_sort(F.collect_set("_a")).alias("_as")).groupBy("_as").agg(F.count("_e").alias("_k"), F.count("*").alias("_all"), F.min("_e").alias("_e"))
    alike = cut_lineage(alike)
    asked = names.select("_names").distinct()
    exact = asked.select("_names", F.explode("_names").alias("_a")).join(alike.select("_e", "_k", F.explode("_as").alias("_a")), "_a").select("_names", "_e", "_k").distinct()
    exact = cut_lineage(exact.groupBy("_names").agg(F.sum("_k").alias("n"), F.min("_e").alias("_e")))
    words = lambda c: F.array_sort(F.array_distinct(F.split(c, " ")))
    rest = cut_lineage(asked.join(exact, "_names", "left_anti").select("_names", F.array_sort(F.array_distinct(F.transform("_names", words))).alias("_words")))
    held = alike.withColumn("_held", F.array_sort(F.array_distinct(F.flatten(F.transform("_as", lambda a: F.split(a, " ")))))).groupBy("_held").agg(F.sum("_all").alias("_all"), F.min("_e").alias("_e"))
    tokens = held.select("_held", "_all", "_e", F.explode("_held").alias("_t"))
    often = tokens.groupBy("_t").agg(F.count("*").alias("_m"))
    each = rest.select("_words").distinct().select("_words", F.explode(F.array_distinct(F.flatten("_words"))).alias("_t")).join(often, "_t", "left")
    rare = each.groupBy("_words").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("_m", F.lit(0)).alias("_m"), "_t"))).alias("_r"))
    least = F.array_min(F.transform("_words", lambda w: F.size(w)))
    rare = rare.select("_words", F.transform(F.slice("_r", F.lit(1), F.size("_r") - least + 1), lambda x: x["_t"]).alias("_rare"))
    met = rare.select("_words", "_rare", F.explode("_rare").alias("_t")).join(tokens, "_t")
    need = F.array_max(F.transform("_words", lambda w: F.when(F.arrays_overlap(w, "_held"), F.size(w))))
    met = met.where(F.array_intersect("_rare", "_held")[0] == F.col("_t")).where(F.size(F.array_intersect(F.flatten("_words"), "_held")) == need)
    by_words = rest.join(met.groupBy("_words").agg(F.sum("_all").alias("n"), F.min("_e").alias("_e")), "_words").select("_names", "n", "_e")
    found = names.join(exact.unionByName(by_words), "_names").select(id, "n", "_e")
    return asks.select(id).join(found, id, "left").select(id, F.when(F.col("n") == 1, F.col("_e")).alias(entity), F.coalesce("n", F.lit(0)).alias("n"))


def fuzzy_matches(df: DataFrame, id: str, name: str, registry: DataFrame, entity: str, known: str, least: float = 0.72, k: int = 3) -> DataFrame:
    """The k most alike registry names (id, entity, ratio, rank) of each name, of those that reach ``least``.

    All distinct names meet all distinct registry names in blocks; only pairs whose longest common subsequence can't
    give ``least`` go unscored.
    """
    steady(df.sparkSession)
    a = df.select(F.col(id), folded(F.col(name)).alias("_a")).where("_a <> ''").distinct()
    b = registry.select(F.col(entity), folded(F.col(known)).alias("_b")).where("_b <> ''").distinct()
    blocks = [-(-max(1, rows.select(c).distinct().count()) // BLOCK) for rows, c in ((a, "_a"), (b, "_b"))]
    asked, names = (rows.select(c).distinct().groupBy(F.pmod(F.xxhash64(c), F.lit(n)).alias(f"{c}_n")).agg(F.collect_list(c).alias(out)) for rows, c, n, out in ((a, "_a", blocks[0], "asked"), (b, "_b", blocks[1], "known")))
    met = asked.crossJoin(names).repartition(min(10_000, blocks[0] * blocks[1]), "_a_n", "_b_n").select("asked", "known")
    pairs = met.mapInPandas(alike_pairs(least), "_a string, _b string, ratio double")
    scored = a.join(pairs, "_a").join(b, "_b").groupBy(id, entity).agg(F.max("ratio").alias("ratio"))
    return top_k_per(scored, [id], [F.desc("ratio"), F.col(entity)], k)


def _parts_met(keys: DataFrame, key: str, others: DataFrame, other: str, most: float, *, cut: bool) -> DataFrame:
    """``keys`` with the parts ``_p`` by which they meet all keys of the other side within ``most`` of the longer length.

    For each pair of lengths the one side (``cut``) is cut into one part more than edits are allowed, so that one part
    stays whole; the other side gives the pieces that can be that part, by the edits left before and behind it.
    """
    lengths = others.select(F.length(other).alias("_m")).distinct()
    n = F.length(key)
    rows = keys.join(F.broadcast(lengths), F.abs(n - F.col("_m")) <= most * F.greatest(n, F.col("_m")) + 1e-9)  # a row per length
    rows = rows.withColumn("_most", F.floor(most * F.greatest(n, F.col("_m")) + 1e-9).cast("int"))
    whole, asked = (n, F.col("_m")) if cut else (F.col("_m"), n)
    rows = rows.select("*", whole.alias("_w"), asked.alias("_q"), F.explode(F.sequence(F.lit(0), F.col("_most"))).alias("_i"))
    edge = lambda i: F.floor(i * F.col("_w") / (F.col("_most") + 1)).cast("int")
    rows = rows.withColumn("_from", edge(F.col("_i"))).withColumn("_size", edge(F.col("_i") + 1) - F.col("_from"))
    if not cut:
        longer, before, behind = F.col("_q") - F.col("_w"), F.col("_i"), F.col("_most") - F.col("_i")
        low = F.greatest(F.col("_from") - before, F.col("_from") + longer - behind, F.lit(0))
        high = F.least(F.col("_from") + before, F.col("_from") + longer + behind, F.col("_q") - F.col("_size"))
        rows = rows.where(low <= high).withColumn("_from", F.explode(F.sequence(low, high)))
    return rows.select(*keys.columns, F.struct("_w", "_q", "_i", F.substring(F.col(key), F.col("_from") + 1, F.col("_size")).alias("_s")).alias("_p")).distinct()


def phonetic_matches(df: DataFrame, id: str, name: str, registry: DataFrame, entity: str, known: str, most: float = 0.30) -> DataFrame:
    """Rows (id, entity, distance): the first registry entry of the same sound, else the one nearest in sound within ``most``, the first of equally near ones.

    Distinct sounds meet by parts that are complete for ``most`` of the longer sound, so no pair within it is passed over.
    """
    steady(df.sparkSession)
    a = df.select(F.col(id), phonetic_key(F.col(name)).alias("_ka")).where("_ka <> ''").distinct()
    b = registry.select(F.col(entity), phonetic_key(F.col(known)).alias("_kb")).where(F.col(entity).isNotNull() & (F.col("_kb") != "")).groupBy("_kb").agg(F.min(entity).alias(entity))
    exact = a.join(b, F.col("_ka") == F.col("_kb")).groupBy(id).agg(F.min(entity).alias(entity)).withColumn("distance", F.lit(0.0))
    rest = a.join(exact, id, "left_anti")
    asks = rest.select("_ka").distinct()
    near = _parts_met(asks, "_ka", b, "_kb", most, cut=False).join(_parts_met(b, "_kb", asks, "_ka", most, cut=True), "_p")
    near = near.withColumn("distance", normalised_distance(F.col("_ka"), F.col("_kb"))).where(F.col("distance") <= most)
    near = near.groupBy("_ka").agg(F.min(F.struct("distance", entity)).alias("m"))
    near = rest.join(near, "_ka").groupBy(id).agg(F.min("m").alias("m")).select(id, f"m.{entity}", "m.distance")
    return exact.unionByName(near)


def promotion_decisions(scored: DataFrame, ratio_column: str = "ratio") -> DataFrame:
    """What to do with a name by its best likeness: add_id if equal, alias from 0.92, review from 0.84, else new."""
    r = F.col(ratio_column)
    return scored.withColumn("decision", F.when(r >= 1.0, "add_id").when(r >= 0.92, "alias").when(r >= 0.84, "review").otherwise("new"))


def merge_registry(registry: DataFrame, id: str, name: str, aliases: str, mentions: str, finals: DataFrame) -> DataFrame:
    """Registry after merges (id, final): mentions summed, aliases united with the losers' names, the winner's name kept."""
    to = finals.select(F.col("id").alias("_i"), F.col("final").alias("_f"))
    rows = registry.join(to, F.col(id) == F.col("_i"), "left").withColumn("_f", F.coalesce("_f", id))
    every = F.array_compact(F.concat(F.array(F.when(F.col(id) != F.col("_f"), F.col(name))), F.coalesce(F.col(aliases), F.array().cast("array<string>"))))
    rows = rows.select("_f", F.when(F.col(id) == F.col("_f"), F.col(name)).alias("_n"), every.alias("_a"), F.col(mentions).alias("_m"))
    merged = rows.groupBy("_f").agg(F.max("_n").alias(name), F.array_sort(F.array_distinct(F.flatten(F.collect_list("_a")))).alias(aliases), F.sum("_m").alias(mentions))
    return merged.select(F.col("_f").alias(id), name, aliases, mentions)


def reference_audit(df: DataFrame, id: str, refs: str, registry: DataFrame, entity: str, pattern: str) -> DataFrame:
    """Rows (kind, id, ref): references missing in the registry, registry ids that occur more than once, ids of the wrong shape."""
    used = df.select(F.col(id).cast("string").alias("id"), F.explode(refs).alias("ref")).where("ref IS NOT NULL").distinct()
    known = registry.select(F.col(entity).alias("ref")).where("ref IS NOT NULL")
    missing = used.join(known.distinct(), "ref", "left_anti").select(F.lit("missing").alias("kind"), "id", "ref")
    twice = known.groupBy("ref").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("duplicate").alias("kind"), F.lit(None).cast("string").alias("id"), "ref")
    wrong = known.distinct().where(~F.col("ref").rlike(pattern)).select(F.lit("invalid").alias("kind"), F.lit(None).cast("string").alias("id"), "ref")
    return missing.union(twice).union(wrong)
