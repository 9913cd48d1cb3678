"""Queries of registries, predicates, ad-hoc SQL, indexes and density clusters, with the SQL that gives the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from fieldreel.functions import predicates
from fieldreel.functions.columns import float_vector
from fieldreel.operators import registries, vector_index
from fieldreel.operators.similarity import density_clusters, group_means, tag_scores
from fieldreel.plans.registry import Registry
from fieldreel.session import cut_lineage, shared_folder
from fieldreel.sources import adhoc

REG = Registry()
_query = REG.query

_ASKED = "SELECT a.record_kind, count(DISTINCT a.asset_id) AS n_assets, count(*) AS n_segments FROM cat.asset a JOIN tr.segment s ON a.asset_id = s.asset_id WHERE s.text IS NOT NULL GROUP BY a.record_kind"


@_query("s7_adhoc_sql", _ASKED.replace("cat.", "").replace("tr.", ""), "asset", "segment")
def s7(a, s):
    return adhoc.ask(a.sparkSession, {"cat": {"asset": a}, "tr": {"segment": s}}, _ASKED)


@_query("p18_theme_of_tag", "SELECT tag, CASE tag WHEN 'speech' THEN 'people' WHEN 'crowd' THEN 'people' WHEN 'rain' THEN 'weather' ELSE '?' END AS theme, count(*) AS n FROM audio_event WHERE tag IS NOT NULL GROUP BY ALL", "audio_event")
def p18(e):
    theme = predicates.theme_of(F.col("tag"), {"speech": "people", "crowd": "people", "rain": "weather"})
    return e.where("tag IS NOT NULL").groupBy("tag", theme.alias("theme")).agg(F.count("*").alias("n"))


@_query("p12_presence_reconciled", "SELECT DISTINCT asset_id, has_machine_transcript AS stored, CAST(asset_id IN (SELECT asset_id FROM segment WHERE asset_id IS NOT NULL) AS INTEGER) AS found FROM asset WHERE has_machine_transcript IS DISTINCT FROM CAST(asset_id IN (SELECT asset_id FROM segment WHERE asset_id IS NOT NULL) AS INTEGER)", "asset", "segment")
def p12(a, s):
    held = s.select("asset_id").distinct().withColumn("found", F.lit(1))
    both = a.join(held, "asset_id", "left").select("asset_id", F.col("has_machine_transcript").alias("stored"), F.coalesce("found", F.lit(0)).alias("found"))
    return both.where(~F.col("stored").eqNullSafe(F.col("found"))).distinct()


@_query("p13_changed_records", "WITH n AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders) SELECT o_orderkey FROM orders o JOIN n USING (o_orderkey) WHERE (o.o_custkey, o.o_orderstatus, o.o_orderpriority) IS DISTINCT FROM (n.o_custkey, n.o_orderstatus, n.o_orderpriority)", "orders")
def p13(o):
    record = lambda priority: F.struct("o_custkey", "o_orderstatus", priority.alias("o_orderpriority"))
    new = o.select("o_orderkey", record(F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority"))).alias("new"))
    return o.select("o_orderkey", record(F.col("o_orderpriority")).alias("old")).join(new, "o_orderkey").where(~F.col("old").eqNullSafe(F.col("new"))).select("o_orderkey")


@_query("f13_bib_texts", r"SELECT DISTINCT doc_id FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents WHERE text IS NOT NULL) WHERE regexp_full_match(trim(w), '\d{2,4}')", "documents")
def f13(d):
    return d.where("text IS NOT NULL").select("doc_id", F.explode(F.split("text", " ")).alias("w")).where(predicates.bib_text(F.col("w"))).select("doc_id").distinct()


@_query("f14_noise_paths", "SELECT asset_id FROM asset WHERE contains(lower(coalesce(source_path, '')), 'broll') OR contains(lower(coalesce(source_path, '')), '.jpg')", "asset")
def f14(a):
    return a.where(predicates.noise_path(F.col("source_path"), ("BRoll", ".jpg"))).select("asset_id")


@_query("f15_skipped_paths", "SELECT asset_id FROM asset WHERE coalesce(source_path, '') GLOB '*/hearing_*' OR filename GLOB '[AB]00?_*.wav'", "asset")
def f15(a):
    return a.where(predicates.skipped(F.col("source_path"), ("*/hearing_*", "[AB]00?_*.wav"))).select("asset_id")


@_query("f16_consented", "SELECT asset_id, seg_idx, speaker_p_id FROM segment WHERE speaker_p_id IS NOT NULL", "segment")
def f16(s):
    return s.where("speaker_p_id IS NOT NULL").select("asset_id", "seg_idx", "speaker_p_id")


@_query("f17_stale_records", "SELECT chunk_id, CASE WHEN label_status IS NULL THEN 'missing' WHEN coalesce(model, '') <> (SELECT min(model) FROM semantic_chunks) THEN 'stale_prompt' WHEN coalesce(trim(response_raw), '') = '' THEN 'empty_summary' END AS reason FROM semantic_chunks", "semantic_chunks")
def f17(c):
    current = c.agg(F.min("model").alias("m")).first()["m"] or ""
    return c.select("chunk_id", predicates.stale_reason(F.col("label_status"), F.col("model"), current, F.col("response_raw")).alias("reason"))


@_query("j40_names_or_ids", "WITH n AS (SELECT id, min(canonical_name) AS name FROM places WHERE canonical_name IS NOT NULL AND confidence = 'high' GROUP BY 1) SELECT p.id, p.parent_id, coalesce(n.name, p.parent_id) AS name FROM places p LEFT JOIN n ON p.parent_id = n.id", "places")
def j40(p):
    return registries.names_or_ids(p.select("id", "parent_id"), "parent_id", p.where("confidence = 'high'").select(F.col("id").alias("k"), "canonical_name"), "k", "canonical_name")


_NORM = r"trim(regexp_replace(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'), '\s+', ' ', 'g'))"


@_query(
    "j42_resolved_labels",
    f"""WITH l AS (SELECT DISTINCT label, {_NORM.format('label')} AS q FROM (SELECT n_name || CASE WHEN n_nationkey % 3 = 0 THEN ' / ' || lead(n_name) OVER (ORDER BY n_nationkey) ELSE '' END AS label FROM nation) WHERE label IS NOT NULL),
    al AS (SELECT {_NORM.format('n_name')} AS p, CAST(n_regionkey AS VARCHAR) AS id FROM nation WHERE n_nationkey <> 4 UNION SELECT {_NORM.format('n_name')}, 'x' FROM nation WHERE n_nationkey = 7),
    ru AS (SELECT {_NORM.format('n_name')} AS q, 'rule' AS id FROM nation WHERE n_nationkey = 1),
    pa AS (SELECT label, q, unnest(list_distinct(list_transform(string_split(label, ' / '), lambda x: {_NORM.format('x')}))) AS p FROM l),
    k AS (SELECT p, list(id) AS ids FROM al GROUP BY 1),
    f AS (SELECT label, any_value(q) AS q, count(*) AS n, max(coalesce(len(ids), 0)) AS most, min(coalesce(len(ids), 0)) AS least, list_sort(list_distinct(flatten(list(ids)))) AS ids FROM pa LEFT JOIN k USING (p) GROUP BY label),
    h AS (SELECT f.*, CASE WHEN ru.id IS NOT NULL THEN 'rule' WHEN least < 1 THEN 'unknown' WHEN most > 1 THEN 'ambiguous' WHEN n > 1 THEN 'composite' ELSE 'direct' END AS how FROM f LEFT JOIN ru USING (q))
    SELECT label, CASE how WHEN 'rule' THEN ['rule'] WHEN 'composite' THEN ids WHEN 'direct' THEN ids ELSE [] END AS ids, how FROM h""",
    "nation",
)
def j42(n):
    nxt = F.lead("n_name").over(Window.orderBy("n_nationkey"))
    labels = n.select(F.when(F.col("n_nationkey") % 3 == 0, F.concat("n_name", F.lit(" / "), nxt)).otherwise(F.col("n_name")).alias("label")).where("label IS NOT NULL")
    aliases = n.where("n_nationkey <> 4").select(F.col("n_name").alias("alias"), F.col("n_regionkey").cast("string").alias("id")).union(n.where("n_nationkey = 7").select("n_name", F.lit("x")))
    return registries.resolve_labels(labels, "label", n.where("n_nationkey = 1").select(F.col("n_name").alias("alias"), F.lit("rule").alias("id")), aliases)


@_query("a6_group_outliers", "SELECT p_id, count(*) AS n, count(DISTINCT exemplar_pk) AS members, avg(exemplar_idx) AS mean, CASE WHEN count(*) < 10 THEN 'small' WHEN count(*) > 5000 THEN 'huge' ELSE 'usual' END AS size FROM face_exemplar WHERE p_id IS NOT NULL GROUP BY 1", "face_exemplar")
def a6(f):
    return registries.group_outliers(f, "p_id", "exemplar_pk", "exemplar_idx")


@_query("a13_bucket_statistics", "WITH t AS (SELECT lang, source, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY ALL), c AS (SELECT lang, arg_max(source, (n, -r)) AS most_common FROM (SELECT *, row_number() OVER (ORDER BY source) AS r FROM t) GROUP BY 1) SELECT d.lang, count(*) AS n, round(avg(n_chars), 6) AS mean, median(n_chars) AS median, any_value(most_common) AS most_common FROM documents d LEFT JOIN c ON d.lang IS NOT DISTINCT FROM c.lang GROUP BY d.lang", "documents")
def a13(d):
    return registries.bucket_statistics(d, "lang", "n_chars", "source").withColumn("mean", F.round("mean", 6))


@_query("a17_variant_clusters", "WITH v AS (SELECT theme AS kind, tag AS target, engine AS variant, asset_id, 1 - score AS d FROM audio_event), c AS (SELECT kind, target, variant, count(*) AS n, min(d) AS d FROM v GROUP BY ALL) SELECT c.kind, c.target, list(c.variant || ':' || c.n ORDER BY c.n DESC, c.variant) AS variants, any_value(a.n) AS n_assets, round(min(c.d), 6) AS distance, CAST(sum(c.n) AS BIGINT) AS n FROM c JOIN (SELECT kind, target, count(DISTINCT asset_id) AS n FROM v GROUP BY ALL) a ON a.kind = c.kind AND a.target = c.target GROUP BY ALL", "audio_event")
def a17(e):
    rows = e.select(F.col("theme").alias("kind"), F.col("tag").alias("target"), F.col("engine").alias("variant"), "asset_id", (1 - F.col("score")).alias("d"))
    found = registries.variant_clusters(rows.where("variant IS NOT NULL"), "kind", "target", "variant", "asset_id", "d")
    return found.select("kind", "target", F.transform("variants", lambda v: F.concat_ws(":", v["variant"], v["n"])).alias("variants"), F.size("assets").cast("bigint").alias("n_assets"), F.round("distance", 6).alias("distance"), "n")


@_query(
    "a18_candidate_summary",
    f"WITH r AS (SELECT {_NORM.format('canonical_name')} AS key, canonical_name AS name, type, id, parent_id FROM places WHERE canonical_name IS NOT NULL AND regexp_matches(lower(canonical_name), '[a-z0-9]')), s AS (SELECT key, name, count(*) AS n FROM r GROUP BY ALL) SELECT key, arg_max(name, (n, -k)) AS name, CAST(sum(n) AS BIGINT) AS n, any_value(x.kinds) AS kinds, any_value(x.ids) AS ids, any_value(x.contexts) AS contexts FROM (SELECT *, row_number() OVER (ORDER BY encode(name)) AS k FROM s) JOIN (SELECT key, coalesce(list_sort(list_distinct(list(type) FILTER (type IS NOT NULL))), []) AS kinds, list_sort(list_distinct(list(id))) AS ids, coalesce(list_sort(list_distinct(list(parent_id) FILTER (parent_id IS NOT NULL)))[1:2], []) AS contexts FROM r GROUP BY 1) x USING (key) GROUP BY key",
    "places",
)
def a18(p):
    return registries.candidate_summary(p, "canonical_name", "type", "id", "parent_id", contexts=2)


@_query("a20_best_names", "WITH r AS (SELECT parent_id, canonical_name AS name, coalesce(mention_count, 99) AS p, confidence FROM places WHERE parent_id IS NOT NULL AND canonical_name IS NOT NULL), b AS (SELECT *, row_number() OVER (PARTITION BY parent_id ORDER BY p, length(name) DESC, encode(name)) AS k FROM r) SELECT parent_id, max(name) FILTER (k = 1) AS canonical, list_sort(list_filter(list_distinct(list(name)), lambda x: x <> max(name) FILTER (k = 1))) AS aliases, max(confidence) AS confidence FROM b GROUP BY 1".replace("list_sort(list_filter(list_distinct(list(name)), lambda x: x <> max(name) FILTER (k = 1)))", "list_sort(list_distinct(list(name) FILTER (name <> (SELECT c.name FROM b c WHERE c.k = 1 AND c.parent_id = b.parent_id))))"), "places")
def a20(p):
    return registries.best_names(p.withColumn("_p", F.coalesce("mention_count", F.lit(99))), "parent_id", "canonical_name", "_p", "confidence").withColumn("aliases", F.when(F.size("aliases") > 0, F.col("aliases")))


@_query(
    "a22_tag_coverage",
    "WITH t AS (SELECT unnest(from_json(moment_ids_json, '[\"VARCHAR\"]')) AS m, asset_id, duration_sec, has_machine_transcript = 1 AS rich FROM (SELECT DISTINCT asset_id, moment_ids_json, duration_sec, has_machine_transcript FROM asset)), k AS (SELECT DISTINCT m AS tag FROM t WHERE m IS NOT NULL UNION SELECT 'nothing'), d AS (SELECT DISTINCT * FROM t) SELECT tag, count(asset_id) AS n, round(coalesce(sum(duration_sec), 0), 3) AS seconds, count(*) FILTER (rich) AS rich, count(asset_id) < 5 OR count(*) FILTER (rich) = 0 AS gap FROM k LEFT JOIN d ON tag = m GROUP BY 1",
    "asset",
)
def a22(a):
    records = a.select("asset_id", F.from_json("moment_ids_json", "array<string>").alias("m"), "duration_sec", "has_machine_transcript").distinct()
    tags = records.select(F.explode("m").alias("tag")).where("tag IS NOT NULL").union(a.sparkSession.createDataFrame([("nothing",)], "tag string"))
    return registries.tag_coverage(tags, "tag", records, "m", "duration_sec", F.col("has_machine_transcript") == 1).withColumn("seconds", F.round("seconds", 3))


@_query("a25_budget", "SELECT round(coalesce(sum(o_totalprice), 0), 2) AS spent, round(1e9 - coalesce(sum(o_totalprice), 0), 2) AS remaining, coalesce(sum(o_totalprice), 0) > 1e9 AS over FROM orders WHERE o_orderstatus = 'F'", "orders")
def a25(o):
    return registries.budget_left(o.where("o_orderstatus = 'F'"), "o_totalprice", 1e9).select(F.round("spent", 2).alias("spent"), F.round("remaining", 2).alias("remaining"), "over")


@_query("a26_top_mentions", "SELECT term, count(*) AS n FROM (SELECT unnest(from_json(people_ids_json, '[\"VARCHAR\"]')) AS term FROM asset) WHERE term IS NOT NULL GROUP BY 1 ORDER BY n DESC, term LIMIT 15", "asset")
def a26(a):
    return registries.top_mentions(a.select(F.from_json("people_ids_json", "array<string>").alias("t")), "t", 15)


@_query("w6_top_then_threshold", "SELECT event_pk, asset_id, rank FROM (SELECT event_pk, asset_id, score, row_number() OVER (PARTITION BY asset_id, window_start_sec, engine ORDER BY score DESC, event_pk) AS rank FROM (SELECT DISTINCT event_pk, asset_id, window_start_sec, engine, score FROM audio_event) WHERE score IS NOT NULL) WHERE rank <= 5 AND score >= 0.5", "audio_event")
def w6(e):
    rows = e.select("event_pk", "asset_id", "window_start_sec", "engine", "score").distinct()
    return registries.top_then_threshold(rows, ["asset_id", "window_start_sec", "engine"], "score", [F.col("event_pk")], 5, 0.5).select("event_pk", "asset_id", "rank")


@_query("w15_context_words", "SELECT l_orderkey, l_linenumber, string_agg(w, ' ') OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_shipdate ROWS BETWEEN 7 PRECEDING AND 6 FOLLOWING) AS context FROM (SELECT *, l_returnflag || l_linenumber AS w FROM lineitem)", "lineitem")
def w15(li):
    words = li.withColumn("w", F.concat("l_returnflag", "l_linenumber"))
    return registries.context_words(words, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"], "w").select("l_orderkey", "l_linenumber", "context")


@_query("w16_distinct_asset_top_k", "WITH b AS (SELECT tag, asset_id, score, event_pk, row_number() OVER (PARTITION BY tag, asset_id ORDER BY score DESC, event_pk) AS k FROM (SELECT DISTINCT tag, asset_id, score, event_pk FROM audio_event) WHERE score IS NOT NULL) SELECT tag, asset_id, event_pk, rank FROM (SELECT tag, asset_id, event_pk, row_number() OVER (PARTITION BY tag ORDER BY score DESC, event_pk) AS rank FROM b WHERE k = 1) WHERE rank <= 10", "audio_event")
def w16(e):
    rows = e.select("tag", "asset_id", "score", "event_pk").distinct().where("score IS NOT NULL")
    return registries.distinct_asset_top_k(rows, ["tag"], "asset_id", "score", [F.col("event_pk")], 10).select("tag", "asset_id", "event_pk", "rank")


@_query("w18_carried_over", "WITH o AS (SELECT asset_id, round_even(start_sec, 2) AS t, seg_idx AS n, min(speaker_p_id) AS p FROM segment WHERE speaker_p_id IS NOT NULL AND start_sec IS NOT NULL AND asset_id IS NOT NULL GROUP BY ALL) SELECT DISTINCT s.asset_id, s.seg_idx, s.start_sec, p AS speaker_p_id FROM segment s LEFT JOIN o ON o.asset_id = s.asset_id AND o.n = s.seg_idx AND o.t = round_even(s.start_sec, 2)", "segment")
def w18(s):
    new = s.select("asset_id", "seg_idx", "start_sec", F.lit(None).cast("string").alias("speaker_p_id")).distinct()
    return registries.carry_over(new, s, "start_sec", "seg_idx", "speaker_p_id").select("asset_id", "seg_idx", "start_sec", "speaker_p_id")


@_query("k10_signal_rank", "WITH q AS (SELECT asset_id, count(*) FILTER (text IS NOT NULL) AS q FROM (SELECT DISTINCT * FROM segment) GROUP BY 1), a AS (SELECT DISTINCT asset_id, record_kind, duration_sec FROM asset) SELECT record_kind, asset_id, round(coalesce(q, 0) * 100 + coalesce(duration_sec, 0) / 60, 6) AS signal FROM a LEFT JOIN q USING (asset_id) QUALIFY row_number() OVER (PARTITION BY record_kind ORDER BY coalesce(q, 0) * 100 + coalesce(duration_sec, 0) / 60 DESC, duration_sec DESC, asset_id) <= 8", "asset", "segment")
def k10(a, s):
    quotes = s.distinct().where("text IS NOT NULL").groupBy("asset_id").agg(F.count("*").alias("q"))
    rows = a.select("asset_id", "record_kind", "duration_sec").distinct().join(quotes, "asset_id", "left")
    return registries.signal_rank(rows, "q", "duration_sec", ["record_kind"], 8).select("record_kind", "asset_id", F.round("signal", 6).alias("signal"))


@_query("u5_union_of_ids", "SELECT DISTINCT asset_id, list_sort(list_distinct(list_concat(coalesce(from_json(people_ids_json, '[\"VARCHAR\"]'), []), coalesce(from_json(org_ids_json, '[\"VARCHAR\"]'), [])))) AS ids FROM asset", "asset")
def u5(a):
    return a.select("asset_id", predicates.union_ids(F.from_json("people_ids_json", "array<string>"), F.from_json("org_ids_json", "array<string>")).alias("ids")).distinct()


@_query("x5_leading_names", r"SELECT DISTINCT chunk_id, nullif(rtrim(regexp_extract(response_raw, '^[\s\"''“‘(]*(?:(?:The|A|An)\s+)?(\p{Lu}[\p{L}''’.-]*(?:\s+(?:of\s+|the\s+)?\p{Lu}[\p{L}''’.-]*){0,4})', 1), '.-''’ '), '') AS name FROM semantic_chunks WHERE response_raw IS NOT NULL", "semantic_chunks")
def x5(c):
    return c.where("response_raw IS NOT NULL").select("chunk_id", predicates.leading_name(F.col("response_raw")).alias("name")).distinct()


@_query("g6_caption_times", "SELECT DISTINCT chunk_id, CASE WHEN s IS NULL OR e IS NULL OR e - s < 2 THEN [] WHEN b = 'raw' THEN [s + (e - s) * 0.25, s + (e - s) * 0.5, s + (e - s) * 0.75] WHEN b = 'selects' THEN [s + (e - s) * 0.5] ELSE [] END AS times FROM (SELECT chunk_id, chunk_start_sec AS s, chunk_end_sec AS e, bucket AS b FROM semantic_chunks)", "semantic_chunks")
def g6(c):
    times = predicates.caption_times(F.col("bucket"), F.col("chunk_start_sec"), F.col("chunk_end_sec"), {"raw": (0.25, 0.5, 0.75), "selects": (0.5,), "other": ()})
    return c.select("chunk_id", times.alias("times")).distinct()


@_query("g9_shots_or_whole", "WITH k AS (SELECT DISTINCT parent_asset_id, chunk_id FROM semantic_chunks WHERE chunk_start_sec IS NOT NULL), n AS (SELECT parent_asset_id AS asset_id, count(*) AS n FROM k GROUP BY 1) SELECT DISTINCT a.asset_id, CAST(CASE WHEN n > 0 THEN n WHEN duration_sec > 0 THEN 1 END AS INTEGER) AS n_shots, CASE WHEN n IS NULL AND duration_sec > 0 THEN duration_sec END AS whole FROM asset a LEFT JOIN n USING (asset_id)", "asset", "semantic_chunks")
def g9(a, c):
    found = c.where("chunk_start_sec IS NOT NULL").select("parent_asset_id", "chunk_id", "chunk_start_sec", "chunk_end_sec").dropDuplicates(["parent_asset_id", "chunk_id"])
    shots = found.groupBy(F.col("parent_asset_id").alias("asset_id")).agg(F.collect_list(F.struct(F.col("chunk_start_sec").alias("start"), F.col("chunk_end_sec").alias("end"))).alias("shots"))
    rows = a.select("asset_id", "duration_sec").distinct().join(shots, "asset_id", "left").withColumn("all", predicates.shots_or_whole(F.coalesce("shots", F.array().cast("array<struct<start:double,end:double>>")), F.col("duration_sec")))
    return rows.select("asset_id", F.when(F.col("all").isNotNull(), F.size("all")).alias("n_shots"), F.when(F.col("shots").isNull(), F.col("all")[0]["end"]).alias("whole"))


@_query(
    "v9_tag_scores",
    "WITH m AS (SELECT label AS tag, list(x ORDER BY i) AS c FROM (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS x FROM embeddings, range(1, 65) t(i) GROUP BY ALL) GROUP BY 1), s AS (SELECT vec_id, tag, list_cosine_similarity(CAST(embedding AS DOUBLE[]), c) AS cosine FROM embeddings, m) SELECT vec_id, tag, rank FROM (SELECT vec_id, tag, cosine, row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, tag) AS rank FROM s) WHERE rank <= 5 AND cosine >= 0.2",
    "embeddings",
)
def v9(e):
    scored = tag_scores(e, "vec_id", "embedding", group_means(e, "label", "embedding").select(F.col("label").alias("tag"), "vector"), "tag")
    return registries.top_then_threshold(scored, ["vec_id"], "cosine", [F.col("tag")], 5, 0.2).select("vec_id", "tag", "rank")


@_query("v32_applied_decisions", "WITH d AS (SELECT DISTINCT canonical_name AS name, CASE WHEN mention_count >= 2 THEN 'accept' ELSE 'reject' END AS action, id FROM places WHERE confidence = 'high' AND canonical_name IS NOT NULL), k AS (SELECT name, min((action, id)) AS x FROM d GROUP BY 1), t AS (SELECT name, CAST(x[2] AS VARCHAR) AS id FROM (SELECT name, [CAST(struct_extract(x, 1) AS VARCHAR), struct_extract(x, 2)] AS x FROM k) WHERE x[1] = 'accept'), r AS (SELECT DISTINCT id, aliases FROM places), m AS (SELECT id, list_sort(list_distinct(list(name))) AS more FROM t GROUP BY 1) SELECT coalesce(r.id, m.id) AS id, list_sort(list_distinct(list_concat(coalesce(aliases, []), coalesce(more, [])))) AS aliases FROM r FULL JOIN m USING (id)", "places")
def v32(p):
    decisions = p.where("confidence = 'high' AND canonical_name IS NOT NULL").select(F.col("canonical_name").alias("name"), F.when(F.col("mention_count") >= 2, "accept").otherwise("reject").alias("action"), "id")
    records = p.select(F.col("id").alias("record_id"), F.lit(None).cast("array<string>").alias("ids")).distinct()
    registry, _, _ = registries.apply_decisions(p.select("id", "aliases").distinct(), records, p.select(F.col("canonical_name").alias("name"), F.col("id").alias("record_id")), decisions)
    return registry


@_query("v32_queue_left", "SELECT DISTINCT canonical_name AS name FROM places WHERE canonical_name IS NOT NULL AND canonical_name NOT IN (SELECT canonical_name FROM places WHERE confidence = 'high' AND canonical_name IS NOT NULL)", "places")
def v32_queue(p):
    decisions = p.where("confidence = 'high' AND canonical_name IS NOT NULL").select(F.col("canonical_name").alias("name"), F.lit("reject").alias("action"), "id")
    names = p.where("canonical_name IS NOT NULL").select(F.col("canonical_name").alias("name"), F.col("id").alias("record_id"))
    return registries.apply_decisions(p.select("id", "aliases"), p.select(F.col("id").alias("record_id"), F.lit(None).cast("array<string>").alias("ids")), names, decisions)[2].select("name").distinct()


@_query("v7_indexed_neighbours", None, "clip_embeddings")
def v7(e):
    """The five most similar of every key divisible by 50, through a stored index built in the shared folder."""
    rows = cut_lineage(e.select("embedding_pk", float_vector(F.col("vector_blob"), 64).alias("v")).dropDuplicates(["embedding_pk"])).where("v IS NOT NULL")
    path = f"{shared_folder(e.sparkSession)}/index-{uuid.uuid4().hex}"
    vector_index.build(rows, "embedding_pk", "v", path)
    queries = rows.where("embedding_pk % 50 = 0").select(F.col("embedding_pk").alias("q_id"), F.col("v").alias("q"))
    return vector_index.search(e.sparkSession, path, queries, "q_id", "q", 5, apart=True)


@_query("v12_density_clusters", None, "face_exemplar")
def v12(f):
    rows = cut_lineage(f.select("exemplar_pk", float_vector(F.col("embedding"), 128).alias("v")).dropDuplicates(["exemplar_pk"])).where("v IS NOT NULL")
    return density_clusters(rows, "exemplar_pk", "v", least=0.6, neighbours=20)


def queries():
    return dict(REG.queries)


def oracle_sql():
    return dict(REG.sql)
