"""Queries of the catalogue's projection and of the questions over it: nested records are put together from the given tables, projected, and asked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldreel.operators import faces as people
from fieldreel.plans import catalog, composers
from fieldreel.plans.registry import Registry

REG = Registry()
TABLES = ("asset", "semantic_chunks", "segment", "audio_event")


def _records(asset: DataFrame, chunks: DataFrame, events: DataFrame) -> DataFrame:
    """Nested records: chunks stand for shots, captions and recognised texts too, and sound figures come from the events' best scores."""
    c = chunks.distinct().where("parent_asset_id IS NOT NULL")
    c = c.select("parent_asset_id", "chunk_id", "chunk_idx", "chunk_start_sec", "chunk_end_sec", "model", "bucket", "label_status", "response_raw", F.length(F.coalesce("response_raw", F.lit(""))).alias("n"))
    start, end = F.col("chunk_start_sec"), F.col("chunk_end_sec")
    moment = F.array(F.struct(start.alias("timestamp_sec"), F.col("response_raw").alias("description")))
    chunk = F.struct(
        F.col("chunk_id"), F.col("chunk_idx"), start.alias("start_sec"), end.alias("end_sec"), F.col("model"), F.left("response_raw", F.lit(20)).alias("subject"), F.col("label_status").alias("action"), F.struct(F.col("bucket").alias("location"), F.lit(" ").alias("time_of_day"), F.col("label_status").alias("weather")).alias("setting"),
        F.struct(F.lit("wide").alias("shot_size"), F.col("label_status").alias("movement"), F.lit(None).cast("string").alias("perspective")).alias("camera"), F.lit(None).cast("string").alias("audio_character"), F.lit(None).cast("string").alias("emotional_tone"), F.col("response_raw").alias("editorial_notes"), moment.alias("key_moments"),
    )
    flag = lambda x: F.coalesce(x, F.lit(False)).cast("int")
    shot = F.struct(F.col("chunk_idx").alias("shot_idx"), start.alias("start_sec"), end.alias("end_sec"), (end - start).alias("duration_sec"))
    quality = F.struct(F.col("chunk_idx").alias("shot_idx"), F.lit(3).alias("n_frames_sampled"), (F.col("n") * 2.0).alias("sharpness_score"), F.lit(0.0).alias("motion_score"), F.lit(90.0).alias("exposure_mean"), F.lit(0.0).alias("clipping_ratio"), F.lit(0).alias("is_blurry"), F.lit(0).alias("is_dark"), F.lit(0).alias("is_blown"), flag(F.col("chunk_idx") == 0).alias("is_setup_or_teardown"), flag(F.col("label_status") == "done").alias("is_in_focus"), (F.col("n") / 20.0).alias("aesthetic_score"), flag(F.col("n") % 3 == 0).alias("is_aesthetic"))
    ocr = F.struct(F.col("chunk_idx").alias("shot_idx"), start.alias("frame_time_sec"), F.lit(None).cast("string").alias("bbox_json"), F.left("response_raw", F.lit(6)).alias("text"), F.lit(0.9).alias("confidence"), F.lit("e").alias("ocr_engine"), F.when(F.col("chunk_idx") % 5 == 3, "suspicious").alias("qa_verdict"))
    bib = F.struct(F.col("chunk_idx").alias("shot_idx"), start.alias("frame_time_sec"), F.regexp_extract("response_raw", r"(\d{2,4})", 1).alias("bib_number"), (F.col("n") / 300.0).alias("confidence"), F.lit("e").alias("source_ocr_engine"), F.lit(None).cast("string").alias("p_id"))
    caption = F.struct("chunk_id", F.col("chunk_idx").alias("shot_idx"), start.alias("frame_time_sec"), F.lit("a").alias("sample_pos"), F.col("response_raw").alias("caption_text"), F.lit(None).cast("string").alias("caption_json"), F.lit("m").alias("model_engine"), F.lit("v").alias("prompt_variant"))
    items = lambda x, when=None: F.struct(F.lit(None).cast("string").alias("processed_at"), F.sort_array(F.collect_list(x if when is None else F.when(when, x))).alias("items"))
    order = F.struct("chunk_idx", "chunk_id", chunk.alias("c"))
    nested = c.groupBy(F.col("parent_asset_id").alias("asset_id")).agg(
        F.struct(F.transform(F.sort_array(F.collect_list(F.struct("chunk_idx", "chunk_id"))), lambda x: x["chunk_id"]).alias("order"), F.collect_list(chunk).alias("chunks")).alias("s"),
        items(shot).alias("shots"), items(quality).alias("shot_quality"), items(ocr).alias("ocr_detections"), items(bib, F.regexp_extract("response_raw", r"(\d{2,4})", 1) != "").alias("bib_hits"), items(caption, F.col("response_raw").isNotNull()).alias("dense_captions"),
    )
    nested = nested.withColumn("asset_semantic_summary", F.struct(F.transform("s.order", lambda i: F.get(F.filter("s.chunks", lambda c: c["chunk_id"] == i), 0)).alias("chunks"))).drop("s")
    sound = events.distinct().groupBy("asset_id").agg(F.max("score").alias("m"), F.max((F.col("tag") == "wind").cast("int")).alias("wind"), F.max((F.col("tag") == "speech").cast("int")).alias("speech"))
    metrics = F.struct(*((F.round(-60 * (1 - F.col("m")), 3) if k == "rms_dbfs" else F.col("wind") if k == "is_windy" else F.col("speech") if k == "is_usable" else F.lit(0 if t.typeName() == "integer" else 0.0)).cast(t).alias(k) for k, t in catalog._METRICS.items()))
    sound = sound.select("asset_id", F.struct(F.lit(None).cast("double").alias("duration_sec"), metrics.alias("metrics")).alias("audio_quality"))
    ids = lambda name: F.from_json(f"{name}_ids_json", "array<string>").alias(f"{name}_ids")
    flat = asset.distinct().select(
        "asset_id", "record_kind", "source_path", "filename", "filesize_bytes", F.struct("duration_sec", "width", "height", "codec", "color_profile").alias("ffprobe"), F.struct("shoot_date", "shoot_label", "category_name", "camera_id").alias("path_metadata"), "audio_recorder", "primary_timeline_date",
        (F.col("human_transcript") == 1).alias("human_transcript"), *map(ids, ("people", "org", "moment", "place")), F.struct("bucket", F.col("asset_type").alias("type")).alias("asset_classifications"), F.when(F.col("record_kind") == "still", F.struct(F.struct((F.length("filename") / 4.0).alias("aesthetic_score"), F.lit(1).alias("is_aesthetic"), F.lit("jpg").alias("image_ext")).alias("metrics"))).alias("still_aesthetic"),
    )
    joined = flat.join(nested, "asset_id", "left").join(sound, "asset_id", "left")
    joined = joined.withColumn("place_match", F.lit(None).cast(catalog.RECORD["place_match"].dataType)).withColumn("audio_extract", F.when(F.col("record_kind") == "video", F.struct(F.lit("x").alias("path"), F.col("audio_quality").alias("audio_quality"))))
    return joined.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name != "audio_extract" else F.col("audio_extract") for f in catalog.RECORD.fields))


def _transcripts(segment: DataFrame) -> DataFrame:
    """Nested transcripts; every segment with a person is a quote too, scored by its number."""
    s = segment.distinct().where("asset_id IS NOT NULL")
    none = lambda t: F.lit(None).cast(t)
    quote = F.struct(
        F.col("text"), F.col("speaker_p_id").alias("speaker"), "start_sec", "end_sec", F.when(F.col("seg_idx") % 3 == 0, "setup").otherwise("payoff").alias("story_function"), none("int").alias("linked_moment_idx"), F.struct((F.col("seg_idx") % 6).cast("string").alias("score"), none("array<string>").alias("reasons")).alias("soundbite_quality"),
        F.struct(F.when(F.col("seg_idx") % 4 == 0, "true").otherwise("false").alias("is_comedic"), F.lit("irony").alias("type"), (F.col("seg_idx") % 10 / 10).cast("string").alias("confidence"), none("string").alias("notes")).alias("comedic"),
    )
    row = F.struct("seg_idx", F.struct("start_sec", "end_sec", "text", F.col("speaker_id").alias("speaker_raw"), F.col("speaker_p_id").alias("speaker")).alias("s"), quote.alias("q"))
    rows = s.groupBy("asset_id").agg(F.array_sort(F.collect_list(row), lambda a, b: a["seg_idx"] - b["seg_idx"]).alias("r"))
    speakers = F.array(F.struct(none("string").alias("speaker_id"), none("string").alias("p_id"), none("string").alias("label_raw"), none("boolean").alias("is_stub"), none("int").alias("segment_count"), none("double").alias("total_duration_sec"), none("double").alias("first_seen_sec")))
    return rows.select("asset_id", F.transform("r", lambda x: x["s"]).alias("segments"), speakers.alias("speakers"), F.struct(F.transform("r", lambda x: x["q"]).alias("key_quotes"), none(catalog.TRANSCRIPT["analysis"].dataType["key_moments"].dataType).alias("key_moments")).alias("analysis"))


def tables(asset: DataFrame, chunks: DataFrame, segment: DataFrame, events: DataFrame) -> dict[str, DataFrame]:
    flat = catalog.project(_records(asset, chunks, events), _transcripts(segment))
    flat["frame_face"] = segment.distinct().where("start_sec IS NOT NULL AND asset_id IS NOT NULL AND seg_idx % 2 = 0").select("asset_id", F.col("start_sec").alias("frame_time_sec"), F.col("speaker_p_id").alias("p_id"), F.col("seg_idx").alias("frame_idx"))
    return flat


# The same flat tables for DuckDB.
_FLAT = r"""a AS (SELECT DISTINCT * FROM asset), c AS (SELECT DISTINCT parent_asset_id AS asset_id, chunk_id, chunk_idx, chunk_start_sec AS start_sec, chunk_end_sec AS end_sec, model, bucket, label_status, response_raw, length(coalesce(response_raw, '')) AS n FROM semantic_chunks WHERE parent_asset_id IN (SELECT asset_id FROM asset)),
sd AS (SELECT DISTINCT * FROM segment WHERE asset_id IS NOT NULL), s AS (SELECT asset_id, seg_idx AS old_idx, CAST(row_number() OVER (PARTITION BY asset_id ORDER BY seg_idx) - 1 AS INTEGER) AS seg_idx, start_sec, end_sec, speaker_id, speaker_p_id, text FROM sd),
aq AS (SELECT e.asset_id, a.record_kind, round(-60 * (1 - e.m), 3) AS rms_dbfs, is_windy, is_usable FROM (SELECT asset_id, max(score) AS m, max(CAST(tag = 'wind' AS INTEGER)) AS is_windy, max(CAST(tag = 'speech' AS INTEGER)) AS is_usable FROM (SELECT DISTINCT * FROM audio_event) GROUP BY 1) e JOIN a USING (asset_id) WHERE a.record_kind IN ('video', 'audio')),
ff AS (SELECT asset_id, start_sec AS frame_time_sec, speaker_p_id AS p_id, seg_idx AS frame_idx FROM sd WHERE start_sec IS NOT NULL AND seg_idx % 2 = 0),
sh AS (SELECT asset_id, chunk_idx AS shot_idx, start_sec, end_sec, end_sec - start_sec AS duration_sec, n * 2.0 AS sharpness_score, n / 20.0 AS aesthetic_score, CAST(n % 3 = 0 AS INTEGER) AS is_aesthetic, CAST(coalesce(label_status = 'done', false) AS INTEGER) AS is_in_focus, CAST(coalesce(chunk_idx = 0, false) AS INTEGER) AS is_setup_or_teardown, label_status FROM c),
q AS (SELECT asset_id, seg_idx AS quote_idx, text, speaker_p_id AS speaker, start_sec, end_sec, CASE WHEN old_idx % 3 = 0 THEN 'setup' ELSE 'payoff' END AS story_function, CAST(old_idx % 6 AS DOUBLE) AS soundbite_score, old_idx % 4 = 0 AS comic, old_idx % 10 / 10.0 AS comedy_confidence FROM s WHERE start_sec IS NOT NULL AND end_sec IS NOT NULL),
tx AS (SELECT asset_id, chunk_idx AS shot_idx, start_sec AS frame_time_sec, left(response_raw, 6) AS text FROM c WHERE length(response_raw) > 0 AND coalesce(chunk_idx % 5, 0) <> 3)"""


def _ask(name: str, sql: str | None):
    return REG.query(name, None if sql is None else f"WITH {_FLAT} {sql}", *TABLES)


@_ask("catalog_asset", "SELECT asset_id, record_kind, source_path, duration_sec, shoot_date, CAST(asset_id IN (SELECT asset_id FROM s) AS INTEGER) AS has_machine_transcript, CAST(record_kind = 'video' AS INTEGER) AS has_audio_extract, coalesce(human_transcript, 0) AS human_transcript, bucket, asset_type, (SELECT arg_min(bucket, (chunk_idx, chunk_id)) FROM c WHERE c.asset_id = a.asset_id AND bucket IS NOT NULL AND (chunk_idx, chunk_id) = (SELECT min((chunk_idx, chunk_id)) FROM c d WHERE d.asset_id = a.asset_id)) AS semantic_location FROM a")
def catalog_asset(*t):
    return tables(*t)["asset"].select("asset_id", "record_kind", "source_path", "duration_sec", "shoot_date", "has_machine_transcript", F.coalesce("has_audio_extract", F.lit(0)).alias("has_audio_extract"), "human_transcript", "bucket", "asset_type", "semantic_location")


@_ask("catalog_people", "SELECT DISTINCT asset_id, unnest(from_json(people_ids_json, '[\"VARCHAR\"]')) AS p_id FROM a WHERE people_ids_json IS NOT NULL")
def catalog_people(*t):
    return tables(*t)["asset_people"]


@_ask("catalog_orgs", "SELECT DISTINCT asset_id, unnest(from_json(org_ids_json, '[\"VARCHAR\"]')) AS o_id FROM a WHERE org_ids_json IS NOT NULL")
def catalog_orgs(*t):
    return tables(*t)["asset_orgs"]


@_ask("catalog_place", "SELECT DISTINCT asset_id, unnest(from_json(place_ids_json, '[\"VARCHAR\"]')) AS pl_id, 'catalog' AS source FROM a WHERE place_ids_json IS NOT NULL")
def catalog_place(*t):
    return tables(*t)["asset_place"].select("asset_id", "pl_id", "source")


@_ask("catalog_chunk", "SELECT asset_id, chunk_id, coalesce(chunk_idx, 0) AS chunk_idx, start_sec, end_sec, model, left(response_raw, 20) AS subject, CASE WHEN trim(bucket) <> '' THEN bucket END AS setting_location, label_status AS camera_movement FROM c")
def catalog_chunk(*t):
    return tables(*t)["asset_semantic_chunk"].where("setting_time_of_day IS NULL AND camera_perspective IS NULL").select("asset_id", "chunk_id", "chunk_idx", "start_sec", "end_sec", "model", "subject", "setting_location", "camera_movement")


@_ask("catalog_moment", "SELECT asset_id, chunk_id, 0 AS moment_idx, start_sec AS timestamp_sec, response_raw AS description FROM c WHERE start_sec IS NOT NULL")
def catalog_moment(*t):
    return tables(*t)["asset_semantic_key_moment"]


@_ask("catalog_segment", "SELECT asset_id, seg_idx, start_sec, end_sec, speaker_id, speaker_p_id, text FROM s")
def catalog_segment(*t):
    return tables(*t)["segment"]


@_ask("catalog_person_appearance", "SELECT speaker_p_id AS p_id, asset_id, seg_idx, start_sec, end_sec, text FROM s WHERE speaker_p_id IS NOT NULL")
def catalog_appearance(*t):
    return tables(*t)["person_appearance"]


@_ask("catalog_audio_quality", "SELECT asset_id, record_kind, rms_dbfs, is_windy, is_usable FROM aq")
def catalog_audio(*t):
    return tables(*t)["audio_quality"].select("asset_id", "record_kind", "rms_dbfs", "is_windy", "is_usable")


@_ask("catalog_shots", "SELECT asset_id, shot_idx, start_sec, end_sec, sharpness_score, is_in_focus, is_setup_or_teardown, is_aesthetic FROM sh")
def catalog_shots(*t):
    flat = tables(*t)
    return flat["shot"].join(flat["shot_quality"].withColumnRenamed("shot_idx", "i").withColumnRenamed("asset_id", "b"), (F.col("asset_id") == F.col("b")) & F.col("shot_idx").eqNullSafe(F.col("i"))).select("asset_id", "shot_idx", "start_sec", "end_sec", "sharpness_score", "is_in_focus", "is_setup_or_teardown", "is_aesthetic")


@_ask("catalog_frame_text", "SELECT asset_id, shot_idx, frame_time_sec, text FROM tx WHERE length(trim(text)) >= 3 AND regexp_matches(text, '[a-zA-Z]')")
def catalog_frame_text(*t):
    return tables(*t)["frame_text"].where(F.col("text").rlike("[a-zA-Z]") & (F.length(F.trim("text")) >= 3)).select("asset_id", "shot_idx", "frame_time_sec", "text")


@_ask("catalog_bib_hit", r"SELECT asset_id, chunk_idx AS shot_idx, start_sec AS frame_time_sec, regexp_extract(response_raw, '(\d{2,4})', 1) AS bib_number, a.record_kind FROM c JOIN a USING (asset_id) WHERE regexp_matches(response_raw, '\d{2}')")
def catalog_bib(*t):
    return tables(*t)["bib_hit"].select("asset_id", "shot_idx", "frame_time_sec", "bib_number", "record_kind")


@_ask("catalog_dense_caption", "SELECT asset_id, chunk_id, chunk_idx AS shot_idx, response_raw AS caption_text FROM c WHERE response_raw IS NOT NULL")
def catalog_caption(*t):
    return tables(*t)["dense_caption"].select("asset_id", "chunk_id", "shot_idx", "caption_text")


@_ask("catalog_still_aesthetic", "SELECT asset_id, length(filename) / 4.0 AS aesthetic_score, 1 AS is_aesthetic FROM a WHERE record_kind = 'still'")
def catalog_still(*t):
    return tables(*t)["still_aesthetic"].select("asset_id", "aesthetic_score", "is_aesthetic")


@_ask("catalog_with_transcript", "SELECT a.asset_id, coalesce(n_segments, 0) AS n_segments, coalesce(n_speakers, 0) AS n_speakers FROM a LEFT JOIN (SELECT asset_id, count(*) AS n_segments, count(DISTINCT speaker_id) AS n_speakers FROM s GROUP BY 1) USING (asset_id)")
def catalog_with_transcript(*t):
    flat = tables(*t)
    return catalog.asset_with_transcript(flat["asset"], flat["segment"]).select("asset_id", "n_segments", "n_speakers")


@_ask("catalog_enriched", "SELECT a.asset_id, (SELECT count(*) FROM c WHERE c.asset_id = a.asset_id) AS n_chunks, (SELECT count(start_sec) FROM c WHERE c.asset_id = a.asset_id) AS n_moments, coalesce((SELECT count(DISTINCT p) FROM (SELECT unnest(from_json(a.place_ids_json, '[\"VARCHAR\"]')) AS p)), 0) AS n_places FROM a")
def catalog_enriched(*t):
    flat = tables(*t)
    return catalog.asset_enriched(flat["asset"], flat["asset_semantic_chunk"], flat["asset_semantic_key_moment"], flat["asset_place"]).select("asset_id", "n_chunks", "n_moments", "n_places")


@_ask("catalog_regrouped_chunks", "SELECT asset_id, count(*) AS n, list_sort(list_distinct(list(model))) AS models FROM c GROUP BY 1")
def catalog_regrouped(*t):
    grouped = catalog.regroup_chunks(tables(*t)["asset_semantic_chunk"], "asset_id", "chunk_idx", ["chunk_id"])
    return grouped.select("asset_id", F.size("chunks").alias("n"), "models")


_PERSON = "(SELECT speaker_p_id FROM s WHERE speaker_p_id IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"
_TALKERS = "(SELECT speaker_p_id FROM s WHERE speaker_p_id IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 50)"
_SEEN = "list_sort(list_distinct(list(p_id)))"


def _person(flat: dict[str, DataFrame]) -> str:
    row = flat["person_appearance"].groupBy("p_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_id").first()
    return row["p_id"] if row else "nobody"


@_ask(
    "q1_soundbites",
    f"SELECT q.asset_id, quote_idx, q.start_sec, soundbite_score, {_SEEN} AS on_camera FROM q JOIN a USING (asset_id) JOIN ff ON ff.asset_id = q.asset_id AND p_id IS NOT NULL AND frame_time_sec BETWEEN q.start_sec - 1 AND q.end_sec + 1 WHERE speaker = {_PERSON} AND soundbite_score >= 1 GROUP BY ALL HAVING list_contains(on_camera, {_PERSON}) ORDER BY soundbite_score DESC, q.asset_id, quote_idx LIMIT 30",
)
def q1(*t):
    flat = tables(*t)
    return composers.soundbites_with_face(flat, _person(flat), min_score=1.0, usable=False, not_windy=False).select("asset_id", "quote_idx", "start_sec", "soundbite_score", "on_camera")


@_ask(
    "q2_broll_with_quality",
    "SELECT asset_id, shot_idx, sharpness_score, is_aesthetic FROM sh JOIN (SELECT asset_id, record_kind, (SELECT arg_min(bucket, (chunk_idx, chunk_id)) FROM c WHERE c.asset_id = a.asset_id AND bucket IS NOT NULL AND (chunk_idx, chunk_id) = (SELECT min((chunk_idx, chunk_id)) FROM c d WHERE d.asset_id = a.asset_id)) AS loc FROM a) b USING (asset_id) WHERE record_kind = 'video' AND loc ILIKE '%sel%' AND duration_sec >= 2 AND is_in_focus = 1 AND is_setup_or_teardown = 0 ORDER BY is_aesthetic DESC, sharpness_score DESC, duration_sec DESC, asset_id, shot_idx LIMIT 30",
)
def q2(*t):
    return composers.broll_with_quality(tables(*t), location="sel", asset_type=None).select("asset_id", "shot_idx", "sharpness_score", "is_aesthetic")


@_ask(
    "q3_broll",
    "SELECT asset_id, shot_idx, sharpness_score FROM sh JOIN a USING (asset_id) WHERE record_kind = 'video' AND sh.duration_sec >= 2 AND is_in_focus = 1 AND is_setup_or_teardown = 0 AND (asset_id, shot_idx) IN (SELECT asset_id, chunk_idx FROM c WHERE response_raw ILIKE '%the%') AND asset_id IN (SELECT asset_id FROM aq WHERE is_usable = 1) AND NOT EXISTS (SELECT 1 FROM ff WHERE ff.asset_id = sh.asset_id AND p_id IS NOT NULL AND frame_time_sec BETWEEN sh.start_sec - 0.5 AND sh.end_sec + 0.5) ORDER BY sharpness_score DESC, sh.duration_sec DESC, asset_id, shot_idx LIMIT 30",
)
def q3(*t):
    return composers.broll(tables(*t), caption="the", audio_state="usable", no_people=True, rank_by="sharpness", asset_type=None).select("asset_id", "shot_idx", "sharpness_score")


@_ask(
    "q4_caption_matches",
    "SELECT c.asset_id, c.chunk_idx AS shot_idx, n * 2.0 AS sharpness_score FROM c WHERE response_raw ILIKE '%camera%' AND chunk_idx <> 0 AND label_status = 'done' ORDER BY n DESC, asset_id, shot_idx, start_sec LIMIT 30",
)
def q4(*t):
    return composers.caption_matches(tables(*t), "camera").select("asset_id", "shot_idx", "sharpness_score")


@_ask(
    "q5_funny_moments",
    f"SELECT q.asset_id, quote_idx, comedy_confidence, {_SEEN} AS on_camera FROM q JOIN a USING (asset_id) JOIN aq USING (asset_id) JOIN ff ON ff.asset_id = q.asset_id AND p_id IS NOT NULL AND frame_time_sec BETWEEN q.start_sec - 1 AND q.end_sec + 1 WHERE a.record_kind = 'video' AND comic AND comedy_confidence >= 0.5 AND is_usable = 1 AND is_windy = 0 GROUP BY ALL ORDER BY comedy_confidence DESC, q.asset_id, quote_idx LIMIT 30",
)
def q5(*t):
    return composers.funny_moments(tables(*t)).select("asset_id", "quote_idx", "comedy_confidence", "on_camera")


@_ask(
    "q6_bib_appearances",
    r"SELECT asset_id, chunk_idx AS shot_idx, regexp_extract(response_raw, '(\d{2,4})', 1) AS bib_number, n / 300.0 AS confidence FROM c WHERE regexp_extract(response_raw, '(\d{2,4})', 1) = (SELECT min(regexp_extract(response_raw, '(\d{2,4})', 1)) FROM c WHERE regexp_matches(response_raw, '\d{2}')) ORDER BY confidence DESC, n DESC, asset_id, start_sec LIMIT 30",
)
def q6(*t):
    flat = tables(*t)
    row = flat["bib_hit"].agg(F.min("bib_number").alias("b")).first()
    return composers.bib_appearances(flat, bib_number=row["b"] or "none", in_focus=False, no_setup=False).select("asset_id", "shot_idx", "bib_number", "confidence")


@_ask("q9_allowlist_of_person", f"SELECT DISTINCT asset_id FROM a WHERE asset_id IN (SELECT asset_id FROM s WHERE speaker_p_id IN {_TALKERS}) AND asset_id IN (SELECT asset_id FROM c)")
def q9(*t):
    flat = tables(*t)
    talkers = flat["person_appearance"].groupBy("p_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_id").limit(50).collect()
    return composers.asset_allowlist(flat, record_kind=None, person_ids=[r["p_id"] for r in talkers], shot_size="WIDE")


@_ask(
    "q15_source_windows",
    """, m AS (SELECT c.asset_id, a.duration_sec AS d, start_sec AS t, CASE WHEN regexp_matches(lower(response_raw), 'pan|drift|whip|sigh|handheld|shake|tilt|wobble|out of focus|blurry|obscur') THEN 'n' WHEN regexp_matches(lower(response_raw), 'clean|static|wide|stable|settled|establishing|reveal|centered|in focus|racks focus') THEN 'p' ELSE '-' END AS k FROM c JOIN a USING (asset_id) WHERE start_sec IS NOT NULL),
    g AS (SELECT asset_id, min(t) + 1 AS good FROM m p WHERE k = 'p' AND coalesce((SELECT min(t) FROM m x WHERE x.asset_id = p.asset_id AND x.k = 'n' AND x.t > p.t + 1 + 0.01), d) - p.t - 1 >= 8 GROUP BY 1),
    e AS (SELECT asset_id, d, 0.0 AS a, coalesce(min(t) FILTER (k = 'n'), d) AS b FROM m GROUP BY asset_id, d UNION ALL SELECT asset_id, d, t + 1, coalesce(lead(t) OVER (PARTITION BY asset_id ORDER BY t), d) FROM m WHERE k = 'n'),
    r AS (SELECT asset_id, arg_max(e.a, (e.b - e.a, -e.a)) AS x, arg_max(e.b, (e.b - e.a, -e.a)) AS y FROM e WHERE e.b - e.a > least(8.0, d) GROUP BY 1)
    SELECT asset_id, round_even(CASE WHEN coalesce(duration_sec, 0) <= 0 THEN 0 WHEN asset_id NOT IN (SELECT asset_id FROM m) THEN least(2.0, greatest(0.0, duration_sec - 8)) ELSE coalesce(good, x, 0.0) END, 3) AS source_in FROM a LEFT JOIN g USING (asset_id) LEFT JOIN r USING (asset_id) WHERE record_kind = 'video'""",
)
def q15(*t):
    flat = tables(*t)
    assets = flat["asset"].where("record_kind = 'video'").select("asset_id", "duration_sec", F.lit("handheld").alias("camera_movement"))
    return composers.source_windows(assets, flat["asset_semantic_key_moment"], 8.0).select("asset_id", "source_in")


@_ask("q16_used_assets", ", x AS (SELECT asset_id, lower(source_path) AS w, lower(string_split(source_path, '/')[-1]) AS f FROM a), k AS (SELECT 's' || (length(filename) % 3) AS sequence, source_path AS p FROM a WHERE record_kind = 'video' UNION SELECT 'other', '/elsewhere/' || filename FROM a WHERE record_kind = 'audio'), w AS (SELECT w, min(asset_id) AS asset_id FROM x GROUP BY 1 HAVING count(DISTINCT asset_id) = 1), f AS (SELECT f, min(asset_id) AS asset_id FROM x GROUP BY 1 HAVING count(DISTINCT asset_id) = 1), r AS (SELECT sequence, coalesce(w.asset_id, f.asset_id) AS asset_id FROM k LEFT JOIN w ON lower(p) = w.w LEFT JOIN f ON lower(string_split(p, '/')[-1]) = f.f) SELECT asset_id, list_sort(list_distinct(list(sequence))) AS sequences FROM r WHERE asset_id IS NOT NULL GROUP BY 1")
def q16(*t):
    a = tables(*t)["asset"]
    clips = a.where("record_kind = 'video'").select(F.concat(F.lit("s"), F.length("filename") % 3).alias("sequence"), F.col("source_path").alias("path")).union(a.where("record_kind = 'audio'").select(F.lit("other"), F.concat(F.lit("/elsewhere/"), "filename"))).distinct()
    return composers.used_assets(clips, a.select("asset_id", F.col("source_path").alias("path")))


@_ask(
    "q17_audit_cut",
    ", k AS (SELECT chunk_id AS clip_id, asset_id, start_sec * 24000 / 1001 AS i, end_sec * 24000 / 1001 AS o, chunk_idx, response_raw FROM c) SELECT clip_id, unnest(list_filter([CASE WHEN chunk_idx = 0 THEN 'TRANSITION_SENTINEL' END, CASE WHEN o / (24000 / 1001.0) > duration_sec + 0.05 THEN 'SOURCE_OUT_OF_BOUNDS' END, CASE WHEN duration_sec IS NULL THEN 'UNRESOLVED_ASSET' END, CASE WHEN duration_sec IS NOT NULL AND k.asset_id NOT IN (SELECT asset_id FROM aq) THEN 'NOTES_MISSING' END, CASE WHEN coalesce(trim(response_raw), '') = '' THEN 'RATIONALE_MISSING' END], lambda x: x IS NOT NULL)) AS flag FROM k JOIN a USING (asset_id)",
)
def q17(*t):
    flat = tables(*t)
    clips = flat["asset_semantic_chunk"].select(F.col("chunk_id").alias("clip_id"), "asset_id", F.lit("x").alias("pathurl"), F.when(F.col("chunk_idx") == 0, -1).otherwise(0).alias("start"), F.lit(0).alias("end"), (F.col("start_sec") * 24_000 / 1_001).alias("source_in"), (F.col("end_sec") * 24_000 / 1_001).alias("source_out"), F.col("editorial_notes").alias("rationale"))
    notes = flat["audio_quality"].select("asset_id", F.lit(None).cast("double").alias("avoid_start"), F.lit(None).cast("double").alias("avoid_end"))
    return composers.audit_cut(clips, flat["asset"], notes)


@_ask("v39_suggested_spans", ", m AS (SELECT s.asset_id, s.seg_idx, s.start_sec, s.end_sec, min(c.start_sec) AS t FROM s LEFT JOIN c ON c.asset_id = s.asset_id AND c.start_sec BETWEEN s.start_sec AND s.end_sec WHERE s.start_sec <= s.end_sec GROUP BY ALL) SELECT asset_id, seg_idx, round(greatest(start_sec, t - 2), 3) AS span_in, round(CASE WHEN t IS NOT NULL THEN least(end_sec, t + 8) END, 3) AS span_out FROM m WHERE t IS NOT NULL")
def v39(*t):
    flat = tables(*t)
    windows = flat["segment"].where("start_sec <= end_sec").select(F.struct("asset_id", "seg_idx").alias("id"), "asset_id", F.col("start_sec").alias("start"), F.col("end_sec").alias("end"))
    spans = composers.suggested_spans(windows, flat["asset_semantic_key_moment"]).where("span_in IS NOT NULL")
    return spans.select("id.asset_id", "id.seg_idx", F.round("span_in", 3).alias("span_in"), F.round("span_out", 3).alias("span_out"))


@_ask("q19_faces_by_person", f"SELECT asset_id, count(*) AS n_faces FROM ff WHERE p_id = {_PERSON} GROUP BY 1 ORDER BY n_faces DESC, asset_id LIMIT 50")
def q19(*t):
    flat = tables(*t)
    return people.by_person(flat["frame_face"], _person(flat))


@_ask("q19_screen_time", "SELECT p_id, round(count(DISTINCT (asset_id, frame_idx)) * 7 / 60.0, 6) AS minutes FROM ff WHERE p_id IS NOT NULL GROUP BY 1")
def q19_time(*t):
    return people.screen_time(tables(*t)["frame_face"]).select("p_id", F.round("minutes", 6).alias("minutes"))


@_ask("q19_alone", f"SELECT asset_id FROM ff WHERE p_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT p_id) = 1 AND min(p_id) = {_PERSON}")
def q19_alone(*t):
    flat = tables(*t)
    return people.alone(flat["frame_face"], _person(flat))


@_ask("q19_co_appearance", ", w AS (SELECT asset_id FROM ff GROUP BY 1 ORDER BY count(DISTINCT p_id) DESC, 1 LIMIT 1), p AS (SELECT DISTINCT p_id FROM ff WHERE p_id IS NOT NULL AND asset_id IN (FROM w) ORDER BY 1 LIMIT 2) SELECT asset_id, count(DISTINCT frame_idx) FILTER (p_id = (SELECT min(p_id) FROM p)) AS n_a, count(DISTINCT frame_idx) FILTER (p_id = (SELECT max(p_id) FROM p)) AS n_b FROM ff GROUP BY 1 HAVING n_a > 0 AND n_b > 0")
def q19_both(*t):
    f = tables(*t)["frame_face"]
    widest = f.groupBy("asset_id").agg(F.count_distinct("p_id").alias("n"), F.array_sort(F.collect_set("p_id")).alias("people")).orderBy(F.desc("n"), "asset_id").first()
    two = (widest["people"] if widest else []) or ["nobody"]
    return people.co_appearance(f, two[0], two[min(1, len(two) - 1)])


def queries():
    return dict(REG.queries)


def oracle_sql():
    return dict(REG.sql)
