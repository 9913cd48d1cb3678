"""Nested catalogue records to flat tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldreel.functions.columns import readable_text
from fieldreel.session import steady

_S, _D, _L, _I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


def _items(**fields: T.DataType) -> T.StructType:
    return _struct(processed_at=_S, items=T.ArrayType(_struct(**fields)))


_METRICS = {"rms_dbfs": _D, "peak_dbfs": _D, "clipping_ratio": _D, "silence_ratio": _D, "dc_offset": _D, "low_freq_ratio": _D, "is_silent": _I, "is_quiet": _I, "is_clippy": _I, "is_windy": _I, "is_usable": _I}
_QUALITY = _struct(duration_sec=_D, metrics=_struct(**_METRICS))
CHUNK = _struct(chunk_id=_S, chunk_idx=_I, start_sec=_D, end_sec=_D, model=_S, subject=_S, action=_S, setting=_struct(location=_S, time_of_day=_S, weather=_S), camera=_struct(shot_size=_S, movement=_S, perspective=_S), audio_character=_S, emotional_tone=_S, editorial_notes=_S, key_moments=T.ArrayType(_struct(timestamp_sec=_D, description=_S)))
RECORD = _struct(
    asset_id=_S, record_kind=_S, source_path=_S, filename=_S, filesize_bytes=_L, ffprobe=_struct(duration_sec=_D, width=_I, height=_I, codec=_S, color_profile=_S), path_metadata=_struct(shoot_date=_S, shoot_label=_S, category_name=_S, camera_id=_S),
    audio_recorder=_S, primary_timeline_date=_S, human_transcript=T.BooleanType(), people_ids=T.ArrayType(_S), org_ids=T.ArrayType(_S), moment_ids=T.ArrayType(_S), place_ids=T.ArrayType(_S),
    place_match=_struct(matches=T.ArrayType(_struct(pl_id=_S, confidence=_S, matched_phrase=_S)), sources=T.MapType(_S, T.ArrayType(_S))), asset_classifications=_struct(bucket=_S, type=_S), asset_semantic_summary=_struct(chunks=T.ArrayType(CHUNK)),
    audio_extract=_struct(path=_S, audio_quality=_QUALITY), audio_quality=_QUALITY, shots=_items(shot_idx=_I, start_sec=_D, end_sec=_D, duration_sec=_D),
    shot_quality=_items(shot_idx=_I, n_frames_sampled=_I, sharpness_score=_D, motion_score=_D, exposure_mean=_D, clipping_ratio=_D, is_blurry=_I, is_dark=_I, is_blown=_I, is_setup_or_teardown=_I, is_in_focus=_I, aesthetic_score=_D, is_aesthetic=_I),
    ocr_detections=_items(shot_idx=_I, frame_time_sec=_D, bbox_json=_S, text=_S, confidence=_D, ocr_engine=_S, qa_verdict=_S), bib_hits=_items(shot_idx=_I, frame_time_sec=_D, bib_number=_S, confidence=_D, source_ocr_engine=_S, p_id=_S),
    dense_captions=_items(chunk_id=_S, shot_idx=_I, frame_time_sec=_D, sample_pos=_S, caption_text=_S, caption_json=_S, model_engine=_S, prompt_variant=_S), still_aesthetic=_struct(metrics=_struct(aesthetic_score=_D, is_aesthetic=_I, image_ext=_S)),
)
TRANSCRIPT = _struct(
    asset_id=_S, segments=T.ArrayType(_struct(start_sec=_D, end_sec=_D, text=_S, speaker_raw=_S, speaker=_S)), speakers=T.ArrayType(_struct(speaker_id=_S, p_id=_S, label_raw=_S, is_stub=T.BooleanType(), segment_count=_I, total_duration_sec=_D, first_seen_sec=_D)),
    analysis=_struct(key_quotes=T.ArrayType(_struct(text=_S, speaker=_S, start_sec=_D, end_sec=_D, story_function=_S, linked_moment_idx=_I, soundbite_quality=_struct(score=_S, reasons=T.ArrayType(_S)), comedic=_struct(is_comedic=_S, type=_S, confidence=_S, notes=_S))), key_moments=T.ArrayType(_struct(label=_S, start_sec=_D, end_sec=_D, subjects_on_camera=T.ArrayType(_S)))),
)


def said(c: Column) -> Column:
    """The text as it is, or null if blank."""
    return F.when(F.trim(c) != "", c)


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("int")


def _layer(records: DataFrame, layer: str) -> DataFrame:
    return records.select("asset_id", "record_kind", F.explode(f"{layer}.items").alias("i")).select("asset_id", "record_kind", "i.*")


def project(records: DataFrame, transcripts: DataFrame) -> dict[str, DataFrame]:
    """All flat tables of nested asset records and transcripts. A record without asset_id is left out; of repeated keys the bridge tables keep one."""
    steady(records.sparkSession)
    records = records.where("asset_id IS NOT NULL")
    first = F.get("asset_semantic_summary.chunks", 0)
    with_transcript = transcripts.select("asset_id", F.lit(1).alias("_t")).distinct()
    ids = lambda c: F.to_json(F.coalesce(c, F.array().cast("array<string>")))
    asset = records.join(with_transcript, "asset_id", "left").select(
        "asset_id", "record_kind", "source_path", "filename", "filesize_bytes", "ffprobe.duration_sec", "ffprobe.width", "ffprobe.height", "ffprobe.codec", "ffprobe.color_profile",
        "path_metadata.shoot_date", "path_metadata.shoot_label", "path_metadata.category_name", "path_metadata.camera_id", "audio_recorder", "primary_timeline_date",
        _flag(F.col("_t") == 1).alias("has_machine_transcript"), F.col("audio_extract").isNotNull().cast("int").alias("has_audio_extract"), _flag(F.col("human_transcript")).alias("human_transcript"),
        *(ids(F.col(f"{k}_ids")).alias(f"{k}_ids_json") for k in ("people", "org", "moment", "place")),
        F.col("asset_classifications.bucket").alias("bucket"), F.col("asset_classifications.type").alias("asset_type"),
        first["setting"]["location"].alias("semantic_location"), first["subject"].alias("semantic_subject"), first["editorial_notes"].alias("semantic_editorial_notes"),
    )
    bridge = lambda c, out: records.select("asset_id", F.explode(c).alias(out)).where(F.col(out).isNotNull()).distinct()
    places = records.select("asset_id", "place_match", F.explode("place_ids").alias("pl_id"))
    match = F.filter(F.col("place_match.matches"), lambda m: m["pl_id"] == F.col("pl_id"))
    last = F.try_element_at(match, F.lit(-1))
    sources = F.try_element_at(F.col("place_match.sources"), F.col("pl_id"))
    asset_place = places.select("asset_id", "pl_id", F.coalesce(F.when(F.size(sources) > 0, F.array_join(sources, ",")), F.lit("catalog")).alias("source"), last["confidence"].alias("confidence"), last["matched_phrase"].alias("matched_phrase")).dropDuplicates(["asset_id", "pl_id"])
    chunks = records.select("asset_id", F.explode("asset_semantic_summary.chunks").alias("c")).where("c.chunk_id IS NOT NULL")
    chunk = chunks.select(
        "asset_id", "c.chunk_id", F.coalesce("c.chunk_idx", F.lit(0)).alias("chunk_idx"), "c.start_sec", "c.end_sec", "c.model", "c.subject", "c.action", *(said(F.col(f"c.setting.{k}")).alias(f"setting_{k}") for k in ("location", "time_of_day", "weather")),
        *(said(F.col(f"c.camera.{k}")).alias(f"camera_{k}") for k in ("shot_size", "movement", "perspective")), "c.audio_character", "c.emotional_tone", "c.editorial_notes",
    ).dropDuplicates(["chunk_id"])
    moments = chunks.select("asset_id", "c.chunk_id", F.posexplode("c.key_moments").alias("moment_idx", "m")).where("m.timestamp_sec IS NOT NULL").select("asset_id", "chunk_id", "moment_idx", "m.timestamp_sec", "m.description")
    quality = F.coalesce(F.when(F.col("record_kind") == "video", F.col("audio_extract.audio_quality")), F.col("audio_quality"))
    audio_quality = records.where("record_kind IN ('video', 'audio')").select("asset_id", "record_kind", quality.alias("q")).where("q IS NOT NULL").select("asset_id", "record_kind", "q.duration_sec", "q.metrics.*")
    segments = transcripts.select("asset_id", F.posexplode("segments").alias("seg_idx", "s")).select("asset_id", "seg_idx", "s.start_sec", "s.end_sec", F.col("s.speaker_raw").alias("speaker_id"), F.col("s.speaker").alias("speaker_p_id"), "s.text")
    frame_text = _layer(records, "ocr_detections").where(readable_text(F.col("text")) & (F.coalesce("qa_verdict", F.lit("")) != "suspicious")).drop("qa_verdict")
    return {
        "asset": asset, "asset_people": bridge("people_ids", "p_id"), "asset_orgs": bridge("org_ids", "o_id"), "asset_place": asset_place, "asset_semantic_chunk": chunk, "asset_semantic_key_moment": moments,
        "segment": segments, "person_appearance": segments.where("speaker_p_id IS NOT NULL").select(F.col("speaker_p_id").alias("p_id"), "asset_id", "seg_idx", "start_sec", "end_sec", "text"),
        "speaker": transcripts.select("asset_id", F.explode("speakers").alias("s")).select("asset_id", "s.*").dropDuplicates(["asset_id", "speaker_id"]),
        "shot": _layer(records, "shots").drop("record_kind"), "shot_quality": _layer(records, "shot_quality").drop("record_kind"), "audio_quality": audio_quality, "frame_text": frame_text,
        "bib_hit": _layer(records, "bib_hits").withColumnRenamed("source_ocr_engine", "ocr_engine"), "dense_caption": _layer(records, "dense_captions").drop("record_kind"),
        "still_aesthetic": records.where("record_kind = 'still' AND still_aesthetic IS NOT NULL").select("asset_id", "still_aesthetic.metrics.*"),
        "quote": transcripts.select("asset_id", "analysis.key_moments", F.posexplode("analysis.key_quotes").alias("quote_idx", "q")).select("asset_id", "quote_idx", "q.*", "key_moments"),
    }


def shot_text(frame_text: DataFrame) -> DataFrame:
    """Rows (asset_id, shot_idx, n_text, n_distinct, texts) of recognised texts per shot."""
    return frame_text.where("shot_idx IS NOT NULL").groupBy("asset_id", "shot_idx").agg(F.count("*").alias("n_text"), F.countDistinct("text").alias("n_distinct"), F.array_join(F.array_sort(F.collect_set("text")), " | ").alias("texts"))


def asset_with_transcript(asset: DataFrame, segment: DataFrame) -> DataFrame:
    counts = segment.groupBy("asset_id").agg(F.count("*").alias("n_segments"), F.countDistinct("speaker_id").alias("n_speakers"))
    return asset.join(counts, "asset_id", "left").fillna(0, ["n_segments", "n_speakers"])


def asset_enriched(asset: DataFrame, chunk: DataFrame, moment: DataFrame, place: DataFrame) -> DataFrame:
    parts = [chunk.groupBy("asset_id").agg(F.count("*").alias("n_chunks")), moment.groupBy("asset_id").agg(F.count("*").alias("n_moments")), place.groupBy("asset_id").agg(F.count("*").alias("n_places"), F.array_join(F.array_sort(F.collect_set("pl_id")), ",").alias("place_ids"))]
    for part in parts:
        asset = asset.join(part, "asset_id", "left")
    return asset.fillna(0, ["n_chunks", "n_moments", "n_places"])


def regroup_chunks(chunks: DataFrame, by: str, order: str, fields: list[str]) -> DataFrame:
    """Rows (by, chunks, models): chunks in order as an array of structs, and the distinct models, sorted."""
    return chunks.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(order, *fields))).alias("chunks"), F.array_sort(F.collect_set("model")).alias("models"))


def chunk_from_text(df: DataFrame, text: str, fields: list[str]) -> DataFrame:
    """``df`` with the named fields of a JSON text; rows whose text isn't an object, or has none of them, are left out."""
    parsed = df.withColumn("_j", F.from_json(F.col(text), T.MapType(_S, _S)))
    some = F.coalesce(*(said(F.try_element_at("_j", F.lit(f))) for f in fields))
    return parsed.where(some.isNotNull()).withColumns({f: said(F.try_element_at("_j", F.lit(f))) for f in fields}).drop("_j")
