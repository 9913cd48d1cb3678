import json

import pytest
from pyspark.sql import functions as F

from fieldreel.plans import catalog, composers
from fieldreel.sources import files

RECORDS = [
    {"asset_id": "v1", "record_kind": "video", "filename": "a.mov", "source_path": "/x/a.mov", "ffprobe": {"duration_sec": 60.0}, "path_metadata": {"shoot_label": "ridge", "shoot_date": "2024-05-06"}, "people_ids": ["p1", "p1", "p2"], "place_ids": ["pl_1"],
     "place_match": {"matches": [{"pl_id": "pl_1", "confidence": "high", "matched_phrase": "ridge"}], "sources": {"pl_1": ["path", "text"]}}, "asset_classifications": {"bucket": "own", "type": "b_roll"},
     "asset_semantic_summary": {"chunks": [{"chunk_id": "c1", "chunk_idx": 0, "start_sec": 0.0, "end_sec": 30.0, "subject": "a runner", "setting": {"location": "the ridge", "weather": "  "}, "camera": {"movement": "gimbal"}, "key_moments": [{"timestamp_sec": 5.0, "description": "steady view"}, {"description": "no time"}]}]},
     "audio_extract": {"path": "a.wav", "audio_quality": {"duration_sec": 60.0, "metrics": {"is_usable": 1, "is_windy": 0, "is_silent": 0}}},
     "shots": {"items": [{"shot_idx": 0, "start_sec": 0.0, "end_sec": 10.0, "duration_sec": 10.0}, {"shot_idx": 1, "start_sec": 10.0, "end_sec": 20.0, "duration_sec": 10.0}, {"shot_idx": 2, "start_sec": 20.0, "end_sec": 21.0, "duration_sec": 1.0}]},
     "shot_quality": {"items": [{"shot_idx": 0, "sharpness_score": 200.0, "is_in_focus": 1, "is_setup_or_teardown": 0, "is_aesthetic": 1, "aesthetic_score": 5.0}, {"shot_idx": 2, "sharpness_score": 900.0, "is_in_focus": 1}]},
     "ocr_detections": {"items": [{"shot_idx": 0, "frame_time_sec": 1.0, "text": "FINISH"}, {"shot_idx": 0, "frame_time_sec": 2.0, "text": "ab"}, {"shot_idx": 0, "frame_time_sec": 3.0, "text": "START", "qa_verdict": "suspicious"}]},
     "bib_hits": {"items": [{"shot_idx": 0, "frame_time_sec": 4.0, "bib_number": "42", "confidence": 0.9, "p_id": "p1"}]}, "dense_captions": {"items": [{"shot_idx": 0, "frame_time_sec": 4.0, "sample_pos": "b", "caption_text": "later"}, {"shot_idx": 0, "frame_time_sec": 2.0, "sample_pos": "a", "caption_text": "A runner on a ridge"}]}},
    {"asset_id": "a1", "record_kind": "audio", "audio_quality": {"metrics": {"is_usable": 0}}},
    {"asset_id": "s1", "record_kind": "still", "still_aesthetic": {"metrics": {"aesthetic_score": 4.5, "is_aesthetic": 1}}},
    {"record_kind": "video"},
]
QUOTES = [
    {"text": "We saw the storm", "speaker": "p1", "start_sec": 5.0, "end_sec": 8.0, "story_function": "setup", "soundbite_quality": {"score": "4"}, "comedic": {"is_comedic": "True", "confidence": "0.8", "type": "irony"}, "linked_moment_idx": 0},
    {"text": "off camera", "speaker": "p1", "start_sec": 40.0, "end_sec": 42.0, "soundbite_quality": {"score": 5}, "comedic": {"is_comedic": "None"}, "linked_moment_idx": 7},
    {"text": "unscored", "speaker": "p1", "start_sec": 5.0, "end_sec": 6.0, "soundbite_quality": {"score": "None"}},
]
TRANSCRIPTS = [{"asset_id": "v1", "segments": [{"start_sec": 4.5, "end_sec": 8.2, "text": "We saw the storms running", "speaker": "p1", "speaker_raw": "S1"}, {"start_sec": 50.0, "end_sec": 51.0, "text": "nothing", "speaker_raw": "S2"}], "analysis": {"key_quotes": QUOTES, "key_moments": [{"label": "m", "subjects_on_camera": ["p2"]}]}}]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("records")
    for k, r in enumerate(RECORDS):
        (folder / f"{k}.json").write_text(json.dumps(r, indent=1))
    (folder / "broken.json").write_text("{not json")
    records = files.read_json_folder(spark, str(folder), catalog.RECORD, "asset_id")
    lines = tmp_path_factory.mktemp("lines") / "t.jsonl"
    lines.write_text("\n\n".join(map(json.dumps, TRANSCRIPTS)) + "\n{broken\n")
    out = catalog.project(records, files.read_json_lines(spark, str(lines), catalog.TRANSCRIPT))
    faces = [("v1", 4.0, "p1"), ("v1", 9.0, "p2"), ("v1", 9.001, "p3"), ("v1", 30.0, None)]
    out["frame_face"] = spark.createDataFrame(faces, "asset_id string, frame_time_sec double, p_id string")
    return {k: v.cache() for k, v in out.items()}


def test_projection(tables):
    assert {r.asset_id: (r.has_machine_transcript, r.has_audio_extract, r.semantic_location) for r in tables["asset"].collect()} == {"v1": (1, 1, "the ridge"), "a1": (0, 0, None), "s1": (0, 0, None)}
    assert {r.p_id for r in tables["asset_people"].collect()} == {"p1", "p2"}
    assert [tuple(r) for r in tables["asset_place"].collect()] == [("v1", "pl_1", "path,text", "high", "ridge")]
    chunk = tables["asset_semantic_chunk"].first()
    assert (chunk.setting_location, chunk.setting_weather, chunk.camera_movement) == ("the ridge", None, "gimbal")
    assert tables["asset_semantic_key_moment"].count() == 1 and [r.text for r in tables["frame_text"].collect()] == ["FINISH"]
    assert {r.asset_id for r in tables["audio_quality"].collect()} == {"v1", "a1"}
    assert [(r.n_text, r.texts) for r in catalog.shot_text(tables["frame_text"]).collect()] == [(1, "FINISH")]
    enriched = catalog.asset_enriched(tables["asset"], tables["asset_semantic_chunk"], tables["asset_semantic_key_moment"], tables["asset_place"])
    assert {r.asset_id: (r.n_chunks, r.n_places) for r in enriched.collect()}["v1"] == (1, 1)
    assert {r.asset_id: r.n_segments for r in catalog.asset_with_transcript(tables["asset"], tables["segment"]).collect()} == {"v1": 2, "a1": 0, "s1": 0}


def test_soundbites(tables):
    got = composers.soundbites_with_face(tables, "p1").collect()
    assert [(r.quote_idx, r.on_camera) for r in got] == [(0, ["p1", "p2"])]
    assert composers.soundbites_with_face(tables, "p1", topic="STORM", story_function="setup").count() == 1
    assert composers.soundbites_with_face(tables, "p1", topic="lake").count() == 0


def test_broll(tables):
    assert [r.shot_idx for r in composers.broll_with_quality(tables, place_id="pl_1").collect()] == [0]
    assert [r.shot_idx for r in composers.broll_with_quality(tables, location="RIDGE", in_focus=False, min_duration=0.5).collect()] == [0, 2, 1]
    got = composers.broll(tables, caption="runner", movement=["GIMBAL"], people=["p1"], audio_state="usable").collect()
    assert [(r.shot_idx, r.dense_caption_text, r.camera_movement, r.audio_state, r.has_bib, r.has_visible_text, r.place_ids) for r in got] == [(0, "A runner on a ridge", "gimbal", "usable", True, True, "pl_1")]
    assert composers.broll(tables, location="ridge", no_people=True, by_shoot=True, in_focus=False).count() == 1
    assert composers.broll(tables, location="ridge", no_bibs=True).count() == 0
    with pytest.raises(ValueError):
        composers.broll(tables)
    with pytest.raises(ValueError):
        composers.broll_with_quality(tables)


def test_captions_bibs_and_jokes(tables):
    assert composers.caption_matches(tables, "runner", p_id="p1").count() == 0
    assert composers.caption_matches(tables, "later", p_id="p1").count() == 1
    assert [r.on_camera for r in composers.bib_appearances(tables, bib_number="42").collect()] == [["p1"]]
    assert [(r.comedy_type, r.on_camera, r.moment_label) for r in composers.funny_moments(tables).collect()] == [("irony", ["p2"], "m")]
    assert composers.funny_moments(tables, p_id="p1").count() == 0


def test_quotes_about(tables):
    got = composers.quotes_about(tables, "storm OR nothing").collect()
    assert [(r.seg_idx, r.soundbite_score, r.has_quote) for r in got] == [(0, 4.0, True), (1, None, False)]
    assert composers.quotes_about(tables, '"saw the storm"', min_score=4).count() == 1
    assert composers.quotes_about(tables, "storm NOT run", exact=True).count() == 0
    assert composers.search_transcript(tables, "storm").count() == 1
    assert composers.search_transcript(tables, "  ").count() == 0


def test_filters(tables):
    assert [r.asset_id for r in composers.asset_allowlist(tables, place_id="pl_1", person_ids=["p1"], camera_movement="Gimbal", date_from="2024-01-01").collect()] == ["v1"]
    assert composers.asset_allowlist(tables, exclude=["v1"]).count() == 0
    assert [r.asset_id for r in composers.search_broll(tables, location="ridge").collect()] == ["v1"]


def test_source_windows(spark):
    assets = spark.createDataFrame([("a", 100.0, "static"), ("b", 100.0, "handheld"), ("c", 100.0, "static"), ("d", 0.0, None), ("e", 40.0, None)], "asset_id string, duration_sec double, camera_movement string")
    moments = spark.createDataFrame([("c", 10.0, "Stable shot"), ("c", 14.0, "handheld, wide"), ("c", 50.0, "racks focus"), ("e", 20.0, "blurry"), ("e", 5.0, "a static view"), ("e", 30.0, "x")], "asset_id string, timestamp_sec double, description string")
    got = {r.asset_id: (r.source_in, r.source_out) for r in composers.source_windows(assets, moments, 15.0).collect()}
    assert got == {"a": (0.0, 15.0), "b": (2.0, 17.0), "c": (51.0, 66.0), "d": (0.0, 15.0), "e": (0.0, 15.0)}


def test_cut_audit_and_usage(spark):
    clips = spark.createDataFrame([("k1", "v1", "/x/a.mov", 0, 24, 0, 24, "why"), ("k2", "v1", "/x/a.mov", -1, 24, 1_400, 1_500, None), ("k3", None, None, 0, 1, 0, 1, "t"), ("k4", "zz", "/x/z.mov", 0, 1, 0, 1, "t")], "clip_id string, asset_id string, pathurl string, start int, end int, source_in int, source_out int, rationale string")
    notes = spark.createDataFrame([("v1", 0.2, 0.9), ("v1", None, None)], "asset_id string, avoid_start double, avoid_end double")
    got = {tuple(r) for r in composers.audit_cut(clips, spark.createDataFrame([("v1", 60.0)], "asset_id string, duration_sec double"), notes).collect()}
    assert got == {("k1", "AVOID_WINDOW_HIT"), ("k2", "TRANSITION_SENTINEL"), ("k2", "SOURCE_OUT_OF_BOUNDS"), ("k2", "RATIONALE_MISSING"), ("k3", "GRAPHIC"), ("k4", "UNRESOLVED_ASSET")}
    paths = spark.createDataFrame([("v1", "C:\\x\\a.mov"), ("v2", "/y/b.mov"), ("v3", "/z/b.mov")], "asset_id string, path string")
    used = composers.used_assets(spark.createDataFrame([("s1", "c:/X/a.mov"), ("s2", "/other/a.mov"), ("s2", "/q/b.mov")], "sequence string, path string"), paths)
    assert [(r.asset_id, r.sequences) for r in used.collect()] == [("v1", ["s1", "s2"])]
    assert {r.asset_id for r in composers.filter_unused(paths, used).collect()} == {"v2", "v3"}


def test_suggested_spans(spark):
    w = spark.createDataFrame([(1, "a", 10.0, 15.0), (2, "a", 50.0, 90.0), (3, "b", 0.0, 9.0)], "id int, asset_id string, start double, end double")
    m = spark.createDataFrame([("a", 11.0), ("a", 12.0), ("a", 60.0)], "asset_id string, timestamp_sec double")
    assert {r.id: (r.span_in, r.span_out) for r in composers.suggested_spans(w, m).collect()} == {1: (10.0, 15.0), 2: (58.0, 68.0), 3: (None, None)}


def test_regrouped_chunks_and_json_chunks(spark, tables):
    df = spark.createDataFrame([(1, '{"subject": "x", "action": " "}'), (2, "[1]"), (3, "{}"), (4, None), (5, "oops")], "id int, raw string")
    assert [(r.id, r.subject, r.action) for r in catalog.chunk_from_text(df, "raw", ["subject", "action"]).collect()] == [(1, "x", None)]
    assert [r.models for r in catalog.regroup_chunks(tables["asset_semantic_chunk"], "asset_id", "chunk_idx", ["chunk_id"]).collect()] == [[]]
