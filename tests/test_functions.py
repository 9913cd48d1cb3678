import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldreel.functions import classify, columns, generators, media
from fieldreel.functions.python import align, fingerprint_match, fold, ratio, stem, substring_boost
from fieldreel.operators.fingerprints import apply_links, propose_links, quick_probe


def one(spark, *cols):
    return tuple(spark.range(1).select(*(c.alias(f"c{k}") for k, c in enumerate(cols))).first())


def test_texts(spark):
    assert one(spark, columns.normalise(F.lit(" The Ånt-hill, 2! ")), columns.slug("p_", F.lit("Jo Ann's")), columns.score(F.lit(" 4 ")), columns.score(F.lit("None")), columns.truthy(F.lit("Yes")), columns.truthy(F.lit(None).cast("string"))) == ("the nt hill 2", "p_jo_ann_s", 4.0, None, True, False)
    assert one(spark, columns.tokens(F.lit("The quick Fox, a fox")), columns.tokens(F.lit(None).cast("string"))) == (["quick", "fox", "fox"], [])
    assert one(spark, fold(F.lit("Éléonore Ünal")), ratio(F.lit("abcd"), F.lit("bcde")), substring_boost(F.lit("abcdefgh"), F.lit("xxdefghx"))) == ("Eleonore Unal", 0.75, 0.625)
    assert one(spark, columns.phonetic_key(F.lit("Knight")), columns.phonetic_key(F.lit("night")), columns.phonetic_key(F.lit("Philip Wright"))) == ("NT", "NT", "FLPRT")
    assert one(spark, columns.noise_reason(F.lit("!!!!")), columns.noise_reason(F.lit("bcdfg")), columns.noise_reason(F.lit("a.,;")), columns.noise_reason(F.lit("fine"))) == ("repeated", "no_vowel", "signs", None)
    assert one(spark, columns.json_object(F.lit('x {"a": {"b": 1}} y')), columns.json_object(F.lit("none"))) == ('{"a": {"b": 1}}', None)


@pytest.mark.parametrize("word, want", [("caresses", "caress"), ("ponies", "poni"), ("agreed", "agre"), ("plastered", "plaster"), ("motoring", "motor"), ("conflated", "conflat"), ("hopping", "hop"), ("filing", "file"), ("happy", "happi"), ("relational", "relat"), ("vietnamization", "vietnam"), ("hopefulness", "hope"), ("electrical", "electr"), ("adjustment", "adjust"), ("adoption", "adopt"), ("rate", "rate"), ("cease", "ceas"), ("controll", "control"), ("sky", "sky")])
def test_stems(word, want):
    assert stem(word) == want


def test_times_and_numbers(spark):
    assert one(spark, columns.timecode_seconds(F.lit("01:00:02;12")), columns.timecode_seconds(F.lit("x")), columns.seconds_frame(F.lit(1.001)), columns.frame_ticks(F.lit(2))) == (3602.5, None, 24, 21_189_168_000)
    assert one(spark, columns.usable_day(F.lit("2024-02-31")), columns.usable_day(F.lit("2024-00-10")), columns.usable_day(F.lit(None).cast("string")), columns.colon_day(F.lit("2024:05:06 x"))) == (True, False, False, "2024-05-06")
    got = one(spark, columns.location(F.lit("+37.33-122.03+10/")), columns.location(F.lit("nowhere")))
    assert (got[0].lat, got[0].lon, got[0].alt, got[1]) == (37.33, -122.03, 10.0, None)
    assert one(spark, columns.overlap(F.lit(0.0), F.lit(5.0), F.lit(3.0), F.lit(9.0)), columns.overlap(F.lit(0.0), F.lit(1.0), F.lit(3.0), F.lit(None).cast("double"))) == (2.0, None)


def test_float_vector_equals_numpy(spark):
    rng = np.random.default_rng(1)
    rows = [rng.normal(size=8), np.array([0, -0.0, 1e-40, 3.4e38, -1.5, 2**-126, 0.1, 7]), np.array([np.nan, np.inf, 1, 1, 1, 1, 1, 1])]
    df = spark.createDataFrame([(k, bytearray(v.astype("<f4").tobytes())) for k, v in enumerate(rows)] + [(9, bytearray(b"abc")), (10, None)], "k int, b binary")
    got = {r.k: r.v for r in df.select("k", columns.float_vector(F.col("b"), 8).alias("v")).collect()}
    for k in (0, 1):
        assert np.array_equal(np.array(got[k], "f4"), rows[k].astype("f4"))
    assert np.isnan(got[2][:2]).all() and got[9] is None and got[10] is None


def test_classifiers(spark):
    flags = classify.audio_flags(F.lit(-50.0), F.lit(-3.0), F.lit(0.0), F.lit(None).cast("double"), F.lit(0.5), F.lit(3.0))
    assert one(spark, *flags.values()) == (1, 0, 0, 0, 0)
    assert one(spark, classify.color_profile(F.lit("bt2020"), F.lit(None).cast("string")), classify.camera_id(F.lit("a1234.mov")), classify.asset_type(F.lit("/x/Time-Lapse/a.mov")), classify.asset_bucket(F.lit("/Stock/a"), ["stock"], F.lit(True))) == ("log_likely", "sony_a1xxx", "timelapse", "third_party")
    md = one(spark, classify.path_metadata(F.lit("2024-2-30_ridge/a.mov")), classify.path_metadata(F.lit("2024-2-3_ridge/a.mov")), classify.path_metadata(F.lit("12. Interviews/hut/a.mov")))
    assert [m.top_level for m in md] == ["other", "shoot_day", "category"] and (md[1].shoot_date, md[1].shoot_label, md[2].category_number, md[2].sub_location) == ("2024-02-03", "ridge", 12, "hut")
    assert one(spark, classify.speaker_confidence(F.lit(5.0), F.lit(80.0), F.lit(True))["level"], classify.speaker_confidence(F.lit(5.0), F.lit(5.0), F.lit(False))["level"]) == ("high", "low")


def test_generators(spark):
    got = one(spark, generators.sliding_windows(F.lit(100.0), 90.0, 45.0), generators.sliding_windows(F.lit(90.0), 90.0, 45.0), generators.sliding_windows(F.lit(0.0), 90.0, 45.0), generators.text_sample_times(F.lit(0.0), F.lit(130.0)), generators.audio_window_centres(F.lit(0.0), F.lit(60.0)), generators.fixed_parts(F.lit(7_000.0)))
    assert [(w.start, w.end) for w in got[0]] == [(0, 90), (45, 100)] and len(got[1]) == 1 and got[2] == []
    assert got[3] == [30.0, 32.5, 60.0, 65.0, 90.0, 97.5, 120.0] and got[4] == [30.0, 7.5, 52.5]
    assert [(w.start, w.end) for w in got[5]] == [(0, 3_000), (3_000, 6_000), (6_000, 7_000)]
    assert one(spark, *generators.ripple(F.lit(10), F.lit(-1), 5, 3), *generators.ripple(F.lit(1), F.lit(4), 5, 3)) == (13, -1, 1, 4)


def test_alignment_finds_the_offset():
    rng = np.random.default_rng(2)
    long = rng.integers(0, 2**32, 60)
    assert align(long[20:40], long) == (1.0, 20) and align(long, long[20:40]) == (1.0, -20)
    assert align(np.empty(0, int), long) == (0.0, 0)


def test_link_proposals(spark):
    rng = np.random.default_rng(3)
    print_ = rng.integers(0, 2**32, 40).tolist()
    noise = rng.integers(0, 2**32, 40).tolist()
    schema = "id string, label string, day string, camera string, fp array<long>"
    video = spark.createDataFrame([("v1", "ridge", "2024-01-02", "a_1", print_[2:30])], schema)
    audio = spark.createDataFrame([("a1", "ridge", "2024-01-02", "b_1", print_), ("a2", "ridge", "2024-01-02", "b_1", noise), ("a3", "lake", "2023-05-06", "c", print_)], schema)
    assert video.select(quick_probe(F.col("fp"), F.array(*map(F.lit, print_)))).first()[0] == 1.0
    got = propose_links(video, audio)
    rows = got.collect()
    assert [(r.video_id, r.audio_id, r.offset, r.rank) for r in rows] == [("v1", "a1", 2, 1)] and abs(rows[0].combined - 0.97) < 1e-9
    edges = spark.createDataFrame([("v1", "a1")], "src string, dst string")
    assert {tuple(r) for r in apply_links(got, edges).collect()} == {("v1", "a1"), ("a1", "v1")}
    assert video.select(fingerprint_match("fp", F.lit(None).cast("array<long>"))["similarity"]).first()[0] == 0.0


def test_paths_are_classified_in_order(spark):
    paths = {"/x/Podcasts/interview.mp3": "third_party", "/x/interview2.mov": "verite", "/x/Interviews/a.mov": "interview", "/x/history/a.mov": "archival", "/x/a podcast about.mov": "third_party", "/x/b roll/podcast/a.mov": "b_roll", "/x/news/a.mov": "third_party", "": "verite"}
    assert one(spark, *(classify.asset_type(F.lit(p)) for p in paths)) == tuple(paths.values())
    reasons = {"a/DJI_01_20240101_101010.wav": "DJI Mic 2 wireless lavalier", "x/A001.RDC/b.wav": "RED .RDC bundle XLR-input audio", "TentacleTrack1.wav": "Tentacle Track production bag recorder", "ZOOM0001.wav": "Zoom handheld recorder", "x/Audio/C0001.wav": "Sony PCM handheld recorder in Audio/ folder", "x/audio/b.wav": "production audio folder (unrecognized recorder)", "x/C0001.wav": "no production-audio signal in path", "": "no path"}
    assert tuple(r["reason"] for r in one(spark, *(classify.recorder_role(F.lit(p)) for p in reasons))) == tuple(reasons.values())


def test_factors_of_relevance(spark):
    rank = lambda text, start, end, total, **kw: media.relevance_rank(F.lit(1.0), F.lit(start), F.lit(end), F.lit(total), F.lit(text), **kw)
    got = one(spark, rank("x", 1_000.0, 1_100.0, 5_000.0), rank("The Ridge record", 1_000.0, 1_100.0, 5_000.0, topic="ridge", companions=("record",)), rank("the storm", 100.0, 110.0, 5_000.0, strong=("storm",)), rank("welcome, use code X at a.com, 10% off", 10.0, 20.0, None), rank("x", 900.0, 1_000.0, 1_000.0))
    want = (0.58 * 10, 0.88 * 10, 0.72 * 30**0.5, 0.58 * 0.72 * 0.6 * 0.38 * 30**0.5, 0.58 * 0.42 * 10)
    assert all(abs(a - b) < 1e-9 for a, b in zip(got, want, strict=True))
