import numpy as np
from pyspark.sql import functions as F

from fieldreel.functions import media
from fieldreel.operators import links, speakers, timeline


def one(spark, *cols):
    return tuple(spark.range(1).select(*(c.alias(f"c{k}") for k, c in enumerate(cols))).first())


def test_media(spark):
    wave = [float(x) for x in np.sin(np.arange(800) * 2 * np.pi * 20 / 800) * 0.5]
    m = one(spark, media.sound_metrics(F.array(*map(F.lit, wave)), F.lit(800)), media.sound_metrics(F.array().cast("array<double>"), F.lit(800)))
    assert m[1] is None and abs(m[0].rms_dbfs + 9.03) < 0.01 and abs(m[0].peak_dbfs + 6.02) < 0.01 and m[0].low_freq_ratio > 0.99 and m[0].clipping_ratio == 0
    f = one(spark, media.frame_metrics(F.array(*(F.lit(float(x)) for x in [10] * 16)), F.lit(4)))[0]
    assert (f.sharpness, f.exposure_mean, f.clipping_ratio) == (0.0, 10.0, 0.0)
    d = one(spark, media.primary_date(F.lit("2024-02-31"), F.lit("2023:01:02 03:04"), F.lit(False)), media.primary_date(F.lit("0000-01-01"), F.lit("2023:01:02"), F.lit(False)), media.primary_date(F.lit("2024-01-01"), F.lit("2023:01:02"), F.lit(True)), media.primary_date(F.lit(None).cast("string"), F.lit("x"), F.lit(True)))
    assert [x and (x.date, x.source) for x in d] == [("2024-02-31", "folder"), ("2023-01-02", "camera"), ("2023-01-02", "camera"), None]
    assert one(spark, media.scale_percent(F.lit(960.0), F.lit(1080.0), 1920.0, 1080.0), media.scale_percent(F.lit(960.0), F.lit(1080.0), 1920.0, 1080.0, fill=True)) == (100.0, 200.0)
    w = one(spark, media.avoid_windows(F.lit("Nice at 5-9s. Avoid 0:12-0:18 (and 1-2s) please."), F.lit("note")), media.avoid_windows(F.lit("3 to 4"), F.lit("avoid")), media.avoid_windows(F.lit(None).cast("string"), F.lit("avoid")))
    assert [[(x.start, x.end) for x in v] for v in w] == [[(12.0, 18.0)], [(3.0, 4.0)], []]
    g = one(spark, media.glossary(F.lit("Foo bar, foobar FOO"), {"foo": "X$1", "foo bar": "Y"}))[0]
    assert (g.text, g.hits) == ("Y, foobar X$1", 3)
    assert one(spark, media.excerpt(F.lit("abcdef"), 4), media.name_tokens(F.lit("C:\\a\\Ridge-0812_x.WAV"))) == ("abc…", ["ridge", "0812"])


def test_speakers(spark):
    windows = spark.createDataFrame([(1, "a", 0.0, 10.0), (2, "a", 50.0, 60.0)], "id int, asset_id string, start double, end double")
    seg = spark.createDataFrame([("a", 0.0, 4.0, "y"), ("a", 4.0, 8.0, "x"), ("a", 9.0, 9.5, None)], "asset_id string, s double, e double, speaker string")
    assert [tuple(r) for r in speakers.majority_speaker(windows, seg).collect()] == [(1, "x", 4.0)]
    human = spark.createDataFrame([("a", 0.0, 40.0, ["p", "q"]), ("a", 40.0, 70.0, ["p"])], "asset_id string, start double, end double, persons array<string>")
    machine = spark.createDataFrame([("a", 0.0, 70.0, "c")], "asset_id string, s double, e double, cluster string")
    votes = speakers.split_votes(human, machine, "persons", F.transform("persons", lambda p: F.lit(0.0)))
    assert {r.p_id: r.seconds for r in votes.collect()} == {"p": 50.0, "q": 20.0}
    assert [(r.cluster, r.p_id) for r in speakers.map_clusters(votes, one_each=True).collect()] == [("c", "p")]
    receiver = spark.createDataFrame([(1, 1, 10.0, 14.0, "we saw the storm"), (1, 2, 20.0, 24.0, "nothing else here")], "pair int, r_id int, start double, end double, text string")
    donor = spark.createDataFrame([(1, 2.0, 6.0, "we saw the storm", "p"), (1, 12.0, 16.0, "nothing else here", "q")], "pair int, s double, e double, said string, p_id string")
    offsets = speakers.time_offsets(receiver, donor)
    assert [tuple(r) for r in offsets.collect()] == [(1, 8)]
    assert {(r.r_id, r.p_id) for r in speakers.propagate(receiver, donor, offsets).collect()} == {(1, "p"), (2, "q")}


def test_clips(spark):
    clips = spark.createDataFrame([(1, "a", 0.0, 10.0), (2, "a", 100.0, 110.0), (3, "b", 0.0, 1.0)], "id int, asset_id string, start double, end double")
    chunks = spark.createDataFrame([("a", "c1", 0.0, 4.0), ("a", "c2", 4.0, 60.0)], "asset_id string, chunk_id string, s double, e double")
    assert {tuple(r) for r in timeline.best_chunk(clips, chunks).collect()} == {(1, "c2", "overlap"), (2, "c2", "nearest")}
    rows = spark.createDataFrame([("s", "k1", "V1", 7, []), ("s", "k2", "A1", -1, ["zz", "k1"]), ("s", "k3", "A2", -1, [])], "sequence string, clip_id string, track string, start int, links array<string>")
    assert {r.clip_id: r.start_resolved for r in timeline.resolve_starts(rows).collect()} == {"k1": 7, "k2": 7, "k3": None}
    words = spark.createDataFrame([("a", 1.0, 2.0, "w")], "asset_id string, s double, e double, word string")
    cuts = spark.createDataFrame([(1, "a", 1.5), (2, "a", 1.1), (3, "a", 2.0)], "id int, asset_id string, at double")
    assert [r.id for r in timeline.cuts_inside_words(cuts, words).collect()] == [1]
    spoken = timeline.speech_seconds(clips, spark.createDataFrame([("a", 2.0, 5.0, "p"), ("a", 5.0, 6.0, None)], "asset_id string, s double, e double, p_id string"))
    assert {(r.id, r.p_id, r.seconds) for r in spoken.collect()} == {(1, "p", 3.0), (1, None, 1.0)}
    assert {(r.p_id, r.share, r.dominant) for r in timeline.shares(spoken, "id", "p_id", "seconds").collect()} == {("p", 1.0, True)}


def test_links(spark):
    schema = "id string, path string, day string, duration double, text string"
    audio = links.spoken(spark.createDataFrame([("a1", "/d/x/ridge0812_mix.wav", "1", 10.0, "they watched storm clouds build"), ("a2", "/d/y.wav", "1", 9.0, "the")], schema), "text")
    video = links.spoken(spark.createDataFrame([("v1", "/d/ridge0812.mov", "1", 10.0, "they watched storm clouds build"), ("v2", "/d/lake.mov", "1", 5.0, "completely other words")], schema), "text")
    scored = links.score_pairs(audio, video, ["day"])
    got = links.primary_links(scored, spark.createDataFrame([("a1", "v9")], "audio_id string, primary_id string")).collect()
    assert [(r.audio_id, r.video_id, r.action) for r in got] == [("a1", "v1", "kept_other")] and got[0].score > 0.99
    assert [(r.audio_id, r.video_id, r.passed) for r in links.folder_links(audio, video).collect()] == [("a1", "v1", True)]
    edges = spark.createDataFrame([("a", "b", "primary")], "src string, dst string, kind string")
    new = spark.createDataFrame([("a", "c", "primary")], "src string, dst string, kind string")
    assert {tuple(r) for r in links.set_primary(edges, new).collect()} == {("a", "c", "primary")}
    assert links.add_edges(edges, new, both_ways=True).count() == 3
    assert links.strict_and_relaxed(scored, scored).count() == 1
