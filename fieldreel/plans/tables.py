"""Queries of the core operators over the given tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldreel.functions import classify, columns, generators
from fieldreel.operators import entities, graph, islands, joins, links, ranking, search, similarity
from fieldreel.operators.intervals import whole_ms
from fieldreel.operators.timestamps import DAY_US, to_utc
from fieldreel.plans import quality
from fieldreel.session import read
from fieldreel.sources import files
from fieldreel.streaming import windows

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def _query(name: str, sql: str | None, *tables: str) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
    """Register a function of DataFrames as a query over the named tables."""

    def register(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        _QUERIES[name] = lambda spark, sf_dir: f(*(read(spark, sf_dir, t) for t in tables))
        if sql:
            _SQL[name] = sql
        return f

    return register


# --- scans and sinks


@_query("s10_blob_lengths", "SELECT vector_dim, count(*) AS n, count(*) FILTER (octet_length(vector_blob) = 256) AS n_good FROM clip_embeddings GROUP BY 1", "clip_embeddings")
def s10(e):
    good = columns.float_vector(F.col("vector_blob"), 64).isNotNull().cast("int")
    return e.groupBy("vector_dim").agg(F.count("*").alias("n"), F.sum(good).alias("n_good"))


@_query("s13_union_sources", "SELECT 'document' AS kind, CAST(doc_id AS VARCHAR) AS id, text, lang FROM documents UNION ALL SELECT 'segment', asset_id || '/' || seg_idx, text, NULL FROM segment", "documents", "segment")
def s13(d, s):
    return files.union_sources({"document": d.select(F.col("doc_id").cast("string").alias("id"), "text", "lang"), "segment": s.select(F.concat_ws("/", "asset_id", "seg_idx").alias("id"), "text")}).select("kind", "id", "text", "lang")


@_query("s14_last_event_of_user", "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1", "events")
def s14(e):
    return files.upsert(e, ["user_id"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_id", "event_type", "value")


@_query("s15_first_event_of_user_and_type", "SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1", "events")
def s15(e):
    return files.insert_ignore(e, ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "event_id")


@_query("s18_media_stats", "SELECT record_kind, count(*) AS n, round(coalesce(sum(duration_sec), 0) / 3600, 2) AS hours, round(coalesce(sum(filesize_bytes), 0) / 1073741824.0, 2) AS gigabytes FROM asset GROUP BY 1", "asset")
def s18(a):
    return quality.media_stats(a)


@_query("s20_null_out", "SELECT chunk_id, parent_asset_id, CAST(NULL AS VARCHAR) AS response_raw FROM semantic_chunks", "semantic_chunks")
def s20(c):
    return files.null_out(c, ["response_raw"]).select("chunk_id", "parent_asset_id", "response_raw")


# --- projections


@_query("proj_people_bridge", "SELECT DISTINCT asset_id, unnest(from_json(people_ids_json, '[\"VARCHAR\"]')) AS p_id FROM asset WHERE people_ids_json IS NOT NULL", "asset")
def proj_bridge(a):
    return a.select("asset_id", F.explode(F.from_json("people_ids_json", "array<string>")).alias("p_id")).distinct()


@_query(
    "proj_presence_flags",
    "SELECT DISTINCT a.asset_id, CAST(a.asset_id IN (SELECT asset_id FROM segment WHERE asset_id IS NOT NULL) AS INTEGER) AS has_segments, CAST(a.asset_id IN (SELECT parent_asset_id FROM semantic_chunks WHERE parent_asset_id IS NOT NULL) AS INTEGER) AS has_chunks FROM asset a",
    "asset", "segment", "semantic_chunks",
)
def proj_flags(a, s, c):
    of = lambda df, k, n: df.select(F.col(k).alias("asset_id")).distinct().withColumn(n, F.lit(1))
    return a.select("asset_id").distinct().join(of(s, "asset_id", "has_segments"), "asset_id", "left").join(of(c, "parent_asset_id", "has_chunks"), "asset_id", "left").fillna(0)


@_query(
    "proj_audio_flags",
    """WITH m AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, -l_quantity * 1.2 AS rms, -l_tax * 30 AS peak, l_discount / 40 AS clip, l_quantity / 52 AS sil, l_discount * 6 AS low, l_tax * 40 AS dur FROM lineitem),
    f AS (SELECT *, rms < -45 OR sil > 0.9 AS silent, clip > 0.001 OR peak > -1 AS clippy FROM m)
    SELECT CAST(silent AS INTEGER) AS is_silent, CAST(NOT silent AND rms < -30 AS INTEGER) AS is_quiet, CAST(clippy AS INTEGER) AS is_clippy, CAST(low > 0.4 AND NOT silent AS INTEGER) AS is_windy, CAST(NOT silent AND NOT clippy AND dur >= 1 AS INTEGER) AS is_usable, count(*) AS n FROM f GROUP BY ALL""",
    "lineitem",
)
def proj_audio(li):
    flags = classify.audio_flags(-F.col("l_quantity") * 1.2, -F.col("l_tax") * 30, F.col("l_discount") / 40, F.col("l_quantity") / 52, F.col("l_discount") * 6, F.col("l_tax") * 40)
    return li.select(*(c.alias(n) for n, c in flags.items())).groupBy(*flags).agg(F.count("*").alias("n"))


@_query(
    "proj_shot_flags",
    """WITH e AS (SELECT *, l_linenumber = min(l_linenumber) OVER w OR l_linenumber = max(l_linenumber) OVER w AS edge FROM lineitem WINDOW w AS (PARTITION BY l_orderkey))
    SELECT CAST(l_extendedprice / 100 < 100 AS INTEGER) AS is_blurry, CAST(l_quantity * 5 < 30 AS INTEGER) AS is_dark, CAST(l_quantity * 5 > 225 OR l_discount > 0.05 AS INTEGER) AS is_blown, CAST(l_extendedprice / 100 >= 100 AS INTEGER) AS is_in_focus, CAST(edge AND l_quantity <= 5 AS INTEGER) AS is_setup_or_teardown, count(*) AS n FROM e GROUP BY ALL""",
    "lineitem",
)
def proj_shot(li):
    w = Window.partitionBy("l_orderkey")
    edge = (F.col("l_linenumber") == F.min("l_linenumber").over(w)) | (F.col("l_linenumber") == F.max("l_linenumber").over(w))
    flags = classify.shot_flags(F.col("l_extendedprice") / 100, F.col("l_quantity") * 5, F.col("l_discount"), F.col("l_quantity"), F.col("edge"))
    return li.withColumn("edge", edge).select(*(c.alias(n) for n, c in flags.items())).groupBy(*flags).agg(F.count("*").alias("n"))


@_query(
    "proj_camera_and_type",
    r"""SELECT DISTINCT asset_id, CASE WHEN b LIKE 'IMG\_%' ESCAPE '\' THEN 'iphone' WHEN b LIKE 'DJI\_%' ESCAPE '\' THEN 'dji' WHEN regexp_matches(b, '^G[XHP]') THEN 'gopro' WHEN regexp_matches(b, '^[A-Z]\d{4}') THEN 'sony_' || lower(b[1]) || b[2] || 'xxx' WHEN b LIKE '%.R3D' THEN 'red' ELSE 'unknown' END AS camera,
    CASE WHEN regexp_matches(p, 'hearing|trial[ _-]audio|courtroom') THEN 'court_recordings' WHEN contains(p, 'b-roll') OR contains(p, 'b roll') OR contains(p, 'stock vids') OR regexp_matches(p, '(^|[\\/_.-])broll([\\/_.-]|$)') THEN 'b_roll' WHEN len(list_intersect(regexp_split_to_array(p, '[\\/]'), ['podcast', 'podcasts', 'adobe podcast'])) > 0 THEN 'third_party' WHEN regexp_matches(p, '\binterviews?\b') OR contains(p, ' int ') THEN 'interview' WHEN contains(p, 'timelapse') OR contains(p, 'time-lapse') OR contains(p, 'time lapse') THEN 'timelapse' WHEN contains(p, 'archival') OR regexp_matches(p, '\bhistory\b') THEN 'archival' WHEN regexp_matches(p, '\bpodcasts?\b|(^|[\\/_. -])news($|[\\/_. -])') THEN 'third_party' ELSE 'verite' END AS kind
    FROM (SELECT asset_id, upper(coalesce(filename, '')) AS b, lower(coalesce(source_path, '')) AS p FROM asset)""",
    "asset",
)
def proj_camera(a):
    return a.select("asset_id", classify.camera_id(F.col("filename")).alias("camera"), classify.asset_type(F.col("source_path")).alias("kind")).distinct()


@_query("proj_duration_bands", "SELECT CASE WHEN duration_sec >= 1800 AND (l LIKE '%interview%' OR l LIKE '% int%') THEN 'interview_long' WHEN duration_sec >= 1800 AND l LIKE '%call%' THEN 'call_short' WHEN duration_sec >= 1800 THEN 'verite' WHEN duration_sec >= 600 AND (l LIKE '%interview%' OR l LIKE '% int%') THEN 'interview_mid' WHEN duration_sec >= 600 AND l LIKE '%call%' THEN 'call_short' ELSE 'verite' END AS band, count(*) AS n FROM (SELECT duration_sec, lower(coalesce(shoot_label, '')) AS l FROM asset) GROUP BY 1", "asset")
def proj_band(a):
    return a.groupBy(classify.duration_bucket(F.col("duration_sec"), F.col("shoot_label")).alias("band")).agg(F.count("*").alias("n"))


@_query("proj_frames", "SELECT seg_idx, asset_id, CAST(round_even(start_sec * 24000 / 1001, 0) AS BIGINT) AS frame, CAST(round_even(start_sec * 24000 / 1001, 0) AS BIGINT) * 10594584000 AS ticks FROM segment WHERE start_sec IS NOT NULL", "segment")
def proj_frames(s):
    frame = columns.seconds_frame(F.col("start_sec"))
    return s.where("start_sec IS NOT NULL").select("seg_idx", "asset_id", frame.alias("frame"), columns.frame_ticks(frame).alias("ticks"))


@_query(
    "proj_recorder_role",
    r"""SELECT DISTINCT asset_id, CASE WHEN p <> '' AND regexp_matches(p, 'DJI_\d+_\d{8}_\d{6}\.WAV$|\.RDC[/\\][^/\\]+\.wav$|Tentacle\s*Track|ZOOM\d+|[/\\]audio[/\\]', 'i') THEN 'audio_source' ELSE 'audio_overlap' END AS role,
    CASE WHEN p = '' THEN 'no path' WHEN regexp_matches(p, 'DJI_\d+_\d{8}_\d{6}\.WAV$', 'i') THEN 'DJI Mic 2 wireless lavalier' WHEN regexp_matches(p, '\.RDC[/\\][^/\\]+\.wav$', 'i') THEN 'RED .RDC bundle XLR-input audio' WHEN regexp_matches(p, 'Tentacle\s*Track', 'i') THEN 'Tentacle Track production bag recorder' WHEN regexp_matches(p, 'ZOOM\d+', 'i') THEN 'Zoom handheld recorder'
      WHEN regexp_matches(p, 'C\d{4}[^/\\]*\.(wav|mp3)$', 'i') AND regexp_matches(p, '[/\\]audio[/\\]', 'i') THEN 'Sony PCM handheld recorder in Audio/ folder' WHEN regexp_matches(p, '[/\\]audio[/\\]', 'i') THEN 'production audio folder (unrecognized recorder)' ELSE 'no production-audio signal in path' END AS reason
    FROM (SELECT asset_id, coalesce(source_path, '') AS p FROM asset)""",
    "asset",
)
def proj_role(a):
    return a.select("asset_id", F.inline(F.array(classify.recorder_role(F.col("source_path"))))).distinct()


@_query("proj_changed_rows", "SELECT count(*) AS n, count(*) FILTER (a.primary_timeline_date IS DISTINCT FROM a.shoot_date) AS changed FROM asset a", "asset")
def proj_changed(a):
    return a.agg(F.count("*").alias("n"), F.sum((~F.col("primary_timeline_date").eqNullSafe(F.col("shoot_date"))).cast("int")).alias("changed"))


# --- filters


@_query("f1_allowlist", "SELECT DISTINCT asset_id FROM asset WHERE record_kind = 'video' AND lower(bucket) = 'selects' AND lower(asset_type) = 'camera_original' AND shoot_date >= '2022' AND shoot_date <= '2025'", "asset")
def f1(a):
    from fieldreel.plans.composers import asset_allowlist

    return asset_allowlist({"asset": a}, bucket="Selects", asset_type="CAMERA_ORIGINAL", date_from="2022", date_to="2025")


@_query("f4_substring", "SELECT doc_id FROM documents WHERE text ILIKE '%storm build%'", "documents")
def f4(d):
    return d.where(columns.like(F.col("text"), "storm build")).select("doc_id")


@_query("f6_null_as_zero", "SELECT coalesce(human_transcript, 0) AS flag, count(*) AS n FROM asset GROUP BY 1", "asset")
def f6(a):
    return a.groupBy(F.coalesce("human_transcript", F.lit(0)).alias("flag")).agg(F.count("*").alias("n"))


@_query("f9_readable_text", r"SELECT DISTINCT asset_id, seg_idx FROM segment WHERE length(regexp_replace(text, '[^\p{L}\p{N}]', '', 'g')) >= 3 AND NOT regexp_matches(text, '[\x{0400}-\x{052F}]')", "segment")
def f9(s):
    return s.where(columns.readable_text(F.col("text"))).select("asset_id", "seg_idx").distinct()


@_query("f11_noise", r"WITH t AS (SELECT DISTINCT asset_id, seg_idx, regexp_replace(text, '[^A-Za-z]', '', 'g') AS l, regexp_replace(text, '\s', '', 'g') AS b FROM segment) SELECT asset_id, seg_idx, CASE WHEN length(l) >= 5 AND NOT regexp_matches(l, '[aeiouy]', 'i') THEN 'no_vowel' WHEN length(b) > 0 AND length(regexp_replace(b, '[\p{L}\p{N}]', '', 'g')) * 2 > length(b) THEN 'signs' END AS reason FROM t WHERE reason IS NOT NULL", "segment")
def f11(s):
    return s.select("asset_id", "seg_idx", columns.noise_reason(F.col("text")).alias("reason")).where("reason IS NOT NULL").distinct()


@_query("f18_id_prefix", "SELECT DISTINCT asset_id FROM asset WHERE starts_with(asset_id, 'ab')", "asset")
def f18(a):
    return a.where(F.col("asset_id").startswith("ab")).select("asset_id").distinct()


# --- joins


@_query(
    "j1_j2_j3_top_orders",
    "SELECT o_orderkey, o_totalprice, n_lines, best FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, max(l_extendedprice) AS best FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE o_orderpriority = '1-URGENT' AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) ORDER BY o_totalprice DESC, o_orderkey LIMIT 30",
    "orders", "customer", "lineitem", "nation",
)
def j123(o, c, li, n):
    lines = li.groupBy("l_orderkey").agg(F.count("*").alias("n_lines"), F.max("l_extendedprice").alias("best"))
    near = c.join(n.where("n_regionkey = 1"), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    df = o.where("o_orderpriority = '1-URGENT'").join(near, F.col("o_custkey") == F.col("c_custkey")).join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return df.select("o_orderkey", "o_totalprice", "n_lines", "best").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(30)


@_query("j5_all_of_set", "SELECT user_id FROM events WHERE event_type IN (SELECT event_type FROM (SELECT DISTINCT event_type FROM events)) GROUP BY user_id HAVING count(DISTINCT event_type) = (SELECT count(DISTINCT event_type) FROM events)", "events")
def j5(e):
    every = e.agg(F.countDistinct("event_type").alias("k"))
    return e.groupBy("user_id").agg(F.countDistinct("event_type").alias("n")).join(every, F.col("n") == F.col("k"), "left_semi").select("user_id")


@_query("j6_no_returned_line", "SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')", "orders", "lineitem")
def j6(o, li):
    return o.join(li.where("l_returnflag = 'R'"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey")


@_query("j7_single_nation_customers", "SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1 HAVING count(DISTINCT s_nationkey) = 1", "orders", "lineitem", "supplier")
def j7(o, li, s):
    df = li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    return df.groupBy("o_custkey").agg(F.countDistinct("s_nationkey").alias("n")).where("n = 1").select("o_custkey")


@_query("j8_orphans", "SELECT DISTINCT asset_id FROM segment WHERE asset_id IS NOT NULL AND asset_id NOT IN (SELECT asset_id FROM asset WHERE asset_id IS NOT NULL)", "segment", "asset")
def j8(s, a):
    return s.where("asset_id IS NOT NULL").join(a, "asset_id", "left_anti").select("asset_id").distinct()


@_query(
    "j10_events_around_purchases",
    "SELECT p.event_id AS purchase_id, count(*) AS n FROM events p JOIN events e ON e.user_id = p.user_id AND e.ts BETWEEN p.ts - INTERVAL 60 SECOND AND p.ts + INTERVAL 60 SECOND WHERE p.event_type = 'purchase' GROUP BY 1",
    "events",
)
def j10(e):
    sec = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6
    left = e.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase_id"), sec.alias("a"), sec.alias("b"))
    right = e.select("user_id", sec.alias("c"), sec.alias("d"))
    return joins.interval_join(left, right, "user_id", ("a", "b"), ("c", "d"), width=3_600.0, tolerance=60.0).groupBy("purchase_id").agg(F.count("*").alias("n"))


@_query(
    "j11_windows_over_speech",
    "WITH w AS (SELECT DISTINCT event_pk, asset_id, window_start_sec AS a, window_end_sec AS b FROM audio_event WHERE window_start_sec <= window_end_sec), s AS (SELECT DISTINCT asset_id, seg_idx, start_sec AS c, end_sec AS d FROM segment WHERE start_sec <= end_sec) SELECT event_pk, count(*) AS n FROM w JOIN s USING (asset_id) WHERE a <= d AND b >= c GROUP BY 1",
    "audio_event", "segment",
)
def j11(e, s):
    w = e.select("event_pk", "asset_id", F.col("window_start_sec").alias("a"), F.col("window_end_sec").alias("b")).distinct()
    t = s.select("asset_id", "seg_idx", F.col("start_sec").alias("c"), F.col("end_sec").alias("d")).distinct()
    return joins.interval_join(w, t, "asset_id", ("a", "b"), ("c", "d"), width=60.0).groupBy("event_pk").agg(F.count("*").alias("n"))


@_query(
    "j13_segment_at_keyframe",
    "WITH k AS (SELECT DISTINCT embedding_pk, parent_asset_id AS asset_id, timestamp_sec AS t FROM clip_embeddings JOIN semantic_chunks USING (chunk_id) WHERE timestamp_sec IS NOT NULL), s AS (SELECT DISTINCT asset_id, seg_idx, start_sec AS c, end_sec AS d FROM segment WHERE start_sec <= end_sec) SELECT embedding_pk, min(seg_idx) AS seg_idx FROM k JOIN s USING (asset_id) WHERE t BETWEEN c AND d GROUP BY 1",
    "clip_embeddings", "semantic_chunks", "segment",
)
def j13(k, c, s):
    at = k.join(c.select("chunk_id", F.col("parent_asset_id").alias("asset_id")).distinct(), "chunk_id").select("embedding_pk", "asset_id", F.col("timestamp_sec").alias("t"), F.col("timestamp_sec").alias("u")).distinct()
    spans = s.select("asset_id", "seg_idx", F.col("start_sec").alias("c"), F.col("end_sec").alias("d")).distinct()
    return joins.interval_join(at, spans, "asset_id", ("t", "u"), ("c", "d"), width=60.0).groupBy("embedding_pk").agg(F.min("seg_idx").alias("seg_idx"))


@_query(
    "j14_tag_vote",
    "WITH w AS (SELECT DISTINCT event_pk, asset_id, tag, window_start_sec AS a, window_end_sec AS b FROM audio_event WHERE window_start_sec <= window_end_sec AND asset_id IS NOT NULL), s AS (SELECT DISTINCT asset_id, seg_idx, speaker_p_id, start_sec AS c, end_sec AS d FROM segment WHERE start_sec <= end_sec) SELECT asset_id, tag, speaker_p_id, round(sum(least(b, d) - greatest(a, c)), 3) AS seconds FROM w JOIN s USING (asset_id) WHERE a < d AND b > c GROUP BY ALL",
    "audio_event", "segment",
)
def j14(e, s):
    w = e.select("event_pk", "asset_id", "tag", F.col("window_start_sec").alias("a"), F.col("window_end_sec").alias("b")).distinct()
    t = s.select("asset_id", "seg_idx", "speaker_p_id", F.col("start_sec").alias("c"), F.col("end_sec").alias("d")).distinct()
    return joins.overlap_vote(w, t, "asset_id", ("a", "b"), ("c", "d"), "tag", "speaker_p_id", width=60.0).withColumn("seconds", F.round("seconds", 3))


@_query(
    "j18_nearest_keyframe",
    """WITH k AS (SELECT parent_asset_id AS asset_id, timestamp_sec AS m, min(embedding_pk) AS pk FROM clip_embeddings JOIN (SELECT DISTINCT chunk_id, parent_asset_id FROM semantic_chunks) USING (chunk_id) WHERE timestamp_sec IS NOT NULL AND parent_asset_id IS NOT NULL GROUP BY ALL),
    c AS (SELECT DISTINCT chunk_id, parent_asset_id AS asset_id, chunk_end_sec AS t FROM semantic_chunks WHERE chunk_end_sec IS NOT NULL AND parent_asset_id IS NOT NULL),
    p AS (SELECT c.*, b.m AS bm, b.pk AS bk FROM c ASOF LEFT JOIN k b ON c.asset_id = b.asset_id AND c.t >= b.m),
    q AS (SELECT p.*, a.m AS am, a.pk AS ak FROM p ASOF LEFT JOIN k a ON p.asset_id = a.asset_id AND p.t <= a.m)
    SELECT chunk_id, CASE WHEN am IS NULL OR t - bm < am - t OR t = bm THEN coalesce(bk, ak) ELSE ak END AS nearest_pk FROM q""",
    "clip_embeddings", "semantic_chunks",
)
def j18(k, c):
    owner = c.select("chunk_id", F.col("parent_asset_id").alias("asset_id")).distinct()
    frames = k.join(owner, "chunk_id").select("asset_id", F.col("timestamp_sec").alias("m"), "embedding_pk")
    ends = c.select("chunk_id", F.col("parent_asset_id").alias("asset_id"), F.col("chunk_end_sec").alias("t")).where("t IS NOT NULL AND asset_id IS NOT NULL").distinct()
    return joins.nearest(ends, frames, "asset_id", "t", "chunk_id", "m", id="embedding_pk", width=300.0).select("chunk_id", F.col("nearest.id").alias("nearest_pk"))


@_query("j20_next_segment", "SELECT asset_id, seg_idx, lead(seg_idx) OVER (PARTITION BY asset_id ORDER BY start_sec, seg_idx) AS next_idx FROM (SELECT DISTINCT asset_id, seg_idx, start_sec FROM segment WHERE start_sec IS NOT NULL)", "segment")
def j20(s):
    rows = s.select("asset_id", "seg_idx", "start_sec").where("start_sec IS NOT NULL").distinct()
    return rows.select("asset_id", "seg_idx", F.lead("seg_idx").over(Window.partitionBy("asset_id").orderBy("start_sec", "seg_idx")).alias("next_idx"))


@_query(
    "j21_seconds_shared",
    "WITH s AS (SELECT DISTINCT asset_id, seg_idx, unnest(generate_series(CAST(trunc(start_sec) AS BIGINT), CAST(trunc(end_sec) AS BIGINT))) AS x FROM segment WHERE start_sec <= end_sec), e AS (SELECT asset_id, x, min(event_pk) AS pk FROM (SELECT asset_id, event_pk, unnest(generate_series(CAST(trunc(window_start_sec) AS BIGINT), CAST(trunc(window_end_sec) AS BIGINT))) AS x FROM audio_event WHERE window_start_sec <= window_end_sec) GROUP BY ALL) SELECT asset_id, seg_idx, arg_min(pk, x) AS event_pk FROM s JOIN e USING (asset_id, x) GROUP BY ALL",
    "segment", "audio_event",
)
def j21(s, e):
    spoken = joins.covered_seconds(s.select("asset_id", "seg_idx", "start_sec", "end_sec").distinct(), "start_sec", "end_sec")
    heard = joins.covered_seconds(e.select("asset_id", "event_pk", "window_start_sec", "window_end_sec"), "window_start_sec", "window_end_sec").groupBy("asset_id", "second").agg(F.min("event_pk").alias("pk"))
    return spoken.join(heard, ["asset_id", "second"]).groupBy("asset_id", "seg_idx").agg(F.min_by("pk", "second").alias("event_pk"))


@_query("j29_sorted_neighbours", "WITH n AS (SELECT p_partkey AS i, p_name AS v, row_number() OVER (PARTITION BY p_name[1] ORDER BY p_name, p_partkey) AS n FROM part WHERE p_name <> '') SELECT a.i AS a, b.i AS b FROM n a JOIN n b ON a.v[1] = b.v[1] AND b.n > a.n AND b.n <= a.n + 5", "part")
def j29(p):
    return joins.sorted_neighbours(p, "p_name", "p_partkey", 5).select("a", "b")


@_query("j32_ancestors", "WITH t AS (SELECT DISTINCT id, parent_id FROM places WHERE id IS NOT NULL), u AS (SELECT id, min(parent_id) AS p FROM t GROUP BY 1), a AS (SELECT id, p AS ancestor FROM u WHERE p IN (SELECT id FROM u) AND p <> id), b AS (SELECT a.id, u.p AS ancestor, a.ancestor AS via FROM a JOIN u ON u.id = a.ancestor WHERE u.p IN (SELECT id FROM u) AND u.p <> a.id AND u.p <> a.ancestor) SELECT id, ancestor, 1 AS level FROM a UNION ALL SELECT id, ancestor, 2 FROM b", "places")
def j32(p):
    return graph.ancestors(p, "id", "parent_id", 2)


@_query("j35_full_outer", "SELECT state, count(*) AS n FROM (SELECT CASE WHEN b.o IS NULL THEN 'only_here' WHEN a.o IS NULL THEN 'only_there' WHEN a.s = b.s AND a.m = b.m THEN 'same' WHEN a.m > b.m THEN 'newer_here' WHEN a.m < b.m THEN 'newer_there' ELSE 'conflict' END AS state FROM (SELECT l_orderkey AS o, count(*) AS s, max(l_shipdate) AS m FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1) a FULL JOIN (SELECT l_orderkey AS o, count(*) AS s, max(l_shipdate) AS m FROM lineitem WHERE l_linestatus <> 'O' GROUP BY 1) b ON a.o = b.o) GROUP BY 1", "lineitem")
def j35(li):
    listing = lambda c: li.where(c).groupBy("l_orderkey").agg(F.count("*").alias("s"), F.max("l_shipdate").alias("m"))
    return joins.compare_listings(listing("l_returnflag <> 'R'"), listing("l_linestatus <> 'O'"), "l_orderkey", "s", "m").groupBy("state").agg(F.count("*").alias("n"))


_LINKS = "SELECT DISTINCT lower(trim(video_asset_id, ' \t\n')) AS a, lower(trim(audio_asset_id, ' \t\n')) AS b FROM link_proposal WHERE video_asset_id IS NOT NULL AND audio_asset_id IS NOT NULL"


def _links(p: DataFrame) -> DataFrame:
    clean = lambda c: F.lower(F.btrim(F.col(c), F.lit(" \t\n")))
    return p.select(clean("video_asset_id").alias("a"), clean("audio_asset_id").alias("b")).dropna().distinct()


@_query("j36_symmetric_edges", f"WITH e AS ({_LINKS}) SELECT a AS src, b AS dst, EXISTS (SELECT 1 FROM e f WHERE f.a = e.b AND f.b = e.a) AS symmetric FROM e", "link_proposal")
def j36(p):
    return joins.symmetric_edges(_links(p), "a", "b")


@_query("j38_shared_tags", "WITH t AS (SELECT DISTINCT asset_id, tag FROM audio_event WHERE asset_id IS NOT NULL AND tag IS NOT NULL) SELECT a.tag AS tag_a, b.tag AS tag_b, count(*) AS n_assets FROM t a JOIN t b USING (asset_id) WHERE a.tag < b.tag GROUP BY ALL", "audio_event")
def j38(e):
    t = e.where("asset_id IS NOT NULL AND tag IS NOT NULL").select("asset_id", "tag").distinct()
    return t.withColumnRenamed("tag", "tag_a").join(t.withColumnRenamed("tag", "tag_b"), "asset_id").where("tag_a < tag_b").groupBy("tag_a", "tag_b").agg(F.count("*").alias("n_assets"))


@_query("j43_reference_audit", "WITH r AS (SELECT DISTINCT asset_id AS id, unnest(from_json(place_ids_json, '[\"VARCHAR\"]')) AS ref FROM asset), k AS (SELECT id AS ref FROM places) SELECT 'missing' AS kind, id, ref FROM r WHERE ref IS NOT NULL AND ref NOT IN (SELECT ref FROM k) UNION ALL SELECT 'duplicate', NULL, ref FROM k GROUP BY ref HAVING count(*) > 1 UNION ALL SELECT DISTINCT 'invalid', NULL, ref FROM k WHERE NOT regexp_matches(ref, '^pl_[0-9a-f]+$')", "asset", "places")
def j43(a, p):
    refs = a.select("asset_id", F.from_json("place_ids_json", "array<string>").alias("refs"))
    return entities.reference_audit(refs, "asset_id", "refs", p.select("id"), "id", "^pl_[0-9a-f]+$")


# --- aggregations


@_query("a1_texts_per_source", "SELECT source, count(*) AS n, count(DISTINCT text) AS n_distinct, array_to_string(list_sort(list(DISTINCT lang)), ' | ') AS langs FROM documents GROUP BY 1", "documents")
def a1(d):
    return d.groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("text").alias("n_distinct"), F.array_join(F.array_sort(F.collect_set("lang")), " | ").alias("langs"))


@_query("a3_top_assets", "SELECT asset_id, count(*) AS n FROM segment WHERE asset_id IS NOT NULL GROUP BY 1 ORDER BY n DESC, asset_id LIMIT 20", "segment")
def a3(s):
    return s.where("asset_id IS NOT NULL").groupBy("asset_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "asset_id").limit(20)


@_query("a4_two_tags", "SELECT asset_id, count(DISTINCT CASE WHEN tag IN ('music', 'crowd') THEN tag END) AS k FROM audio_event WHERE asset_id IS NOT NULL GROUP BY 1 HAVING k = 2", "audio_event")
def a4(e):
    return e.where("asset_id IS NOT NULL").groupBy("asset_id").agg(F.countDistinct(F.when(F.col("tag").isin("music", "crowd"), F.col("tag"))).alias("k")).where("k = 2")


@_query("a5_screen_time", "SELECT user_id, count(DISTINCT (event_type, CAST(ts AS DATE))) * 7 / 60.0 AS minutes FROM events GROUP BY 1", "events")
def a5(e):
    return e.groupBy("user_id").agg((F.countDistinct("event_type", F.to_date("ts")) * 7 / 60.0).alias("minutes"))


@_query("a7_ordered_concat", "SELECT parent_asset_id, string_agg(lower(chunk_id), ',' ORDER BY chunk_idx, chunk_id) AS ids FROM (SELECT DISTINCT parent_asset_id, chunk_idx, chunk_id FROM semantic_chunks WHERE parent_asset_id IS NOT NULL) GROUP BY 1", "semantic_chunks")
def a7(c):
    rows = c.where("parent_asset_id IS NOT NULL").select("parent_asset_id", F.struct("chunk_idx", F.lower("chunk_id").alias("id")).alias("x")).distinct()
    return rows.groupBy("parent_asset_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["id"]), ",").alias("ids"))


@_query("a8_top_tags", "SELECT asset_id, tag, best FROM (SELECT asset_id, tag, max(score) AS best FROM audio_event WHERE asset_id IS NOT NULL AND tag IS NOT NULL GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY best DESC NULLS LAST, tag) <= 3", "audio_event")
def a8(e):
    best = e.where("asset_id IS NOT NULL AND tag IS NOT NULL").groupBy("asset_id", "tag").agg(F.max("score").alias("best"))
    return ranking.top_k_per(best, ["asset_id"], [F.desc_nulls_last("best"), F.col("tag")], 3).select("asset_id", "tag", "best")


@_query("a9_group_means", "SELECT label, list_transform(list(m ORDER BY i), lambda x: round(x, 5)) AS mean FROM (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m FROM embeddings, range(1, 65) t(i) GROUP BY ALL) GROUP BY 1", "embeddings")
def a9(e):
    return similarity.group_means(e, "label", "embedding").select("label", F.transform("vector", lambda x: F.round(x, 5)).alias("mean"))


@_query("a11_agreement", "WITH n AS (SELECT label, vec_id, embedding AS v FROM embeddings) SELECT a.label, a.vec_id, count(*) AS agreeing FROM n a JOIN n b USING (label) WHERE list_cosine_similarity(a.v, b.v) > 0.4 GROUP BY ALL", "embeddings")
def a11(e):
    return similarity.agreement(e, "label", "vec_id", "embedding")


@_query("a12_index_percentiles", "SELECT source, v[least(CAST(floor(n * 0.5) AS BIGINT), n - 1) + 1] AS p50, v[least(CAST(floor(n * 0.9) AS BIGINT), n - 1) + 1] AS p90 FROM (SELECT source, list_sort(list(n_chars)) AS v, count(*) AS n FROM documents WHERE n_chars IS NOT NULL GROUP BY 1)", "documents")
def a12(d):
    return ranking.index_percentiles(d, ["source"], "n_chars", {"p50": 0.5, "p90": 0.9})


@_query("a14_grouping_sets", "SELECT source, lang, count(*) AS n FROM documents GROUP BY GROUPING SETS ((source), (lang), (source, lang), ())", "documents")
def a14(d):
    return d.groupingSets([["source"], ["lang"], ["source", "lang"], []], "source", "lang").agg(F.count("*").alias("n"))


@_query("a15_main_speaker", "SELECT asset_id, arg_max(speaker_p_id, (s, speaker_p_id)) AS p_id FROM (SELECT asset_id, speaker_p_id, sum(CAST(round(end_sec * 1000) AS BIGINT) - CAST(round(start_sec * 1000) AS BIGINT)) AS s FROM (SELECT DISTINCT asset_id, seg_idx, speaker_p_id, start_sec, end_sec FROM segment) WHERE speaker_p_id IS NOT NULL AND asset_id IS NOT NULL AND start_sec < end_sec GROUP BY ALL) GROUP BY 1", "segment")
def a15(s):
    rows = s.select("asset_id", "seg_idx", "speaker_p_id", "start_sec", "end_sec").distinct().where("speaker_p_id IS NOT NULL AND asset_id IS NOT NULL AND start_sec < end_sec")
    sums = rows.groupBy("asset_id", "speaker_p_id").agg(F.sum(whole_ms(F.col("end_sec")) - whole_ms(F.col("start_sec"))).alias("s"))
    return sums.groupBy("asset_id").agg(F.max_by("speaker_p_id", F.struct("s", "speaker_p_id")).alias("p_id"))


@_query("a16_threshold_sweep", "SELECT t AS threshold, count(*) FILTER (v >= t AND y) AS tp, count(*) FILTER (v >= t AND NOT y) AS fp, count(*) FILTER (v < t AND y) AS fn, count(*) FILTER (v < t AND NOT y) AS tn FROM (SELECT coalesce(score, '-infinity'::DOUBLE) AS v, coalesce(rank_in_win = 1, false) AS y FROM audio_event), (VALUES (0.25::DOUBLE), (0.5), (0.75)) x(t) GROUP BY 1", "audio_event")
def a16(e):
    return quality.threshold_sweep(e, "score", F.coalesce(F.col("rank_in_win") == 1, F.lit(False)), [0.25, 0.5, 0.75])


@_query("a16_confusion", "SELECT tag AS true, theme AS predicted, count(*) AS n FROM audio_event GROUP BY ALL", "audio_event")
def a16b(e):
    return quality.confusion(e, "tag", "theme")


@_query("a21_coverage", "WITH a AS (SELECT DISTINCT asset_id FROM asset), l AS (SELECT DISTINCT asset_id, 'segment' AS l FROM segment UNION SELECT asset_id, 'audio_event' FROM audio_event UNION SELECT parent_asset_id, 'semantic_chunks' FROM semantic_chunks) SELECT asset_id, count(l) AS n_present, 3 - count(l) >= 2 AS incomplete FROM a LEFT JOIN l USING (asset_id) GROUP BY 1", "asset", "segment", "audio_event", "semantic_chunks")
def a21(a, s, e, c):
    out = quality.coverage(a, {"segment": s, "audio_event": e, "semantic_chunks": c.select(F.col("parent_asset_id").alias("asset_id"))})
    return out.select("asset_id", F.size("present").cast("bigint").alias("n_present"), "incomplete")


@_query("a22_coverage_by_moment", "WITH m AS (SELECT asset_id, duration_sec, unnest(from_json(moment_ids_json, '[\"VARCHAR\"]')) AS moment FROM (SELECT DISTINCT asset_id, duration_sec, moment_ids_json FROM asset)) SELECT moment, count(*) AS n, count(*) < 5 AS is_gap FROM m WHERE moment IS NOT NULL GROUP BY 1", "asset")
def a22(a):
    rows = a.select("asset_id", "duration_sec", "moment_ids_json").distinct().select(F.explode(F.from_json("moment_ids_json", "array<string>")).alias("moment")).where("moment IS NOT NULL")
    return rows.groupBy("moment").agg(F.count("*").alias("n"), (F.count("*") < 5).alias("is_gap"))


@_query("a23_status", "SELECT record_kind, count(*) AS n, sum(has_machine_transcript) AS has_machine_transcript, round(100.0 * sum(has_machine_transcript) / count(*), 1) AS has_machine_transcript_pct FROM asset GROUP BY 1", "asset")
def a23(a):
    return quality.status(a, ["has_machine_transcript"], ["record_kind"])


@_query("a24_dominance", "WITH c AS (SELECT asset_id, tag, count(*) AS n FROM audio_event WHERE tag IS NOT NULL GROUP BY ALL) SELECT asset_id, first(tag ORDER BY n DESC, tag) AS top, max(n) AS top_n, CAST(sum(n) AS BIGINT) AS total, max(n) / sum(n) AS share, max(n) / sum(n) < 0.6 AS weak FROM c GROUP BY 1", "audio_event")
def a24(e):
    return quality.dominance(e, "asset_id", "tag")


@_query("a27_repeated_texts", "SELECT count(*) AS n FROM (SELECT trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) AS k, count(*) AS c FROM documents GROUP BY 1 HAVING c > 1) GROUP BY ALL", "documents")
def a27(d):
    return d.groupBy(columns.normalise(F.col("text")).alias("k")).agg(F.count("*").alias("c")).where("c > 1").agg(F.count("*").alias("n"))


# --- windows


@_query("w1_top_links", "SELECT video_asset_id, proposal_pk FROM (SELECT DISTINCT video_asset_id, proposal_pk, combined_score FROM link_proposal WHERE video_asset_id IS NOT NULL) QUALIFY row_number() OVER (PARTITION BY video_asset_id ORDER BY combined_score DESC NULLS LAST, proposal_pk) <= 3", "link_proposal")
def w1(p):
    rows = p.where("video_asset_id IS NOT NULL").select("video_asset_id", "proposal_pk", "combined_score").distinct()
    return ranking.top_k_per(rows, ["video_asset_id"], [F.desc_nulls_last("combined_score"), F.col("proposal_pk")], 3).select("video_asset_id", "proposal_pk")


@_query("w2_margin_gate", "WITH r AS (SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER w AS n, lead(o_totalprice) OVER w AS runner_up FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)) SELECT o_custkey, o_orderkey, runner_up, o_totalprice >= 100000 AND (runner_up IS NULL OR o_totalprice - runner_up >= 5000) AS passed FROM r WHERE n = 1", "orders")
def w2(o):
    return ranking.margin_gate(o, ["o_custkey"], "o_totalprice", [F.col("o_orderkey")], 100_000, 5_000).select("o_custkey", "o_orderkey", "runner_up", "passed")


@_query("w3_diversified_top", "SELECT o_orderkey FROM (SELECT o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS n FROM (SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 150)) WHERE n <= 6 ORDER BY o_totalprice DESC, o_orderkey LIMIT 30", "orders")
def w3(o):
    return ranking.diversify(o, "o_orderpriority", [F.desc("o_totalprice"), F.col("o_orderkey")], 30, over_fetch=150).select("o_orderkey")


@_query("w5_first_last_flag", "SELECT chunk_id, chunk_idx = min(chunk_idx) OVER w OR chunk_idx = max(chunk_idx) OVER w AS at_edge FROM (SELECT DISTINCT chunk_id, parent_asset_id, chunk_idx FROM semantic_chunks) WINDOW w AS (PARTITION BY parent_asset_id)", "semantic_chunks")
def w5(c):
    w = Window.partitionBy("parent_asset_id")
    rows = c.select("chunk_id", "parent_asset_id", "chunk_idx").distinct()
    return rows.select("chunk_id", ((F.col("chunk_idx") == F.min("chunk_idx").over(w)) | (F.col("chunk_idx") == F.max("chunk_idx").over(w))).alias("at_edge"))


@_query("w7_merged_hits", "WITH h AS (SELECT asset_id, greatest(0, CAST(round(window_start_sec * 1000) AS BIGINT) - 45000) AS s, CAST(round(window_end_sec * 1000) AS BIGINT) + 45000 AS e FROM (SELECT DISTINCT * FROM audio_event) WHERE tag = 'music' AND asset_id IS NOT NULL AND window_start_sec IS NOT NULL AND window_end_sec IS NOT NULL), r AS (SELECT *, max(e) OVER (PARTITION BY asset_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM h), k AS (SELECT *, sum(CASE WHEN m IS NULL OR s > m + 20000 THEN 1 ELSE 0 END) OVER (PARTITION BY asset_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS k FROM r) SELECT asset_id AS entity, min(s) AS start, max(e) AS end, count(*) AS n FROM k GROUP BY asset_id, k", "audio_event")
def w7(e):
    rows = e.distinct().where("tag = 'music'").select("asset_id", whole_ms(F.col("window_start_sec")).alias("s"), whole_ms(F.col("window_end_sec")).alias("e"), F.lit(1).alias("v"))
    out = islands.merge_hits(rows, "asset_id", "s", "e", "v", pad=45_000, gap=20_000)
    return out.select("entity", F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"), "n")


@_query("w7_sessions", "WITH o AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS o FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), k AS (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS k FROM o) SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n FROM k GROUP BY user_id, k", "events")
def w7b(e):
    return islands.sessions(e, "user_id", "ts", 1_800_000_000)


@_query("w8_runs_by_gap", "WITH s AS (SELECT DISTINCT asset_id, start_sec, end_sec FROM segment WHERE asset_id IS NOT NULL AND start_sec IS NOT NULL AND end_sec IS NOT NULL), o AS (SELECT *, CASE WHEN start_sec <= lag(end_sec) OVER w + 5 THEN 0 ELSE 1 END AS o FROM s WINDOW w AS (PARTITION BY asset_id ORDER BY start_sec, end_sec)) SELECT asset_id, CAST(sum(o) AS BIGINT) AS n_runs FROM o GROUP BY 1", "segment")
def w8(s):
    rows = s.select("asset_id", "start_sec", "end_sec").distinct().dropna()
    return islands.cluster_by_gap(rows, "asset_id", "start_sec", "end_sec", 5.0).groupBy("asset_id").agg(F.max("run").cast("bigint").alias("n_runs"))


@_query("w10_uncovered", "WITH f AS (SELECT asset_id, 0 AS f0, max(CAST(round(duration_sec * 1000) AS BIGINT)) AS f1 FROM asset WHERE asset_id IS NOT NULL GROUP BY 1 HAVING f1 > 0), s AS (SELECT f.asset_id, greatest(CAST(round(start_sec * 1000) AS BIGINT), f0) AS s, least(CAST(round(end_sec * 1000) AS BIGINT), f1) AS e FROM segment JOIN f USING (asset_id) WHERE start_sec IS NOT NULL AND end_sec IS NOT NULL), g AS (SELECT asset_id, s, e FROM s WHERE s < e UNION ALL SELECT asset_id, f0, f0 FROM f UNION ALL SELECT asset_id, f1, f1 FROM f), r AS (SELECT asset_id, s, max(e) OVER (PARTITION BY asset_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM g) SELECT asset_id, m AS start, s AS end FROM r WHERE s > m", "asset", "segment")
def w10(a, s):
    frames = a.where("asset_id IS NOT NULL").groupBy("asset_id").agg(F.lit(0).cast("bigint").alias("f0"), F.max(whole_ms(F.col("duration_sec"))).alias("f1"))
    spans = s.select("asset_id", whole_ms(F.col("start_sec")).alias("s"), whole_ms(F.col("end_sec")).alias("e")).dropna()
    return islands.uncovered(frames, spans, "asset_id", ("f0", "f1"), ("s", "e"))


@_query(
    "w11_visible_layers",
    """WITH r AS (SELECT DISTINCT asset_id, CAST(round(window_start_sec * 1000) AS BIGINT) AS s, CAST(round(window_end_sec * 1000) AS BIGINT) AS e, score, tag FROM audio_event WHERE window_start_sec < window_end_sec AND asset_id IS NOT NULL AND score IS NOT NULL AND tag IS NOT NULL),
    c AS (SELECT asset_id, s AS t FROM r UNION SELECT asset_id, e FROM r), p AS (SELECT asset_id, t, lead(t) OVER (PARTITION BY asset_id ORDER BY t) AS u FROM c),
    v AS (SELECT p.asset_id, t, u, arg_max(tag, (score, tag)) AS tag FROM p JOIN r ON r.asset_id = p.asset_id AND s < u AND e > t WHERE u IS NOT NULL GROUP BY ALL),
    o AS (SELECT *, CASE WHEN lag(tag) OVER w = tag AND lag(u) OVER w = t THEN 0 ELSE 1 END AS o FROM v WINDOW w AS (PARTITION BY asset_id ORDER BY t)), k AS (SELECT *, sum(o) OVER (PARTITION BY asset_id ORDER BY t) AS k FROM o)
    SELECT asset_id AS entity, min(tag) AS label, min(t) AS start, max(u) AS end FROM k GROUP BY asset_id, k""",
    "audio_event",
)
def w11(e):
    rows = e.select("asset_id", whole_ms(F.col("window_start_sec")).alias("s"), whole_ms(F.col("window_end_sec")).alias("e"), "score", "tag").dropna().distinct()
    return islands.visible_layers(rows, "asset_id", "s", "e", F.col("score"), "tag", width=60_000)


@_query("w14_repeated_speaker", "SELECT asset_id, seg_idx FROM (SELECT asset_id, seg_idx, speaker_id, lag(speaker_id) OVER (PARTITION BY asset_id ORDER BY seg_idx) AS b FROM (SELECT DISTINCT asset_id, seg_idx, speaker_id FROM segment)) WHERE speaker_id = b", "segment")
def w14(s):
    rows = s.select("asset_id", "seg_idx", "speaker_id").distinct().withColumn("b", F.lag("speaker_id").over(Window.partitionBy("asset_id").orderBy("seg_idx")))
    return rows.where("speaker_id = b").select("asset_id", "seg_idx")


@_query("w17_spaced_sample", "WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events) SELECT user_id, event_id FROM r WHERE i = 0 OR floor(i * 10 / greatest(n, 10)::DOUBLE) <> floor((i - 1) * 10 / greatest(n, 10)::DOUBLE)", "events")
def w17(e):
    return ranking.spaced_sample(e.select("user_id", "event_id"), ["user_id"], ["event_id"], 10)


@_query("w19_character_offsets", "SELECT asset_id, seg_idx, CAST(sum(length(text)) OVER (PARTITION BY asset_id ORDER BY seg_idx) - length(text) AS BIGINT) AS char_start FROM (SELECT DISTINCT asset_id, seg_idx, text FROM segment WHERE text IS NOT NULL)", "segment")
def w19(s):
    rows = s.where("text IS NOT NULL").select("asset_id", "seg_idx", F.length("text").alias("n")).distinct()
    return rows.select("asset_id", "seg_idx", (F.sum("n").over(Window.partitionBy("asset_id").orderBy("seg_idx")) - F.col("n")).alias("char_start"))


# --- order, limits, sets


@_query("k2_blended_rank", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(coalesce(l_quantity, 0) / 10 + least(l_extendedprice, 1000) / 1000 + least(l_tax * 1000, 30) / 30, 6) AS blended FROM lineitem", "lineitem")
def k2(li):
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(columns.blended_rank(F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_tax") * 1_000), 6).alias("blended"))


@_query("k5_scored_first", "SELECT event_pk FROM (SELECT DISTINCT event_pk, score FROM audio_event) ORDER BY score IS NULL, score DESC, event_pk LIMIT 50", "audio_event")
def k5(e):
    return e.select("event_pk", "score").distinct().orderBy(F.col("score").isNull(), F.desc("score"), "event_pk").limit(50).select("event_pk")


@_query("k7_stratified_sample", None, "documents")
def k7(d):
    return ranking.stratified_sample(d.select("doc_id", "source"), "source", "doc_id", 20, seed=11)


@_query("k8_greedy_budget", None, "audio_event")
def k8(e):
    rows = e.distinct().where("window_start_sec < window_end_sec AND score IS NOT NULL AND asset_id IS NOT NULL").select("asset_id", "event_pk", "window_start_sec", "window_end_sec", "score")
    return ranking.greedy_budget(rows, ["asset_id"], "window_start_sec", "window_end_sec", "score", 60.0)


@_query("w9_greedy_chunks", None, "segment")
def w9(s):
    return ranking.greedy_chunks(s.distinct(), "asset_id", "start_sec", "end_sec", "text")


@_query("u3_difference_both_ways", "SELECT 'only_asset' AS side, count(*) AS n FROM (SELECT asset_id FROM asset EXCEPT SELECT asset_id FROM segment) UNION ALL SELECT 'only_segment', count(*) FROM (SELECT asset_id FROM segment EXCEPT SELECT asset_id FROM asset)", "asset", "segment")
def u3(a, s):
    diff = joins.snapshot_diff(s, a, ["asset_id"])
    names = a.sparkSession.createDataFrame([("only_asset", "added"), ("only_segment", "removed")], "side string, change string")
    return names.join(diff.groupBy("change").agg(F.count("*").alias("n")), "change", "left").select("side", F.coalesce("n", F.lit(0)).alias("n"))


@_query("u4_snapshot_diff", "WITH o AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A'), n AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'N'), x AS (SELECT 'removed' AS change FROM (FROM o EXCEPT FROM n) UNION ALL SELECT 'added' FROM (FROM n EXCEPT FROM o) UNION ALL SELECT 'unchanged' FROM (FROM n INTERSECT FROM o)) SELECT change, count(*) AS n FROM x GROUP BY 1", "lineitem")
def u4(li):
    return joins.snapshot_diff(li.where("l_returnflag = 'A'"), li.where("l_returnflag = 'N'"), ["l_partkey", "l_suppkey"]).groupBy("change").agg(F.count("*").alias("n"))


# --- scalar functions


@_query("x1_x4_slugs", "SELECT DISTINCT canonical_name, trim(regexp_replace(lower(canonical_name), '[^a-z0-9]+', ' ', 'g')) AS plain, 'pl_' || replace(trim(regexp_replace(lower(canonical_name), '[^a-z0-9]+', ' ', 'g')), ' ', '_') AS slug FROM places", "places")
def x1(p):
    return p.select("canonical_name", columns.normalise(F.col("canonical_name")).alias("plain"), columns.slug("pl_", F.col("canonical_name")).alias("slug")).distinct()


@_query("x2_tokens", "SELECT asset_id, seg_idx, list_filter(string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^a-z0-9]+', ' ', 'g')), ' '), lambda w: length(w) >= 2 AND NOT list_contains([" + ", ".join(f"'{w}'" for w in columns.STOP_WORDS) + "], w)) AS words FROM (SELECT DISTINCT asset_id, seg_idx, text FROM segment)", "segment")
def x2(s):
    return s.select("asset_id", "seg_idx", "text").distinct().select("asset_id", "seg_idx", columns.tokens(F.col("text")).alias("words"))


@_query("x6_name_distance", "SELECT a.n_name AS a, b.n_name AS b, levenshtein(a.n_name, b.n_name) / greatest(length(a.n_name), length(b.n_name)) AS distance FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_name < b.n_name", "nation")
def x6(n):
    pairs = joins.block_pairs(n.select("n_regionkey", "n_name"), ["n_regionkey"], "n_name")
    return pairs.select(F.col("a.n_name").alias("a"), F.col("b.n_name").alias("b"), columns.normalised_distance(F.col("a.n_name"), F.col("b.n_name")).alias("distance"))


@_query("x7_sounds", None, "places")
def x7(p):
    return p.select("id", columns.phonetic_key(F.col("canonical_name")).alias("sound")).distinct()


@_query("x18_keyword_score", "SELECT doc_id, 2.0 * CAST(contains(lower(t), 'storm') AS INTEGER) + 1.5 * CAST(contains(lower(t), 'ridge') AS INTEGER) + 1.0 * CAST(contains(lower(t), 'camera') AS INTEGER) AS score FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)", "documents")
def x18(d):
    return d.select("doc_id", columns.keyword_score(F.col("text"), {"storm": 2.0, "ridge": 1.5, "camera": 1.0})["score"].alias("score"))


@_query("x28_overlaps", "SELECT event_pk, greatest(0, least(window_end_sec, 60.0) - greatest(window_start_sec, 10.0)) AS shared FROM (SELECT DISTINCT event_pk, window_start_sec, window_end_sec FROM audio_event WHERE window_start_sec IS NOT NULL AND window_end_sec IS NOT NULL)", "audio_event")
def x28(e):
    rows = e.select("event_pk", "window_start_sec", "window_end_sec").dropna().distinct()
    return rows.select("event_pk", columns.overlap(F.col("window_start_sec"), F.col("window_end_sec"), F.lit(10.0), F.lit(60.0)).alias("shared"))


@_query("x30_bit_distance", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(bit_count(xor(l_partkey, l_suppkey)) AS INTEGER) AS bits FROM lineitem", "lineitem")
def x30(li):
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.bit_count(F.col("l_partkey").bitwiseXOR(F.col("l_suppkey"))).alias("bits"))


@_query("x35_json_values", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events", "events")
def x35(e):
    return e.select("event_id", columns.score(F.get_json_object(columns.json_object(F.col("props")), "$.k")).cast("int").alias("k"))


# --- row generators


@_query("g1_sliding_windows", "SELECT DISTINCT asset_id, CAST(k * 45 AS DOUBLE) AS start, least(k * 45 + 90, duration_sec) AS end FROM asset, LATERAL (SELECT unnest(generate_series(0, CAST(ceil(greatest(0, duration_sec - 90) / 45) AS BIGINT))) AS k) WHERE duration_sec > 0", "asset")
def g1(a):
    return a.select("asset_id", F.explode(generators.sliding_windows(F.col("duration_sec"), 90.0, 45.0)).alias("w")).select("asset_id", "w.start", "w.end").distinct()


@_query("g3_quality_samples", "SELECT DISTINCT chunk_id, round(t, 6) AS t FROM (SELECT chunk_id, unnest(CASE WHEN d < 2 THEN [s + d * 0.5] WHEN d < 4 THEN [s + d * 0.25, s + d * 0.75] ELSE [s + d * 0.10, s + d * 0.35, s + d * 0.65, s + d * 0.90] END) AS t FROM (SELECT chunk_id, chunk_start_sec AS s, chunk_end_sec - chunk_start_sec AS d FROM semantic_chunks WHERE chunk_start_sec < chunk_end_sec))", "semantic_chunks")
def g3(c):
    rows = c.where("chunk_start_sec < chunk_end_sec")
    return rows.select("chunk_id", F.explode(generators.quality_sample_times(F.col("chunk_start_sec"), F.col("chunk_end_sec"))).alias("t")).select("chunk_id", F.round("t", 6).alias("t")).distinct()


@_query("g7_cadence", "SELECT DISTINCT asset_id, CAST(unnest(generate_series(0, greatest(1, CAST(ceil(coalesce(duration_sec, 0) / 7) AS BIGINT)) - 1)) * 7 AS DOUBLE) AS t FROM asset", "asset")
def g7(a):
    return a.select("asset_id", F.explode(generators.cadence(F.col("duration_sec"), 7.0)).alias("t")).distinct()


@_query(
    "g11_speech_without_music",
    """WITH r AS (SELECT 'own' AS k, asset_id, CAST(round(start_sec * 1000) AS BIGINT) AS s, CAST(round(end_sec * 1000) AS BIGINT) AS e FROM segment UNION ALL SELECT 'hole', asset_id, CAST(round(window_start_sec * 1000) AS BIGINT), CAST(round(window_end_sec * 1000) AS BIGINT) FROM audio_event WHERE tag = 'music'),
    g AS (SELECT *, max(e) OVER (PARTITION BY k, asset_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM r WHERE asset_id IS NOT NULL AND s < e), i AS (SELECT *, sum(CAST(m IS NULL OR s > m AS INTEGER)) OVER (PARTITION BY k, asset_id ORDER BY s, e) AS n FROM g),
    p AS (SELECT k, asset_id, min(s) AS s, max(e) AS e FROM i GROUP BY k, asset_id, n), b AS (SELECT asset_id, s AS t, CAST(k = 'own' AS INTEGER) AS i, CAST(k = 'hole' AS INTEGER) AS o FROM p UNION ALL SELECT asset_id, e, -CAST(k = 'own' AS INTEGER), -CAST(k = 'hole' AS INTEGER) FROM p),
    d AS (SELECT asset_id, t, sum(i) AS i, sum(o) AS o FROM b GROUP BY ALL), w AS (SELECT asset_id, t, sum(i) OVER x AS i, sum(o) OVER x AS o, lead(t) OVER x AS u FROM d WINDOW x AS (PARTITION BY asset_id ORDER BY t)) SELECT asset_id, t AS start, u AS "end" FROM w WHERE i > 0 AND o = 0 AND u - t >= 500""", "segment", "audio_event",
)
def g11(s, e):
    spans = s.select("asset_id", whole_ms(F.col("start_sec")).alias("s"), whole_ms(F.col("end_sec")).alias("e"))
    holes = e.where("tag = 'music'").select("asset_id", whole_ms(F.col("window_start_sec")).alias("s"), whole_ms(F.col("window_end_sec")).alias("e"))
    return islands.subtract(spans, holes, "asset_id", ("s", "e"), ("s", "e"), least=500)


# --- search, vectors, graphs

_NORMAL = r"trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"

# The 64 little-endian floats of a blob that is of that length, finite and not all zero.
_FLOATS = """SELECT {key}, list_transform(b, lambda u: CASE WHEN u & 2147483647 = 0 THEN 0.0 ELSE (CASE WHEN u >= 2147483648 THEN -1 ELSE 1 END) * (CASE WHEN (u >> 23) & 255 = 0 THEN (u & 8388607) * pow(2.0, -149) ELSE (1 + (u & 8388607) / 8388608.0) * pow(2.0, ((u >> 23) & 255) - 127) END) END) AS v
  FROM (SELECT {key}, list_transform(range(0, 64), lambda i: CAST('0x' || substr(h, i * 8 + 7, 2) || substr(h, i * 8 + 5, 2) || substr(h, i * 8 + 3, 2) || substr(h, i * 8 + 1, 2) AS BIGINT)) AS b FROM (SELECT DISTINCT {key}, hex({blob}) AS h FROM {table} WHERE octet_length({blob}) = 256))
  WHERE len(list_filter(b, lambda u: (u >> 23) & 255 = 255)) = 0 AND len(list_filter(b, lambda u: u & 2147483647 <> 0)) > 0"""

_WORDS = r"SELECT doc_id AS doc, list_filter(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), lambda w: true) AS w FROM (SELECT DISTINCT doc_id, text FROM documents WHERE trim(text) <> '')"


@_query(
    "v1_bm25",
    f"""WITH d AS ({_WORDS}), p AS (SELECT doc, t AS term, count(*) AS tf FROM (SELECT doc, unnest(w) AS t FROM d) WHERE t IN ('storm', 'camera') GROUP BY ALL), f AS (SELECT term, count(*) AS df FROM p GROUP BY 1), n AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM d)
    SELECT doc AS doc_id, round(sum(greatest(1e-6, ln((n - df + 0.5) / (df + 0.5))) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean))), 6) AS score FROM p JOIN f USING (term) JOIN d USING (doc), n GROUP BY doc HAVING count(*) = 2""",
    "documents",
)
def v1(d):
    index = search.build_index(d.select("doc_id", "text").distinct(), "doc_id", "text", stemmed=False)
    return search.bm25(index, "storm camera", stemmed=False).select(F.col("doc").alias("doc_id"), F.round("score", 6).alias("score"))


@_query(
    "v2_boolean_match",
    f"WITH d AS (SELECT doc, ' ' || array_to_string(w, ' ') || ' ' AS t FROM ({_WORDS})) SELECT doc AS doc_id FROM d WHERE (contains(t, ' storm build ') OR contains(t, ' lens ')) AND NOT contains(t, ' citation ')",
    "documents",
)
def v2(d):
    index = search.build_index(d.select("doc_id", "text").distinct(), "doc_id", "text", stemmed=False)
    return search.match(index, '("storm build" OR lens) NOT citation', stemmed=False).select(F.col("doc").alias("doc_id"))


@_query("v1_stemmed_search", None, "segment")
def v1b(s):
    index = search.build_index(s.where("text IS NOT NULL").select(F.struct("asset_id", "seg_idx").alias("doc"), "text").distinct(), "doc", "text")
    return search.bm25(index, "running flags").select("doc.asset_id", "doc.seg_idx", F.round("score", 6).alias("score"))


@_query("v3_cosine_top_k", "WITH q AS (SELECT embedding AS v FROM embeddings ORDER BY vec_id LIMIT 1) SELECT vec_id, round(list_cosine_similarity(embedding, v), 4) AS cosine FROM embeddings, q WHERE label IN (1, 2, 3) ORDER BY list_cosine_similarity(embedding, v) DESC, vec_id LIMIT 20", "embeddings")
def v3(e):
    query = e.orderBy("vec_id").first()["embedding"]
    allowed = e.where(F.col("label").isin(1, 2, 3)).select("vec_id")
    return similarity.cosine_top_k(e, "embedding", query, 20, [F.col("vec_id")], allowed, "vec_id").select("vec_id", F.round("cosine", 4).alias("cosine"))


@_query(
    "v3_cosine_top_k_each",
    "WITH q AS (SELECT vec_id AS q_id, embedding AS v FROM embeddings WHERE vec_id % 50 = 0), s AS (SELECT q_id, vec_id, list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST(v AS DOUBLE[])) AS cosine FROM embeddings, q WHERE vec_id <> q_id) SELECT q_id, vec_id, round(cosine, 4) AS cosine, row_number() OVER (PARTITION BY q_id ORDER BY cosine DESC, vec_id) AS rank FROM s QUALIFY rank <= 20",
    "embeddings",
)
def v3b(e):
    queries = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("q_id"), F.col("embedding").alias("v"))
    return similarity.cosine_top_k_each(e, "vec_id", "embedding", queries, "q_id", "v", 20, apart=("q_id", "vec_id")).withColumn("cosine", F.round("cosine", 4))


@_query(
    "v10_nearest_centroid",
    "WITH m AS (SELECT label, list(x ORDER BY i) AS c FROM (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS x FROM embeddings, range(1, 65) t(i) GROUP BY ALL) GROUP BY 1), s AS (SELECT vec_id, m.label, list_cosine_similarity(CAST(embedding AS DOUBLE[]), c) AS cosine FROM embeddings, m), r AS (SELECT *, lead(cosine) OVER w AS ru, row_number() OVER w AS n FROM s WINDOW w AS (PARTITION BY vec_id ORDER BY cosine DESC, label)) SELECT vec_id, label, cosine >= 0.55 AND cosine - ru >= 0.10 AS passed FROM r WHERE n = 1",
    "embeddings",
)
def v10(e):
    return similarity.nearest_centroid(e, "vec_id", "embedding", similarity.group_means(e, "label", "embedding"), "label").select("vec_id", "label", "passed")


@_query(
    "v23_components",
    f"WITH RECURSIVE e AS ({_LINKS}), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r(id, o) AS (SELECT a, a FROM u UNION SELECT r.id, u.b FROM r JOIN u ON r.o = u.a) SELECT id, min(o) AS component FROM r GROUP BY 1",
    "link_proposal",
)
def v23(p):
    return graph.components(_links(p), "a", "b")


@_query(
    "v23_directed_reach",
    f"WITH RECURSIVE e AS ({_LINKS}), s AS (SELECT DISTINCT lower(trim(video_asset_id, ' \t\n')) AS seed FROM applied_link WHERE video_asset_id IS NOT NULL), r(seed, id) AS (SELECT seed, seed FROM s UNION SELECT r.seed, e.b FROM r JOIN e ON r.id = e.a) SELECT seed, id FROM r",
    "link_proposal", "applied_link",
)
def v23b(p, a):
    return graph.directed_reach(_links(p), "a", "b", _links(a.withColumn("audio_asset_id", F.col("video_asset_id"))).select("a"), "a")


@_query(
    "v24_edge_tiers",
    f"WITH e AS ({_LINKS}), s AS (SELECT DISTINCT lower(trim(video_asset_id, ' \t\n')) AS id FROM applied_link WHERE video_asset_id IS NOT NULL) SELECT a AS src, b AS dst, CASE WHEN a IN (FROM s) AND b IN (FROM s) THEN 1 WHEN EXISTS (SELECT 1 FROM e f WHERE f.a = e.b AND f.b = e.a) THEN 2 ELSE 3 END AS tier FROM e",
    "link_proposal", "applied_link",
)
def v24(p, a):
    return graph.edge_tiers(_links(p), "a", "b", _links(a.withColumn("audio_asset_id", F.col("video_asset_id"))).select("a"), "a")


@_query("v27_cycles", "WITH RECURSIVE u AS (SELECT DISTINCT id, parent_id AS p FROM places WHERE id IS NOT NULL AND parent_id IS NOT NULL), r(id, o, n) AS (SELECT id, p, 1 FROM u UNION SELECT r.id, u.p, n + 1 FROM r JOIN u ON r.o = u.id WHERE n < 40 AND r.o <> r.id) SELECT DISTINCT id FROM r WHERE id = o", "places")
def v27(p):
    return graph.cycles(p, "id", "parent_id")


@_query(
    "u8_resolved_merges",
    "WITH RECURSIVE st AS (SELECT id, min(parent_id) AS t FROM places WHERE id IS NOT NULL AND parent_id IS NOT NULL AND id <> parent_id GROUP BY 1), r(id, cur) AS (SELECT id, t FROM st UNION SELECT r.id, st.t FROM r JOIN st ON r.cur = st.id) SELECT id, cur AS final FROM r WHERE cur NOT IN (SELECT id FROM st)", "places",
)
def u8(p):
    return graph.resolve_merges(p, "id", "parent_id")


@_query("j30_dictionary", None, "documents", "places")
def j30(d, p):
    names = p.select("id", F.explode(F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("phrase"))
    return entities.dictionary_matches(d.select("doc_id", "text").distinct(), "doc_id", "text", names, "phrase", "id")


@_query("j28_sounds_alike", None, "places")
def j28(p):
    typed = p.select(F.explode("aliases").alias("alias")).where("alias IS NOT NULL").distinct()
    return entities.phonetic_matches(typed, "alias", "alias", p.select("id", "canonical_name").distinct(), "id", "canonical_name")


@_query("j27_fuzzy_names", None, "places")
def j27(p):
    return entities.fuzzy_matches(p.select(F.col("id").alias("row"), "canonical_name").distinct(), "row", "canonical_name", p.select("id", "canonical_name").distinct(), "id", "canonical_name")


@_query(
    "j41_aliases",
    f"WITH k AS (SELECT DISTINCT e, {_NORMAL.format('a')} AS a FROM (SELECT id AS e, unnest(aliases) AS a FROM places)), kk AS (SELECT * FROM k WHERE a <> ''), q AS (SELECT DISTINCT id AS row, {_NORMAL.format('canonical_name')} AS q FROM places WHERE regexp_matches(lower(canonical_name), '[a-z0-9]')), x AS (SELECT row, count(DISTINCT e) AS n, min(e) AS e FROM q JOIN kk ON q = a GROUP BY 1), t AS (SELECT row, unnest(list_distinct(string_split(q, ' '))) AS t, len(list_distinct(string_split(q, ' '))) AS need FROM q WHERE row NOT IN (SELECT row FROM x)), kt AS (SELECT DISTINCT e, unnest(string_split(a, ' ')) AS t FROM kk), al AS (SELECT row, e FROM t JOIN kt USING (t) GROUP BY row, e HAVING count(DISTINCT t) = max(need)), y AS (SELECT row, count(*) AS n, min(e) AS e FROM al GROUP BY 1), f AS (SELECT * FROM x UNION ALL SELECT * FROM y) SELECT row, CASE WHEN n = 1 THEN e END AS id, coalesce(n, 0) AS n FROM q LEFT JOIN f USING (row)", "places",
)
def j41(p):
    return entities.resolve_aliases(p.select(F.col("id").alias("row"), "canonical_name").distinct(), "row", "canonical_name", p.select("id", "aliases").distinct(), "id", "aliases")


def _vectors(df, id, blob, keep):
    return df.select(id, *keep, columns.float_vector(F.col(blob), 64).alias("vector")).dropDuplicates([id])


@_query("q10_search_transcript", None, "segment")
def q10(s):
    from fieldreel.plans.composers import search_transcript

    return search_transcript({"segment": s.distinct()}, "tents ticket").withColumn("score", F.round("score", 6))


@_query(
    "q11_similar_transcript_windows",
    f"WITH w AS ({_FLOATS.format(key='id, run_id, asset_id', blob='vector_blob', table='transcript_window_embedding')}), l AS (SELECT * FROM w WHERE run_id = (SELECT max(run_id) FROM transcript_window_embedding)), s AS (SELECT q.id AS q_id, l.id, l.asset_id, list_cosine_similarity(l.v, q.v) AS cosine FROM w q, l WHERE q.id % 50 = 0) SELECT q_id, id, asset_id, round(cosine, 4) AS cosine, row_number() OVER (PARTITION BY q_id ORDER BY round(cosine, 9) DESC, id) AS rank FROM s QUALIFY rank <= 25", "transcript_window_embedding",
)
def q11(w):
    from fieldreel.plans.composers import similar_transcript_windows_each

    rows = _vectors(w, "id", "vector_blob", ["run_id", "asset_id"])
    queries = rows.where("id % 50 = 0").select(F.col("id").alias("q_id"), F.col("vector").alias("q"))
    return similar_transcript_windows_each(rows, queries).withColumn("cosine", F.round("cosine", 4))


@_query(
    "q12_visually_similar",
    f"WITH w AS ({_FLOATS.format(key='embedding_pk, chunk_id', blob='vector_blob', table='clip_embeddings')}), u AS (SELECT chunk_id, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM w), g AS (SELECT chunk_id, i, avg(x) AS x FROM u GROUP BY ALL), o AS (SELECT chunk_id, min(parent_asset_id) AS asset_id FROM semantic_chunks WHERE chunk_id IS NOT NULL GROUP BY 1), m AS (SELECT chunk_id, asset_id, list(x ORDER BY i) AS v FROM g JOIN o USING (chunk_id) GROUP BY ALL), s AS (SELECT q.chunk_id AS q_id, m.chunk_id, m.asset_id, list_cosine_similarity(m.v, q.v) AS cosine FROM m q, m WHERE CAST('0x' || right(q.chunk_id, 4) AS INTEGER) % 50 = 0 AND q.chunk_id <> m.chunk_id) SELECT q_id, chunk_id, asset_id, round(cosine, 4) AS cosine, row_number() OVER (PARTITION BY q_id ORDER BY round(cosine, 9) DESC, chunk_id) AS rank FROM s QUALIFY rank <= 20", "clip_embeddings", "semantic_chunks",
)
def q12(k, c):
    from fieldreel.plans.composers import visually_similar_each

    seeds = c.where("chunk_id IS NOT NULL").select("chunk_id").distinct().where(F.conv(F.right("chunk_id", F.lit(4)), 16, 10).cast("int") % 50 == 0)
    return visually_similar_each(_vectors(k, "embedding_pk", "vector_blob", ["chunk_id"]), c, seeds).withColumn("cosine", F.round("cosine", 4))


@_query(
    "q14_chunk_means",
    f"WITH w AS ({_FLOATS.format(key='embedding_pk, chunk_id', blob='vector_blob', table='clip_embeddings')}), u AS (SELECT chunk_id, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM w WHERE chunk_id IS NOT NULL), g AS (SELECT chunk_id, i, avg(x) AS x, count(*) AS n FROM u GROUP BY ALL) SELECT chunk_id, max(n) AS n, round(max(x) FILTER (i = 1), 4) AS first, round(sqrt(sum(x * x)), 4) AS length FROM g GROUP BY 1", "clip_embeddings",
)
def q14(k):
    return similarity.group_means(_vectors(k, "embedding_pk", "vector_blob", ["chunk_id"]), "chunk_id", "vector").select("chunk_id", "n", F.round(F.col("vector")[0], 4).alias("first"), F.round(columns.norm(F.col("vector")), 4).alias("length"))


@_query("v8_cut_deltas", None, "clip_embeddings", "semantic_chunks")
def v8(k, c):
    owner = c.select("chunk_id", F.col("parent_asset_id").alias("asset_id")).dropDuplicates(["chunk_id"])
    frames = _vectors(k, "embedding_pk", "vector_blob", ["chunk_id", "timestamp_sec"]).join(owner, "chunk_id").select("asset_id", F.col("timestamp_sec").alias("at"), F.col("embedding_pk").alias("frame_id"), "vector")
    rows = c.dropDuplicates(["chunk_id"]).where("parent_asset_id IS NOT NULL AND chunk_start_sec IS NOT NULL")
    w = Window.partitionBy("parent_asset_id").orderBy("chunk_idx", "chunk_id")
    cuts = rows.select("chunk_id", F.col("parent_asset_id").alias("a"), F.col("chunk_end_sec").alias("t"), F.lead("chunk_start_sec").over(w).alias("u"))
    return similarity.cut_deltas(cuts, frames, id="chunk_id", out_asset="a", out_at="t", in_asset="a", in_at="u").withColumn("cosine", F.round("cosine", 4))


@_query("q8_search_broll", "SELECT DISTINCT asset_id, shoot_date FROM asset WHERE record_kind = 'video' AND (lower(asset_type) IN ('b_roll', 'broll', 'b-roll') OR bucket ILIKE '%broll%' OR semantic_editorial_notes ILIKE '%b-roll%') AND semantic_location ILIKE '%trail%' ORDER BY shoot_date DESC NULLS LAST, asset_id LIMIT 50", "asset")
def q8(a):
    from fieldreel.plans.composers import search_broll

    chunk = a.select("asset_id", F.lit(None).cast("string").alias("editorial_notes"), F.lit(None).cast("string").alias("action"), F.lit(None).cast("string").alias("setting_location")).limit(0)
    return search_broll({"asset": a, "asset_semantic_chunk": chunk}, location="trail").select("asset_id", "shoot_date")


@_query(
    "q20_boundary_distance",
    "WITH st AS (SELECT DISTINCT asset_id, event_pk, window_start_sec AS at FROM audio_event WHERE window_start_sec IS NOT NULL AND asset_id IS NOT NULL), d AS (SELECT st.event_pk, min(abs(s.end_sec - st.at)) AS d FROM st JOIN segment s ON s.asset_id = st.asset_id AND s.end_sec IS NOT NULL GROUP BY 1), o AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS i, count(*) OVER () AS n FROM d) SELECT round(max(d) FILTER (i = least(CAST(floor(n * 0.5) AS BIGINT), n - 1)), 6) AS p50, round(max(d) FILTER (i = least(CAST(floor(n * 0.9) AS BIGINT), n - 1)), 6) AS p90, any_value(n) AS n, round(avg(CAST(d <= 0.5 AS INTEGER)), 6) AS share_within FROM o", "audio_event", "segment",
)
def q20(e, s):
    starts = e.select("asset_id", F.col("event_pk").alias("id"), F.col("window_start_sec").alias("at")).distinct()
    found = quality.distance_summary(quality.boundary_distance(starts, s.select("asset_id", F.col("end_sec").alias("at"))))
    return found.select(F.round("p50", 6).alias("p50"), F.round("p90", 6).alias("p90"), "n", F.round("share_within", 6).alias("share_within"))


@_query(
    "q23_validate_segments",
    "WITH s AS (SELECT DISTINCT asset_id, seg_idx, start_sec, end_sec, text FROM segment) SELECT asset_id, seg_idx, 'ordered' AS rule, 'error' AS severity FROM s WHERE coalesce(start_sec <= end_sec, false) = false UNION ALL SELECT asset_id, seg_idx, 'has_text', 'warning' FROM s WHERE coalesce(trim(text) <> '', false) = false",
    "segment",
)
def q23(s):
    rows = s.select("asset_id", "seg_idx", "start_sec", "end_sec", "text").distinct().withColumn("id", F.struct("asset_id", "seg_idx"))
    rules = {"ordered": ("error", F.col("start_sec") <= F.col("end_sec")), "has_text": ("warning", F.trim("text") != "")}
    return quality.validate(rows, "id", rules).select("id.asset_id", "id.seg_idx", "rule", "severity")


@_query("q24_key_problems", "SELECT asset_id, seg_idx, count(*) AS n FROM segment GROUP BY ALL HAVING n > 1 OR asset_id IS NULL OR seg_idx IS NULL", "segment")
def q24(s):
    return quality.key_problems(s, ["asset_id", "seg_idx"])


@_query("v18_same_kind_links", None, "segment", "asset")
def v18(s, a):
    """Pairs of recordings of one kind, thirty days and label whose speech is alike."""
    text = s.where("text IS NOT NULL").select("asset_id", "seg_idx", "text").repartition("asset_id").distinct().groupBy("asset_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seg_idx", "text"))), lambda x: x["text"]), " ").alias("text"))
    day = to_utc(a.select("asset_id", "record_kind", "shoot_date", "shoot_label", F.lit(None).cast("string").alias("zone")).distinct(), "shoot_date", "zone")
    # exploding drops nulls; a filter would inline the parsing into itself
    day = day.select("asset_id", "record_kind", "shoot_label", F.explode(F.array_compact(F.array("utc_us"))).alias("us"))
    rows = day.select("asset_id", "record_kind", F.floor(F.col("us") / (30 * DAY_US)).alias("shoot_date"), "shoot_label").distinct().where("record_kind IS NOT NULL AND shoot_label IS NOT NULL").join(text, "asset_id")
    rows = rows.withColumn("plain", F.array_join(columns.tokens(F.col("text")), " "))
    # what rounds to 0.35 may be a little below it
    pairs = links.alike_in_blocks(rows, ["record_kind", "shoot_date", "shoot_label"], "asset_id", "plain", 0.35 - 1e-4)
    return pairs.select("a", "b", F.round("score", 4).alias("score")).where("score >= 0.35")


@_query("v26_winner_per_name", "SELECT k, first(id ORDER BY mention_count DESC NULLS LAST, id) AS winner, count(*) AS n FROM (SELECT DISTINCT id, mention_count, trim(regexp_replace(lower(canonical_name), '[^a-z0-9]+', ' ', 'g')) AS k FROM places WHERE canonical_name IS NOT NULL) GROUP BY 1", "places")
def v26(p):
    rows = p.where("canonical_name IS NOT NULL").select("id", "mention_count", columns.normalise(F.col("canonical_name")).alias("k")).distinct()
    return rows.groupBy("k").agg(F.min(F.struct((-F.coalesce("mention_count", F.lit(-1))).alias("m"), "id")).alias("w"), F.count("*").alias("n")).select("k", F.col("w.id").alias("winner"), "n")


# --- streaming operators on batches


@_query("t1_sliding_counts", "SELECT event_type, to_timestamp(k * 2700)::TIMESTAMP AS window_start, to_timestamp(k * 2700 + 5400)::TIMESTAMP AS window_end, count(*) AS n FROM events, LATERAL (SELECT unnest([CAST(floor(epoch(ts) / 2700) AS BIGINT), CAST(floor(epoch(ts) / 2700) AS BIGINT) - 1]) AS k) GROUP BY ALL", "events")
def t1(e):
    return windows.sliding_counts(e, "ts", ["event_type"], "90 minutes", "45 minutes")


@_query("t2_tumbling_counts", "SELECT event_type, to_timestamp(floor(epoch(ts) / 420) * 420)::TIMESTAMP AS window_start, to_timestamp(floor(epoch(ts) / 420) * 420 + 420)::TIMESTAMP AS window_end, count(*) AS n FROM events GROUP BY ALL", "events")
def t2(e):
    return windows.tumbling_counts(e, "ts", ["event_type"], "7 minutes")


@_query("t3_session_counts", "WITH o AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS o FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), k AS (SELECT *, sum(o) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS k FROM o) SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL 30 MINUTE AS window_end, count(*) AS n FROM k GROUP BY user_id, k", "events")
def t3(e):
    return windows.session_counts(e, "ts", ["user_id"], "30 minutes")


@_query("t4_once_per_key", "SELECT count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events)", "events")
def t4(e):
    return windows.once_per_key(e, ["user_id", "event_type"], "ts").agg(F.count("*").alias("n"))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
