"""Questions over several layers of the catalogue; each takes the flat tables by name and returns a DataFrame.

Tables are those of ``plans.catalog.project`` beside frame_face (asset_id, frame_time_sec, p_id). Every order ends with
ids, so results are the same on every run.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldreel.functions.columns import blended_rank, like, score, truthy
from fieldreel.operators.joins import covered_seconds, interval_join
from fieldreel.operators.ranking import diversify
from fieldreel.operators.search import build_index, bm25, match
from fieldreel.operators.similarity import cosine_top_k, cosine_top_k_each, group_means
from fieldreel.session import cut_lineage, steady

Tables = Mapping[str, DataFrame]
#: Length of the stretches by which times of an asset meet.
WIDTH = 60.0


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def _gate(df: DataFrame, in_focus: bool, no_setup: bool) -> DataFrame:
    """A missing quality row counts as zero: it fails what must be set and passes what must not."""
    df = df.where(_zero("is_in_focus") == 1) if in_focus else df
    return df.where(_zero("is_setup_or_teardown") == 0) if no_setup else df


def _audio_gate(df: DataFrame, tables: Tables, usable: bool, not_windy: bool) -> DataFrame:
    """An asset without sound figures is not usable, but not windy either."""
    q = tables["audio_quality"].select("asset_id", "is_usable", "is_windy", "is_silent")
    df = df.join(q, "asset_id", "left")
    df = df.where(_zero("is_usable") == 1) if usable else df
    return df.where(_zero("is_windy") == 0) if not_windy else df


def faces_between(df: DataFrame, key: list[str], faces: DataFrame, start: str, end: str, tolerance: float, out: str = "on_camera") -> DataFrame:
    """``df`` with the sorted persons seen from start - tolerance to end + tolerance, bounds included; an empty array for nobody. ``key`` names a row and holds asset_id."""
    seen = faces.where("p_id IS NOT NULL").select("asset_id", F.col("p_id").alias("_p"), F.col("frame_time_sec").alias("_f"), F.col("frame_time_sec").alias("_g"))
    spans = df.select(*key, F.col(start).alias("_a"), F.col(end).alias("_b")).distinct()
    met = interval_join(spans, seen, "asset_id", ("_a", "_b"), ("_f", "_g"), width=WIDTH, tolerance=tolerance)
    found = met.groupBy(*key).agg(F.array_sort(F.collect_set("_p")).alias(out))
    return df.join(found, key, "left").withColumn(out, F.coalesce(out, F.array().cast("array<string>")))


def _quotes(tables: Tables) -> DataFrame:
    return tables["quote"].where("start_sec IS NOT NULL AND end_sec IS NOT NULL").withColumn("soundbite_score", score(F.col("soundbite_quality.score")))


def soundbites_with_face(tables: Tables, p_id: str, *, min_score: float = 4.0, topic: str | None = None, story_function: str | None = None, usable: bool = True, not_windy: bool = True, asset_type: str | None = None, limit: int = 30) -> DataFrame:
    """Scored quotes of a person who is on camera at that time, best first."""
    asset = tables["asset"] if asset_type is None else tables["asset"].where(F.col("asset_type") == asset_type)
    heard = tables["person_appearance"].where(F.col("p_id") == p_id).select("asset_id").distinct()
    q = _quotes(tables).where((F.col("speaker") == p_id) & (F.col("soundbite_score") >= min_score))
    q = q.where(F.contains(F.lower("text"), F.lit(topic.lower()))) if topic else q
    q = q.where(F.col("story_function") == story_function) if story_function else q
    q = q.join(heard, "asset_id", "left_semi").join(asset.select("asset_id", "filename", "shoot_label", "asset_type"), "asset_id")
    q = faces_between(_audio_gate(q, tables, usable, not_windy), ["asset_id", "quote_idx"], tables["frame_face"], "start_sec", "end_sec", 1.0)
    q = q.where(F.array_contains("on_camera", p_id))
    out = q.select("asset_id", "quote_idx", "filename", "shoot_label", "asset_type", "start_sec", "end_sec", "text", "soundbite_score", F.col("soundbite_quality.reasons").alias("reasons"), "story_function", "on_camera")
    return out.orderBy(F.desc("soundbite_score"), "asset_id", "quote_idx").limit(limit)


def _shots(tables: Tables, columns: list[str]) -> DataFrame:
    shots = tables["shot"].join(tables["asset"].select("asset_id", *columns), "asset_id")
    return shots.join(tables["shot_quality"], ["asset_id", "shot_idx"], "left")


def _at_place(df: DataFrame, tables: Tables, place_id: str | None) -> DataFrame:
    return df.join(tables["asset_place"].where(F.col("pl_id") == place_id).select("asset_id"), "asset_id", "left_semi") if place_id else df


def _places_of(df: DataFrame, tables: Tables) -> DataFrame:
    return df.join(tables["asset_place"].groupBy("asset_id").agg(F.array_join(F.array_sort(F.collect_set("pl_id")), ",").alias("place_ids")), "asset_id", "left")


def broll_with_quality(tables: Tables, *, place_id: str | None = None, location: str | None = None, in_focus: bool = True, no_setup: bool = True, aesthetic: bool = False, min_duration: float = 2.0, asset_type: str | None = "b_roll", limit: int = 30) -> DataFrame:
    """Shots at a place or location, by looks, sharpness and length."""
    if not place_id and not location:
        raise ValueError("give place_id or location")
    df = _shots(tables, ["record_kind", "filename", "shoot_label", "semantic_subject", "semantic_location", "asset_type"]).where((F.col("record_kind") == "video") & (F.col("duration_sec") >= min_duration))
    df = df.where(F.col("asset_type") == asset_type) if asset_type else df
    df = df.where(like(F.col("semantic_location"), location)) if location else df
    df = _gate(_at_place(df, tables, place_id), in_focus, no_setup)
    df = df.where(_zero("is_aesthetic") == 1) if aesthetic else df
    df = df.orderBy(_zero("is_aesthetic").desc(), _zero("sharpness_score").desc(), F.desc("duration_sec"), "asset_id", "shot_idx").limit(limit)
    return _places_of(df, tables)


_ORDERS = {
    "aesthetic": lambda: [_zero("aesthetic_score").desc(), _zero("sharpness_score").desc(), F.desc("duration_sec")], "sharpness": lambda: [_zero("sharpness_score").desc(), F.desc("duration_sec")],
    "duration": lambda: [F.desc("duration_sec"), _zero("sharpness_score").desc()], "blended": lambda: [F.desc("blended")],
}


def broll(
    tables: Tables, *, place_id: str | None = None, location: str | None = None, caption: str | None = None, subject: str | None = None, similar_assets: DataFrame | None = None, movement: list[str] | None = None, no_people: bool = False, people: list[str] | None = None,
    audio_state: str = "any", no_text: bool = False, no_bibs: bool = False, in_focus: bool = True, no_setup: bool = True, min_aesthetic: float | None = None, min_duration: float = 2.0, rank_by: str = "blended", by_shoot: bool = False, asset_type: str | None = "b_roll", limit: int = 30,
) -> DataFrame:
    """Shots that pass all given conditions, ranked, with what else is known of them. ``similar_assets`` (asset_id) is the result of a vector search; empty, it gives nothing."""
    if not any((place_id, location, caption, subject, similar_assets is not None)):
        raise ValueError("give a place, location, caption, subject or similar assets")
    if rank_by not in _ORDERS or audio_state not in ("any", "silent", "usable"):
        raise ValueError("unknown rank_by or audio_state")
    df = _shots(tables, ["record_kind", "filename", "shoot_label", "shoot_date", "asset_type", "semantic_subject", "semantic_location"]).where((F.col("record_kind") == "video") & (F.col("duration_sec") >= min_duration))
    shot = ["asset_id", "shot_idx"]
    df = df.where(F.col("asset_type") == asset_type) if asset_type else df
    df = _at_place(df, tables, place_id)
    df = df.where(like(F.col("semantic_location"), location)) if location else df
    df = df.where(like(F.col("semantic_subject"), subject)) if subject else df
    df = df.join(tables["dense_caption"].where(like(F.col("caption_text"), caption)).select(*shot), shot, "left_semi") if caption else df
    df = df.join(similar_assets.select("asset_id"), "asset_id", "left_semi") if similar_assets is not None else df
    chunks = tables["asset_semantic_chunk"].select("asset_id", F.col("camera_movement"), F.col("start_sec").alias("_cs"), F.col("end_sec").alias("_ce"))
    spans = lambda d: d.select(*shot, "start_sec", "end_sec")
    if movement:
        moving = chunks.where(reduce(lambda a, b: a | b, (like(F.col("camera_movement"), m) for m in movement)))
        df = df.join(interval_join(spans(df), moving, "asset_id", ("start_sec", "end_sec"), ("_cs", "_ce"), width=WIDTH).select(*shot), shot, "left_semi")
    q = tables["audio_quality"]
    if audio_state != "any":
        good = q.where("is_silent = 1") if audio_state == "silent" else q.where((F.col("is_usable") == 1) & (_zero("is_silent") == 0))
        df = df.join(good.select("asset_id"), "asset_id", "left_semi")
    df = df.join(tables["frame_text"].select(*shot), shot, "left_anti") if no_text else df
    df = df.join(tables["bib_hit"].select(*shot), shot, "left_anti") if no_bibs else df
    df = _gate(df, in_focus, no_setup)
    df = df.where(_zero("aesthetic_score") >= min_aesthetic) if min_aesthetic is not None else df
    df = faces_between(df, shot, tables["frame_face"], "start_sec", "end_sec", 0.5)
    df = df.where(F.size("on_camera") == 0) if no_people else df
    df = df.where(reduce(lambda a, b: a & b, (F.array_contains("on_camera", p) for p in people))) if people else df
    df = df.withColumn("blended", blended_rank(F.col("aesthetic_score"), F.col("sharpness_score"), F.col("duration_sec")))
    order = [*_ORDERS[rank_by](), F.col("asset_id"), F.col("shot_idx")]
    if by_shoot:
        df = diversify(df.withColumn("_shoot", F.coalesce("shoot_label", F.lit("_unknown"))), "_shoot", order, limit, over_fetch=limit * 5).drop("_shoot")
    else:
        df = df.orderBy(*order).limit(limit)
    first_caption = tables["dense_caption"].groupBy(*shot).agg(F.min_by("caption_text", F.struct("sample_pos", "caption_text")).alias("dense_caption_text"))
    first_move = interval_join(spans(df), chunks, "asset_id", ("start_sec", "end_sec"), ("_cs", "_ce"), width=WIDTH).groupBy(*shot).agg(F.min_by("camera_movement", F.struct("_cs", "_ce")).alias("camera_movement"))
    state = F.when(F.col("asset_known").isNull(), "unknown").when(_zero("is_silent") == 1, "silent").when(_zero("is_usable") == 1, "usable").otherwise("unusable")
    df = df.join(first_caption, shot, "left").join(first_move, shot, "left").join(q.select("asset_id", "is_silent", "is_usable", F.lit(1).alias("asset_known")), "asset_id", "left").withColumn("audio_state", state)
    for name, table in (("has_visible_text", "frame_text"), ("has_bib", "bib_hit")):
        df = df.join(tables[table].select(*shot).distinct().withColumn(name, F.lit(True)), shot, "left").withColumn(name, F.coalesce(name, F.lit(False)))
    return _places_of(df.drop("is_silent", "is_usable", "asset_known", "record_kind"), tables).withColumn("blended_score", F.bround("blended", 4)).drop("blended")


def caption_matches(tables: Tables, text: str, *, p_id: str | None = None, in_focus: bool = True, no_setup: bool = True, asset_type: str | None = None, limit: int = 30, exact: bool = False) -> DataFrame:
    """Captions that hold a text, sharpest first. With a person, three times the limit is looked at before the faces, unless ``exact``."""
    if not text.strip():
        raise ValueError("give a text")
    df = tables["dense_caption"].where(like(F.col("caption_text"), text)).join(tables["asset"].select("asset_id", "filename", "shoot_label", "asset_type"), "asset_id").join(tables["shot_quality"], ["asset_id", "shot_idx"], "left")
    df = _gate(df.where(F.col("asset_type") == asset_type) if asset_type else df, in_focus, no_setup)
    order = [_zero("sharpness_score").desc(), F.col("asset_id"), F.col("shot_idx"), F.col("frame_time_sec"), F.col("sample_pos")]
    df = df.orderBy(*order).limit(limit * 3 if p_id else limit) if not (exact and p_id) else df
    df = faces_between(df, ["asset_id", "frame_time_sec"], tables["frame_face"], "frame_time_sec", "frame_time_sec", 1.0)
    df = df.where(F.array_contains("on_camera", p_id)) if p_id else df
    return df.orderBy(*order).limit(limit)


def funny_moments(tables: Tables, *, p_id: str | None = None, comedy_type: str | None = None, min_confidence: float = 0.5, usable: bool = True, not_windy: bool = True, limit: int = 30) -> DataFrame:
    """Comic quotes with somebody on camera, by the linked moment or else by the faces seen, surest first."""
    asset = tables["asset"].where("record_kind = 'video' AND has_machine_transcript = 1").select("asset_id", "filename", "shoot_label", "asset_type")
    q = _quotes(tables).withColumn("comedy_confidence", score(F.col("comedic.confidence"))).where(truthy(F.col("comedic.is_comedic")) & (F.col("comedy_confidence") >= min_confidence))
    q = q.where(F.col("comedic.type") == comedy_type) if comedy_type else q
    q = _audio_gate(q.join(asset, "asset_id"), tables, usable, not_windy)
    moment = F.when(F.col("linked_moment_idx") >= 0, F.get("key_moments", F.col("linked_moment_idx")))
    q = faces_between(q.withColumn("_m", moment), ["asset_id", "quote_idx"], tables["frame_face"], "start_sec", "end_sec", 1.0)
    q = q.withColumn("on_camera", F.when(F.size("_m.subjects_on_camera") > 0, F.col("_m.subjects_on_camera")).otherwise(F.col("on_camera"))).where(F.size("on_camera") > 0)
    q = q.where(F.array_contains("on_camera", p_id)) if p_id else q
    out = q.select("asset_id", "quote_idx", "filename", "shoot_label", "asset_type", "start_sec", "end_sec", "text", F.col("speaker").alias("speaker_p_id"), F.col("comedic.type").alias("comedy_type"), "comedy_confidence", "story_function", F.col("_m.label").alias("moment_label"), "on_camera")
    return out.orderBy(F.desc("comedy_confidence"), "asset_id", "quote_idx").limit(limit)


def bib_appearances(tables: Tables, *, bib_number: str | None = None, p_id: str | None = None, in_focus: bool = True, no_setup: bool = True, asset_type: str | None = None, limit: int = 30) -> DataFrame:
    if not bib_number and not p_id:
        raise ValueError("give bib_number or p_id")
    df = tables["bib_hit"].drop("record_kind").join(tables["asset"].select("asset_id", "filename", "shoot_label", "asset_type"), "asset_id").join(tables["shot_quality"].select("asset_id", "shot_idx", "sharpness_score", "is_in_focus", "is_setup_or_teardown"), ["asset_id", "shot_idx"], "left")
    for column, value in (("bib_number", bib_number), ("p_id", p_id), ("asset_type", asset_type)):
        df = df.where(F.col(column) == value) if value else df
    df = _gate(df, in_focus, no_setup).orderBy(F.desc("confidence"), _zero("sharpness_score").desc(), "asset_id", "frame_time_sec", "bib_number").limit(limit)
    return faces_between(df, ["asset_id", "frame_time_sec"], tables["frame_face"], "frame_time_sec", "frame_time_sec", 1.0)


def quotes_about(tables: Tables, query: str, *, speaker: str | None = None, min_score: float | None = None, story_function: str | None = None, limit: int = 30, exact: bool = False) -> DataFrame:
    """Segments that a text query matches, with the first quote that shares a whole second; scored ones first.

    With a condition on quotes, four times the limit is looked at, in order of relevance, unless ``exact``.
    """
    seg = tables["segment"].withColumn("doc", F.struct("asset_id", "seg_idx"))
    index = build_index(seg, "doc", "text")
    hits = match(index, query).join(bm25(index, query, match_all=False), "doc", "left").join(seg, "doc")
    hits = hits.where(F.col("speaker_p_id") == speaker) if speaker else hits
    conditioned = min_score is not None or story_function is not None
    order = [F.desc_nulls_last("score"), F.col("asset_id"), F.col("seg_idx")]
    hits = hits if exact else hits.orderBy(*order).limit(limit * 4 if conditioned else limit)
    quotes = covered_seconds(_quotes(tables).select("asset_id", "quote_idx", "start_sec", "end_sec", "soundbite_score", F.col("story_function").alias("quote_function")), "start_sec", "end_sec")
    quotes = quotes.groupBy("asset_id", "second").agg(F.min_by(F.struct("quote_idx", "soundbite_score", "quote_function"), "quote_idx").alias("q"))
    heard = covered_seconds(hits.select("asset_id", "seg_idx", "start_sec", "end_sec"), "start_sec", "end_sec").join(quotes, ["asset_id", "second"])
    heard = heard.groupBy("asset_id", "seg_idx").agg(F.min_by("q", "second").alias("q"))
    out = hits.join(heard, ["asset_id", "seg_idx"], "left").join(tables["asset"].select("asset_id", "filename", "shoot_label", "asset_type"), "asset_id")
    out = out.select("asset_id", "seg_idx", "start_sec", "end_sec", "text", "speaker_p_id", "filename", "shoot_label", "asset_type", F.col("score").alias("relevance"), F.col("q.soundbite_score").alias("soundbite_score"), F.col("q.quote_function").alias("story_function"), F.col("q").isNotNull().alias("has_quote"))
    out = out.where(F.col("soundbite_score") >= min_score) if min_score is not None else out
    out = out.where(F.col("story_function") == story_function) if story_function else out
    return out.orderBy(F.col("soundbite_score").isNull(), F.desc("soundbite_score"), F.desc("relevance"), "asset_id", "seg_idx").limit(limit)


def asset_allowlist(tables: Tables, *, bucket: str | None = None, asset_type: str | None = None, record_kind: str | None = "video", date_from: str | None = None, date_to: str | None = None, place_id: str | None = None, person_ids: list[str] | None = None, exclude: list[str] | None = None, camera_movement: str | None = None, shot_size: str | None = None) -> DataFrame:
    """Ids of the assets that meet all given conditions; dates are compared as texts, both ends included."""
    df = tables["asset"]
    same = lambda c, v: F.lower(F.col(c)) == v.lower()
    conditions = [F.col("record_kind") == record_kind if record_kind else None, same("bucket", bucket) if bucket else None, same("asset_type", asset_type) if asset_type else None, F.col("shoot_date") >= date_from if date_from else None, F.col("shoot_date") <= date_to if date_to else None, ~F.col("asset_id").isin(exclude) if exclude else None]
    df = reduce(lambda d, c: d if c is None else d.where(c), conditions, df)
    df = _at_place(df, tables, place_id)
    df = df.join(tables["person_appearance"].where(F.col("p_id").isin(person_ids)).select("asset_id"), "asset_id", "left_semi") if person_ids else df
    for column, value in (("camera_movement", camera_movement), ("camera_shot_size", shot_size)):
        df = df.join(tables["asset_semantic_chunk"].where(same(column, value)).select("asset_id"), "asset_id", "left_semi") if value else df
    return df.select("asset_id").distinct()


def search_broll(tables: Tables, *, place_id: str | None = None, location: str | None = None, limit: int = 50) -> DataFrame:
    """Additional footage by its type, bucket or notes, newest first."""
    chunk = tables["asset_semantic_chunk"]
    noted = chunk.where(like(F.col("editorial_notes"), "b-roll") | like(F.col("action"), "b-roll")).select("asset_id").distinct().withColumn("_noted", F.lit(True))
    df = tables["asset"].where("record_kind = 'video'").join(noted, "asset_id", "left")
    df = df.where(F.coalesce(F.lower("asset_type").isin("b_roll", "broll", "b-roll") | like(F.col("bucket"), "broll") | like(F.col("semantic_editorial_notes"), "b-roll"), F.lit(False)) | F.coalesce("_noted", F.lit(False)))
    df = _at_place(df, tables, place_id)
    if location:
        at = chunk.where(like(F.col("setting_location"), location)).select("asset_id").distinct().withColumn("_at", F.lit(True))
        df = df.join(at, "asset_id", "left").where(F.coalesce(like(F.col("semantic_location"), location), F.lit(False)) | F.coalesce("_at", F.lit(False)))
    return df.select("asset_id", "filename", "source_path", "duration_sec", "semantic_location", "semantic_subject", "shoot_date").distinct().orderBy(F.desc("shoot_date"), "asset_id").limit(limit)


def search_transcript(tables: Tables, query: str, limit: int = 40) -> DataFrame:
    """Segments that hold all words of the query, most relevant first."""
    seg = tables["segment"].withColumn("doc", F.struct("asset_id", "seg_idx"))
    found = bm25(build_index(seg, "doc", "text"), query)
    return found.join(seg, "doc").select("asset_id", "seg_idx", "start_sec", "end_sec", "text", "speaker_p_id", "score").orderBy(F.desc("score"), "asset_id", "seg_idx").limit(limit)


def similar_transcript_windows(windows: DataFrame, query: list[float], k: int = 25) -> DataFrame:
    """Windows of the latest run most similar to a vector (run_id, id, vector ..)."""
    latest = windows.agg(F.max("run_id").alias("run_id"))
    return cosine_top_k(windows.join(F.broadcast(latest), "run_id", "left_semi"), "vector", query, k, [F.col("id")])  # one row


def similar_transcript_windows_each(windows: DataFrame, queries: DataFrame, k: int = 25) -> DataFrame:
    """Rows (q_id, id, asset_id, cosine, rank): windows of the latest run most similar to each query (q_id, q), itself included."""
    latest = windows.agg(F.max("run_id").alias("run_id"))
    rows = windows.join(F.broadcast(latest), "run_id", "left_semi")  # one row
    return cosine_top_k_each(rows, "id", "vector", queries, "q_id", "q", k).join(rows.select("id", "asset_id"), "id")


def visually_similar(frames: DataFrame, chunks: DataFrame, *, chunk_id: str | None = None, asset_id: str | None = None, vector: list[float] | None = None, k: int = 20, allowed: DataFrame | None = None) -> DataFrame:
    """Chunks most similar to a chunk, to the mean of an asset's chunks, or to a vector; the seed's own are left out; an unknown seed gives nothing."""
    means = group_means(frames, "chunk_id", "vector").join(chunks.select("chunk_id", F.col("parent_asset_id").alias("asset_id"), "chunk_start_sec", "chunk_end_sec").dropDuplicates(["chunk_id"]), "chunk_id")
    if vector is None:
        seed = means.where(F.col("chunk_id") == chunk_id) if chunk_id else means.where(F.col("asset_id") == asset_id)
        row = group_means(seed.withColumn("_all", F.lit(1)), "_all", "vector").first()
        if row is None:
            return means.limit(0).withColumn("cosine", F.lit(0.0))
        vector = row["vector"]
        means = means.where(F.col("chunk_id") != chunk_id) if chunk_id else means.where(F.col("asset_id") != asset_id)
    return cosine_top_k(means, "vector", vector, k, [F.col("chunk_id")], allowed, "asset_id")


def visually_similar_each(frames: DataFrame, chunks: DataFrame, seeds: DataFrame, k: int = 20) -> DataFrame:
    """Rows (q_id, chunk_id, asset_id, cosine, rank): chunks most similar to each seed (chunk_id), without the seed itself; an unknown seed gives nothing."""
    owner = chunks.select("chunk_id", F.col("parent_asset_id").alias("asset_id")).dropDuplicates(["chunk_id"])
    means = cut_lineage(group_means(frames, "chunk_id", "vector").join(owner, "chunk_id"))
    queries = means.join(seeds, "chunk_id", "left_semi").select(F.col("chunk_id").alias("q_id"), F.col("vector").alias("q"))
    found = cosine_top_k_each(means, "chunk_id", "vector", queries, "q_id", "q", k, apart=("q_id", "chunk_id"))
    return found.join(means.select("chunk_id", "asset_id"), "chunk_id")


# Words by which a moment is clean or spoiled.
CLEAN = ("clean", "static", "wide", "stable", "settled", "establishing", "reveal", "centered", "in focus", "racks focus")
SPOILED = ("pan", "drift", "whip", "sigh", "handheld", "shake", "tilt", "wobble", "out of focus", "blurry", "obscur")


def moment_class(description: Column) -> Column:
    """negative if a spoiling word stands in it, else positive for a good one, else neutral."""
    low = F.lower(F.coalesce(description, F.lit("")))
    any_of = lambda ws: reduce(lambda a, b: a | b, (F.contains(low, F.lit(w)) for w in ws))
    return F.when(any_of(SPOILED), "negative").when(any_of(CLEAN), "positive").otherwise("neutral")


def source_windows(assets: DataFrame, moments: DataFrame, target: float, *, buffer: float = 1.0, offset: float = 2.0) -> DataFrame:
    """Rows (asset_id, source_in, source_out): for every asset (asset_id, duration_sec, camera_movement) a clean window of the wanted length.

    From a second after the first good moment with room up to the next spoiled one or the end; else the largest gap
    between spoiled ones; without moments after a short head, none for a static camera.
    """
    steady(assets.sparkSession)
    m = moments.where("timestamp_sec IS NOT NULL").join(assets.select("asset_id", "duration_sec"), "asset_id").select("asset_id", "duration_sec", F.col("timestamp_sec").alias("t"), moment_class(F.col("description")).alias("c"))
    w = Window.partitionBy("asset_id").orderBy("t", "c")
    bad = F.when(F.col("c") == "negative", F.col("t"))
    later = F.min(bad).over(Window.partitionBy("asset_id").orderBy(F.round(F.col("t") * 1_000).cast("bigint")).rangeBetween(round(buffer * 1_000) + 11, Window.unboundedFollowing))
    good = m.withColumn("next", F.coalesce(later, "duration_sec")).where((F.col("c") == "positive") & (F.col("next") - F.col("t") - buffer >= target))
    good = good.groupBy("asset_id").agg(F.min("t").alias("t")).select("asset_id", (F.col("t") + buffer).alias("good"))
    negative = m.where("c = 'negative'")
    edges = negative.select("asset_id", "duration_sec", (F.col("t") + buffer).alias("a"), F.coalesce(F.lead("t").over(w), "duration_sec").alias("b"))
    heads = m.groupBy("asset_id", "duration_sec").agg(F.coalesce(F.min(bad), F.col("duration_sec")).alias("b")).select("asset_id", "duration_sec", F.lit(0.0).alias("a"), "b")
    start = F.least(F.lit(target), F.col("duration_sec"))
    gaps = heads.union(edges).where(F.col("b") - F.col("a") > start)
    best = gaps.groupBy("asset_id").agg(F.max_by(F.struct("a", "b"), F.struct(F.col("b") - F.col("a"), -F.col("a"))).alias("g")).select("asset_id", F.col("g.a").alias("gap_in"), F.col("g.b").alias("gap_out"))
    known = m.select("asset_id").distinct().withColumn("has", F.lit(True))
    df = assets.join(known, "asset_id", "left").join(good, "asset_id", "left").join(best, "asset_id", "left")
    d = F.coalesce("duration_sec", F.lit(0.0))
    head = F.least(F.when(F.lower("camera_movement") == "static", 0.0).otherwise(offset), F.greatest(F.lit(0.0), d - target))
    source_in = F.when(d <= 0, 0.0).when(F.col("has").isNull(), head).when(F.col("good").isNotNull(), F.col("good")).otherwise(F.coalesce("gap_in", F.lit(0.0)))
    out = F.when(d <= 0, F.lit(target)).otherwise(F.least(source_in + target, F.when(F.col("good").isNull(), F.col("gap_out")), d))
    return df.select("asset_id", F.bround(source_in, 3).alias("source_in"), F.bround(out, 3).alias("source_out"))


def used_assets(clips: DataFrame, paths: DataFrame) -> DataFrame:
    """Rows (asset_id, sequences): assets that timelines use, by path or else by unique file name. ``clips``: sequence, path. ``paths``: asset_id, path."""
    from fieldreel.operators.joins import cascade

    tail = lambda c: F.lower(F.element_at(F.split(F.regexp_replace(c, r"\\", "/"), "/"), -1))
    whole = lambda c: F.lower(F.regexp_replace(c, r"\\", "/"))
    known = paths.select("asset_id", whole(F.col("path")).alias("whole"), tail(F.col("path")).alias("tail"))
    found = cascade(clips, "path", [(whole(F.col("path")), known, "whole", "asset_id"), (tail(F.col("path")), known, "tail", "asset_id")], "asset_id")
    return found.where("asset_id IS NOT NULL").groupBy("asset_id").agg(F.array_sort(F.collect_set("sequence")).alias("sequences"))


def filter_unused(df: DataFrame, used: DataFrame) -> DataFrame:
    return df.join(used.select("asset_id"), "asset_id", "left_anti")


def annotate_usage(df: DataFrame, used: DataFrame) -> DataFrame:
    return df.join(used, "asset_id", "left").withColumn("sequences", F.coalesce("sequences", F.array().cast("array<string>")))


def audit_cut(clips: DataFrame, assets: DataFrame, notes: DataFrame, fps: float = 24_000 / 1_001) -> DataFrame:
    """Rows (clip_id, flag) of what is wrong with the clips of a timeline.

    ``clips``: clip_id, asset_id, pathurl, start, end, source_in, source_out (frames), rationale. ``assets``: asset_id,
    duration_sec. ``notes``: asset_id, avoid_start, avoid_end (seconds; null for notes without times).
    """
    seconds = lambda c: F.col(c) / fps
    known = clips.join(assets.select("asset_id", "duration_sec"), "asset_id", "left").join(notes.select("asset_id").distinct().withColumn("_noted", F.lit(True)), "asset_id", "left")
    flags = F.array_compact(F.array(
        F.when(F.col("pathurl").isNull(), "GRAPHIC"), F.when(F.col("pathurl").isNotNull() & F.col("duration_sec").isNull(), "UNRESOLVED_ASSET"), F.when((F.col("start") == -1) | (F.col("end") == -1), "TRANSITION_SENTINEL"),
        F.when(seconds("source_out") > F.col("duration_sec") + 0.05, "SOURCE_OUT_OF_BOUNDS"), F.when(F.col("duration_sec").isNotNull() & F.col("_noted").isNull(), "NOTES_MISSING"), F.when(F.coalesce(F.trim("rationale"), F.lit("")) == "", "RATIONALE_MISSING"),
    ))
    own = known.select("clip_id", F.explode(flags).alias("flag"))
    spans = clips.select("clip_id", "asset_id", seconds("source_in").alias("_a"), seconds("source_out").alias("_b"))
    hit = interval_join(spans, notes.where("avoid_start IS NOT NULL"), "asset_id", ("_a", "_b"), ("avoid_start", "avoid_end"), width=WIDTH)
    hit = hit.where(F.least("_b", "avoid_end") - F.greatest("_a", "avoid_start") > 0.5).select("clip_id", F.lit("AVOID_WINDOW_HIT").alias("flag")).distinct()
    return own.union(hit)


def suggested_spans(windows: DataFrame, moments: DataFrame, before: float = 2.0, after: float = 8.0) -> DataFrame:
    """``windows`` (id, asset_id, start, end) with the span around their first moment, cut to the window; null without one."""
    m = moments.where("timestamp_sec IS NOT NULL").select("asset_id", F.col("timestamp_sec").alias("_t"), F.col("timestamp_sec").alias("_u"))
    first = interval_join(windows.select("id", "asset_id", "start", "end"), m, "asset_id", ("start", "end"), ("_t", "_u"), width=WIDTH).groupBy("id").agg(F.min("_t").alias("_m"))
    return windows.join(first, "id", "left").select(*windows.columns, F.greatest("start", F.when(F.col("_m").isNotNull(), F.col("_m") - before)).alias("_in"), F.least("end", F.col("_m") + after).alias("_out"), "_m").select(*windows.columns, F.when(F.col("_m").isNotNull(), F.col("_in")).alias("span_in"), F.when(F.col("_m").isNotNull(), F.col("_out")).alias("span_out"))
