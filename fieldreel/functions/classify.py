"""Threshold flags and first-match classifiers over rows of measurements and paths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldreel.functions.columns import clamp

# Thresholds of the audio flags (decibels and shares) and of the shot flags.
SILENT_DB, SILENT_SHARE, QUIET_DB, CLIP_SHARE, CLIP_PEAK_DB, WINDY_SHARE, LEAST_AUDIO_SEC = -45.0, 0.9, -30.0, 0.001, -1.0, 0.4, 1.0
BLURRY_BELOW, DARK_BELOW, BLOWN_ABOVE, BLOWN_CLIP, SETUP_SEC = 100.0, 30.0, 225.0, 0.05, 5.0


def first_match(rules: list[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """The value of the first rule that holds."""
    chain = reduce(lambda c, r: c.when(*r), rules[1:], F.when(*rules[0]))
    return chain.otherwise(otherwise)


def _flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("int")


def audio_flags(rms: Column, peak: Column, clipping: Column, silence: Column, low: Column, duration: Column) -> dict[str, Column]:
    """is_silent, is_quiet, is_clippy, is_windy and is_usable as 0 or 1."""
    silent = F.coalesce((rms < SILENT_DB) | (silence > SILENT_SHARE), F.lit(False))
    clippy = F.coalesce((clipping > CLIP_SHARE) | (peak > CLIP_PEAK_DB), F.lit(False))
    return {"is_silent": _flag(silent), "is_quiet": _flag(~silent & (rms < QUIET_DB)), "is_clippy": _flag(clippy), "is_windy": _flag((low > WINDY_SHARE) & ~silent), "is_usable": _flag(~silent & ~clippy & (duration >= LEAST_AUDIO_SEC))}


def shot_flags(sharpness: Column, exposure: Column, clipping: Column, duration: Column, at_edge: Column) -> dict[str, Column]:
    """is_blurry, is_dark, is_blown, is_in_focus and is_setup_or_teardown as 0 or 1; ``at_edge`` says first or last shot."""
    return {"is_blurry": _flag(sharpness < BLURRY_BELOW), "is_dark": _flag(exposure < DARK_BELOW), "is_blown": _flag((exposure > BLOWN_ABOVE) | (clipping > BLOWN_CLIP)), "is_in_focus": _flag(sharpness >= BLURRY_BELOW), "is_setup_or_teardown": _flag(at_edge & (duration <= SETUP_SEC))}


# Kinds of footage and the pattern of a lower-case path that speaks of each, in order.
ASSET_TYPES = (
    ("court_recordings", r"hearing|trial[ _-]audio|courtroom"),
    ("b_roll", r"b[- ]roll|(^|[\\/_.-])broll([\\/_.-]|$)|stock vids"),
    ("third_party", r"(^|[\\/])(podcasts?|adobe podcast)([\\/]|$)"),
    ("interview", r"\binterviews?\b| int "),
    ("timelapse", r"time[- ]?lapse"),
    ("archival", r"archival|\bhistory\b"),
    ("third_party", r"\bpodcasts?\b|(^|[\\/_. -])news($|[\\/_. -])"),
)

# Patterns of a sound file's path, the role they speak for, and the reason that is given.
RECORDERS = (
    (r"(?i)DJI_\d+_\d{8}_\d{6}\.WAV$", "audio_source", "DJI Mic 2 wireless lavalier"),
    (r"(?i)\.RDC[/\\][^/\\]+\.wav$", "audio_source", "RED .RDC bundle XLR-input audio"),
    (r"(?i)Tentacle\s*Track", "audio_source", "Tentacle Track production bag recorder"),
    (r"(?i)ZOOM\d+", "audio_source", "Zoom handheld recorder"),
    (r"(?i)^(?=.*[/\\]Audio[/\\]).*C\d{4}[^/\\]*\.(wav|mp3)$", "audio_source", "Sony PCM handheld recorder in Audio/ folder"),
    (r"(?i)[/\\]Audio[/\\]", "audio_source", "production audio folder (unrecognized recorder)"),
)
NO_PATH, NO_RECORDER = ("audio_overlap", "no path"), ("audio_overlap", "no production-audio signal in path")


def asset_type(path: Column) -> Column:
    """Kind of footage that a path speaks of, by the first pattern that it meets; verite if none."""
    p = F.lower(F.coalesce(path, F.lit("")))
    return first_match([(p.rlike(pattern), kind) for kind, pattern in ASSET_TYPES], "verite")


def asset_bucket(path: Column, third_party_tops: list[str], has_human: Column) -> Column:
    """third_party by podcast path or top folder, in_house_priority with a human transcript, else in_house_other."""
    p = F.lower(F.regexp_replace(F.coalesce(path, F.lit("")), r"\\", "/"))
    top = F.regexp_extract(p, r"^/*([^/]+)", 1)
    return first_match([(p.rlike(r"\bpodcasts?\b") | top.isin([t.lower() for t in third_party_tops]), "third_party"), (F.coalesce(has_human, F.lit(False)), "in_house_priority")], "in_house_other")


def camera_id(filename: Column) -> Column:
    """Camera family by file name; a letter and four digits name a body by its first digit."""
    base = F.upper(F.coalesce(filename, F.lit("")))
    body = F.concat(F.lit("sony_"), F.lower(F.left(base, F.lit(1))), F.substring(base, 2, 1), F.lit("xxx"))
    chain = F.when(base.startswith("IMG_"), "iphone").when(base.startswith("DJI_"), "dji").when(base.rlike("^G[XHP]"), "gopro").when(base.rlike(r"^[A-Z]\d{4}"), body)
    return chain.when(base.endswith(".R3D"), "red").otherwise("unknown")


def recorder_role(path: Column) -> Column:
    """Struct (role, reason): whether a sound file comes from a recorder of its own or from a camera."""
    p = F.coalesce(path, F.lit(""))
    of = lambda role, why: F.struct(F.lit(role).alias("role"), F.lit(why).alias("reason"))
    chain = reduce(lambda c, r: c.when(p.rlike(r[0]), of(r[1], r[2])), RECORDERS, F.when(p == "", of(*NO_PATH)))
    return chain.otherwise(of(*NO_RECORDER))


# How transfer and primaries of a video stream are named by the probe.
def color_profile(primaries: Column, transfer: Column) -> Column:
    cp, ct = F.lower(F.coalesce(primaries, F.lit(""))), F.lower(F.coalesce(transfer, F.lit("")))
    unsaid = ct.isin("", "unknown", "reserved")
    return first_match([
        (ct == "smpte2084", "hdr_pq"), (ct == "arib-std-b67", "hdr_hlg"), (ct == "bt709", "rec709"), ((cp == "bt2020") & unsaid, "log_likely"), (cp == "bt2020", "wide_gamut"),
        (cp.isin("bt709", "smpte170m") & (unsaid | ct.isin("smpte170m", "iec61966-2-1")), "rec709"),
    ], "unknown")


def duration_bucket(duration: Column, label: Column) -> Column:
    """Band of a clip by half an hour and ten minutes, and by what its label speaks of."""
    low = F.lower(F.coalesce(label, F.lit("")))
    interview, call = low.contains("interview") | low.contains(" int"), low.contains("call")
    long, mid = duration >= 1_800, duration >= 600
    return first_match([(long & interview, "interview_long"), (long & call, "call_short"), (long, "verite"), (mid & interview, "interview_mid"), (mid & call, "call_short")], "verite")


def speaker_confidence(duration: Column, cluster_seconds: Column, mapped: Column) -> Column:
    """Struct (confidence, level) of a segment's speaker by its length and the seconds that support the cluster's person."""
    unmapped = 0.15 + F.least(F.lit(0.15), F.greatest(F.lit(0.0), duration - 2) / 20)
    value = F.when(mapped, 0.35 + 0.35 * clamp((duration - 0.8) / 6) + 0.30 * clamp((cluster_seconds - 10) / 120)).otherwise(unmapped)
    high, medium = mapped & (duration >= 4) & (cluster_seconds >= 60), mapped & (duration >= 2) & (cluster_seconds >= 20)
    bound = F.when(high, F.greatest(value, F.lit(0.85))).when(medium, F.greatest(value, F.lit(0.60))).otherwise(F.least(value, F.lit(0.59)))
    return F.struct(F.bround(clamp(bound), 4).alias("confidence"), F.when(high, "high").when(medium, "medium").otherwise("low").alias("level"))


def path_metadata(path: Column) -> Column:
    """Struct (top_level, shoot_date, shoot_label, category_number, category_name, sub_location) of a path's folders.

    A first folder YYYY-M-D_label names a day of shooting, if it is a real day; a first folder 'N. name' a category.
    """
    p = F.regexp_replace(F.coalesce(path, F.lit("")), r"\\", "/")
    top, second = F.regexp_extract(p, r"^/*([^/]+)/", 1), F.regexp_extract(p, r"^/*[^/]+/([^/]+)/", 1)
    day = lambda k: F.regexp_extract(top, r"^(\d{4})-(\d{1,2})-(\d{1,2})[_ -]?(.*)$", k)
    iso = F.try_to_date(F.concat_ws("-", day(1), F.lpad(day(2), 2, "0"), F.lpad(day(3), 2, "0")), "yyyy-MM-dd")
    cat = lambda k: F.regexp_extract(top, r"^(\d+)[._ -]+([^\d].*)$", k)
    dated, numbered = (day(1) != "") & iso.isNotNull(), (day(1) == "") & (cat(1) != "")
    return F.struct(
        F.when(dated, "shoot_day").when(numbered, "category").otherwise("other").alias("top_level"), F.when(dated, iso.cast("string")).alias("shoot_date"), F.when(dated, F.nullif(day(4), F.lit(""))).alias("shoot_label"),
        F.when(numbered, cat(1).cast("int")).alias("category_number"), F.when(numbered, F.trim(cat(2))).alias("category_name"), F.when(numbered, F.nullif(second, F.lit(""))).alias("sub_location"),
    )
