"""Queries of the general data-cleaning operators, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldreel.operators.intervals import periods_and_gaps, whole_ms
from fieldreel.operators.timestamps import estimate_histories, to_utc
from fieldreel.session import read

#: Table and column of the written dates.
DATES = (("asset", "primary_timeline_date"), ("asset", "shoot_date"), ("semantic_stills", "shoot_date"))
WINDOWS = (("audio_event", "window_start_sec", "window_end_sec"), ("segment", "start_sec", "end_sec"))


def _dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct rows (store, field, asset_id, camera_id, value); both columns of ``asset`` come from one scan."""
    parts = []
    for table in dict.fromkeys(t for t, _ in DATES):
        fields = [f for t, f in DATES if t == table]
        rows = read(spark, sf_dir, table).select("asset_id", "camera_id", F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields))).alias("x"))
        parts.append(rows.select(F.lit(table).alias("store"), "x.field", "asset_id", "camera_id", "x.value"))
    return parts[0].union(parts[1]).where("value IS NOT NULL").distinct()


def _instants(rows: DataFrame, clocks: DataFrame) -> DataFrame:
    """Rows (store, field, asset_id, value, utc_us) of values that name a real day or moment; ``clocks`` (camera_id, clock_zone) is joined as its size allows."""
    known = rows.where("camera_id IS NOT NULL").join(clocks, "camera_id", "left").select("store", "field", "asset_id", "value", "clock_zone")
    rows = known.union(rows.where("camera_id IS NULL").select("store", "field", "asset_id", "value", F.lit(None).cast("string")))
    # exploding drops nulls; a filter would be pushed down and inline the whole parsing into itself
    return to_utc(rows, "value", "clock_zone").select("store", "field", "asset_id", "value", F.explode(F.array_compact(F.array("utc_us"))).alias("utc_us"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    clocks = read(spark, sf_dir, "camera_clock").select("camera_id", "clock_zone").distinct()
    return _instants(_dates(spark, sf_dir), clocks).select("store", "field", "asset_id", "utc_us").distinct()


def _estimated(rows: DataFrame) -> DataFrame:
    moments = to_utc(rows.where("camera_id IS NOT NULL").withColumn("zone", F.lit(None).cast("string")), "value", "zone", offset="offset")
    both = F.when(F.col("utc_us").isNotNull() & F.col("offset").isNotNull(), F.struct("utc_us", "offset"))
    moments = moments.select("camera_id", F.explode(F.array_compact(F.array(both))).alias("m")).select("camera_id", "m.utc_us", "m.offset")
    return estimate_histories(moments, "camera_id", "utc_us", "offset")


def p2_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone of each camera's clock, estimated without ``camera_clock`` from the values that carry their own offset."""
    return _estimated(_dates(spark, sf_dir)).select(F.col("clock").alias("camera_id"), "zone", "violations", "rows")


def p2_recovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per store and field, how many of p2_found's values of listed cameras come out alike with estimated zones in place of ``camera_clock``."""
    rows = _dates(spark, sf_dir)
    clocks = read(spark, sf_dir, "camera_clock").select("camera_id", "clock_zone").distinct()
    listed = rows.join(clocks.select("camera_id"), "camera_id", "left_semi")
    guessed = _estimated(rows).select(F.col("clock").alias("camera_id"), F.col("zone").alias("clock_zone"))
    true, other = (_instants(listed, c).distinct() for c in (clocks, guessed))
    met = true.join(other.withColumnRenamed("utc_us", "guessed_us"), ["store", "field", "asset_id", "value"], "left")
    return met.groupBy("store", "field").agg(F.count("*").alias("cases"), F.sum((F.coalesce(F.col("guessed_us") == F.col("utc_us"), F.lit(False))).cast("bigint")).alias("recovered"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [periods_and_gaps(read(spark, sf_dir, t), "asset_id", whole_ms(F.col(a)), whole_ms(F.col(b))).select(F.lit(t).alias("store"), F.col("entity").alias("asset_id"), "kind", F.col("start").alias("start_ms"), F.col("end").alias("end_ms")) for t, a, b in WINDOWS]
    return parts[0].union(parts[1])


_P6 = """
WITH r AS (
  SELECT DISTINCT 'audio_event' AS store, asset_id, CAST(round(window_start_sec * 1000) AS BIGINT) AS s, CAST(round(window_end_sec * 1000) AS BIGINT) AS e FROM audio_event
  UNION SELECT 'segment', asset_id, CAST(round(start_sec * 1000) AS BIGINT), CAST(round(end_sec * 1000) AS BIGINT) FROM segment
), good AS (SELECT * FROM r WHERE asset_id IS NOT NULL AND s < e),
reach AS (SELECT *, max(e) OVER (PARTITION BY store, asset_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM good),
islands AS (SELECT *, sum(CASE WHEN m IS NULL OR s > m THEN 1 ELSE 0 END) OVER (PARTITION BY store, asset_id ORDER BY s, e) AS k FROM reach)
SELECT store, asset_id, 'period' AS kind, min(s) AS start_ms, max(e) AS end_ms FROM islands GROUP BY store, asset_id, k
UNION ALL SELECT store, asset_id, 'gap', m, s FROM reach WHERE s > m AND s - m < 1800000
"""


_MONTHS = "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
_TAIL = r"(?:(?:\s*t\s*|,?\s+|:)(\d{1,2}):?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?(?:\s*([ap])\.?m\b\.?)?)?\s*(z|[+-]\d{1,2}(?::?\d{2})?)?\s*(?:\[([^\]]+)\]|\(?([a-z][a-z0-9_+/-]*)\)?)?"
_WAYS = (
    (r"(\d{4})([-:/.])(\d{1,2})([-:/.])(\d{1,2})", "'y', 'a', 'm', 'b', 'd'"), (r"(\d{4})()(\d{2})()(\d{2})", "'y', 'a', 'm', 'b', 'd'"), (r"()()(\d{1,2})/(\d{1,2})/(\d{4})", "'a', 'b', 'm', 'd', 'y'"), (r"()()(\d{1,2})\.(\d{1,2})\.(\d{4})", "'a', 'b', 'd', 'm', 'y'"),
    (rf"()()({_MONTHS})\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})", "'a', 'b', 'm', 'd', 'y'"), (rf"()()(?:[a-z]+,?\s+)?(\d{{1,2}})(?:st|nd|rd|th)?\.?[\s-]({_MONTHS})\.?,?[\s-](\d{{4}})", "'a', 'b', 'd', 'm', 'y'"),
)
_MOMENTS = rf"""raw AS (
  SELECT DISTINCT 'asset' AS store, field, asset_id, camera_id, value FROM (SELECT asset_id, camera_id, unnest(['primary_timeline_date', 'shoot_date']) AS field, unnest([primary_timeline_date, shoot_date]) AS value FROM asset)
  UNION SELECT 'semantic_stills', 'shoot_date', asset_id, camera_id, shoot_date FROM semantic_stills
), t AS (SELECT store, field, asset_id, camera_id, value, regexp_replace(value, '^[\s\x{{a0}}\x{{feff}}\x{{200b}}]+|[\s\x{{a0}}\x{{feff}}\x{{200b}}]+$', '', 'g') AS v FROM raw WHERE value IS NOT NULL),
p AS ({" UNION ALL ".join(rf"SELECT store, field, asset_id, camera_id, value, v, {k} AS way, g.y, g.a, g.m, g.b, g.d, g.h, g.mi, g.s, g.f, g.ap, g.o, g.zb, g.zn FROM (SELECT *, regexp_extract(v, '^{date}{_TAIL}$', [{names}, 'h', 'mi', 's', 'f', 'ap', 'o', 'zb', 'zn'], 'i') AS g FROM t WHERE regexp_matches(v, '^{date}{_TAIL}$', 'i'))" for k, (date, names) in enumerate(_WAYS))}),
q AS (SELECT * FROM p WHERE a = b QUALIFY row_number() OVER (PARTITION BY store, field, asset_id, camera_id, value ORDER BY way) = 1),
n AS (SELECT *, CAST(y AS INTEGER) AS yy, CASE WHEN regexp_matches(m, '^\d') THEN CAST(m AS INTEGER) ELSE list_position(['jan', 'feb', 'mar', 'apr', 'may', 'jun', 'jul', 'aug', 'sep', 'oct', 'nov', 'dec'], left(lower(m), 3)) END AS mm, CAST(d AS INTEGER) AS dd, coalesce(TRY_CAST(h AS INTEGER), 0) AS h0, coalesce(TRY_CAST(mi AS INTEGER), 0) AS mn, coalesce(TRY_CAST(s AS INTEGER), 0) AS ss, lower(ap) AS half, replace(lower(o), ':', '') AS off, CASE WHEN zb <> '' THEN zb ELSE zn END AS zname FROM q),
l AS (SELECT *, CASE WHEN h0 <= 23 AND mn <= 59 AND ss <= 59 AND (half = '' OR h0 BETWEEN 1 AND 12) THEN TRY_CAST(format('{{:04d}}-{{:02d}}-{{:02d}} {{:02d}}:{{:02d}}:{{:02d}}', yy, mm, dd, CASE WHEN half = '' THEN h0 ELSE h0 % 12 + CASE WHEN half = 'p' THEN 12 ELSE 0 END END, mn, ss) AS TIMESTAMP) END AS wall, CASE WHEN f <> '' THEN TRY_CAST(rpad(left(f, 6), 6, '0') AS BIGINT) ELSE 0 END AS us, (SELECT min(clock_zone) FROM camera_clock c WHERE c.camera_id = n.camera_id) AS clock FROM n),
z AS (SELECT *, CASE WHEN off = 'z' THEN 0 WHEN off <> '' THEN (CASE WHEN left(off, 1) = '-' THEN -1 ELSE 1 END) * CASE WHEN length(off) <= 3 THEN CAST(off[2:] AS INTEGER) * 60 ELSE CAST(off[2:length(off) - 2] AS INTEGER) * 60 + CAST(right(off, 2) AS INTEGER) END
    ELSE CASE lower(zname) WHEN 'utc' THEN 0 WHEN 'gmt' THEN 0 WHEN 'z' THEN 0 WHEN 'est' THEN -300 WHEN 'edt' THEN -240 WHEN 'cst' THEN -360 WHEN 'cdt' THEN -300 WHEN 'mst' THEN -420 WHEN 'mdt' THEN -360 WHEN 'pst' THEN -480 WHEN 'pdt' THEN -420 WHEN 'cet' THEN 60 WHEN 'cest' THEN 120 END END AS minutes,
    CASE WHEN zname = '' THEN coalesce(clock, 'UTC') WHEN contains(zname, '/') THEN zname END AS zone FROM l WHERE wall IS NOT NULL),
i AS (SELECT *, CASE WHEN minutes IS NULL AND zone IS NOT NULL THEN timezone(zone, wall) END AS inst FROM z),
found AS (
  SELECT store, field, asset_id, CASE WHEN minutes IS NOT NULL THEN CASE WHEN abs(minutes) <= 1080 THEN epoch_us(wall) - CAST(minutes AS BIGINT) * 60000000 + us END WHEN timezone(zone, inst - INTERVAL 1 HOUR) = wall THEN epoch_us(inst) - 3600000000 + us ELSE epoch_us(inst) + us END AS utc_us FROM i
  UNION SELECT store, field, asset_id, TRY_CAST(rpad(v, 16, '0') AS BIGINT) FROM t WHERE regexp_full_match(v, '\d{{10}}|\d{{13}}|\d{{16}}')
)"""
_P2 = f"WITH {_MOMENTS} SELECT DISTINCT store, field, asset_id, utc_us FROM found WHERE utc_us IS NOT NULL"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p2_found": p2_found, "p2_zones": p2_zones, "p2_recovered": p2_recovered, "p6_found": p6_found}


def oracle_sql() -> dict[str, str]:
    return {"p2_found": _P2, "p6_found": _P6}
