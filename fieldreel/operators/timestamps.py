"""Mixed timestamp formats and time zones, normalised to instants in UTC."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo, available_timezones

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_US = 86_400_000_000

# Month names, and short zone names of the United States, Central Europe and UTC in minutes.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
MONTH_NAMES = "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
SHORT_ZONES = {"utc": 0, "gmt": 0, "z": 0, "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420, "cet": 60, "cest": 120}

# A date, then maybe a time, then maybe a zone. Each date pattern has year, month and day at the places given.
DATES = (
    (r"(\d{4})([-:/.])(\d{1,2})\2(\d{1,2})", (1, 3, 4)),
    (r"(\d{4})(\d{2})(\d{2})", (1, 2, 3)),
    (r"(\d{1,2})/(\d{1,2})/(\d{4})", (3, 1, 2)),
    (r"(\d{1,2})\.(\d{1,2})\.(\d{4})", (3, 2, 1)),
    (rf"({MONTH_NAMES})\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})", (3, 1, 2)),
    (rf"(?:[a-z]+,?\s+)?(\d{{1,2}})(?:st|nd|rd|th)?\.?[\s-]({MONTH_NAMES})\.?,?[\s-](\d{{4}})", (3, 2, 1)),
)
TIME = r"(\d{1,2}):?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?(?:\s*([ap])\.?m\.?(?![a-z]))?"
ZONE = r"(z|[+-]\d{1,2}(?::?\d{2})?)?\s*(?:\[([^\]]+)\]|\(?([a-z][a-z0-9_+/-]*)\)?)?"


def _days(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970-01-01 of a date of the Gregorian calendar, counted in years that begin in March."""
    year = y - (m <= 2).cast("int")
    in_year = F.floor((153 * F.pmod(m + 9, F.lit(12)) + 2) / 5) + d - 1
    return 365 * year + F.floor(year / 4) - F.floor(year / 100) + F.floor(year / 400) + in_year - 719_468


def _month_days(y: Column, m: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    return F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)


def parse(value: Column) -> Column:
    """Struct (p, epoch) of a written date or moment.

    ``p`` holds, as written, year, month, day, hour, minute, second, fraction, a or p, offset, zone in brackets, zone;
    it is null for other texts. ``epoch`` is set, in microseconds, for bare numbers of 10, 13 or 16 digits.
    """
    text = F.regexp_replace(value, r"^[\s\x{a0}\x{feff}\x{200b}]+|[\s\x{a0}\x{feff}\x{200b}]+$", "")
    number = text.rlike(r"^(?:\d{10}|\d{13}|\d{16})$")
    epoch = F.when(number, F.rpad(text, 16, "0").cast("bigint"))
    found = []
    for date, (y, m, d) in DATES:
        t = date.count("(") - date.count("(?:") + 1
        whole = rf"(?i)^{date}(?:(?:\s*t\s*|,?\s+|:(?=\d\d:)){TIME})?\s*{ZONE}$"
        parts = "|".join(f"${k}" for k in (y, m, d, *range(t, t + 8)))
        found.append(F.when(text.rlike(whole), F.split(F.regexp_replace(text, whole, parts), r"\|")))
    return F.struct(F.coalesce(*found).alias("p"), epoch.alias("epoch"))


def to_utc(df: DataFrame, value: str, clock_zone: str, out: str = "utc_us", offset: str | None = None) -> DataFrame:
    """``df`` with ``out``: the instant of the written ``value`` in microseconds since 1970-01-01 UTC, or null.

    With ``offset``, also a column of that name: the minutes of an offset written in digits, else null.

    An explicit offset counts before a zone name beside it; a value with neither is wall time in the row's
    ``clock_zone``, or UTC where that is null or unknown. A wall time that occurs twice means the first; one that is
    skipped is read with the offset before the change. Null, empty and blank values, days that don't exist, hours over
    23, unknown zone names and other texts give null. Digits beyond microseconds are dropped. The result doesn't depend
    on the session's time zone. All work stays in built-in expressions; a ``clock_zone`` column may be ``lit``-ed.
    """
    zones = sorted(available_timezones() - {"localtime"})
    short = F.create_map(*(x for k, v in SHORT_ZONES.items() for x in (F.lit(k), F.lit(v))))
    df = df.withColumn("_parsed", parse(F.col(value)))
    p = F.col("_parsed.p")
    n = lambda k: F.when(p[k] != "", p[k].cast("bigint"))
    month = F.when(p[1].rlike(r"^\d"), p[1].cast("bigint")).when(p[1] != "", F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.left(p[1], F.lit(3)))))
    df = df.withColumns({
        "_y": n(0), "_m": month, "_d": n(2), "_h": n(3), "_mi": F.coalesce(n(4), F.lit(0)), "_s": F.coalesce(n(5), F.lit(0)),
        "_frac": F.when(p[6] != "", F.rpad(F.left(p[6], F.lit(6)), 6, "0").cast("int")).otherwise(0), "_half": F.lower(p[7]),
        "_off": F.lower(F.regexp_replace(p[8], ":", "")), "_name": F.when(p[9] != "", p[9]).otherwise(p[10]), "_epoch": F.col("_parsed.epoch"),
    })
    hour = F.when(F.col("_h").isNull(), 0).when(F.col("_half") == "", F.col("_h")).otherwise(F.col("_h") % 12 + F.when(F.col("_half") == "p", 12).otherwise(0))
    real = F.col("_m").between(1, 12) & (F.col("_d") >= 1) & (F.col("_d") <= _month_days(F.col("_y"), F.col("_m"))) & (F.col("_y") >= 1) & (hour <= 23) & (F.col("_mi") <= 59) & (F.col("_s") <= 59)
    real &= (F.coalesce(F.col("_half"), F.lit("")) == "") | F.col("_h").between(1, 12)
    local = F.when(real, (_days(F.col("_y"), F.col("_m"), F.col("_d")) * 86_400 + hour * 3_600 + F.col("_mi") * 60 + F.col("_s")) * F.lit(1_000_000) + F.col("_frac"))
    sign = F.when(F.left("_off", F.lit(1)) == "-", -1).otherwise(1)
    body = F.substring("_off", 2, 6)
    minutes = F.when(F.length(body) <= 2, body.cast("bigint") * 60).otherwise(F.left(body, F.length(body) - 2).cast("bigint") * 60 + F.right(body, F.lit(2)).cast("bigint"))
    written = F.when((F.col("_off") != "") & (F.col("_off") != "z"), sign * minutes)
    df = df.withColumns({"_local": local, "_written": written.cast("int"), "_offset": F.coalesce(F.when(F.col("_off") == "z", 0).otherwise(written), F.when(F.col("_name") != "", short[F.lower("_name")])), "_zone": F.when(F.col("_name").isin(zones), F.col("_name"))})
    clock = F.when(F.col(clock_zone).isin(zones), F.col(clock_zone)).otherwise("UTC")
    zone = F.when(F.coalesce(F.col("_name"), F.lit("")) == "", clock).otherwise(F.col("_zone"))
    wall = F.unix_micros(F.to_utc_timestamp(F.timestamp_micros("_local"), zone))
    utc = F.when(F.col("_epoch").isNotNull(), F.col("_epoch")).when(F.col("_offset").isNotNull(), F.when(F.abs("_offset") <= 18 * 60, F.col("_local") - F.col("_offset").cast("bigint") * F.lit(60_000_000))).when(F.col("_local").isNotNull() & zone.isNotNull(), wall)
    if offset:
        df = df.withColumn(offset, F.col("_written"))
    return df.withColumn(out, utc.cast("bigint")).drop("_written", "_parsed", "_y", "_m", "_d", "_h", "_mi", "_s", "_frac", "_half", "_off", "_name", "_epoch", "_local", "_offset", "_zone")


def estimate_zones(df: DataFrame, clock: str, local_us: str, reference_us: str, candidates: list[str]) -> DataFrame:
    """One row (clock, zone, violations, rows) for each clock whose zone is not known: the candidate under which the fewest wall times lie after the moment they were taken in, or more than a day before.

    ``reference_us`` is a moment in UTC at or after the wall time, as that of ingestion. Among equals the candidate that
    brings the times closest below their references, then the first by name. Rows with a null in any of the three are
    left out; repeated rows count once. Zones follow their own daylight saving, so each candidate is a whole history of
    offsets. Counts are combined before the shuffle, so a hot clock costs no more than others.
    """
    rows = df.select(F.col(clock).alias("clock"), F.col(local_us).alias("l"), F.col(reference_us).alias("r")).dropna().distinct()
    tried = rows.withColumn("zone", F.explode(F.array(*(F.lit(c) for c in sorted(candidates)))))
    late = F.col("r") - F.unix_micros(F.to_utc_timestamp(F.timestamp_micros("l"), F.col("zone")))
    scored = tried.groupBy("clock", "zone").agg(F.sum(((late < 0) | (late > DAY_US)).cast("bigint")).alias("violations"), F.sum(F.abs(late).cast("double")).alias("far"), F.count("*").alias("rows"))
    best = F.min(F.struct("violations", "far", "zone", "rows")).alias("b")
    return scored.groupBy("clock").agg(best).select("clock", "b.zone", "b.violations", "b.rows")


def distinct_histories(zones: list[str], first: datetime, last: datetime) -> list[str]:
    """One zone, the first by name, for each history of offsets between two days, looked at week by week."""
    weeks = [first + timedelta(weeks=k) for k in range((last - first).days // 7 + 2)]
    found: dict[tuple, str] = {}
    for zone in sorted(zones):
        info = ZoneInfo(zone)
        found.setdefault(tuple(w.astimezone(info).utcoffset() for w in weeks), zone)
    return sorted(found.values())


def estimate_histories(df: DataFrame, clock: str, utc_us: str, offset: str, candidates: list[str] | None = None) -> DataFrame:
    """One row (clock, zone, violations, rows) for each clock: the zone whose history of offsets disagrees with the fewest moments that carry an offset of their own.

    ``utc_us`` is the instant and ``offset`` its written offset in minutes. Candidates are by default all regional zones
    and UTC, one for each history of offsets in the time that the moments span; among equals the first by name. Rows
    with a null in any of the three are left out; an empty table gives no rows. Moments reduce to counts per clock, day
    and offset before zones are tried, so a hot clock costs no more than others. Within a day of change the offset at
    the day's end counts.
    """
    rows = df.select(F.col(clock).alias("clock"), F.floor(F.col(utc_us) / DAY_US).alias("day"), F.col(offset).cast("bigint").alias("offset")).dropna()
    counts = rows.groupBy("clock", "day", "offset").agg(F.count("*").alias("n"))
    span = rows.agg(F.min("day").alias("a"), F.max("day").alias("b")).first()
    epoch = datetime(1970, 1, 1, tzinfo=UTC)
    most = (datetime(2200, 1, 1, tzinfo=UTC) - epoch).days
    first, last = (epoch + timedelta(days=max(0, min(most, d or 0))) for d in (span["a"], span["b"]))
    zones = candidates or distinct_histories([z for z in available_timezones() if "/" in z and not z.startswith(("Etc/", "posix/", "right/"))] + ["UTC"], first, last)
    tried = counts.withColumn("zone", F.explode(F.array(*(F.lit(z) for z in zones))))
    at = F.timestamp_micros((F.col("day") + 1) * F.lit(DAY_US))
    own = (F.unix_micros(F.from_utc_timestamp(at, F.col("zone"))) - F.unix_micros(at)) / 60_000_000
    scored = tried.groupBy("clock", "zone").agg(F.sum(F.when(own != F.col("offset"), F.col("n")).otherwise(0)).alias("violations"), F.sum("n").alias("rows"))
    return scored.groupBy("clock").agg(F.min(F.struct("violations", "zone", "rows")).alias("b")).select("clock", "b.zone", "b.violations", "b.rows")
