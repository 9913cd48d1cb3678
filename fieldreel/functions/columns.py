"""Column expressions used across the operators; all stay inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Common words that token comparisons leave out.
STOP_WORDS = (
    "the a an and or but in on at to for of as is was are were be been being it this that these those i you he she we they me him her them my your our their "
    "do did does doing have has had having get got go going went come came can could would should just like so very really then there here oh yeah um uh okay ok"
).split()
# Frame rate of film slowed for video, and ticks of one such frame.
FPS = 24_000 / 1_001
TICKS_PER_FRAME = 10_594_584_000


def clamp(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    """Length that two intervals share; zero if none. Null if any bound is null."""
    known = a_start.isNotNull() & a_end.isNotNull() & b_start.isNotNull() & b_end.isNotNull()
    return F.when(known, F.greatest(F.lit(0.0), F.least(a_end, b_end) - F.greatest(a_start, b_start)))


def truthy(c: Column) -> Column:
    """Whether a written flag means yes; null and other words mean no."""
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("true", "1", "yes", "y"), F.lit(False))


def score(c: Column) -> Column:
    """A written number, or null for None, blank and other words."""
    return F.trim(c.cast("string")).try_cast("double")


def normalise(c: Column) -> Column:
    """Lower case; other characters than a-z and 0-9 become single blanks."""
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def tokens(c: Column, stop: list[str] = STOP_WORDS) -> Column:
    """Words of two letters or more, without common words, in order; an empty array for null."""
    words = F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z0-9]+", " ")), r"\s+")
    return F.array_except(F.filter(words, lambda w: F.length(w) >= 2), F.array(*map(F.lit, stop))) if not stop else F.filter(words, lambda w: (F.length(w) >= 2) & ~w.isin(stop))


def slug(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), F.regexp_replace(normalise(c), " ", "_"))


def jaccard(a: Column, b: Column) -> Column:
    """Shared part of two token sets; 0 if both are empty."""
    both = F.size(F.array_union(a, b))
    return F.when(both > 0, F.size(F.array_intersect(a, b)) / both).otherwise(F.lit(0.0))


def duration_similarity(a: Column, b: Column) -> Column:
    """1 - difference as a share of the longer; 0 if either is null or not above zero."""
    return F.when((a > 0) & (b > 0), F.greatest(F.lit(0.0), 1 - F.abs(a - b) / F.greatest(a, b))).otherwise(F.lit(0.0))


def normalised_distance(a: Column, b: Column) -> Column:
    """Edit distance as a share of the longer length; 0 for two empty texts."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest > 0, F.levenshtein(a, b) / longest).otherwise(F.lit(0.0))


# The rules of the phonetic key, in the order in which they apply to upper-case letters.
PHONETIC_STARTS = (("AE", "E"), ("GN", "N"), ("KN", "N"), ("PN", "N"), ("WR", "R"), ("PS", "S"), ("WH", "W"))
PHONETIC_RULES = (
    ("PH", "F"), ("GH", ""), ("DG[EIY]", "J"), ("CK", "K"), ("CC", "K"), ("CH", "X"), ("C(?=[IEY])", "S"), ("C", "K"), ("SH|SCH|SCI|SCE|SCY", "X"), ("TH", "0"),
    ("G(?=[IEY])", "J"), ("Q", "K"), ("Z", "S"), ("V", "F"), ("[WY]", ""), ("MB", "M"), (r"(.)\1+", "$1"), ("(?<!^)[AEIOU]", ""),
)


def phonetic_word(c: Column) -> Column:
    start = F.regexp_replace(F.upper(c), "[^A-Z]", "")
    opened = reduce(lambda w, r: w.when(start.startswith(r[0]), F.concat(F.lit(r[1]), F.substring(start, len(r[0]) + 1, 1_000))), PHONETIC_STARTS[1:], F.when(start.startswith("AE"), F.concat(F.lit("E"), F.substring(start, 3, 1_000)))).otherwise(start)
    return reduce(lambda w, r: F.regexp_replace(w, *r), PHONETIC_RULES, F.regexp_replace(opened, "^X", "S"))


def phonetic_key(c: Column) -> Column:
    """Sound of a name: the keys of its words, run together; an empty text for null and names without letters."""
    return F.array_join(F.transform(F.split(F.trim(F.regexp_replace(F.upper(F.coalesce(c, F.lit(""))), "[^A-Z]+", " ")), " "), phonetic_word), "")


def timecode_seconds(c: Column, frames_per_second: float = 24.0) -> Column:
    """Seconds of HH:MM:SS:FF, with ; allowed for :; null for other texts."""
    part = lambda k: F.regexp_extract(c, r"^\s*(\d{1,2})[:;](\d{2})[:;](\d{2})[:;.](\d{1,2})\s*$", k)
    return F.when(part(1) != "", part(1).cast("int") * 3_600 + part(2).cast("int") * 60 + part(3).cast("int") + part(4).cast("int") / frames_per_second)


def frame_seconds(c: Column) -> Column:
    return c * 1_001 / 24_000


def seconds_frame(c: Column) -> Column:
    """Nearest frame, halves to even."""
    return F.bround(c * 24_000 / 1_001, 0).cast("bigint")


def frame_ticks(c: Column) -> Column:
    return c.cast("bigint") * F.lit(TICKS_PER_FRAME)


def usable_day(c: Column) -> Column:
    """Whether a text starts with YYYY-MM-DD in which no part is zero and month and day are in range; 31 February passes."""
    part = lambda k: F.regexp_extract(c, r"^(\d{4})-(\d{2})-(\d{2})", k)
    return F.coalesce((part(1) > "0000") & part(2).between("01", "12") & part(3).between("01", "31"), F.lit(False))


def colon_day(c: Column) -> Column:
    """YYYY-MM-DD of a text that starts with YYYY:MM:DD; null for others."""
    return F.when(c.rlike(r"^\d{4}:\d{2}:\d{2}"), F.regexp_replace(F.left(c, F.lit(10)), ":", "-"))


def location(c: Column) -> Column:
    """Struct (lat, lon, alt) of signed numbers as +37.33-122.03+10/; null with fewer than two."""
    parts = F.regexp_extract_all(c, F.lit(r"([+-]\d+(?:\.\d+)?)"))
    return F.when(F.size(parts) >= 2, F.struct(F.get(parts, 0).cast("double").alias("lat"), F.get(parts, 1).cast("double").alias("lon"), F.get(parts, 2).cast("double").alias("alt")))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors of one length; null if either is null, of another length or all zero."""
    size = norm(a) * norm(b)
    return F.when((F.size(a) == F.size(b)) & (size > 0), dot(a, b) / size)


def float_vector(blob: Column, dim: int) -> Column:
    """Vector of a blob of little-endian float32 values; null if the length isn't that of ``dim`` values.

    The bits are taken apart with hexadecimal digits and integer arithmetic, so no Python is needed.
    """
    digits = F.hex(blob)

    def value(k: Column) -> Column:
        byte = lambda n: F.substring(digits, k * 8 + 1 + 2 * n, F.lit(2))
        bits = F.conv(F.concat(byte(3), byte(2), byte(1), byte(0)), 16, 10).cast("bigint")
        sign = F.when(bits >= F.lit(1 << 31), -1.0).otherwise(1.0)
        exponent = F.shiftright(bits.bitwiseAND(F.lit(0x7F800000)), 23)
        mantissa = bits.bitwiseAND(F.lit(0x7FFFFF))
        size = F.when(exponent == 0, mantissa * F.pow(F.lit(2.0), F.lit(-149.0))).otherwise((mantissa + (1 << 23)) * F.pow(F.lit(2.0), exponent - 150))
        return F.when(exponent < 255, sign * size).otherwise(F.lit(float("nan"))).cast("float")

    return F.when(F.length(blob) == 4 * dim, F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), value))


def usable_vector(v: Column) -> Column:
    """Whether a vector is present, finite and not all zero."""
    return F.coalesce(v.isNotNull() & ~F.exists(v, F.isnan) & F.exists(v, lambda x: x != 0), F.lit(False))


def keyword_score(text: Column, keywords: dict[str, float]) -> Column:
    """Struct (score, matched): weights of the phrases that the text holds, without case, and the phrases in order."""
    table = F.array(*(F.struct(F.lit(p).alias("p"), F.lit(float(w)).alias("w")) for p, w in sorted(keywords.items())))
    low = F.lower(F.coalesce(text, F.lit("")))
    hits = F.filter(table, lambda k: F.contains(low, k["p"]))
    return F.struct(F.aggregate(hits, F.lit(0.0), lambda s, k: s + k["w"]).alias("score"), F.transform(hits, lambda k: k["p"]).alias("matched"))


def noise_reason(c: Column) -> Column:
    """Why a recognised text looks like noise, or null: one sign repeated, no vowels, mostly signs."""
    letters, bare = F.regexp_replace(c, r"[^A-Za-z]", ""), F.regexp_replace(c, r"\s", "")
    return F.when(bare.rlike(r"^(.)\1{3,}$"), "repeated").when((F.length(letters) >= 5) & ~letters.rlike("(?i)[aeiouy]"), "no_vowel").when((F.length(bare) > 0) & (F.length(F.regexp_replace(bare, r"[\p{L}\p{N}]", "")) * 2 > F.length(bare)), "signs")


def readable_text(c: Column) -> Column:
    """Whether a recognised text has three letters or digits and no Cyrillic ones."""
    return F.coalesce((F.length(F.regexp_replace(c, r"[^\p{L}\p{N}]", "")) >= 3) & ~c.rlike(r"[\x{0400}-\x{052F}]"), F.lit(False))


def json_object(c: Column) -> Column:
    """The text from the first opening to the last closing brace; null if there is none."""
    return F.nullif(F.regexp_extract(c, r"(?s)(\{.*\})", 1), F.lit(""))


def like(c: Column, text: str) -> Column:
    """Whether the text stands inside, without case; % and _ in it stand for anything."""
    return c.ilike(f"%{text}%")


def blended_rank(aesthetic: Column, sharpness: Column, duration: Column) -> Column:
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return zero(aesthetic) / 10 + F.least(zero(sharpness), F.lit(1_000.0)) / 1_000 + F.least(zero(duration), F.lit(30.0)) / 30
