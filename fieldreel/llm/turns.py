"""Speech transcripts into clean speaker turns."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldreel.session import cut_lineage, steady

#: Segments are scanned by asset and stretch of this length; stretches of an asset meet only as one summary row each.
STRETCH_MS = 600_000
#: Words that a speaker's language profile is smoothed with, and pairs of neighbours that an asset's transitions are.
PRIOR_WORDS, PRIOR_PAIRS = 50.0, 20.0
#: Weights of what is said beside who spoke before; the one that fits withheld labels best is taken.
WEIGHTS = (0.0, 0.1, 0.2, 0.4, 0.7, 1.0)
#: One labelled segment in so many is withheld to choose the weight.
WITHHELD = 10
#: Chance that a neighbour has the same speaker where no pair of labelled neighbours exists at all.
USUAL_STAY = 0.8

# What transcripts hold besides speech. Brackets of any kind, also nested once.
NOTES = (r"\([^()]*\)", r"\[[^\[\]]*\]", r"\{[^{}]*\}", r"<[^<>]*>", r"（[^（）]*）", r"【[^【】]*】", r"\*[^*]*\*", r"♪[^♪]*♪", r"♫[^♫]*♫")
CLOCKS = (r"\d{1,3}:\d{2}(?::\d{2})?(?:[.,;:]\d{1,3})?(?:\s*-->\s*\d{1,3}:\d{2}(?::\d{2})?(?:[.,;:]\d{1,3})?)?", r"(?i)\b\d{1,3}h\d{1,2}m\d{1,2}(?:\.\d+)?s\b")
LABEL = r"(?i)(?:speakers?|spk|s)\s*[ _#-]*\s*(\d{1,4})"
#: A label before the text: in brackets, or up to a colon or a dash between blanks.
TEXT_LABELS = (r"(?i)^\s*[(\[<]\s*(?:v\s+)?(?:speaker|spk|s)[\s_#-]*(\d{1,4})\s*[)\]>]", r"(?i)^\s*(?:>+\s*)?(?:speaker|spk|s)[\s_#-]*(\d{1,4})\s*:", r"(?i)^\s*(?:>+\s*)?(?:speaker|spk|s)[\s_#-]*(\d{1,4})\s+[-–—]")
NAMED_LABEL = r"(?i)^\s*(?:>+\s*)?(?:speaker|spk|s)[\s_#-]*\d{1,4}\s*(?::|\s[-–—])"
HESITATION = r"(?i)(?<![\p{L}\p{N}'’])(?:u+h+-?h+u+h+|m+-?h+m+|u+h*m+|u+h+|e+r+m*|a+h+m*|h+m+|m{2,}|e+h+m*|ä+h+m*|e+u+h+)(?![\p{L}\p{N}'’])"


_LEAD = TEXT_LABELS[0].replace("(\\d", "(?:\\d") + r"\s*:?"
_NESTED = "|".join(NOTES[:4])
_NAMED = NAMED_LABEL.replace(r"^\s*", rf"^\s*(?:(?:{'|'.join(c.replace('(?i)', '') for c in CLOCKS)})\s*)*", 1)


def spoken(text: Column) -> Column:
    """The text without clock times and timecodes, notes in brackets, asterisks or music notes, labels, and hesitations.

    Each pass over a text costs more than its pattern, so patterns that don't build on one another go together.
    """
    bare = F.regexp_replace(text, "|".join([_LEAD, *NOTES]), " ")
    bare = F.when(bare.rlike(r"[(\[{<]"), F.regexp_replace(bare, _NESTED, " ")).otherwise(bare)
    bare = F.regexp_replace(bare, "|".join([_NAMED, *CLOCKS]), " ")
    return F.regexp_replace(bare, HESITATION, " ")


def speech(text: Column) -> Column:
    """``spoken`` with single blanks and without marks of dialogue at the start."""
    return F.trim(F.regexp_replace(F.regexp_replace(spoken(text), r"^[\s>–—-]+", ""), r"\s+", " "))


def label_number(speaker: Column, text: Column) -> Column:
    """The number in a speaker label, else in the label before the text, else null."""
    own = F.regexp_extract(speaker, r"(\d{1,4})\s*$", 1)
    clean = F.regexp_replace(text, rf"^\s*[\[(]?(?:{CLOCKS[0]}|{CLOCKS[1]})[\])]?", " ")
    tries = [F.regexp_extract(clean, p, 1) for p in TEXT_LABELS]
    return F.when(own != "", own.cast("int")).otherwise(F.coalesce(*(F.when(t != "", t.cast("int")) for t in tries)))


def number_speakers(df: DataFrame, texts: bool = True) -> DataFrame:
    """Counting segments with speaker_no: the label's number, else the one that the person has on a labelled row of the asset, else -1.

    A person with several numbers in an asset has the smallest. Only rows without a number and with a person are joined.
    Texts are cleaned once: what is read several times later is written to the shared folder, without ``texts`` only
    whether they count.
    """
    start = F.when(~F.isnan("start_sec"), F.col("start_sec"))
    rows = df.where("asset_id IS NOT NULL").select("asset_id", "seg_idx", start.alias("start"), "speaker_p_id", label_number(F.col("speaker_id"), F.col("text")).alias("no"), (speech if texts else spoken)(F.col("text")).alias("said"))
    rows = rows.withColumn("counts", F.coalesce(F.col("start").isNotNull() & F.col("said").rlike(r"[\p{L}\p{N}]"), F.lit(False)))
    rows = cut_lineage(rows if texts else rows.drop("said"))
    said = ["said"] if texts else []
    known = rows.where("no IS NOT NULL AND speaker_p_id IS NOT NULL").groupBy("asset_id", "speaker_p_id").agg(F.min("no").alias("by_person"))
    rows = rows.where("counts").drop("counts")
    asked = rows.where("no IS NULL AND speaker_p_id IS NOT NULL").join(known, ["asset_id", "speaker_p_id"], "left").select("asset_id", "seg_idx", "start", *said, F.coalesce("by_person", F.lit(-1)).alias("speaker_no"))
    rest = rows.where("no IS NOT NULL OR speaker_p_id IS NULL").select("asset_id", "seg_idx", "start", *said, F.coalesce("no", F.lit(-1)).alias("speaker_no"))
    return asked.union(rest)


def speaker_turns(df: DataFrame, texts: bool = True) -> DataFrame:
    """Rows (asset_id, speaker_no, first_seg_idx, last_seg_idx, start_sec, text): longest runs of counting segments of one speaker, ordered by start_sec, then seg_idx.

    A segment counts if start_sec is present and text holds a letter or digit after cleaning (see ``speech``). Null and
    blank texts, null and NaN starts don't count; a null asset is left out; repeated rows count once; rows of equal
    start are ordered by seg_idx. An empty table gives no rows. Other columns are ignored. Without ``texts`` the text is
    left out and never gathered.

    Runs are found within a stretch of the asset's time, in one ordering. Where the first run of a stretch has the
    speaker of the last run before it, it goes on from the stretch in which that run began; stretches meet by one summary
    row each. A hot asset spreads over many tasks.
    """
    steady(df.sparkSession)
    rows = number_speakers(df, texts).withColumn("part", F.floor(F.col("start") * 1000 / STRETCH_MS)).withColumn("at", F.struct("start", "seg_idx"))
    order = Window.partitionBy("asset_id", "part").orderBy("at")
    before = F.lag("speaker_no").over(order)
    rows = rows.select("asset_id", "part", "at", "speaker_no", *(["said"] if texts else []), F.when(before.isNull() | (before != F.col("speaker_no")), F.col("at")).alias("opens"))
    rows = rows.withColumn("turn", F.max("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    # the structs of a run sort by time; equal ones are one repeated row
    gathered = [F.array_sort(F.collect_set(F.struct("at", "said"))).alias("pieces")] if texts else []
    runs = cut_lineage(rows.groupBy("asset_id", "part", "turn").agg(F.max("at").alias("end"), F.first("speaker_no").alias("speaker_no"), *gathered))
    stretches = runs.groupBy("asset_id", "part").agg(F.min_by("speaker_no", "turn").alias("first_no"), F.max_by("speaker_no", "turn").alias("last_no"), F.min("turn").alias("first"), F.max("turn").alias("last"))
    by = Window.partitionBy("asset_id").orderBy("part")
    stretches = stretches.withColumn("goes_on", F.coalesce(F.lag("last_no").over(by) == F.col("first_no"), F.lit(False)))
    fresh = F.when((F.col("first") != F.col("last")) | ~F.col("goes_on"), F.col("last"))
    stretches = stretches.withColumn("fresh", fresh).withColumn("from", F.last("fresh", True).over(by.rowsBetween(Window.unboundedPreceding, -1)))
    onward = stretches.where("goes_on").select("asset_id", "part", F.col("first").alias("turn"), "from")
    runs = runs.join(onward, ["asset_id", "part", "turn"], "left").withColumn("turn", F.coalesce("from", "turn"))
    gathered = [F.array_sort(F.flatten(F.collect_list("pieces"))).alias("pieces")] if texts else []
    turns = runs.groupBy("asset_id", "turn").agg(F.first("speaker_no").alias("speaker_no"), F.max("end").alias("end"), *gathered)
    text = [F.array_join(F.transform("pieces", lambda p: p["said"]), " ").alias("text")] if texts else []
    return turns.select("asset_id", "speaker_no", F.col("turn.seg_idx").alias("first_seg_idx"), F.col("end.seg_idx").alias("last_seg_idx"), F.col("turn.start").alias("start_sec"), *text)


def most_likely(fixed: list[int], scores: np.ndarray, stay: float, share: np.ndarray, before: int, after: int) -> list[int]:
    """The most likely states of a hidden Markov chain: fixed[i] is the known state or -1, scores[i] the states' log-likelihoods of what is said, before and after the known states on either side or -1."""
    k = len(share)
    rest = np.maximum(1.0 - share, 1e-9)
    move = (1.0 - stay) * share[None, :] / rest[:, None]
    np.fill_diagonal(move, stay if k > 1 else 1.0)
    log_move, never = np.log(np.maximum(move, 1e-12)), -1e18

    def seen(i: int) -> np.ndarray:
        return np.where(np.arange(k) == fixed[i], 0.0, never) if fixed[i] >= 0 else scores[i]

    best = (log_move[before] if before >= 0 else np.log(np.maximum(share, 1e-12))) + seen(0)
    back = []
    for i in range(1, len(fixed)):
        ways = best[:, None] + log_move
        back.append(ways.argmax(axis=0))
        best = ways.max(axis=0) + seen(i)
    if after >= 0:
        best = best + log_move[:, after]
    path = [int(best.argmax())]
    for step in reversed(back):
        path.append(int(step[path[-1]]))
    return path[::-1]


def _scores(states: list[dict], gains: list[dict] | None, n_words: int) -> np.ndarray:
    """Log-likelihood of a segment's words by each speaker, up to what is common to all."""
    if gains is None:
        return np.zeros(len(states))
    by = {g["no"]: g["gain"] for g in gains}
    return np.array([by.get(s["no"], 0.0) for s in states]) - n_words * np.log(np.array([s["words"] for s in states], float) + PRIOR_WORDS)


def _fits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Log-likelihood of withheld labels under each weight, summed over the batch."""
    for batch in batches:
        total = np.zeros(len(WEIGHTS))
        for no, states, gains, n_words in batch.itertuples(index=False, name=None):
            share = np.log(np.array([s["n"] for s in states], float))
            score = _scores(states, gains, n_words)
            true = [s["no"] for s in states].index(no)
            for n, weight in enumerate(WEIGHTS):
                x = share + weight * score
                total[n] += x[true] - x.max() - np.log(np.exp(x - x.max()).sum())
        yield pd.DataFrame({"n": np.arange(len(WEIGHTS)), "fit": total})


def _decoder(weight: float) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for asset, states, stay, before, after, segments in batch.itertuples(index=False, name=None):
                at = {s["no"]: n for n, s in enumerate(states)}
                share = np.array([s["n"] for s in states], float)
                fixed = [at[seg["no"]] if seg["no"] is not None else -1 for seg in segments]
                scores = np.array([weight * _scores(states, seg["gains"], seg["n_words"]) if f < 0 else np.zeros(len(states)) for seg, f in zip(segments, fixed, strict=True)])
                path = most_likely(fixed, scores, stay, share / share.sum(), at.get(before, -1), at.get(after, -1))
                out += [(asset, seg["at"]["seg_idx"], states[n]["no"]) for seg, n, f in zip(segments, path, fixed, strict=True) if f < 0]
            yield pd.DataFrame(out, columns=["asset_id", "seg_idx", "speaker_no"])

    return decode


def infer_speakers(rows: DataFrame) -> DataFrame:
    """Rows (asset_id, seg_idx, speaker_no) for the segments whose ``no`` is null: the speaker by a hidden Markov model.

    ``rows``: asset_id, seg_idx, start, said (clean text) and no, as of ``number_speakers`` with null for -1. The states
    of an asset are its known speakers. What a segment says is scored by each speaker's word counts in the asset,
    smoothed by those of the whole asset, and weighted as fits one in ``WITHHELD`` labels best; speakers change as often as among labelled neighbours of the asset, smoothed
    by those of the corpus, and to others by their share of segments. Known labels are fixed, and the most likely path
    between them is taken. In an asset without any known speaker every segment comes out as -1. An empty table gives no
    rows. Repeated rows count once.

    Counts and scores are sums by asset, word and speaker, made before shuffles. Paths are found within a stretch of the
    asset's time, with the nearest known speakers before and after it from summary rows: a task holds one stretch.
    """
    steady(rows.sparkSession)
    rows = cut_lineage(rows.select("asset_id", F.floor(F.col("start") * 1000 / STRETCH_MS).alias("part"), F.struct("start", "seg_idx").alias("at"), "no", "said").distinct())
    held = F.col("no").isNotNull() & (F.pmod(F.xxhash64(F.lit("held"), F.col("asset_id"), F.col("at")), F.lit(WITHHELD)) == 0)
    words = F.explode(F.regexp_extract_all(F.lower("said"), F.lit(r"([\p{L}\p{N}']+)"), F.lit(1)))
    tokens = rows.select("asset_id", "at", "no", held.alias("held"), words.alias("word"))
    counts = cut_lineage(tokens.where("no IS NOT NULL").groupBy("asset_id", "word", "no").agg(F.count("*").alias("c"), F.sum((~F.col("held")).cast("bigint")).alias("c_shown")))
    segments_of = rows.where("no IS NOT NULL").groupBy("asset_id", "no").agg(F.count("*").alias("n"), F.sum((~held).cast("bigint")).alias("n_shown"))

    def language(asked: DataFrame, c: str, n: str) -> tuple[DataFrame, DataFrame]:
        """Speakers of each asset (states), and for each asked segment how much more likely its words are by a speaker than by the asset as a whole."""
        size = counts.groupBy("asset_id", "no").agg(F.sum(c).alias("words"))
        speakers = segments_of.where(F.col(n) > 0).join(size, ["asset_id", "no"], "left").withColumn("words", F.coalesce("words", F.lit(0)))
        speakers = speakers.groupBy("asset_id").agg(F.array_sort(F.collect_list(F.struct("no", F.col(n).alias("n"), "words"))).alias("states"), F.sum("words").alias("total"))
        asset_words = counts.where(F.col(c) > 0).groupBy("asset_id", "word").agg(F.sum(c).alias("all"), F.collect_list(F.struct("no", F.col(c).alias("c"))).alias("by"))
        met = asked.groupBy("asset_id", "at", "word").agg(F.count("*").alias("times")).join(asset_words, ["asset_id", "word"]).join(speakers.select("asset_id", "total"), "asset_id")
        gain = F.transform("by", lambda b: F.struct(b["no"].alias("no"), (F.col("times") * F.log1p(b["c"] * F.col("total") / (F.lit(PRIOR_WORDS) * F.col("all")))).alias("gain")))
        met = met.select("asset_id", "at", F.explode(F.concat(gain, F.array(F.struct(F.lit(None).cast("int").alias("no"), F.col("times").cast("double").alias("gain"))))).alias("g"))
        sums = met.groupBy("asset_id", "at", "g.no").agg(F.sum("g.gain").alias("gain"))
        gains = sums.groupBy("asset_id", "at").agg(F.collect_list(F.when(F.col("no").isNotNull(), F.struct("no", "gain"))).alias("gains"), F.max(F.when(F.col("no").isNull(), F.col("gain"))).cast("bigint").alias("n_words"))
        return speakers, gains

    shown, fit_gains = language(tokens.where("held"), "c_shown", "n_shown")
    trial = rows.where(held).select("asset_id", "at", "no").join(fit_gains, ["asset_id", "at"]).join(shown, "asset_id")
    trial = trial.where(F.exists("states", lambda x: x["no"] == F.col("no"))).select("no", "states", "gains", "n_words")
    fits = {r.n: r.fit for r in trial.mapInPandas(_fits, "n int, fit double").groupBy("n").agg(F.sum("fit").alias("fit")).collect()}
    weight = WEIGHTS[max(fits, key=lambda n: (fits[n], -n))] if fits else 0.0
    speakers, gains = language(tokens.where("no IS NULL"), "c", "n")

    order = Window.partitionBy("asset_id", "part").orderBy("at")
    pairs = rows.select("asset_id", "no", F.lag("no").over(order).alias("was")).dropna()
    stays = pairs.groupBy("asset_id").agg(F.sum((F.col("no") == F.col("was")).cast("double")).alias("same"), F.count("*").cast("double").alias("pairs"))
    every = stays.agg(F.sum("same").alias("same"), F.sum("pairs").alias("pairs")).first()
    usual = every["same"] / every["pairs"] if every["pairs"] else USUAL_STAY

    by = Window.partitionBy("asset_id").orderBy("part")
    known = rows.groupBy("asset_id", "part").agg(F.max_by("no", F.when(F.col("no").isNotNull(), F.col("at"))).alias("last"), F.min_by("no", F.when(F.col("no").isNotNull(), F.col("at"))).alias("first"), F.max(F.col("no").isNull()).alias("asks"))
    known = known.select("asset_id", "part", "asks", F.last("last", True).over(by.rowsBetween(Window.unboundedPreceding, -1)).alias("before"), F.first("first", True).over(by.rowsBetween(1, Window.unboundedFollowing)).alias("after")).where("asks").drop("asks")
    segments = rows.select("asset_id", "part", "at", "no").join(known, ["asset_id", "part"]).join(gains, ["asset_id", "at"], "left")
    stretches = segments.groupBy("asset_id", "part").agg(F.first("before").alias("before"), F.first("after").alias("after"), F.array_sort(F.collect_list(F.struct("at", "no", "gains", "n_words"))).alias("segments"))
    jobs = stretches.join(speakers, "asset_id", "left").join(stays, "asset_id", "left")
    stay = (F.coalesce("same", F.lit(0.0)) + PRIOR_PAIRS * usual) / (F.coalesce("pairs", F.lit(0.0)) + PRIOR_PAIRS)
    jobs = jobs.select("asset_id", "states", stay.alias("stay"), "before", "after", "segments")
    schema = f"asset_id {rows.schema['asset_id'].dataType.simpleString()}, seg_idx {rows.schema['at'].dataType['seg_idx'].dataType.simpleString()}, speaker_no int"
    unknown = jobs.where("states IS NULL").select("asset_id", F.explode("segments").alias("s")).select("asset_id", "s.at.seg_idx", F.lit(-1).alias("speaker_no"))
    return jobs.where("states IS NOT NULL").mapInPandas(_decoder(weight), schema).union(unknown)


def inferred_speakers(df: DataFrame) -> DataFrame:
    """``infer_speakers`` of the counting segments that have neither a label nor a person known by one."""
    return infer_speakers(number_speakers(df).withColumn("no", F.when(F.col("speaker_no") >= 0, F.col("speaker_no"))))


def hidden_label_accuracy(df: DataFrame, every: int = 10) -> DataFrame:
    """One row (hidden, right, same_as_before): of one in ``every`` numbers that are known but withheld, how many ``infer_speakers`` finds, and how many the number before, of those shown, would give."""
    rows = cut_lineage(number_speakers(df).distinct())
    held = (F.col("speaker_no") >= 0) & (F.pmod(F.xxhash64("asset_id", "seg_idx"), F.lit(every)) == 0)
    found = infer_speakers(rows.withColumn("no", F.when((F.col("speaker_no") >= 0) & ~held, F.col("speaker_no"))))
    shown = F.last(F.when((F.col("speaker_no") >= 0) & ~held, F.col("speaker_no")), True).over(Window.partitionBy("asset_id", F.floor(F.col("start") * 1000 / STRETCH_MS)).orderBy("start", "seg_idx").rowsBetween(Window.unboundedPreceding, -1))
    true = rows.withColumn("before", shown).where(held).select("asset_id", "seg_idx", "speaker_no", "before")
    met = true.join(found.withColumnRenamed("speaker_no", "guess"), ["asset_id", "seg_idx"], "left")
    right = lambda c: F.coalesce(F.sum((F.col(c) == F.col("speaker_no")).cast("bigint")), F.lit(0))
    return met.agg(F.count("*").alias("hidden"), right("guess").alias("right"), right("before").alias("same_as_before"))
