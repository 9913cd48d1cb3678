"""Sound fingerprints: quick probe, alignment, and link proposals in blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldreel.functions.python import fingerprint_match
from fieldreel.operators.ranking import top_k_per

PROBE, SHIFT = 16, 4


def quick_probe(a: Column, b: Column) -> Column:
    """Largest share of equal hashes among the first 16 of ``a``, laid on ``b`` up to four places off; 0 if ``a`` is shorter."""

    def share(off: Column) -> Column:
        # shifted left, the end of the probe meets the start of b; shifted right, its start meets b from there
        mine = F.when(off < 0, F.slice(a, 1 - off, PROBE + off)).otherwise(F.slice(a, 1, PROBE))
        other = F.when(off < 0, F.slice(b, 1, PROBE + off)).otherwise(F.slice(b, off + 1, PROBE))
        n = F.least(F.size(mine), F.size(other))
        mine = F.when(off < 0, F.slice(mine, F.size(mine) - n + 1, n)).otherwise(F.slice(mine, 1, n))
        same = F.aggregate(F.zip_with(mine, F.slice(other, 1, n), lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0)))
        return F.when(n > 0, same / n).otherwise(F.lit(0.0))

    return F.when(F.size(a) >= PROBE, F.array_max(F.transform(F.sequence(F.lit(-SHIFT), F.lit(SHIFT)), share))).otherwise(F.lit(0.0))


def path_score(label: tuple[Column, Column], day: tuple[Column, Column], camera: tuple[Column, Column]) -> Column:
    """Likeness of two recordings by label, day and camera family; 1 at most."""
    la, lb = label
    by_label = F.when(la == lb, 0.50).when(F.contains(la, lb) | F.contains(lb, la), 0.25).otherwise(0.0)
    by_day = F.when(day[0] == day[1], 0.40).when(F.left(day[0], F.lit(7)) == F.left(day[1], F.lit(7)), 0.10).otherwise(0.0)
    family = lambda c: F.substring_index(c, "_", 1)
    by_camera = F.when(family(camera[0]) == family(camera[1]), 0.10).otherwise(0.0)
    said = lambda c: F.nullif(c, F.lit(""))
    return F.least(F.lit(1.0), F.when(said(la).isNotNull() & said(lb).isNotNull(), by_label).otherwise(0.0) + F.coalesce(by_day, F.lit(0.0)) + F.coalesce(by_camera, F.lit(0.0)))


def propose_links(video: DataFrame, audio: DataFrame, *, least_path: float = 0.30, least_probe: float = 0.30, least_match: float = 0.55, k: int = 3) -> DataFrame:
    """Rows (video_id, audio_id, path_score, similarity, offset, combined, rank): the k best sounds of each video.

    Both: id, label, day, camera, fp. Pairs meet by equal label, by equal day, or by a label inside the other in the same
    month or camera family, by which alone a path score of 0.30 can be reached; distinct labels are held against one
    another once per family. Prints shorter than the probe skip it. Similarity is the share of equal bits at the best offset.
    """
    a, b = (df.select(*(F.col(c).alias(f"{p}_{c}") for c in ("id", "label", "day", "camera", "fp"))) for df, p in ((video, "v"), (audio, "a")))
    by_label = a.where("v_label <> ''").join(b, F.col("v_label") == F.col("a_label"))
    by_day = a.join(b, F.col("v_day") == F.col("a_day"))
    part = a.where("v_label <> ''").join(b.where("a_label <> ''"), F.left("v_day", F.lit(7)) == F.left("a_day", F.lit(7))).where(F.contains("v_label", F.col("a_label")) | F.contains(F.col("a_label"), F.col("v_label")))
    # in one camera family without the month: distinct labels first, then their rows
    family = lambda c: F.substring_index(c, "_", 1)
    labels = [df.where(f"{p}_label <> ''").select(f"{p}_label", family(F.col(f"{p}_camera")).alias("_f")).where("_f IS NOT NULL").distinct() for df, p in ((a, "v"), (b, "a"))]
    inside = labels[0].join(labels[1], "_f").where(F.contains("v_label", F.col("a_label")) | F.contains(F.col("a_label"), F.col("v_label")))
    by_family = inside.join(a.withColumn("_f", family(F.col("v_camera"))), ["v_label", "_f"]).join(b.withColumn("_f", family(F.col("a_camera"))), ["a_label", "_f"]).drop("_f")
    pairs = by_label.unionByName(by_day).unionByName(part).unionByName(by_family).dropDuplicates(["v_id", "a_id"])
    pairs = pairs.withColumn("path_score", path_score((F.col("v_label"), F.col("a_label")), (F.col("v_day"), F.col("a_day")), (F.col("v_camera"), F.col("a_camera")))).where(F.col("path_score") >= least_path)
    short = F.least(F.size("v_fp"), F.size("a_fp")) < PROBE
    pairs = pairs.where(short | (quick_probe(F.col("v_fp"), F.col("a_fp")) >= least_probe))
    scored = pairs.withColumn("m", fingerprint_match("v_fp", "a_fp")).where(F.col("m.similarity") >= least_match)
    scored = scored.select(F.col("v_id").alias("video_id"), F.col("a_id").alias("audio_id"), "path_score", "m.similarity", "m.offset", (0.7 * F.col("m.similarity") + 0.3 * F.col("path_score")).alias("combined"))
    return top_k_per(scored, ["video_id"], [F.desc("combined"), F.col("audio_id")], k)


def apply_links(proposals: DataFrame, edges: DataFrame, least: float = 0.65) -> DataFrame:
    """Edges (src, dst) with the first-ranked proposals of at least ``least`` added both ways; edges there already stay single."""
    good = proposals.where((F.col("rank") == 1) & (F.col("combined") >= least))
    return edges.select("src", "dst").union(good.select("video_id", "audio_id")).union(good.select("audio_id", "video_id")).distinct()
