"""Overlapping and gapped time intervals: continuous periods and the gaps between them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldreel.session import cut_lineage, steady

#: Rows are scanned by entity and stretch of this length; stretches of an entity meet only as one summary row each.
STRETCH_MS = 600_000
#: Longer gaps are breaks and not listed.
MOST_GAP_MS = 1_800_000


def whole_ms(seconds: Column) -> Column:
    """Milliseconds of seconds with at most three decimals; null for null, NaN and infinite values."""
    return F.when((F.abs(seconds) < 1e12) & ~F.isnan(seconds), F.round(seconds * 1000).cast("bigint"))


def periods_and_gaps(df: DataFrame, entity: str, start: Column, end: Column, *, stretch: int = STRETCH_MS, most_gap: int | None = MOST_GAP_MS) -> DataFrame:
    """Rows (entity, kind, start, end): each entity's longest covered stretches (``period``) and the gaps between neighbours (``gap``).

    ``start`` and ``end`` are whole numbers. Rows with a null entity or bound, or that don't end after their start, are
    left out; touching rows join; repeated and nested rows change nothing; gaps of ``most_gap`` or more are left out
    (none if it is None). An empty table gives no rows. Other columns are ignored.

    Rows are merged within a stretch of the entity's time first, in one ordering, and only these local periods go on. The
    latest end of earlier stretches is carried over from one summary row of each; so a hot entity spreads over many
    tasks, and what meets in one task grows with an entity's time, not with its rows. What is read several times is
    written to the shared folder.
    """
    steady(df.sparkSession)
    rows = df.select(F.col(entity).alias("entity"), start.alias("s"), end.alias("e")).where("entity IS NOT NULL AND s < e").withColumn("part", F.floor(F.col("s") / stretch))
    within = Window.partitionBy("entity", "part").orderBy("s", "e")
    reach = F.max("e").over(within.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("first", F.when(reach.isNull() | (F.col("s") > reach), F.col("s")))
    rows = rows.withColumn("first", F.max("first").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = cut_lineage(rows.groupBy("entity", "part", F.col("first").alias("s")).agg(F.max("e").alias("e")))

    earlier = Window.partitionBy("entity").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.groupBy("entity", "part").agg(F.max("e").alias("e")).select("entity", "part", F.max("e").over(earlier).alias("carried"))
    order = Window.partitionBy("entity", "part").orderBy("s")
    pieces = pieces.join(carried, ["entity", "part"]).withColumn("reach", F.greatest("carried", F.lag("e").over(order)))
    pieces = pieces.withColumn("opens", F.when(F.col("reach").isNull() | (F.col("s") > F.col("reach")), F.col("s")))
    pieces = pieces.withColumn("start", F.max("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = cut_lineage(pieces.select("entity", "part", "e", "reach", "opens", "start"))

    gaps = pieces.where("opens IS NOT NULL AND reach IS NOT NULL").select("entity", F.lit("gap").alias("kind"), F.col("reach").alias("start"), F.col("opens").alias("end"))
    if most_gap is not None:
        gaps = gaps.where(F.col("end") - F.col("start") < most_gap)
    # a stretch's pieces before its first opening belong to the last period opened in an earlier stretch
    opened = pieces.groupBy("entity", "part").agg(F.max("start").alias("last"), F.max(F.col("start").isNull()).alias("goes_on"))
    opened = opened.withColumn("from", F.max("last").over(earlier)).where("goes_on").select("entity", "part", "from")
    goes_on = pieces.where("start IS NULL").groupBy("entity", "part").agg(F.max("e").alias("e")).join(opened, ["entity", "part"]).select("entity", F.col("from").alias("start"), "e")
    periods = pieces.where("start IS NOT NULL").select("entity", "start", "e").union(goes_on).groupBy("entity", "start").agg(F.max("e").alias("end"))
    return periods.select("entity", F.lit("period").alias("kind"), "start", "end").unionByName(gaps)
