"""Interval, nearest, blocked and cascading joins, written as equi-joins on bounded keys so that hot entities spread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldreel.functions.columns import overlap
from fieldreel.session import steady

#: Stretches that one interval may span.
MOST_STRETCHES = 1_000_000


def _stretch(c: Column, width: float) -> Column:
    return F.floor(c / width).cast("bigint")


def _cells(a: Column, b: Column, width: float) -> Column:
    """The stretches from a to b; an interval over more than ``MOST_STRETCHES`` is an error, as one corrupt bound would else fill a task."""
    first, last = _stretch(a, width), _stretch(b, width)
    return F.when(last - first > MOST_STRETCHES, F.raise_error(F.lit(f"an interval spans more than {MOST_STRETCHES} stretches; take a greater width"))).otherwise(F.sequence(first, last))


def interval_join(left: DataFrame, right: DataFrame, on: str, l: tuple[str, str], r: tuple[str, str], *, width: float, half_open: bool = False, tolerance: float = 0.0) -> DataFrame:  # noqa: E741
    """Rows of both sides with one ``on`` whose intervals overlap; touching counts unless ``half_open``.

    Both sides are spread over stretches of ``width``; a pair that shares several stretches is kept in the first of
    them only. Rows with a null or reversed bound or null key match nothing. Column names of the sides must differ but
    for ``on``. A point is an interval of two equal bounds; ``tolerance`` widens the right side.
    """
    a, b = (F.col(x) for x in l)
    c, d = F.col(r[0]) - tolerance, F.col(r[1]) + tolerance
    lo, hi = left.where(a <= b), right.where(c <= d)
    lo = lo.withColumn("_l", _stretch(a, width)).withColumn("_s", F.explode(_cells(a, b, width)))
    hi = hi.withColumn("_r", _stretch(c, width)).withColumn("_s", F.explode(_cells(c, d, width)))
    meets = (a < d) & (b > c) if half_open else (a <= d) & (b >= c)
    return lo.join(hi, [on, "_s"]).where(meets & (F.col("_s") == F.greatest("_l", "_r"))).drop("_s", "_l", "_r")


def overlap_vote(left: DataFrame, right: DataFrame, on: str, l: tuple[str, str], r: tuple[str, str], group: str, vote: str, *, width: float) -> DataFrame:  # noqa: E741
    """Rows (on, group, vote, seconds): seconds that intervals of a group and of a vote share, summed."""
    met = interval_join(left, right, on, l, r, width=width, half_open=True)
    return met.groupBy(on, group, vote).agg(F.sum(overlap(F.col(l[0]), F.col(l[1]), F.col(r[0]), F.col(r[1]))).alias("seconds"))


def nearest(left: DataFrame, right: DataFrame, on: str, at: str, key: str, moment: str, *, id: str, width: float) -> DataFrame:
    """``left`` with the nearest row of ``right`` on either side: (before, after, nearest) as structs (moment, id); null where there is none.

    ``key`` identifies a row of ``left``. A row at the same moment is nearest before. On equal distance the later one
    wins; of several rows at one moment that with the smallest id. Both sides meet in one ordering per entity and
    stretch of ``width``; what lies beyond comes from one summary row per stretch, so hot entities spread.
    """
    points = right.where(F.col(moment).isNotNull() & F.col(on).isNotNull()).groupBy(on, moment).agg(F.min(id).alias("_id"))
    asks = left.where(F.col(at).isNotNull() & F.col(on).isNotNull()).select(on, key, F.col(at).alias("_t"))
    hit = F.struct(F.col(moment).alias("moment"), F.col("_id").alias("id"))
    points = points.select(on, F.col(moment).alias("_t"), _stretch(F.col(moment), width).alias("_s"), hit.alias("_p"))
    both = points.withColumn(key, F.lit(None).cast(left.schema[key].dataType)).unionByName(asks.withColumn("_s", _stretch(F.col("_t"), width)).withColumn("_p", F.lit(None).cast(points.schema["_p"].dataType)))
    order = Window.partitionBy(on, "_s").orderBy("_t", F.col("_p").isNull())
    inner = both.withColumn("_b", F.last("_p", True).over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_a", F.first("_p", True).over(order.rowsBetween(0, Window.unboundedFollowing)))
    marks = both.groupBy(on, "_s").agg(F.max("_p").alias("_hi"), F.min("_p").alias("_lo"))
    by = Window.partitionBy(on).orderBy("_s")
    marks = marks.select(on, "_s", F.last("_hi", True).over(by.rowsBetween(Window.unboundedPreceding, -1)).alias("_pb"), F.first("_lo", True).over(by.rowsBetween(1, Window.unboundedFollowing)).alias("_pa"))
    found = inner.where(F.col(key).isNotNull()).join(marks, [on, "_s"]).select(key, F.col("_t"), F.coalesce("_b", "_pb").alias("before"), F.coalesce("_a", "_pa").alias("after"))
    gap_b, gap_a = F.col("_t") - F.col("before.moment"), F.col("after.moment") - F.col("_t")
    pick = F.when(F.col("after").isNull() | (gap_b < gap_a) | (gap_b == 0), F.coalesce("before", "after")).otherwise(F.col("after"))
    return left.join(found.select(key, "before", "after", pick.alias("nearest")), key, "left")


def covered_seconds(df: DataFrame, start: str, end: str, out: str = "second") -> DataFrame:
    """One row for each whole second that an interval touches."""
    return df.where(F.col(start) <= F.col(end)).withColumn(out, F.explode(_cells(F.col(start), F.col(end), 1.0)))


def block_pairs(df: DataFrame, keys: list[str], id: str) -> DataFrame:
    """Pairs of different rows that share all block keys, once each, as structs a and b with a.id < b.id. Blocks must be small by nature; null keys share nothing."""
    rows = df.select(*keys, F.struct("*").alias("a"))
    return rows.join(rows.withColumnRenamed("a", "b"), keys).where(F.col(f"a.{id}") < F.col(f"b.{id}")).select("a", "b")


def sorted_neighbours(df: DataFrame, value: str, id: str, reach: int = 24) -> DataFrame:
    """Pairs (a, b, value_a, value_b) of rows at most ``reach`` apart in the order of ``value`` that begin with the same letter.

    Rows are numbered within the first letters of their value, and counted on from the letters before; so no task orders
    all rows of a letter. Only rows whose number lies in a neighbouring block meet.
    """
    rows = df.where(F.length(value) > 0).select(F.left(value, F.lit(1)).alias("_f"), F.left(value, F.lit(4)).alias("_g"), F.col(value).alias("v"), F.col(id).alias("i"))
    before = Window.partitionBy("_f").orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("_f", "_g").agg(F.count("*").alias("_c")).select("_f", "_g", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_o"))
    rows = rows.withColumn("_r", F.row_number().over(Window.partitionBy("_f", "_g").orderBy("v", "i"))).join(offsets, ["_f", "_g"]).select("_f", "v", "i", (F.col("_r") + F.col("_o")).alias("n"))
    left = rows.select("_f", F.col("i").alias("a"), F.col("v").alias("value_a"), F.col("n").alias("na"), F.explode(F.array(F.floor(F.col("n") / reach), F.floor(F.col("n") / reach) + 1)).alias("_k"))
    right = rows.select("_f", F.col("i").alias("b"), F.col("v").alias("value_b"), F.col("n").alias("nb"), F.floor(F.col("n") / reach).alias("_k"))
    return left.join(right, ["_f", "_k"]).where((F.col("nb") > F.col("na")) & (F.col("nb") <= F.col("na") + reach)).select("a", "b", "value_a", "value_b")


def ancestors_of_path(path: Column) -> Column:
    """All parent folders of a path, nearest first."""
    parts = F.split(F.regexp_replace(path, r"\\", "/"), "/")
    return F.transform(F.sequence(F.size(parts) - 1, F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def under_folder(files: DataFrame, file_path: str, folders: DataFrame, folder: str) -> DataFrame:
    """Files joined with each folder above them, by equality on exploded parents."""
    return files.withColumn("_up", F.explode(ancestors_of_path(F.col(file_path)))).join(folders.withColumn("_up", F.col(folder)), "_up").drop("_up")


def near_match(wanted: DataFrame, present: DataFrame, keys: list[str], id: str, anchor: str) -> DataFrame:
    """For each wanted row (id): ``exact``, ``rebind`` (one present row agrees in all keys but one), ``ambiguous`` (several do) or ``orphan``, with the row it binds to.

    Rows meet by all keys but one at a time, so no block is wider than rows that agree in all others.
    """
    steady(wanted.sparkSession)
    there = present.select(F.col(id).alias("_to"), *keys)
    exact = wanted.join(there, keys).groupBy(id).agg(F.min("_to").alias("to")).withColumn("status", F.lit("exact"))
    rest = wanted.join(exact.select(id), id, "left_anti")
    close = [rest.select(id, *(k for k in keys if k != skip)).join(there.select("_to", *(k for k in keys if k != skip)), [k for k in keys if k != skip]).select(id, "_to") for skip in keys if skip != anchor]
    near = close[0]
    for more in close[1:]:
        near = near.union(more)
    near = near.distinct().groupBy(id).agg(F.count("*").alias("n"), F.min("_to").alias("to"))
    near = near.select(id, F.when(F.col("n") == 1, F.col("to")).alias("to"), F.when(F.col("n") == 1, "rebind").otherwise("ambiguous").alias("status"))
    known = exact.unionByName(near)
    return wanted.select(id).join(known, id, "left").select(id, F.coalesce("status", F.lit("orphan")).alias("status"), "to")


def lookup(rows: DataFrame, table: DataFrame, key: str, spread: str, how: str = "inner", hot: int = 1_000_000) -> DataFrame:
    """``rows`` joined with the one row that ``table`` has for each ``key``; keys of more than ``hot`` rows meet in several parts, chosen by the column ``spread``.

    Only keys that are hot are counted out, after counts are combined before the shuffle, and only their rows of the
    table are repeated.
    """
    many = rows.groupBy(key).agg(F.ceil(F.count("*") / hot).cast("int").alias("_p")).where("_p > 1")
    left = rows.join(many, key, "left").withColumn("_s", F.pmod(F.xxhash64(spread), F.coalesce("_p", F.lit(1)))).drop("_p")
    right = table.join(many, key, "left").withColumn("_s", F.explode(F.sequence(F.lit(0).cast("bigint"), (F.coalesce("_p", F.lit(1)) - 1).cast("bigint")))).drop("_p")
    return left.join(right, [key, "_s"], how).drop("_s")


def cascade(df: DataFrame, key: str, lookups: list[tuple[Column, DataFrame, str, str]], out: str) -> DataFrame:
    """``df`` with ``out``: the value of the first lookup (expression over df, table, key column, value column) that knows it.

    A lookup key that has several values is taken as unknown.
    """
    values = []
    for n, (expression, table, k, v) in enumerate(lookups):
        only = table.groupBy(F.col(k).alias(f"_k{n}")).agg(F.min(v).alias(f"_v{n}"), F.max(v).alias("_w")).where(f"_v{n} = _w").drop("_w")
        df = df.withColumn(f"_e{n}", expression).join(only, F.col(f"_e{n}") == F.col(f"_k{n}"), "left").drop(f"_e{n}", f"_k{n}")
        values.append(f"_v{n}")
    return df.withColumn(out, F.coalesce(*values)).drop(*values)


def symmetric_edges(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Distinct edges (src, dst, symmetric): whether the opposite edge exists."""
    own = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).dropna().distinct()
    both = own.select(F.least("src", "dst").alias("lo"), F.greatest("src", "dst").alias("hi"), (F.col("src") <= F.col("dst")).alias("up"))
    both = both.groupBy("lo", "hi").agg(F.max(F.col("up").cast("int")).alias("up"), F.max((~F.col("up")).cast("int")).alias("down"))
    ways = F.array_compact(F.array(F.when(F.col("up") == 1, F.struct(F.col("lo").alias("src"), F.col("hi").alias("dst"))), F.when(F.col("down") == 1, F.struct(F.col("hi").alias("src"), F.col("lo").alias("dst")))))
    return both.select(F.explode(ways).alias("e"), ((F.col("up") == 1) & ((F.col("down") == 1) | (F.col("lo") == F.col("hi")))).alias("symmetric")).select("e.src", "e.dst", "symmetric")


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct rows of both snapshots with change added, removed or unchanged; nulls equal nulls."""
    both = old.select(*keys).distinct().withColumn("_o", F.lit(1)).withColumn("_n", F.lit(0)).union(new.select(*keys).distinct().withColumn("_o", F.lit(0)).withColumn("_n", F.lit(1)))
    both = both.groupBy(*keys).agg(F.max("_o").alias("_o"), F.max("_n").alias("_n"))
    return both.select(*keys, F.when(F.col("_o") == 0, "added").when(F.col("_n") == 0, "removed").otherwise("unchanged").alias("change"))


def compare_listings(here: DataFrame, there: DataFrame, path: str, size: str, modified: str) -> DataFrame:
    """Full outer comparison of two file listings: only_here, only_there, same, newer_here, newer_there or conflict."""
    a = here.select(path, F.col(size).alias("size_a"), F.col(modified).alias("mod_a"))
    b = there.select(path, F.col(size).alias("size_b"), F.col(modified).alias("mod_b"))
    both = a.join(b, path, "full_outer")
    state = F.when(F.col("size_b").isNull(), "only_here").when(F.col("size_a").isNull(), "only_there").when((F.col("size_a") == F.col("size_b")) & (F.col("mod_a") == F.col("mod_b")), "same")
    return both.withColumn("state", state.when(F.col("mod_a") > F.col("mod_b"), "newer_here").when(F.col("mod_a") < F.col("mod_b"), "newer_there").otherwise("conflict"))
