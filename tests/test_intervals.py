import random

from pyspark.sql import functions as F

from fieldreel.operators.intervals import periods_and_gaps, whole_ms


def brute(rows, most_gap):
    out = set()
    for entity in {r[0] for r in rows if r[0] is not None}:
        own = sorted({(s, e) for x, s, e in rows if x == entity and s is not None and e is not None and s < e})
        periods = []
        for s, e in own:
            if periods and s <= periods[-1][1]:
                periods[-1][1] = max(periods[-1][1], e)
            else:
                periods.append([s, e])
        out |= {(entity, "period", s, e) for s, e in periods}
        out |= {(entity, "gap", a[1], b[0]) for a, b in zip(periods, periods[1:]) if b[0] - a[1] < most_gap}
    return out


def test_against_brute_force_over_many_stretches(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "a", "b", "c", None]), s, s + rng.choice([-3, 0, 1, 5, 40, 900])) for s in (rng.randrange(3_000) for _ in range(900))]
    rows += rows[:50] + [("a", None, 4), ("a", 4, None), ("d", 5, 5)]
    df = spark.createDataFrame(rows, "id string, s long, e long").withColumn("entity", F.lit("clash")).withColumn("part", F.lit(1))
    got = {tuple(r) for r in periods_and_gaps(df, "id", F.col("s"), F.col("e"), stretch=50, most_gap=20).collect()}
    assert got == brute(rows, 20)


def test_touching_join_and_break_is_left_out(spark):
    rows = [("a", 0, 10), ("a", 10, 20), ("a", 1_800_020, 1_800_030), ("a", 1_800_040, 1_800_050)]
    got = periods_and_gaps(spark.createDataFrame(rows, "id string, s long, e long"), "id", F.col("s"), F.col("e")).where("kind = 'gap'").collect()
    assert [(r.start, r.end) for r in got] == [(1_800_030, 1_800_040)]


def test_empty_and_odd_numbers(spark):
    df = spark.createDataFrame([], "id string, s double, e double")
    assert periods_and_gaps(df, "id", whole_ms(F.col("s")), whole_ms(F.col("e"))).count() == 0
    df = spark.createDataFrame([("a", float("nan"), 1.0), ("a", 0.0, float("inf")), ("a", 0.1, 0.3)], "id string, s double, e double")
    got = periods_and_gaps(df, "id", whole_ms(F.col("s")), whole_ms(F.col("e"))).collect()
    assert [(r.start, r.end) for r in got] == [(100, 300)]
