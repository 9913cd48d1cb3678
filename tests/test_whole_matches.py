"""Matches beside brute force over all pairs: none may be passed over by the keys under which rows meet."""

import random
from difflib import SequenceMatcher

import numpy as np
from pyspark.sql import functions as F

from fieldreel.functions.columns import phonetic_key
from fieldreel.operators import entities, similarity
from fieldreel.operators.fingerprints import path_score, propose_links


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_sounds_meet_all_within_the_distance(spark):
    rng = random.Random(5)

    def slip(name):
        for _ in range(rng.randrange(5)):
            at = rng.randrange(len(name))
            name = name[:at] + rng.choice(["", *"bdkmprst"]) + name[at + rng.randrange(2) :]
        return name or "p"

    known = ["parkinson trout", *("".join(rng.choice("bdkmprsta") for _ in range(rng.randrange(2, 14))) for _ in range(150))]
    asked = ["barkinson troul", *(slip(rng.choice(known)) for _ in range(150))]
    a = spark.createDataFrame(list(enumerate(asked)), "row int, q string")
    b = spark.createDataFrame([(f"e{i:03}", n) for i, n in enumerate(known)], "id string, name string")
    sounds = [(r.id, r.k) for r in b.select("id", phonetic_key(F.col("name")).alias("k")).collect() if r.k]
    for most in (0.30, 0.45):
        want = {}
        for r in a.select("row", phonetic_key(F.col("q")).alias("k")).collect():
            near = [(edits(r.k, k) / max(len(r.k), len(k)), e) for e, k in sounds if r.k]
            if (best := min(near, default=(1, ""))) and best[0] <= most:
                want[r.row] = best[::-1]
        got = {r.row: (r.id, r.distance) for r in entities.phonetic_matches(a, "row", "q", b, "id", "name", most).collect()}
        assert got == want and 0 in got and sum(d > 0 for _, d in got.values()) > 40


def test_names_meet_all_from_the_least_ratio_on(spark):
    rng = random.Random(6)
    known = ["hjonson", "x" * 70 + "jonson", *("".join(rng.choice("abcdeo ") for _ in range(rng.randrange(2, 12))) for _ in range(120))]
    asked = ["jonson", "x" * 68 + "jonson", *(n[:1] + rng.choice("abo") + n[2:] for n in known[2:90]), "aé b"]
    a = spark.createDataFrame(list(enumerate(asked)), "row int, q string")
    b = spark.createDataFrame([(f"e{i:03}", n) for i, n in enumerate(known)], "id string, name string")
    folded = {**{("a", r.row): r.f for r in a.select("row", entities.folded(F.col("q")).alias("f")).collect()}, **{("b", r.id): r.f for r in b.select("id", entities.folded(F.col("name")).alias("f")).collect()}}
    want = set()
    for (side, row), x in folded.items():
        if side == "a" and x:
            scores = [(-SequenceMatcher(None, x, y).ratio(), e) for (s, e), y in folded.items() if s == "b" and y]
            want |= {(row, e, round(-r, 9), n) for n, (r, e) in enumerate(sorted(s for s in scores if -s[0] >= 0.72)[:3], 1)}
    got = {(r.row, r.id, round(r.ratio, 9), r["rank"]) for r in entities.fuzzy_matches(a, "row", "q", b, "id", "name").collect()}
    assert got == want and (0, "e000", round(12 / 13, 9), 1) in got
    assert entities.fuzzy_matches(a.limit(0), "row", "q", b, "id", "name").count() == 0


def test_each_query_meets_all_rows(spark, monkeypatch):
    monkeypatch.setattr(similarity, "QUERY_BLOCK", 7)
    monkeypatch.setattr(similarity, "ROW_BLOCK", 40)
    rng = np.random.default_rng(7)
    v = rng.normal(size=(150, 8))
    v[100:130] = v[5]
    df = spark.createDataFrame([*((n, x.tolist()) for n, x in enumerate(v)), (900, [0.0] * 8), (901, None)], "id int, v array<double>")
    queries = df.where("id % 5 = 0").select(F.col("id").alias("q"), F.col("v").alias("w"))
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    want = set()
    for q in range(0, 150, 5):
        best = sorted((-round(float((unit[q] * unit[n]).sum()), 9), n) for n in range(150) if n != q)[:12]
        want |= {(q, n, rank) for rank, (_, n) in enumerate(best, 1)}
    got = similarity.cosine_top_k_each(df, "id", "v", queries, "q", "w", 12, apart=("q", "id")).collect()
    assert {(r.q, r.id, r["rank"]) for r in got} == want and len(got) == len(want)
    assert similarity.cosine_top_k_each(df, "id", "v", queries.limit(0), "q", "w", 12).count() == 0


def test_phrases_of_any_length_are_found(spark):
    long = "the old mill at the end of the north road by the lake"
    phrases = spark.createDataFrame([(long, "l"), ("The old mill", "m"), ("mill", "s"), ("lake shore", "x")], "phrase string, target string")
    texts = spark.createDataFrame([(1, f"We saw {long.title()}, again."), (2, "the old mill"), (3, "mill at the lake"), (4, None)], "d int, t string")
    got = {(r.d, r.target) for r in entities.dictionary_matches(texts, "d", "t", phrases, "phrase", "target").collect()}
    assert got == {(1, "l"), (1, "s"), (2, "m"), (2, "s"), (3, "s")}
    assert {(r.d, r.target) for r in entities.contains_matches(texts, "d", "t", phrases, "phrase", "target").collect()} == {(1, "l"), (2, "m")}


def test_labels_inside_one_another_meet_without_the_month(spark):
    rng = np.random.default_rng(8)
    print_ = rng.integers(0, 2**32, 40).tolist()
    rows = [(f"{n}", label, day, camera, print_) for n, (label, day, camera) in enumerate((x, d, c) for x in ("ridge", "north ridge", "lake", "", None) for d in ("2024-01-02", "2024-03-04", None) for c in ("a_1", "a_2", "b", None))]
    schema = "id string, label string, day string, camera string, fp array<long>"
    video, audio = spark.createDataFrame(rows, schema), spark.createDataFrame(rows, schema)
    score = path_score((F.col("v.label"), F.col("a.label")), (F.col("v.day"), F.col("a.day")), (F.col("v.camera"), F.col("a.camera")))
    want = {(r.v, r.a) for r in video.alias("v").crossJoin(audio.alias("a")).where(score >= 0.30).select(F.col("v.id").alias("v"), F.col("a.id").alias("a")).collect()}
    got = {(r.video_id, r.audio_id) for r in propose_links(video, audio, k=100).collect()}
    assert got == want and ("0", "17") in got
