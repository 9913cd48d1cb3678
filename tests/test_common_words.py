"""Names and texts that share common words or much of their rows: no pairs beyond those that can match, and the same results."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from fieldreel.functions.columns import tokens
from fieldreel.functions.python import Blocks
from fieldreel.operators import entities
from fieldreel.plans import tables


def rows_joined(df):
    """Rows that the joins of a frame's last plan put out, after it was collected."""
    total = 0

    def walk(node):
        nonlocal total
        metric = node.metrics().get("numOutputRows")
        if "Join" in node.nodeName() and metric.isDefined():
            total += metric.get().value()
        children = node.children()
        for n in range(children.size()):
            walk(children.apply(n))
        for inner in ("executedPlan", "plan"):
            if "AdaptiveSparkPlan" in node.nodeName() and inner == "executedPlan" or "QueryStage" in node.nodeName() and inner == "plan":
                walk(getattr(node, inner)())

    walk(df._jdf.queryExecution().executedPlan())
    return total


def test_names_meet_by_their_rarest_word(spark):
    n = 400
    asks = spark.createDataFrame([(i, f"aid station w{i}") for i in range(n)], "row int, q string")
    registry = spark.createDataFrame([(f"e{i}", [f"w{i} aid", "old station"]) for i in range(n)], "id string, aliases array<string>")
    found = entities.resolve_aliases(asks, "row", "q", registry, "id", "aliases")
    assert {(r.row, r.id, r.n) for r in found.collect()} == {(i, f"e{i}", 1) for i in range(n)}
    assert n <= rows_joined(found) <= 10 * n


def test_aliases_as_their_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    rng = random.Random(4)
    words = "aid station creek old w1 w2 w3 w4 w5".split()
    text = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(1, 4)))
    # ids of several names and of several rows of aliases, equal aliases under several ids, null aliases
    rows = [(f"p{rng.randrange(120)}", text(), rng.choice([None, [], [text()], [text(), None, text()], [text(), "  Aid-Station "]])) for _ in range(200)]
    spark.createDataFrame(rows, "id string, canonical_name string, aliases array<string>").coalesce(2).write.parquet(f"{tmp_path}/places.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW places AS SELECT * FROM read_parquet('{tmp_path}/places.parquet/*.parquet')")
    want = sorted(con.execute(f"SELECT row, id, n FROM ({tables.oracle_sql()['j41_aliases']})").fetchall(), key=repr)
    got = sorted(((r.row, r.id, r.n) for r in tables.queries()["j41_aliases"](spark, str(tmp_path)).select("row", "id", F.col("n").cast("int").alias("n")).collect()), key=repr)
    assert got == want and sum(n == 1 for _, _, n in got) > 5 and sum(n > 1 for _, _, n in got) > 20


def test_blocks_as_difflib_finds_them(spark):
    rng = random.Random(1)
    words = "keep going back toward the lake quiz jinx 48 zero x9 map filming radio clock".split()
    for k in range(300):
        letters = rng.choice(["abcde", "abcdefghijklmnopqrstuvwxyz0123456789 ", None])
        text = lambda n: "".join(rng.choice(letters) for _ in range(n)) if letters else " ".join(rng.choice(words) for _ in range(n // 5))  # noqa: B023, E731
        x, y = text(rng.choice([30, 200, 700])), text(rng.choice([50, 199, 200, 300, 900]))
        x = y[:20] + x if k % 5 == 0 else x[:40] + y[len(y) // 4 : len(y) // 2] + x[40:] if k % 3 == 0 else x
        y += "".join(rng.sample("!#$%&()*+^]-[\\ABCDEFGHIJ", 12)) if k % 7 == 0 else ""
        matcher, find = SequenceMatcher(None, x, y), Blocks(y).finder(x)
        for area in [(0, len(x), 0, len(y)), *((*sorted(rng.randrange(len(x) + 1) for _ in "ab"), *sorted(rng.randrange(len(y) + 1) for _ in "ab")) for _ in range(5))]:
            assert tuple(matcher.find_longest_match(*area)) == tuple(find(*area))


def test_links_of_one_kind_score_only_what_can_be_alike(spark, tmp_path):
    rng = random.Random(7)
    words = "keep going back toward lake quiz jinx 48 zero x9 map filming radio clock kept trail marshal ticket fog ridge".split()
    sentence = lambda n: " ".join(rng.choice(words) for _ in range(n))
    said = {f"r{k:03}": sentence(rng.choice([1, 3, 8, 60, 90])) for k in range(150)}
    said |= {f"s{k:03}": said[f"r{k:03}"] for k in range(6)} | {f"a{k:03}": f"{sentence(4)} {said[f'r{k:03}']} {sentence(2)}" for k in range(40)} | {"z1": "", "z2": "the"}
    spark.createDataFrame([(k, 1, t) for k, t in said.items()], "asset_id string, seg_idx int, text string").write.parquet(f"{tmp_path}/segment.parquet")
    spark.createDataFrame([(k, "video", "2024-05-03", rng.choice("xy")) for k in said], "asset_id string, record_kind string, shoot_date string, shoot_label string").write.parquet(f"{tmp_path}/asset.parquet")
    label = {r.asset_id: r.shoot_label for r in spark.read.parquet(f"{tmp_path}/asset.parquet").collect()}
    plain = {r.asset_id: " ".join(r.w) for r in spark.read.parquet(f"{tmp_path}/segment.parquet").select("asset_id", tokens(F.col("text")).alias("w")).collect()}
    want, met = {}, 0
    for a in sorted(said):
        for b in sorted(said):
            if a < b and label[a] == label[b]:
                met += 1
                x, y = plain[a], plain[b]
                if x and y:
                    both, matcher = set(x.split()) & set(y.split()), SequenceMatcher(None, x, y)
                    common = 1.0 if x in y or y in x else matcher.find_longest_match().size / max(8, min(len(x), len(y)))
                    score = 0.15 * len(both) / len({*x.split(), *y.split()}) + 0.35 * matcher.ratio() + 0.45 * common
                    if round(score, 4) >= 0.35:
                        want[a, b] = round(score, 3)
    found = tables.queries()["v18_same_kind_links"](spark, str(tmp_path))
    got = {(r.a, r.b): r.score for r in found.collect()}
    assert set(got) == set(want) and all(abs(got[p] - want[p]) < 6e-4 for p in want)
    assert 100 < len(want) < met / 4
    assert 0 < rows_joined(found) < met / 2
