import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldreel.functions import predicates
from fieldreel.operators import registries, search, vector_index
from fieldreel.operators.similarity import density_clusters
from fieldreel.sources import adhoc


def one(spark, *cols):
    return tuple(spark.range(1).select(*(c.alias(f"c{k}") for k, c in enumerate(cols))).first())


def test_predicates(spark):
    assert one(spark, *(predicates.bib_text(F.lit(t)) for t in ("12", " 1234 ", "1", "12345", "12a", None))) == (True, True, False, False, False, False)
    assert one(spark, *(predicates.skipped(F.lit(t), ("*.tmp", "cache/*", "a[0-9]?.x", "b[!0-9].x")) for t in ("x/y.TMP", "x/y.tmp", "cache/z", "q/a1z.x", "b1.x", "bz.x", None))) == (False, True, True, True, False, True, False)
    assert one(spark, predicates.noise_path(F.lit("/A/Trash.d/x"), ("trash.",)), predicates.noise_path(F.lit("/a/trashed"), ("trash.",)), predicates.noise_path(F.lit(None).cast("string"), ())) == (True, False, False)
    assert one(spark, predicates.theme_of(F.lit("b"), {"a": "x"}), predicates.theme_of(F.lit("a"), {"a": "x"}), predicates.theme_of(F.lit("a"), {}), predicates.theme_of(F.lit(None).cast("string"), {"a": "x"})) == ("?", "x", "?", None)
    assert one(spark, *(predicates.leading_name(F.lit(t)) for t in ('"The Auburn Lake of Ice melts', "melts in May", "É. Zola, said", None))) == ("Auburn Lake of Ice", None, "É. Zola", None)
    assert one(spark, predicates.stale_reason(F.lit(None).cast("string"), F.lit("p"), "p", F.lit("s")), predicates.stale_reason(F.lit("t"), F.lit(None).cast("string"), "p", F.lit("s")), predicates.stale_reason(F.lit("t"), F.lit("p"), "p", F.lit(" ")), predicates.stale_reason(F.lit("t"), F.lit("p"), "p", F.lit("s"))) == ("missing", "stale_prompt", "empty_summary", None)
    none = F.lit(None).cast("array<string>")
    assert one(spark, predicates.union_ids(F.array(F.lit("b"), F.lit(None)), F.array(F.lit("a"), F.lit("b"))), predicates.union_ids(none, none)) == (["a", "b"], [])


def test_labels_resolve_by_rule_parts_and_alias(spark):
    aliases = spark.createDataFrame([("Ann", "p1"), ("Bob", "p2"), ("Sam", "p3"), ("Sam", "p4")], "alias string, id string")
    rules = spark.createDataFrame([("the crew", "p9")], "alias string, id string")
    labels = spark.createDataFrame([("Ann",), ("Ann and Bob",), ("Sam/Ann",), ("Ann, Zed",), ("The  Crew",), ("",), (None,), ("Ann",)], "l string")
    got = {r.label: (r.ids, r.how) for r in registries.resolve_labels(labels, "l", rules, aliases).collect()}
    assert got == {"Ann": (["p1"], "direct"), "Ann and Bob": (["p1", "p2"], "composite"), "Sam/Ann": ([], "ambiguous"), "Ann, Zed": ([], "unknown"), "The  Crew": (["p9"], "rule")}
    assert registries.resolve_labels(labels.limit(0), "l", rules, aliases).count() == 0


def test_decisions_fill_registry_records_and_queue(spark):
    registry = spark.createDataFrame([("p1", ["Ann"]), ("p2", None)], "id string, aliases array<string>")
    records = spark.createDataFrame([("r1", ["p2"]), ("r2", None)], "record_id string, ids array<string>")
    queue = spark.createDataFrame([("Annie", "r1"), ("Zed", "r2"), ("Late", "r2")], "name string, record_id string")
    decisions = spark.createDataFrame([("Annie", "accept", "p1"), ("Annie", "reject", None), ("Zed", "reject", None), ("New", "accept", "p7"), ("Late", "wait", "p1")], "name string, action string, id string")
    a, b, c = registries.apply_decisions(registry, records, queue, decisions)
    assert {r.id: r.aliases for r in a.collect()} == {"p1": ["Ann", "Annie"], "p2": [], "p7": ["New"]}
    assert {r.record_id: r.ids for r in b.collect()} == {"r1": ["p1", "p2"], "r2": []}
    assert [r.name for r in c.collect()] == ["Late"]


def test_ranks_and_carry_over(spark):
    rows = spark.createDataFrame([("w", 1, "a", 0.9), ("w", 2, "a", 0.8), ("w", 3, "b", 0.7), ("w", 4, "c", 0.1), ("w", 5, "d", None)], "w string, i int, asset string, s double")
    assert [r.i for r in registries.top_then_threshold(rows, ["w"], "s", [F.col("i")], 3, 0.75).orderBy("rank").collect()] == [1, 2]
    assert [r.i for r in registries.distinct_asset_top_k(rows.where("s IS NOT NULL"), ["w"], "asset", "s", [F.col("i")], 2).orderBy("rank").collect()] == [1, 3]
    old = spark.createDataFrame([("a", 1.004, 7, "p1"), ("a", 1.0, 7, "p0"), ("a", 2.0, 7, None)], "asset_id string, t double, n int, p string")
    new = spark.createDataFrame([("a", 1.001, 7), ("a", 2.0, 7), ("b", 1.0, 7)], "asset_id string, t double, n int").withColumn("p", F.lit(None).cast("string"))
    assert {(r.asset_id, r.t): r.p for r in registries.carry_over(new, old, "t", "n", "p").collect()} == {("a", 1.001): "p0", ("a", 2.0): None, ("b", 1.0): None}


def test_adhoc_sql_binds_tables_of_schemas(spark):
    a, b = spark.createDataFrame([(1, "x")], "k int, v string"), spark.createDataFrame([(1, "from cat.t")], "k int, w string")
    schemas = {"cat": {"t": a, "only": a}, "tr": {"t": b}}
    assert [tuple(r) for r in adhoc.ask(spark, schemas, "SELECT x.v, y.w FROM cat.t AS x JOIN tr.t y ON x.k = y.k WHERE y.w = 'from cat.t'").collect()] == [("x", "from cat.t")]
    assert adhoc.ask(spark, schemas, "SELECT only.v FROM only WHERE k = 1").count() == 1
    assert [r.n for r in adhoc.ask(spark, schemas, "WITH q AS (SELECT k FROM cat.only) SELECT count(*) AS n FROM q").collect()] == [1]


def test_stored_index_against_brute_force(spark, tmp_path):
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(150, 16))
    x = (centre[rng.integers(0, 150, 900)] + rng.normal(scale=0.2, size=(900, 16))).astype(np.float32)
    df = spark.createDataFrame([(int(i), f"a{i % 40}", [float(f) for f in v]) for i, v in enumerate(x)] + [(5_000, "z", None), (5_001, "z", [0.0] * 16)], "id long, asset string, v array<float>")
    path = str(tmp_path / "index")
    vector_index.build(df, "id", "v", path, asset="asset", fit_rows=400)
    queries = df.where("id % 20 = 0 AND id < 900").select(F.col("id").alias("q"), "v")
    got = {(r.q, r.id) for r in vector_index.search(spark, path, queries, "q", "v", 5, apart=True).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    cosine = unit @ unit.T
    np.fill_diagonal(cosine, -2)
    want = {(q, int(i)) for q in range(0, 900, 20) for i in np.argsort(-cosine[q], kind="stable")[:5]}
    assert len(got & want) >= 0.9 * len(want) and len(got) == len(want)
    assert {r.id for r in vector_index.search_key(spark, path, 40, 5).collect()} == {i for q, i in got if q == 40}
    assets = df.select("id", "asset").join(vector_index.search(spark, path, queries, "q", "v", 5, by_asset=True), "id").groupBy("q").agg(F.count("*").alias("n"), F.count_distinct("asset").alias("m")).collect()
    assert all(r.n == r.m == 5 for r in assets)
    assert vector_index.search_key(spark, path, 77_777, 5).count() == 0


def test_dense_groups_and_noise(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(3, 12))
    x = np.concatenate([c + rng.normal(scale=0.15, size=(25, 12)) for c in centres] + [rng.normal(size=(15, 12))])
    df = spark.createDataFrame([(int(i), [float(f) for f in v]) for i, v in enumerate(x)], "id int, v array<double>")
    got = {r.id: r.cluster for r in density_clusters(df, "id", "v", least=0.85).collect()}
    assert [{got[i] for i in range(k * 25, k * 25 + 25)} for k in range(3)] == [{0}, {25}, {50}]
    assert all(got[i] is None for i in range(75, 90))


@pytest.mark.parametrize("limit, over", [(1.0, True), (10.0, False)])
def test_budget(spark, limit, over):
    df = spark.createDataFrame([(2.0,), (None,)], "c double")
    assert tuple(registries.budget_left(df, "c", limit).first()) == (2.0, limit - 2.0, over)
    assert tuple(registries.budget_left(df.limit(0), "c", limit).first()) == (0.0, limit, False)


def test_stored_search_index_reads_its_terms_only(spark, tmp_path):
    texts = [(1, "the storm build grew"), (2, "a storm came, storms left"), (3, "the ridge"), (4, None), (5, " "), (6, "stormy étude storm")]
    df = spark.createDataFrame(texts, "id int, t string")
    made = search.build_index(df, "id", "t", stemmed=False)
    search.save_index(made, str(tmp_path / "index"))
    stored = search.load_index(spark, str(tmp_path / "index"))
    for query in ("storm", "storm build", "étude", "nothing", ""):
        fresh, read = ({(r.doc, round(r.score, 9)) for r in search.bm25(i, query, stemmed=False).collect()} for i in (made, stored))
        assert fresh == read
    for query in ('"storm build" OR ridge', "stor* NOT build", "st*", "the AND storm"):
        fresh, read = ({r.doc for r in search.match(i, query, stemmed=False).collect()} for i in (made, stored))
        assert fresh == read and fresh
    plan = search.bm25(stored, "storm", stemmed=False)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(folder" in plan or "folder#" in plan.split("PartitionFilters", 1)[1][:200]
