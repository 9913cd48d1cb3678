import random

import pytest
from pyspark.sql import functions as F

from fieldreel.operators import entities, graph, islands, joins, ranking, search, similarity
from fieldreel.plans import quality
from fieldreel.sources import files
from fieldreel.streaming import windows


@pytest.mark.parametrize("half_open", [True, False])
def test_interval_join_against_all_pairs(spark, half_open):
    rng = random.Random(5)
    side = lambda n: [(rng.choice("ab"), k, s, s + rng.choice([0, 1, 5, 200])) for k in range(n) for s in [rng.randrange(500)]]
    left, right = side(80), side(80) + [("a", 900, 7, 3), ("a", 901, None, 3)]
    got = joins.interval_join(spark.createDataFrame(left, "k string, i int, a int, b int"), spark.createDataFrame(right, "k string, j int, c int, d int"), "k", ("a", "b"), ("c", "d"), width=50, half_open=half_open)
    want = sorted((x[1], y[1]) for x in left for y in right if x[0] == y[0] and y[2] is not None and y[2] <= y[3] and ((x[2] < y[3] and x[3] > y[2]) if half_open else (x[2] <= y[3] and x[3] >= y[2])))
    assert sorted((r.i, r.j) for r in got.collect()) == want


def test_nearest_over_many_stretches(spark):
    rng = random.Random(6)
    points = [("a", rng.randrange(2_000) / 2, k) for k in range(40)]
    asks = [(k, rng.choice("ab"), rng.randrange(2_200) / 2 - 20) for k in range(60)]
    got = joins.nearest(spark.createDataFrame(asks, "key int, e string, t double"), spark.createDataFrame(points, "e string, m double, id int"), "e", "t", "key", "m", id="id", width=30.0).collect()
    for r in got:
        own = sorted((m, i) for e, m, i in points if e == r.e)
        if not own:
            assert r.nearest is None
            continue
        gap = min(abs(m - r.t) for m, _ in own)
        assert abs(r.nearest.moment - r.t) == gap
        later = [m for m, _ in own if m - r.t == gap]
        assert r.nearest.moment == (later[0] if later else r.t - gap)


def test_near_match_and_cascade(spark):
    wanted = spark.createDataFrame([(1, "a", 1, 2), (2, "a", 9, 2), (3, "b", 1, 1), (4, "c", 5, 9)], "id int, x string, y int, z int")
    present = spark.createDataFrame([(11, "a", 1, 2), (12, "b", 1, 5), (13, "b", 7, 1), (14, "q", 1, 1)], "id int, x string, y int, z int")
    got = {r.id: (r.status, r.to) for r in joins.near_match(wanted, present, ["x", "y", "z"], "id", "x").collect()}
    assert got == {1: ("exact", 11), 2: ("rebind", 11), 3: ("ambiguous", None), 4: ("orphan", None)}
    table = spark.createDataFrame([("k", "v"), ("twice", "1"), ("twice", "2")], "a string, b string")
    out = joins.cascade(spark.createDataFrame([("k",), ("twice",), ("K",)], "q string"), "q", [(F.col("q"), table, "a", "b"), (F.lower("q"), table, "a", "b")], "o")
    assert {r.q: r.o for r in out.collect()} == {"k": "v", "twice": None, "K": "v"}


def test_folders(spark):
    got = joins.under_folder(spark.createDataFrame([("/a/b/c.wav",)], "f string"), "f", spark.createDataFrame([("/a",), ("/a/b",), ("/a/x",)], "d string"), "d").collect()
    assert sorted(r.d for r in got) == ["/a", "/a/b"]


def test_assign_ids_fills_gaps(spark):
    prior = spark.createDataFrame([("k1", "v", 2), ("old", "v", 4)], "key string, prefix string, number int")
    df = spark.createDataFrame([("k1", "v", 0), ("n1", "v", 1), ("n2", "v", 2), ("n3", "v", 3), ("m", "w", 0)], "key string, prefix string, at int")
    fixed = ranking.assign_ids(df, ["key"], "prefix", ["at"], prior)
    got = {r.key: r.clip_id for r in fixed.collect()}
    assert got == {"k1": "v_002", "n1": "v_001", "n2": "v_003", "n3": "v_005", "m": "w_001"}


def test_budget_and_chunks(spark):
    df = spark.createDataFrame([("a", 0.0, 10.0, 5.0), ("a", 20.0, 50.0, 30.0), ("a", 60.0, 65.0, 1.0)], "k string, s double, e double, v double")
    assert sorted(r.s for r in ranking.greedy_budget(df, ["k"], "s", "e", "v", 36.0).collect()) == [20.0, 60.0]
    text = spark.createDataFrame([("a", 0.0, 1.0, "x" * 300), ("a", 1.0, 2.0, "y" * 219), ("a", 2.0, 3.0, "z"), ("a", 90.0, 95.0, "w"), ("a", 4.0, None, "q"), ("a", 5.0, 6.0, " ")], "k string, s double, e double, t string")
    assert [(r.start, r.end) for r in ranking.greedy_chunks(text, "k", "s", "e", "t").orderBy("chunk_idx").collect()] == [(0.0, 2.0), (2.0, 3.0), (90.0, 95.0)]


def test_subtract_and_stereo(spark):
    spans = spark.createDataFrame([("a", 0, 100), ("a", 90, 200), ("b", 0, 5)], "k string, s long, e long")
    holes = spark.createDataFrame([("a", 50, 120), ("a", 199, 300)], "k string, s long, e long")
    assert sorted((r.k, r.start, r.end) for r in islands.subtract(spans, holes, "k", ("s", "e"), ("s", "e")).collect()) == [("a", 0, 50), ("a", 120, 199), ("b", 0, 5)]
    tracks = spark.createDataFrame([("x", 1), ("x", 2), ("x", 4), ("x", 5), ("x", 6), ("y", 2)], "k string, t int")
    assert sorted((r.k, r.t) for r in islands.collapse_stereo(tracks, ["k"], "t").collect()) == [("x", 1), ("x", 4), ("x", 6), ("y", 2)]


def test_search_grammar(spark):
    df = spark.createDataFrame([(1, "The storms were building"), (2, "storm warning, café"), (3, "a warning storm"), (4, None), (5, "")], "id int, t string")
    index = search.build_index(df, "id", "t")
    found = lambda q: {r.doc for r in search.match(index, q).collect()}
    assert found("storm") == {1, 2, 3} and found('"storm warning"') == {2} and found("storm NOT warn") == {1} and found("(cafe OR build*) AND storm") == {1, 2}
    assert found("") == set() and found("NOT storm") == set() and found('"storm') == {1, 2, 3}
    assert [r.doc for r in search.bm25(index, "warning cafe").collect()] == [2]


def test_vectors(spark):
    df = spark.createDataFrame([(1, "a", [1.0, 0.0]), (2, "a", [0.8, 0.6]), (3, "b", [0.0, 1.0]), (4, "b", [0.0, 0.0]), (5, "b", None)], "id int, g string, v array<float>")
    assert [r.id for r in similarity.cosine_top_k(df, "v", [1.0, 0.0], 2, [F.col("id")]).collect()] == [1, 2]
    assert similarity.cosine_top_k(df, "v", [1.0, 0.0], 2, [F.col("id")], df.limit(0).select("id"), "id").count() == 0
    assert {r.g: (r.n, [round(x, 3) for x in r.vector]) for r in similarity.group_means(df, "g", "v").collect()} == {"a": (2, [0.9, 0.3]), "b": (1, [0.0, 1.0])}
    near = {r.id: (r.g, r.passed) for r in similarity.nearest_centroid(df, "id", "v", similarity.centroids(df, "g", "v"), "g").collect()}
    assert near == {1: ("a", True), 2: ("a", True), 3: ("b", True)}
    assert similarity.nearest_centroid(df, "id", "v", similarity.centroids(df.limit(0), "g", "v"), "g").count() == 0
    frames = spark.createDataFrame([("x", 1.0, 1, [1.0, 0.0]), ("x", 9.0, 2, [0.0, 1.0]), ("y", 2.0, 3, [0.9, 0.1])], "asset_id string, at double, frame_id int, vector array<float>")
    cuts = spark.createDataFrame([(1, "x", 2.0, "y", 0.0), (2, "x", 2.0, "x", 9.0), (3, "z", 0.0, "x", 0.0)], "id int, oa string, ot double, ia string, it double")
    assert {r.id: r.grade for r in similarity.cut_deltas(cuts, frames, id="id", out_asset="oa", out_at="ot", in_asset="ia", in_at="it").collect()} == {1: "clean", 2: "hard", 3: "no_out"}


def test_graphs(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(70)] + [(k, k + 1) for k in range(200, 260)] + [(300, j) for j in range(301, 340)]
    df = spark.createDataFrame(edges, "a int, b int")
    group = {x: {x} for e in edges for x in e}
    for a, b in edges:
        if group[a] is not group[b]:
            group[a] |= group[b]
            for x in group[b]:
                group[x] = group[a]
    assert {(r.id, r.component) for r in graph.components(df, "a", "b").collect()} == {(x, min(g)) for x, g in group.items()}
    assert graph.components(df.limit(0), "a", "b").count() == 0
    reach = graph.directed_reach(spark.createDataFrame([(1, 2), (2, 3), (3, 1), (5, 1)], "a int, b int"), "a", "b", spark.createDataFrame([(1,), (9,)], "s int"), "s")
    assert {tuple(r) for r in reach.collect()} == {(1, 1), (1, 2), (1, 3), (9, 9)}
    merges = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "x"), ("q", "q")], "l string, w string")
    assert {r.id: r.final for r in graph.resolve_merges(merges, "l", "w").collect()} == {"a": "c", "b": "c", "x": "x", "y": "x"}
    tree = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", None), ("d", "gone"), ("e", "f"), ("f", "e")], "id string, p string")
    assert {tuple(r) for r in graph.ancestors(tree, "id", "p", 3).collect()} == {("a", "b", 1), ("a", "c", 2), ("b", "c", 1), ("e", "f", 1), ("f", "e", 1)}
    assert {r.id for r in graph.cycles(tree, "id", "p").collect()} == {"e", "f"}


def test_entities(spark):
    registry = spark.createDataFrame([("p1", "Jane Doe", ["Jane", "J. Doe"]), ("p2", "Janet Doe", ["Janet"]), ("p3", "Bob Stone", ["Bob", "the rock"])], "id string, name string, aliases array<string>")
    asks = spark.createDataFrame([(1, "jane"), (2, "doe j"), (3, "nobody"), (4, "")], "row int, q string")
    assert {r.row: (r.id, r.n) for r in entities.resolve_aliases(asks, "row", "q", registry, "id", "aliases").collect()} == {1: ("p1", 1), 2: ("p1", 1), 3: (None, 0)}
    texts = spark.createDataFrame([(1, "I met The Rock, and Janet."), (2, "rocky bobcat"), (3, None)], "d int, t string")
    names = registry.select("id", F.explode("aliases").alias("a"))
    assert {(r.d, r.target) for r in entities.dictionary_matches(texts, "d", "t", names, "a", "id").collect()} == {(1, "p3"), (1, "p2")}
    fuzzy = entities.fuzzy_matches(spark.createDataFrame([(1, "Jane Do")], "row int, q string"), "row", "q", registry, "id", "name").collect()
    assert [r.id for r in fuzzy][0] == "p1"
    sound = entities.phonetic_matches(spark.createDataFrame([(1, "Jayn Dough"), (2, "Zzz")], "row int, q string"), "row", "q", registry, "id", "name").collect()
    assert [(r.row, r.id) for r in sound] == [(1, "p1")]
    merged = entities.merge_registry(registry.withColumn("m", F.lit(1)), "id", "name", "aliases", "m", spark.createDataFrame([("p2", "p1")], "id string, final string"))
    assert {r.id: (r.name, r.m, r.aliases) for r in merged.collect()}["p1"] == ("Jane Doe", 2, ["J. Doe", "Jane", "Janet", "Janet Doe"])
    audit = entities.reference_audit(spark.createDataFrame([("a", ["p1", "zz"])], "id string, refs array<string>"), "id", "refs", registry.select("id").union(registry.limit(1).select("id")), "id", "^p")
    assert {(r.kind, r.ref) for r in audit.collect()} == {("missing", "zz"), ("duplicate", "p1")}


def test_quality(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "x"), ("b", None, None)], "k string, n int, t string")
    assert [tuple(r) for r in quality.key_problems(df, ["k", "n"], "rows").orderBy("k").collect()] == [("a", 1, 2), ("b", None, 1)]
    assert [tuple(r) for r in quality.contradictions(df.where("k = 'b'"), {"no_t": F.col("t").isNull(), "unknown": F.col("n") > 1}, "k").collect()] == [("b", "no_t")]
    assert {r.k: (r.top, r.share) for r in quality.dominance(df, "k", "t").collect()} == {"a": ("x", 1.0)}


def test_files(spark, tmp_path):
    data = b"q" * (3 << 20)
    (tmp_path / "bin").mkdir()
    (tmp_path / "bin" / "a.dat").write_bytes(data)
    (tmp_path / "bin" / "b.dat").write_bytes(b"xyz")
    import hashlib

    want = {len(d): hashlib.sha256((d if len(d) <= 2 << 20 else d[: 1 << 20] + d[-(1 << 20) :]) + len(d).to_bytes(8, "big")).hexdigest() for d in (data, b"xyz")}
    assert {r.length: r.asset_id for r in files.read_file_ids(spark, str(tmp_path / "bin")).collect()} == want
    url = "file://localhost/C%3a/a%20b/%C3%A9+1%25.mov"
    got = spark.createDataFrame([("C:\\a b\\é+1%.mov",)], "p string").select(files.url_of_path(F.col("p")).alias("u")).select("u", files.path_of_url(F.col("u")).alias("p")).first()
    assert (got.u, got.p) == (url, "C:/a b/é+1%.mov")
    (tmp_path / "l.jsonl").write_text('{"a": 1}\n\nbad\n')
    assert [tuple(r) for r in files.json_line_errors(spark, str(tmp_path / "l.jsonl")).collect()] == [("l.jsonl", 3, "l.jsonl#L003")]
    table = str(tmp_path / "t")
    files.replace_table(spark.range(3), table)
    files.replace_table(spark.range(5), table)
    assert files.read_replaced(spark, table).count() == 5
    files.log_run(spark, str(tmp_path / "log"), "x", "done", {"n": 1})
    files.log_run(spark, str(tmp_path / "log"), "y", "done", {})
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2


XML = """<xmeml version="4"><sequence><name>s</name><duration>100</duration><media><video>
<track><clipitem id="c1"><name>a</name><start>0</start><end>10</end><in>5</in><out>15</out><file id="f1"><pathurl>file://localhost/x/a.mov</pathurl></file><link><linkclipref>c2</linkclipref></link></clipitem></track>
<track><clipitem id="c3"><name>b</name><start>-1</start><end>10</end><in>0</in><out>4</out><file id="f1"/></clipitem></track></video>
<audio><track><clipitem id="c2"><name>a</name><start>0</start><end>10</end><in>5</in><out>15</out><file id="f1"/></clipitem></track></audio></media></sequence></xmeml>"""


def test_timeline(spark, tmp_path):
    (tmp_path / "t.xml").write_text(XML)
    got = {r.clip_id: (r.track, r.start, r.source_in, r.pathurl, r.links) for r in files.read_timeline(spark, str(tmp_path / "t.xml")).collect()}
    path = "file://localhost/x/a.mov"
    assert got == {"c1": ("V1", 0, 5, path, ["c2"]), "c3": ("V2", -1, 0, path, []), "c2": ("A1", 0, 5, path, [])}


def test_streams_equal_batches(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = windows.tumbling_counts(stream, "ts", ["event_type"], "1 hour", "40 days").writeStream.outputMode("complete").format("memory").queryName("tumbling").trigger(availableNow=True).start()
    q.awaitTermination(120)
    want = {tuple(r) for r in windows.tumbling_counts(events, "ts", ["event_type"], "1 hour").collect()}
    assert {tuple(r) for r in spark.table("tumbling").collect()} == want
    windows.append_journal(stream, str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination(120)
    windows.append_journal(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "c")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == events.count()


def test_components_by_forest_and_by_stars(spark):
    rng = random.Random(2)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(k, 401) for k in range(380, 400)] + [(None, 1), (5, 5)]
    df = spark.createDataFrame(pairs, "a int, b int").repartition(4)
    forest, stars = ({(r.id, r.component) for r in graph.components(df, "a", "b", edge_bound=n).collect()} for n in (10_000, 10))
    assert forest == stars and all(c <= i for i, c in forest)
    assert graph.components(df.limit(0), "a", "b").count() == 0


def test_cycles_of_any_length(spark):
    rows = [(k, (k + 1) % 60) for k in range(60)] + [(100, 3), (3, 101), (200, 200), (300, 301), (301, 302), (None, 1), (1, None)]
    df = spark.createDataFrame(rows, "id int, parent int")
    assert {r.id for r in graph.cycles(df, "id", "parent").collect()} == {*range(60), 200}


def test_lookup_spreads_hot_keys(spark):
    rows = spark.createDataFrame([("a", k) for k in range(100)] + [("b", 1), ("c", 2)], "k string, v int")
    table = spark.createDataFrame([("a", 10), ("b", 20)], "k string, w int")
    got = {tuple(r) for r in joins.lookup(rows, table, "k", "v", "left", hot=7).collect()}
    assert got == {("a", k, 10) for k in range(100)} | {("b", 1, 20), ("c", 2, None)}
