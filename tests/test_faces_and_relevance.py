from pyspark.sql import functions as F

from fieldreel.operators import faces, relevance


def test_faces(spark):
    rows = [("a", 0, "p"), ("a", 0, "p"), ("a", 1, "q"), ("b", 0, "p"), ("b", 1, None)]
    df = spark.createDataFrame(rows, "asset_id string, frame_idx int, p_id string")
    assert [tuple(r) for r in faces.by_person(df, "p").collect()] == [("a", 2), ("b", 1)]
    assert [tuple(r) for r in faces.co_appearance(df, "p", "q").collect()] == [("a", 1, 1)]
    assert {r.p_id: round(r.minutes * 60) for r in faces.screen_time(df).collect()} == {"p": 14, "q": 7}
    assert [r.asset_id for r in faces.alone(df, "p").collect()] == ["b"]
    face = spark.createDataFrame([(1, "b", 0.9, 2_000.0, [1.0, 0.0]), (2, "b", 0.8, 2_000.0, [0.9, 0.1]), (3, "b", 0.9, 2_000.0, [0.0, 1.0]), (4, "b", 0.1, 9_000.0, [1.0, 0.0]), (5, "a", 0.9, 9_000.0, [1.0, 0.0])], "face_pk int, asset_id string, det_score double, area double, vector array<float>")
    got = faces.mine_exemplars(face, df.select("asset_id", "p_id"), k=2).orderBy("rank").collect()
    assert [(r.p_id, r.face_pk, r.agreeing) for r in got] == [("p", 1, 2), ("p", 2, 2)]
    seen = spark.createDataFrame([("x", 1, "p", [1.0, 0.0]), ("y", 2, "q", [0.0, 1.0]), ("z", 3, None, [0.95, 0.05]), ("y", 4, None, [0.1, 0.9])], "asset_id string, cluster_id int, p_id string, vector array<float>")
    assert [(r.cluster_id, r.p_id) for r in faces.suggest_labels(seen).collect()] == [(3, "p")]


def test_relevance(spark):
    seg = spark.createDataFrame([("a", 100.0, 110.0, "the storm and the ridge"), ("a", 160.0, 170.0, "storm"), ("a", 900.0, 910.0, "storm"), ("a", 1.0, 2.0, None)], "asset_id string, start_sec double, end_sec double, text string")
    got = relevance.keyword_windows(seg, {"storm": 1.0, "ridge": 0.5}, budget=170.0).collect()
    assert [(r.start, r.end, r.score) for r in got] == [(55.0, 215.0, 2.5)]
    chunks = spark.createDataFrame([("a", 0.0, 10.0, "x", [0.0, 1.0]), ("a", 100.0, 150.0, "y", [1.0, 0.0]), ("a", 160.0, 200.0, "z", [1.0, 0.1]), ("a", 500.0, 520.0, "w", [1.0, 0.0]), ("a", 990.0, 1_000.0, "sponsor", [1.0, 0.0])], "asset_id string, start double, end double, text string, vector array<float>")
    runs = relevance.vector_windows(chunks, [1.0, 0.0], companions=1).orderBy(F.desc("rank_score")).collect()
    assert [(r.start, r.end, r.role) for r in runs] == [(100.0, 200.0, "primary"), (500.0, 520.0, "companion")]
    text = spark.createDataFrame([("a", 0, "We met Jon Smyth, and Bo."), ("b", 0, "Bo knows")], "asset_id string, seg_idx int, text string")
    variants = spark.createDataFrame([("jon smyth", "John Smith"), ("bo", "Beau")], "variant string, target string")
    spans = relevance.correction_spans(text, variants, spark.createDataFrame([("b", "Beau")], "asset_id string, target string"))
    assert {tuple(r) for r in spans.collect()} == {("a", 0, "jon smyth", "John Smith"), ("b", 0, "bo", "Beau")}
    people = spark.createDataFrame([("p1", "Dr Ann Lee", ["Ann"]), ("p2", "Bob Lee", ["Bob"]), ("p3", "x1234", None)], "id string, name string, aliases array<string>")
    found = {(r.category, r.id) for r in relevance.registry_scan(people, spark.createDataFrame([("p1",), ("p2",)], "id string")).collect()}
    assert found == {("title", "p1"), ("no_short_alias", "p1"), ("shared_surname", "p1"), ("shared_surname", "p2"), ("orphan", "p3"), ("noise", "p3")}
    aliases = spark.createDataFrame([("Ann", "p1"), ("Lee", "p1"), ("lee", "p2"), ("Sam", "p9")], "alias string, id string")
    queue = spark.createDataFrame([("ann",), ("Lee",), ("zed",), ("sam",), ("",)], "n string")
    got = {(r.name, r.id, r.reason) for r in relevance.unique_names(queue, "n", aliases, spark.createDataFrame([("sam", "p3")], "alias string, id string")).collect()}
    assert got == {("ann", "p1", "alias"), ("lee", None, "ambiguous"), ("zed", None, "unknown"), ("sam", "p3", "exception")}
