import itertools
import json
import os
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fieldreel.llm.bpe import Encoder, encode_texts, load_vocabulary, merge_word
from fieldreel.llm.components import connected_components
from fieldreel.llm.leakage import find_leaks, words
from fieldreel.llm.names import abbreviates, link_names, one_slip, parse_name, place_groups, same_places
from fieldreel.llm.queries import TOKENIZERS
from fieldreel.llm.splitting import bisect_items, bisected, cut_points, split_items
from fieldreel.llm.truncation import find_truncated, spikes, truncation_rates
from fieldreel.llm.turns import hidden_label_accuracy, infer_speakers, inferred_speakers, most_likely, speaker_turns
from fieldreel.operators.forest import union_find
from fieldreel.llm.vectors import calibrate, fit_tree, graft, measured_recall, nearest, similar_pairs, unit_vectors


# --- vectors


def clustered(n, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 6, dim))
    return (centres[rng.integers(0, len(centres), n)] + rng.normal(scale=0.15, size=(n, dim))).astype(np.float32)


def exact_pairs(x, keys, k, least):
    i, j, _ = nearest(x, keys, x, keys, k, least)
    return {(min(a, b), max(a, b)) for a, b in zip(keys[i].tolist(), keys[j].tolist())}


@pytest.mark.parametrize("block", [50, 8_000])
def test_similar_pairs_reach_recall_of_brute_force(spark, block):
    x = clustered(1_500)
    rows = [(int(i), bytearray(v.astype("<f4").tobytes()), "x") for i, v in enumerate(x)]
    rows += rows[:20] + [(9_001, None, "x"), (9_002, bytearray(b"abc"), "x"), (9_003, bytearray(np.full(16, np.nan, "<f4").tobytes()), "x"), (9_004, bytearray(np.zeros(16, "<f4").tobytes()), "x")]
    df = spark.createDataFrame(rows, "id long, blob binary, leaf string").repartition(3)
    got = {(r.key_lo, r.key_hi) for r in similar_pairs(df, "id", "blob", 16, leaf_rows=40, block_rows=block, fit_rows=600).collect()}
    unit, ok = unit_vectors([r[1] for r in rows[:1_500]], 16)
    want = exact_pairs(unit, np.arange(1_500), 5, 0.8)
    assert ok.all() and len(got & want) >= 0.95 * len(want)
    assert len(got - want) <= 0.02 * len(want)


def test_equal_vectors_and_empty(spark):
    one = bytearray(np.arange(1, 5, dtype="<f4").tobytes())
    df = spark.createDataFrame([(i, one) for i in range(12)], "id long, blob binary")
    got = similar_pairs(df, "id", "blob", 4).collect()
    assert all(abs(r.cosine - 1) < 1e-6 and r.key_lo < r.key_hi for r in got)
    assert {k for r in got for k in (r.key_lo, r.key_hi)} == set(range(12))
    assert similar_pairs(df.limit(0), "id", "blob", 4).count() == 0


def test_wider_search_never_finds_less():
    x, _ = unit_vectors([v.tobytes() for v in clustered(800)], 16)
    tree = fit_tree(x, 20)
    order, fell = tree.visits(x[:50], tree.leaves)
    assert all(sorted(row) == list(range(tree.leaves)) for row in order.tolist())
    assert (np.diff(fell, axis=1) >= 0).all()
    narrow, _ = tree.visits(x[:50], tree.leaves, 0.1)
    assert all(set(n[n >= 0]) <= set(o) for n, o in zip(narrow, order, strict=True))
    i, j, _ = nearest(x[:200], np.arange(200), x, np.arange(800), 5, 0.8)
    assert calibrate(tree, x[i], x[j], 0.9)[0] <= calibrate(tree, x[i], x[j], 0.99)[0]


def test_leaves_are_split_further_where_they_lie(spark):
    x = clustered(4_000, seed=3)
    df = spark.createDataFrame([(int(i), bytearray(v.tobytes())) for i, v in enumerate(x)], "id long, blob binary").repartition(4)
    got = {(r.key_lo, r.key_hi) for r in similar_pairs(df, "id", "blob", 16, fit_rows=300, leaf_rows=40, leaf_sample=12).collect()}
    unit, _ = unit_vectors([v.tobytes() for v in x], 16)
    want = exact_pairs(unit, np.arange(4_000), 5, 0.8)
    assert len(got & want) >= 0.95 * len(want) and len(got - want) <= 0.02 * len(want)
    top = fit_tree(unit[:300], 100)
    grafted = graft(top, {0: fit_tree(unit[300:600], 50), top.leaves - 1: fit_tree(unit[600:900], 50)})
    order, _ = grafted.visits(unit[:20], grafted.leaves)
    assert grafted.leaves > top.leaves and all(sorted(row) == list(range(grafted.leaves)) for row in order.tolist())


def test_copies_beyond_the_sixth_skip_the_search(spark):
    x = clustered(300, seed=5)
    rows = [(int(i), bytearray(v.tobytes())) for i, v in enumerate(x)]
    rows += [(1_000 + i, rows[7][1]) for i in range(400)] + [(2_000 + i, bytearray(64)) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, blob binary").repartition(3)
    got = {(r.key_lo, r.key_hi) for r in similar_pairs(df, "id", "blob", 16).collect()}
    unit, ok = unit_vectors([r[1] for r in rows], 16)
    keys = np.array([r[0] for r in rows])[ok]
    want = exact_pairs(unit, keys, 5, 0.8)
    assert len(got & want) >= 0.97 * len(want) and len(got - want) <= 0.02 * len(want)
    assert {(7, k) for k in range(1_005, 1_400)} <= got


def test_recall_is_measured_against_all_rows(spark):
    df = spark.createDataFrame([(int(i), bytearray(v.tobytes())) for i, v in enumerate(clustered(600, seed=9))], "id long, blob binary")
    row = measured_recall(df, "id", "blob", 16, F.col("id") % 50 == 0).first()
    assert row.queries == 12 and row.neighbours > 0 and row.found >= 0.95 * row.neighbours
    assert measured_recall(df.limit(0), "id", "blob", 16, F.col("id") % 50 == 0).first().recall is None


# --- hidden speakers


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3), st.integers(1, 5), st.data())
def test_most_likely_path_equals_brute_force(k, n, data):
    fixed = data.draw(st.lists(st.integers(-1, k - 1), min_size=n, max_size=n))
    scores = np.array(data.draw(st.lists(st.lists(st.floats(-3, 3), min_size=k, max_size=k), min_size=n, max_size=n)))
    share = np.array(data.draw(st.lists(st.floats(0.1, 1), min_size=k, max_size=k)))
    share /= share.sum()
    before, after, stay = data.draw(st.integers(-1, k - 1)), data.draw(st.integers(-1, k - 1)), 0.7

    def value(path):
        total = 0.0
        for a, b in zip([before, *path], [*path, after]):
            if b >= 0:
                total += np.log(share[b]) if a < 0 else np.log((stay if k > 1 else 1.0) if a == b else 0.3 * share[b] / (1 - share[a]))
        return total + sum(scores[i, s] for i, s in enumerate(path) if fixed[i] < 0)

    paths = [p for p in itertools.product(range(k), repeat=n) if all(f in (-1, s) for f, s in zip(fixed, p))]
    got = most_likely(fixed, scores, stay, share, before, after)
    assert tuple(got) in paths and value(got) >= max(map(value, paths)) - 1e-6


def test_speakers_are_inferred_from_what_they_say(spark):
    rng = random.Random(4)
    own = {1: "river boat paddle rapid current".split(), 2: "judge court ruling appeal brief".split()}
    rows = []
    for asset in "ab":
        for i in range(300):
            no = rng.choice((1, 2))
            label = None if i % 9 == 4 else no
            rows.append((asset, i, 7.0 * i, " ".join(rng.choices(own[no], k=6)), label, no))
    rows += [("c", 0, 1.0, "river", None, -1), ("c", 0, 1.0, "river", None, -1)]
    df = spark.createDataFrame([r[:5] for r in rows], "asset_id string, seg_idx int, start double, said string, no int")
    got = {(r.asset_id, r.seg_idx): r.speaker_no for r in infer_speakers(df).collect()}
    want = {r[:2]: r[5] for r in rows if r[4] is None}
    assert set(got) == set(want) and sum(got[k] == want[k] for k in want) >= 0.97 * len(want)
    assert infer_speakers(df.limit(0)).count() == 0


def test_inferred_speakers_odd_rows(spark):
    rows = [("a", 0, 0.0, "S1", None, "we go"), ("a", 1, 1.0, None, None, "we went"), ("a", 2, None, None, None, "lost"), ("a", 3, 3.0, None, None, None), (None, 4, 4.0, "S2", None, "x"), ("b", 0, 0.0, None, None, "alone")]
    df = spark.createDataFrame(rows, "asset_id string, seg_idx int, start_sec double, speaker_id string, speaker_p_id string, text string")
    assert {(r.asset_id, r.seg_idx, r.speaker_no) for r in inferred_speakers(df).collect()} == {("a", 1, 1), ("b", 0, -1)}
    assert hidden_label_accuracy(df.limit(0)).first().hidden == 0


# --- components


def plain_components(pairs):
    group = {}
    for a, b in pairs:
        if a is not None and b is not None:
            ga, gb = group.setdefault(a, {a}), group.setdefault(b, {b})
            if ga is not gb:
                ga |= gb
                for x in gb:
                    group[x] = ga
    return {(x, min(g)) for x, g in group.items()}


@pytest.mark.parametrize("bound", [40, 10_000])
def test_components_by_levels_and_at_once(spark, bound):
    rng = random.Random(bound)
    pairs = [(f"n{k:04}", f"n{k + 1:04}") for k in range(0, 300)]
    pairs += [(f"m{rng.randrange(200)}", f"m{rng.randrange(200)}") for _ in range(150)] + [("hub", f"h{k}") for k in range(200)]
    pairs += [("self", "self"), (None, "x"), ("y", None)] + pairs[:30] + [(b, a) for a, b in pairs[:30]]
    rng.shuffle(pairs)
    df = spark.createDataFrame(pairs, "l string, r string").repartition(5)
    got = [(r.id, r.group_id) for r in connected_components(df, "l", "r", edge_bound=bound).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_components(pairs)


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "l string, r string"), "l", "r").count() == 0


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=60))
def test_union_find(pairs):
    a = np.array([p[0] for p in pairs], int)
    b = np.array([p[1] for p in pairs], int)
    root = union_find(a, b, 31)
    assert {(x, int(root[x])) for p in pairs for x in p} == plain_components(pairs)


# --- splitting


@given(st.integers(0, 500), st.integers(1, 2_000), st.integers(2, 300), st.data())
def test_pieces_cover_and_overlap(start, length, window, data):
    overlap = data.draw(st.integers(0, window - 1))
    ends = np.array(sorted(data.draw(st.sets(st.integers(0, 2_500), max_size=30))), dtype=np.int64)
    pieces = cut_points(start, start + length, window, overlap, ends)
    assert pieces[0][0] == start and pieces[-1][1] == start + length
    assert all(b - a <= window for a, b in pieces)
    assert all(b[0] == a[1] - overlap for a, b in zip(pieces, pieces[1:]))
    for a, b in pieces[:-1]:
        inside = [e for e in ends if a + overlap < e <= a + window]
        assert b == (max(inside) if inside else a + window)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10_000), st.integers(1, 60_000), st.integers(2, 4_000), st.data())
def test_bisected_pieces_fit_cover_and_overlap(start, length, window, data):
    overlap = data.draw(st.integers(0, window - 1))
    length = min(length, 300 * (window - overlap))
    ends = np.array(sorted(set(data.draw(st.lists(st.integers(start, start + length), max_size=40)))), dtype=np.int64)
    pieces = bisected(start, start + length, window, overlap, ends, np.ones(len(ends), np.int64))
    assert pieces[0][0] == start and pieces[-1][1] == start + length
    assert all(b - a <= window for a, b in pieces)
    assert all(q[0] == max(start, p[1] - overlap) and q[1] > p[1] for p, q in zip(pieces, pieces[1:]))


def test_bisection_takes_the_strongest_boundary_of_the_middle_half(spark):
    ends = np.array([10, 45, 52, 70])
    assert bisected(0, 100, 60, 5, ends, np.array([9, 1, 1, 1])) == [(0, 52), (47, 100)]
    assert bisected(0, 100, 60, 5, ends, np.array([9, 1, 1, 2]))[-1] == (65, 100)
    chunks = spark.createDataFrame([("far", "a", 0.0, 9e10), ("c", None, 0.0, 100.0), ("c", "a", 0.0, 100.0)], "chunk_id string, parent_asset_id string, chunk_start_sec double, chunk_end_sec double")
    runs = spark.createDataFrame([(1, 6e9, 1.0)], "run_id long, window_sec double, overlap_sec double")
    marks = spark.createDataFrame([("a", 3e10), ("a", 4.4e10), (None, 1.0)], "asset_id string, end_sec double")
    got = bisect_items(chunks, marks, runs).orderBy("piece_idx").collect()
    assert {r.chunk_id for r in got} == {"far"} and got[-1].end_ms == 90_000_000_000_000 and 44_000_000_000_000 in {r.end_ms for r in got}


def test_split_items_odd_rows(spark):
    chunks = spark.createDataFrame([("c1", "a", 0.0, 100.0), ("c1", "a", 0.0, 100.0), ("c2", None, 0.0, 70.0), ("c3", "a", 9.0, 1.0), ("c4", "a", None, 80.0), ("c5", "a", float("nan"), 80.0), ("c6", "a", 0.0, 30.0)], "chunk_id string, parent_asset_id string, chunk_start_sec double, chunk_end_sec double")
    ends = spark.createDataFrame([("a", 25.0), ("a", 25.0), ("a", 61.5), ("a", None), ("b", 29.0)], "asset_id string, end_sec double")
    runs = spark.createDataFrame([(1, 30.0, 5.0), (2, 30.0, 30.0), (3, None, 1.0), (4, 30.0, -1.0)], "run_id long, window_sec double, overlap_sec double")
    got = {(r.run_id, r.chunk_id, r.piece_idx, r.start_ms, r.end_ms) for r in split_items(chunks, ends, runs).collect()}
    assert {x for x in got if x[1] == "c1"} == {(1, "c1", 0, 0, 25_000), (1, "c1", 1, 20_000, 50_000), (1, "c1", 2, 45_000, 61_500), (1, "c1", 3, 56_500, 86_500), (1, "c1", 4, 81_500, 100_000)}
    assert {x[1] for x in got} == {"c1", "c2"}
    assert split_items(chunks, ends, runs.limit(0)).count() == 0
    assert split_items(chunks.limit(0), ends.limit(0), runs).count() == 0


# --- turns


def test_turns(spark):
    rows = [
        ("a", 2, 3.0, "SPEAKER_01", "p1", "[00:00:03] Hello um there."), ("a", 1, 1.0, " Speaker  1 ", None, "(SPK2): hi"), ("a", 3, 700.0, None, "p1", "more words"), ("a", 4, 701.0, "unknown", None, "<v Speaker 2> yes"),
        ("a", 5, 702.0, "S2", None, "um, [laughter] *sighs*"), ("a", 6, 1_400.0, None, None, ">> Speaker 2: go on"), ("a", 7, 1_401.0, "voice", "p9", "who"), ("a", 8, None, "S1", None, "lost"), ("a", 9, 1_402.0, "S3", None, None), ("b", 0, 1.0, "S0", None, "x"),
    ]
    df = spark.createDataFrame(rows + rows, "asset_id string, seg_idx int, start_sec double, speaker_id string, speaker_p_id string, text string").withColumn("turn", F.lit(1)).withColumn("part", F.lit(2))
    got = {(r.asset_id, r.speaker_no, r.first_seg_idx, r.last_seg_idx, r.text) for r in speaker_turns(df).collect()}
    assert got == {("a", 1, 1, 3, "hi Hello there. more words"), ("a", 2, 4, 6, "yes go on"), ("a", -1, 7, 7, "who"), ("b", 0, 0, 0, "x")}
    assert speaker_turns(df.limit(0)).count() == 0


# --- names


@pytest.mark.parametrize("a, b, same", [
    ("Sth Bridge of Belvires Pemogur", "south belvires pemogur bridge", True), ("Tathobe Gerapop AS mi. 38", "AID STN, TATHOBE GERAPOP MI. 38", True), ("E. Bazendu Midithu Mt.", "East Bazendu Midithu Mountain (car park side)", True),
    ("Aid Station Foo Bar Mile 38", "Aid Station Foo Bar Mile 83", False), ("North Foo Bar Creek", "South Foo Bar Creek", False), ("Foo Bar Creek", "Foo Bar Lake", False),
])
def test_parse_name(a, b, same):
    assert (parse_name(a) == parse_name(b)) is same


def test_general_names_mean_nothing():
    assert [parse_name(n) for n in ("here", "finish area", "start line", "the trail", "", None, "Unknown", "base camp", "(mile 3)")] == [None] * 9


def test_same_places(spark):
    rows = [
        ("1", "Restaler Brubupef Meadow", ["finish area"]), ("2", "Brubupef Restaler Mdw", None), ("3", "B. Restaler Meadow", []), ("4", "Brubupfe Restalerr Meadow / parking", [None, ""]), ("5", "brubupefrestaler meadow", None), ("6", "brubupef restaler", ["The Rmonigun Rubrithe"]),
        ("7", "the Rmonigun Rubriteh", None), ("8", "Brubupef Restaler Creek", ["finish area"]), ("9", "finish area", None), ("10", None, None), ("11", "Upper Brubupef Restaler Meadow", []), ("1", "Restaler Brubupef Meadow", ["finish area"]),
    ]
    df = spark.createDataFrame(rows, "id string, canonical_name string, aliases array<string>").withColumn("place", F.lit("clash"))
    got = {(r.id_lo, r.id_hi) for r in same_places(df, "id", "canonical_name", "aliases").collect()}
    meadow = ["1", "2", "3", "4", "5"]
    assert {(a, b) for a in meadow for b in meadow if a < b} <= got
    assert ("6", "7") in got and not any("8" in p or "9" in p or "11" in p for p in got)
    assert same_places(df.limit(0), "id", "canonical_name", "aliases").count() == 0


def test_kindless_name_joins_the_one_place_of_its_words(spark):
    df = spark.createDataFrame([("1", "Kezepat Bathathu Lodge", None), ("2", "Bathathu Kezepat", None)], "id string, canonical_name string, aliases array<string>")
    assert link_names(df, "id", "canonical_name", "aliases").select("place").distinct().count() == 1


# --- encoding

VOCABULARY = f"{TOKENIZERS}/byte_bpe_50k.json"


@pytest.fixture(scope="module")
def theirs():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def ours():
    return Encoder(*load_vocabulary(VOCABULARY))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80))
def test_encoding_of_any_text(theirs, ours, text):
    assert ours.encode(text) == theirs.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["", " ", "<|endoftext|> is text", "don't  stop\n\n\tnow 12345", "été – ÇA 👩‍👩‍👧", "a" * 5_000, "=" * 20_001, "naïvé", "\r\n﻿x"])
def test_encoding_of_odd_texts(theirs, ours, text):
    assert ours.encode(text) == theirs.encode(text, add_special_tokens=False).ids


def test_both_vocabulary_files_agree(ours):
    other = Encoder(*load_vocabulary(f"{TOKENIZERS}/byte_bpe_50k.tiktoken"))
    for text in ("The quick brown fox’s 42 jumps", "Zugspitze überquert", "x" * 99):
        assert other.encode(text) == ours.encode(text)


def test_merges_lowest_rank_first_and_leftmost():
    merges = {(1, 1): (0, 2), (2, 1): (1, 3), (2, 2): (2, 4)}
    assert merge_word([1, 1, 1, 1, 1], merges) == [2, 3]
    assert merge_word([1], merges) == [1] and merge_word([], merges) == []


def test_encode_texts(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None), (3, "")], "doc_id long, text string").withColumn("ids", F.lit(1))
    got = {(r.doc_id, tuple(r.ids)) for r in encode_texts(df, "doc_id", "text", VOCABULARY).collect()}
    assert got == {(1, (64, 275)), (2, ()), (3, ())}
    assert encode_texts(df.limit(0), "doc_id", "text", VOCABULARY).count() == 0


# --- leaks


@pytest.mark.parametrize("most_sent", [2_000_000, 0])
def test_leaks_against_brute_force(spark, most_sent):
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(40)] + ["Straße", "d'or"]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([5, 13, 14, 40])))) for k in range(25)] + [(99, None), (98, ""), (97, "x " * 13)]
    docs = []
    for d in range(120):
        body = rng.choices(vocabulary, k=rng.randrange(0, 60))
        if d % 2 and (text := items[rng.randrange(25)][1].split(" ")):
            at = rng.randrange(max(1, len(text) - 11))
            body += text[at : at + rng.choice([12, 13, 20])]
        docs.append((d, rng.choice([" ", ", ", "\n_"]).join(w.upper() if d % 3 else w for w in body)))
    docs += [(500, None), (501, ""), (502, "X " * 30)] + docs[:10]
    d_df, i_df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("id", F.lit(0)), spark.createDataFrame(items + items[:3], "item_id long, text string")
    got = {tuple(r) for r in find_leaks(d_df, i_df, most_sent=most_sent).collect()}

    def grams(t):
        w = words(t)
        return {tuple(w[k : k + 13]) for k in range(len(w) - 12)}

    assert got == {(d, i) for d, t in docs for i, u in items if grams(t) & grams(u)} and got
    assert find_leaks(d_df.limit(0), i_df.limit(0), most_sent=most_sent).count() == 0


def test_leak_with_a_replaced_word(spark):
    text = [f"w{k}" for k in range(20)]
    changed = text[:9] + ["other"] + text[10:]
    docs, items = spark.createDataFrame([(1, " ".join(changed))], "doc_id long, text string"), spark.createDataFrame([(2, " ".join(text))], "item_id long, text string")
    assert find_leaks(docs, items).count() == 0
    assert find_leaks(docs, items, substitutions=1).count() == 1


@pytest.mark.parametrize("most_sent", [10_000, 0])
def test_replaced_words_are_ignored_at_every_place(spark, most_sent):
    rng = random.Random(8)
    item = [f"w{k}" for k in range(13)]
    noise = lambda: [f"n{rng.randrange(99)}" for _ in range(6)]
    one = [[*noise(), *item[:r], "x", *item[r + 1 :], *noise()] for r in range(13)]
    two = [[*noise(), *("x" if k in pair else w for k, w in enumerate(item)), *noise()] for pair in itertools.combinations(range(13), 2)]
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate([*one, *two, item * 40])], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    found = lambda n: {r.doc_id for r in find_leaks(docs, items, substitutions=n, most_sent=most_sent).collect()}
    whole = len(one) + len(two)
    assert found(0) == {whole}
    assert found(1) == {*range(13), whole}
    assert len(found(2)) >= 14 + 0.9 * len(two)


# --- spellings of any names


def linked(spark, rows):
    df = spark.createDataFrame([(str(k), names[0], list(names[1:])) for k, names in enumerate(rows)], "id string, canonical_name string, aliases array<string>")
    return {(int(r.id_lo), int(r.id_hi)) for r in same_places(df, "id", "canonical_name", "aliases", block=2).collect()}


def test_slips_in_names_of_any_number_of_words(spark):
    rows = [
        ("Emigrant Gap Sunrise Trailhead",), ("Emigrent Gap Sunrise Trailhead",), ("Auburn Lake",), ("Aubrun Lake",),
        ("Western States Endurance Run Foundation",), ("Western States Endurance Run Fndn",), ("Muir Lodge",), ("Miur Lodge",),
        ("San Juan Hill Trail",), ("San Jaun Hill Trail",), ("Redrock Lake",), ("Red Rock Lake",), ("Elk Creek",), ("Elm Creek",),
        ("Emigrant Gap Sunset Trailhead",), ("Western States Endurance Ride Foundation",), ("J. Q. Adams",), (None,),
    ]
    assert linked(spark, rows) == {(k, k + 1) for k in range(0, 12, 2)}


def test_abbreviations_and_nicknames_are_learnt_from_merged_names(spark):
    rows = [("Robert Keller Lodge", "Bob Keller Lodge"), ("Bob Marsh Lodge", "Robert Marsh Lodge"), ("Robert Tanner Bridge",), ("Bob Tanner Bridge",), ("Rob Tanner Bridge",)]
    assert linked(spark, rows) == {(2, 3)}
    df = spark.createDataFrame([(str(k), r[0], list(r[1:])) for k, r in enumerate(rows)], "id string, canonical_name string, aliases array<string>")
    groups = {r.id: r.group_id for r in place_groups(df, "id", "canonical_name", "aliases").collect()}
    assert groups == {"0": "0", "1": "1", "2": "2", "3": "2", "4": "4"}
    assert place_groups(df.limit(0), "id", "canonical_name", "aliases").count() == 0


@given(st.text("abcd", min_size=3, max_size=8), st.data())
def test_one_slip(word, data):
    k = data.draw(st.integers(0, len(word) - 1))
    assert not one_slip(word, word)
    longer = word[:k] + "x" + word[k:]
    assert one_slip(word, longer) and one_slip(longer, word)
    assert one_slip(word, word[:k] + "x" + word[k + 1 :]) == (len(word) >= 5)
    if k + 1 < len(word) and word[k] != word[k + 1]:
        assert one_slip(word, word[:k] + word[k + 1] + word[k] + word[k + 2 :])
    assert not one_slip(word, "xx" + word)


def test_abbreviates():
    assert abbreviates("fndn", "foundation") and abbreviates("found", "foundation") and not abbreviates("ride", "run") and not abbreviates("f", "foundation") and not abbreviates("fxn", "foundation")


# --- truncation


def corpus():
    rng = random.Random(3)
    subject, verb, thing = ["the runner", "a ranger", "our guide", "the editor"], ["watched", "followed", "described", "counted"], ["the storm", "the river crossing", "the northern ridge", "every battery"]
    full = lambda n: " ".join(f"{rng.choice(subject).capitalize()} {rng.choice(verb)} {rng.choice(thing)} near {rng.choice(thing)}." for _ in range(n))
    rows = [(k, full(rng.randrange(1, 9)), "whole", "article") for k in range(300)]
    long = [full(9) for _ in range(60)]
    rows += [(1_000 + k, t[:200], "field", "article") for k, t in enumerate(long)] + [(1_100 + k, full(rng.randrange(1, 4)), "field", "article") for k in range(60)]
    cut = {1_000 + k for k, t in enumerate(long) if not t[:200].rstrip().endswith(".")}
    rows += [(2_000, full(2) + " The runner wat… (more)", "whole", "article"), (2_001, full(2) + " A ranger followed the", "whole", "article"), (2_002, full(1) + "\n=======", "whole", "article"), (2_003, full(1) + " #ridge", "whole", "article"), (2_004, None, "whole", "article"), (2_005, "", "whole", None), (2_006, "   ", None, None)]
    return rows, cut | {2_000, 2_001}


def test_truncated_documents(spark):
    rows, cut = corpus()
    df = spark.createDataFrame(rows + rows[:5], "doc_id long, text string, source string, doc_kind string").withColumn("kind", F.lit("clash"))
    assert {r.doc_id for r in find_truncated(df).collect()} == cut
    found = spikes(df, "source", "text").collect()
    assert {(r.source, r.length) for r in found if r.unit == "chars"} >= {("field", 200)}
    rates = {r.source: (r.texts, r.cut) for r in truncation_rates(df).collect()}
    assert rates["field"] == (120, len(cut) - 2)
    assert find_truncated(df.limit(0)).count() == 0


def test_queries_and_sql_have_the_same_names():
    from fieldreel.llm import queries

    assert set(queries.oracle_sql()) <= set(queries.queries())
