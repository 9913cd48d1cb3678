"""Queries of the training-data operators and, where SQL can express them, the SQL that gives the same rows."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldreel.llm.bpe import encode_texts
from fieldreel.llm.components import connected_components
from fieldreel.llm.leakage import find_leaks
from fieldreel.llm.names import link_names, place_groups, same_places
from fieldreel.llm.splitting import bisect_items, split_items
from fieldreel.llm.truncation import find_truncated, find_truncated_at_spikes, spikes, truncation_rates
from fieldreel.llm.turns import hidden_label_accuracy, inferred_speakers, speaker_turns
from fieldreel.llm.vectors import measured_recall, similar_pairs
from fieldreel.session import read

#: Folder of the public tokenizers' files.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
#: Table, key, vector column and number of values.
STORES = (("clip_embeddings", "embedding_pk", "vector_blob", 64), ("transcript_window_embedding", "id", "vector_blob", 64), ("face_exemplar", "exemplar_pk", "embedding", 128))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = [similar_pairs(read(spark, sf_dir, table), key, blob, dim).select(F.lit(table).alias("store"), F.col("key_lo").cast("bigint"), F.col("key_hi").cast("bigint")) for table, key, blob, dim in STORES]
    return found[0].union(found[1]).union(found[2])


def p1_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recall of the five most similar of every row whose key is divisible by 50, against all rows of its table."""
    found = [measured_recall(read(spark, sf_dir, table), key, blob, dim, F.col(key) % 50 == 0).select(F.lit(table).alias("store"), "*") for table, key, blob, dim in STORES]
    return found[0].union(found[1]).union(found[2])


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = lambda c: F.nullif(F.lower(F.regexp_replace(c, r"(?U)^\s+|\s+$", "")), F.lit("")).alias(c)
    both = [read(spark, sf_dir, t).select(clean("video_asset_id"), clean("audio_asset_id")) for t in ("link_proposal", "applied_link")]
    return both[0].union(both[1])


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connected_components(_pairs(spark, sf_dir), "video_asset_id", "audio_asset_id").select(F.col("id").alias("asset_id"), "group_id")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_items(read(spark, sf_dir, "semantic_chunks"), read(spark, sf_dir, "segment"), read(spark, sf_dir, "embedding_run"))


def p4_bisected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bisect_items(read(spark, sf_dir, "semantic_chunks"), read(spark, sf_dir, "segment"), read(spark, sf_dir, "embedding_run"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speaker_turns(read(spark, sf_dir, "segment"), texts=False).select("asset_id", "speaker_no", "first_seg_idx", "last_seg_idx").distinct()


def p5_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return speaker_turns(read(spark, sf_dir, "segment"))


def p5_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speakers of the segments that p5_found must leave at -1, by the hidden Markov model."""
    return inferred_speakers(read(spark, sf_dir, "segment"))


def p5_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hidden_label_accuracy(read(spark, sf_dir, "segment"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return same_places(read(spark, sf_dir, "places"), "id", "canonical_name", "aliases")


def p7_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row of ``places`` with the smallest id of its place: p7_found without pairs."""
    return place_groups(read(spark, sf_dir, "places"), "id", "canonical_name", "aliases")


def p7_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = link_names(read(spark, sf_dir, "places"), "id", "canonical_name", "aliases")
    return linked.groupBy("place").agg(F.count("*").alias("n_rows"), F.min("id").alias("first_id")).select("first_id", "n_rows")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(read(spark, sf_dir, "documents"), "doc_id", "text", f"{TOKENIZERS}/byte_bpe_50k.json")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "eval_item"))


def p9_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold 13 consecutive words of an item, of which one may be replaced."""
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "eval_item"), substitutions=1)


def p9_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_found(spark, sf_dir).groupBy("item_id").agg(F.count("*").alias("n_docs"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_truncated(read(spark, sf_dir, "documents")).select("doc_id").distinct()


def p10_at_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part of p10_found that lengths alone give, by the method of problem 10."""
    return find_truncated_at_spikes(read(spark, sf_dir, "documents")).select("doc_id", "reason").distinct()


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation_rates(read(spark, sf_dir, "documents"))


def p10_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spikes(read(spark, sf_dir, "documents"), "source", "text").select("source", "unit", "length", "texts", F.round("expected", 6).alias("expected"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_recall, p3_found, p4_found, p4_bisected, p5_found, p5_turns, p5_inferred, p5_accuracy, p7_found, p7_groups, p7_places, p8_ids, p9_found, p9_replaced, p9_items, p10_found, p10_at_spikes, p10_rates, p10_spikes)}


_P3 = """
WITH RECURSIVE pairs AS (
  SELECT lower(regexp_replace(video_asset_id, '^\\s+|\\s+$', '', 'g')) AS a, lower(regexp_replace(audio_asset_id, '^\\s+|\\s+$', '', 'g')) AS b FROM link_proposal
  UNION SELECT lower(regexp_replace(video_asset_id, '^\\s+|\\s+$', '', 'g')), lower(regexp_replace(audio_asset_id, '^\\s+|\\s+$', '', 'g')) FROM applied_link
), good AS (SELECT a, b FROM pairs WHERE a <> '' AND b <> ''),
edges AS (SELECT a, b FROM good UNION SELECT b, a FROM good),
reach(id, other) AS (SELECT a, a FROM edges UNION SELECT r.id, e.b FROM reach r JOIN edges e ON r.other = e.a)
SELECT id AS asset_id, min(other) AS group_id FROM reach GROUP BY id
"""

_P4 = """
WITH RECURSIVE runs AS (
  SELECT DISTINCT run_id, CAST(round(window_sec * 1000) AS BIGINT) AS w, CAST(round(overlap_sec * 1000) AS BIGINT) AS o FROM embedding_run
  WHERE window_sec IS NOT NULL AND overlap_sec IS NOT NULL AND NOT isnan(window_sec) AND NOT isnan(overlap_sec) AND overlap_sec >= 0 AND overlap_sec < window_sec
), items AS (
  SELECT DISTINCT run_id, chunk_id, parent_asset_id AS asset, CAST(round(chunk_start_sec * 1000) AS BIGINT) AS s, CAST(round(chunk_end_sec * 1000) AS BIGINT) AS e, w, o
  FROM semantic_chunks, runs WHERE chunk_start_sec IS NOT NULL AND chunk_end_sec IS NOT NULL AND round(chunk_end_sec * 1000) - round(chunk_start_sec * 1000) > w
), marks AS (
  SELECT asset_id AS asset, list_sort(list(DISTINCT CAST(round(end_sec * 1000) AS BIGINT))) AS ends FROM segment WHERE end_sec IS NOT NULL GROUP BY asset_id
), jobs AS (SELECT i.*, coalesce(m.ends, []) AS ends FROM items i LEFT JOIN marks m USING (asset)),
cut AS (
  SELECT run_id, chunk_id, 0 AS k, s AS a, CASE WHEN e - s > w THEN coalesce(list_max(list_filter(ends, lambda x: x > s + o AND x <= s + w)), s + w) ELSE e END AS b, e, w, o, ends FROM jobs
  UNION ALL
  SELECT run_id, chunk_id, k + 1, b - o, CASE WHEN e - (b - o) > w THEN coalesce(list_max(list_filter(ends, lambda x: x > b AND x <= b - o + w)), b - o + w) ELSE e END, e, w, o, ends FROM cut WHERE b < e
)
SELECT run_id, chunk_id, CAST(k AS INTEGER) AS piece_idx, a AS start_ms, b AS end_ms FROM cut
"""

_P4_BISECTED = """
WITH RECURSIVE runs AS (
  SELECT DISTINCT run_id, CAST(round(window_sec * 1000) AS BIGINT) AS w, CAST(round(overlap_sec * 1000) AS BIGINT) AS o FROM embedding_run
  WHERE window_sec IS NOT NULL AND overlap_sec IS NOT NULL AND NOT isnan(window_sec) AND NOT isnan(overlap_sec) AND overlap_sec >= 0 AND overlap_sec < window_sec
), items AS (
  SELECT DISTINCT run_id, chunk_id, parent_asset_id AS asset, CAST(round(chunk_start_sec * 1000) AS BIGINT) AS s, CAST(round(chunk_end_sec * 1000) AS BIGINT) AS e, w, o
  FROM semantic_chunks, runs WHERE chunk_start_sec IS NOT NULL AND chunk_end_sec IS NOT NULL AND round(chunk_end_sec * 1000) - round(chunk_start_sec * 1000) > w
), counted AS (
  SELECT asset_id AS asset, CAST(round(end_sec * 1000) AS BIGINT) AS x, count(*) AS n FROM segment WHERE end_sec IS NOT NULL GROUP BY ALL
), marks AS (SELECT asset, list({'x': x, 'n': n}) AS ends FROM counted GROUP BY asset),
parts AS (
  SELECT run_id, chunk_id, s, e, s AS a, e AS b, w, o, coalesce(m.ends, []) AS ends FROM items i LEFT JOIN marks m USING (asset)
  UNION ALL
  SELECT run_id, chunk_id, s, e, unnest([a, cut]), unnest([cut, b]), w, o, ends FROM (
    SELECT *, coalesce(-list_max(list_transform(list_filter(ends, lambda m: m.x > a AND m.x < b AND m.x >= a + (b - a) // 4 AND m.x <= b - (b - a) // 4), lambda m: {'n': m.n, 'd': -abs(2 * m.x - a - b), 'x': -m.x})).x, a + (b - a) // 2) AS cut
    FROM parts WHERE b - a > w - o)
), leaves AS (SELECT DISTINCT run_id, chunk_id, s, e, a, b, o FROM parts WHERE b - a <= w - o)
SELECT run_id, chunk_id, CAST(row_number() OVER (PARTITION BY run_id, chunk_id, s, e ORDER BY a) - 1 AS INTEGER) AS piece_idx, CASE WHEN a = s THEN a ELSE greatest(s, a - o) END AS start_ms, b AS end_ms FROM leaves
"""

_P5 = r"""
WITH seg AS (SELECT DISTINCT asset_id, seg_idx, start_sec, speaker_id, speaker_p_id, coalesce(text, '') AS text FROM segment WHERE asset_id IS NOT NULL),
timed AS (SELECT *, regexp_replace(text, '^\s*[\[(]?(\d{1,3}:\d{2}(:\d{2})?([.,;:]\d{1,3})?(\s*-->\s*\d{1,3}:\d{2}(:\d{2})?([.,;:]\d{1,3})?)?|\d{1,3}h\d{1,2}m\d{1,2}(\.\d+)?s)[\])]?', ' ', 'i') AS t FROM seg),
numbered AS (
  SELECT asset_id, seg_idx, start_sec, speaker_p_id, text,
    coalesce(TRY_CAST(nullif(regexp_extract(coalesce(speaker_id, ''), '(\d{1,4})\s*$', 1), '') AS INTEGER),
      TRY_CAST(nullif(regexp_extract(t, '^\s*[(\[<]\s*(?:v\s+)?(?:speaker|spk|s)[\s_#-]*(\d{1,4})\s*[)\]>]', 1, 'i'), '') AS INTEGER),
      TRY_CAST(nullif(regexp_extract(t, '^\s*(?:>+\s*)?(?:speaker|spk|s)[\s_#-]*(\d{1,4})\s*(?::|\s[-–—])', 1, 'i'), '') AS INTEGER)) AS no
  FROM timed
), people AS (SELECT asset_id, speaker_p_id, min(no) AS by_person FROM numbered WHERE no IS NOT NULL AND speaker_p_id IS NOT NULL GROUP BY ALL),
cleaned AS (
  SELECT asset_id, seg_idx, start_sec, speaker_p_id, no,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
      '\([^()]*\)|\[[^\[\]]*\]|\{[^{}]*\}|<[^<>]*>|\*[^*]*\*|♪[^♪]*♪', ' ', 'g'),
      '\([^()]*\)|\[[^\[\]]*\]|\{[^{}]*\}|<[^<>]*>', ' ', 'g'),
      '\d{1,3}:\d{2}(:\d{2})?([.,;:]\d{1,3})?|\b\d{1,3}h\d{1,2}m\d{1,2}(\.\d+)?s\b', ' ', 'gi'),
      '^[\s>-]*(speaker|spk|s)[\s_#-]*\d{1,4}\s*(:|\s[-–—])', ' ', 'i'),
      '\b(u+h+-?h+u+h+|m+-?h+m+|u+h*m+|u+h+|e+r+m*|a+h+m*|h+m+|m{2,}|e+h+m*)\b', ' ', 'gi') AS said
  FROM numbered
), counting AS (
  SELECT c.asset_id, c.seg_idx, c.start_sec, coalesce(c.no, p.by_person, -1) AS speaker_no
  FROM cleaned c LEFT JOIN people p USING (asset_id, speaker_p_id)
  WHERE c.start_sec IS NOT NULL AND NOT isnan(c.start_sec) AND regexp_matches(c.said, '[\p{L}\p{N}]')
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY start_sec, seg_idx) - row_number() OVER (PARTITION BY asset_id, speaker_no ORDER BY start_sec, seg_idx) AS island FROM counting
)
SELECT DISTINCT asset_id, speaker_no, arg_min(seg_idx, (start_sec, seg_idx)) AS first_seg_idx, arg_max(seg_idx, (start_sec, seg_idx)) AS last_seg_idx
FROM ordered GROUP BY asset_id, speaker_no, island
"""

_P9 = r"""
WITH d AS (SELECT DISTINCT doc_id, list_transform(regexp_extract_all(text, '[\p{L}\p{N}]+'), lambda x: replace(lower(x), 'ß', 'ss')) AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT DISTINCT item_id, list_transform(regexp_extract_all(text, '[\p{L}\p{N}]+'), lambda x: replace(lower(x), 'ß', 'ss')) AS w FROM eval_item WHERE text IS NOT NULL),
dg AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(w[k:k + 12], ' '))) AS g FROM d WHERE len(w) >= 13),
ig AS (SELECT item_id, unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(w[k:k + 12], ' '))) AS g FROM i WHERE len(w) >= 13)
SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)
"""

_P9_REPLACED = r"""
WITH d AS (SELECT DISTINCT doc_id, list_transform(regexp_extract_all(text, '[\p{L}\p{N}]+'), lambda x: replace(lower(x), 'ß', 'ss')) AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT DISTINCT item_id, list_transform(regexp_extract_all(text, '[\p{L}\p{N}]+'), lambda x: replace(lower(x), 'ß', 'ss')) AS w FROM eval_item WHERE text IS NOT NULL),
dw AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 11), lambda k: w[k:k + 12])) AS g FROM d WHERE len(w) >= 13),
iw AS (SELECT item_id, unnest(list_transform(range(1, len(w) - 11), lambda k: w[k:k + 12])) AS g FROM i WHERE len(w) >= 13),
dk AS (SELECT doc_id, r, hash(g[1:r - 1], 0, g[r + 1:13]) AS h FROM dw, range(1, 14) t(r)),
ik AS (SELECT item_id, r, hash(g[1:r - 1], 0, g[r + 1:13]) AS h FROM iw, range(1, 14) t(r))
SELECT DISTINCT doc_id, item_id FROM dk JOIN ik USING (r, h)
"""

_P10_SPIKES = """
WITH t AS (SELECT DISTINCT source, text FROM documents WHERE length(text) > 0),
l AS (SELECT source, 'chars' AS unit, CAST(length(text) AS INTEGER) AS length FROM t UNION ALL SELECT source, 'bytes', CAST(octet_length(encode(text)) AS INTEGER) FROM t),
c AS (SELECT source, unit, length, count(*) AS texts FROM l GROUP BY ALL),
x AS (
  SELECT *, (coalesce(sum(texts) OVER lo, 0) + coalesce(sum(texts) OVER hi, 0)) / 18.0 AS expected FROM c
  WINDOW lo AS (PARTITION BY source, unit ORDER BY length RANGE BETWEEN 12 PRECEDING AND 4 PRECEDING), hi AS (PARTITION BY source, unit ORDER BY length RANGE BETWEEN 4 FOLLOWING AND 12 FOLLOWING)
)
SELECT source, unit, length, texts, round(CAST(expected AS DOUBLE), 6) AS expected FROM x WHERE texts >= 6 AND texts >= 5.0 * greatest(expected, 0.5)
"""


def oracle_sql() -> dict[str, str]:
    return {"p3_found": _P3, "p4_found": _P4, "p4_bisected": _P4_BISECTED, "p5_found": _P5, "p9_found": _P9, "p9_replaced": _P9_REPLACED, "p9_items": f"SELECT item_id, count(*) AS n_docs FROM ({_P9}) GROUP BY item_id", "p10_spikes": _P10_SPIKES}
