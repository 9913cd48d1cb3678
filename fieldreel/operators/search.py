"""Full-text search: an inverted index, BM25, and boolean, phrase and prefix queries."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldreel.functions.python import fold, stem, stems

# Constants of the ranking function.
K1, B = 1.2, 0.75

#: Folders of a stored index, and the letters of a term that choose its folder.
FOLDERS, FOLDER_LETTERS = 64, 3


def words_of(text: Column, stemmed: bool) -> Column:
    """Lower-case words of a text, without accents and stemmed if asked for."""
    words = F.regexp_extract_all(F.lower(fold(text) if stemmed else text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    return stems(words) if stemmed else words


def query_words(text: str, stemmed: bool) -> list[str]:
    import unicodedata

    low = text.lower()
    if stemmed:
        low = unicodedata.normalize("NFKD", low).encode("ascii", "ignore").decode()
    found = re.findall(r"[^\W_]+", low)
    return [stem(w) for w in found] if stemmed else found


@dataclass
class Index:
    """Postings (doc, term, tf, places) and lengths (doc, len) of the non-blank texts.

    A stored index also has the number and mean length of documents (totals, one row), lengths beside its postings, and
    its postings in folders by the first letters of the term, of which a query reads its own only.
    """

    postings: DataFrame
    lengths: DataFrame
    totals: DataFrame | None = None

    def of(self, terms: list[str], prefix: bool = False) -> DataFrame:
        """Postings of the terms, or of terms that begin with one of them."""
        if not terms:
            return self.postings.where(F.lit(False))
        rows = self.postings
        if self.totals is not None and not (prefix and any(len(t) < FOLDER_LETTERS for t in terms)):
            rows = rows.where(F.col("folder").isin(sorted({zlib.crc32(t[:FOLDER_LETTERS].encode()) % FOLDERS for t in terms})))
        return rows.where(reduce(lambda a, b: a | b, (F.col("term").startswith(t) for t in terms)) if prefix else F.col("term").isin(terms))


def build_index(df: DataFrame, id: str, text: str, *, stemmed: bool = True) -> Index:
    """Index of the texts; null and blank ones are left out. Terms are counted within a text before anything is shuffled."""
    rows = df.where(F.trim(text) != "").select(F.col(id).alias("doc"), words_of(F.col(text), stemmed).alias("words"))
    postings = rows.select("doc", F.posexplode("words").alias("place", "term")).groupBy("doc", "term").agg(F.count("*").alias("tf"), F.array_sort(F.collect_list("place")).alias("places"))
    return Index(postings, rows.select("doc", F.size("words").alias("len")))


def save_index(index: Index, path: str) -> None:
    """Write an index to a folder, replacing what is there: postings by folders of terms, lengths, and totals."""
    folder = F.crc32(F.encode(F.left("term", F.lit(FOLDER_LETTERS)), "UTF-8")) % FOLDERS
    postings = index.postings.join(index.lengths, "doc").withColumn("folder", folder.cast("int"))
    # a folder may hold a frequent word: its rows go to several files
    postings.repartition(F.col("folder"), F.pmod(F.xxhash64("doc"), F.lit(8))).write.mode("overwrite").partitionBy("folder").parquet(f"{path}/postings")
    index.lengths.write.mode("overwrite").parquet(f"{path}/lengths")
    index.lengths.agg(F.count("*").alias("n"), F.avg("len").alias("mean")).coalesce(1).write.mode("overwrite").parquet(f"{path}/totals")


def load_index(spark: SparkSession, path: str) -> Index:
    """An index that ``save_index`` wrote; queries read the folders of their terms only."""
    return Index(*(spark.read.parquet(f"{path}/{part}") for part in ("postings", "lengths", "totals")))


def bm25(index: Index, query: str, *, stemmed: bool = True, match_all: bool = True) -> DataFrame:
    """Rows (doc, score) of documents that hold all words of the query (or any): higher is better. No words match nothing.

    Rarity has a small floor above zero for words in more than half of the documents. Only the query's words are read
    from the postings; the number and mean length of documents are one row, made by one aggregation.
    """
    terms = list(dict.fromkeys(query_words(query, stemmed)))
    hits = index.of(terms)
    df = hits.groupBy("term").agg(F.count("*").alias("df"))
    total = index.totals if index.totals is not None else index.lengths.agg(F.count("*").alias("n"), F.avg("len").alias("mean"))
    hits = hits if index.totals is not None else hits.join(index.lengths, "doc")
    scored = hits.join(F.broadcast(df), "term").join(F.broadcast(total), F.lit(True))  # one row per query word; one row
    rarity = F.greatest(F.lit(1e-6), F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5)))
    weight = rarity * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / F.col("mean")))
    found = scored.groupBy("doc").agg(F.sum(weight).alias("score"), F.count("*").alias("held"))
    return found.where(F.col("held") >= (len(terms) if match_all else 1)).select("doc", "score")


def _phrase(index: Index, words: list[str], prefix: bool) -> DataFrame:
    """Documents in which the words follow one another; the last may be a prefix."""
    parts = []
    for k, w in enumerate(words):
        parts.append(index.of([w], prefix and k == len(words) - 1).select("doc", F.explode("places").alias("p")).select("doc", (F.col("p") - k).alias("p")).distinct())
    return reduce(lambda a, b: a.join(b, ["doc", "p"], "left_semi"), parts).select("doc").distinct()


def match(index: Index, query: str, *, stemmed: bool = True) -> DataFrame:
    """Documents (doc) that a query with AND, OR, NOT, "phrases", prefix* and brackets matches; words side by side mean AND.

    NOT takes away from what stands before it. A query without words matches nothing; an open quote or bracket is closed
    at the end.
    """
    found = re.findall(r'"[^"]*"?|[()]|[^\s()"]+', query)
    at = 0

    def peek() -> str | None:
        return found[at] if at < len(found) else None

    def primary() -> DataFrame | None:
        nonlocal at
        token = found[at]
        at += 1
        if token == "(":
            inner = either()
            if peek() == ")":
                at += 1
            return inner
        words = query_words(token, stemmed)
        return _phrase(index, words, token.endswith("*")) if words else None

    def both() -> DataFrame | None:
        nonlocal at
        result = None
        while (token := peek()) is not None and token not in (")", "OR"):
            negative = token == "NOT"
            if token in ("AND", "NOT"):
                at += 1
                if peek() is None:
                    break
            part = primary()
            if part is not None:
                if negative:
                    result = result.join(part, "doc", "left_anti") if result is not None else None
                else:
                    result = part if result is None else result.join(part, "doc", "left_semi")
        return result

    def either() -> DataFrame | None:
        nonlocal at
        result = both()
        while peek() == "OR":
            at += 1
            more = both()
            result = more if result is None else result if more is None else result.union(more).distinct()
        return result

    result = either() if found else None
    return index.lengths.select("doc").limit(0) if result is None else result
