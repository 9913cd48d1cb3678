"""Readers and writers: JSON folders and lines, delimited text, timelines in XML, binary files, upserts and run logs."""

from __future__ import annotations

import json
import uuid
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json_folder(spark: SparkSession, path: str, schema: T.StructType, key: str) -> DataFrame:
    """One row per JSON file; files that can't be parsed, or without the key, are left out."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").json(path).where(F.col(key).isNotNull())


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row per JSON line; blank and broken lines are left out."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r"), "value").where(F.expr("try_parse_json(value) IS NOT NULL") & F.col("r").isNotNull()).select("r.*")


def json_line_errors(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file, line, reference) of lines that are not JSON; lines count from 1 within their file."""
    files = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), F.posexplode(F.split("value", "\r?\n")).alias("n", "text"))
    bad = files.where((F.trim("text") != "") & F.expr("try_parse_json(text) IS NULL"))
    return bad.select("file", (F.col("n") + 1).alias("line"), F.concat("file", F.lit("#L"), F.lpad((F.col("n") + 1).cast("string"), 3, "0")).alias("reference"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


CLIP_ITEM = T.StructType([
    T.StructField("_id", T.StringType()), T.StructField("name", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("in", T.LongType()), T.StructField("out", T.LongType()),
    T.StructField("file", T.StructType([T.StructField("_id", T.StringType()), T.StructField("pathurl", T.StringType())])), T.StructField("link", T.ArrayType(T.StructType([T.StructField("linkclipref", T.StringType())]))),
])
_TRACKS = T.StructType([T.StructField("track", T.ArrayType(T.StructType([T.StructField("clipitem", T.ArrayType(CLIP_ITEM))])))])
SEQUENCE = T.StructType([T.StructField("name", T.StringType()), T.StructField("duration", T.LongType()), T.StructField("media", T.StructType([T.StructField("video", _TRACKS), T.StructField("audio", _TRACKS)]))])


def read_timeline(spark: SparkSession, path: str) -> DataFrame:
    """Rows (sequence, track, clip_id, name, start, end, source_in, source_out, file_id, pathurl, links) of timelines in XML.

    Tracks are V1, V2 .. and A1, A2 .. by order. A file that is described once and then only named has its path everywhere.
    """
    seq = spark.read.format("xml").schema(SEQUENCE).option("rowTag", "sequence").load(path)
    parts = []
    for kind, letter in (("video", "V"), ("audio", "A")):
        tracks = seq.select(F.col("name").alias("sequence"), F.posexplode(f"media.{kind}.track").alias("n", "t"))
        parts.append(tracks.select("sequence", F.concat(F.lit(letter), F.col("n") + 1).alias("track"), F.explode("t.clipitem").alias("c")))
    clips = parts[0].union(parts[1]).select("sequence", "track", F.col("c._id").alias("clip_id"), "c.name", "c.start", "c.end", F.col("c.in").alias("source_in"), F.col("c.out").alias("source_out"), F.col("c.file._id").alias("file_id"), F.col("c.file.pathurl").alias("_p"), F.transform(F.coalesce("c.link", F.array()), lambda x: x["linkclipref"]).alias("links"))
    paths = clips.where("_p IS NOT NULL").groupBy("sequence", "file_id").agg(F.min("_p").alias("pathurl"))
    return clips.drop("_p").join(paths, ["sequence", "file_id"], "left")


def path_of_url(url: Column) -> Column:
    """File path of a path URL; a plus sign stays one."""
    return F.try_url_decode(F.replace(F.regexp_replace(url, r"^file://(?:localhost)?/?(?=/|[A-Za-z](?::|%3[aA]))", ""), F.lit("+"), F.lit("%2B")))


def url_of_path(path: Column) -> Column:
    """Path URL of a file path: % and blank, a drive's colon and letters outside ASCII are escaped, slashes stay."""
    slashed = F.regexp_replace(path, r"\\", "/")
    escaped = F.regexp_replace(F.regexp_replace(slashed, "%", "%25"), " ", "%20")
    drive = F.regexp_replace(escaped, r"^([A-Za-z]):", "$1%3a")
    letters = F.transform(F.split(drive, ""), lambda c: F.when(c.rlike(r"^[\x00-\x7F]*$"), c).otherwise(F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1")))
    return F.concat(F.lit("file://localhost/"), F.regexp_replace(F.array_join(letters, ""), "^/", ""))


def rewrite_text(spark: SparkSession, path: str, pattern: str, replacement: str) -> DataFrame:
    """Rows (file, text) of whole files with a pattern replaced and all else as it was."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.regexp_replace("value", pattern, replacement).alias("text"))


def partial_hash(content: Column, length: Column) -> Column:
    """SHA-256 of the first and last mebibyte, or of all if no more than both, and the size as eight bytes, big end first."""
    part = 1 << 20
    body = F.when(length <= 2 * part, content).otherwise(F.concat(F.substring(content, 1, part), F.substring(content, -part, part)))
    return F.sha2(F.concat(body, F.unhex(F.lpad(F.hex(length), 16, "0"))), 256)


def read_file_ids(spark: SparkSession, path: str) -> DataFrame:
    """Rows (path, length, asset_id) of all files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "length", partial_hash(F.col("content"), F.col("length")).alias("asset_id"))


def unlisted(files: DataFrame, path: str, known: DataFrame, known_path: str) -> DataFrame:
    """Files whose path, without case and kind of slash, is not known."""
    bare = lambda c: F.lower(F.regexp_replace(c, r"\\", "/"))
    return files.withColumn("_k", bare(F.col(path))).join(known.select(bare(F.col(known_path)).alias("_k")), "_k", "left_anti").drop("_k")


def upsert(df: DataFrame, key: list[str], sequence: list[Column]) -> DataFrame:
    """The last row of each key by the sequence."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*(c.desc() for c in sequence)))).where("_n = 1").drop("_n")


def insert_ignore(df: DataFrame, key: list[str], sequence: list[Column]) -> DataFrame:
    """The first row of each key by the sequence."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*(c.asc() for c in sequence)))).where("_n = 1").drop("_n")


def replace_table(df: DataFrame, path: str) -> str:
    """Write a new version beside the others and name it in a pointer file; readers see the old version until then."""
    version = f"{path}/v-{uuid.uuid4().hex}"
    df.write.parquet(version)
    df.sparkSession.createDataFrame([(version, datetime.now(UTC))], "version string, at timestamp").coalesce(1).write.mode("append").parquet(f"{path}/_pointer")
    return version


def read_replaced(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(spark.read.parquet(f"{path}/_pointer").orderBy(F.desc("at")).first()["version"])


def log_run(spark: SparkSession, path: str, name: str, status: str, detail: dict) -> None:
    """Add a row to an append-only log of runs."""
    spark.createDataFrame([(name, status, json.dumps(detail, sort_keys=True), datetime.now(UTC))], "name string, status string, detail string, at timestamp").write.mode("append").parquet(path)


def null_out(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in columns})


def pending(df: DataFrame, key: list[str], ledger: DataFrame) -> DataFrame:
    """Rows whose key is not in the ledger of work done."""
    return df.join(ledger.select(*key).distinct(), key, "left_anti")


def union_sources(parts: dict[str, DataFrame]) -> DataFrame:
    """Rows of all sources with their kind; columns that a source lacks are null."""
    first, *rest = (df.withColumn("kind", F.lit(kind)) for kind, df in parts.items())
    for more in rest:
        first = first.unionByName(more, allowMissingColumns=True)
    return first
