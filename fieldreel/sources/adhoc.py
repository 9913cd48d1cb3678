"""Ad-hoc SQL over tables of several named schemas."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def ask(spark: SparkSession, schemas: dict[str, dict[str, DataFrame]], sql: str) -> DataFrame:
    """Run SQL in which tables are named schema.table, or by table alone where one schema has it.

    The frames are bound to this statement only; nothing is left registered. A name in quotes, or after another dot, is
    not a table.
    """
    frames: dict[str, DataFrame] = {}
    owners: dict[str, list[str]] = {}
    for schema, tables in schemas.items():
        for table, df in tables.items():
            frames[f"{schema}__{table}"] = df
            owners.setdefault(table, []).append(schema)
    used: dict[str, DataFrame] = {}

    def bind(match: re.Match) -> str:
        if match["quoted"]:
            return match[0].replace("{", "{{").replace("}", "}}")
        schema, table = match["schema"], match["table"]
        if schema is None and len(owners.get(table, [])) == 1:
            schema = owners[table][0]
        name = f"{schema}__{table}"
        if name not in frames:
            return match[0]
        used[name] = frames[name]
        alias = "" if match["alias"] else f" AS {table}"
        return f"{match['before']}{{{name}}}{alias}{match['alias'] or ''}"

    words = r"WHERE|JOIN|LEFT|RIGHT|FULL|INNER|CROSS|ON|USING|GROUP|ORDER|LIMIT|UNION|HAVING|SEMI|ANTI|NATURAL|EXCEPT|INTERSECT"
    table = rf"(?i)(?P<quoted>'(?:[^']|'')*'|\"[^\"]*\"|--[^\n]*)|(?P<before>\b(?:FROM|JOIN)\s+)(?:(?P<schema>\w+)\.)?(?P<table>\w+)(?P<alias>\s+(?:AS\s+)?(?!(?:{words})\b)[a-z_]\w*)?"
    return spark.sql(re.sub(table, bind, sql), **used)


def to_tsv(df: DataFrame, path: str) -> None:
    """Write a result as tab-separated text with a header, one file for each partition."""
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)
