"""Session helpers shared by all operators."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def steady(spark: SparkSession) -> None:
    """Plan unions as before 4.1: otherwise a union may claim a partitioning that adaptive execution has changed since, and a join on it fails."""
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table of a dataset folder."""
    steady(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application under the cluster's ``spark.checkpoint.dir``.

    Without that setting a session on one machine, as in tests, takes a temporary folder of its own; on a cluster it is
    an error, as a folder of the driver's machine would be out of the executors' reach.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoint-")
        atexit.register(shutil.rmtree, folder, True)
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return f"{folder.rstrip('/')}/{spark.sparkContext.applicationId}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from its files.

    A lost executor then costs no recomputation. Unlike a checkpoint, the table has its true size, where a checkpoint
    keeps the estimate of the plan behind it, which multiplies with every join of a loop. A loop gives the tables that
    it no longer reads to ``release``; those that a result still reads stay until ``clear_tables``.
    """
    spark = df.sparkSession
    steady(spark)
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def release(*tables: DataFrame) -> None:
    """Delete the files of tables made by ``cut_lineage`` that nothing reads any more; other frames are left alone."""
    for table in tables:
        if path := table.__dict__.pop("_written_to", None):
            _delete(table.sparkSession, path)


def clear_tables(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; results not yet read can't be read afterwards."""
    _delete(spark, shared_folder(spark))
