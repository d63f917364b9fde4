"""Small tables that are replaced as a whole: every write is a new version, readers take the newest finished one.

A version is a folder; it is finished once Spark's writer has left its success marker, which it does last. So a reader
during a write sees the version before, and a write that fails leaves that in force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _folder(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def versions(spark: SparkSession, path: str) -> list[int]:
    """The finished versions, oldest first."""
    files, folder = _folder(spark, path)
    if not files.exists(folder):
        return []
    names = [s.getPath().getName() for s in files.listStatus(folder)]
    found = [n for n in names if n.startswith("version=") and files.exists(_folder(spark, f"{path}/{n}/_SUCCESS")[1])]
    return sorted(int(n.removeprefix("version=")) for n in found)


def read(spark: SparkSession, path: str, schema: StructType, before: int | None = None) -> DataFrame:
    """The newest finished version (older than ``before``); without one, an empty table."""
    known = [v for v in versions(spark, path) if before is None or v < before]
    return spark.read.schema(schema).parquet(f"{path}/version={known[-1]}") if known else spark.createDataFrame([], schema)


def write(table: DataFrame, path: str, version: int | None = None, keep: int = 2) -> int:
    """Write the next version, or the one given (again, if it is there); all but the newest ``keep`` are deleted.

    Two writers of the same next version: the second one fails, and nothing is lost. Readers hold a version for as long
    as ``keep`` - 1 writes take.
    """
    spark = table.sparkSession
    number = version if version is not None else max(versions(spark, path), default=-1) + 1
    table.write.mode("errorifexists" if version is None else "overwrite").parquet(f"{path}/version={number}")
    for old in [v for v in versions(spark, path) if v <= number][:-keep]:
        files, folder = _folder(spark, f"{path}/version={old}")
        files.delete(folder, True)
    return number
