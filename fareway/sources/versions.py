"""Versioned tables: a folder for each version, complete once Spark has marked it so."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def subfolders(spark: SparkSession, root: str, key: str) -> list[str]:
    """Values of the folders ``key=value`` below ``root``, ascending as text."""
    folder, files = _folder(spark, root)
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder) if status.isDirectory()]
    return sorted(name[len(key) + 1 :] for name in names if name.startswith(f"{key}="))


def versions(spark: SparkSession, root: str) -> list[int]:
    """Complete versions, ascending."""
    found = []
    for name in subfolders(spark, root, "version"):
        mark, files = _folder(spark, f"{root}/version={name}/_SUCCESS")
        if files.exists(mark):
            found.append(int(name))
    return sorted(found)


def write_version(df: DataFrame, root: str, version: int) -> None:
    """Write a version, over whatever a failed attempt has left of it."""
    df.write.mode("overwrite").parquet(f"{root}/version={version}")


def read_version(spark: SparkSession, root: str, version: int, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{root}/version={version}")


def drop_versions(spark: SparkSession, root: str, before: int) -> None:
    """Remove versions older than ``before``."""
    for name in subfolders(spark, root, "version"):
        if int(name) < before:
            folder, files = _folder(spark, f"{root}/version={name}")
            files.delete(folder, True)
