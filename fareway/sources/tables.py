"""Batch sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str | None = None
) -> DataFrame:
    """Parquet or CSV with header. CSV needs a schema: guessing one reads the data twice."""
    kind = fmt or ("csv" if path.rstrip("/").lower().endswith((".csv", ".csv.gz")) else "parquet")
    if kind == "parquet":
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    if kind == "csv":
        if schema is None:
            raise ValueError("a CSV table needs a schema")
        return spark.read.schema(schema).csv(path, header=True, mode="PERMISSIVE")
    raise ValueError(f"unsupported table format {kind!r}")


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """(image, value): one row per annotation file, named by the file without its suffix."""
    name = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1)
    return spark.read.text(path, wholetext=True).select(name.alias("image"), "value")


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the whole table."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header, written by the executors."""
    df.write.mode("overwrite").csv(path, header=True)


def export_records(
    df: DataFrame, path: str, order: Sequence[str | Column], limit: int | None = 500
) -> None:
    """JSON records in table order with ISO dates; ``limit`` bounds the file."""
    shown = df.orderBy(*order)
    if limit is not None:
        shown = shown.limit(limit)
    shown.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def source_profile(spark: SparkSession, path: str) -> DataFrame:
    """Size, rows and columns per landed Parquet file, from one scan without columns."""
    df = spark.read.parquet(path)
    names = F.array(*[F.lit(name) for name in df.columns])
    sized = df.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")
    )
    return sized.groupBy("path").agg(
        F.max("size").alias("file_size_bytes"), F.count("*").alias("rows")
    ).withColumn("columns", names)
