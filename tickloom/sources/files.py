"""File scans: CSV, JSON lines, Parquet, text, and rows given in memory."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def in_memory(
    spark: SparkSession, rows: Iterable, schema: StructType | Sequence[str]
) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files, one row per line, in the column ``line``."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """CSV with a header row. Without a schema the types are inferred, which costs a
    second pass over the text; give the schema for large inputs."""
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_json_lines(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame:
    """JSON lines. Without a schema the types are inferred by an extra pass."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def file_inventory(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Path and size of each file that holds something; the contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .load(path)
        .select(
            F.col("path").alias("file_path"),
            F.col("length").alias("file_size"),
        )
    )


def read_csv_checked(
    spark: SparkSession, path: str, schema: StructType | None = None, glob: str = "*.csv"
) -> DataFrame:
    """CSV from an object store, after checking that it arrived and is not empty."""
    if file_inventory(spark, path, glob).isEmpty():
        raise FileNotFoundError(f"no {glob} with content in {path}")
    return read_csv(spark, path, schema)
