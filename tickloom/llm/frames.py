"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str) -> str:
    """``base``, with underscores in front until no column of ``df`` is called so."""
    taken = {name.lower() for name in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def whole(text: str | Column) -> Column:
    """The text, with the empty text for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def utf8_bytes(text: str | Column) -> Column:
    return F.octet_length(whole(text)).cast("bigint")
