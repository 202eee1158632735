"""Queries that write a table, read it back and show what arrived."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.catalog.views import documents, people, table
from tickloom.operators.profile import count_by
from tickloom.plans.people import profile_csv, select_people
from tickloom.sinks.files import land_json, write_csv, write_parquet
from tickloom.sources.files import (
    file_inventory,
    read_csv,
    read_csv_checked,
    read_json_lines,
    read_lines,
    read_parquet,
)
from tickloom.workspace import fresh_path


def _sales(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    return line.withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


def _csv(spark, sf_dir):
    path, sales = fresh_path(spark, "sales-csv"), _sales(spark, sf_dir)
    write_csv(sales, path)
    return read_csv_checked(spark, path, sales.schema)


def _csv_inferred(spark, sf_dir):
    path = fresh_path(spark, "parts-csv")
    write_csv(table(spark, sf_dir, "part"), path)
    return read_csv(spark, path)


def _parquet(spark, sf_dir):
    path = fresh_path(spark, "sales-parquet")
    write_parquet(_sales(spark, sf_dir), path)
    return read_parquet(spark, path)


def _json(spark, sf_dir):
    path, sales = fresh_path(spark, "sales-json"), _sales(spark, sf_dir)
    land_json(sales, path)
    return read_json_lines(spark, path, sales.schema)


def _lines(spark, sf_dir):
    """Documents written as text and read back line by line; how often each line occurs."""
    path = fresh_path(spark, "lines")
    documents(spark, sf_dir).write.text(path)
    return count_by(read_lines(spark, path), "line")


def _csv_profile(spark, sf_dir):
    path, output = fresh_path(spark, "quantities"), fresh_path(spark, "profile")
    sales = table(spark, sf_dir, "lineitem")
    write_csv(sales.select(F.col("l_quantity").alias("age")), path)
    profile_csv(spark, path, output)
    return read_csv(spark, output, schema="avg_age double, max_age double, count_rows bigint")


def _people_csv(spark, sf_dir):
    output = fresh_path(spark, "people")
    select_people(people(spark, sf_dir), output)
    return read_csv(spark, output, schema="name string, age double, initial string")


def _inventory(spark, sf_dir):
    """Sales written as CSV by day; for each day its rows, and whether all their files are
    listed with the size the reader reports."""
    path = fresh_path(spark, "sales-csv")
    sales = _sales(spark, sf_dir).select("l_orderkey", "l_returnflag")
    sales.write.partitionBy("l_returnflag").option("header", True).csv(path)
    listed = file_inventory(spark, path, "*.csv").withColumn("file_path", _bare_path("file_path"))
    read = spark.read.option("header", True).csv(path)
    rows = read.select("l_returnflag", _bare_path("_metadata.file_path").alias("file_path"), "_metadata.file_size")
    files = rows.groupBy("l_returnflag", "file_path", F.col("file_size").alias("size")).count()
    both = files.join(listed, "file_path", "left")
    complete = F.coalesce(F.col("file_size") == F.col("size"), F.lit(False)).cast("int")
    return both.groupBy("l_returnflag").agg(F.sum("count").alias("row_total"), F.min(complete).alias("all_listed"))


def _bare_path(column):
    """A path without scheme and host, decoded."""
    return F.url_decode(F.regexp_replace(column, "^[a-z0-9]+:/*", "/"))


QUERIES = {
    "csv_roundtrip": _csv,
    "csv_inferred": _csv_inferred,
    "parquet_roundtrip": _parquet,
    "json_roundtrip": _json,
    "text_lines": _lines,
    "csv_profile": _csv_profile,
    "people_csv": _people_csv,
    "file_inventory": _inventory,
}

_SALES = "SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate) FROM lineitem"

ORACLES = {
    "file_inventory": """
        SELECT l_returnflag, count(*) AS row_total, 1 AS all_listed FROM lineitem GROUP BY ALL""",
    "csv_roundtrip": _SALES,
    "csv_inferred": "SELECT * REPLACE (CAST(p_partkey AS INTEGER) AS p_partkey) FROM part",
    "parquet_roundtrip": _SALES,
    "json_roundtrip": _SALES,
    "text_lines": """
        SELECT line, count(*) AS count
        FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY line""",
    "csv_profile": """
        SELECT avg(l_quantity) AS avg_age, max(l_quantity) AS max_age, count(*) AS count_rows
        FROM lineitem""",
    "people_csv": """
        SELECT c_name AS name, c_acctbal AS age, upper(left(c_name, 1)) AS initial
        FROM customer WHERE c_acctbal > 26""",
}
