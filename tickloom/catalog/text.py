"""Queries over people, words, single columns, and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.catalog.views import documents, people, table
from tickloom.functions import day_text, initial_udf, lagged_day, ratio, zero_if_missing
from tickloom.operators.people import older_than, with_initial
from tickloom.operators.profile import column_profile, preview, row_total
from tickloom.operators.text import word_count


def _scalars(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    return line.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        zero_if_missing(ratio("l_tax", "l_discount")).alias("tax_per_discount"),
        F.abs(F.col("l_discount") - F.col("l_tax")).alias("gap"),
        F.nullif("l_returnflag", F.lit("N")).alias("returned"),
        day_text("l_shipdate").alias("ship_day"),
        lagged_day("l_shipdate", 7, "yyyyMMdd").alias("landing_day"),
    )


QUERIES = {
    "word_count": lambda spark, sf_dir: word_count(documents(spark, sf_dir)),
    "name_initial": lambda spark, sf_dir: with_initial(older_than(people(spark, sf_dir), 26)),
    "name_initial_udf": lambda spark, sf_dir: older_than(people(spark, sf_dir), 26).withColumn(
        "initial", initial_udf("name")
    ),
    "column_profile": lambda spark, sf_dir: column_profile(
        table(spark, sf_dir, "lineitem"), "l_quantity"
    ),
    "table_preview": lambda spark, sf_dir: preview(
        table(spark, sf_dir, "orders"), order_by=["o_orderkey"]
    ).withColumn("o_orderdate", F.col("o_orderdate").cast("date")),
    "row_total": lambda spark, sf_dir: row_total(table(spark, sf_dir, "lineitem")),
    "scalar_functions": _scalars,
}

ORACLES = {
    "word_count": """
        SELECT word, count(*) AS count
        FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word""",
    "name_initial": """
        SELECT c_name AS name, c_acctbal AS age, upper(left(nullif(c_name, ''), 1)) AS initial
        FROM customer WHERE c_acctbal > 26""",
    "column_profile": """
        SELECT avg(l_quantity) AS avg_l_quantity, max(l_quantity) AS max_l_quantity,
               count(l_quantity) AS count_rows
        FROM lineitem""",
    "table_preview": """
        SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate)
        FROM orders ORDER BY o_orderkey LIMIT 10""",
    "row_total": "SELECT count(*) AS row_total FROM lineitem",
    "scalar_functions": """
        SELECT l_orderkey, l_linenumber, l_partkey,
               coalesce(l_tax / nullif(l_discount, 0), 0) AS tax_per_discount,
               abs(l_discount - l_tax) AS gap, nullif(l_returnflag, 'N') AS returned,
               strftime(l_shipdate, '%Y-%m-%d') AS ship_day,
               strftime(l_shipdate - INTERVAL 7 DAY, '%Y%m%d') AS landing_day
        FROM lineitem""",
}
ORACLES["name_initial_udf"] = ORACLES["name_initial"]
