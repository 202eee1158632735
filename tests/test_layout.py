"""Lists in tables and stored layouts: same rows, and the plans they are there for."""

import pytest
from helpers import TICK_SCHEMA, tick
from pyspark.sql import functions as F

from tickloom.operators.bars import daily_bars
from tickloom.operators.ranges import between_dates, listed_tickers, only_tickers
from tickloom.sinks.ticks import read_tick_table, write_by_ticker, write_tick_table


@pytest.fixture(scope="module")
def ticks(spark):
    rows = [tick(f"T{i % 11}", f"2024-{1 + i % 6:02d}-{1 + i % 27:02d} 10:{i % 60:02d}:00", float(i)) for i in range(2000)]
    return spark.createDataFrame(rows, TICK_SCHEMA)


def plan_of(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def files_read(df):
    """Files that the scan of an executed frame has read."""
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    if plan.getClass().getSimpleName() == "ResultQueryStageExec":
        plan = plan.plan()
    leaves = plan.collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size())]
    return sum(x.metrics().apply("numFiles").value() for x in scans if x.metrics().contains("numFiles"))


def same(left, right):
    columns = sorted(left.columns)
    return sorted(map(repr, left.select(columns).collect())) == sorted(map(repr, right.select(columns).collect()))


def test_listed_tickers_prune_the_scan(spark, ticks, tmp_path):
    path = str(tmp_path / "ticks")
    write_by_ticker(ticks, path)
    stored = spark.read.parquet(path)
    listed = spark.createDataFrame([("T3",), ("T3",), ("T7",), ("",), (None,), ("T99",)], "ticker string")
    found = listed_tickers(stored, listed)
    assert same(found, only_tickers(ticks, ["T3", "T7"]))
    assert "dynamicpruning" in plan_of(found).lower()
    found.collect()
    scan, *_ = [line for line in plan_of(found).split("\n") if "PartitionFilters" in line and "dynamicpruning" in line]
    assert "ticker" in scan
    whole = spark.read.parquet(path)
    whole.collect()
    assert files_read(found) == files_read(whole) * 2 // 11
    assert listed_tickers(stored, listed.limit(0)).collect() == []


def test_a_table_in_buckets_needs_no_exchange_by_ticker(spark, ticks, tmp_path):
    name = "bucketed_ticks"
    write_tick_table(ticks, name, str(tmp_path / "table"), buckets=4)
    stored = read_tick_table(spark, name, "2024-02-10", "2024-03-20")
    assert same(stored, between_dates(ticks, "2024-02-10", "2024-03-20"))
    per_ticker = stored.groupBy("ticker").agg(F.sum("volume").alias("volume"))
    assert "Exchange" not in plan_of(per_ticker) and "Bucketed: true" in plan_of(per_ticker)
    assert same(per_ticker, between_dates(ticks, "2024-02-10", "2024-03-20").groupBy("ticker").agg(F.sum("volume").alias("volume")))
    files = lambda df: df.select(F.input_file_name().alias("f")).distinct().count()
    assert files(stored) <= files(read_tick_table(spark, name)) / 2
    assert "PartitionFilters: [isnotnull(month" in plan_of(stored)
    assert same(daily_bars(read_tick_table(spark, name)), daily_bars(ticks))
    spark.sql(f"DROP TABLE {name}")
