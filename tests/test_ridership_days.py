"""Reports over a range of days from stored figures."""

import json
import random
from datetime import date

import pytest

from tickloom.operators.ridership import report_lines, usage_by_line_and_station, with_counters
from tickloom.plans import ridership_days as rd
from tickloom.sinks.files import land_json
from tickloom.sources.paths import daily_paths
from tickloom.workspace import settle

SCHEMA = "USE_YMD string, SBWY_ROUT_LN_NM string, SBWY_STNS_NM string, GTON_TNOPE string, GTOFF_TNOPE string, REG_YMD string"


def rides(spark, seed, n=60):
    rng = random.Random(seed)
    number = lambda: rng.choice([None, "x", *map(str, range(1, 50))])
    rows = [("d", f"line{rng.randint(1, 3)}", f"s{rng.randint(1, 9)}", number(), number(), "r") for _ in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(map(repr, df.collect()))


def expected(*frames):
    rows = frames[0]
    for frame in frames[1:]:
        rows = rows.unionByName(frame)
    return rows_of(report_lines(settle(usage_by_line_and_station(with_counters(rows)), "usage")))


@pytest.fixture
def days(spark, tmp_path):
    root = str(tmp_path / "subway")
    frames = {}
    for i in range(5):
        run = date(2024, 3, 8 + i)
        frames[run] = rides(spark, i)
        land_json(frames[run], daily_paths(run, root).landing)
        rd.store_day(spark, run, root)
    return root, list(frames.values())


def test_a_range_equals_a_report_over_all_rows(spark, days):
    root, frames = days
    assert rows_of(rd.range_lines(spark, root, "2024-03-02", "2024-03-04")) == expected(*frames[1:4])
    assert rows_of(rd.range_lines(spark, root)) == expected(*frames)
    assert rd.missing_days(spark, root, [date(2024, 3, 1), date(2024, 3, 9)]) == [date(2024, 3, 9)]


def test_a_day_landed_again_counts_once(spark, days):
    root, frames = days
    run = date(2024, 3, 10)
    again = rides(spark, 99, 30)
    land_json(again, daily_paths(run, root).landing)
    rd.store_day(spark, run, root)
    assert rows_of(rd.range_lines(spark, root)) == expected(*frames[:2], again, *frames[3:])


def test_the_report_of_a_range(spark, days):
    root, frames = days
    path = rd.report_range(spark, root, "2024-03-01", "2024-03-02")
    lines = [json.loads(r.value) for r in spark.read.text(path).collect()]
    sums = {x["name"]: x["total"] for x in lines if x["section"] == "total_by_line"}
    assert sums == {r.name: r.total for r in rd.range_lines(spark, root, "2024-03-01", "2024-03-02").filter("section = 'total_by_line'").collect()}


def test_landed_rows_are_not_read(spark, days):
    root, _ = days
    lines = rd.stored_usage(spark, root, "2024-03-02", "2024-03-03")
    files = {x.rsplit("/", 2)[-2] for x in (r[0] for r in lines.selectExpr("input_file_name()").distinct().collect())}
    assert files == {"day=2024-03-02", "day=2024-03-03"}


def test_many_days_in_one_pass(spark, tmp_path):
    rows = with_counters(rides(spark, 3, 200)).selectExpr("*", "date_add(date'2024-01-01', cast(hash(SBWY_STNS_NM) % 4 AS int)) AS day")
    root = str(tmp_path / "subway")
    rd.store_usage(rd.usage_by_day(rows), root)
    assert rows_of(rd.range_lines(spark, root)) == rows_of(report_lines(settle(usage_by_line_and_station(rows), "usage")))
