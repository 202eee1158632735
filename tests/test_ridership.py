import glob
import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tickloom.catalog import reports
from tickloom.operators import ridership as rid
from tickloom.plans.ridership import (
    land_ridership,
    read_ridership,
    report_ridership,
    ridership_figures,
)
from tickloom.sinks.files import land_json
from tickloom.sinks.reports import write_report, write_report_document
from tickloom.sources.envelope import read_envelopes
from tickloom.sources.paths import daily_paths

ROWS = [
    ("1호선", "서울역", "100", "50"),
    ("1호선", "시청", "80", "90"),
    ("2호선", "시청", "70", "10"),
    ("2호선", "강남", "60", None),
    ("2호선", "종점", "40", "0"),
    ("2호선", "[괄호]", "x", "5"),
]
NAMES = ["SBWY_ROUT_LN_NM", "SBWY_STNS_NM", "GTON_TNOPE", "GTOFF_TNOPE"]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(ROWS, " string, ".join(NAMES) + " string")


@pytest.fixture
def rides(raw):
    return rid.with_counters(raw)


def ordered(df):
    return [tuple(r) for r in df.collect()]


def test_unreadable_counters_become_unknown(rides):
    assert dict(rides.dtypes)["GTON_TNOPE"] == "bigint"
    assert rides.filter(F.col("GTON_TNOPE").isNull()).count() == 1


def test_line_totals_skip_rows_with_a_missing_side(rides):
    assert ordered(rid.line_totals(rides)) == [("1호선", 320), ("2호선", 120)]


def test_station_totals(rides):
    assert ordered(rid.station_totals(rides)) == [
        ("시청", 150, 100),
        ("서울역", 100, 50),
        ("강남", 60, None),
        ("종점", 40, 0),
        ("[괄호]", None, 5),
    ]


def test_ratio_is_unknown_and_last_where_nobody_alights(rides):
    assert ordered(rid.board_ratio(rides)) == [
        ("서울역", 2.0),
        ("시청", 1.5),
        ("[괄호]", None),
        ("강남", None),
        ("종점", None),
    ]
    assert ordered(rid.top_ratio(rides, 1)) == [("서울역", 2.0)]


def test_ratio_rounds_half_up(spark):
    df = spark.createDataFrame([("a", "s", 201, 200), ("a", "t", 1, 8)], NAMES)
    assert dict(ordered(rid.board_ratio(df))) == {"s": 1.01, "t": 0.13}


def test_top_stations_break_ties_by_name(spark):
    df = spark.createDataFrame([("l", s, 1, 1) for s in "gfedcba"], NAMES)
    assert [r[0] for r in ordered(rid.top_stations(df))] == list("abcde")
    assert "TakeOrderedAndProject" in (
        rid.top_stations(df)._jdf.queryExecution().executedPlan().toString()
    )


def test_report_figures_equal_the_single_queries(rides):
    lines = rid.report_lines(rid.usage_by_line_and_station(rides)).collect()

    def section(name, *fields):
        return {tuple(r[f] for f in fields) for r in lines if r.section == name}

    figures = {name: set(ordered(df)) for name, df in ridership_figures(rides).items()}
    assert section("total_by_line", "name", "total") == figures["total_by_line"]
    assert section("station_stats", "name", "boarding", "alighting") == figures["station_stats"]
    assert section("ratio_top10", "name", "ratio") == figures["ratio_top10"]
    assert section("top5_stations", "name", "total") == figures["top5_stations"]


def read_text(path):
    return "".join(open(f, encoding="utf-8").read() for f in sorted(glob.glob(f"{path}/part-*")))


def test_report_document(rides, tmp_path):
    path = str(tmp_path / "report.json")
    write_report_document(rides, path, datetime(2024, 3, 8, 1, 2, 3))
    text = read_text(path)
    report = json.loads(text)
    assert "서울역" in text
    assert list(report) == [
        *("total_by_line", "station_stats", "ratio_top10", "top5_stations"),
        "generated_at",
    ]
    assert report["generated_at"] == "2024-03-08 01:02:03"
    assert report["total_by_line"] == [
        {"line_name": "1호선", "total_passengers": 320},
        {"line_name": "2호선", "total_passengers": 120},
    ]
    assert [s["station_name"] for s in report["station_stats"]] == [
        *("시청", "서울역", "강남", "종점", "[괄호]")
    ]
    assert report["station_stats"][2] == {
        "station_name": "강남",
        "total_boarding": 60,
        "total_alighting": None,
    }
    assert report["ratio_top10"][:2] == [
        {"station_name": "서울역", "board_to_alight_ratio": 2.0},
        {"station_name": "시청", "board_to_alight_ratio": 1.5},
    ]
    assert report["top5_stations"][0] == {"station_name": "시청", "total_usage": 250}


def test_report_lines_are_in_order_and_whole(rides, tmp_path):
    path = str(tmp_path / "report")
    write_report(rides, path, datetime(2024, 3, 8, 1, 2, 3))
    entries = [json.loads(line) for line in read_text(path).splitlines()]
    names = {}
    for e in entries:
        assert set(e) == {"section", "name", "total", "boarding", "alighting", "ratio", "generated_at"}
        assert e["generated_at"] == "2024-03-08 01:02:03"
        names.setdefault(e["section"], []).append(e["name"])
    assert list(names) == sorted(names)
    assert names["total_by_line"] == ["1호선", "2호선"]
    assert names["station_stats"] == ["시청", "서울역", "강남", "종점", "[괄호]"]
    assert names["ratio_top10"] == ["서울역", "시청", "[괄호]", "강남", "종점"]
    assert names["top5_stations"] == ["시청", "서울역", "종점", "[괄호]", "강남"]


def test_daily_paths():
    paths = daily_paths("2024-03-05", "subway")
    assert paths.day == date(2024, 2, 27)
    assert paths.landing == "subway/20240227/240227.json"
    assert paths.report == "subway/analysis/20240227.json"
    assert daily_paths(date(2024, 1, 1), lag_days=0).day == date(2024, 1, 1)


def test_landing_keeps_brackets(spark, raw, tmp_path):
    path = str(tmp_path / "rows")
    land_json(raw, path)
    stored = read_ridership(spark, path)
    assert stored.filter(F.col("SBWY_STNS_NM") == "[괄호]").count() == 1
    assert stored.count() == len(ROWS)


def answer(code, rows):
    result = {"CODE": code, "MESSAGE": "m"}
    items = [dict(zip(NAMES, row)) for row in rows]
    return {"CardSubwayStatsNew": {"list_total_count": len(items), "RESULT": result, "row": items}}


def test_land_and_report(spark, tmp_path):
    answers = tmp_path / "answers"
    answers.mkdir()
    good = json.dumps(answer("INFO-000", ROWS), indent=2, ensure_ascii=False)
    (answers / "a.json").write_text(good, encoding="utf-8")
    (answers / "b.json").write_text(json.dumps(answer("ERROR-300", ROWS)), encoding="utf-8")
    root = str(tmp_path / "subway")
    target = land_ridership(spark, str(answers), "2024-03-08", root)
    assert target == f"{root}/20240301/240301.json"
    assert read_ridership(spark, target).count() == len(ROWS)
    entries = [json.loads(e) for e in read_text(report_ridership(spark, "2024-03-08", root)).splitlines()]
    first = next(e for e in entries if e["section"] == "total_by_line")
    assert (first["name"], first["total"]) == ("1호선", 320)


def test_files_of_one_answer_and_of_many_read_alike(spark, tmp_path):
    answers = [answer("INFO-000", ROWS[i:]) for i in range(3)]
    for folder in ("one", "many"):
        (tmp_path / folder).mkdir()
    for i, one in enumerate(answers):
        (tmp_path / "one" / f"{i}.json").write_text(json.dumps(one, indent=1), encoding="utf-8")
    (tmp_path / "many" / "all.json").write_text("\n".join(map(json.dumps, answers)), encoding="utf-8")
    read = [read_envelopes(spark, str(tmp_path / f), f == "one").collect() for f in ("one", "many")]
    assert sorted(map(repr, read[0])) == sorted(map(repr, read[1])) and len(read[0]) == 3


def test_only_errors_land_nothing(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(answer("ERROR-300", [])))
    assert land_ridership(spark, str(tmp_path), "2024-03-08", str(tmp_path / "out")) is None
    assert not (tmp_path / "out").exists()


def test_answer_files_of_a_hot_supplier_are_bounded(spark, tmp_path, monkeypatch):
    supplier = F.when(F.col("id") < 5000, 1).when(F.col("id") >= 5003, F.col("id") % 9)
    sales = spark.range(6000).select(
        F.col("id").alias("l_orderkey"),
        F.lit(1).alias("l_linenumber"),
        (F.col("id") % 7).alias("l_partkey"),
        supplier.alias("l_suppkey"),
        F.lit("O").alias("l_linestatus"),
        F.lit("A").alias("l_returnflag"),
        F.lit(3.0).alias("l_quantity"),
        F.lit(datetime(2024, 3, 8)).alias("l_shipdate"),
    )
    sales.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(2).write.parquet(f"{tmp_path}/nation.parquet")
    read = []
    monkeypatch.setattr(reports, "read_envelopes", lambda *a: read.append(read_envelopes(*a)) or read[0])
    rows = reports.QUERIES["api_answer_files"](spark, str(tmp_path))
    sizes = [r[0] for r in read[0].select(F.size("CardSubwayStatsNew.row")).collect()]
    assert sum(sizes) == 6000 and max(sizes) <= 1000 and len(sizes) < 40
    assert rows.count() == 6000 and rows.filter("SBWY_STNS_NM IS NULL").count() == 3
