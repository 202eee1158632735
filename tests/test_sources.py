from datetime import datetime, timezone

import pytest
from helpers import TICK_SCHEMA, bars_of, day, tick

from tickloom.functions import EmptyInputError
from tickloom.plans.market import market_job, market_summary
from tickloom.plans.people import profile_csv, select_people
from tickloom.schemas import KAFKA_RECORD, PERSON, TICK
from tickloom.session import DEFAULTS
from tickloom.sinks import files as sinks
from tickloom.sinks.jdbc import write_options
from tickloom.sources import (
    empty_ticks,
    file_inventory,
    in_memory,
    jdbc_options,
    open_ticks,
    or_fallback,
    read_csv,
    read_csv_checked,
    read_lines,
    topic_options,
)
from tickloom.sources.jdbc import preview_query
from tickloom.workspace import fresh_path, shared_folder


def test_session_defaults(spark):
    assert all(spark.conf.get(key) == value for key, value in DEFAULTS.items())


def test_shared_folder_comes_from_the_session(spark):
    folder = shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    assert fresh_path(spark, "x").startswith(f"{folder}/x-")
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_shared_folder_must_be_named_on_a_cluster():
    class Conf:
        def __init__(self, master):
            self.master = master

        def get(self, key, default=None):
            return self.master if key == "spark.master" else default

    class Session:
        def __init__(self, master):
            self.conf = Conf(master)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session("spark://host:7077"))
    assert shared_folder(Session("local[2]"))


def test_csv_with_declared_and_inferred_types(spark, tmp_path):
    path = str(tmp_path / "people.csv")
    people = in_memory(spark, [("Uma", 61), ("Vic", None)], PERSON)
    sinks.write_csv(people, path)
    assert sorted(read_csv(spark, path, PERSON).collect(), key=str) == sorted(people.collect(), key=str)
    assert read_csv(spark, path).dtypes == [("name", "string"), ("age", "int")]


def test_single_csv_is_one_file_with_header(spark, tmp_path):
    path = str(tmp_path / "one")
    sinks.write_single_csv(spark.range(1000).repartition(8), path)
    (file,) = (tmp_path / "one").glob("part-*")
    assert file.read_text().splitlines()[0] == "id"
    assert len(file.read_text().splitlines()) == 1001


def test_checked_csv(spark, tmp_path):
    (tmp_path / "in").mkdir()
    with pytest.raises(FileNotFoundError):
        read_csv_checked(spark, str(tmp_path / "in"))
    (tmp_path / "in" / "a.csv").write_text("")
    with pytest.raises(FileNotFoundError):
        read_csv_checked(spark, str(tmp_path / "in"))
    (tmp_path / "in" / "b.csv").write_text("name,age\nUma,61\n")
    assert read_csv_checked(spark, str(tmp_path / "in"), PERSON).collect() == [("Uma", 61)]
    sizes = {r.file_path.rsplit("/", 1)[1]: r.file_size for r in file_inventory(spark, str(tmp_path / "in")).collect()}
    assert sizes == {"b.csv": 16}


def test_lines(spark, tmp_path):
    (tmp_path / "t.txt").write_text("first line\n\nend")
    assert [r.line for r in read_lines(spark, str(tmp_path / "t.txt")).collect()] == ["first line", "", "end"]


def test_topic_options():
    assert topic_options("b:9092", "ticks") == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "ticks",
        "startingOffsets": "earliest",
        "endingOffsets": "latest",
    }
    stream = topic_options("b", "t", bounded=False, tolerate_loss=True, extra={"minPartitions": "64"})
    assert stream == {
        "kafka.bootstrap.servers": "b",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "minPartitions": "64",
    }
    for since in (datetime(2024, 1, 1), datetime(2024, 1, 1, tzinfo=timezone.utc)):
        assert topic_options("b", "t", records_since=since)["startingTimestamp"] == "1704067200000"


def test_jdbc_options():
    login = {"user": "u", "password": "p"}
    assert jdbc_options("jdbc:x", "stock_prices", login) == {
        "url": "jdbc:x",
        "dbtable": "stock_prices",
        **login,
    }
    split = jdbc_options("jdbc:x", "t", partition_column="date", lower=day(1), upper=day(9), partitions=4)
    assert split["partitionColumn"] == "date" and split["lowerBound"] == "2024-01-01"
    assert split["upperBound"] == "2024-01-09" and split["numPartitions"] == "4"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="date")
    assert "truncate" not in write_options("jdbc:x", "t")
    assert write_options("jdbc:x", "t", mode="overwrite")["truncate"] == "true"


def test_preview_limits_in_the_database():
    assert preview_query() == "(SELECT * FROM public.sample_table LIMIT 10) preview"
    assert preview_query("t", 3) == "(SELECT * FROM t LIMIT 3) preview"
    with pytest.raises(ValueError):
        preview_query("t; DROP TABLE t")


def test_empty_topic_falls_back(spark, tmp_path):
    nothing = spark.createDataFrame([], KAFKA_RECORD)
    assert or_fallback(spark, nothing, None).schema == TICK
    assert or_fallback(spark, nothing, str(tmp_path / "missing")).schema == TICK
    sinks.write_parquet(bars_of(spark, A=[1, 2]), str(tmp_path / "stored"))
    assert or_fallback(spark, nothing, str(tmp_path / "stored")).count() == 2
    one = spark.createDataFrame([(None, bytearray(b"{}"), "t", 0, 0, None, 0)], KAFKA_RECORD)
    assert or_fallback(spark, one, None) is None
    assert empty_ticks(spark).isEmpty()


@pytest.fixture
def stored_ticks(spark, tmp_path):
    ticks = [
        tick(ticker, f"2024-01-{d:02d} {hour}:00:00", float(d + i))
        for i, ticker in enumerate(("A", "B"))
        for d in range(1, 21)
        for hour in ("09", "15")
    ]
    path = str(tmp_path / "ticks")
    sinks.write_parquet(spark.createDataFrame(ticks, TICK_SCHEMA), path)
    return path


def test_file_and_db_location_read_parquet_in_range(spark, stored_ticks, tmp_path):
    for kind in ("file", "db"):
        found = open_ticks(
            spark, kind, location=stored_ticks, start=datetime(2024, 1, 2), end=datetime(2024, 1, 3)
        )
        assert found.count() == 8
    assert open_ticks(spark, "file", default_path=stored_ticks).count() == 80
    with pytest.raises(ValueError, match="no location"):
        open_ticks(spark, "file", default_path=str(tmp_path / "missing"))
    with pytest.raises(ValueError, match="unknown source"):
        open_ticks(spark, "ftp")


def test_market_job(spark, stored_ticks, tmp_path):
    out = str(tmp_path / "out")
    market_job(
        spark, "file", out, "2024-01-05", "2024-01-09", tickers="B", fmt="parquet",
        save_raw=True, location=stored_ticks,
    )
    (row,) = spark.read.parquet(out).collect()
    # The range is padded by three days before and one after.
    assert (row.ticker, row.date, row.close, row.volume) == ("B", day(10), 11.0, 2)
    raw = spark.read.parquet(f"{out}_raw")
    assert raw.count() == 18
    assert raw.agg({"date": "min"}).first()[0] == day(2)


def test_market_job_formats(spark, stored_ticks, tmp_path):
    summary = market_summary(spark.read.parquet(stored_ticks))
    for fmt in ("csv", "JSON", "parquet"):
        sinks.save(summary, str(tmp_path / fmt), fmt)
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 2
    documents = spark.read.json(str(tmp_path / "JSON"))
    assert {r.ticker: r.close for r in documents.collect()} == {"A": 20.0, "B": 21.0}
    with pytest.raises(ValueError, match="unknown format"):
        sinks.save(summary, str(tmp_path / "x"), "xml")


def test_default_output():
    assert sinks.default_output(day(5)) == "stock_analysis_results_20240105"


def test_market_job_without_ticks(spark, stored_ticks, tmp_path):
    for options in ({"tickers": "Z"}, {"start": "2030-01-01", "end": "2030-01-02"}):
        arguments = {"start": "2024-01-05", "end": "2024-01-09", **options}
        with pytest.raises(EmptyInputError):
            market_job(spark, "file", str(tmp_path / "none"), location=stored_ticks, **arguments)
    assert not (tmp_path / "none").exists()


def test_profile_csv_job(spark, tmp_path):
    sinks.write_csv(in_memory(spark, [("Uma", 61), ("Vic", 20)], PERSON), str(tmp_path / "in"))
    profile = profile_csv(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert tuple(profile.first()) == (40.5, 61, 2)
    (file,) = (tmp_path / "out").glob("part-*")
    assert file.read_text() == "avg_age,max_age,count_rows\n40.5,61,2\n"
    with pytest.raises(ValueError, match="score"):
        profile_csv(spark, str(tmp_path / "in"), str(tmp_path / "out2"), "score")


def test_people_job(spark, tmp_path):
    people = in_memory(spark, [("Uma", 61), ("Vic", 20), ("Wen", 33)], PERSON)
    select_people(people, str(tmp_path / "out"), single_file=True)
    (file,) = (tmp_path / "out").glob("part-*")
    lines = file.read_text().splitlines()
    assert lines[0] == "name,age,initial" and sorted(lines[1:]) == ["Uma,61,U", "Wen,33,W"]
