from datetime import date, datetime

import pytest

from tickloom import functions as fn
from tickloom.operators.people import older_than, with_initial
from tickloom.operators.profile import column_profile, count_by, max_by_key, row_total
from tickloom.operators.text import word_count
from tickloom.schemas import PERSON
from tickloom.sources.files import in_memory

PEOPLE = [("mira", 52), ("Noor", 19), ("Ode", 27), ("Pim", 26)]
LINES = ["rain on tin", "rain and wind", "tin roof"]


def column(spark, kind, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_missing_numbers_become_zero(spark):
    values = [1.5, None, float("nan"), 0.0]
    assert column(spark, "double", values, fn.zero_if_missing("x")) == [1.5, 0.0, 0.0, 0.0]


def test_initial_and_its_python_form_agree(spark):
    names = ["mira", "Noor", "", None, "ähre", "ßa", "한글", " x"]
    native = column(spark, "string", names, fn.initial("x"))
    assert native == ["M", "N", None, None, "Ä", "SS", "한", " "]
    assert native == column(spark, "string", names, fn.initial_udf("x"))


def test_percent_and_ratio_of_zero_base_are_unknown(spark):
    df = spark.createDataFrame([(1.0, 0.0), (3.0, 2.0)], "a double, b double")
    found = df.select(fn.percent_above("a", "b"), fn.ratio("a", "b")).collect()
    assert [tuple(r) for r in found] == [(None, None), (50.0, 1.5)]


def test_days_as_text(spark):
    days = [date(2024, 3, 1), None]
    assert column(spark, "date", days, fn.day_text("x")) == ["2024-03-01", None]
    assert column(spark, "date", days, fn.lagged_day("x")) == ["20240223", None]
    moment = [datetime(2024, 1, 3, 23)]
    assert column(spark, "timestamp", moment, fn.lagged_day("x", 7, "yyMMdd")) == ["231227"]


def test_flag_of_unknown_condition_is_zero(spark):
    from pyspark.sql import functions as F

    assert column(spark, "int", [1, 3, None], fn.flag(F.col("x") > 2)) == [0, 1, 0]


def test_guards(spark):
    df = in_memory(spark, PEOPLE, ["name", "age"])
    assert fn.require_columns(df, "age") is df and fn.require_rows(df) is df
    with pytest.raises(ValueError, match="score.*name.*age"):
        fn.require_columns(df, "age", "score")
    with pytest.raises(fn.EmptyInputError, match="people"):
        fn.require_rows(df.limit(0), "people")


def test_people_above_age_with_initial(spark):
    df = in_memory(spark, [*PEOPLE, ("Quin", None)], PERSON)
    found = with_initial(older_than(df)).collect()
    assert sorted(map(tuple, found)) == [("Ode", 27, "O"), ("mira", 52, "M")]


def test_word_count(spark):
    df = in_memory(spark, [(line,) for line in LINES], ["line"])
    counts = {r.word: r["count"] for r in word_count(df).collect()}
    assert counts == {"rain": 2, "tin": 2, "on": 1, "and": 1, "wind": 1, "roof": 1}


def test_empty_words_count(spark):
    df = in_memory(spark, [("a  b ",), ("",)], ["line"])
    counts = {r.word: r["count"] for r in word_count(df).collect()}
    assert counts == {"a": 1, "": 3, "b": 1}


def test_profile_and_counts(spark):
    df = in_memory(spark, [*PEOPLE, ("Noor", None)], PERSON)
    assert tuple(column_profile(df).first()) == (31.0, 52, 4)
    assert column_profile(df).columns == ["avg_age", "max_age", "count_rows"]
    with pytest.raises(ValueError):
        column_profile(df, "score")
    assert {tuple(r) for r in count_by(df, "name").collect()} == {
        ("mira", 1),
        ("Noor", 2),
        ("Ode", 1),
        ("Pim", 1),
    }
    assert ("Noor", 19) in {tuple(r) for r in max_by_key(df, "name", "age", "oldest").collect()}
    assert row_total(df).first()[0] == 5
