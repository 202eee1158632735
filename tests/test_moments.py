"""Models from sums equal models from rows."""

import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import features as ml
from tickloom.operators import moments as mo
from tickloom.plans.listings import fit_full

CATEGORICAL, NUMERIC = ["kind", "place"], ["size", "age"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    data = []
    for i in range(600):
        kind, place = rng.choice("aaabc"), rng.choice("xy")
        size, age = rng.uniform(10, 90), rng.uniform(0, 40)
        price = {"a": 5, "b": 90, "c": -40}[kind] + (30 if place == "x" else 0) + 3 * size - age + rng.gauss(0, 5)
        data.append((i, kind, place, size, age, f"L{rng.randint(0, 60)}", price))
    return spark.createDataFrame(data, "id int, kind string, place string, size double, age double, host string, price double").cache()


def by_id(df, digits=6):
    return {r["id"]: round(r["prediction"], digits) for r in df.select("id", "prediction").collect()}


def test_predictions_equal_those_of_the_pipeline(rows):
    wanted = rows.select("kind", "place", "size", "age", "price")
    expected = by_id(fit_full(wanted, rows).predictions, 4)
    model = mo.fit_by_moments(rows, CATEGORICAL, NUMERIC, "price")
    assert by_id(model.predict(rows), 4) == expected


def test_a_further_part_joins_without_the_old_rows(spark, rows, tmp_path):
    path = str(tmp_path / "moments")
    for day in range(3):
        mo.store_moments(mo.moments(rows.filter(f"id % 3 = {day}"), CATEGORICAL, NUMERIC, "price"), path, f"d{day}")
    # A day that is stored again counts once.
    mo.store_moments(mo.moments(rows.filter("id % 3 = 1"), CATEGORICAL, NUMERIC, "price"), path, "d1")
    whole = mo.fit_by_moments(rows, CATEGORICAL, NUMERIC, "price")
    parts = mo.solve(mo.stored_moments(spark, path, CATEGORICAL), CATEGORICAL, NUMERIC, "price")
    assert by_id(parts.predict(rows)) == by_id(whole.predict(rows))


def test_numbers_alone_and_unknown_labels(spark, rows):
    line = mo.fit_by_moments(rows, [], ["size"], "price")
    expected = ml.fitted_line(rows, "size", "price").first()
    assert line.slopes["size"] == pytest.approx(expected.slope) and line.intercept == pytest.approx(expected.intercept)
    model = mo.fit_by_moments(rows, ["kind"], ["size"], "price")
    other = spark.createDataFrame([(1, "z", 1.0), (2, None, 1.0), (3, "a", 1.0)], "id int, kind string, size double")
    assert list(by_id(model.predict(other))) == [3]


def test_rows_with_unknown_numbers_are_not_fitted(spark, rows):
    odd = rows.unionByName(rows.limit(3).withColumn("size", F.lit(None).cast("double"))).unionByName(
        rows.limit(3).withColumn("age", F.lit(float("nan")))
    )
    model, expected = (mo.fit_by_moments(x, CATEGORICAL, NUMERIC, "price") for x in (odd, rows))
    assert model.slopes == pytest.approx(expected.slopes)


def test_many_labels_are_absorbed(rows):
    """Equal to a column for each label."""
    dense = mo.fit_by_moments(rows, ["host"], NUMERIC, "price")
    model = mo.absorb(mo.label_sums(rows, "host", NUMERIC, "price"), "host", NUMERIC, "price")
    assert by_id(model.predict(rows), 4) == by_id(dense.predict(rows), 4)
    assert model.shares.count() == 61
    parts = [mo.label_sums(rows.filter(f"id % 2 = {i}"), "host", NUMERIC, "price") for i in (0, 1)]
    again = mo.absorb(mo.merged(parts, ["host"]), "host", NUMERIC, "price")
    assert by_id(again.predict(rows), 4) == by_id(dense.predict(rows), 4)


def test_too_many_combinations_are_refused(rows, monkeypatch):
    monkeypatch.setattr(mo, "MOST_COMBINATIONS", 10)
    with pytest.raises(ValueError, match="absorb"):
        mo.fit_by_moments(rows, ["host"], NUMERIC, "price")
    with pytest.raises(ValueError, match="no rows"):
        mo.fit_by_moments(rows.limit(0), ["kind"], NUMERIC, "price")
    with pytest.raises(ValueError, match="no rows"):
        mo.absorb(mo.label_sums(rows.limit(0), "host", NUMERIC, "price"), "host", NUMERIC, "price")


def test_sparse_features(rows):
    index = ml.label_index(rows, "host")
    found = mo.sparse_features(rows, index, "host", NUMERIC)
    at = {r["host"]: int(r["index"]) for r in index.collect()}
    for r in found.limit(50).collect():
        assert r["slots"] == [0, 1, 2 + at[r["host"]]] and r["values"] == [r["size"], r["age"], 1.0]
    none = mo.sparse_features(rows.withColumn("size", F.lit(0.0)), index, "host", NUMERIC).first()
    assert len(none["slots"]) == 2
