import numpy as np
import pytest
from pyspark.ml.linalg import DenseVector

from tickloom.operators import features as ml
from tickloom.plans.listings import fit_formula, fit_full, fit_line, price_models, split_listings
from tickloom.schemas import LISTING


@pytest.fixture(scope="module")
def rows():
    generator = np.random.default_rng(5)
    result = []
    for _ in range(400):
        area = generator.choice(["north", "south", "west"], p=[0.5, 0.3, 0.2])
        room = generator.choice(["home", "shared"], p=[0.7, 0.3])
        beds, baths, reviews = (float(generator.integers(1, n)) for n in (6, 4, 90))
        extra = {"north": 5.0, "south": 20.0, "west": 0.0}[str(area)] + (30.0 if room == "home" else 0)
        price = 50 + 40 * beds + 12 * baths - 0.25 * reviews + extra + float(generator.normal(0, 3))
        result.append((str(area), str(room), beds, baths, reviews, price))
    return result


@pytest.fixture(scope="module")
def listings(spark, rows):
    return spark.createDataFrame(rows, LISTING).cache()


def test_column_roles(listings):
    categorical, numeric = ml.column_roles(listings)
    assert categorical == ["neighbourhood_cleansed", "room_type"]
    assert numeric == ["bedrooms", "bathrooms", "number_of_reviews"]


def test_random_split_keeps_every_row(listings):
    train, test = ml.random_split(listings)
    assert train.count() + test.count() == 400
    assert 280 <= train.count() <= 360
    assert train.exceptAll(listings).isEmpty()


def test_random_split_follows_its_weights_and_seed(spark):
    df = spark.range(20_000).repartition(4)
    ids = lambda part: {r.id for r in part.collect()}
    train, test = map(ids, ml.random_split(df))
    assert not train & test and len(train | test) == 20_000
    # Four standard deviations around the share.
    assert abs(len(train) - 16_000) < 4 * (20_000 * 0.8 * 0.2) ** 0.5
    assert tuple(map(ids, ml.random_split(df))) == (train, test)
    other, _ = map(ids, ml.random_split(df, seed=7))
    # Independent of the first: a row is in both with the product of the shares.
    assert abs(len(train & other) - 12_800) < 4 * (20_000 * 0.64 * 0.36) ** 0.5
    half, _ = map(ids, ml.random_split(df, (1, 1)))
    assert abs(len(half) - 10_000) < 4 * (20_000 * 0.25) ** 0.5


def test_hash_split_does_not_depend_on_partitions(spark):
    df = spark.range(5000)
    splits = {
        tuple(sorted(r.id for r in ml.hash_split(df.repartition(n), ["id"])[1].collect()))
        for n in (1, 5, 11)
    }
    assert len(splits) == 1
    assert 850 <= len(splits.pop()) <= 1150
    train, test = ml.hash_split(df, ["id"], train_percent=30)
    assert 1350 <= train.count() <= 1650 and train.union(test).distinct().count() == 5000
    with pytest.raises(ValueError):
        ml.hash_split(df, ["id"], train_percent=100)


def test_single_feature_vector(listings):
    first = ml.assembler(["bedrooms"]).transform(listings).first()
    assert first.features == DenseVector([first.bedrooms])


def test_line_equals_least_squares(listings, rows):
    slope, intercept = np.polyfit([r[2] for r in rows], [r[5] for r in rows], 1)
    fitted, formula = fit_line(listings, listings)
    model = fitted.model.stages[-1]
    assert model.coefficients[0] == pytest.approx(slope)
    assert model.intercept == pytest.approx(intercept)
    assert formula == f"price = {round(slope, 2)}*bedrooms + {round(intercept, 2)}"
    line = ml.fitted_line(listings, "bedrooms", "price").first()
    assert tuple(line) == pytest.approx((slope, intercept))
    one = fitted.predictions.first()
    assert one.prediction == pytest.approx(slope * one.bedrooms + intercept)


def test_labels_are_indexed_by_frequency_then_name(spark):
    df = spark.createDataFrame([(c,) for c in "bbaacd"], "x string")
    model = ml.indexer(["x"]).fit(df)
    assert list(model.labelsArray[0]) == ["a", "b", "c", "d"]
    unseen = spark.createDataFrame([("a",), ("z",)], "x string")
    assert model.transform(unseen).collect() == [("a", 0.0)]


def test_one_hot_drops_the_last_label(listings):
    indexed = ml.indexer(["room_type"]).fit(listings).transform(listings)
    encoded = ml.one_hot(["room_type"]).fit(indexed).transform(indexed)
    values = ml.features_as_array(encoded, "room_typeOHE").select("room_type", "room_typeOHE")
    assert {(r.room_type, tuple(r.room_typeOHE)) for r in values.collect()} == {
        ("home", (1.0,)),
        ("shared", (0.0,)),
    }


def predictions(fitted):
    return [r.prediction for r in fitted.predictions.select("prediction").collect()]


def test_full_model_equals_least_squares(listings, rows):
    design = np.array(
        [[1, r[0] == "north", r[0] == "south", r[1] == "home", *r[2:5]] for r in rows], dtype=float
    )
    prices = np.array([r[5] for r in rows])
    solution, *_ = np.linalg.lstsq(design, prices, rcond=None)
    fitted = fit_full(listings, listings)
    assert fitted.model.stages[-1].coefficients.toArray() == pytest.approx(solution[1:])
    assert predictions(fitted) == pytest.approx(design @ solution)
    assert predictions(fit_formula(listings, listings)) == pytest.approx(design @ solution)


def test_rows_with_unseen_labels_are_skipped(spark, listings):
    new = spark.createDataFrame([("moon", "home", 1.0, 1.0, 1.0, 1.0)], LISTING)
    assert fit_full(listings, new).predictions.isEmpty()


def test_price_models(listings):
    models = price_models(listings)
    test_rows = split_listings(listings)[1].count()
    assert {name: m.predictions.count() for name, m in models.items()} == {
        "line": test_rows,
        "full": test_rows,
    }
    by_key = price_models(listings, ["bedrooms", "price"])
    assert set(by_key["full"].predictions.columns) >= {"features", "price", "prediction"}
