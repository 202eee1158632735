"""Feature and regression queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.catalog.views import LISTING_FIELDS, LISTING_KEYS, listings
from tickloom.operators import features as ml
from tickloom.plans.listings import fit_formula, fit_full, fit_line, price_models, settled_split
from tickloom.workspace import settle

CATEGORICAL = ["neighbourhood_cleansed", "room_type"]
NUMERIC = ["bedrooms", "bathrooms", "number_of_reviews"]


def _random_split(spark, sf_dir):
    """The rows of both parts together: none is lost, none is in both. Which part a row is
    in is no matter of SQL; tests look at the share and at repeated splits."""
    train, test = ml.random_split(listings(spark, sf_dir).select(*LISTING_KEYS))
    return train.unionByName(test)


def _marked(spark, sf_dir):
    return ml.with_split(listings(spark, sf_dir), LISTING_KEYS).select(*LISTING_KEYS, "split")


def _split(spark, sf_dir):
    return ml.hash_split(listings(spark, sf_dir), LISTING_KEYS)


def _feature_vector(spark, sf_dir):
    vectors = ml.assembler(["bedrooms"]).transform(listings(spark, sf_dir))
    values = ml.features_as_array(vectors)
    return values.select(*LISTING_KEYS, F.col("features")[0].alias("feature"), "price")


def _line(spark, sf_dir):
    """Slope and intercept of the fitted line, as the model reports them."""
    rows = listings(spark, sf_dir)
    model = ml.regression().fit(ml.assembler(["bedrooms"]).transform(rows))
    numbers = (round(float(model.coefficients[0]), 2), round(float(model.intercept), 2))
    return spark.createDataFrame([numbers], "slope double, intercept double")


def _line_aggregate(spark, sf_dir):
    line = ml.fitted_line(listings(spark, sf_dir), "bedrooms", "price")
    return line.select(F.round("slope", 2).alias("slope"), F.round("intercept", 2).alias("intercept"))


def _line_predictions(spark, sf_dir):
    fitted, _ = fit_line(*_split(spark, sf_dir))
    return fitted.predictions.select(
        *LISTING_KEYS, "bedrooms", F.round("prediction", 2).alias("prediction")
    )


def _indexed(spark, sf_dir):
    rows = listings(spark, sf_dir)
    return ml.indexer(CATEGORICAL).fit(rows).transform(rows)


def _string_index(spark, sf_dir):
    return _indexed(spark, sf_dir).select(
        *LISTING_KEYS, "neighbourhood_cleansedIndex", "room_typeIndex"
    )


def _one_hot(spark, sf_dir):
    rows = _indexed(spark, sf_dir)
    encoded = ml.one_hot(CATEGORICAL).fit(rows).transform(rows)
    values = ml.features_as_array(encoded, "neighbourhood_cleansedOHE")
    values = ml.features_as_array(values, "room_typeOHE")
    slots, room = F.col("neighbourhood_cleansedOHE"), F.col("room_typeOHE")
    return values.select(
        *LISTING_KEYS, slots[0].alias("slot_0"), slots[1].alias("slot_1"), room[0].alias("room_0")
    )


def _assembled(spark, sf_dir):
    rows = _indexed(spark, sf_dir)
    encoded = ml.one_hot(CATEGORICAL).fit(rows).transform(rows)
    inputs = [f"{name}OHE" for name in CATEGORICAL] + NUMERIC
    values = ml.features_as_array(ml.assembler(inputs).transform(encoded))
    slots = [F.col("features")[i].alias(f"feature_{i}") for i in range(6)]
    return values.select(*LISTING_KEYS, *slots)


def _fit_balance(spark, sf_dir):
    """What a least-squares fit must keep: over the training rows, the predictions have
    the mean of the prices per label and the same mean products with each number."""
    train, _ = settled_split(listings(spark, sf_dir), LISTING_KEYS, LISTING_FIELDS)
    train = train.select(*LISTING_FIELDS)
    fitted = settle(fit_full(train, train).predictions.select(*LISTING_FIELDS, "prediction"), "fitted")
    value = lambda factor: F.round(F.avg(factor), 1).alias("value")
    labels = [
        fitted.groupBy(F.concat(F.lit(f"{column}="), column).alias("name")).agg(value(F.col("prediction")))
        for column in CATEGORICAL
    ]
    products = [
        fitted.agg(value(F.col(column) * F.col("prediction"))).select(F.lit(column).alias("name"), "value")
        for column in NUMERIC
    ]
    return reduce(DataFrame.unionByName, [*labels, *products])


def _predictions(fit):
    def query(spark, sf_dir):
        train, test = settled_split(listings(spark, sf_dir), LISTING_KEYS, LISTING_FIELDS)
        fitted = fit(train.select(*LISTING_FIELDS), test)
        return fitted.predictions.select(
            *LISTING_KEYS, "price", F.round("prediction", 1).alias("prediction")
        )

    return query


def _price_models(spark, sf_dir):
    """Both models of the job, fitted from rows written once."""
    models = price_models(listings(spark, sf_dir), LISTING_KEYS)
    rows = [
        fitted.predictions.select(
            *LISTING_KEYS, F.lit(name).alias("model"), F.round("prediction", 1).alias("prediction")
        )
        for name, fitted in models.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def _string_index_join(spark, sf_dir):
    rows = listings(spark, sf_dir)
    for column in CATEGORICAL:
        rows = ml.with_label_index(rows, column)
    return rows.select(*LISTING_KEYS, "neighbourhood_cleansedIndex", "room_typeIndex")


QUERIES = {
    "price_models": _price_models,
    "string_index_join": _string_index_join,
    "random_split": _random_split,
    "hash_split": _marked,
    "feature_vector": _feature_vector,
    "simple_regression": _line,
    "simple_regression_aggregate": _line_aggregate,
    "line_predictions": _line_predictions,
    "string_index": _string_index,
    "one_hot": _one_hot,
    "assembled_features": _assembled,
    "price_model": _predictions(fit_full),
    "price_model_fit": _fit_balance,
    "price_model_formula": _predictions(fit_formula),
}

_KEYS = "l_orderkey, l_linenumber, l_partkey"


def split_sql(*keys: str) -> str:
    text = " || '|' || ".join(f"CAST({key} AS VARCHAR)" for key in keys)
    # Four fifths of the range of eight hex digits.
    return f"if(md5({text}) < 'cccccccc', 'train', 'test')"


def _index_of(column: str) -> str:
    return f"""(SELECT {column}, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1.0 AS idx
                FROM lineitem GROUP BY {column})"""


_LINE = """
  SELECT round(regr_slope(l_extendedprice, l_quantity), 2) AS slope,
         round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept
  FROM lineitem"""

_INDEXED = f"""
indexed AS (
  SELECT lineitem.*, CAST(flag.idx AS DOUBLE) AS flag, CAST(state.idx AS DOUBLE) AS state
  FROM lineitem
  JOIN {_index_of("l_returnflag")} flag USING (l_returnflag)
  JOIN {_index_of("l_linestatus")} state USING (l_linestatus)
)"""

def _least_squares() -> str:
    """Predictions of the regression on all features, for the test rows.

    One feature after the other is regressed on; each time its share is taken out of the
    features that follow, so that the slopes do not depend on one another.
    """
    features = [
        "CAST(l_returnflag = 'A' AS DOUBLE)",
        "CAST(l_returnflag = 'N' AS DOUBLE)",
        "CAST(l_linestatus = 'F' AS DOUBLE)",
        *("l_quantity", "l_discount", "l_tax"),
    ]
    columns = ", ".join(f"{feature} AS x{i}" for i, feature in enumerate(features))
    split = split_sql("l_orderkey", "l_linenumber", "l_partkey")
    steps = [
        f"""rows_0 AS (
          SELECT {_KEYS}, l_extendedprice AS price, {split} AS split, {columns},
                 (SELECT avg(l_extendedprice) FROM lineitem WHERE {split} = 'train') AS fit
          FROM lineitem
        )"""
    ]
    for i in range(len(features)):
        later = range(i + 1, len(features))
        shares = "".join(f", regr_slope(x{k}, x{i}) AS share_{k}" for k in later)
        left = "".join(f", x{k} - share_{k} * (x{i} - mu) AS x{k}" for k in later)
        steps.append(
            f"""line_{i} AS (
              SELECT avg(x{i}) AS mu, regr_slope(price, x{i}) AS slope{shares}
              FROM rows_{i} WHERE split = 'train'
            ), rows_{i + 1} AS (
              SELECT {_KEYS}, price, split, fit + slope * (x{i} - mu) AS fit{left}
              FROM rows_{i}, line_{i}
            )"""
        )
    return f"""WITH {", ".join(steps)}
        SELECT {_KEYS}, price, round(fit, 1) AS prediction
        FROM rows_{len(features)} WHERE split = 'test'"""


ORACLES = {
    "price_model": _least_squares(),
    "price_model_formula": _least_squares(),
    "random_split": f"SELECT {_KEYS} FROM lineitem",
    "hash_split": f"""
        SELECT {_KEYS}, {split_sql("l_orderkey", "l_linenumber", "l_partkey")} AS split
        FROM lineitem""",
    "feature_vector": f"SELECT {_KEYS}, l_quantity AS feature, l_extendedprice AS price FROM lineitem",
    "simple_regression": _LINE,
    "simple_regression_aggregate": _LINE,
    "line_predictions": f"""
        WITH rows AS (
          SELECT *, {split_sql("l_orderkey", "l_linenumber", "l_partkey")} AS split FROM lineitem
        ), line AS (
          SELECT regr_slope(l_extendedprice, l_quantity) AS m,
                 regr_intercept(l_extendedprice, l_quantity) AS b
          FROM rows WHERE split = 'train'
        )
        SELECT {_KEYS}, l_quantity AS bedrooms, round(m * l_quantity + b, 2) AS prediction
        FROM rows, line WHERE split = 'test'""",
    "price_model_fit": f"""
        WITH train AS (
          SELECT * FROM lineitem
          WHERE {split_sql("l_orderkey", "l_linenumber", "l_partkey")} = 'train'
        ), factors AS (
          SELECT l_extendedprice AS price,
                 unnest(['bedrooms', 'bathrooms', 'number_of_reviews']) AS name,
                 unnest([l_quantity, l_discount, l_tax]) AS factor
          FROM train
        )
        SELECT name, round(avg(factor * price), 1) AS value FROM factors
        GROUP BY name
        UNION ALL
        SELECT 'neighbourhood_cleansed=' || l_returnflag, round(avg(l_extendedprice), 1)
        FROM train GROUP BY l_returnflag
        UNION ALL
        SELECT 'room_type=' || l_linestatus, round(avg(l_extendedprice), 1)
        FROM train GROUP BY l_linestatus""",
    "string_index": f"""WITH {_INDEXED}
        SELECT {_KEYS}, flag AS "neighbourhood_cleansedIndex", state AS "room_typeIndex"
        FROM indexed""",
    "one_hot": f"""WITH {_INDEXED}
        SELECT {_KEYS}, CAST(flag = 0 AS DOUBLE) AS slot_0, CAST(flag = 1 AS DOUBLE) AS slot_1,
               CAST(state = 0 AS DOUBLE) AS room_0
        FROM indexed""",
    "assembled_features": f"""WITH {_INDEXED}
        SELECT {_KEYS}, CAST(flag = 0 AS DOUBLE) AS feature_0, CAST(flag = 1 AS DOUBLE) AS feature_1,
               CAST(state = 0 AS DOUBLE) AS feature_2, l_quantity AS feature_3,
               l_discount AS feature_4, l_tax AS feature_5
        FROM indexed""",
}

ORACLES["string_index_join"] = ORACLES["string_index"]
ORACLES["price_models"] = f"""
    SELECT * FROM (
      SELECT {_KEYS}, 'full' AS model, prediction FROM ({ORACLES["price_model"]})
      UNION ALL
      SELECT {_KEYS}, 'line', prediction
      FROM ({ORACLES["line_predictions"].replace("b, 2)", "b, 1)")}))"""
