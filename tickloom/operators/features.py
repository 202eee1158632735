"""Features and regression models on ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, RFormula, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.workspace import settle


def random_split(
    df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Seeded random split. It depends on how the rows are spread over partitions and
    sorts each of them by all columns; :func:`hash_split` needs neither."""
    return tuple(df.randomSplit([float(w) for w in weights], seed=seed))


def _in_first(percent: int, keys: Sequence[str]) -> Column:
    """Whether the MD5 of the keys, a text of evenly spread hex digits, lies in the first
    ``percent`` of its range. Any engine can repeat this."""
    if not 0 < percent < 100:
        raise ValueError(f"percent must lie between 0 and 100, not {percent}")
    bound = f"{(percent << 32) // 100:08x}"
    text = F.concat_ws("|", *(F.col(k).cast("string") for k in keys))
    return F.md5(text) < bound


def with_split(df: DataFrame, keys: Sequence[str], train_percent: int = 80) -> DataFrame:
    """Mark each row as ``train`` or ``test`` by its keys: no shuffle, no sort."""
    is_train = _in_first(train_percent, keys)
    return df.withColumn("split", F.when(is_train, "train").otherwise("test"))


def hash_split(
    df: DataFrame, keys: Sequence[str], train_percent: int = 80
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; the same keys always fall on the same side."""
    is_train = _in_first(train_percent, keys)
    return df.filter(is_train), df.filter(~is_train)


def column_roles(df: DataFrame, label: str = "price") -> tuple[list[str], list[str]]:
    """Categorical columns (text) and numeric ones (double, except the label)."""
    categorical = [name for name, kind in df.dtypes if kind == "string"]
    numeric = [name for name, kind in df.dtypes if kind == "double" and name != label]
    return categorical, numeric


def indexer(categorical: Sequence[str]) -> StringIndexer:
    """Index by falling frequency, then label; rows with unseen labels are skipped."""
    return StringIndexer(
        inputCols=list(categorical),
        outputCols=[f"{name}Index" for name in categorical],
        handleInvalid="skip",
    )


def label_index(df: DataFrame, column: str) -> DataFrame:
    """``column`` and its ``index`` by falling frequency, then label, for any number of
    labels: a distributed sort whose parts are numbered on from each other."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).count()
    ordered = counts.orderBy(F.desc("count"), column).withColumn("_at", F.monotonically_increasing_id())
    ordered = settle(ordered.select(column, "_at"), "labels")
    part = F.shiftright("_at", 33)
    parts = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each part of the sort.
    starts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    numbered = ordered.join(starts, part == F.col("_part"))
    return numbered.select(column, (F.col("_before") + F.col("_at") - F.col("_first")).cast("double").alias("index"))


def with_label_index(df: DataFrame, column: str) -> DataFrame:
    """Add ``<column>Index`` by a join with :func:`label_index`; rows without a label are
    skipped, as by :func:`indexer`."""
    index = label_index(df, column).withColumnRenamed("index", f"{column}Index")
    return df.join(index, column)


def one_hot(categorical: Sequence[str]) -> OneHotEncoder:
    return OneHotEncoder(
        inputCols=[f"{name}Index" for name in categorical],
        outputCols=[f"{name}OHE" for name in categorical],
    )


def assembler(inputs: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(inputs), outputCol="features")


def regression(label: str = "price") -> LinearRegression:
    return LinearRegression(featuresCol="features", labelCol=label)


def single_feature_pipeline(feature: str = "bedrooms", label: str = "price") -> Pipeline:
    return Pipeline(stages=[assembler([feature]), regression(label)])


def full_pipeline(
    df: DataFrame, label: str = "price", categorical: Sequence[str] | None = None
) -> Pipeline:
    """Index, one-hot encode, assemble and regress. Without a list of categorical columns
    all text columns are; each of their labels becomes an entry on the driver and a slot
    of the vector, so name the columns where a text column has very many."""
    texts, numeric = column_roles(df, label)
    categorical = texts if categorical is None else list(categorical)
    inputs = [*(f"{name}OHE" for name in categorical), *numeric]
    return Pipeline(
        stages=[indexer(categorical), one_hot(categorical), assembler(inputs), regression(label)]
    )


def formula_pipeline(label: str = "price") -> Pipeline:
    """The same model declared as a formula over all other columns."""
    formula = RFormula(
        formula=f"{label} ~ .", featuresCol="features", labelCol=label, handleInvalid="skip"
    )
    return Pipeline(stages=[formula, regression(label)])


def line_formula(model: LinearRegressionModel, feature: str = "bedrooms", label: str = "price") -> str:
    """The fitted line as text, both numbers rounded to two places."""
    slope, intercept = round(model.coefficients[0], 2), round(model.intercept, 2)
    return f"{label} = {slope}*{feature} + {intercept}"


def fitted_line(df: DataFrame, feature: str, label: str) -> DataFrame:
    """Slope and intercept of the one-feature regression as a plain aggregation."""
    return df.select(
        F.regr_slope(label, feature).alias("slope"),
        F.regr_intercept(label, feature).alias("intercept"),
    )


def features_as_array(df: DataFrame, column: str = "features") -> DataFrame:
    """The feature vector as an array column, readable outside of ``pyspark.ml``."""
    return df.withColumn(column, vector_to_array(column))
