"""Price model of housing listings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.features import (
    formula_pipeline,
    full_pipeline,
    hash_split,
    line_formula,
    random_split,
    single_feature_pipeline,
    with_split,
)
from tickloom.schemas import LISTING
from tickloom.workspace import settle


@dataclass(frozen=True)
class FittedModel:
    model: PipelineModel
    predictions: DataFrame


def split_listings(
    listings: DataFrame, keys: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """80/20 split: by keys if there are any, else at random with a fixed seed."""
    return hash_split(listings, keys) if keys else random_split(listings)


def settled_split(
    listings: DataFrame, keys: list[str], columns: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """The split by keys, of the keys and the columns a model reads, written once.

    Fitting passes over its rows several times; it should neither read all columns nor
    work out the split of every row each time.
    """
    wanted = list(dict.fromkeys([*keys, *(columns or LISTING.fieldNames())]))
    marked = settle(with_split(listings, keys).select(*wanted, "split"), "listings")
    return tuple(marked.filter(F.col("split") == part).drop("split") for part in ("train", "test"))


def fit_line(
    train: DataFrame, test: DataFrame, feature: str = "bedrooms", label: str = "price"
) -> tuple[FittedModel, str]:
    """The one-feature model with its formula as text."""
    model = single_feature_pipeline(feature, label).fit(train.select(feature, label))
    return FittedModel(model, model.transform(test)), line_formula(model.stages[-1], feature, label)


def fit_full(
    train: DataFrame,
    test: DataFrame,
    label: str = "price",
    categorical: list[str] | None = None,
) -> FittedModel:
    """The model on all text and double columns, or on the text columns given."""
    model = full_pipeline(train, label, categorical).fit(train)
    return FittedModel(model, model.transform(test))


def fit_formula(train: DataFrame, test: DataFrame, label: str = "price") -> FittedModel:
    model = formula_pipeline(label).fit(train)
    return FittedModel(model, model.transform(test))


def price_models(listings: DataFrame, keys: list[str] | None = None) -> dict[str, FittedModel]:
    """Fit on the train part and predict the test part, with one and with all features.

    With keys, both models read the same rows, written once, and predictions keep the keys.
    """
    wanted = list(LISTING.fieldNames())
    if keys:
        train, test = settled_split(listings, keys)
    else:
        train, test = (part.select(*wanted) for part in split_listings(listings))
    line, _ = fit_line(train, test)
    return {"line": line, "full": fit_full(train.select(*wanted), test)}
