"""Least squares from sums: one pass, mergeable, and no row is read twice.

A linear model with categories and numbers needs no rows to be fitted, only sums: for each
combination of labels how many rows there are, and the sums of the numbers and of their
products. Tasks add them up before the shuffle. Sums of several parts are added, so a day's
rows join a model without the rows of the days before.

A category with very many labels is not worth a column for each. Its labels are absorbed:
all numbers are taken relative to the mean of their label, which leaves the slopes of the
numbers as they are, and each label's own share follows from its means. The driver sees the
numbers' sums alone; the labels' shares are a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.workspace import settle

# Combinations of labels that a model may have; they come to the driver.
MOST_COMBINATIONS = 100_000


def _number(name: str) -> Column:
    return F.col(name).cast("double")


def _products(names: Sequence[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(names) for b in names[i:]]


def _sums(names: Sequence[str]) -> list[Column]:
    sums = [F.sum(_number(name)).alias(f"sum({name})") for name in names]
    return sums + [F.sum(_number(a) * _number(b)).alias(f"sum({a}*{b})") for a, b in _products(names)]


def _usable(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str]) -> DataFrame:
    """Rows that know every column, the only ones a fit looks at."""
    conditions = [F.col(c).isNotNull() for c in categorical] + [F.col(n).isNotNull() & ~F.isnan(_number(n)) for n in numeric]
    return df.filter(reduce(Column.__and__, conditions, F.lit(True)))


def moments(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], label: str) -> DataFrame:
    """One row for each combination of labels: ``n`` and the sums of numbers and products."""
    names = [*numeric, label]
    rows = _usable(df, categorical, names)
    return rows.groupBy(*categorical).agg(F.count(F.lit(1)).alias("n"), *_sums(names))


def merged(parts: Sequence[DataFrame], categorical: Sequence[str]) -> DataFrame:
    """The moments of all rows from the moments of parts of them."""
    both = reduce(DataFrame.unionByName, parts)
    rest = [name for name in both.columns if name not in categorical]
    return both.groupBy(*categorical).agg(*(F.sum(f"`{name}`").alias(name) for name in rest))


@dataclass(frozen=True)
class LinearModel:
    """``intercept``, a slope for each number, a share for each label of each category."""

    intercept: float
    slopes: dict[str, float]
    shares: dict[str, dict[str, float]] = field(default_factory=dict)

    def predict(self, df: DataFrame, result: str = "prediction") -> DataFrame:
        """Add the prediction; rows with a label the model has not seen are left out."""
        total = F.lit(self.intercept)
        for name, slope in self.slopes.items():
            total = total + _number(name) * F.lit(slope)
        for name, shares in self.shares.items():
            pairs = [F.lit(x) for pair in shares.items() for x in pair]
            total = total + F.try_element_at(F.create_map(*pairs), F.col(name))
            df = df.filter(F.col(name).isin(list(shares)))
        return df.withColumn(result, total)


def solve(sums: DataFrame, categorical: Sequence[str], numeric: Sequence[str], label: str) -> LinearModel:
    """The least-squares model of some moments.

    Labels of a category add up to the intercept, so the system has many solutions; all give
    the same predictions, and the shortest is taken.
    """
    names = [*numeric, label]
    rows = sums.limit(MOST_COMBINATIONS + 1).collect()
    if len(rows) > MOST_COMBINATIONS:
        raise ValueError(f"more than {MOST_COMBINATIONS} combinations of labels; absorb the largest category")
    if not rows:
        raise ValueError("no rows to fit a model on")
    labels = [(c, value) for c in categorical for value in sorted({row[c] for row in rows})]
    slots = {slot: i for i, slot in enumerate([None, *labels, *numeric])}
    size = len(slots)
    gram, target = np.zeros((size, size)), np.zeros(size)
    for row in rows:
        own = [slots[None], *(slots[c, row[c]] for c in categorical)]
        gram[np.ix_(own, own)] += row["n"]
        target[own] += row[f"sum({label})"]
        for name in numeric:
            gram[own, slots[name]] += row[f"sum({name})"]
            gram[slots[name], own] += row[f"sum({name})"]
        for a, b in _products(names):
            value = row[f"sum({a}*{b})"]
            if b == label:
                if a != label:
                    target[slots[a]] += value
                continue
            gram[slots[a], slots[b]] += value
            if a != b:
                gram[slots[b], slots[a]] += value
    found = _least_squares(gram, target)
    shares = {c: {value: float(found[slots[c, value]]) for k, value in labels if k == c} for c in categorical}
    return LinearModel(float(found[0]), {name: float(found[slots[name]]) for name in numeric}, shares)


def _least_squares(gram: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The shortest solution; columns are brought to one scale first."""
    scale = 1 / np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))
    found, *_ = np.linalg.lstsq(gram * np.outer(scale, scale), target * scale, rcond=1e-11)
    return found * scale


def fit_by_moments(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str], label: str) -> LinearModel:
    return solve(moments(df, categorical, numeric, label), categorical, numeric, label)


def store_moments(sums: DataFrame, path: str, part: str) -> None:
    """Store the moments of a part, a day for instance; the same part replaces itself."""
    sums.write.mode("overwrite").parquet(f"{path}/part={part}")


def stored_moments(spark, path: str, categorical: Sequence[str]) -> DataFrame:
    """The moments of all parts stored."""
    return merged([spark.read.parquet(path).drop("part")], categorical)


# ------------------------------------------------------------------------- many labels


@dataclass(frozen=True)
class AbsorbedModel:
    """Slopes of the numbers, and a table of the labels' shares: ``absorbed``, ``share``."""

    absorbed: str
    slopes: dict[str, float]
    shares: DataFrame

    def predict(self, df: DataFrame, result: str = "prediction") -> DataFrame:
        """Add the prediction; rows with a label the model has not seen are left out."""
        joined = df.join(self.shares, self.absorbed)
        total = F.col("share")
        for name, slope in self.slopes.items():
            total = total + _number(name) * F.lit(slope)
        return joined.withColumn(result, total).drop("share")


def label_sums(df: DataFrame, absorbed: str, numeric: Sequence[str], label: str) -> DataFrame:
    """``n`` and the sums of each number and product for each label; mergeable as well."""
    names = [*numeric, label]
    rows = _usable(df, [absorbed], names)
    return rows.groupBy(absorbed).agg(F.count(F.lit(1)).alias("n"), *_sums(names))


def absorb(sums: DataFrame, absorbed: str, numeric: Sequence[str], label: str) -> AbsorbedModel:
    """The least-squares model with a share for each label of ``absorbed``, from
    :func:`label_sums`: predictions equal those of a column for each label."""
    names = [*numeric, label]
    sums = settle(sums, "label-sums")
    within = [
        (F.sum(f"`sum({a}*{b})`") - F.sum(F.col(f"`sum({a})`") * F.col(f"`sum({b})`") / F.col("n"))).alias(f"{i}")
        for i, (a, b) in enumerate(_products(names))
    ]
    row = sums.agg(*within).first()
    if row[0] is None:
        raise ValueError("no rows to fit a model on")
    gram, target = np.zeros((len(numeric),) * 2), np.zeros(len(numeric))
    for i, (a, b) in enumerate(_products(names)):
        if b != label:
            x, y = names.index(a), names.index(b)
            gram[x, y] = gram[y, x] = row[i]
        elif a != label:
            target[names.index(a)] = row[i]
    slopes = dict(zip(numeric, _least_squares(gram, target).tolist()))
    share = F.col(f"`sum({label})`")
    for name, slope in slopes.items():
        share = share - F.col(f"`sum({name})`") * F.lit(slope)
    return AbsorbedModel(absorbed, slopes, sums.select(absorbed, (share / F.col("n")).alias("share")))


def sparse_features(
    df: DataFrame, index: DataFrame, category: str, numeric: Sequence[str], first_slot: int = 0
) -> DataFrame:
    """Add ``slots`` and ``values``: a row's features other than 0, as numbers of their slots
    and values. The label's slot comes from a join with ``index`` (``category``, ``index``,
    see :func:`tickloom.operators.features.label_index`), for any number of labels; the
    numbers have the first slots, then come the labels. Rows without a label are left out."""
    joined = df.join(index.withColumnRenamed("index", "_slot"), category)
    pairs = [F.struct(F.lit(first_slot + i).cast("bigint").alias("s"), _number(name).alias("v")) for i, name in enumerate(numeric)]
    own = F.struct((F.col("_slot").cast("bigint") + first_slot + len(numeric)).alias("s"), F.lit(1.0).alias("v"))
    kept = F.filter(F.array(*pairs, own), lambda x: x["v"] != 0)
    return joined.withColumns(
        {"slots": F.transform(kept, lambda x: x["s"]), "values": F.transform(kept, lambda x: x["v"])}
    ).drop("_slot")
