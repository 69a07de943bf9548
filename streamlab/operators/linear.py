"""Online logistic classifier: scaler, gradient step, prediction, accuracy, decision grid.

A model is a handful of numbers. Rows stay on the executors: fitting the scaler, one
gradient step and one evaluation are each a single aggregation that returns one row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The two features, the regularisation strength and the text labels.
FEATURES = ("glucose", "bmi")
L2_ALPHA = 1e-3
POSITIVE_TEXT = "DIABÉTICO"
NEGATIVE_TEXT = "NÃO diabético"


@dataclass(frozen=True)
class Scaler:
    features: tuple[str, ...]
    mean: tuple[float, ...]
    std: tuple[float, ...]

    def column(self, feature: str) -> Column:
        i = self.features.index(feature)
        return (F.col(feature) - F.lit(self.mean[i])) / F.lit(self.std[i])


@dataclass(frozen=True)
class Model:
    """Weights over scaled features, with the counters of the training run."""

    scaler: Scaler
    weights: tuple[float, ...]
    bias: float = 0.0
    version: int = -1
    batches: int = 0
    seen: int = 0

    @classmethod
    def untrained(cls, scaler: Scaler) -> "Model":
        return cls(scaler, tuple(0.0 for _ in scaler.features))


def fit_scaler(df: DataFrame, features: Sequence[str] = FEATURES) -> Scaler:
    """Mean and population standard deviation; a constant feature is left unscaled."""
    row = df.agg(
        *[F.avg(f).alias(f"m_{f}") for f in features],
        *[F.stddev_pop(f).alias(f"s_{f}") for f in features],
    ).first()
    return Scaler(
        tuple(features),
        tuple(float(row[f"m_{f}"] or 0.0) for f in features),
        tuple(float(row[f"s_{f}"] or 1.0) for f in features),
    )


def apply_scaler(df: DataFrame, scaler: Scaler) -> DataFrame:
    return df.withColumns({f: scaler.column(f) for f in scaler.features})


def _margin(model: Model, scaled: bool) -> Column:
    terms = [
        F.lit(w) * (F.col(f) if scaled else model.scaler.column(f))
        for f, w in zip(model.scaler.features, model.weights)
    ]
    return reduce(lambda a, b: a + b, terms, F.lit(model.bias))


def _sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def gradient_sums(df: DataFrame, model: Model, label: str = "outcome") -> DataFrame:
    """One row: the log-loss gradient summed over raw rows, per weight and for the bias."""
    error = _sigmoid(_margin(model, scaled=False)) - F.col(label)
    features = model.scaler.features
    ready = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*features, label)])
    return df.where(ready).agg(
        *[F.sum(error * model.scaler.column(f)).alias(f"g_{f}") for f in features],
        F.sum(error).alias("g_bias"),
        F.count(F.lit(1)).alias("n"),
    )


def train_step(
    df: DataFrame,
    model: Model,
    label: str = "outcome",
    rate: float = 0.5,
    alpha: float = L2_ALPHA,
    steps: int = 1,
) -> Model:
    """Move the model by ``steps`` full-batch gradient steps; no rows, no change.

    Each step is one pass over ``df``. The penalty applies to the weights, not the bias.
    """
    counted = 0
    for _ in range(steps):
        row = gradient_sums(df, model, label).first()
        counted = row["n"]
        if not counted:
            return model
        weights = tuple(
            w - rate * (row[f"g_{f}"] / counted + alpha * w)
            for f, w in zip(model.scaler.features, model.weights)
        )
        model = replace(model, weights=weights, bias=model.bias - rate * row["g_bias"] / counted)
    return replace(model, batches=model.batches + 1, seen=model.seen + counted)


def curvature_sums(df: DataFrame, model: Model, label: str = "outcome") -> DataFrame:
    """``gradient_sums`` with the second derivatives h_<f>_<g>, in the same aggregation."""
    chance = _sigmoid(_margin(model, scaled=False))
    names = [*model.scaler.features, "bias"]
    values = {f: model.scaler.column(f) for f in model.scaler.features} | {"bias": F.lit(1.0)}
    ready = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*model.scaler.features, label)])
    steep = chance * (F.lit(1.0) - chance)
    return df.where(ready).agg(
        *[F.sum((chance - F.col(label)) * values[f]).alias(f"g_{f}") for f in names],
        *[F.sum(steep * values[f] * values[g]).alias(f"h_{f}_{g}") for i, f in enumerate(names) for g in names[i:]],
        F.count(F.lit(1)).alias("n"),
    )


def newton_step(df: DataFrame, model: Model, label: str = "outcome", alpha: float = L2_ALPHA) -> Model:
    """Move the model to the minimum of the loss's second-order expansion: one pass over ``df``.

    Gradient and Hessian come from one aggregation that returns one row; the few weights are solved
    for on the driver. A few steps reach what gradient steps take hundreds of passes for. Where the
    Hessian can't be inverted (all margins saturated, no penalty) the smallest step that solves it
    is taken. No rows, no change.
    """
    row = curvature_sums(df, model, label).first()
    if not row["n"]:
        return model
    names = [*model.scaler.features, "bias"]
    h = np.array([[row[f"h_{f}_{g}"] if i <= j else row[f"h_{g}_{f}"] for j, g in enumerate(names)] for i, f in enumerate(names)]) / row["n"]
    now = np.array([*model.weights, model.bias])
    penalty = np.array([alpha] * len(model.weights) + [0.0])  # not on the bias
    gradient = np.array([row[f"g_{f}"] for f in names]) / row["n"] + penalty * now
    moved = now - np.linalg.lstsq(h + np.diag(penalty), gradient, rcond=None)[0]
    weights = tuple(float(w) for w in moved[:-1])
    return replace(model, weights=weights, bias=float(moved[-1]), batches=model.batches + 1, seen=model.seen + row["n"])


def predict(df: DataFrame, model: Model, scaled: bool = False) -> DataFrame:
    """Class (margin above 0), probability and text label as plain column expressions."""
    z = _margin(model, scaled)
    return df.withColumns(
        {
            "classe": (z > 0).cast("int"),
            "probabilidade": _sigmoid(z),
            "rotulo": F.when(z > 0, F.lit(POSITIVE_TEXT)).otherwise(F.lit(NEGATIVE_TEXT)),
        }
    )


def accuracy(df: DataFrame, label: str = "outcome", predicted: str = "classe") -> DataFrame:
    """Share of rows whose prediction equals the label."""
    return df.agg(F.avg((F.col(label) == F.col(predicted)).cast("int")).alias("acuracia"))


def class_share(df: DataFrame, label: str = "outcome") -> DataFrame:
    """Share of positive rows among 0/1 labels."""
    return df.agg(F.avg(label).alias("proporcao"))


def feature_range(
    df: DataFrame, features: Sequence[str] = FEATURES, margin: float = 1.0
) -> DataFrame:
    """One row: extent of each feature widened by ``margin`` on both ends."""
    return df.agg(
        *[(F.min(f) - F.lit(margin)).alias(f"min_{f}") for f in features],
        *[(F.max(f) + F.lit(margin)).alias(f"max_{f}") for f in features],
    )


def decision_grid(test_set: DataFrame, model: Model, n: int = 200) -> DataFrame:
    """Predictions on an n x n grid over the scaled extent of the first two features.

    The grid has n x n rows by definition, so it is generated from one ``range`` and its
    index is split into the two axes.
    """
    fx, fy = model.scaler.features[:2]
    r = feature_range(apply_scaler(test_set, model.scaler), (fx, fy)).first()

    def axis(index: Column, f: str) -> Column:
        low, high = r[f"min_{f}"], r[f"max_{f}"]
        return F.lit(low) + index * F.lit((high - low) / max(n - 1, 1))

    spark: SparkSession = test_set.sparkSession
    cells = spark.range(n * n).select(
        (F.col("id") % n).alias("ix"), F.floor(F.col("id") / n).alias("iy")
    )
    grid = cells.withColumns({fx: axis(F.col("ix"), fx), fy: axis(F.col("iy"), fy)})
    return predict(grid, model, scaled=True)


def risk_of(model: Model, *values: float) -> tuple[int, float, str]:
    """Score one record: (class, probability, text label)."""
    z = model.bias + sum(
        w * (v - m) / s
        for w, v, m, s in zip(model.weights, values, model.scaler.mean, model.scaler.std)
    )
    small = math.exp(-abs(z))  # never overflows
    chance = 1.0 / (1.0 + small) if z >= 0 else small / (1.0 + small)
    return int(z > 0), chance, POSITIVE_TEXT if z > 0 else NEGATIVE_TEXT
