"""Least squares with one intercept per entity, by group means.

Centring target and features on their entity's means removes the intercepts, so the slopes follow from
small normal equations over all rows; each intercept is then read off its entity's means. Exact for
any number of entities: nothing is indexed, one-hot encoded or iterated.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .ordering import broadcast_if_small, rows_that_fit


@dataclass
class EntityOls:
    """A fitted model: slopes by feature, ``effects`` (entity, n, effect), the effect of an unseen entity."""

    features: list[str]
    entity: str
    slopes: list[float]
    effects: DataFrame
    unseen: float

    def line(self) -> Column:
        total = F.lit(0.0)
        for name, slope in zip(self.features, self.slopes):
            total = total + F.col(name).cast("double") * F.lit(slope)
        return total

    def transform(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        """Add the prediction; an unseen entity gets the row-weighted mean effect, a null feature gives null."""
        known = broadcast_if_small(self.effects.select(F.col(self.entity).alias("_entity"), "effect"), rows_that_fit(2))
        joined = df.join(known, df[self.entity] == F.col("_entity"), "left")
        return joined.withColumn(prediction, F.coalesce("effect", F.lit(self.unseen)) + self.line()).drop("_entity", "effect")


def solved(gram: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Slopes of the normal equations; features without variation get 0."""
    scale = np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))
    return np.linalg.lstsq(gram / np.outer(scale, scale), right / scale, rcond=1e-12)[0] / scale


def normal_equations(sums: Sequence[float | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Gram matrix and right side from the sums of products of (feature i, feature or target j >= i)."""
    gram, right, values = np.zeros((size, size)), np.zeros(size), iter(sums)
    for i in range(size):
        for j in range(i, size + 1):
            value = next(values) or 0.0
            if j == size:
                right[i] = value
            else:
                gram[i, j] = gram[j, i] = value
    return gram, right


@dataclass
class FoldOls:
    """A model per fold, each fitted on the rows of earlier folds: ``slopes`` by fold, ``effects``
    (entity, fold, n, effect) and the effect of an unseen entity by fold."""

    features: list[str]
    entity: str
    fold: str
    slopes: dict[int, list[float]]
    effects: DataFrame
    unseen: dict[int, float]

    def table(self) -> DataFrame:
        """A row a fold: its number, ``slopes`` and ``unseen``."""
        rows = [(f, self.slopes[f], self.unseen[f]) for f in sorted(self.slopes)]
        return self.effects.sparkSession.createDataFrame(rows, f"{self.fold} int, slopes array<double>, unseen double")

    def transform(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        """Predict the rows of every fold with that fold's model; rows of other folds get null."""
        known = self.effects.select(F.col(self.entity).alias("_entity"), F.col(self.fold).alias("_fold"), "effect")
        lines = F.broadcast(self.table().select(F.col(self.fold).alias("_line"), "slopes", "unseen"))  # a row a fold
        joined = df.join(lines, df[self.fold] == F.col("_line"), "left").join(known, (df[self.entity] == F.col("_entity")) & (df[self.fold] == F.col("_fold")), "left")
        line = F.lit(0.0)
        for i, name in enumerate(self.features):
            line = line + F.col(name).cast("double") * F.col("slopes")[i]
        return joined.withColumn(prediction, F.coalesce("effect", "unseen") + line).drop("_entity", "_fold", "_line", "slopes", "unseen", "effect")


def fit_fold_ols(train: DataFrame, features: Sequence[str], entity: str, target: str, fold: str = "cv_fold") -> FoldOls:
    """The models of all folds 1, 2, ... of an expanding split from one scan of the rows.

    Every (entity, fold) leaves one block: rows, means and products of deviations from them. Blocks of
    the folds before f merge into entity f's own; so the rows are read once and no fold is refitted.
    """
    names, size = [*features, target], len(features)
    pairs = [(i, j) for i in range(size) for j in range(i, size + 1)]
    rows = train.select(entity, F.col(fold).cast("int").alias(fold), *[F.col(c).cast("double").alias(c) for c in names]).na.drop()
    blocks = rows.where(F.col(fold) >= 0).groupBy(entity, fold).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(names)],
        *[F.covar_pop(names[i], names[j]).alias(f"p{i}_{j}") for i, j in pairs])
    blocks = checkpointed(blocks)
    folds = sorted(r[0] for r in blocks.select(fold).distinct().collect() if r[0] > 0)
    # Means are taken from the entity's own middle, so that their products lose no digits.
    middles = blocks.groupBy(entity).agg(*[F.avg(f"m{i}").alias(f"a{i}") for i in range(size + 1)])
    later = F.filter(F.array(*[F.lit(f) for f in folds]), lambda f: f > F.col(fold))
    spread = blocks.join(middles, entity).withColumn("_into", F.explode(later))
    off = [F.col(f"m{i}") - F.col(f"a{i}") for i in range(size + 1)]
    merged = spread.groupBy(entity, "_into").agg(
        F.sum("n").alias("n"), *[F.first(f"a{i}").alias(f"a{i}") for i in range(size + 1)],
        *[(F.sum(F.col("n") * off[i]) / F.sum("n")).alias(f"d{i}") for i in range(size + 1)],
        *[F.sum(F.col("n") * (F.col(f"p{i}_{j}") + off[i] * off[j])).alias(f"s{i}_{j}") for i, j in pairs])
    merged = checkpointed(merged)
    within = [F.sum(F.col(f"s{i}_{j}") - F.col("n") * F.col(f"d{i}") * F.col(f"d{j}")) for i, j in pairs]
    slopes = {r[0]: [float(s) for s in solved(*normal_equations(r[1:], size))] for r in merged.groupBy("_into").agg(*within).collect()}  # a row a fold
    table = F.broadcast(train.sparkSession.createDataFrame(sorted(slopes.items()), "_into int, slopes array<double>"))
    effect = F.col(f"a{size}") + F.col(f"d{size}")
    for i in range(size):
        effect = effect - (F.col(f"a{i}") + F.col(f"d{i}")) * F.col("slopes")[i]
    effects = checkpointed(merged.join(table, "_into").select(entity, F.col("_into").alias(fold), "n", effect.alias("effect")))
    unseen = {r[0]: float(r[1]) for r in effects.groupBy(fold).agg(F.sum(F.col("n") * F.col("effect")) / F.sum("n")).collect()}
    return FoldOls(list(features), entity, fold, slopes, effects, unseen)


def expanding_ols(train: DataFrame, features: Sequence[str], entity: str, target: str, baseline: str, fold: str = "cv_fold") -> DataFrame:
    """Errors by (fold, model) of the fold models and of the column ``baseline`` as a prediction."""
    from .metrics import regression_metrics

    scored = fit_fold_ols(train, features, entity, target, fold).transform(train.where(F.col(fold) > 0), "linear_regression").withColumn("naive", F.col(baseline))
    long = scored.select(fold, F.col(target).alias("actual"), "linear_regression", "naive").unpivot([fold, "actual"], ["linear_regression", "naive"], "model", "predicted")
    return regression_metrics(long, "actual", "predicted", [fold, "model"])


def fit_entity_ols(train: DataFrame, features: Sequence[str], entity: str, target: str) -> EntityOls:
    """Fit on the rows without nulls. Features that do not vary within entities get slope 0."""
    names = [*features, target]
    rows = train.select(entity, *[F.col(c).cast("double").alias(c) for c in names]).na.drop()
    means = checkpointed(rows.groupBy(entity).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"{c}__mean") for c in names]))
    centred = rows.join(broadcast_if_small(means, rows_that_fit(len(names) + 2)), entity).select(*[(F.col(c) - F.col(f"{c}__mean")).alias(c) for c in names])
    size = len(features)
    sums = centred.agg(*[F.sum(F.col(names[i]) * F.col(names[j])) for i in range(size) for j in range(i, size + 1)]).first()
    slopes = solved(*normal_equations(sums, size))
    effect = F.col(f"{target}__mean")
    for name, slope in zip(features, slopes):
        effect = effect - F.col(f"{name}__mean") * F.lit(float(slope))
    effects = means.select(entity, "n", effect.alias("effect"))
    unseen = effects.agg(F.sum(F.col("n") * F.col("effect")) / F.sum("n")).first()[0]
    return EntityOls(list(features), entity, [float(s) for s in slopes], effects, float(unseen or 0.0))
