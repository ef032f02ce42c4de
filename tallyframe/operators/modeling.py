"""Preprocessing pipelines, classifiers, regressors, cross-validation and result tables.

Every step is a persistable ML stage; statistics are read from the training rows only.
"""

from __future__ import annotations

import math
import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpointed, held_for_training
from .entity_ols import EntityOls, fit_entity_ols
from .metrics import regression_metrics, summary_metrics
from .prepare import MedianImputer, ModeImputer, ZScaler
from .splits import feature_columns, stratified_split
from .subtree_forest import fit_subtree_forest

# Model settings of the two studies.
CLASSIFIER_TREES, CLASSIFIER_MIN_LEAF, CLASSIFIER_MAX_ITER = 250, 2, 2_000
REGRESSOR_TREES, REGRESSOR_CV_TREES, REGRESSOR_DEPTH, REGRESSOR_MIN_LEAF, REGRESSOR_FEATURE_SHARE = 80, 25, 18, 5, 0.8
SEED = 42
HISTOGRAM_ROWS = 20_000  # training rows up to which every node of a forest is split by the histograms of Spark ML


def split_columns(df: DataFrame, features: Sequence[str]) -> tuple[list[str], list[str]]:
    """Numeric and categorical features by schema type."""
    numeric = [c for c in features if isinstance(df.schema[c].dataType, T.NumericType)]
    return numeric, [c for c in features if c not in numeric]


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fit_preprocessor(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], encode: str = "onehot", scale: bool = True) -> PipelineModel:
    """Median / most-frequent imputation, population z-score, one-hot or ordinal codes, assembly.

    One-hot: a category unseen in training has all slots 0. Ordinal: sorted codes, unseen -1.
    """
    medians = MedianImputer(numeric).fit(train).values if numeric else {}
    tops = ModeImputer(categorical).fit(train).values if categorical else {}
    filled = train.select(*[F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c, 0.0))).alias(c) for c in numeric])
    stats = ZScaler(numeric).fit(filled).stats if scale and numeric else {}
    pieces = ["*"]
    for c in numeric:
        value = f"coalesce(cast(`{c}` as double), cast({medians.get(c, 0.0)!r} as double))"
        mean, std = stats.get(c, (0.0, 1.0))
        pieces.append(f"({value} - cast({float(mean)!r} as double)) / cast({float(std or 1.0)!r} as double) as `{c}__num`")
    for c in categorical:
        pieces.append(f"coalesce(cast(`{c}` as string), {_quote(str(tops.get(c)))}) as `{c}__cat`")
    stages = [SQLTransformer(statement=f"SELECT {', '.join(pieces)} FROM __THIS__")]
    inputs = [f"{c}__num" for c in numeric]
    if categorical:
        cats, codes = [f"{c}__cat" for c in categorical], [f"{c}__code" for c in categorical]
        stages.append(StringIndexer(inputCols=cats, outputCols=codes, handleInvalid="keep", stringOrderType="alphabetAsc"))
        if encode == "onehot":
            slots = [f"{c}__hot" for c in categorical]
            stages.append(OneHotEncoder(inputCols=codes, outputCols=slots, dropLast=True))
            inputs += slots
        else:
            inputs += [f"{c}__ord" for c in categorical]
    first = Pipeline(stages=stages).fit(train)
    rest = []
    if categorical and encode != "onehot":
        unseen = [len(labels) for labels in first.stages[1].labelsArray]
        recoded = [f"CASE WHEN `{c}__code` = {n} THEN -1.0D ELSE `{c}__code` END AS `{c}__ord`" for c, n in zip(categorical, unseen)]
        rest.append(SQLTransformer(statement=f"SELECT *, {', '.join(recoded)} FROM __THIS__"))
    rest.append(VectorAssembler(inputCols=inputs, outputCol="features_vector", handleInvalid="keep"))
    return PipelineModel(stages=[*first.stages, *rest])


def slot_names(df: DataFrame, vector: str = "features_vector") -> list[str]:
    """Names of the vector's slots from its ML attributes."""
    attrs = df.schema[vector].metadata.get("ml_attr", {}).get("attrs", {})
    return [a["name"] for a in sorted((a for group in attrs.values() for a in group), key=lambda a: a["idx"])]


def feature_importances(model, df: DataFrame) -> DataFrame:
    weights = model.featureImportances.toArray()
    names = slot_names(df) or [f"slot_{i}" for i in range(len(weights))]
    rows = [(n, float(w)) for n, w in zip(names, weights)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def balanced_weights(df: DataFrame, label: str, weight: str = "class_weight") -> DataFrame:
    """Row weight n / (classes * class size)."""
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    total, classes = sum(sizes.values()), len(sizes)
    cases = reduce(lambda w, item: w.when(F.col(label) == F.lit(item[0]), F.lit(total / (classes * item[1]))), sizes.items(), F)
    return df.withColumn(weight, cases)


def logistic(rows: int, max_iter: int = CLASSIFIER_MAX_ITER, c: float = 1.0) -> LogisticRegression:
    """Balanced L2 logistic regression; balanced weights sum to the row count, so C maps to 1 / (C * rows)."""
    return LogisticRegression(featuresCol="features_vector", labelCol="label", weightCol="class_weight", maxIter=max_iter,
                              regParam=1.0 / (c * rows), elasticNetParam=0.0, standardization=False)


def forest_classifier(trees: int = CLASSIFIER_TREES, depth: int = 20, min_leaf: int = CLASSIFIER_MIN_LEAF, max_bins: int = 64) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol="features_vector", labelCol="label", weightCol="class_weight", numTrees=trees,
                                  maxDepth=depth, minInstancesPerNode=min_leaf, maxBins=max_bins, seed=SEED)


def linear_model() -> LinearRegression:
    return LinearRegression(featuresCol="features_vector", labelCol="label", regParam=0.0)


def forest_regressor(trees: int = REGRESSOR_TREES, depth: int = REGRESSOR_DEPTH, max_bins: int = 64) -> RandomForestRegressor:
    return RandomForestRegressor(featuresCol="features_vector", labelCol="label", numTrees=trees, maxDepth=depth,
                                 minInstancesPerNode=REGRESSOR_MIN_LEAF, featureSubsetStrategy=str(REGRESSOR_FEATURE_SHARE), maxBins=max_bins, seed=SEED)


def classification_experiments(df: DataFrame, targets: Mapping[str, object], key: Sequence[str], exclusions: Mapping[str, Sequence[str]] = {},
                               keep_leaky: bool = False, trees: int = CLASSIFIER_TREES, depth: int = 20, max_iter: int = CLASSIFIER_MAX_ITER) -> tuple[DataFrame, DataFrame]:
    """Every target with both classifiers: metrics per split, and all predictions.

    One fit serves both splits; metrics come from one aggregate over the stacked predictions.
    """
    spark, parts = df.sparkSession, []
    for target, positive in targets.items():
        features = [c for c in feature_columns(df, target, exclusions, keep_leaky) if c not in key]
        labelled = stratified_split(df.where(F.col(target).isNotNull()), target, key).withColumn("label", (F.col(target) == F.lit(positive)).cast("double"))
        labelled = checkpointed(labelled.select(*key, "split", "label", *features))  # every statistic below reads it
        train = labelled.where(F.col("split") == "train")
        prep = fit_preprocessor(train, *split_columns(df, features))
        ready = prep.transform(labelled).select(*key, "split", "label", "features_vector")
        ready = held_for_training(ready)
        fit_rows = balanced_weights(ready.where(F.col("split") == "train"), "label")
        for name, estimator in (("logistic_regression", logistic(fit_rows.count(), max_iter)), ("random_forest", forest_classifier(trees, depth))):
            scored = estimator.fit(fit_rows).transform(ready)
            parts.append(scored.select(
                F.lit(target).alias("target"), F.lit(name).alias("model"), *key, "split",
                F.col("label").cast("int").alias("actual"), F.col("prediction").cast("int").alias("predicted"),
            ))
    predictions = reduce(DataFrame.unionByName, parts)
    return summary_metrics(predictions, [0, 1], 1, by=["target", "model", "split"]), predictions


def _timed(action):
    start = time.perf_counter()
    result = action()
    return result, time.perf_counter() - start


def regression_candidates(trees: int, depth: int, max_bins: int):
    return (("linear_regression", "onehot", True, linear_model()), ("random_forest", "ordinal", False, forest_regressor(trees, depth, max_bins)))


def fit_regressors(train: DataFrame, test: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str = "target_close_next",
                   baseline: str = "close", trees: int = REGRESSOR_TREES, depth: int = REGRESSOR_DEPTH, max_bins: int = 64,
                   models: Sequence[str] = ("linear_regression", "random_forest")) -> tuple[DataFrame, dict[str, PipelineModel | EntityOls], dict[str, tuple[float, float]]]:
    """Fit on train; the test rows with one prediction column per model, the fitted models, and (fit, predict) seconds.

    Least squares over one categorical column is fitted by its group means. A forest over more than ``HISTOGRAM_ROWS``
    rows is grown by ``subtree_forest``, whose passes do not grow in number with the nodes; its draws are other ones.
    """
    scored = test.withColumn("pred_naive", F.col(baseline))
    fitted, seconds = {}, {"naive": (0.0, 0.0)}
    for name, encode, scale, estimator in regression_candidates(trees, depth, max_bins):
        if name not in models:
            continue
        def fit():
            if name == "linear_regression" and len(categorical) == 1:
                return fit_entity_ols(train, numeric, categorical[0], target)
            prep = fit_preprocessor(train, numeric, categorical, encode, scale)
            rows = held_for_training(prep.transform(train).select("features_vector", F.col(target).cast("double").alias("label")))
            if name == "random_forest" and rows.count() > HISTOGRAM_ROWS:
                model = fit_subtree_forest(rows, trees, depth, REGRESSOR_MIN_LEAF, REGRESSOR_FEATURE_SHARE, max_bins, SEED)
            else:
                model = estimator.fit(rows)
            return PipelineModel(stages=[*prep.stages, model])

        kept = scored.columns
        fitted[name], fit_seconds = _timed(fit)
        scored, predict_seconds = _timed(lambda: checkpointed(fitted[name].transform(scored).select(*kept, F.col("prediction").alias(f"pred_{name}"))))
        seconds[name] = (fit_seconds, predict_seconds)
    return scored, fitted, seconds


def stacked_predictions(scored: DataFrame, models: Sequence[str], actual: str = "target_close_next", keep: Sequence[str] = ()) -> DataFrame:
    """One row per (row, model)."""
    columns = [f"pred_{m}" for m in models]
    long = scored.select(*keep, F.col(actual).alias("actual"), *columns).unpivot([*keep, "actual"], columns, "model", "predicted")
    return long.withColumn("model", F.substring("model", 6, 100))


def expanding_cv(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str = "target_close_next", trees: int = REGRESSOR_CV_TREES,
                 depth: int = REGRESSOR_DEPTH, max_bins: int = 64, models: Sequence[str] = ("linear_regression", "random_forest"),
                 parallelism: int = 1) -> DataFrame:
    """Per fold: fit on earlier target dates, score the fold; metrics and timings per (fold, model).

    ``parallelism`` folds are submitted together; their timings then include waiting for each other.
    """
    cached = held_for_training(train)
    folds = sorted(r["cv_fold"] for r in cached.where("cv_fold > 0").select("cv_fold").distinct().collect())
    names = ["naive", *models]

    def one(fold: int) -> tuple[DataFrame, list[tuple]]:
        earlier, current = cached.where(F.col("cv_fold") < fold), cached.where(F.col("cv_fold") == fold)
        scored, _, seconds = fit_regressors(earlier, current, numeric, categorical, target, trees=trees, depth=depth, max_bins=max_bins, models=models)
        metrics = regression_metrics(stacked_predictions(scored, names, target), "actual", "predicted", ["model"])
        row_count = earlier.count()
        return metrics.select(F.lit(fold).alias("fold"), "*", F.lit(row_count).alias("train_rows")), [(fold, n, *seconds[n]) for n in names]

    with ThreadPoolExecutor(parallelism) as pool:
        done = list(pool.map(inheritable_thread_target(train.sparkSession)(one), folds))
    parts = [metrics for metrics, _ in done]
    timings = [row for _, rows in done for row in rows]
    clock = train.sparkSession.createDataFrame(timings, "fold int, model string, fit_seconds double, predict_seconds double")
    return reduce(DataFrame.unionByName, parts).join(F.broadcast(clock), ["fold", "model"])


# Chance of at least k draws of a row in a bootstrap of the whole table (Poisson with mean one).
DRAWS = 8
AT_LEAST = [1 - sum(math.exp(-1) / math.factorial(i) for i in range(k)) for k in range(1, DRAWS + 1)]
TREES_A_PASS = 25


def bootstrap_draws(hashed: Column, tree: int, seed: int = SEED) -> Column:
    """How often a row is drawn for one tree: reproducible from the hash of its key, whatever the partitioning."""
    u = F.pmod(F.xxhash64(hashed, F.lit(seed), F.lit(tree)), F.lit(1 << 40)) / float(1 << 40)
    return reduce(lambda a, b: a + b, [(u < p).cast("int") for p in AT_LEAST])


@dataclass
class BalancedSubsampleForest:
    """Trees of which each was grown on a bootstrap of its own, weighted by the classes of that bootstrap."""

    trees: list
    class_weights: list[dict[float, float]]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability`` (mean of the trees' class shares) and ``prediction``. A pass adds some trees."""
        total = df.withColumn("_total", F.lit(None).cast("array<double>"))
        for first in range(0, len(self.trees), TREES_A_PASS):
            for tree in self.trees[first:first + TREES_A_PASS]:
                share = vector_to_array("_p")
                scored = tree.transform(total)
                total = scored.withColumn("_total", F.when(F.col("_total").isNull(), share).otherwise(F.zip_with("_total", share, lambda a, b: a + b))).drop("_p", "_raw", "_label")
            total = checkpointed(total)
        mean = F.transform("_total", lambda v: v / len(self.trees))
        best = F.array_position("_total", F.array_max("_total")) - 1
        return total.withColumns({"probability": mean, "prediction": best.cast("double")}).drop("_total")

    def importances(self, df: DataFrame) -> DataFrame:
        """Mean importance of each slot over the trees."""
        weights = np.mean([t.featureImportances.toArray() for t in self.trees], axis=0)
        names = slot_names(df) or [f"slot_{i}" for i in range(len(weights))]
        return df.sparkSession.createDataFrame([(n, float(w)) for n, w in zip(names, weights)], "feature string, importance double").orderBy(F.desc("importance"), "feature")


def balanced_subsample_forest(df: DataFrame, key: Sequence[str], trees: int = CLASSIFIER_TREES, depth: int = 20, min_leaf: int = CLASSIFIER_MIN_LEAF,
                              max_bins: int = 64, seed: int = SEED, parallelism: int = 8) -> BalancedSubsampleForest:
    """Random forest whose class weights follow each tree's own bootstrap (``label``, ``features_vector``, ``key``).

    A row counts as often as it is drawn times rows / (classes * draws of its class) of that bootstrap.
    The class sums of all trees come from one aggregate; ``parallelism`` trees grow at the same time.
    """
    rows = held_for_training(df.select("label", "features_vector", F.xxhash64(*key).alias("hash")))
    sums = rows.groupBy("label").agg(*[F.sum(bootstrap_draws(F.col("hash"), t, seed)).alias(f"t{t}") for t in range(trees)]).collect()  # a row a class
    weights = []
    for t in range(trees):
        drawn = {r["label"]: r[f"t{t}"] for r in sums if r[f"t{t}"]}
        weights.append({c: sum(drawn.values()) / (len(drawn) * n) for c, n in drawn.items()})

    def grow(t: int):
        weight = reduce(lambda w, item: w.when(F.col("label") == F.lit(item[0]), F.lit(item[1])), weights[t].items(), F)
        own = rows.withColumn("_weight", bootstrap_draws(F.col("hash"), t, seed) * weight).where(F.col("_weight") > 0)
        return RandomForestClassifier(featuresCol="features_vector", labelCol="label", weightCol="_weight", numTrees=1, bootstrap=False, subsamplingRate=1.0, featureSubsetStrategy="sqrt",
                                      maxDepth=depth, minInstancesPerNode=min_leaf, maxBins=max_bins, seed=seed + t, probabilityCol="_p", rawPredictionCol="_raw", predictionCol="_label").fit(own)

    with ThreadPoolExecutor(parallelism) as pool:
        grown = list(pool.map(inheritable_thread_target(df.sparkSession)(grow), range(trees)))
    return BalancedSubsampleForest(grown, weights)
