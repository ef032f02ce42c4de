"""End-to-end flows that chain the operators the way the two studies do."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cluster as cl
from ..operators import density as dn
from ..operators import modeling as md
from ..operators import panel as pn
from ..operators import splits as sp
from ..operators import validate as v
from ..session import checkpointed, held_for_training
from ..operators.describe import group_profile
from ..operators.metrics import regression_metrics
from ..operators.prepare import ZScaler
from ..operators.reduce import TruncatedSvd, feature_space_summary, pca_coordinates

FORECAST_NUMERIC = ["open", "high", "low", "close", "volume"]


def model_ready(bars: DataFrame, cutoff: str, n_splits: int = 5) -> DataFrame:
    """Next-day target, null rows dropped, time split and fold labels."""
    checked = checkpointed(v.require_columns(bars, ["Name", "date", *FORECAST_NUMERIC]))  # every audit below reads it
    targeted = pn.next_day_target(v.assert_unique(checked, ["Name", "date"]))
    kept = targeted.na.drop(subset=["Name", *FORECAST_NUMERIC, "target_close_next", "target_date"])
    return sp.label_folds(sp.time_split(kept, cutoff), n_splits)


@dataclass
class Forecast:
    metrics: DataFrame
    predictions: DataFrame
    importances: DataFrame | None
    models: dict


def forecast(ready: DataFrame, trees: int = md.REGRESSOR_TREES, depth: int = md.REGRESSOR_DEPTH, models: Sequence[str] = ("linear_regression", "random_forest")) -> Forecast:
    """Fit on the train split and score the test split against the persistence baseline."""
    ready = held_for_training(ready)
    train, test = (ready.where(F.col("split") == s) for s in ("train", "test"))
    scored, fitted, seconds = md.fit_regressors(train, test, FORECAST_NUMERIC, ["Name"], trees=trees, depth=depth, models=models)
    metrics = regression_metrics(md.stacked_predictions(scored, ["naive", *models]), "actual", "predicted", ["model"])
    clock = ready.sparkSession.createDataFrame([(m, *s) for m, s in seconds.items()], "model string, fit_seconds double, predict_seconds double")
    weights = None
    if "random_forest" in fitted:
        pipeline = fitted["random_forest"]
        weights = md.feature_importances(pipeline.stages[-1], md.PipelineModel(stages=pipeline.stages[:-1]).transform(train))
    return Forecast(metrics.join(F.broadcast(clock), "model"), scored, weights, fitted)


def best_model_series(metrics: DataFrame, predictions: DataFrame, entity: str) -> DataFrame:
    """Actual and predicted values of the lowest-error model for one entity, by target date."""
    best = metrics.orderBy("mae", "rmse").first()["model"]
    return predictions.where(F.col("Name") == entity).select(
        "target_date", F.round("target_close_next", 4).alias("actual"), F.round(f"pred_{best}", 4).alias("predicted"), F.lit(best).alias("model"),
    ).orderBy("target_date")


def standardised_sessions(bars: DataFrame) -> DataFrame:
    """Session rows with a row number as id, written with them, and the z-scored feature array."""
    sessions = pn.session_features(bars)
    scaled = ZScaler(pn.SESSION_FEATURES, suffix="_z").fit(sessions).transform(sessions)
    columns = [f"{c}_z" for c in pn.SESSION_FEATURES]
    return checkpointed(scaled.withColumn("id", F.monotonically_increasing_id()).withColumn("features", F.array(*columns)))


def session_segmentation(bars: DataFrame, k_values: Sequence[int] = cl.K_RANGE, seeds: Sequence[int] = (42, 43), max_iter: int = 55):
    """K sweep on all sessions, K by elbow and silhouette margin, labels and cluster profile."""
    sessions = standardised_sessions(bars)
    table, models = cl.kmeans_sweep(sessions, "id", k_values, seeds=seeds, max_iter=max_iter)
    chosen = cl.choose_k_by_margin(table).first()["selected_k"]
    labelled = cl.assign_nearest(sessions, cl.centres_of(models[chosen]))
    profile = group_profile(
        labelled, "cluster", ["open", "high", "low", "volume", "intraday_range_pct", "upper_shadow_pct", "lower_shadow_pct"], ["open", "volume"]
    )
    return table, labelled, profile


def session_density(bars: DataFrame, min_samples: int = 12, eps_quantile: float = 0.90) -> tuple[DataFrame, float]:
    """Density clusters of all sessions on their first two principal components; eps from the k-distances of all of them."""
    from ..operators.ordering import fitted_quantiles

    sessions = v.assert_unique(standardised_sessions(bars), ["id"])
    placed, _ = pca_coordinates(sessions, [f"{c}_z" for c in pn.SESSION_FEATURES], ["id"])
    placed = checkpointed(placed)
    # The point itself is the zeroth neighbour here, so the k-th other point is asked for.
    near = dn.kth_distances(placed, placed, min_samples + 1)
    eps = fitted_quantiles(near, ["kth_distance"], [eps_quantile])["kth_distance"][0]
    return dn.dbscan(placed, eps, min_samples, "id"), eps


# Neighbours of a core point, quantiles of the k-distances that are tried as radii.
SEARCH_MIN_SAMPLES = 20
EPS_QUANTILES = (0.40, 0.50, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90, 0.95, 0.98)


@dataclass
class DensityChoice:
    """The radii tried with their scores, the row of the chosen one, and its labels."""

    search: DataFrame
    chosen: DataFrame
    labels: DataFrame


def density_choice(df: DataFrame, key: str = "id", min_samples: int = SEARCH_MIN_SAMPLES, quantiles: Sequence[float] = EPS_QUANTILES) -> DensityChoice:
    """Radii from the quantiles of the k-distances of all rows, clusters of each, the best radius and its labels."""
    from ..operators.ordering import fitted_quantiles

    rows = checkpointed(df.select(key, "features"))
    near = checkpointed(dn.kth_distances(rows, rows, min_samples, key))
    radii = sorted(set(fitted_quantiles(near, ["kth_distance"], quantiles)["kth_distance"]))
    search, labels = dn.eps_search(rows, radii, min_samples, key, near)
    chosen = checkpointed(cl.choose_eps(search))
    return DensityChoice(cl.eps_objective(search), chosen, labels[chosen.first()["eps"]])


@dataclass
class CentroidChoice:
    """Measures of every K, the chosen one, its labels and their profile."""

    search: DataFrame
    chosen: DataFrame
    labels: DataFrame
    profile: DataFrame


def centroid_choice(df: DataFrame, key: str = "id", k_values: Sequence[int] = cl.K_RANGE, max_iter: int = 500) -> CentroidChoice:
    """K by the elbow of the sweep and the silhouettes next to it; labels of all rows and the size and spread of each cluster."""
    search, models = cl.kmeans_sweep(df, key, k_values, max_iter=max_iter)
    chosen = checkpointed(cl.choose_k_near_elbow(search))
    labels = checkpointed(cl.assign_nearest(df.select(key, "features"), cl.centres_of(models[chosen.first()["selected_k"]])))
    profile = labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("rows"), F.avg("distance_to_centroid").alias("mean_distance"), F.max("distance_to_centroid").alias("max_distance"))
    return CentroidChoice(search, chosen, labels, profile)


@dataclass
class FeatureSpace:
    rows: DataFrame
    svd: TruncatedSvd
    summary: DataFrame
    loadings: DataFrame


def feature_space(df: DataFrame, features: Sequence[str], key: str, components: int = 10, fit_on: DataFrame | None = None) -> FeatureSpace:
    """Encode, reduce and re-standardise; held-out labels never enter because only ``features`` are read."""
    numeric, categorical = md.split_columns(df, features)
    basis = df if fit_on is None else fit_on
    prep = md.fit_preprocessor(basis, numeric, categorical)
    encoded_fit = prep.transform(basis)
    names = md.slot_names(encoded_fit)
    encoded = checkpointed(encoded_fit.select("features_vector"))
    svd = TruncatedSvd(components, "features_vector").fit(encoded)
    rows = svd.transform(prep.transform(df)).select(key, "features")
    return FeatureSpace(rows, svd, feature_space_summary(df, numeric, categorical, len(names), svd), svd.loadings(df, names))


def stability(df: DataFrame, features: Sequence[str], key: str, k: int = 5, eps: float = 1.1088466854779546, min_samples: int = 20,
              components: int = 10, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Fit K-means, the divisive hierarchy and density clusters on 80 % and label both splits; quality table and assignments."""
    split = checkpointed(sp.hash_split(df.select(key, *features), [key], seed=seed))  # every statistic below reads it
    train = split.where(F.col("split") == "train")
    space = feature_space(split, features, key, components, fit_on=train)
    rows = checkpointed(space.rows.join(split.select(key, "split"), key))
    fit_rows, test_rows = rows.where(F.col("split") == "train"), rows.where(F.col("split") == "test")
    labelled = cl.predict(cl.fit_kmeans(fit_rows, k), rows, cluster="kmeans")
    labelled = cl.predict(cl.divisive_hierarchy(fit_rows, k), labelled, cluster="hierarchy")
    dense = checkpointed(dn.dbscan(fit_rows, eps, min_samples, key))  # read for the core rows and for the labels
    core = fit_rows.join(dense.where("is_core"), key).select(key, "features", "cluster")
    out = dn.nearest_within(test_rows, core, eps, key).select(key, "cluster")
    labels = dense.select(key, "cluster").unionByName(out).withColumnRenamed("cluster", "dbscan")
    labelled = checkpointed(labelled.join(labels, key))
    table = cl.stability_table(labelled, key, ["kmeans", "hierarchy", "dbscan"])
    return table, labelled.select(key, "split", "kmeans", "hierarchy", "dbscan")


def classification_study(df: DataFrame, targets: Mapping[str, object], key: Sequence[str], exclusions: Mapping[str, Sequence[str]], **settings):
    """Experiment grid with generalisation gaps."""
    from ..operators.metrics import generalisation_gap

    table, predictions = md.classification_experiments(df, targets, key, exclusions, **settings)
    gaps = generalisation_gap(table, ["accuracy", "precision_positive", "recall_positive", "f1_positive", "f1_macro"], ["target", "model"])
    return table, gaps, predictions
