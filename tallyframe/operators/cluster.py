"""Centroid clustering, its quality measures and the rules that choose K.

Rows carry a key and ``features``, an array of doubles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed, held_for_training
from .ordering import broadcast_if_small, rows_that_fit

# Sweep range, silhouette margin of the session rule, density-search scoring.
K_RANGE = range(2, 11)
SILHOUETTE_MARGIN = 0.03
MAX_CLUSTERS, MIN_NOISE_PERCENT, MAX_NOISE_PERCENT = 20, 1.0, 40.0
NOISE_TARGET, NOISE_WEIGHT, CLUSTER_TARGET, CLUSTER_WEIGHT = 10.0, 0.004, 10, 0.005
INVALID_OBJECTIVE = -999.0
DRAWN_VALUES = 16 << 20  # numbers of drawn members that travel to the rows
NOISE = -1


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, term: total + term)


def _centre_literal(centre: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in centre])


def _nearest_centre(features: Column, centres: Sequence[Sequence[float]]) -> Column:
    """Squared distance ``d`` and number ``c`` of the nearest centre."""
    return F.array_min(F.array(*[F.struct(squared_distance(features, _centre_literal(c)).alias("d"), F.lit(i).alias("c")) for i, c in enumerate(centres)]))


def assign_nearest(df: DataFrame, centres: Sequence[Sequence[float]], features: str = "features", cluster: str = "cluster") -> DataFrame:
    """Index of the nearest centre (the first on ties) and the distance to it."""
    placed = df.withColumn("nearest", _nearest_centre(F.col(features), centres))
    return placed.withColumns({cluster: F.col("nearest.c"), "distance_to_centroid": F.sqrt("nearest.d")}).drop("nearest")


def group_centroids(df: DataFrame, cluster: str = "cluster", features: str = "features") -> DataFrame:
    """Size and mean point of every cluster, combined on the map side."""
    mean = vector_to_array(Summarizer.mean(array_to_vector(F.col(features))))
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"), mean.alias("centroid"))


def _dimensions(df: DataFrame, features: str = "features") -> int:
    row = df.select(F.size(features).alias("n")).first()
    return row["n"] if row else 1


def _with_centroids(df: DataFrame, cluster: str, features: str) -> DataFrame:
    joined = df.join(broadcast_if_small(group_centroids(df, cluster, features), rows_that_fit(_dimensions(df, features) + 2)), cluster)
    return joined.withColumn("sq", squared_distance(F.col(features), F.col("centroid")))


def inertia(df: DataFrame, cluster: str = "cluster", features: str = "features") -> DataFrame:
    """Sum of squared distances to the own cluster's mean."""
    return _with_centroids(df, cluster, features).agg(F.sum("sq").alias("inertia"))


def calinski_harabasz(df: DataFrame, cluster: str = "cluster", features: str = "features") -> DataFrame:
    within = _with_centroids(df, cluster, features).agg(F.sum("sq")).scalar()
    overall = df.agg(vector_to_array(Summarizer.mean(array_to_vector(F.col(features))))).scalar()
    placed = group_centroids(df, cluster, features).withColumn("overall", overall)
    spread = placed.withColumn("away", F.col("size") * squared_distance(F.col("centroid"), F.col("overall")))
    figures = spread.agg(F.sum("away").alias("between"), F.count(F.lit(1)).alias("k"), F.sum("size").alias("n"))
    ratio = (F.col("between") / (F.col("k") - 1)) / (within / (F.col("n") - F.col("k")))
    return figures.select(ratio.alias("calinski_harabasz"))


def davies_bouldin(df: DataFrame, cluster: str = "cluster", features: str = "features", block: int = 512) -> DataFrame:
    """Mean over clusters of the worst (S_i + S_j) / d_ij; each cluster meets the others in blocks."""
    scatter = checkpointed(_with_centroids(df, cluster, features).groupBy(cluster).agg(F.first("centroid").alias("centroid"), F.avg(F.sqrt("sq")).alias("s")))
    short = scatter.select(F.col(cluster).alias("c"), "centroid", "s")
    blocks = max(1, -(-short.count() // block))
    lists = short.groupBy(F.pmod(F.xxhash64("c"), F.lit(blocks)).alias("block")).agg(F.collect_list(F.struct("c", "centroid", "s")).alias("others"))
    met = short.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).join(lists, "block")
    closeness = F.transform(
        F.filter(F.col("others"), lambda o: o["c"] != F.col("c")),
        lambda o: F.try_divide(F.col("s") + o["s"], F.sqrt(squared_distance(F.col("centroid"), o["centroid"]))),
    )
    worst = met.select("c", F.array_max(closeness).alias("worst")).groupBy("c").agg(F.max("worst").alias("worst"))
    return worst.agg(F.avg("worst").alias("davies_bouldin"))


CLUSTER_BLOCK = 512


def silhouette_points(df: DataFrame, key: str, cluster: str = "cluster", features: str = "features", block: int = CLUSTER_BLOCK) -> DataFrame:
    """Silhouette of every row on squared distances; noise is left out, singletons score 0.

    The mean squared distance from a row to a cluster is its squared distance to the cluster's mean
    plus the cluster's own mean squared spread, so one table of clusters replaces all pairs of rows
    and the cost is linear in the rows. Many clusters are compared in blocks of ``block``.
    """
    usable = df.where(F.col(cluster) != NOISE).select(F.col(key).alias("key"), F.col(cluster).alias("cluster"), F.col(features).alias("features"))
    spread = _with_centroids(usable, "cluster", "features").groupBy("cluster").agg(
        F.first("size").alias("size"), F.first("centroid").alias("centroid"), F.avg("sq").alias("spread"))
    spread = checkpointed(spread)
    found = spread.count()
    kind = usable.schema["cluster"].dataType.simpleString()
    if found < 2:
        return df.sparkSession.createDataFrame([], f"key {usable.schema['key'].dataType.simpleString()}, cluster {kind}, silhouette double")
    blocks = -(-found // block)
    lists = spread.groupBy(F.pmod(F.xxhash64("cluster"), F.lit(blocks)).alias("block")).agg(
        F.collect_list(F.struct("cluster", "size", "centroid", "spread")).alias("clusters"))
    if found <= rows_that_fit(_dimensions(usable) + 3):
        lists = F.broadcast(lists)
    rows = usable.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))).join(lists, "block")
    away = F.transform("clusters", lambda c: F.struct(
        (c["cluster"] == F.col("cluster")).alias("own"), c["size"].alias("size"), (squared_distance(F.col("features"), c["centroid"]) + c["spread"]).alias("d")))
    rows = rows.select("key", "cluster", away.alias("away")).select(
        "key", "cluster", F.get(F.filter("away", lambda a: a["own"]), F.lit(0)).alias("own"),
        F.array_min(F.transform(F.filter("away", lambda a: ~a["own"]), lambda a: a["d"])).alias("outside"))
    if blocks > 1:
        rows = rows.groupBy("key", "cluster").agg(F.max("own").alias("own"), F.min("outside").alias("outside"))
    inside = F.col("own.d") * F.col("own.size") / F.greatest(F.col("own.size") - 1, F.lit(1))
    widest = F.greatest(inside, F.col("outside"))
    score = F.when(F.col("own.size") == 1, F.lit(0.0)).when(widest > 0, (F.col("outside") - inside) / widest).otherwise(F.lit(0.0))
    return rows.select("key", "cluster", score.alias("silhouette"))


def silhouette(df: DataFrame, key: str, cluster: str = "cluster", features: str = "features") -> DataFrame:
    """Mean silhouette of all rows; null with fewer than two clusters."""
    return silhouette_points(df, key, cluster, features).agg(F.avg("silhouette").alias("silhouette"))


def fit_kmeans(df: DataFrame, k: int, features: str = "features", seeds: Sequence[int] = (42, 43), max_iter: int = 100):
    """Best of several seeded fits by training cost."""
    vectors = held_for_training(df.select(array_to_vector(F.col(features)).alias("vector")))
    fits = [KMeans(k=k, seed=s, maxIter=max_iter, featuresCol="vector", predictionCol="cluster").fit(vectors) for s in seeds]
    return min(fits, key=lambda m: m.summary.trainingCost)


def centres_of(model) -> list[list[float]]:
    return [list(map(float, c)) for c in model.clusterCenters()]


def predict(model, df: DataFrame, features: str = "features", cluster: str = "cluster") -> DataFrame:
    """Labels of a fitted centroid model as a long column."""
    labelled = model.transform(df.withColumn("vector", array_to_vector(F.col(features))))
    return labelled.withColumnRenamed("cluster", "model_cluster").withColumn(cluster, F.col("model_cluster").cast("long")).drop("vector", "model_cluster")


def kmeans_sweep(df: DataFrame, key: str, k_values: Sequence[int] = K_RANGE, features: str = "features",
                 seeds: Sequence[int] = (42, 43), max_iter: int = 100, error: float | None = None):
    """Fit every K with every seed on all rows in shared passes; the table of measures of the best fit of each K, and those fits by K.

    Silhouettes use plain distances; ``error`` bounds how far mean distances may be off (see ``silhouette``).
    """
    from .kmeans_sweep import blocks_of, drawn_scores, fit_all, measure_all
    from .silhouette import ERROR, draws, silhouettes

    rows = held_for_training(df.select(F.col(key).alias("id"), F.xxhash64(key).alias("hash"), F.col(features).cast("array<double>").alias("features")))
    best, blocks = {}, blocks_of(rows)
    for model in fit_all(rows, [(k, s) for k in k_values for s in seeds], max_iter, blocks=blocks):
        if model.k not in best or model.cost < best[model.k].cost:
            best[model.k] = model
    models = [best[k] for k in k_values]
    measure_all(rows, models, blocks)
    error = ERROR if error is None else error
    if draws(error) * sum(len(m.centres) for m in models) * len(models[0].centres[0]) <= DRAWN_VALUES:
        once = rows.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
        asked = None if once else blocks_of(rows.dropDuplicates(["id", "features"]))  # a repeated row is one row of the mean
        scores = {m.k: found for m, found in zip(models, drawn_scores(blocks, models, draws(error), asked))}
    else:
        placed = rows.select("id", "features", F.inline(F.array(*[
            F.struct(F.lit(m.k).alias("part"), _nearest_centre(F.col("features"), m.centres)["c"].cast("long").alias("cluster")) for m in models])))
        scores = {r["part"]: r["silhouette"] for r in silhouettes(placed, error).groupBy("part").agg(F.avg("silhouette").alias("silhouette")).collect()}
    table = [(m.k, float(m.cost), scores.get(m.k), m.figures["calinski_harabasz"], m.figures["davies_bouldin"]) for m in models]
    return df.sparkSession.createDataFrame(table, "k int, inertia double, silhouette double, calinski_harabasz double, davies_bouldin double"), best


def elbow(table: DataFrame, normalize: bool = False) -> DataFrame:
    """K farthest from the chord between the first and last point of the inertia curve.

    The table has one row per tried K. ``normalize`` rescales both axes to [0, 1] first.
    """
    ends = table.agg(
        F.min_by("inertia", "k").alias("y0"), F.max_by("inertia", "k").alias("y1"), F.min("k").alias("x0"), F.max("k").alias("x1"),
        F.min("inertia").alias("lo"), F.max("inertia").alias("hi"),
    )
    x0, x1, y0, y1, lo, hi = (ends.select(c).scalar() for c in ("x0", "x1", "y0", "y1", "lo", "hi"))
    if normalize:
        def sx(v: Column) -> Column:
            return F.try_divide(v - x0, x1 - x0)

        def sy(v: Column) -> Column:
            return F.try_divide(v - lo, hi - lo)
    else:
        def sx(v: Column) -> Column:
            return v.cast("double")

        sy = sx
    dx, dy = sx(x1) - sx(x0), sy(y1) - sy(y0)
    away = F.abs(dx * (sy(F.col("inertia")) - sy(y0)) - dy * (sx(F.col("k")) - sx(x0))) / F.sqrt(dx * dx + dy * dy)
    scored = table.select("k", F.coalesce(away, F.lit(0.0)).alias("distance_to_chord"))
    return scored.orderBy(F.desc("distance_to_chord"), "k").limit(1).select(F.col("k").alias("elbow_k"), "distance_to_chord")


def choose_k_near_elbow(table: DataFrame) -> DataFrame:
    """Best silhouette, then lowest Davies-Bouldin, among the elbow and its neighbours."""
    elbow_k = elbow(table).select("elbow_k").scalar()
    near = table.withColumn("elbow_k", elbow_k).where(F.abs(F.col("k") - F.col("elbow_k")) <= 1)
    return near.orderBy(F.desc("silhouette"), "davies_bouldin", "k").limit(1).select("elbow_k", F.col("k").alias("selected_k"))


def choose_k_by_margin(table: DataFrame, margin: float = SILHOUETTE_MARGIN) -> DataFrame:
    """The silhouette winner if it beats the normalised elbow by the margin, else the elbow."""
    elbow_k = elbow(table, normalize=True).select("elbow_k").scalar()
    marked = table.withColumn("elbow_k", elbow_k)
    figures = marked.agg(
        F.first("elbow_k").alias("elbow_k"), F.max(F.when(F.col("k") == F.col("elbow_k"), F.col("silhouette"))).alias("at_elbow"),
        F.max("silhouette").alias("best"), F.min(F.struct((-F.col("silhouette")).alias("s"), F.col("k"))).alias("winner"),
    )
    chosen = F.when(F.col("best") >= F.col("at_elbow") + margin, F.col("winner.k")).otherwise(F.col("elbow_k"))
    return figures.select("elbow_k", chosen.alias("selected_k"))


def cluster_counts(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Rows and share per cluster, noise included."""
    counts = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.select(cluster, "count", (F.col("count") / total).alias("share"))


def eps_objective(search: DataFrame) -> DataFrame:
    """Validity and score of each tried radius (``cluster_count, noise_percent, silhouette``)."""
    valid = (
        F.col("cluster_count").between(2, MAX_CLUSTERS) & F.col("noise_percent").between(MIN_NOISE_PERCENT, MAX_NOISE_PERCENT)
        & F.col("silhouette").isNotNull()
    )
    score = (
        F.col("silhouette") - NOISE_WEIGHT * F.abs(F.col("noise_percent") - NOISE_TARGET)
        - CLUSTER_WEIGHT * F.greatest(F.col("cluster_count") - CLUSTER_TARGET, F.lit(0))
    )
    return search.withColumn("valid", valid).withColumn("objective", F.when(F.col("valid"), score).otherwise(INVALID_OBJECTIVE))


def choose_eps(search: DataFrame) -> DataFrame:
    """Best valid radius; else best silhouette with two clusters; else noise nearest to its target."""
    scored = eps_objective(search)
    usable = (F.col("cluster_count") >= 2) & F.col("silhouette").isNotNull()
    tier = F.when(F.col("valid"), 0).when(usable, 1).otherwise(2)
    first = F.when(tier == 0, -F.col("objective")).when(tier == 1, -F.col("silhouette")).otherwise(F.abs(F.col("noise_percent") - NOISE_TARGET))
    second = F.when(tier == 0, -F.col("silhouette")).when(tier == 1, F.col("noise_percent")).otherwise(F.lit(0.0))
    return scored.orderBy(tier, first, second, "eps").limit(1)


def divisive_hierarchy(df: DataFrame, k: int, features: str = "features", seed: int = 42, max_iter: int = 40):
    """Top-down hierarchy cut at K on all rows: splits the loosest cluster until K remain."""
    vectors = held_for_training(df.select(array_to_vector(F.col(features)).alias("vector")))
    model = BisectingKMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="vector", predictionCol="cluster").fit(vectors)
    return model


def stability_table(labelled: DataFrame, key: str, algorithms: Sequence[str], split: str = "split", features: str = "features") -> DataFrame:
    """Rows, clusters, noise and silhouette per (algorithm, split); one label column per algorithm."""
    long = labelled.unpivot([key, split], list(algorithms), "algorithm", "cluster")
    sizes = long.groupBy("algorithm", split).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(F.when(F.col("cluster") != NOISE, F.col("cluster"))).alias("cluster_count"),
        F.count_if(F.col("cluster") == NOISE).alias("noise_count"),
    ).withColumn("noise_percent", 100.0 * F.col("noise_count") / F.col("rows"))
    parts = []
    for name in algorithms:
        for side in ("train", "test"):
            rows = labelled.where(F.col(split) == side)
            score = silhouette(rows, key, name, features)
            parts.append(score.select(F.lit(name).alias("algorithm"), F.lit(side).alias(split), "silhouette"))
    scores = parts[0]
    for part in parts[1:]:
        scores = scores.unionByName(part)
    return sizes.join(scores, ["algorithm", split], "left")


def assignments(labelled: DataFrame, held_out: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Label columns per row key with the held-out labels joined back afterwards."""
    return labelled.select(key, *columns).join(held_out, key, "left")
