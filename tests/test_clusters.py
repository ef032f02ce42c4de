import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import cluster as cl
from tallyframe.operators import density as dn


def points(spark, x):
    return spark.createDataFrame(pd.DataFrame({"id": range(len(x)), "features": [list(map(float, r)) for r in x]}))


def distances(a, b):
    return np.sqrt(((a[:, None] - b[None]) ** 2).sum(-1))


def brute_dbscan(x, eps, min_samples):
    near = distances(x, x) <= eps
    core = near.sum(1) >= min_samples
    label = np.where(core, np.arange(len(x)), -1)
    while True:
        merged = label.copy()
        for i in np.flatnonzero(core):
            merged[i] = label[near[i] & core].min()
        if np.array_equal(merged, label):
            break
        label = merged
    for i in np.flatnonzero(~core):
        reach = label[near[i] & core]
        label[i] = reach.min() if len(reach) else -1
    return label, core, near.sum(1)


@pytest.mark.parametrize("dims,block_rows", [(1, 1024), (2, 1024), (3, 16), (5, 32)])
def test_dbscan_matches_brute_force(spark, dims, block_rows):
    """A third of the rows are copies of one point and a third sit in one tight clump."""
    rng = np.random.default_rng(dims)
    x = np.vstack([np.full((60, dims), 0.5), rng.normal(2, 0.05, (60, dims)), rng.uniform(-3, 3, (70, dims))])
    eps, least = {1: (0.05, 4), 2: (0.35, 4), 3: (0.6, 4), 5: (1.6, 5)}[dims]
    got = dn.dbscan(points(spark, x), eps, least, block_rows=block_rows).toPandas().sort_values("id")
    label, core, near = brute_dbscan(x, eps, least)
    assert np.array_equal(got["is_core"], core) and np.array_equal(got["cluster"], label)


def test_dbscan_all_noise_and_one_row(spark):
    x = np.array([[0.0, 0.0], [10.0, 0.0], [20.0, 0.0]])
    assert {r["cluster"] for r in dn.dbscan(points(spark, x), 1.0, 2).collect()} == {-1}
    assert [r["cluster"] for r in dn.dbscan(points(spark, x[:1]), 1.0, 1).collect()] == [0]


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(300)]
    hub = [(1000, 1001 + i) for i in range(300)]
    got = dn.connected_components(spark.createDataFrame(chain + hub, "a long, b long")).toPandas()
    assert len(got) == 602 and set(got["component"]) == {0, 1000}


def test_nearest_within_matches_brute_force(spark):
    rng = np.random.default_rng(9)
    cores, asked = rng.uniform(0, 4, (150, 3)), rng.uniform(0, 4, (80, 3))
    labelled = points(spark, cores).withColumn("cluster", (F.col("id") % 7).cast("long"))
    got = dn.nearest_within(points(spark, asked), labelled, 0.6).toPandas().sort_values("id")
    d = distances(asked, cores)
    assert np.array_equal(got["cluster"], np.where(d.min(1) <= 0.6, d.argmin(1) % 7, -1))


def test_kth_distances_with_several_query_blocks(spark):
    x = np.random.default_rng(8).normal(0, 1, (120, 4))
    df = points(spark, x)
    got = dn.kth_distances(df, df, 5, block_rows=40).toPandas().sort_values("id")
    assert np.allclose(got["kth_distance"], np.sort(distances(x, x), axis=1)[:, 4])


def test_kth_distances_by_rings(spark):
    rng = np.random.default_rng(6)
    x = np.vstack([np.full((50, 2), 0.25), rng.normal(0, 1, (100, 2)), rng.normal(40, 0.01, (60, 2)), [[500.0, -3.0]]])
    df = points(spark, x)
    got = dn.kth_distances(df, df, 7).toPandas().sort_values("id")
    assert len(got) == len(x) and np.allclose(got["kth_distance"], np.sort(distances(x, x), axis=1)[:, 6])
    assert dn.kth_distances(df.limit(3), df, 7).count() == 0


def test_dense_cell_of_many_distinct_points(spark):
    rng = np.random.default_rng(2)
    x = np.vstack([rng.uniform(0, 0.1, (100_000, 2)), rng.uniform(0.3, 0.35, (2_000, 2)), [[5.0, 5.0]]])
    got = dn.dbscan(points(spark, x), 0.15, 10).groupBy("cluster").count().collect()
    assert {(r["cluster"], r["count"]) for r in got} == {(0, 100_000), (100_000, 2_000), (-1, 1)}


def test_silhouette_matches_brute_force_and_skips_noise(spark):
    rng = np.random.default_rng(7)
    x = np.vstack([rng.normal(0, 0.3, (30, 2)), rng.normal(3, 0.3, (30, 2)), [[9.0, 9.0]], rng.normal(0, 5, (5, 2))])
    label = np.array([0] * 30 + [1] * 30 + [2] + [-1] * 5)
    df = points(spark, x).join(spark.createDataFrame(pd.DataFrame({"id": range(66), "cluster": label})), "id")
    got = cl.silhouette_points(df, "id").toPandas().set_index("key")["silhouette"].sort_index()
    keep = label >= 0
    d, lab = distances(x[keep], x[keep]) ** 2, label[keep]
    want = []
    for i, own in enumerate(lab):
        same = (lab == own).sum()
        a = d[i, lab == own].sum() / max(same - 1, 1)
        b = min(d[i, lab == o].mean() for o in set(lab) - {own})
        want.append(0.0 if same == 1 else (b - a) / max(a, b))
    assert np.allclose(got, want)
    assert cl.silhouette(df.where("cluster = 0"), "id").first()[0] is None
    blocked = cl.silhouette_points(df, "id", block=1).toPandas().set_index("key")["silhouette"].sort_index()
    assert np.allclose(blocked, want)


def test_silhouette_of_more_rows_than_any_sample(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (10_200, 2))
    label = rng.integers(0, 4, len(x))
    df = spark.createDataFrame(pd.DataFrame({"id": range(len(x)), "features": list(map(list, x)), "cluster": label}))
    total = np.zeros((len(x), 4))
    for c in range(4):
        part = x[label == c]
        total[:, c] = (x ** 2).sum(1) * len(part) + (part ** 2).sum() - 2 * x @ part.sum(0)
    n = np.bincount(label)
    own = np.arange(len(x)), label
    a, means = total[own] / (n[label] - 1), total / n
    means[own] = np.inf
    b = means.min(1)
    assert cl.silhouette(df, "id").first()[0] == pytest.approx(np.mean((b - a) / np.maximum(a, b)), rel=1e-9)
    assert cl.silhouette_points(df, "id").count() == len(x)


def test_kmeans_sweep_and_choice(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(c, 0.2, (40, 2)) for c in ((0, 0), (5, 0), (0, 5))])
    table, models = cl.kmeans_sweep(points(spark, x), "id", range(2, 6), seeds=[1, 2, 3])
    rows = {r["k"]: r for r in table.collect()}
    assert rows[3]["inertia"] <= rows[2]["inertia"] and max(rows, key=lambda k: rows[k]["silhouette"]) == 3
    assert cl.choose_k_near_elbow(table).first()["selected_k"] == 3
    assert cl.choose_k_by_margin(table).first()["selected_k"] == 3
    labelled = cl.assign_nearest(points(spark, x), cl.centres_of(models[3]))
    assert labelled.agg(F.sum(F.pow("distance_to_centroid", F.lit(2)))).first()[0] == pytest.approx(rows[3]["inertia"], rel=1e-6)
    assert sorted(r["count"] for r in cl.cluster_counts(labelled).collect()) == [40, 40, 40]


def test_choose_eps_fallbacks(spark):
    schema = "eps double, cluster_count long, noise_percent double, silhouette double"
    valid = [(0.1, 3, 10.0, 0.2), (0.2, 3, 30.0, 0.25), (0.3, 1, 0.0, None)]
    assert cl.choose_eps(spark.createDataFrame(valid, schema)).first()["eps"] == 0.1
    assert cl.choose_eps(spark.createDataFrame([(0.1, 30, 70.0, 0.1), (0.2, 25, 80.0, 0.3)], schema)).first()["eps"] == 0.2
    assert cl.choose_eps(spark.createDataFrame([(0.1, 1, 60.0, None), (0.2, 1, 14.0, None)], schema)).first()["eps"] == 0.2


def test_eps_search_reports_each_radius(spark):
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(c, 0.2, (40, 2)) for c in ((0, 0), (4, 4))] + [rng.uniform(-8, 8, (8, 2))])
    table, labels = dn.eps_search(points(spark, x), [0.3, 0.6], 4)
    rows = table.collect()
    assert [r["eps"] for r in rows] == [0.3, 0.6] and rows[1]["cluster_count"] == 2 and set(labels) == {0.3, 0.6}
