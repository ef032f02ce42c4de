import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import metric_density as md
from tallyframe.operators import metric_index as mi
from tests.test_clusters import brute_dbscan, distances


def table(spark, x, **more):
    frame = {"id": np.arange(len(x)), "features": [list(map(float, r)) for r in x]} | more
    return spark.createDataFrame(pd.DataFrame(frame))


def clumps(rng, n, dims, spread=0.05, centres=12):
    middle = rng.uniform(-5, 5, (centres, dims))
    return middle[rng.integers(0, centres, n)] + rng.normal(0, spread, (n, dims))


def test_within_is_exact_at_the_edge():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 6, (60, 10)).astype(float)
    for eps in (np.sqrt(20), np.sqrt(50), 3.0):
        assert np.array_equal(mi.within(a, a, eps), distances(a, a) <= eps)
    far = a + 1e6
    assert np.array_equal(mi.within(far, far, 5.0), distances(far, far) <= 5.0)


def test_pivots_and_leaves():
    x = np.array([[0.0], [1.0], [10.0], [10.0], [4.0]])
    assert mi.farthest_first(x, 3)[:, 0].tolist() == [0, 10, 4] and len(mi.farthest_first(x, 9)) == 4
    parts = mi.halved(np.random.default_rng(1).normal(size=(1000, 7)), 60)
    assert sorted(np.concatenate(parts).tolist()) == list(range(1000)) and max(map(len, parts)) <= 60 and min(map(len, parts)) >= 30
    assert sum(map(len, mi.halved(np.zeros((300, 2)), 10))) == 300


@pytest.fixture(scope="module")
def small_leaves():
    patch = pytest.MonkeyPatch()
    for name, value in {"IN_PLACE_ROWS": 0, "LEAF_ROWS": 16, "GROUP_ROWS": 200, "PIVOT_ROWS": 60, "SLICE_ROWS": 64, "BUNDLE_LEAVES": 2}.items():
        patch.setattr(mi, name, value)
    yield
    patch.undo()


def test_leaf_pairs_lose_nothing_and_bounds_hold(spark, small_leaves):
    rng = np.random.default_rng(2)
    x = np.vstack([clumps(rng, 500, 10), rng.uniform(-6, 6, (100, 10))])
    index = mi.build(table(spark, x))
    leaf = {r.id: r.leaf for r in index.rows.collect()}
    heads = index.leaves.toPandas()
    assert heads["rows"].sum() == 600 and heads["rows"].max() <= 16 and len(index.pivots) == 10
    d = distances(x, x)
    for eps in (0.3, 2.0, 9.0):
        pairs = {(r.a, r.b): r.high for r in mi.near_leaves(index, index, eps).collect()}
        for i, j in zip(*np.nonzero(d <= eps)):
            assert (leaf[i], leaf[j]) in pairs
        assert all(d[i, j] <= pairs[leaf[i], leaf[j]] for i in range(600) for j in range(600) if (leaf[i], leaf[j]) in pairs)


@pytest.mark.parametrize("seed", [3, 4])
def test_density_in_ten_dimensions(spark, small_leaves, seed):
    """Tight clumps are whole leaves, loose ones are counted, scattered rows are noise or border."""
    rng = np.random.default_rng(seed)
    x = np.vstack([clumps(rng, 250, 10, 0.03, 5), clumps(rng, 200, 10, 0.25, 4), rng.uniform(-5, 5, (60, 10)), np.full((1, 10), 0.4)])
    points = table(spark, x).withColumn("weight", F.when(F.col("id") == 510, 30).otherwise(1).cast("long"))
    whole = np.vstack([x, np.repeat(x[510:], 29, 0)])
    for eps, least in ((1.0, 6), (0.45, 4)):
        got = md.density_labels(points, eps, least).toPandas().sort_values("id")
        label, core, _ = brute_dbscan(whole, eps, least)
        assert np.array_equal(got["is_core"], core[:511])
        assert np.array_equal(got["cluster"].fillna(-1), label[:511])


def test_compared_pairs_grow_slower_than_the_square(spark):
    """Clustered rows in ten dimensions: eight times the rows cost far less than 64 times the pairs."""
    found = []
    for n in (1000, 8000):
        rng = np.random.default_rng(5)
        index = mi.build(table(spark, clumps(rng, n, 10, 0.02, n // 50)), leaf_rows=32)
        row = mi.compared(mi.near_leaves(index, index, 0.3), index, index).first()
        found.append(row["compared"])
        assert row["all_pairs"] == n * n
    assert found[1] < 0.2 * 8000 ** 2 and found[1] < 24 * found[0]


def test_kth_and_capped(spark, small_leaves):
    rng = np.random.default_rng(6)
    x = np.vstack([clumps(rng, 300, 10), rng.uniform(-6, 6, (60, 10)), [[90.0] * 10]])
    d = np.sort(distances(x, x), axis=1)
    points = table(spark, x).withColumn("weight", F.lit(1).cast("long"))
    for k in (1, 7, 40):
        got = mi.kth(points, points.select("id", "features"), k).toPandas().sort_values("id")
        assert np.allclose(got["distance"], d[:, k - 1], rtol=1e-12, atol=0)
    got = mi.kth(points, points.select("id", "features"), 7, cap=0.3).toPandas().sort_values("id")
    assert np.allclose(got["distance"].fillna(-1), np.where(d[:, 6] <= 0.3, d[:, 6], -1))
    asked = rng.uniform(-6, 6, (90, 10))
    weighted = points.withColumn("weight", (1 + F.col("id") % 3).cast("long"))
    got = mi.kth(weighted, table(spark, asked), 9).toPandas().sort_values("id")
    many = np.sort(np.repeat(distances(asked, x), 1 + np.arange(len(x)) % 3, axis=1), axis=1)
    assert np.allclose(got["distance"], many[:, 8], rtol=1e-12)
    assert mi.kth(points, points.select("id", "features"), 999).where("distance is not null").count() == 0


def test_nearest_in_ten_dimensions(spark, small_leaves):
    rng = np.random.default_rng(7)
    x = np.round(clumps(rng, 300, 10, 0.3), 1)
    asked = np.vstack([np.round(x[:80] + rng.normal(0, 0.3, (80, 10)), 1), rng.uniform(-5, 5, (40, 10))])
    points = table(spark, np.vstack([x, x[:40]])).withColumn("label", F.col("id") * 10)
    got = {r.id: (r.point, r.label, r.distance) for r in mi.nearest(table(spark, asked), points, 2.0).collect()}
    d = mi.distances(asked, np.vstack([x, x[:40]]))
    want = {i: (int(d[i].argmin()), 10 * int(d[i].argmin()), d[i].min()) for i in range(len(asked)) if d[i].min() <= 2.0}
    assert got == want and 0 < len(want)


def test_few_points_travel_to_the_queries(spark):
    """The way without an index gives the same k-distances and nearest points."""
    rng = np.random.default_rng(8)
    x, asked = np.round(rng.normal(0, 1, (200, 6)), 1), np.round(rng.normal(0, 1, (700, 6)), 1)
    points = table(spark, x).withColumn("weight", (1 + F.col("id") % 3).cast("long"))
    many = np.sort(np.repeat(mi.distances(asked, x), 1 + np.arange(200) % 3, axis=1), axis=1)
    for k, cap in ((5, None), (9, 1.5), (999, None)):
        got = mi.kth(points, table(spark, asked), k, cap).toPandas().sort_values("id")["distance"].fillna(-1).to_numpy()
        want = many[:, k - 1] if k < 999 else np.full(700, -1.0)
        assert np.array_equal(got, want if cap is None else np.where(want <= cap, want, -1))
    d = mi.distances(asked, x)
    got = {r.id: (r.point, r.label, r.distance) for r in mi.nearest(table(spark, asked), points.withColumn("label", F.col("id") * 10), 1.0).collect()}
    assert got == {i: (int(d[i].argmin()), 10 * int(d[i].argmin()), d[i].min()) for i in range(700) if d[i].min() <= 1.0}


def test_few_pairs_are_measured_one_by_one(monkeypatch):
    """The nearest rows equal brute force far from the origin and with ties; hardly more than those are measured exactly."""
    rng = np.random.default_rng(9)
    x, y = rng.normal(0, 1, (200, 48)) + 1e4, np.vstack([rng.normal(0, 1, (6000, 48)), np.zeros((30, 48))]) + 1e4
    x[:5] = y[-5:]
    measured, plain = [], mi.exact
    monkeypatch.setattr(mi, "exact", lambda a, b, i, j: (measured.append(len(i)), plain(a, b, i, j))[1])
    weight = 1 + np.arange(len(y)) % 3
    i, d, w = mi.smallest(x, y, weight, 7)
    true = mi.distances(x, y)
    for row in range(len(x)):
        assert np.array_equal(np.repeat(d[i == row], w[i == row])[:7], np.sort(np.repeat(true[row], weight))[:7])
    best, away = mi.nearest_one(x, y, np.arange(len(y))[::-1])
    assert np.array_equal(away, true.min(1)) and np.array_equal(best[:5], np.full(5, len(y) - 1))
    assert sum(measured) < len(x) * len(y) / 100


def test_rows_travel_to_a_set_number_of_bundles(spark, monkeypatch):
    """Small pivots share bundles: twenty times the leaves make no more tasks than ``BUNDLES`` and the slices ask for."""
    for name, value in {"LEAF_ROWS": 4, "PIVOT_ROWS": 16, "SLICE_ROWS": 100_000, "BUNDLE_LEAVES": 1, "BUNDLES": 4}.items():
        monkeypatch.setattr(mi, name, value)
    rng = np.random.default_rng(5)
    x = rng.normal(0, 1, (800, 10))
    index = mi.build(table(spark, x).withColumn("weight", F.lit(1).cast("long")))
    assert len(index.pivots) == 50
    tasks = mi.compare(index.rows, index.rows, mi.near_leaves(index, index, 100.0), lambda a, b: pd.DataFrame({"rows": [len(a)], "others": [len(b)]}), "rows long, others long").toPandas()
    assert tasks["rows"].sum() == 800 and (tasks["others"] == 800).all() and len(tasks) <= 6
