"""Flows over large tables read their input once, and heavy cells that one point each connects are not compared."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tallyframe.operators import density as dn
from tallyframe.operators import grid_density as gd
from tallyframe.operators import metric_density
from tallyframe.operators import modeling as md
from tallyframe.operators import panel as pn
from tallyframe.plans import flows
from tests.test_clusters import brute_dbscan, points


def counted(df, column):
    """``df`` whose ``column`` counts how many rows it was computed for."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    @F.udf("double")
    def look(v):
        seen.add(1)
        return v

    return df.withColumn(column, look.asNondeterministic()(column)), seen


def customers(spark, n=240):
    rng = np.random.default_rng(3)
    return spark.createDataFrame(pd.DataFrame({
        "id": range(n), "a": rng.normal(0, 1, n), "b": rng.normal(0, 1, n), "c": [["x", "y", "z"][i % 3] for i in range(n)], "y": [["no", "yes"][i % 2] for i in range(n)]}))


def test_stability_reads_its_input_once(spark):
    df, seen = counted(customers(spark), "a")
    table, labels = flows.stability(df, ["a", "b", "c"], "id", k=2, eps=0.8, min_samples=4, components=4)
    assert labels.count() == 240 and table.agg(F.sum("rows")).first()[0] == 3 * 240
    assert seen.value <= 240


def test_classifiers_read_their_input_once_a_target(spark):
    df, seen = counted(customers(spark), "a")
    table, predictions = md.classification_experiments(df, {"y": "yes"}, ["id"], trees=2, depth=2, max_iter=5)
    assert predictions.count() == 480 and table.count() == 4
    assert seen.value <= 240


def test_session_features_are_computed_before_their_filter(spark):
    bars = spark.createDataFrame([("u", "2024-01-02", 1.0, 2.0, 0.5, 3), ("u", "2024-01-03", 1.0, 2.0, 0.5, None)], "Name string, date string, open double, high double, low double, volume long")
    sessions = pn.session_features(bars.withColumn("date", F.to_date("date")))
    assert sessions.count() == 1
    plan = sessions._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "log" not in plan.replace("log_", "").replace("logicalrdd", "") and "sin(" not in plan.replace("_sin", "")


def test_four_dimensions_are_clustered_on_the_grid(spark, monkeypatch):
    monkeypatch.setattr(metric_density, "density_labels", None)
    rng = np.random.default_rng(4)
    # Two clumps that touch in a row only, noise, and a chain whose steps are exactly eps long and cross three cells.
    chain = np.zeros((5, 4)) + 40
    chain[:, 0] = 50 + 0.4999999993 + np.arange(5)
    x = np.vstack([rng.normal(0, 0.1, (80, 4)), rng.normal(0, 0.1, (80, 4)) + [1.4, 0, 0, 0], rng.uniform(-4, 4, (120, 4)), chain])
    got = dn.dbscan(points(spark, x), 1.0, 3).toPandas().sort_values("id")
    label, core, _ = brute_dbscan(x, 1.0, 3)
    assert np.array_equal(got["is_core"], core) and np.array_equal(got["cluster"], label)


def test_connected_heavy_cells_are_not_compared(spark):
    side = 0.5 / 2 ** 0.5 * (1 - 1e-9)
    middles = (np.indices((10, 10)).reshape(2, -1).T + 0.5) * side  # the smallest ids of their cells
    x = np.vstack([middles, np.random.default_rng(5).uniform(0, 10 * side, (4000, 2))])
    rows = points(spark, x).withColumn("weight", F.lit(1).cast("long"))
    found = []
    def kept(*args):
        found.append(plain(*args))
        return found[-1]
    plain = gd._cell_links
    gd._cell_links = kept
    try:
        labels = gd.density_labels(rows, 0.5, 5, 2)
        assert labels.select("cluster").distinct().count() == 1
    finally:
        gd._cell_links = plain
    assert "CoGroups" not in found[0]._jdf.queryExecution().optimizedPlan().toString()


def test_cells_that_only_rows_connect_are_linked(spark):
    # Each clump fills a cell; the smallest ids are far apart, other rows are in reach.
    left, right = np.linspace(0.0, 0.69, 20), np.linspace(1.45, 2.05, 20)[::-1]
    x = np.stack([np.concatenate([left, right]), np.zeros(40)], axis=1)
    got = dn.dbscan(points(spark, x), 1.0, 3).toPandas().sort_values("id")
    label, _, _ = brute_dbscan(x, 1.0, 3)
    assert set(label) == {0} and np.array_equal(got["cluster"], label)
