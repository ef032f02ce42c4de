import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector

from tallyframe.operators import modeling as md
from tallyframe.operators import subtree_forest as sf


def table(spark, n, seed, parts=3):
    """A step and a slope, copies, a column without use; rows to score hold values beyond the training range."""
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(0, 2, (n, 3)), 2)
    y = 5 * (x[:, 0] > 0.5) + x[:, 1] + rng.normal(0, 0.3, n)
    frame = pd.DataFrame({"key": range(n), "x": list(map(list, x)), "label": y})
    return spark.createDataFrame(frame).withColumn("features_vector", array_to_vector("x")).repartition(parts)


def score(df):
    got = df.toPandas()
    return ((got["prediction"] - got["label"]) ** 2).mean()


@pytest.mark.parametrize("task_rows", [1 << 21, 150])
def test_error_and_importances_are_those_of_histograms_alone(spark, monkeypatch, task_rows):
    """Subtrees only, and large nodes split by added histograms first, give forests as good as Spark ML's."""
    monkeypatch.setattr(sf, "TASK_ROWS", task_rows)
    monkeypatch.setattr(sf, "NODES_A_PASS", 7)
    monkeypatch.setattr(sf, "SLICE_ROWS", 500)
    train, test = table(spark, 2000, 1), table(spark, 1000, 2)
    model = sf.fit_subtree_forest(train, 12, 9, 5, 0.8)
    plain = md.forest_regressor(12, 9).fit(train)
    scored = model.transform(test)
    assert scored.columns == [*test.columns, "prediction"] and scored.count() == 1000
    assert score(scored) < 1.15 * score(plain.transform(test))
    assert np.allclose(model.featureImportances.toArray(), plain.featureImportances.toArray(), atol=0.05)


def test_subtree_is_the_best_one(spark):
    """One feature, two steps: the leaves are the means; a leaf below the smallest size is not made."""
    codes, y = np.repeat(np.arange(4, dtype=np.uint8), 6)[:, None], np.repeat([1.0, 1.0, 4.0, 9.0], 6)
    grown = lambda depth, least: sf.subtree(codes, np.ones(24), y, depth, 8, 1, least, np.random.default_rng(1))
    tree, gains = grown(5, 5)
    assert np.allclose(tree["value"][sf.walk(tree, codes)], y) and (tree["feature"] < 0).sum() == 3
    assert gains[0] == pytest.approx(((y - y.mean()) ** 2).sum())
    assert len(grown(0, 5)[0]) == 1 and len(grown(5, 13)[0]) == 1 and len(grown(1, 5)[0]) == 3
    top = tree[:3].copy()
    top["feature"][1:] = -1
    whole = sf.grafted(top, {1: sf.leaf(7.0), 2: tree})
    assert len(whole) == 2 + len(tree) and set(whole["value"][sf.walk(whole, codes)]) <= {7.0, 1.0, 4.0, 9.0}


def test_many_nodes_need_no_more_jobs(spark):
    """The jobs of a fit do not grow with the nodes; with a histogram a node they did, once a group of nodes was full."""
    train = table(spark, 3000, 3)
    def jobs(depth):
        spark.sparkContext.setJobGroup(f"forest{depth}", "")
        sf.fit_subtree_forest(train, 10, depth, 2, 0.8)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"forest{depth}"))
    assert jobs(3) == jobs(14)


def test_fit_regressors_takes_it_for_many_rows(spark, monkeypatch):
    monkeypatch.setattr(md, "HISTOGRAM_ROWS", 300)
    rng = np.random.default_rng(4)
    frame = pd.DataFrame({"Name": rng.choice(["a", "b"], 800), "close": rng.normal(50, 5, 800)}).assign(target_close_next=lambda d: d["close"] + 3 * (d["Name"] == "b"))
    df = spark.createDataFrame(frame)
    scored, fitted, seconds = md.fit_regressors(df, df, ["close"], ["Name"], trees=10, depth=8, models=["random_forest"])
    assert isinstance(fitted["random_forest"].stages[-1], sf.SubtreeForest) and seconds["random_forest"][0] > 0
    assert scored.count() == 800 and (scored.toPandas().eval("pred_random_forest - target_close_next") ** 2).mean() < 1
