import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import modeling as md


def ready(spark, n=500):
    """One row in eight is positive."""
    rng = np.random.default_rng(5)
    label = (np.arange(n) % 8 == 0).astype(float)
    frame = pd.DataFrame({"id": range(n), "x": rng.normal(0, 1, n) + label, "g": np.where(rng.random(n) < 0.3 + 0.4 * label, "u", "v"), "label": label})
    df = spark.createDataFrame(frame)
    return md.fit_preprocessor(df, ["x"], ["g"]).transform(df)


def test_draws_are_poisson(spark):
    df = spark.range(20_000).select(F.xxhash64("id").alias("h"))
    counts = np.array([r[0] for r in df.select(md.bootstrap_draws(F.col("h"), 3)).collect()])
    assert abs(counts.mean() - 1) < 0.03 and abs(counts.var() - 1) < 0.05 and abs((counts == 0).mean() - np.exp(-1)) < 0.02
    other = np.array([r[0] for r in df.select(md.bootstrap_draws(F.col("h"), 4)).collect()])
    assert abs(np.corrcoef(counts, other)[0, 1]) < 0.03


def test_class_weights_follow_each_bootstrap(spark):
    """Each tree's classes weigh the same in its own bootstrap; weights differ from tree to tree and not by layout."""
    df = ready(spark)
    forest = md.balanced_subsample_forest(df, ["id"], trees=6, depth=5)
    for t, weights in enumerate(forest.class_weights):
        drawn = {r["label"]: r["n"] for r in df.groupBy("label").agg(F.sum(md.bootstrap_draws(F.xxhash64("id"), t)).alias("n")).collect()}
        assert weights[0.0] * drawn[0.0] == pytest.approx(weights[1.0] * drawn[1.0]) == pytest.approx(sum(drawn.values()) / 2)
    assert len({w[1.0] for w in forest.class_weights}) > 3
    mean = np.mean([w[1.0] for w in forest.class_weights])
    assert mean == pytest.approx(4.0, rel=0.15)
    again = md.balanced_subsample_forest(df.repartition(3), ["id"], trees=6, depth=5)
    assert again.class_weights == forest.class_weights
    out = forest.transform(df).toPandas()
    one = np.mean([[p[1] for p in t.transform(df).orderBy("id").select(md.vector_to_array("_p").alias("p")).toPandas()["p"]] for t in forest.trees], axis=0)
    out = out.sort_values("id")
    assert np.allclose([p[1] for p in out["probability"]], one) and np.array_equal(out["prediction"], (one > 0.5).astype(float))
    recall = out.loc[out["label"] == 1, "prediction"].mean()
    assert recall > 0.6 and sum(r["importance"] for r in forest.importances(df).collect()) == pytest.approx(1.0)
