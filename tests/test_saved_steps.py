import numpy as np
import pandas as pd
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallyframe.operators.entity_ols import fit_entity_ols, fit_fold_ols
from tallyframe.operators.prepare import IqrCapper, MedianImputer, MinMaxScaler, ModeImputer, ZScaler
from tallyframe.operators.reduce import TruncatedSvd
from tallyframe.sources.tables import load_step, save_model


def people(spark):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame({"id": range(200), "who": rng.choice(list("abc"), 200), "x": rng.normal(5, 2, 200), "z": rng.normal(0, 1, 200), "cv_fold": np.arange(200) // 50})
    return spark.createDataFrame(frame.assign(y=frame.x * 2 - frame.z + 1)).withColumn("x", F.when(F.col("id") % 9 != 0, F.col("x")))


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_every_step_comes_back(spark, tmp_path):
    """Equal results from the files alone, in a session of its own; saving again replaces."""
    df = people(spark)
    steps = [IqrCapper(["x", "z"]).fit(df), MedianImputer(["x"]).fit(df), MinMaxScaler(["x", "z"]).fit(df), ModeImputer(["who"]).fit(df), ZScaler(["x", "z"]).fit(df),
             fit_entity_ols(df, ["x", "z"], "who", "y"), fit_fold_ols(df, ["x", "z"], "who", "y")]
    other = spark.newSession()
    for n, step in enumerate(steps):
        path = str(tmp_path / str(n))
        save_model(steps[0], path)
        save_model(step, path)
        back = load_step(other, path)
        want = step.transform(df)
        copied = other.createDataFrame(df.toPandas(), df.schema) if n < 5 else df
        got = back.transform(copied) if n < 5 else load_step(spark, path).transform(df)
        assert type(back) is type(step) and got.columns == want.columns and rows(got, *want.columns) == rows(want, *want.columns)
    with pytest.raises(ValueError):
        save_model(object(), str(tmp_path / "no"))


def one_hot(spark, width, n, seed, hot=4):
    rng = np.random.default_rng(seed)
    slots = np.minimum((rng.pareto(0.7, (n, hot)) * 9).astype(int), width - 1)
    vectors = [(i, Vectors.sparse(width, {int(j): 1.0 + k for k, j in enumerate(sorted(set(s)))})) for i, s in enumerate(slots)]
    x = np.zeros((n, width))
    for i, v in vectors:
        x[i, v.indices] = v.values
    return spark.createDataFrame(vectors, ["id", "vector"]), x


def test_wide_sparse_rows_match_numpy(spark, tmp_path):
    """5,000 slots, four entries a row; nothing of slots x slots is made."""
    df, x = one_hot(spark, 5000, 3000, 2)
    svd = TruncatedSvd(6).fit(df)
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    assert np.abs(np.abs(svd.pc.toArray().T @ vt[:6].T) - np.eye(6)).max() < 1e-6
    scores = x @ vt[:6].T
    assert svd.explained_ratio == pytest.approx(scores.var(0).sum() / x.var(0).sum(), rel=1e-9)
    z = np.array([r["features"] for r in svd.transform(df).orderBy("id").collect()])
    assert np.allclose(np.abs(z), np.abs((scores - scores.mean(0)) / scores.std(0)), atol=1e-6)
    save_model(svd, str(tmp_path / "svd"))
    assert rows(load_step(spark, str(tmp_path / "svd")).transform(df), "id", "features") == rows(svd.transform(df), "id", "features")


def test_dense_empty_and_mixed_vectors(spark):
    data = [(0, Vectors.dense([1.0, 2.0, 0.0])), (1, Vectors.sparse(3, {})), (2, Vectors.sparse(3, {1: 4.0})), (3, Vectors.dense([0.0, 0.0, 5.0])), (4, Vectors.sparse(3, {0: 1.0, 2: 1.0}))]
    x = np.array([v.toArray() for _, v in data])
    svd = TruncatedSvd(2).fit(spark.createDataFrame(data, ["id", "vector"]))
    assert np.allclose(np.abs(svd.pc.toArray()), np.abs(np.linalg.svd(x)[2][:2].T), atol=1e-7)
