"""Statistics that used to take a pass a fold, a row a grid point, or a near-enough count."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.operators.entity_ols import expanding_ols, fit_fold_ols
from tallyframe.operators.frequency import kernel_density
from tallyframe.operators.splits import exact_stratified_split


def test_kernel_density_error_and_plan(spark):
    """Tails, copies, a far outlier, a flat group and a null group; no row meets the grid."""
    rng = np.random.default_rng(1)
    groups = {"a": np.concatenate([rng.normal(0, 1, 900), np.full(400, 0.25), rng.standard_cauchy(60)]), "b": rng.uniform(5, 6, 50), "c": np.full(9, 3.0), None: rng.normal(-4, 2, 70)}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "g string, v double")
    out = kernel_density(df, ["v"], ["g"])
    got = {g: rows.sort_values("step") for g, rows in out.toPandas().groupby("g", dropna=False)}
    for g, v in groups.items():
        rows = next(r for k, r in got.items() if k == g or (g is None and not isinstance(k, str)))
        if g == "c":
            assert len(rows) == 1 and rows["density"].isna().all()
            continue
        h, x = len(v) ** -0.2 * v.std(ddof=1), np.linspace(v.min(), v.max(), 200)
        want = np.exp(-0.5 * ((x[:, None] - v[None]) / h) ** 2).mean(1) / (np.sqrt(2 * np.pi) * h)
        assert len(rows) == 200 and np.allclose(rows["x"], x) and np.abs(rows["density"] - want).max() * h < 1e-12
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    first = plan[plan.index("Generate"):]
    assert "Aggregate" in first  # what is spread over the grid are sums by bin


def test_exact_split(spark):
    """Every class, a null one and a class of one included, has exactly its rounded share; layouts agree."""
    rng = np.random.default_rng(2)
    rows = [(i, rng.choice(["x", "y", None], p=[0.7, 0.2, 0.1])) for i in range(5003)] + [(9000, "solo"), (9001, "pair"), (9002, "pair"), (9003, "pair")]
    df = spark.createDataFrame([(i, None if c is None else str(c)) for i, c in rows], "id long, c string")
    out = exact_stratified_split(df, "c", ["id"])
    for r in out.groupBy("c").agg(F.count_if(F.col("split") == "test").alias("test"), F.count("*").alias("n")).collect():
        assert r["test"] == np.floor(r["n"] * 0.2 + 0.5)
    again = exact_stratified_split(df.repartition(7).sortWithinPartitions(F.desc("id")), "c", ["id"])
    assert sorted(map(str, out.collect())) == sorted(map(str, again.collect()))
    assert exact_stratified_split(df.limit(0), "c", ["id"]).count() == 0


def test_fold_models_equal_refits(spark):
    """Every fold against a regression with a dummy per entity; entities that appear late; a large offset."""
    rng = np.random.default_rng(3)
    n = 600
    fold = np.sort(rng.integers(0, 5, n))
    who = np.where(fold < 2, rng.integers(0, 3, n), rng.integers(0, 5, n))
    x = rng.normal(0, 1, (n, 2)) + 1e6 * (who == 1)[:, None]
    y = x @ [2.0, -0.5] + who * 7.0 + rng.normal(0, 0.1, n)
    pdf = pd.DataFrame({"who": [f"e{i}" for i in who], "cv_fold": fold, "p": x[:, 0], "q": x[:, 1], "y": y, "last": y + 1})
    df = spark.createDataFrame(pdf)
    model = fit_fold_ols(df, ["p", "q"], "who", "y")
    effects = {(r.cv_fold, r.who): (r.n, r.effect) for r in model.effects.collect()}
    assert sorted(model.slopes) == [1, 2, 3, 4]
    for f in (1, 2, 3, 4):
        seen = fold < f
        names = np.unique(who[seen])
        shift = np.array([x[seen & (who == k)].mean(0) for k in names])
        inner = np.vstack([x[seen & (who == k)] - shift[i] for i, k in enumerate(names)])
        right = np.concatenate([y[seen & (who == k)] - y[seen & (who == k)].mean() for k in names])
        slopes = np.linalg.lstsq(inner, right, rcond=None)[0]
        assert np.allclose(model.slopes[f], slopes, rtol=1e-7)
        for i, k in enumerate(names):
            assert effects[f, f"e{k}"][0] == (seen & (who == k)).sum()
            assert effects[f, f"e{k}"][1] == pytest.approx(y[seen & (who == k)].mean() - shift[i] @ slopes, rel=1e-6, abs=1e-3)
    assert len(effects) == sum(len(np.unique(who[fold < f])) for f in (1, 2, 3, 4))
    rows = {(r.cv_fold, r.model): r for r in expanding_ols(df, ["p", "q"], "who", "y", "last").collect()}
    assert all(rows[f, "naive"].mae == pytest.approx(1.0) for f in (1, 2, 3, 4)) and rows[4, "linear_regression"].rmse < 0.2
    assert rows[3, "linear_regression"].rows == (fold == 3).sum()
