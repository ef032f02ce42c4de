import numpy as np
import pandas as pd

from tallyframe.operators.entity_ols import fit_entity_ols


def test_matches_dummy_regression_and_handles_unseen(spark):
    rng = np.random.default_rng(4)
    n, names = 400, ["a", "b", "c", "d"]
    x = rng.normal(0, [1, 10, 100, 1, 5], (n, 5))
    who = rng.integers(0, 4, n)
    y = x @ [2, -1, 0.5, 3, 0] + np.array([5, -3, 0, 9])[who] + rng.normal(0, 0.1, n)
    pdf = pd.DataFrame(x, columns=list("pqrst")).assign(who=[names[i] for i in who], y=y)
    model = fit_entity_ols(spark.createDataFrame(pdf), list("pqrst"), "who", "y")
    design = np.hstack([x, np.eye(4)[who]])
    want = np.linalg.lstsq(design, y, rcond=None)[0]
    assert np.allclose(model.slopes, want[:5])
    effects = {r.who: r.effect for r in model.effects.collect()}
    assert np.allclose([effects[k] for k in names], want[5:])
    mean = sum(effects[k] * (who == i).sum() for i, k in enumerate(names)) / n
    new = pd.DataFrame(np.zeros((2, 5)), columns=list("pqrst")).assign(who=["zz", "a"])
    got = {r.who: r.prediction for r in model.transform(spark.createDataFrame(new)).collect()}
    assert np.isclose(got["zz"], mean) and np.isclose(got["a"], effects["a"])


def test_constant_and_repeated_features(spark):
    rows = [("a", 1.0, 2.0, 5.0, 3.0), ("a", 2.0, 4.0, 5.0, 5.0), ("b", 1.0, 2.0, 7.0, 1.0), ("b", 3.0, 6.0, 7.0, 5.0), ("b", None, 1.0, 7.0, 9.0)]
    df = spark.createDataFrame(rows, "who string, x double, twice double, fixed double, y double")
    model = fit_entity_ols(df, ["x", "twice", "fixed"], "who", "y")
    assert model.slopes[2] == 0.0 and np.isclose(model.slopes[0] + 2 * model.slopes[1], 2.0)
    fitted = model.transform(df.na.drop()).collect()
    assert all(np.isclose(r.prediction, r.y) for r in fitted)
