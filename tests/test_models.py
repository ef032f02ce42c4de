import json

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tallyframe.operators import metrics as mt
from tallyframe.operators import modeling as md
from tallyframe.operators.reduce import TruncatedSvd, pca_coordinates
from tallyframe.sources import tables as tb


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(2)
    n = 600
    x = rng.normal(0, 1, n)
    group = rng.choice(["a", "b", "c"], n)
    y = np.where(x + (group == "b") + rng.normal(0, 0.3, n) > 0.8, "yes", "no")
    pdf = pd.DataFrame({"id": range(n), "x": x, "group": group, "y": y, "leak": (y == "yes") * 1.0})
    return spark.createDataFrame(pdf)


def test_metrics_handle_empty_classes(spark):
    df = spark.createDataFrame([("no", "no"), ("no", "no")], "actual string, predicted string")
    cells = {(r["actual"], r["predicted"]): (r["count"], r["row_percent"]) for r in mt.confusion(df, ["no", "yes"]).collect()}
    assert cells == {("no", "no"): (2, 100.0), ("no", "yes"): (0, 0.0), ("yes", "no"): (0, 0.0), ("yes", "yes"): (0, 0.0)}
    report = {r["label"]: r for r in mt.classification_report(df, ["no", "yes"]).collect()}
    assert report["yes"]["f1"] == 0 and report["accuracy"]["f1"] == 1 and report["macro avg"]["recall"] == 0.5
    assert mt.summary_metrics(df, ["no", "yes"], "yes").first()["balanced_accuracy"] == 1.0


def test_adjusted_rand_limits(spark):
    df = spark.createDataFrame([(i % 3, (i % 3) + 10, i % 2) for i in range(60)], "a int, same int, other int")
    assert mt.adjusted_rand(df, "a", "same").first()[0] == pytest.approx(1.0)
    assert abs(mt.adjusted_rand(df, "a", "other").first()[0]) < 0.1


def test_preprocessor_is_fitted_on_train_only(spark):
    train = spark.createDataFrame([(1.0, "a"), (3.0, "b"), (None, "b")], "x double, c string")
    new = spark.createDataFrame([(None, "zz"), (3.0, "a"), (1.0, None)], "x double, c string")
    prep = md.fit_preprocessor(train, ["x"], ["c"])
    rows = [list(r[0]) for r in prep.transform(new).select(vector_to_array("features_vector")).collect()]
    assert [r[1:] for r in rows] == [[0.0, 0.0], [1.0, 0.0], [0.0, 1.0]]
    assert rows[0][0] == pytest.approx(0.0) and rows[1][0] == pytest.approx(1 / np.std([1, 3, 2]))
    ordinal = md.fit_preprocessor(train, [], ["c"], encode="ordinal")
    assert [r[0] for r in ordinal.transform(new).select("c__ord").collect()] == [-1.0, 0.0, 1.0]


def test_experiments_learn_and_exclude_leaks(people):
    table, predictions = md.classification_experiments(people, {"y": "yes"}, ["id"], {"y": ["leak"]}, trees=10, depth=5, max_iter=50)
    rows = {(r["model"], r["split"]): r for r in table.collect()}
    assert len(rows) == 4 and predictions.count() == 1200
    assert all(0.7 < r["accuracy"] < 1.0 for r in rows.values())
    gap = mt.generalisation_gap(table, ["accuracy"], ["target", "model"]).first()
    assert gap["accuracy_gap"] == pytest.approx(gap["accuracy_train"] - gap["accuracy_test"])


def test_balanced_weights_sum_to_rows(people):
    weighted = md.balanced_weights(people, "y")
    sums = [r["w"] for r in weighted.groupBy("y").agg(F.sum("class_weight").alias("w")).collect()]
    assert sums == pytest.approx([300.0, 300.0])


def test_forest_importances_name_their_slots(people):
    ready = md.fit_preprocessor(people, ["x"], ["group"]).transform(people).withColumn("label", (F.col("y") == "yes").cast("double"))
    table = md.feature_importances(md.forest_classifier(5, 4).fit(md.balanced_weights(ready, "label")), ready).collect()
    assert table[0]["feature"] == "x__num" and sum(r["importance"] for r in table) == pytest.approx(1.0)


def test_svd_matches_numpy(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(1.0, 1.0, (300, 5)) * np.array([5, 3, 1, 0.5, 0.1])
    df = spark.createDataFrame(pd.DataFrame({"id": range(300), "a": list(map(list, x))})).withColumn("vector", array_to_vector("a"))
    svd = TruncatedSvd(3).fit(df)
    _, _, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(np.abs(svd.model.pc.toArray()), np.abs(vt[:3].T), atol=1e-6)
    scores = x @ vt[:3].T
    assert svd.explained_ratio == pytest.approx(scores.var(axis=0).sum() / x.var(axis=0).sum())
    z = np.array([r["features"] for r in svd.transform(df).orderBy("id").collect()])
    assert np.allclose(np.abs(z), np.abs((scores - scores.mean(0)) / scores.std(0)), atol=1e-6)


def test_pca_matches_numpy(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(2.0, 1.0, (200, 3)) * np.array([4, 2, 1])
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abc")).assign(id=range(200)))
    placed, ratio = pca_coordinates(df, ["a", "b", "c"], ["id"])
    centred = x - x.mean(0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    got = np.array([r["features"] for r in placed.orderBy("id").collect()])
    assert np.allclose(np.abs(got), np.abs(centred @ vt[:2].T), atol=1e-8) and np.allclose(ratio, (s**2 / (s**2).sum())[:2])


def test_sources_and_sinks(spark, people, tmp_path):
    bars = spark.createDataFrame([("2024-01-02", 1.0, 2.0, 0.5, 1.5, 10, "x")], "date string, open double, high double, low double, close double, volume long, Name string")
    bars = bars.withColumn("date", F.to_date("date"))
    tb.write_delimited(bars, str(tmp_path / "bars"), date_format="dd/MM/yyyy")
    back = tb.read_delimited(spark, str(tmp_path / "bars"), tb.BAR_SCHEMA, date_format="dd/MM/yyyy", columns=["date", "close"])
    assert back.collect() == bars.select("date", "close").collect()
    (tmp_path / "people.csv").write_text("age;job\n30;clerk\n41;unknown\n")
    assert tb.read_delimited(spark, str(tmp_path / "people.csv"), sep=";").dtypes == [("age", "int"), ("job", "string")]
    tb.write_table(people, str(tmp_path / "split"), partition_by=["group"])
    assert spark.read.parquet(str(tmp_path / "split")).count() == 600
    tb.write_run_record(spark, {"rows": 3, "means": [1.0, 2.0]}, str(tmp_path / "run"))
    text = next((tmp_path / "run").glob("part-*.json")).read_text()
    assert json.loads(text) == {"rows": 3, "means": [1.0, 2.0]}
    prep = md.fit_preprocessor(people, ["x"], ["group"])
    tb.save_model(prep, str(tmp_path / "model"))
    again = tb.load_model(str(tmp_path / "model"))
    assert again.transform(people).select("features_vector").first() == prep.transform(people).select("features_vector").first()
