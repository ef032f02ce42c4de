import time

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.functions import windows as win
from tallyframe.operators import panel as pn
from tallyframe.operators import sampling as sm
from tallyframe.operators import splits as sp
from tallyframe.operators import validate as v

COLUMNS = ["open", "high", "low", "close", "volume"]


def bars(seed=3, days=40, names=("a", "b", "c")):
    rng = np.random.default_rng(seed)
    rows = []
    for name in names:
        for i in range(days):
            if rng.random() < 0.3:
                continue
            values = [float(x) for x in rng.uniform(5, 10, 4)] + [float(rng.integers(1, 99))]
            if rng.random() < 0.2:
                values[1] = None
            rows.append((name, dt.date(2024, 1, 1) + dt.timedelta(days=i * 2), *values))
    return pd.DataFrame(rows, columns=["Name", "date", *COLUMNS])


@pytest.fixture(scope="module")
def panel(spark):
    pdf = bars()
    return spark.createDataFrame(pdf, "Name string, date date, open double, high double, low double, close double, volume double"), pdf


def test_gap_filling_matches_pandas(panel):
    df, pdf = panel
    index = pd.MultiIndex.from_product([sorted(pdf.Name.unique()), sorted(pdf.date.unique())], names=["Name", "date"])
    want = pdf.set_index(["Name", "date"]).reindex(index).reset_index()
    for c in COLUMNS:
        for name in pdf.Name.unique():
            mine = want["Name"] == name
            values = want.loc[mine, c].to_numpy(dtype=float)
            known = np.flatnonzero(~np.isnan(values))
            want.loc[mine, c] = np.interp(np.arange(len(values)), known, values[known])
    got = pn.fill_panel(pn.complete_panel(df)).toPandas().sort_values(["Name", "date"])
    for c in COLUMNS:
        assert np.allclose(got[f"{c}_filled"], want[c])
    assert got["was_missing_timestamp"].sum() == len(index) - len(pdf) == pn.missing_timestamps(df).count()


def test_long_series_fill_in_linear_time(spark):
    n = 50_000
    df = spark.range(n).select(F.lit("x").alias("Name"), F.col("id").alias("day"), F.when(F.col("id") % 1000 == 0, F.col("id").cast("double")).alias("close"))
    w, back = win.per_entity("Name", "day"), win.per_entity_backward("Name", "day")
    filled = df.select("day", win.interpolated("close", "day", w, back).alias("i"))
    filled.limit(1).collect()
    start = time.perf_counter()
    row = filled.agg(F.max(F.abs(F.col("i") - F.least("day", F.lit(n - 1000)))), F.count("i")).first()
    assert row[0] < 1e-9 and row[1] == n and time.perf_counter() - start < 10


def test_within_lifetime_invents_nothing_outside(panel):
    df, pdf = panel
    gaps = pn.missing_timestamps(df, within_lifetime=True).toPandas()
    span = pdf.groupby("Name")["date"].agg(["min", "max"])
    assert all(span.loc[r.Name, "min"] < r.date < span.loc[r.Name, "max"] for r in gaps.itertuples())


def test_rolling_and_centred_windows_match_pandas(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"Name": "x", "day": range(600), "close": rng.uniform(1, 9, 600)})
    pdf.loc[::13, "close"] = np.nan
    w = win.per_entity("Name", "day")
    df = spark.createDataFrame(pdf).withColumn("close", F.nanvl("close", F.lit(None).cast("double")))
    got = df.select("day", win.rolling_mean("close", w).alias("m"), win.rolling_std("close", w).alias("s"), win.centred_mean("close", w).alias("c"),
                    win.interpolated("close", "day", w, win.per_entity_backward("Name", "day")).alias("i")).toPandas().sort_values("day")
    s = pdf["close"]
    for name, want in (("m", s.rolling(20, min_periods=5).mean()), ("s", s.rolling(20, min_periods=5).std()),
                       ("c", s.rolling(252, center=True, min_periods=60).mean()), ("i", s.interpolate(limit_direction="both"))):
        assert np.allclose(got[name], want, equal_nan=True)


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 20), ("b", 1, 5)], "k string, seq int, v int")
    assert {r["k"]: r["v"] for r in pn.first_per_key(df, ["k"], ["seq"]).collect()} == {"a": 10, "b": 5}
    assert {r["k"]: r["v"] for r in pn.last_per_key(df, ["k"], ["seq"]).collect()} == {"a": 20, "b": 5}


def test_fold_geometry_and_labels(spark):
    assert sp.fold_geometry(1005, 5) == (167, 170)
    for n, s in ((10, 1), (5, 5)):
        with pytest.raises(ValueError):
            sp.fold_geometry(n, s)
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(1005)]
    df = spark.createDataFrame([(x,) for x in days], "target_date date")
    summary = sp.fold_summary(df, 5).orderBy("fold").collect()
    assert [r["train_unique_dates"] for r in summary] == [170, 337, 504, 671, 838]
    assert {r["validation_unique_dates"] for r in summary} == {167}
    assert all(r["train_target_end"] < r["validation_target_start"] for r in summary)


def test_time_split_rejects_an_empty_side(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 1),)], "target_date date")
    with pytest.raises(ValueError):
        sp.time_split(df, "2021-01-01")


def test_hash_split_is_stable_and_stratified(spark):
    df = spark.range(20_000).withColumn("y", F.when(F.col("id") % 10 == 0, "yes").otherwise("no"))
    one = {(r["id"], r["split"]) for r in sp.stratified_split(df.coalesce(1), "y", ["id"]).collect()}
    many = {(r["id"], r["split"]) for r in sp.stratified_split(df.repartition(9), "y", ["id"]).collect()}
    assert one == many
    shares = {r["y"]: r["s"] for r in sp.stratified_split(df, "y", ["id"]).groupBy("y").agg(F.avg((F.col("split") == "test").cast("int")).alias("s")).collect()}
    assert all(abs(s - 0.2) < 0.03 for s in shares.values())


def test_samples(spark):
    df = spark.range(5_000).withColumn("g", F.when(F.col("id") < 20, "rare").otherwise("hot"))
    sizes = {r["g"]: r["count"] for r in sm.group_sample(df, "g", ["id"], 50).groupBy("g").count().collect()}
    assert sizes == {"rare": 20, "hot": 50}
    picked = sorted(r["id"] for r in sm.uniform_sample(df, ["id"], 100).collect())
    assert picked == sorted(r["id"] for r in sm.uniform_sample(df.repartition(3), ["id"], 100).collect()) and len(set(picked)) == 100
    bins = sm.value_bins(df, "id", ["id"], 20).groupBy("bin").count().collect()
    assert len(bins) == 20 and all(abs(r["count"] - 250) <= 1 for r in bins)
    hot = df.withColumn("v", F.when(F.col("id") < 4_000, 1.0).when(F.col("id") < 4_990, F.col("id").cast("double")))
    sizes = {r["bin"]: r["count"] for r in sm.value_bins(hot, "v", ["id"], 20).groupBy("bin").count().collect()}
    assert sizes.pop(None) == 10 and len(sizes) == 20 and max(sizes.values()) - min(sizes.values()) <= 1


def test_guards(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, t string")
    with pytest.raises(ValueError, match="missing required"):
        v.require_columns(df, ["k", "zz"])
    with pytest.raises(ValueError, match="no rows"):
        v.require_columns(df.limit(0), ["k"])
    with pytest.raises(ValueError, match="duplicate"):
        v.assert_unique(df, ["k"])
    labelled = spark.createDataFrame([(dt.date(2020, 1, 2), dt.date(2020, 1, 1), "train", 0)], "date date, target_date date, split string, cv_fold int")
    with pytest.raises(ValueError, match="integrity"):
        v.assert_split_integrity(labelled, ["date"])


def test_misaligned_tables_are_refused(spark):
    original = spark.createDataFrame([(i, float(i)) for i in range(50)], "k int, x double")
    shifted = original.select("k", (F.col("x") + F.when(F.col("k") == 7, 1.0).otherwise(0.0)).alias("x_original"), F.col("x").alias("x_capped"), F.lit(0.0).alias("x_minmax"), F.lit(0.0).alias("x_zscore"))
    with pytest.raises(ValueError, match="misaligned"):
        v.aligned_ingest(original, shifted, "k", ["x"])
    with pytest.raises(ValueError, match="misaligned"):
        v.aligned_ingest(original, shifted.where("k <> 7"), "k", ["x"])
