import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import describe as d
from tallyframe.operators import frequency as fq
from tallyframe.operators import outliers as o
from tallyframe.operators import prepare as p
from tallyframe.operators import relate as rel
from tallyframe.operators.ordering import average_ranks, exact_quantiles, ordered_counts

PROBS = [0.0, 0.01, 0.25, 0.5, 0.77, 0.99, 1.0]


def frame(spark, n=60_000, parts=7, seed=1):
    """A third of one column is a single hot value; another has a long tail; some cells are null or NaN."""
    rng = np.random.default_rng(seed)
    hot = np.where(rng.random(n) < 0.34, 7.0, rng.normal(0, 3, n))
    tail = np.exp(rng.normal(0, 4, n))
    gappy = np.where(rng.random(n) < 0.1, np.nan, rng.integers(0, 50, n).astype(float))
    pdf = pd.DataFrame({"id": range(n), "g": np.where(rng.random(n) < 0.9, "a", "b"), "hot": hot, "tail": tail, "gappy": gappy})
    return spark.createDataFrame(pdf).repartition(parts), pdf


@pytest.fixture(scope="module")
def big(spark):
    df, pdf = frame(spark)
    return df.persist(), pdf


@pytest.mark.parametrize("small_rows", [0, 10**6])
def test_quantiles_match_numpy(big, small_rows):
    df, pdf = big
    for row in exact_quantiles(df, ["hot", "tail", "gappy"], PROBS, small_rows=small_rows).collect():
        assert np.allclose(row["q"], np.nanquantile(pdf[row["variable"]], PROBS), rtol=1e-12)


@pytest.mark.parametrize("small_rows", [0, 10**6])
def test_grouped_quantiles(big, small_rows):
    df, pdf = big
    got = {(r["g"], r["variable"]): r["q"] for r in exact_quantiles(df, ["hot", "tail"], PROBS, ["g"], small_rows=small_rows).collect()}
    for (g, c), q in got.items():
        assert np.allclose(q, np.quantile(pdf.loc[pdf.g == g, c], PROBS), rtol=1e-12)
    assert len(got) == 4


def test_quantiles_do_not_depend_on_partitions(big):
    df, _ = big
    one = exact_quantiles(df.coalesce(1), ["tail"], [0.333], small_rows=0).first()["q"]
    assert one == exact_quantiles(df.repartition(13), ["tail"], [0.333], small_rows=0).first()["q"]


def test_quantiles_of_tiny_empty_and_infinite_columns(spark):
    df = spark.createDataFrame([(1.0, None, float("inf")), (4.0, None, 2.0), (2.0, None, 3.0)], "a double, b double, c double")
    for small_rows in (0, 10):
        got = {r["variable"]: r["q"] for r in exact_quantiles(df, ["a", "b", "c"], [0.0, 0.5], small_rows=small_rows).collect()}
        assert got == {"a": [1.0, 2.0], "c": [2.0, 3.0]}
    assert exact_quantiles(df, ["b"], [0.5]).collect() == []


def test_ordered_counts_and_ranks(big):
    df, pdf = big
    rows = ordered_counts(df, ["hot", "gappy"]).toPandas()
    for name, part in rows.groupby("variable"):
        part = part.sort_values("value")
        counts = pdf[name].dropna().value_counts().sort_index()
        assert np.array_equal(part["n"], counts.to_numpy())
        assert np.array_equal(part["before"], counts.cumsum().to_numpy() - counts.to_numpy())
        assert (part["total"] == counts.sum()).all()
    ranks = average_ranks(df, ["hot"]).toPandas().set_index("value")["rank"]
    want = pd.Series(pdf["hot"].rank().to_numpy(), index=pdf["hot"]).groupby(level=0).first()
    assert np.allclose(ranks.sort_index(), want.sort_index())


def test_description_matches_pandas(big):
    df, pdf = big
    got = d.describe(df, ["hot", "gappy"]).toPandas().set_index("variable")
    for c in ("hot", "gappy"):
        s = pdf[c]
        assert got.loc[c, "count"] == s.count() and got.loc[c, "missing"] == s.isna().sum()
        for name, value in (("mean", s.mean()), ("std_sample", s.std()), ("skewness", s.skew()), ("kurtosis_excess", s.kurt()), ("p95", s.quantile(0.95))):
            assert np.isclose(got.loc[c, name], value, rtol=1e-9)


def test_degenerate_columns(spark):
    df = spark.createDataFrame([(5.0, None, float(i)) for i in range(3)], "flat double, empty double, few double")
    got = d.describe(df, ["flat", "empty", "few"]).toPandas().set_index("variable")
    assert got.loc["flat", "skewness"] == 0 and got.loc["flat", "variance_sample"] == 0
    assert got.loc["empty", "count"] == 0 and pd.isna(got.loc["empty", "median"])
    assert pd.isna(got.loc["few", "kurtosis_excess"])
    assert fq.frequency_table(df, ["flat"]).first()["frequency"] == 3
    assert p.MinMaxScaler(["flat"]).fit(df).transform(df).first()["flat_minmax"] == 0
    assert p.ZScaler(["flat"]).fit(df).transform(df).first()["flat_zscore"] == 0


def test_modes(spark):
    df = spark.createDataFrame([(float(i % 15), float(i)) for i in range(30)], "tied double, unique double")
    got = {r["variable"]: r for r in d.modes(df, ["tied", "unique"]).collect()}
    assert got["tied"]["mode_frequency"] == 2 and got["tied"]["modes_not_shown"] == 5 and got["tied"]["smallest_mode"] == 0
    assert got["unique"]["mode_frequency"] == 1 and got["unique"]["mode"] is None


def test_fence_values_are_not_outliers(spark):
    # quartiles 1 and 3: fences -2 and 6
    df = spark.createDataFrame([(v,) for v in (-2.0, 1.0, 1.0, 2.0, 3.0, 3.0, 6.0)], "v double")
    row = o.outlier_summary(df, ["v"]).first()
    assert (row["lower_fence"], row["upper_fence"], row["outlier_count"]) == (-2.0, 6.0, 0)


def test_frequency_table_matches_pandas_cut(big):
    df, pdf = big
    got = fq.frequency_table(df, ["gappy"]).toPandas().sort_values("class_number")
    x = pdf["gappy"].dropna()
    k = int(np.ceil(1 + 3.322 * np.log10(len(x))))
    want = pd.cut(x, bins=np.linspace(x.min(), x.max(), k + 1), include_lowest=True).value_counts(sort=False)
    assert np.array_equal(got["frequency"], want.to_numpy()) and got["cumulative_frequency"].iloc[-1] == len(x)


def test_histogram_matches_numpy(big):
    df, pdf = big
    got = fq.histogram(df, ["hot"], 28).toPandas().sort_values("bin")
    assert np.array_equal(got["count"], np.histogram(pdf["hot"], bins=28)[0])


def test_spearman_matches_pandas(big):
    df, pdf = big
    got = rel.spearman(df, ["hot", "tail", "gappy"]).toPandas().pivot(index="row", columns="column", values="correlation")
    want = pdf[["hot", "tail", "gappy"]].dropna().rank().corr()
    assert np.allclose(got.loc[want.index, want.columns], want, atol=1e-9)


def test_capping_keeps_rows_and_limits(big):
    df, pdf = big
    capper = p.IqrCapper(["tail"]).fit(df)
    capped = capper.transform(df)
    low, high = capper.fences["tail"]
    row = capped.agg(F.count("tail"), F.min("tail"), F.max("tail")).first()
    assert row[0] == len(pdf) and row[1] >= low and row[2] <= high
    assert capper.counts(df).first()["capped_high"] == (pdf["tail"] > high).sum()


def test_decile_edges_drop_repeats(spark):
    df = spark.createDataFrame([(0.0,)] * 90 + [(float(i),) for i in range(10)], "v double")
    edges = rel.decile_edges(df, "v")
    assert edges == sorted(set(edges)) and edges[0] == 0
    table = rel.binned_response(df, "v", F.lit(1.0), edges, include_lowest=True)
    assert table.agg(F.sum("count")).first()[0] == 100


def test_group_sample_orders_few_rows(spark):
    """Null groups, repeated keys and small groups; only rows with low digests reach the ordering."""
    from tallyframe.operators import sampling as sm
    from tallyframe.operators.splits import key_digest

    df = spark.range(6000).select((F.col("id") % 5000).alias("k"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 3 == 1, "b").when(F.col("id") < 20, "c").alias("g"))
    got = sm.group_sample(df, "g", ["k"], 50)
    rows = df.withColumn("d", key_digest(["k"], 42)).toPandas()
    for group, part in rows.groupby("g", dropna=False):
        want = part.sort_values(["d", "k"])["k"].head(50).tolist()
        assert sorted(r.k for r in got.where(F.col("g").eqNullSafe(F.lit(None if pd.isna(group) else group))).collect()) == sorted(want)
    assert got.columns == df.columns and "_head" in got._jdf.queryExecution().optimizedPlan().toString()
