"""Interquartile fences, outlier tables, box-plot figures and examples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .describe import quantile_columns, with_fences
from .ordering import attach, long_form


def iqr_fences(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return with_fences(quantile_columns(df, columns, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by))


def _placed(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), fences: DataFrame | None = None) -> DataFrame:
    fences = iqr_fences(df, columns) if fences is None else fences
    rows = attach(long_form(df, columns, keep), fences, ["variable"])
    low, high = F.col("value") < F.col("lower_fence"), F.col("value") > F.col("upper_fence")
    direction = F.when(low, "low").when(high, "high")
    distance = F.when(high, F.col("value") - F.col("upper_fence")).when(low, F.col("lower_fence") - F.col("value"))
    return rows.withColumn("direction", direction).withColumn("distance_to_bound", distance)


def outlier_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fences, count and share of outliers; the share counts null rows in its base."""
    parameters = ["variable", "q1", "q3", "lower_fence", "upper_fence"]
    return _placed(df, columns).groupBy(*parameters).agg(
        F.count("direction").alias("outlier_count"),
        (F.count("direction") / F.count(F.lit(1))).alias("outlier_share"),
    )


def boxplot_stats(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, whisker ends (extreme values inside the fences) and outlier count."""
    keys = [*by, "variable"]
    rows = attach(long_form(df, columns, by).where(F.col("value").isNotNull()), iqr_fences(df, columns, by), keys)
    inside = F.col("value").between(F.col("lower_fence"), F.col("upper_fence"))
    return rows.groupBy(*keys, "q1", "median", "q3").agg(
        F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
        F.count_if(~inside).alias("outlier_count"),
    )


def top_outliers(df: DataFrame, columns: Sequence[str], key: Sequence[str], n: int = 10) -> DataFrame:
    """The ``n`` values farthest beyond a fence per variable; the key settles ties."""
    rows = _placed(df, columns, key).where(F.col("direction").isNotNull())
    order = Window.partitionBy("variable").orderBy(F.desc("distance_to_bound"), *key)
    return (
        rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)
        .select("variable", "place", *key, "value", "lower_fence", "upper_fence", "distance_to_bound")
    )


def extreme_outliers(df: DataFrame, columns: Sequence[str], key: Sequence[str], context: Sequence[str] = (), n: int = 5) -> DataFrame:
    """Per variable the ``n`` smallest low and ``n`` largest high outliers with context columns."""
    keep = [*key, *[c for c in context if c not in key]]
    rows = _placed(df, columns, keep).where(F.col("direction").isNotNull())
    outward = F.when(F.col("direction") == "low", F.col("value")).otherwise(-F.col("value"))
    order = Window.partitionBy("variable", "direction").orderBy(outward, *key)
    return (
        rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)
        .select("variable", "direction", "place", *keep, "value", "lower_fence", "upper_fence")
    )
