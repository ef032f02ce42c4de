"""Descriptive statistics per variable, optionally per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.moments import adjusted_kurtosis, adjusted_skewness
from ..functions.scalar import log10_floored, wilson_interval
from ..session import checkpointed
from .ordering import attach, exact_quantiles, long_form

# Percentiles and fence factor of the report tables.
REPORT_PERCENTILES = [0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99]
SUMMARY_PERCENTILES = [0.01, 0.05, 0.25, 0.50, 0.75, 0.95, 0.99]
FENCE_FACTOR = 1.5
SHOWN_MODES = 10


def pct_name(p: float) -> str:
    return f"p{round(p * 100):02d}"


def moments(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, missing, mean, range, sample variance, skewness and kurtosis in one pass."""
    return (
        long_form(df, columns, by).groupBy(*by, "variable")
        .agg(
            F.count("value").alias("count"),
            F.count_if(F.col("value").isNull()).alias("missing"),
            F.avg("value").alias("mean"),
            F.min("value").alias("min"), F.max("value").alias("max"),
            F.var_samp("value").alias("variance_sample"),
            F.stddev_samp("value").alias("std_sample"),
            adjusted_skewness("value").alias("skewness"),
            adjusted_kurtosis("value").alias("kurtosis_excess"),
        )
        .withColumn("range", F.col("max") - F.col("min"))
        .withColumn("cv_percent", F.try_divide(F.col("std_sample"), F.col("mean")) * 100)
    )


def value_frequencies(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    return (
        long_form(df, columns, by).where(F.col("value").isNotNull())
        .groupBy(*by, "variable", "value").agg(F.count(F.lit(1)).alias("n"))
    )


def modes(df: DataFrame, columns: Sequence[str], shown: int = SHOWN_MODES) -> DataFrame:
    """Most frequent values per variable: none when every value is unique, else the ``shown`` smallest ties.

    Ties are counted where they lie and only the first ``shown`` of them are ever brought together.
    """
    counts = value_frequencies(df, columns)
    top = counts.groupBy("variable").agg(F.max("n").alias("mode_frequency"))
    tied = attach(counts, top, ["variable"]).where((F.col("n") == F.col("mode_frequency")) & (F.col("n") > 1))
    tie_counts = tied.groupBy("variable").agg(F.count(F.lit(1)).alias("tied_modes"))
    place = F.row_number().over(Window.partitionBy("variable").orderBy("value"))
    listed = (
        tied.withColumn("place", place).where(F.col("place") <= shown)
        .groupBy("variable").agg(F.array_sort(F.collect_list("value")).alias("modes"))
    )
    return (
        top.join(tie_counts, "variable", "left").join(listed, "variable", "left")
        .select(
            "variable", "mode_frequency",
            F.array_join(F.transform("modes", lambda v: v.cast("string")), "; ").alias("mode"),
            F.get("modes", F.lit(0)).alias("smallest_mode"),
            F.greatest(F.coalesce("tied_modes", F.lit(0)) - shown, F.lit(0)).alias("modes_not_shown"),
        )
    )


def smallest_mode(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Most frequent value per (by, variable) as text-preserving column ``mode``; ties go to the smallest."""
    labels = df.select(*by, *columns).unpivot(list(by), list(columns), "variable", "mode").where(F.col("mode").isNotNull())
    counts = labels.groupBy(*by, "variable", "mode").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("mode")))
    return counts.groupBy(*by, "variable").agg(best.alias("best")).select(*by, "variable", "best.mode")


def quantile_columns(df: DataFrame, columns: Sequence[str], probs: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles as named columns."""
    wanted = exact_quantiles(df, columns, list(probs.values()), by)
    return wanted.select(*by, "variable", *[F.col("q")[i].alias(n) for i, n in enumerate(probs)])


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), percentiles: Sequence[float] = REPORT_PERCENTILES) -> DataFrame:
    """Moments, quartiles and percentiles per (by, variable)."""
    names = {pct_name(p): p for p in sorted({*percentiles, 0.25, 0.5, 0.75})}
    table = moments(df, columns, by).join(quantile_columns(df, columns, names, by), [*by, "variable"], "left")
    table = table.withColumn("q1", F.col("p25")).withColumn("median", F.col("p50")).withColumn("q3", F.col("p75"))
    return table.withColumn("iqr", F.col("q3") - F.col("q1"))


def describe_with_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return describe(df, columns).join(modes(df, columns), "variable", "left")


def with_fences(table: DataFrame, q1: str = "q1", q3: str = "q3") -> DataFrame:
    spread = F.col(q3) - F.col(q1)
    return (
        table.withColumn("iqr", spread)
        .withColumn("lower_fence", F.col(q1) - FENCE_FACTOR * spread)
        .withColumn("upper_fence", F.col(q3) + FENCE_FACTOR * spread)
    )


def describe_with_outliers(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), percentiles: Sequence[float] = SUMMARY_PERCENTILES) -> DataFrame:
    """Description plus fences and the number of values strictly outside them."""
    keys = [*by, "variable"]
    table = checkpointed(with_fences(describe(df, columns, by, percentiles)))  # a row a group, read twice
    fences = table.select(*keys, "lower_fence", "upper_fence")
    outside = (F.col("value") < F.col("lower_fence")) | (F.col("value") > F.col("upper_fence"))
    counts = attach(long_form(df, columns, by), fences, keys).groupBy(*keys).agg(F.count_if(outside).alias("outlier_count"))
    return table.join(counts, keys, "left")


def stacked(states: Mapping[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """Named states of the data one below the other."""
    parts = [frame.select(F.lit(state).alias("state"), *columns) for state, frame in states.items()]
    return reduce(DataFrame.unionByName, parts)


def before_after(states: Mapping[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """The same statistics for each named state of the data."""
    return describe_with_outliers(stacked(states, columns), columns, ["state"], percentiles=()).select(
        "state", "variable", "count", "missing", "mean", "median", "std_sample", "min", "q1", "q3", "max", "skewness",
        "lower_fence", "upper_fence", "outlier_count",
    )


def raw_filled_log(raw: DataFrame, filled: DataFrame, logged: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, missing, mean and deviation of raw and filled values; deviation and skewness of the logs."""
    def part(frame: DataFrame, prefix: str, kept: Sequence[str]) -> DataFrame:
        short = {"std_sample": "std", "skewness": "skew"}
        return moments(frame, columns).select("variable", *[F.col(c).alias(f"{prefix}_{short.get(c, c)}") for c in kept])

    return (
        part(raw, "raw", ["count", "missing", "mean", "std_sample", "skewness"])
        .join(part(filled, "filled", ["count", "missing", "mean", "std_sample"]), "variable")
        .join(part(logged, "log", ["std_sample", "skewness"]), "variable")
    )


def domain_dispersion(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Five-number summary of the values and seven quantiles of their floored log10."""
    raw = quantile_columns(df, columns, {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0})
    logs = df.select(*[log10_floored(c).alias(c) for c in columns])
    names = {"log_min": 0.0, "log_p01": 0.01, "log_q1": 0.25, "log_median": 0.5, "log_q3": 0.75, "log_p99": 0.99, "log_max": 1.0}
    return raw.join(quantile_columns(logs, columns, names), "variable")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Count and share per non-null value."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.select(column, "count", (F.col("count") / total).alias("share"))


def group_profile(df: DataFrame, by: str, means: Sequence[str] = (), medians: Sequence[str] = ()) -> DataFrame:
    """Size, share, means and exact medians per group."""
    sizes = df.groupBy(by).agg(F.count(F.lit(1)).alias("size"), *[F.avg(c).alias(f"{c}_mean") for c in means])
    total = sizes.agg(F.sum("size")).scalar()
    profile = sizes.withColumn("percent", 100.0 * F.col("size") / total)
    if medians:
        middle = exact_quantiles(df, medians, [0.5], [by]).groupBy(by).agg(
            *[F.max(F.when(F.col("variable") == c, F.col("q")[0])).alias(f"{c}_median") for c in medians]
        )
        profile = profile.join(middle, by, "left")
    return profile


def group_rates_and_tops(df: DataFrame, by: str, rates: Mapping[str, object], tops: Sequence[str]) -> DataFrame:
    """Percent of rows with the positive label per group, and the most common category of each column."""
    shares = df.groupBy(by).agg(
        F.count(F.lit(1)).alias("size"),
        *[(F.avg(F.coalesce((F.col(c) == F.lit(v)).cast("double"), F.lit(0.0))) * 100).alias(f"{c}_rate") for c, v in rates.items()],
    )
    common = smallest_mode(df, tops, [by]).groupBy(by).agg(
        *[F.max(F.when(F.col("variable") == c, F.col("mode"))).alias(f"top_{c}") for c in tops]
    )
    return shares.join(common, by, "left")


def response_rates(df: DataFrame, category: str, outcome: Column, interval: bool = False) -> DataFrame:
    """Mean, sum and count of a 0/1 outcome per category, with the Wilson interval on request."""
    table = df.groupBy(category).agg(
        F.avg(outcome).alias("rate"), F.sum(outcome).cast("long").alias("positives"), F.count(outcome).alias("n")
    )
    if interval:
        low, high = wilson_interval("rate", "n")
        table = table.withColumns({"low": low, "high": high})
    return table


def row_shares(df: DataFrame, rows: str, column: str, values: Sequence[object]) -> DataFrame:
    """Cross-tabulation with every row summing to 1; the values are named so no extra pass finds them."""
    counts = df.where(F.col(column).isin(*values)).groupBy(rows).pivot(column, list(values)).count().na.fill(0)
    total = sum((F.col(f"`{v}`") for v in values), F.lit(0))
    return counts.select(rows, *[(F.col(f"`{v}`") / total).alias(str(v)) for v in values])


def profile_zscores(profile: DataFrame, columns: Sequence[str], log1p: Sequence[str] = ()) -> DataFrame:
    """Z-score of each profile column across the groups (population deviation, 1 where it is 0)."""
    prepared = profile.withColumns({c: F.log1p(c) if c in log1p else F.col(c).cast("double") for c in columns})
    means = {c: prepared.agg(F.avg(c)).scalar() for c in columns}
    spreads = {c: prepared.agg(F.stddev_pop(c)).scalar() for c in columns}
    return prepared.withColumns({c: (F.col(c) - means[c]) / F.when(spreads[c] == 0, 1.0).otherwise(spreads[c]) for c in columns})


def unpivoted(df: DataFrame, ids: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return long_form(df, columns, ids)


def pivoted(df: DataFrame, rows: Sequence[str], column: str, values: Sequence[object], value: str) -> DataFrame:
    return df.groupBy(*rows).pivot(column, list(values)).agg(F.first(value))


def aligned_counts(before: DataFrame, after: DataFrame, column: str) -> DataFrame:
    """Value counts of two states over the union of their values, 0 where one lacks the value."""
    left = value_counts(before, column).select(column, F.col("count").alias("before"))
    right = value_counts(after, column).select(column, F.col("count").alias("after"))
    joined = left.join(right, column, "full")
    return joined.select(column, F.coalesce("before", F.lit(0)).alias("before"), F.coalesce("after", F.lit(0)).alias("after"))
