"""Association: correlation, regression lines, binned response."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import number
from ..session import checkpointed
from .ordering import average_ranks, fitted_quantiles


def _square(pairs: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long symmetric matrix from one aggregate row named ``a|b``."""
    entries = [F.struct(F.lit(a).alias("row"), F.lit(b).alias("column"), F.col(f"`{min(a, b)}|{max(a, b)}`").alias("correlation")) for a in columns for b in columns]
    return pairs.select(F.inline(F.array(*entries)))


def pearson(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise-complete correlation of every pair in a single aggregate."""
    values = df.select(*[number(c).alias(c) for c in columns])
    pairs = [(min(a, b), max(a, b)) for a, b in combinations(columns, 2)] + [(c, c) for c in columns]
    return _square(values.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs]), columns)


def grouped_pearson(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The matrix of every group: ``by``, ``row``, ``column``, ``correlation``; null where a column does not vary."""
    values = df.select(*by, *[number(c).alias(c) for c in columns])
    pairs = [(min(a, b), max(a, b)) for a, b in combinations(columns, 2)] + [(c, c) for c in columns]
    wide = values.groupBy(*by).agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    entries = [F.struct(F.lit(a).alias("row"), F.lit(b).alias("column"), F.col(f"`{min(a, b)}|{max(a, b)}`").alias("correlation")) for a in columns for b in columns]
    return wide.select(*by, F.inline(F.array(*entries)))


def spearman(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Correlation of tie-averaged ranks over rows complete in all columns.

    Rows collapse to distinct value combinations before the rank lookups, and a rank table has one
    row per distinct value, so copies of a hot value never multiply.
    """
    complete = df.select(*[number(c).alias(c) for c in columns]).na.drop()
    ranks = checkpointed(average_ranks(complete, columns))  # read once per column
    combos = complete.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    for c in columns:
        lookup = ranks.where(F.col("variable") == c).select(F.col("value").alias(c), F.col("rank").alias(f"{c}_rank"))
        combos = combos.join(lookup, c)
    total = F.sum("n")
    mean = {c: F.sum(F.col("n") * F.col(f"{c}_rank")) / total for c in columns}

    def cross(a: str, b: str) -> Column:
        product = F.sum(F.col("n") * F.col(f"{a}_rank") * F.col(f"{b}_rank")) / total
        return product - mean[a] * mean[b]

    def rank_corr(a: str, b: str) -> Column:
        return F.try_divide(cross(a, b), F.sqrt(cross(a, a) * cross(b, b)))

    pairs = [(min(a, b), max(a, b)) for a, b in combinations(columns, 2)] + [(c, c) for c in columns]
    return _square(combos.agg(*[rank_corr(a, b).alias(f"{a}|{b}") for a, b in pairs]), columns)


def ols_lines(df: DataFrame, predictors: Sequence[str], response: str) -> DataFrame:
    """Slope and intercept of the response on each predictor."""
    values = df.select(*[number(c).alias(c) for c in {*predictors, response}])
    wide = values.agg(*[F.struct(F.regr_slope(response, p).alias("slope"), F.regr_intercept(response, p).alias("intercept")).alias(p) for p in predictors])
    return wide.unpivot([], list(predictors), "predictor", "line").select("predictor", "line.*")


def decile_edges(df: DataFrame, column: str, parts: int = 10) -> list[float]:
    """Equal-frequency edges with repeated edges dropped."""
    edges = fitted_quantiles(df, [column], [i / parts for i in range(parts + 1)]).get(column, [])
    return sorted(set(edges))


def binned_response(df: DataFrame, column: str, outcome: Column, edges: Sequence[float], include_lowest: bool = False) -> DataFrame:
    """Count and outcome mean in right-closed bins; values outside all bins are left out, empty bins too."""
    if not edges:
        return df.sparkSession.createDataFrame([], "bin int, left_edge double, right_edge double, count long, rate double")
    value = number(column)
    bin_number = reduce(lambda a, b: a + b, [(value > F.lit(float(e))).cast("int") for e in edges])
    if include_lowest:
        bin_number = F.when(value == F.lit(float(edges[0])), 1).otherwise(bin_number)
    placed = df.select(bin_number.alias("bin"), outcome.alias("outcome")).where((F.col("bin") >= 1) & (F.col("bin") < len(edges)))
    table = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("count"), F.avg("outcome").alias("rate"))
    limits = F.array(*[F.lit(float(e)) for e in edges])
    return table.select("bin", limits[F.col("bin") - 1].alias("left_edge"), limits[F.col("bin")].alias("right_edge"), "count", "rate")
