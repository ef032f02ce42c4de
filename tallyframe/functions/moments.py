"""Bias-adjusted sample moments on top of the built-in population aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def adjusted_skewness(column: Column | str) -> Column:
    """Adjusted Fisher-Pearson skewness; NULL below three values, 0 for a constant column."""
    n = F.count(column).cast("double")
    g1 = F.skewness(column)
    adjusted = g1 * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))
    return F.when(n >= 3, F.when(F.var_pop(column) == 0, F.lit(0.0)).otherwise(adjusted))


def adjusted_kurtosis(column: Column | str) -> Column:
    """Adjusted excess kurtosis; NULL below four values, 0 for a constant column."""
    n = F.count(column).cast("double")
    g2 = F.kurtosis(column)
    factor = (n - 1) / F.nullif((n - 2) * (n - 3), F.lit(0.0))
    adjusted = factor * ((n + 1) * g2 + 6)
    return F.when(n >= 4, F.when(F.var_pop(column) == 0, F.lit(0.0)).otherwise(adjusted))
