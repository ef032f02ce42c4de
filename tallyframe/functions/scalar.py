"""Column expressions: logs, candles, calendar encoding, labels, intervals."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label thresholds and the 95 % normal quantile.
SYMMETRIC_SKEW = 0.5
STRONG_SKEW = 1.0
LOW_VARIABILITY_PERCENT = 15
MODERATE_VARIABILITY_PERCENT = 30
WILSON_Z = 1.96
LOG10_FLOOR = 1e-9
TRADING_DAYS_PER_WEEK = 5
TRADING_DAYS_PER_YEAR = 252


def _c(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def number(column: Column | str) -> Column:
    """Double with NaN normalised to NULL; text that is not a number becomes NULL."""
    value = _c(column).try_cast("double")
    return F.when(F.isnan(value), None).otherwise(value)


def day(column: Column | str) -> Column:
    """Date, or NULL where the text is not a date."""
    return _c(column).try_cast("date")


def finite(column: Column | str) -> Column:
    """NULL for NaN and both infinities."""
    value = _c(column)
    return F.when(F.isnan(value) | (F.abs(value) == F.lit(float("inf"))), None).otherwise(value)


def sentinel_to_null(column: Column | str, sentinels: tuple[str, ...] = ("unknown",)) -> Column:
    value = _c(column)
    return F.when(~value.isin(*sentinels), value)


def indicator(column: Column | str, positive: object) -> Column:
    """1 where the column equals ``positive``, otherwise 0; NULL counts as 0."""
    return F.coalesce((_c(column) == F.lit(positive)).cast("int"), F.lit(0))


def log10_floored(column: Column | str) -> Column:
    value = number(column)
    return F.when(value.isNotNull(), F.log10(F.greatest(value, F.lit(LOG10_FLOOR))))


def signed_log1p(column: Column | str) -> Column:
    value = _c(column)
    return F.signum(value) * F.log1p(F.abs(value))


def intraday_range(open_: str, high: str, low: str) -> Column:
    return F.try_divide(F.col(high) - F.col(low), F.col(open_))


def upper_shadow(open_: str, high: str, low: str) -> Column:
    """Reach above the larger of open and low; close stays out because it is the target."""
    return F.try_divide(F.col(high) - F.greatest(open_, low), F.col(open_))


def lower_shadow(open_: str, high: str, low: str) -> Column:
    return F.try_divide(F.least(open_, high) - F.col(low), F.col(open_))


def cyclic(position: Column, period: int) -> tuple[Column, Column]:
    angle = position * F.lit(2 * math.pi) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def calendar_cycle(date: Column | str) -> dict[str, Column]:
    """Month on a 12-cycle and weekday (Monday = 0) on a 5-cycle, as sine and cosine."""
    value = _c(date)
    month_sin, month_cos = cyclic(F.month(value), 12)
    dow_sin, dow_cos = cyclic(F.weekday(value), TRADING_DAYS_PER_WEEK)
    return {"month_sin": month_sin, "month_cos": month_cos, "dow_sin": dow_sin, "dow_cos": dow_cos}


def shape_label(skewness: Column | str) -> Column:
    s = _c(skewness)
    return (
        F.when(F.abs(s) < SYMMETRIC_SKEW, "fairly symmetric")
        .when(s >= STRONG_SKEW, "strong right skew")
        .when(s > 0, "moderate right skew")
        .when(s <= -STRONG_SKEW, "strong left skew")
        .when(s.isNotNull(), "moderate left skew")
    )


def variability_label(cv_percent: Column | str) -> Column:
    cv = _c(cv_percent)
    return (
        F.when(cv < LOW_VARIABILITY_PERCENT, "low")
        .when(cv < MODERATE_VARIABILITY_PERCENT, "moderate")
        .when(cv.isNotNull(), "high")
    )


def wilson_interval(rate: Column | str, n: Column | str, z: float = WILSON_Z) -> tuple[Column, Column]:
    """Lower and upper bound of the Wilson score interval of a share."""
    p, count = _c(rate), F.nullif(_c(n).cast("double"), F.lit(0.0))  # no outcomes, no interval
    scale = 1 + z * z / count
    centre = (p + z * z / (2 * count)) / scale
    half = z * F.sqrt(p * (1 - p) / count + z * z / (4 * count * count)) / scale
    return centre - half, centre + half


def clip(column: Column | str, low: Column | float | None, high: Column | float | None) -> Column:
    """Limit to [low, high]; NULL stays NULL (``least``/``greatest`` alone would skip it)."""
    value = _c(column)
    bounded = value
    if low is not None:
        bounded = F.greatest(bounded, low if isinstance(low, Column) else F.lit(float(low)))
    if high is not None:
        bounded = F.least(bounded, high if isinstance(high, Column) else F.lit(float(high)))
    return F.when(value.isNotNull(), bounded)
