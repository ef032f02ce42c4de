"""Per-entity window expressions. ``order`` is unique per entity, so a window spans one calendar at most."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def per_entity(entity: str, order: str) -> WindowSpec:
    return Window.partitionBy(entity).orderBy(order)


def per_entity_backward(entity: str, order: str) -> WindowSpec:
    """The same rows, last one first."""
    return Window.partitionBy(entity).orderBy(F.desc(order))


def lag_one(column: str, w: WindowSpec) -> Column:
    return F.lag(column, 1).over(w)


def lead_one(column: str, w: WindowSpec) -> Column:
    return F.lead(column, 1).over(w)


def log_change(column: str, w: WindowSpec, scale: float = 1.0) -> Column:
    """Difference of logs to the previous row."""
    return (F.ln(column) - F.ln(F.lag(column, 1).over(w))) * scale


def percent_change(column: str, w: WindowSpec) -> Column:
    return F.try_divide(F.col(column), F.lag(column, 1).over(w)) - 1


def _rows(w: WindowSpec, first: int, last: int) -> WindowSpec:
    return w.rowsBetween(first, last)


def rolling_mean(column: str, w: WindowSpec, size: int = 20, min_rows: int = 5) -> Column:
    frame = _rows(w, -(size - 1), 0)
    return F.when(F.count(column).over(frame) >= min_rows, F.avg(column).over(frame))


def rolling_std(column: str, w: WindowSpec, size: int = 20, min_rows: int = 5) -> Column:
    frame = _rows(w, -(size - 1), 0)
    return F.when(F.count(column).over(frame) >= min_rows, F.stddev_samp(column).over(frame))


def centred_mean(column: str | Column, w: WindowSpec, size: int = 252, min_rows: int = 60) -> Column:
    """Mean of ``size`` rows around the current one; an even size leans one row to the past."""
    frame = _rows(w, -(size // 2), (size - 1) // 2)
    return F.when(F.count(column).over(frame) >= min_rows, F.avg(column).over(frame))


def detrended_percent(column: str, w: WindowSpec, size: int = 252, min_rows: int = 60) -> Column:
    """Percent deviation from the centred mean of the logs."""
    return (F.exp(F.ln(column) - centred_mean(F.ln(column), w, size, min_rows)) - 1) * 100


def forward_fill(column: str | Column, w: WindowSpec) -> Column:
    return F.last(column, ignorenulls=True).over(_rows(w, Window.unboundedPreceding, 0))


def back_fill(column: str | Column, backward: WindowSpec) -> Column:
    """Next known value. ``backward`` runs from the last row to the first, so the running frame only grows."""
    return F.last(column, ignorenulls=True).over(_rows(backward, Window.unboundedPreceding, 0))


def interpolated(column: str, position: str, w: WindowSpec, backward: WindowSpec) -> Column:
    """Linear in row position between known values; edge runs take the nearest known value."""
    known_at = F.when(F.col(column).isNotNull(), F.col(position))
    before, after = forward_fill(column, w), back_fill(column, backward)
    start, stop = forward_fill(known_at, w), back_fill(known_at, backward)
    blend = before + (after - before) * (F.col(position) - start) / (stop - start)
    return F.when(F.col(column).isNotNull(), F.col(column)).when(before.isNotNull() & after.isNotNull(), blend).otherwise(F.coalesce(before, after))


def running_sum(column: str, w: WindowSpec) -> Column:
    return F.sum(column).over(_rows(w, Window.unboundedPreceding, 0))
