"""Daily panels: calendar gaps, filling, features, snapshots, seasonality.

A panel has one row per (entity, date), so a window over an entity spans one calendar at most,
however the rows are spread over entities.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import windows as win
from ..functions.scalar import TRADING_DAYS_PER_YEAR, calendar_cycle, finite, intraday_range, lower_shadow, upper_shadow
from ..session import checkpointed
from .ordering import exact_quantiles
from .prepare import positive_only

PRICES = ["open", "high", "low", "close"]
BAR_COLUMNS = [*PRICES, "volume"]
CONTEXT_DAYS = 25
CONTEXT_ROWS = 80


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first by ``order``; an aggregate, so copies merge before the shuffle."""
    return _one_per_key(df, keys, F.min_by, order)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _one_per_key(df, keys, F.max_by, order)


def _one_per_key(df: DataFrame, keys: Sequence[str], pick, order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    chosen = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("row"))
    return chosen.select(*keys, "row.*").select(*df.columns)


def entity_series(df: DataFrame, entity: str, name: object, date: str, tie: Sequence[str]) -> DataFrame:
    """One entity's rows with one row per date (the first by ``tie``); order them at the sink."""
    return first_per_key(df.where(F.col(entity) == F.lit(name)), [entity, date], tie)


def calendar(df: DataFrame, date: str = "date") -> DataFrame:
    """Observed dates numbered from 1. Days only, so the ordered set stays tiny at any data size."""
    days = df.where(F.col(date).isNotNull()).select(date).distinct()
    return days.select(date, F.row_number().over(Window.orderBy(date)).alias("day_number"))


def missing_timestamps(df: DataFrame, entity: str = "Name", date: str = "date", within_lifetime: bool = False) -> DataFrame:
    """(entity, date) pairs absent from the panel although the date occurs elsewhere.

    Gaps are read off neighbouring day numbers, so only the missing pairs are generated and the
    entity x date grid is never built.
    """
    days = calendar(df, date)
    last_day = days.agg(F.max("day_number")).scalar()
    seen = df.select(entity, date).where(F.col(entity).isNotNull()).distinct().join(days, date)
    w = win.per_entity(entity, "day_number")
    number, previous = F.col("day_number"), F.lag("day_number").over(w)
    head = F.coalesce(previous, number - 1 if within_lifetime else F.lit(0))
    gap = F.when(number - head > 1, F.sequence(head + 1, number - 1)).otherwise(F.array().cast("array<int>"))
    is_last = F.lead("day_number").over(w).isNull() & F.lit(not within_lifetime)
    runs = seen.select(entity, number.alias("day_number"), gap.alias("gap"), is_last.alias("is_last"))
    tail = F.when(F.col("is_last") & (number < last_day), F.sequence(number + 1, last_day)).otherwise(F.array().cast("array<int>"))
    absent = runs.select(entity, F.explode(F.concat("gap", tail)).alias("day_number"))
    return absent.join(days, "day_number").select(entity, date)


def complete_panel(df: DataFrame, entity: str = "Name", date: str = "date", within_lifetime: bool = False) -> DataFrame:
    """The panel on its full calendar: observed rows plus the missing pairs with null values."""
    known = df.where(F.col(entity).isNotNull() & F.col(date).isNotNull())
    return known.unionByName(missing_timestamps(known, entity, date, within_lifetime), allowMissingColumns=True)


def panel_size(df: DataFrame, entity: str = "Name", date: str = "date") -> DataFrame:
    """Rows, full-grid rows and missing timestamps, from counts alone."""
    counts = df.agg(F.count(F.lit(1)).alias("raw_rows"), F.count_distinct(entity).alias("entities"), F.count_distinct(date).alias("dates"),
                    F.count_distinct(entity, date).alias("pairs"))
    full = F.col("entities") * F.col("dates")
    return counts.select((full - F.col("pairs")).alias("missing_timestamps"), full.alias("full_panel_rows"), "raw_rows")


def most_gapped_entity(df: DataFrame, entity: str = "Name", date: str = "date") -> DataFrame:
    gaps = missing_timestamps(df, entity, date).groupBy(entity).agg(F.count(F.lit(1)).alias("missing"))
    return gaps.orderBy(F.desc("missing"), entity).limit(1)


def fill_panel(panel: DataFrame, columns: Sequence[str] = BAR_COLUMNS, entity: str = "Name", date: str = "date") -> DataFrame:
    """Flag invented rows and interpolate each column inside its entity."""
    w, backward = win.per_entity(entity, date), win.per_entity_backward(entity, date)
    empty = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in columns])
    placed = panel.withColumn("was_missing_timestamp", empty).withColumn("position", F.row_number().over(w))
    placed = placed.withColumns({c: F.col(c).cast("double") for c in columns})
    return placed.withColumns({f"{c}_filled": win.interpolated(c, "position", w, backward) for c in columns}).drop("position")


def panel_features(filled: DataFrame, entity: str = "Name", date: str = "date") -> DataFrame:
    """Logs, log changes, lags and rolling figures of the filled columns."""
    usable = positive_only(filled, [f"{c}_filled" for c in PRICES], ["volume_filled"])
    w = win.per_entity(entity, date)
    logged = usable.withColumns({**{f"log_{c}": F.ln(f"{c}_filled") for c in PRICES}, "log_volume": F.log1p("volume_filled")})
    changed = logged.withColumns({
        **{f"log_return_{c}": F.col(f"log_{c}") - win.lag_one(f"log_{c}", w) for c in PRICES},
        **{f"{c}_lag1": win.lag_one(f"{c}_filled", w) for c in BAR_COLUMNS},
    })
    return changed.withColumns({
        "rolling_close_mean_20": win.rolling_mean("close_filled", w),
        "rolling_volatility_20": win.rolling_std("log_return_close", w),
        "rolling_volume_mean_20": win.rolling_mean("volume_filled", w),
    })


def context_slice(raw: DataFrame, filled: DataFrame, column: str, entity: str = "Name", date: str = "date",
                  days: int = CONTEXT_DAYS, rows: int = CONTEXT_ROWS) -> DataFrame:
    """Raw and filled values around each entity's first missing date, or its last rows when none is missing."""
    first_gap = raw.groupBy(entity).agg(F.min(F.when(F.col(column).isNull(), F.col(date))).alias("gap"))
    latest = Window.partitionBy(entity).orderBy(F.desc(date))
    near = F.col(date).between(F.date_sub("gap", days), F.date_add("gap", days))
    shown = raw.select(entity, date, F.col(column).alias("raw")).withColumn("from_end", F.row_number().over(latest)).join(first_gap, entity)
    shown = shown.where(F.when(F.col("gap").isNotNull(), near).otherwise(F.col("from_end") <= rows))
    return shown.select(entity, date, "raw").join(filled.select(entity, date, F.col(column).alias("filled")), [entity, date], "left")


def next_day_target(df: DataFrame, entity: str = "Name", date: str = "date", value: str = "close") -> DataFrame:
    """Value and date of the entity's next row."""
    w = win.per_entity(entity, date)
    return df.withColumns({"target_close_next": win.lead_one(value, w), "target_date": win.lead_one(date, w)})


def session_features(df: DataFrame, date: str = "date") -> DataFrame:
    """Clustering features of a session: logs, candle shape and cyclic calendar; the close is not used."""
    base = positive_only(df.na.drop(subset=[date, "open", "high", "low", "volume"]), ["open", "high", "low", "volume"])
    shaped = base.withColumns({
        "log_open": F.ln("open"), "log_high": F.ln("high"), "log_low": F.ln("low"), "log_volume": F.log1p("volume"),
        "intraday_range_pct": intraday_range("open", "high", "low"),
        "upper_shadow_pct": upper_shadow("open", "high", "low"),
        "lower_shadow_pct": lower_shadow("open", "high", "low"),
        **calendar_cycle(date),
    })
    # Written once: the filter below would otherwise repeat every logarithm and sine many times a row.
    return checkpointed(shaped).withColumns({c: finite(c) for c in SESSION_FEATURES}).na.drop(subset=SESSION_FEATURES)


SESSION_FEATURES = ["log_open", "log_high", "log_low", "log_volume", "intraday_range_pct", "upper_shadow_pct",
                    "lower_shadow_pct", "month_sin", "month_cos", "dow_sin", "dow_cos"]


def earliest_argmax(value: Column, date: str | Column) -> Column:
    """Date of the largest value; the earliest wins a tie."""
    when = F.col(date) if isinstance(date, str) else date
    return F.min(F.when(value.isNotNull(), F.struct((-value).alias("v"), when.alias("d"))))["d"]


def earliest_argmin(value: Column, date: str | Column) -> Column:
    when = F.col(date) if isinstance(date, str) else date
    return F.min(F.when(value.isNotNull(), F.struct(value.alias("v"), when.alias("d"))))["d"]


def series_snapshot(df: DataFrame, entity: str = "Name", date: str = "date") -> DataFrame:
    """Per entity: span, first and last close, level statistics, extreme volume and returns, close-volume correlation."""
    w = win.per_entity(entity, date)
    returns = df.withColumn("daily_return", win.percent_change("close", w))
    stats = returns.groupBy(entity).agg(
        F.count(F.lit(1)).alias("rows"), F.min(date).alias("date_min"), F.max(date).alias("date_max"),
        F.min_by("close", date).alias("close_start"), F.max_by("close", date).alias("close_end"),
        F.avg("close").alias("close_mean"), F.stddev_samp("close").alias("close_std"),
        F.avg("volume").alias("volume_mean"), F.max("volume").alias("volume_max"),
        earliest_argmax(F.col("volume"), date).alias("volume_max_date"),
        (F.max("daily_return") * 100).alias("max_daily_return_pct"), earliest_argmax(F.col("daily_return"), date).alias("max_daily_return_date"),
        (F.min("daily_return") * 100).alias("min_daily_return_pct"), earliest_argmin(F.col("daily_return"), date).alias("min_daily_return_date"),
        F.corr("close", "volume").alias("close_volume_corr"),
    ).withColumn("close_total_change_pct", (F.try_divide(F.col("close_end"), F.col("close_start")) - 1) * 100)
    middle = exact_quantiles(df, ["close", "volume"], [0.5], [entity]).groupBy(entity).agg(
        *[F.max(F.when(F.col("variable") == c, F.col("q")[0])).alias(f"{c}_median") for c in ("close", "volume")]
    )
    return stats.join(middle, entity)


def volatility_extremes(df: DataFrame, entity: str = "Name", date: str = "date", column: str = "close", size: int = 20) -> DataFrame:
    """Largest annualised rolling volatility and the extreme log changes, with their earliest dates."""
    w = win.per_entity(entity, date)
    change = df.withColumn("change", win.log_change(column, w))
    rolled = change.withColumn("volatility", win.rolling_std("change", w, size, size) * math.sqrt(TRADING_DAYS_PER_YEAR) * 100)
    percent = F.col("change") * 100
    return rolled.groupBy(entity).agg(
        F.max("volatility").alias("max_rolling_volatility_percent"), earliest_argmax(F.col("volatility"), date).alias("max_rolling_volatility_date"),
        F.stddev_samp(percent).alias("daily_log_return_std_percent"),
        F.max(percent).alias("max_daily_log_return_percent"), earliest_argmax(percent, date).alias("max_daily_log_return_date"),
        F.min(percent).alias("min_daily_log_return_percent"), earliest_argmin(percent, date).alias("min_daily_log_return_date"),
    )


def monthly_deviation(df: DataFrame, columns: Sequence[str], entity: str = "Name", date: str = "date", size: int = 252, min_rows: int = 60) -> DataFrame:
    """Mean percent deviation from the centred trend per (entity, month, variable)."""
    w = win.per_entity(entity, date)
    flat = df.select(entity, F.month(date).alias("month"), *[win.detrended_percent(c, w, size, min_rows).alias(c) for c in columns])
    return flat.unpivot([entity, "month"], list(columns), "variable", "deviation").groupBy(entity, "variable", "month").agg(F.avg("deviation").alias("deviation"))


def seasonality(df: DataFrame, columns: Sequence[str], entity: str = "Name", date: str = "date", size: int = 252, min_rows: int = 60) -> DataFrame:
    """Highest and lowest month and the amplitude per (entity, variable)."""
    monthly = monthly_deviation(df, columns, entity, date, size, min_rows)
    value = F.col("deviation")
    return monthly.groupBy(entity, "variable").agg(
        earliest_argmax(value, "month").alias("highest_month"), F.max(value).alias("highest_percent"),
        earliest_argmin(value, "month").alias("lowest_month"), F.min(value).alias("lowest_percent"),
        (F.max(value) - F.min(value)).alias("amplitude_percent"),
    )
