"""Fitted preparation steps: fit reads a few numbers per column, transform is one projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clip, number
from .describe import FENCE_FACTOR, smallest_mode
from .ordering import fitted_quantiles


@dataclass
class MedianImputer:
    columns: Sequence[str]
    suffix: str = ""
    values: dict[str, float] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> MedianImputer:
        self.values = {c: q[0] for c, q in fitted_quantiles(df, self.columns, [0.5]).items()}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c + self.suffix: F.coalesce(number(c), F.lit(self.values.get(c)).cast("double")) for c in self.columns})


@dataclass
class ModeImputer:
    columns: Sequence[str]
    suffix: str = ""
    values: dict[str, str] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> ModeImputer:
        self.values = {r["variable"]: r["mode"] for r in smallest_mode(df, self.columns).collect()}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c + self.suffix: F.coalesce(F.col(c), F.lit(self.values.get(c))) for c in self.columns})


@dataclass
class IqrCapper:
    """Limit to the fences of the frame it was fitted on; no row is dropped. A column of nulls has no fences and stays."""

    columns: Sequence[str]
    suffix: str = ""
    fences: dict[str, tuple[float, float]] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> IqrCapper:
        for column, (q1, q3) in fitted_quantiles(df, self.columns, [0.25, 0.75]).items():
            reach = FENCE_FACTOR * (q3 - q1)
            self.fences[column] = (q1 - reach, q3 + reach)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c + self.suffix: clip(number(c), *self.fences.get(c, (None, None))) for c in self.columns})

    def counts(self, df: DataFrame) -> DataFrame:
        """Values below, above and outside the fences per variable."""
        def stats(c: str):
            low, high = (F.lit(v).cast("double") for v in self.fences.get(c, (None, None)))
            return F.struct(
                low.alias("lower_fence"), high.alias("upper_fence"),
                F.count_if(F.col(c) < low).alias("capped_low"), F.count_if(F.col(c) > high).alias("capped_high"),
                F.count_if((F.col(c) < low) | (F.col(c) > high)).alias("capped_count"),
            ).alias(c)

        wide = df.agg(*[stats(c) for c in self.columns])
        return wide.unpivot([], list(self.columns), "variable", "s").select("variable", "s.*")


@dataclass
class MinMaxScaler:
    """To [0, 1]; a constant column becomes 0."""

    columns: Sequence[str]
    suffix: str = "_minmax"
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> MinMaxScaler:
        row = df.agg(*[F.struct(F.min(number(c)), F.max(number(c))).alias(c) for c in self.columns]).first()
        self.ranges = {c: tuple(row[c]) for c in self.columns}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        def scaled(c: str):
            low, high = self.ranges[c]
            value = number(c)
            if low is None or high == low:
                return F.when(value.isNotNull(), F.lit(0.0))
            return (value - low) / (high - low)

        return df.withColumns({c + self.suffix: scaled(c) for c in self.columns})


@dataclass
class ZScaler:
    """Population z-score; a constant column becomes 0."""

    columns: Sequence[str]
    suffix: str = "_zscore"
    stats: dict[str, tuple[float, float]] = field(default_factory=dict)

    def fit(self, df: DataFrame) -> ZScaler:
        row = df.agg(*[F.struct(F.avg(number(c)), F.stddev_pop(number(c))).alias(c) for c in self.columns]).first()
        self.stats = {c: tuple(row[c]) for c in self.columns}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        def scaled(c: str):
            mean, std = self.stats[c]
            value = number(c)
            if not std:
                return F.when(value.isNotNull(), F.lit(0.0))
            return (value - mean) / std

        return df.withColumns({c + self.suffix: scaled(c) for c in self.columns})


def column_stack(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Raw, imputed, capped, min-max and z-score variant of each column; fences from the raw values."""
    raw = df.select(key, *[number(c).alias(f"{c}_raw") for c in columns])
    named = raw.withColumns({c: F.col(f"{c}_raw") for c in columns})
    capper = IqrCapper(columns).fit(named)
    filled = MedianImputer(columns).fit(named).transform(named).withColumns({f"{c}_imputed": F.col(c) for c in columns})
    capped = capper.transform(filled)
    scaled = ZScaler(columns).fit(capped).transform(MinMaxScaler(columns).fit(capped).transform(capped))
    order = [f"{c}_{s}" for c in columns for s in ("raw", "imputed", "capped", "minmax", "zscore")]
    return scaled.withColumns({f"{c}_capped": F.col(c) for c in columns}).select(key, *order)


def quantile_clip(df: DataFrame, columns: Sequence[str], low: float = 0.01, high: float = 0.99) -> DataFrame:
    bounds = fitted_quantiles(df, columns, [low, high])
    return df.withColumns({c: clip(number(c), *bounds.get(c, (None, None))) for c in columns})


def quantile_trim(df: DataFrame, columns: Sequence[str], low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Keep rows whose every column lies within its own quantile bounds, ends included; a column of nulls bounds nothing."""
    bounds = fitted_quantiles(df, columns, [low, high])
    for c in bounds:
        df = df.where(F.col(c).between(*bounds[c]))
    return df


def symmetric_clip(df: DataFrame, column: str, tail: float = 0.005) -> DataFrame:
    """Null to 0, then limit to the larger absolute tail quantile on both sides."""
    filled = df.withColumn(column, F.coalesce(number(column), F.lit(0.0)))
    low, high = fitted_quantiles(filled, [column], [tail, 1 - tail]).get(column, (0.0, 0.0))
    limit = max(abs(low), abs(high))
    return filled.withColumn(column, clip(column, -limit, limit))


def positive_only(df: DataFrame, above_zero: Sequence[str], not_negative: Sequence[str] = ()) -> DataFrame:
    for c in above_zero:
        df = df.where(F.col(c) > 0)
    for c in not_negative:
        df = df.where(F.col(c) >= 0)
    return df


def rounded(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})
