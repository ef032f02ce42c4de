"""Checks that raise, and audits that return a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import number

# Tolerance of the closeness test |a - b| <= ATOL + RTOL * |b|.
RTOL = 1e-5
ATOL = 1e-8
SENTINEL = "unknown"


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    if df.isEmpty():
        raise ValueError("the input has no rows")
    return df


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    examples = [r.asDict() for r in duplicate_keys(df, keys).limit(5).collect()]
    if examples:
        raise ValueError(f"duplicate keys {list(keys)}, for example {examples}")
    return df


def _is_null(df: DataFrame, column: str) -> Column:
    value = F.col(column)
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def null_census(df: DataFrame, columns: Sequence[str] | None = None, name: str = "missing_count") -> DataFrame:
    """Null and NaN count per column, from one aggregate row."""
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(_is_null(df, c)).alias(c) for c in columns])
    return counts.unpivot([], columns, "variable", name)


def column_overview(df: DataFrame, sentinel: str = SENTINEL) -> DataFrame:
    """Type, distinct values, nulls and sentinel count per column."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    as_text = df.select(*[F.when(~_is_null(df, c), F.col(c).cast("string")).alias(c) for c in df.columns])
    counts = as_text.unpivot([], df.columns, "variable", "value").groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    flagged = F.col("variable").isin(*text) & (F.col("value") == sentinel) if text else F.lit(False)
    types = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    return (
        counts.groupBy("variable")
        .agg(
            F.count("value").alias("unique_count"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("missing_count"),
            F.coalesce(F.sum(F.when(flagged, F.col("n"))), F.lit(0)).alias("unknown_count"),
        )
        .withColumn("data_type", types[F.col("variable")])
    )


def missing_audit(before: DataFrame, after: DataFrame, columns: Sequence[str], sentinel: str = SENTINEL) -> DataFrame:
    """True nulls and sentinel values before cleaning, nulls after it."""
    text = [c for c in columns if isinstance(before.schema[c].dataType, T.StringType)]
    unknown = before.agg(*[(F.count_if(F.col(c) == sentinel) if c in text else F.lit(0).cast("long")).alias(c) for c in columns])
    unknown = unknown.unpivot([], list(columns), "variable", "semantic_unknown_before")
    return (
        null_census(before, columns, "true_null_before")
        .join(unknown, "variable")
        .join(null_census(after, columns, "null_after"), "variable")
    )


def class_distribution(df: DataFrame, targets: Sequence[str]) -> DataFrame:
    """Count and percent per (target, class); null labels are left out."""
    labels = df.select(*[F.col(t).cast("string").alias(t) for t in targets]).unpivot([], list(targets), "target", "class")
    counts = labels.where(F.col("class").isNotNull()).groupBy("target", "class").agg(F.count(F.lit(1)).alias("count"))
    totals = counts.groupBy("target").agg(F.sum("count").alias("total"))
    share = (100.0 * F.col("count") / F.col("total")).alias("percent")
    return counts.join(F.broadcast(totals), "target").select("target", "class", "count", share)


def close(a: Column, b: Column, rtol: float = RTOL, atol: float = ATOL) -> Column:
    """Closeness with equal infinities and matching nulls counted as close."""
    within = F.abs(a - b) <= atol + rtol * F.abs(b)
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise((a == b) | F.coalesce(within, F.lit(False)))


def alignment_audit(original: DataFrame, prepared: DataFrame, key: str, variables: Sequence[str]) -> DataFrame:
    """Compare ``v`` with ``v_original`` by key and summarise the capped and scaled variants.

    ``prepared`` carries ``v_original, v_capped, v_minmax, v_zscore`` for each variable.
    """
    left = original.select(key, *[number(v).alias(v) for v in variables])
    right = prepared.select(
        F.col(key), F.lit(1).alias("in_prepared"),
        *[number(f"{v}_{s}").alias(f"{v}_{s}") for v in variables for s in ("original", "capped", "minmax", "zscore")],
    )
    pairs = left.withColumn("in_original", F.lit(1)).join(right, key, "full")
    matched = F.col("in_original").isNotNull() & F.col("in_prepared").isNotNull()

    def stats(v: str) -> Column:
        capped, raw = F.col(f"{v}_capped"), F.col(v)
        return F.struct(
            F.count(F.lit(1)).alias("rows"),
            F.bool_and(matched & close(raw, F.col(f"{v}_original"))).alias("aligned"),
            F.count_if(capped.isNull()).alias("capped_null"),
            F.min(raw).alias("original_min"), F.max(raw).alias("original_max"),
            F.min(capped).alias("capped_min"), F.max(capped).alias("capped_max"),
            F.count_if(~raw.eqNullSafe(capped)).alias("changed_count"),
            F.min(f"{v}_minmax").alias("minmax_min"), F.max(f"{v}_minmax").alias("minmax_max"),
            F.avg(f"{v}_zscore").alias("zscore_mean"), F.stddev_pop(f"{v}_zscore").alias("zscore_std_population"),
        ).alias(v)

    wide = pairs.agg(*[stats(v) for v in variables])
    return wide.unpivot([], list(variables), "variable", "s").select("variable", "s.*")


def assert_aligned(audit: DataFrame) -> DataFrame:
    bad = audit.where(~F.col("aligned") | (F.col("capped_null") > 0)).select("variable", "aligned").collect()
    if bad:
        raise ValueError(f"tables are misaligned or a capped value is missing: {[r['variable'] for r in bad]}")
    return audit


def aligned_ingest(original: DataFrame, prepared: DataFrame, key: str, variables: Sequence[str]) -> DataFrame:
    """Replace each variable of ``original`` by its capped variant, after the audit passes."""
    assert_aligned(alignment_audit(original, prepared, key, variables))
    capped = prepared.select(key, *[number(f"{v}_capped").alias(f"{v}_capped") for v in variables])
    kept = [F.col(f"{c}_capped").alias(c) if c in variables else F.col(c) for c in original.columns]
    return original.join(capped, key).select(*kept)


def split_integrity(df: DataFrame, required: Sequence[str], date: str = "date", target_date: str = "target_date",
                    split: str = "split", fold: str = "cv_fold") -> DataFrame:
    """One row of leakage and completeness counts for a labelled train/test frame."""
    any_null = reduce(lambda a, b: a | b, [_is_null(df, c) for c in required])
    train, test = F.col(split) == "train", F.col(split) == "test"
    return df.agg(
        F.count_if(any_null).alias("rows_with_nulls"),
        F.count_if(F.col(target_date) <= F.col(date)).alias("target_not_after_feature"),
        F.count_if(~(train | test)).alias("unknown_split"),
        F.count_if(test & (F.col(fold) != -1)).alias("test_rows_with_fold"),
        F.max(F.when(train, F.col(target_date))).alias("train_target_end"),
        F.min(F.when(test, F.col(target_date))).alias("test_target_start"),
    ).withColumn("no_leakage", F.col("train_target_end") < F.col("test_target_start"))


def assert_split_integrity(df: DataFrame, required: Sequence[str], **names: str) -> DataFrame:
    row = split_integrity(df, required, **names).first()
    faults = [c for c in ("rows_with_nulls", "target_not_after_feature", "unknown_split", "test_rows_with_fold") if row[c]]
    if faults or not row["no_leakage"]:
        raise ValueError(f"split integrity failed: {row.asDict()}")
    return df


def scaling_quality(df: DataFrame, variables: Sequence[str]) -> DataFrame:
    """Range of ``v_minmax`` and mean / population deviation of ``v_zscore``."""
    wide = df.agg(*[
        F.struct(
            F.min(f"{v}_minmax").alias("minmax_min"), F.max(f"{v}_minmax").alias("minmax_max"),
            F.avg(f"{v}_zscore").alias("zscore_mean"), F.stddev_pop(f"{v}_zscore").alias("zscore_std_population"),
        ).alias(v)
        for v in variables
    ])
    return wide.unpivot([], list(variables), "variable", "s").select("variable", "s.*")


def first_row_with_null(df: DataFrame, columns: Sequence[str], entity: str, date: str) -> DataFrame:
    """Entity, date and first null column of the earliest row with a null, in (entity, date) order."""
    null_column = F.coalesce(*[F.when(_is_null(df, c), F.lit(c)) for c in columns])
    gaps = df.select(entity, date, null_column.alias("null_column")).where(F.col("null_column").isNotNull())
    return gaps.agg(F.min(F.struct(entity, date, "null_column")).alias("first")).where(F.col("first").isNotNull()).select("first.*")


