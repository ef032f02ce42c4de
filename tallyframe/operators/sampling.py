"""Reproducible samples that do not depend on partitioning, and bounded top-k tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordering import broadcast_if_small, ordered_counts, rows_that_fit
from .splits import key_digest


def group_sample(df: DataFrame, group: str, key: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """At most ``n`` rows per group: those of its smallest key digests.

    The first four characters of the digests are counted first. Only rows up to the count that reaches
    ``n`` are ordered, so no task sorts its whole input, and what a group sends on is hardly more than ``n`` rows.
    """
    digest = key_digest(key, seed)
    head = F.conv(F.substring(digest, 1, 4), 16, 10).cast("int").alias("_head")
    heads = df.select(F.col(group).alias("_group"), head).groupBy("_group", "_head").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("_group").orderBy("_head"))
    last = heads.withColumn("_before", upto - F.col("_n")).where(F.col("_before") < n).groupBy("_group").agg(F.max("_head").alias("_last"))
    low = df.withColumn("_head", head).join(broadcast_if_small(last, rows_that_fit(2)), F.col(group).eqNullSafe(F.col("_group"))).where(F.col("_head") <= F.col("_last"))
    order = Window.partitionBy(group).orderBy(digest, *key)
    return low.withColumn("draw", F.row_number().over(order)).where(F.col("draw") <= n).select(*df.columns)


def uniform_sample(df: DataFrame, key: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """``n`` rows without replacement."""
    return df.orderBy(key_digest(key, seed), *key).limit(n)


def value_bins(df: DataFrame, column: str, key: Sequence[str], bins: int = 20, seed: int = 42) -> DataFrame:
    """Equal-sized bin 1..bins of each row by value; equal values are told apart by the digest of their key.

    A row's place is the rows below its value plus its place among the copies. Copies are numbered in
    256 digest buckets, so a hot value is spread over tasks. Null values have a null bin.
    """
    counts = ordered_counts(df, [column]).select(F.col("value").alias("_value"), "before", "total")
    digest = key_digest(key, seed)
    rows = df.withColumns({"_value": F.col(column).cast("double"), "_digest": digest, "_part": F.conv(F.substring(digest, 1, 2), 16, 10).cast("int")})
    sizes = rows.where(F.col("_value").isNotNull()).groupBy("_value", "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_value").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_value", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")).join(counts, "_value")
    within = F.row_number().over(Window.partitionBy("_value", "_part").orderBy("_digest", *key))
    placed = rows.withColumn("_within", within).join(offsets, ["_value", "_part"], "left")
    place = F.col("before") + F.col("_offset") + F.col("_within")
    return placed.withColumn("bin", F.ceil(place * bins / F.col("total")).cast("int")).select(*df.columns, "bin")


def binned_sample(df: DataFrame, column: str, key: Sequence[str], per_bin: int = 125, bins: int = 20, seed: int = 42) -> DataFrame:
    return group_sample(value_bins(df, column, key, bins, seed), "bin", key, per_bin, seed)


def best_rows(df: DataFrame, order: Sequence, n: int = 1) -> DataFrame:
    return df.orderBy(*order).limit(n)
