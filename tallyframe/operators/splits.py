"""Reproducible splits and leakage-safe folds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordering import broadcast_if_small, rows_that_fit


def key_digest(key: Sequence[str], seed: int) -> Column:
    """Hex digest of the row key and the seed, the same in any engine that has MD5."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key], F.lit(str(seed))))


def hash_share(key: Sequence[str], seed: int) -> Column:
    """A number in [0, 1) fixed by the row key and the seed, whatever the partitioning."""
    return F.conv(F.substring(key_digest(key, seed), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))


def hash_split(df: DataFrame, key: Sequence[str], test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """``split`` = train / test. The hash ignores labels, so each class keeps its share."""
    return df.withColumn("split", F.when(hash_share(key, seed) < test_share, "test").otherwise("train"))


def stratified_split(df: DataFrame, label: str, key: Sequence[str], test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """As ``hash_split`` with an independent draw inside every class."""
    return hash_split(df, [label, *key], test_share, seed)


SPLIT_BITS = 12


def exact_stratified_split(df: DataFrame, label: str, key: Sequence[str], test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """``split`` with exactly round(share * rows) test rows in every class: those with its smallest key digests.

    Counts by the first bits of the digest show in which 4,096th of a class the last test row lies;
    only those rows are ranked. Rows with equal keys stay on one side, so repeated keys at the edge may
    add to the test side. A null class is a class.
    """
    digest = key_digest([label, *key], seed)
    bucket = F.shiftright(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), 32 - SPLIT_BITS)
    placed = df.select(F.col(label).alias("label"), digest.alias("digest"), bucket.alias("bucket"))
    ahead = Window.partitionBy("label").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("label", "bucket").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumns({"before": F.coalesce(F.sum("n").over(ahead), F.lit(0)), "quota": F.floor(F.sum("n").over(Window.partitionBy("label")) * test_share + 0.5)})
    cuts = counts.where((F.col("before") < F.col("quota")) & (F.col("before") + F.col("n") >= F.col("quota")))
    cuts = cuts.select(F.col("label").alias("at"), F.col("bucket").alias("cut"), (F.col("quota") - F.col("before")).alias("rest"))  # a row a class
    edge = placed.join(broadcast_if_small(cuts, rows_that_fit(4)), F.col("label").eqNullSafe(F.col("at")) & (F.col("bucket") == F.col("cut")))
    ranked = edge.withColumn("place", F.row_number().over(Window.partitionBy("label").orderBy("digest"))).where(F.col("place") == F.col("rest"))
    last = ranked.select(F.col("label").alias("_class"), F.col("digest").alias("_last"))
    joined = df.join(broadcast_if_small(last, rows_that_fit(4)), F.col(label).eqNullSafe(F.col("_class")), "left")
    return joined.withColumn("split", F.when(digest <= F.col("_last"), "test").otherwise("train")).drop("_class", "_last")


def time_split(df: DataFrame, cutoff: str, target_date: str = "target_date") -> DataFrame:
    """Train before the cutoff, test from it on; an empty side is an error."""
    limit = F.lit(cutoff).cast("date")
    split = df.withColumn("split", F.when(F.col(target_date) < limit, "train").when(F.col(target_date) >= limit, "test"))
    sides = df.agg(F.count_if(F.col(target_date) < limit).alias("a"), F.count_if(F.col(target_date) >= limit).alias("b")).first()
    if not sides["a"] or not sides["b"]:
        raise ValueError("the cutoff leaves the train or the test side empty")
    return split.where(F.col("split").isNotNull())


def fold_geometry(n_dates: int, n_splits: int) -> tuple[int, int]:
    """Validation size and position of the first validation date (0-based)."""
    if n_splits < 2:
        raise ValueError("n_splits must be 2 or more")
    if n_dates <= n_splits:
        raise ValueError("not enough dates for the requested folds")
    size = n_dates // (n_splits + 1)
    return size, n_dates - n_splits * size


def fold_calendar(df: DataFrame, n_splits: int, date: str = "target_date") -> DataFrame:
    """Each training date with its position and fold: 0 for the initial block, then 1..n_splits."""
    days = df.select(date).distinct()
    size, start = fold_geometry(days.count(), n_splits)
    placed = days.select(date, (F.row_number().over(Window.orderBy(date)) - 1).alias("position"))
    fold = F.when(F.col("position") < start, 0).otherwise(F.floor((F.col("position") - start) / size) + 1).cast("int")
    return placed.withColumn("cv_fold", fold)


def label_folds(df: DataFrame, n_splits: int, date: str = "target_date") -> DataFrame:
    """Add ``cv_fold`` to a frame with ``split``: folds for train rows, -1 for test rows."""
    folds = fold_calendar(df.where(F.col("split") == "train"), n_splits, date).select(date, "cv_fold")
    fold = F.when(F.col("split") == "test", -1).otherwise(F.col("cv_fold"))
    return df.join(folds, date, "left").withColumn("cv_fold", fold)


def fold_summary(train: DataFrame, n_splits: int, date: str = "target_date") -> DataFrame:
    """Date ranges, date counts and row counts of the training and validation part of every fold."""
    per_day = train.groupBy(date).agg(F.count(F.lit(1)).alias("rows"))
    per_fold = per_day.join(fold_calendar(train, n_splits, date), date).groupBy("cv_fold").agg(
        F.min(date).alias("first_day"), F.max(date).alias("last_day"), F.count(F.lit(1)).alias("days"), F.sum("rows").alias("rows")
    )
    earlier = Window.orderBy("cv_fold").rowsBetween(Window.unboundedPreceding, -1)
    return per_fold.select(
        F.col("cv_fold").alias("fold"),
        F.min("first_day").over(earlier).alias("train_target_start"), F.max("last_day").over(earlier).alias("train_target_end"),
        F.col("first_day").alias("validation_target_start"), F.col("last_day").alias("validation_target_end"),
        F.sum("days").over(earlier).alias("train_unique_dates"), F.col("days").alias("validation_unique_dates"),
        F.sum("rows").over(earlier).alias("train_rows"), F.col("rows").alias("validation_rows"),
    ).where(F.col("fold") > 0)


def row_loss(targeted: DataFrame, features: Sequence[str], cutoff: str, target: str = "target_close_next", target_date: str = "target_date") -> DataFrame:
    """Where rows go between the raw panel and the train and test sets."""
    has_target = F.col(target).isNotNull()
    gap = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in features])
    kept = has_target & F.col(target_date).isNotNull() & ~gap
    early = F.col(target_date) < F.lit(cutoff).cast("date")
    counts = targeted.agg(
        F.count(F.lit(1)).alias("input_rows"), F.count_if(~has_target).alias("removed_no_next_target"),
        F.count_if(gap & has_target).alias("removed_missing_features"), F.count_if(kept).alias("model_ready_rows"),
        F.count_if(kept & early).alias("train_rows"), F.count_if(kept & ~early).alias("test_rows"),
    )
    return counts.withColumns({f"{s}_ratio": F.try_divide(F.col(f"{s}_rows"), F.col("model_ready_rows")) for s in ("train", "test")})


def feature_columns(df: DataFrame, target: str, exclusions: Mapping[str, Sequence[str]] = {}, keep_leaky: bool = False) -> list[str]:
    """Columns a model for ``target`` may see."""
    dropped = {target} | (set() if keep_leaky else set(exclusions.get(target, ())))
    return [c for c in df.columns if c not in dropped]


def in_fold(df: DataFrame, folds: DataFrame, fold: int, date: str = "target_date") -> DataFrame:
    """Rows whose date belongs to one validation fold."""
    return df.join(folds.where(F.col("cv_fold") == fold).select(date), date, "left_semi")
