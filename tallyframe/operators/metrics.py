"""Scores of predictions and labelings. Each is one aggregate over the rows, then arithmetic on a short table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: smallest denominator of the percentage error (double machine epsilon).
EPSILON = 2.220446049250313e-16


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    error = F.col(predicted) - F.col(actual)
    return (
        df.groupBy(*by).agg(
            F.count(F.lit(1)).alias("rows"), F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"),
            (1 - F.try_divide(F.avg(error * error), F.var_pop(actual))).alias("r2"),
            (F.avg(F.abs(error) / F.greatest(F.abs(actual), F.lit(EPSILON))) * 100).alias("mape_percent"),
        )
    )


def _zero_safe(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def confusion(df: DataFrame, labels: Sequence[object], actual: str = "actual", predicted: str = "predicted", by: Sequence[str] = ()) -> DataFrame:
    """Every (actual, predicted) cell with count and percent of its actual row; empty rows give 0."""
    def cell(a: object, p: object) -> Column:
        return F.struct(
            F.lit(a).alias("actual"), F.lit(p).alias("predicted"),
            F.count_if((F.col(actual) == F.lit(a)) & (F.col(predicted) == F.lit(p))).alias("count"),
            F.count_if((F.col(actual) == F.lit(a)) & F.col(predicted).isin(*labels)).alias("row_total"),
        )

    cells = df.groupBy(*by).agg(F.array(*[cell(a, p) for a in labels for p in labels]).alias("cells"))
    return cells.select(*by, F.inline("cells")).select(
        *by, "actual", "predicted", "count", (_zero_safe(F.col("count"), F.col("row_total")) * 100).alias("row_percent")
    )


def _per_label(df: DataFrame, labels: Sequence[object], actual: str, predicted: str, by: Sequence[str]) -> DataFrame:
    def row(label: object) -> Column:
        is_actual, is_predicted = F.col(actual) == F.lit(label), F.col(predicted) == F.lit(label)
        return F.struct(
            F.lit(label).cast("string").alias("label"), F.count_if(is_actual & is_predicted).alias("hits"),
            F.count_if(is_actual).alias("support"), F.count_if(is_predicted).alias("claimed"),
        )

    counted = df.groupBy(*by).agg(F.array(*[row(v) for v in labels]).alias("rows"), F.count(F.lit(1)).alias("total"))
    table = counted.select(*by, "total", F.inline("rows"))
    precision, recall = _zero_safe(F.col("hits"), F.col("claimed")), _zero_safe(F.col("hits"), F.col("support"))
    table = table.withColumns({"precision": precision, "recall": recall})
    f1 = _zero_safe(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return table.withColumn("f1", f1)


def classification_report(df: DataFrame, labels: Sequence[object], actual: str = "actual", predicted: str = "predicted", by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, f1 and support per class, then accuracy, macro and weighted averages."""
    rows = _per_label(df, labels, actual, predicted, by)
    scores = ["precision", "recall", "f1"]
    classes = rows.select(*by, "label", *scores, F.col("support").cast("long").alias("support"))
    accuracy = F.sum("hits") / F.first("total")
    overall = rows.groupBy(*by).agg(
        F.struct(F.lit("accuracy").alias("label"), *[accuracy.alias(s) for s in scores], F.first("total").alias("support")).alias("a"),
        F.struct(F.lit("macro avg").alias("label"), *[F.avg(s).alias(s) for s in scores], F.sum("support").alias("support")).alias("b"),
        F.struct(
            F.lit("weighted avg").alias("label"),
            *[_zero_safe(F.sum(F.col(s) * F.col("support")), F.sum("support").cast("double")).alias(s) for s in scores], F.sum("support").alias("support"),
        ).alias("c"),
    )
    return classes.unionByName(overall.select(*by, F.inline(F.array("a", "b", "c"))))


def summary_metrics(df: DataFrame, labels: Sequence[object], positive: object, actual: str = "actual", predicted: str = "predicted", by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, balanced accuracy, and precision / recall / f1 of the positive class and macro."""
    rows = _per_label(df, labels, actual, predicted, by)
    yes = F.col("label") == F.lit(str(positive))
    return rows.groupBy(*by).agg(
        F.first("total").alias("rows"), (F.sum("hits") / F.first("total")).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        *[F.max(F.when(yes, F.col(s))).alias(f"{s}_positive") for s in ("precision", "recall", "f1")],
        *[F.avg(s).alias(f"{s}_macro") for s in ("precision", "recall", "f1")],
    )


def generalisation_gap(table: DataFrame, metrics: Sequence[str], by: Sequence[str], split: str = "split") -> DataFrame:
    """Train, test and train minus test of each metric, side by side."""
    at = {s: [F.max(F.when(F.col(split) == s, F.col(m))).alias(f"{m}_{s}") for m in metrics] for s in ("train", "test")}
    wide = table.groupBy(*by).agg(*at["train"], *at["test"])
    return wide.withColumns({f"{m}_gap": F.col(f"{m}_train") - F.col(f"{m}_test") for m in metrics})


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index of two labelings, from their contingency counts."""
    def pairs(n: Column) -> Column:
        return n.cast("double") * (n - 1) / 2

    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    together = cells.agg(F.sum(pairs(F.col("n"))).alias("both"), F.sum("n").alias("total"))
    in_a = cells.groupBy(a).agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n")))).scalar()
    in_b = cells.groupBy(b).agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n")))).scalar()
    figures = together.select("both", pairs(F.col("total")).alias("every"), in_a.alias("in_a"), in_b.alias("in_b"))
    expected = F.try_divide(F.col("in_a") * F.col("in_b"), F.col("every"))
    ceiling = (F.col("in_a") + F.col("in_b")) / 2
    return figures.select(F.coalesce(F.try_divide(F.col("both") - expected, ceiling - expected), F.lit(1.0)).alias("adjusted_rand"))
