"""Linear dimensionality reduction on vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseMatrix
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOP_LOADINGS = 10


OVERSAMPLE = 10
PASSES = 60
SETTLED = 1e-9


def sparse_rows(df: DataFrame, column: str) -> DataFrame:
    """``indices`` and ``values`` of ML vectors; a dense vector has all its indices."""
    v = F.unwrap_udt(F.col(column))
    every = F.transform(F.sequence(F.lit(0), F.size(v["values"]) - 1), lambda i: i.cast("int"))
    indices = F.when(v["type"] == 0, v["indices"]).when(F.size(v["values"]) > 0, every).otherwise(F.array().cast("array<int>"))
    return df.select(indices.alias("indices"), v["values"].alias("values"))


def flat_rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, value) of every stored entry of a batch."""
    indices, values = batch.column("indices"), batch.column("values")
    sizes = np.diff(indices.offsets.to_numpy())
    return np.repeat(np.arange(len(sizes)), sizes), indices.flatten().to_numpy(), values.flatten().to_numpy()


def products_with(batch: pa.RecordBatch, basis: np.ndarray) -> tuple[np.ndarray, tuple]:
    """The batch's rows times ``basis``, and its entries."""
    row, slot, value = entries = flat_rows(batch)
    out = np.empty((batch.num_rows, basis.shape[1]))
    for c in range(basis.shape[1]):
        out[:, c] = np.bincount(row, value * basis[slot, c], batch.num_rows)
    return out, entries


def added(rows: DataFrame, width: int, height: int, measure: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """Sum of a ``width`` x ``height`` table over all batches; each task hands on one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, height))
        for batch in batches:
            if batch.num_rows:
                total += measure(batch)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total.ravel()[at])], ["at", "v"])

    out = np.zeros(width * height)
    cells = rows.mapInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    out[cells.column("at").to_numpy()] = cells.column("v").to_numpy()
    return out.reshape(width, height)


@dataclass
class TruncatedSvd:
    """Leading right singular vectors of the uncentred matrix, with scores re-standardised.

    A few random directions are multiplied by the rows and back, and made orthogonal, until the space
    they span no longer turns; inside it the singular vectors are an eigenproblem of k + 10 columns.
    A pass reads stored entries only and hands on slots x (k + 10) numbers, so wide one-hot rows stay
    sparse and no slots x slots table exists anywhere.
    """

    k: int
    input_col: str = "vector"
    components: list[list[float]] = field(default_factory=list)
    means: list[float] = field(default_factory=list)
    stds: list[float] = field(default_factory=list)
    explained_ratio: float = 0.0

    @property
    def pc(self) -> DenseMatrix:
        """The components as columns, as Spark's own PCA models have them."""
        weights = np.array(self.components)
        return DenseMatrix(*weights.shape, weights.ravel(order="F").tolist())

    @property
    def model(self) -> TruncatedSvd:
        return self

    def fit(self, df: DataFrame, seed: int = 42) -> TruncatedSvd:
        rows = sparse_rows(df, self.input_col)
        width = df.select(self.input_col).first()[0].size
        size = min(width, self.k + OVERSAMPLE)
        basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(width, size)))[0]
        keep = min(self.k, width - 1)
        last = None
        for _ in range(PASSES):
            def back(batch: pa.RecordBatch, basis=basis) -> np.ndarray:
                y, (row, slot, value) = products_with(batch, basis)
                return np.stack([np.bincount(slot, value * y[row, c], width) for c in range(y.shape[1])], axis=1)
            turned = added(rows, width, size, back)
            # Inside the current space: its own eigenvectors, largest first.
            small = basis.T @ turned
            values, inner = np.linalg.eigh((small + small.T) / 2)
            leading = basis @ inner[:, ::-1][:, :keep]
            residual = turned @ inner[:, ::-1][:, :keep] - leading * values[::-1][:keep]
            last = leading
            if np.sqrt((residual ** 2).sum(0)).max() <= SETTLED * max(values[-1], 1e-300):
                break
            basis = np.linalg.qr(turned)[0]
        flip = np.where(last[np.abs(last).argmax(0), np.arange(keep)] < 0, -1.0, 1.0)
        self.components = (last * flip).tolist()
        stats = self.scored(df).select(
            Summarizer.metrics("mean", "variance", "count").summary(array_to_vector("scores")).alias("s"),
            Summarizer.metrics("variance").summary(F.col(self.input_col)).alias("raw"),
        ).first()
        n = stats["s"]["count"]
        variance = [float(x) for x in stats["s"]["variance"]]
        self.means = [float(x) for x in stats["s"]["mean"]]
        self.stds = [(x * (n - 1) / n) ** 0.5 or 1.0 for x in variance]
        self.explained_ratio = sum(variance) / sum(float(x) for x in stats["raw"]["variance"])
        return self

    def scored(self, df: DataFrame) -> DataFrame:
        """``df`` with ``scores``, the rows times the components."""
        basis = np.array(self.components)

        @F.pandas_udf("array<double>")
        def project(indices: pd.Series, values: pd.Series) -> pd.Series:
            return pd.Series([basis[i].T @ v if len(i) else np.zeros(basis.shape[1]) for i, v in zip(indices, values)])

        v = F.unwrap_udt(F.col(self.input_col))
        every = F.transform(F.sequence(F.lit(0), F.greatest(F.size(v["values"]) - 1, F.lit(0))), lambda i: i.cast("int"))
        return df.withColumn("scores", project(F.coalesce(v["indices"], every), v["values"]))

    def transform(self, df: DataFrame, output_col: str = "features") -> DataFrame:
        """Standardised scores as an array column."""
        scaled = F.array(*[(F.col("scores")[i] - F.lit(m)) / F.lit(s) for i, (m, s) in enumerate(zip(self.means, self.stds))])
        return self.scored(df).withColumn(output_col, scaled).drop("scores")

    def loadings(self, df: DataFrame, names: list[str], top: int = TOP_LOADINGS) -> DataFrame:
        """The ``top`` largest absolute weights of each component."""
        weights = np.array(self.components)
        rows = []
        for component in range(weights.shape[1]):
            column = weights[:, component]
            order = sorted(range(len(column)), key=lambda i: (-abs(column[i]), i))[:top]
            rows += [(component + 1, rank, names[i], float(column[i]), abs(float(column[i]))) for rank, i in enumerate(order, 1)]
        return df.sparkSession.createDataFrame(rows, "component int, rank int, feature string, loading double, absolute_loading double")


def pca_coordinates(df: DataFrame, columns: list[str], key: list[str], k: int = 2) -> tuple[DataFrame, list[float]]:
    """Coordinates on the leading components of already standardised columns, and their variance shares."""
    from pyspark.ml.feature import VectorAssembler

    stats = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    centred = df.select(*key, *[(F.col(c) - F.lit(stats[c])).alias(c) for c in columns])
    vectors = VectorAssembler(inputCols=columns, outputCol="v").transform(centred)
    model = PCA(k=k, inputCol="v", outputCol="scores").fit(vectors.select("v"))
    placed = model.transform(vectors).select(*key, vector_to_array("scores").alias("features"))
    return placed, [float(x) for x in model.explainedVariance]


def feature_space_summary(df: DataFrame, numeric: list[str], categorical: list[str], encoded_width: int, svd: TruncatedSvd) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(len(numeric) + len(categorical)).alias("original_feature_count"), F.lit(len(numeric)).alias("numerical_feature_count"),
        F.lit(len(categorical)).alias("categorical_feature_count"), F.lit(encoded_width).alias("encoded_feature_count"),
        F.lit(len(svd.means)).alias("component_count"), F.lit(svd.explained_ratio).alias("explained_variance_ratio"),
    )
