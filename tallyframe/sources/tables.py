"""Readers and writers: Parquet, delimited text, JSON run records, fitted pipelines."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import fields

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAR_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("Name", T.StringType()),
])

CUSTOMER_SCHEMA = T.StructType(
    [T.StructField(c, T.IntegerType() if c in {"age", "balance", "day", "duration", "campaign", "pdays", "previous"} else T.StringType())
     for c in ("age", "job", "marital", "education", "default", "balance", "housing", "loan", "contact", "day",
               "month", "duration", "campaign", "pdays", "previous", "poutcome", "y")]
)


def read_table(spark: SparkSession, folder: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A Parquet table; naming columns keeps the others from being read."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ",",
                   date_format: str = "yyyy-MM-dd", columns: Sequence[str] | None = None) -> DataFrame:
    """Header-first delimited text. Give a schema in production: inference costs one more pass."""
    reader = spark.read.option("header", True).option("sep", sep).option("dateFormat", date_format)
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    return df.select(*columns) if columns else df


def write_delimited(df: DataFrame, path: str, sep: str = ",", date_format: str | None = None, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite").option("header", True).option("sep", sep)
    if date_format:
        writer = writer.option("dateFormat", date_format)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_run_record(spark: SparkSession, record: Mapping[str, object], path: str) -> None:
    """One JSON object describing a run: counts, parameters, means, deviations."""
    spark.createDataFrame([dict(record)]).coalesce(1).write.mode("overwrite").json(path)


def read_run_record(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(path)


def save_model(model: object, path: str) -> None:
    """Save a fitted pipeline or one of the library's own fitted steps, replacing what is there."""
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(path)
    else:
        save_step(model, path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def step_classes() -> dict[str, type]:
    """The library's fitted steps by name."""
    from ..operators import entity_ols, prepare, reduce

    kinds = [entity_ols.EntityOls, entity_ols.FoldOls, prepare.IqrCapper, prepare.MedianImputer, prepare.MinMaxScaler, prepare.ModeImputer, prepare.ZScaler, reduce.TruncatedSvd]
    return {k.__name__: k for k in kinds}


def save_step(step: object, path: str) -> None:
    """Save a fitted step: numbers and names as one JSON line, tables (such as the effects of entities) as Parquet.

    Everything goes through Spark, so the path may be on any file system the cluster reaches.
    """
    name = type(step).__name__
    if name not in step_classes():
        raise ValueError(f"not a step that can be saved: {name}")
    spark = SparkSession.getActiveSession()
    plain, frames = {}, {}
    for f in fields(step):
        value = getattr(step, f.name)
        (frames if isinstance(value, DataFrame) else plain)[f.name] = value
    for key, frame in frames.items():
        frame.write.mode("overwrite").parquet(f"{path}/{key}")
    # Keys of dictionaries may be numbers, which JSON objects cannot have; they are listed as pairs.
    record = {k: {"pairs": [[i, j] for i, j in v.items()]} if isinstance(v, dict) else v for k, v in plain.items()}
    line = json.dumps({"step": name, "values": record, "frames": sorted(frames)})
    spark.createDataFrame([(line,)], "line string").coalesce(1).write.mode("overwrite").text(f"{path}/step")


def load_step(spark: SparkSession, path: str) -> object:
    """A step saved by ``save_step``, in this or any later session."""
    record = json.loads(spark.read.text(f"{path}/step").first()[0])
    values = {k: dict((i, j) for i, j in v["pairs"]) if isinstance(v, dict) and set(v) == {"pairs"} else v for k, v in record["values"].items()}
    return step_classes()[record["step"]](**values, **{k: spark.read.parquet(f"{path}/{k}") for k in record["frames"]})


def daily_bars(ticks: DataFrame, entity: str, time: str = "ts", value: str = "value", tie: str = "event_id") -> DataFrame:
    """Daily open, high, low, close and tick count per entity; (time, tie) decides first and last.

    Every figure combines on the map side, so an entity with most of the ticks costs no more to merge.
    """
    moment = F.struct(time, tie)
    return ticks.groupBy(F.col(entity).cast("string").alias("Name"), F.to_date(time).alias("date")).agg(
        F.min_by(value, moment).alias("open"), F.max(value).alias("high"), F.min(value).alias("low"),
        F.max_by(value, moment).alias("close"), F.count(F.lit(1)).alias("volume"),
    )
