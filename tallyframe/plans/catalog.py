"""Registry of the named queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
DIGITS = 6


def tidy(df: DataFrame, digits: int = DIGITS, **special: int) -> DataFrame:
    """Comparable output: rounded doubles, long integers, dates as text."""
    out = []
    for f in df.schema.fields:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            column = F.round(column, special.get(f.name, digits)) + F.lit(0.0)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("long")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("date").cast("string")
        out.append(column.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, doubles: str = "", digits: int = DIGITS, special: Mapping[str, int] = {}):
    """Register a query; ``doubles`` names the SQL columns to round like ``tidy`` does."""
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return tidy(fn(spark, folder), digits, **special)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            rounded = ", ".join(f"round({c}, {special.get(c, digits)}) + 0.0 AS {c}" for c in doubles.split())
            ORACLES[name] = f"SELECT * REPLACE ({rounded}) FROM (\n{sql}\n)" if rounded else sql
        return fn

    return register
