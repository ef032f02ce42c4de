"""Inputs derived from the given tables, each with the SQL that derives the same rows.

The tables hold no nulls and no ``unknown`` labels, so both are planted by the same rule on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import daily_bars, read_table

LINE_COLUMNS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
BARS = ["open", "high", "low", "close", "volume"]
CUTOFF = "2024-01-24"
ORDER_CUTOFF = "2000-01-01"


def planted(column: str, key: str):
    return F.when(F.pmod(F.col(key), F.lit(17)) != 0, F.col(column))


def lines(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", "l_discount", planted("l_tax", "l_orderkey").alias("l_tax"), "l_returnflag", "l_linestatus")


LINES = """li AS (SELECT l_orderkey, l_quantity, l_extendedprice, l_discount,
  CASE WHEN l_orderkey % 17 <> 0 THEN l_tax END AS l_tax, l_returnflag, l_linestatus FROM lineitem)"""


def customers(spark: SparkSession, folder: str) -> DataFrame:
    segment = F.when(F.col("c_mktsegment") == "MACHINERY", "unknown").otherwise(F.col("c_mktsegment"))
    return read_table(spark, folder, "customer").select("c_custkey", "c_nationkey", planted("c_acctbal", "c_custkey").alias("c_acctbal"), segment.alias("c_mktsegment"))


CUSTOMERS = """cu AS (SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 17 <> 0 THEN c_acctbal END AS c_acctbal,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'unknown' ELSE c_mktsegment END AS c_mktsegment FROM customer)"""


def orders(spark: SparkSession, folder: str) -> DataFrame:
    priority = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "unknown").otherwise(F.col("o_orderpriority"))
    return read_table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", planted("o_totalprice", "o_orderkey").alias("o_totalprice"), priority.alias("priority"), "o_orderstatus",
        F.when(F.col("o_orderstatus") == "F", "yes").otherwise("no").alias("y"), F.to_date("o_orderdate").alias("day"),
    )


ORDERS = """od AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 17 <> 0 THEN o_totalprice END AS o_totalprice,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'unknown' ELSE o_orderpriority END AS priority, o_orderstatus,
  CASE WHEN o_orderstatus = 'F' THEN 'yes' ELSE 'no' END AS y, CAST(o_orderdate AS DATE) AS day FROM orders)"""


def bars(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars per user: gaps in the calendar, no null cell."""
    return daily_bars(read_table(spark, folder, "events", ["event_id", "ts", "user_id", "value"]), "user_id")


def type_bars(spark: SparkSession, folder: str) -> DataFrame:
    return daily_bars(read_table(spark, folder, "events", ["event_id", "ts", "event_type", "value"]), "event_type")


def status_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Years of daily bars of order value per order status."""
    ticks = read_table(spark, folder, "orders", ["o_orderkey", "o_orderdate", "o_orderstatus", "o_totalprice"])
    return daily_bars(ticks, "o_orderstatus", "o_orderdate", "o_totalprice", "o_orderkey")


def _bars_sql(name: str, table: str, entity: str, time: str, value: str, tie: str) -> str:
    order = f"ORDER BY {time}, {tie}"
    return f"""{name} AS (SELECT CAST({entity} AS VARCHAR) AS "Name", CAST({time} AS DATE) AS date,
  first({value} {order}) AS open, max({value}) AS high, min({value}) AS low, last({value} {order}) AS close,
  count(*) AS volume FROM {table} GROUP BY 1, 2)"""


BARS_SQL = _bars_sql("bars", "events", "user_id", "ts", "value", "event_id")
TYPE_BARS_SQL = _bars_sql("bars", "events", "event_type", "ts", "value", "event_id")
STATUS_BARS_SQL = _bars_sql("bars", "orders", "o_orderstatus", "o_orderdate", "o_totalprice", "o_orderkey")


def gappy_bars(spark: SparkSession, folder: str) -> DataFrame:
    """Daily bars per user with planted null cells in high and volume."""
    df = bars(spark, folder)
    hole = F.pmod(F.dayofyear("date") + F.col("Name").cast("long"), F.lit(11)) == 0
    return df.withColumns({"high": F.when(~hole, F.col("high")), "volume": F.when(~hole, F.col("volume"))})


GAPPY_SQL = BARS_SQL.replace("bars AS", "whole AS") + """,
bars AS (SELECT "Name", date, open, CASE WHEN (dayofyear(date) + CAST("Name" AS BIGINT)) % 11 <> 0 THEN high END AS high, low, close,
  CASE WHEN (dayofyear(date) + CAST("Name" AS BIGINT)) % 11 <> 0 THEN volume END AS volume FROM whole)"""


def targeted_sql(source: str) -> str:
    return source + """,
targeted AS (SELECT *, lead(close) OVER w AS target_close_next, lead(date) OVER w AS target_date
  FROM bars WINDOW w AS (PARTITION BY "Name" ORDER BY date))"""


def long_sql(table: str, columns: list[str], keep: str = "") -> str:
    lead = f"{keep}, " if keep else ""
    return " UNION ALL ".join(f"SELECT {lead}'{c}' AS variable, CAST({c} AS DOUBLE) AS value FROM {table}" for c in columns)


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features"), F.col("label").cast("long").alias("label"))


VECTORS = "ve AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS features, CAST(label AS BIGINT) AS label FROM embeddings)"
