"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(links: DataFrame) -> DataFrame:
    """Smallest node of each component: rows (``node``, ``root``) for every node that is not a root.

    ``links`` has two columns ``a`` and ``b`` of one integer type, in any order, repeats allowed.
    Null ends and self links are ignored. Each round hangs a node's larger neighbours, then its
    smaller ones, under the smallest node it sees; the number of rounds grows with the logarithm of
    the longest path. A round's links are written to the shared folder, so lineage stays short and
    no link reaches the driver. Rounds end when the links no longer change.
    """
    state = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    state, seen = written(state, "links"), None
    while (now := _signature(state)) != seen:
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        state, seen = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links"), now
    return state.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _signature(state: DataFrame) -> tuple:
    """Row count and an order-free hash of the links."""
    return tuple(state.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
