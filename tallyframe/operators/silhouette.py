"""Silhouettes with plain distances.

The mean distance from a row to a cluster has no short form, so it is estimated from members drawn in
proportion to their size: half by number, half by distance to the cluster's mean. With m the mean and
W(x) the sum of distances from x, n |x - m| <= W(x) and W(m) <= 2 W(x), so a member drawn with
probability p weighs d(x, y) / p <= 6 W(x). About 6 / e**2 draws a cluster therefore estimate
*every* row's mean distance with a root mean square error of at most the share e of it. Clusters that have
no more members than that are taken whole, and with e = 0 all are: then the result is exact and costs
a distance for each pair of rows, compared block by block.

Members of a cluster that fits into a block meet a row together, so of all such clusters in the block only the
row's own and the nearest one go on: what is shuffled does not grow with the number of clusters. Blocks grow with
the table up to eight times ``BLOCK_ROWS`` and ``BLOCK_VALUES`` numbers, so a row travels to a set number of tasks until then.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .cluster import NOISE, squared_distance
from .metric_index import matrix

ERROR = 0.05
BLOCK_ROWS = 4096
BLOCKS, BLOCK_VALUES = 12, 4 << 20  # blocks of rows before they grow; numbers in a large block


def draws(error: float) -> float:
    """Members of a cluster to draw so that each mean distance is off by the share ``error`` at most (root mean square)."""
    return 6.0 / (error * error) if error > 0 else float("inf")


def drawn_members(rows: DataFrame, clusters: DataFrame, error: float, seed: int = 42) -> DataFrame:
    """Members that stand for their cluster (``part``, ``cluster``, ``features``, ``weight``); weights are one over the chance to be drawn.

    The draw hashes ``id``, so it can be repeated. ``clusters`` has ``part``, ``cluster``, ``size``, ``mean``; the size is handed on.
    """
    away = rows.join(clusters, ["part", "cluster"]).withColumn("away", F.sqrt(squared_distance(F.col("features"), F.col("mean"))))
    if error <= 0:
        return away.select("part", "cluster", "id", "features", F.lit(1.0).alias("weight"), "size")
    total = away.groupBy("part", "cluster").agg(F.sum("away").alias("total"))
    share = (1 / F.col("size") + F.coalesce(F.try_divide("away", "total"), 1 / F.col("size"))) / 2
    chance = F.least(F.lit(1.0), share * draws(error))
    number = F.pmod(F.xxhash64(F.lit(seed), "id", "part"), F.lit(1 << 40)) / float(1 << 40)
    return away.join(total, ["part", "cluster"]).withColumn("chance", chance).where(number < F.col("chance")).select(
        "part", "cluster", "id", "features", (1 / F.col("chance")).alias("weight"), "size")


def distance_sums(rows: DataFrame, members: DataFrame, block_rows: int = BLOCK_ROWS, only_nearest: bool = False) -> DataFrame:
    """``part``, ``id``, ``cluster`` and, for each ``other`` cluster, the (estimated) sum of distances ``total``.

    A task compares one block of rows with one block of members of the same part. With ``only_nearest`` other
    clusters may be left out that are not the one of the smallest mean distance.
    """
    def counts(df: DataFrame, name: str, *more) -> DataFrame:
        return df.groupBy("part").agg(F.count(F.lit(1)).alias(name), *more)  # a row a part
    large = F.least(F.lit(8.0 * block_rows), BLOCK_VALUES / F.greatest("dimensions", F.lit(1)))
    wide = F.greatest(F.lit(float(block_rows)), F.least(large, F.col("rows") / BLOCKS))
    sizes = counts(rows, "rows", F.max(F.size("features")).alias("dimensions")).join(counts(members, "members"), "part")
    sizes = F.broadcast(checkpointed(sizes.select("part", *[F.ceil(F.col(c) / wide).cast("long").alias(c) for c in ("rows", "members")])))
    def spread(df: DataFrame, mine: str, others: str, dealt_by) -> DataFrame:
        dealt = df.join(sizes, "part").withColumn(f"block_{mine}", F.pmod(dealt_by, F.col(mine)))
        return dealt.withColumn(f"block_{others}", F.explode(F.sequence(F.lit(0).cast("long"), F.col(others) - 1))).drop("rows", "members")
    by_id = F.xxhash64("id")
    if only_nearest:
        whole = members.groupBy("part", "cluster").agg((F.count(F.lit(1)) <= block_rows).alias("whole"))
        members = members.join(whole, ["part", "cluster"])
        by_id = F.when(F.col("whole"), F.xxhash64("cluster")).otherwise(by_id)
    right = spread(members, "members", "rows", by_id)
    right = right.select(*[F.col(c).alias(c) for c in right.columns])  # columns of its own, as both sides may come from one frame
    keys = ["part", "block_rows", "block_members"]
    id_type, part_type = (rows.schema[c].dataType.simpleString() for c in ("id", "part"))

    def add(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"part": [], "id": [], "cluster": [], "other": [], "total": []})
        b = b.sort_values("cluster", kind="stable", ignore_index=True)
        x, y = matrix(a), matrix(b)
        middle = y.mean(0)
        x, y = x - middle, y - middle
        others, first = np.unique(b["cluster"].to_numpy(), return_index=True)
        weight, mine, ids, part = b["weight"].to_numpy(float), a["cluster"].to_numpy(), a["id"].to_numpy(), a["part"].iloc[0]
        # Nothing but sizes of whole clusters: the others keep all their totals.
        size = np.where(b["whole"].to_numpy(bool), b["size"].to_numpy(float), np.nan)[first] if only_nearest else np.full(len(others), np.nan)
        closed, open_ = np.flatnonzero(~np.isnan(size)), np.flatnonzero(np.isnan(size))
        square, out = (y * y).sum(1), []
        for i in range(0, len(x), 64):
            here = slice(i, i + 64)
            apart = x[here] @ (-2 * y.T)
            apart += (x[here] * x[here]).sum(1)[:, None]
            apart += square
            np.sqrt(np.maximum(apart, 0, out=apart), out=apart)
            apart *= weight
            total = np.add.reduceat(apart, first, axis=1)
            take = np.zeros(total.shape, bool)
            take[:, open_] = True
            if len(closed):
                own = others[closed][None, :] == mine[here][:, None]
                best = np.where(own, np.inf, total[:, closed] / size[closed]).argmin(1)
                own[np.arange(len(own)), best] = True
                take[:, closed] = own
            row, column = np.nonzero(take)
            out.append((row + i, column, total[row, column]))
        row, column, total = (np.concatenate(c) for c in zip(*out))
        return pd.DataFrame({"part": part, "id": ids[row], "cluster": mine[row], "other": others[column], "total": total})

    left = spread(rows, "rows", "members", F.xxhash64("id"))
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(add, f"part {part_type}, id {id_type}, cluster long, other long, total double")
    return found.groupBy("part", "id", "cluster", "other").agg(F.sum("total").alias("total"))


def silhouettes(rows: DataFrame, error: float = ERROR) -> DataFrame:
    """``part``, ``id``, ``cluster``, ``silhouette`` of every row of every labelling (``part``, ``id``, ``cluster``, ``features``).

    Noise is left out, a row alone in its cluster scores 0, and a part with one cluster gives no rows.
    """
    rows = checkpointed(rows.where(F.col("cluster") != NOISE).select("part", "id", F.col("cluster").cast("long").alias("cluster"), F.col("features").cast("array<double>").alias("features")))
    mean = vector_to_array(Summarizer.mean(array_to_vector(F.col("features"))))
    clusters = checkpointed(rows.groupBy("part", "cluster").agg(F.count(F.lit(1)).alias("size"), mean.alias("mean")))
    several = clusters.groupBy("part").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("part")
    rows = rows.join(F.broadcast(several), "part")  # a row a part
    members = checkpointed(drawn_members(rows, clusters, error))
    sizes = clusters.select("part", F.col("cluster").alias("other"), "size")
    totals = distance_sums(rows, members, only_nearest=True).join(sizes, ["part", "other"])
    own = F.col("cluster") == F.col("other")
    means = totals.groupBy("part", "id", "cluster").agg(
        F.max(F.when(own, F.col("size"))).alias("size"), F.max(F.when(own, F.col("total") / F.greatest(F.col("size") - 1, F.lit(1)))).alias("inside"),
        F.min(F.when(~own, F.col("total") / F.col("size"))).alias("outside"))
    widest = F.greatest("inside", "outside")
    score = F.when((F.col("size") == 1) | (widest == 0), F.lit(0.0)).otherwise((F.col("outside") - F.col("inside")) / widest)
    return means.select("part", "id", "cluster", score.alias("silhouette"))


def euclidean_silhouette_points(df: DataFrame, key: str, cluster: str = "cluster", features: str = "features", error: float = ERROR) -> DataFrame:
    """Silhouette of every row: ``key``, ``cluster``, ``silhouette``. A row's is off by about twice ``error`` at most."""
    rows = df.select(F.lit(0).alias("part"), F.col(key).alias("id"), F.col(cluster).alias("cluster"), F.col(features).alias("features"))
    return silhouettes(rows, error).select(F.col("id").alias("key"), "cluster", "silhouette")


def euclidean_silhouette(df: DataFrame, key: str, cluster: str = "cluster", features: str = "features", error: float = ERROR) -> DataFrame:
    """Mean silhouette; null with fewer than two clusters."""
    return euclidean_silhouette_points(df, key, cluster, features, error).agg(F.avg("silhouette").alias("silhouette"))
