"""Density clustering over a metric index, for more dimensions than a grid can follow.

A leaf no wider than ``eps`` whose surroundings wholly within reach weigh ``min_samples`` is all core
and one piece: its rows are never counted and it takes part in links as one node. Only other leaves
count the neighbours of their rows. Two such leaves are linked without a look at their rows if all of
them are in reach, and otherwise at the first contact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .metric_index import ROOM, MetricIndex, Neighbours, build, compare, matrix, near_leaves, places, products, touches, within


def local_roots(touch: np.ndarray) -> np.ndarray:
    """Column-side component per left row of a boolean contact matrix: a settled minimum over shared contacts."""
    right, far = np.arange(touch.shape[1]), touch.shape[1]
    i, j = places(touch)
    while True:
        left = np.full(touch.shape[0], far)
        np.minimum.at(left, i, right[j])
        merged = right.copy()
        np.minimum.at(merged, j, left[i])
        if np.array_equal(merged, right):
            return left
        right = merged


def core_rows(index: MetricIndex, pairs: DataFrame, eps: float, min_samples: int) -> DataFrame:
    """The index rows with ``is_core``, ``heavy`` (their leaf is one piece) and ``node`` (what links name)."""
    inside = pairs.where(F.col("high") <= eps * (1 - ROOM)).groupBy(F.col("a").alias("leaf")).agg(F.sum("mass_b").alias("around"))
    pieces = index.leaves.where(F.col("radius") * 2 <= eps * (1 - ROOM)).join(inside, "leaf").where(F.col("around") >= min_samples).select("leaf", F.lit(True).alias("heavy"))
    rows = checkpointed(index.rows.join(pieces, "leaf", "left").withColumn("heavy", F.coalesce("heavy", F.lit(False))))
    light = pairs.join(pieces.select(F.col("leaf").alias("a")), "a", "left_anti")

    def count(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        x, y, weight, out = matrix(a), Neighbours(matrix(b)), b["weight"].to_numpy(), np.zeros(len(a), np.int64)
        for _, mine, near in products(a, b, eps):
            there, lines = y.take(near)
            i, j = places(within(x[mine], lines, eps))
            out[mine] = np.bincount(i, weight[there][j], mine.stop - mine.start)  # exact up to 2 ** 53
        return pd.DataFrame({"id": a["id"], "near": out})

    counted = compare(rows.where("not heavy").select("leaf", "id", "features"), rows.select("leaf", "id", "features", "weight"), light, count, "id long, near long")
    full = counted.groupBy("id").agg(F.sum("near").alias("near")).where(F.col("near") >= min_samples).select("id", F.lit(True).alias("full"))
    least = rows.where("heavy").groupBy("leaf").agg(F.min("id").alias("least"))
    rows = rows.join(full, "id", "left").join(least, "leaf", "left")
    return checkpointed(rows.withColumns({"is_core": F.col("heavy") | F.coalesce("full", F.lit(False)), "node": F.coalesce("least", "id")}).drop("full", "least"))


def core_links(rows: DataFrame, pairs: DataFrame, eps: float) -> DataFrame:
    """Links (``a``, ``b``, ``border``): nodes whose cores are in reach, and border rows with the nodes they touch."""
    pieces = rows.where("heavy").groupBy("leaf").agg(F.first("node").alias("node"))
    one, two = (pieces.select(F.col("leaf").alias(c), F.col("node").alias(f"node_{c}")) for c in ("a", "b"))
    kinds = pairs.join(one, "a", "left").join(two, "b", "left")
    solid = F.col("node_a").isNotNull() & F.col("node_b").isNotNull()
    inside = F.col("high") <= eps * (1 - ROOM)
    known = kinds.where(solid & inside & (F.col("a") < F.col("b"))).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), F.lit(False).alias("border"))
    # Heavy leaves meet once, from the smaller; light ones look at all leaves around them.
    open_pairs = kinds.where((solid & ~inside & (F.col("a") < F.col("b"))) | F.col("node_a").isNull()).select("a", "b", "rows_b")

    def link(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        x, y = matrix(a), matrix(b)
        others = Neighbours(y)
        heavy_a, heavy_b, node_a, node_b, core = (f[c].to_numpy() for f, c in ((a, "heavy"), (b, "heavy"), (a, "node"), (b, "node"), (a, "is_core")))
        found = [pd.DataFrame({"a": [], "b": [], "border": []})]
        for name, mine, near in products(a, b, eps):
            if heavy_a[mine.start]:
                met = [node_b[s.start] for other, s in near if other > name and heavy_b[s.start] and touches(x[mine], y[s], eps)]
                found.append(pd.DataFrame({"a": node_a[mine.start], "b": met, "border": False}))
                continue
            there, lines = others.take(near)
            touch, here = within(x[mine], lines, eps), core[mine]
            inner = touch[here]
            if inner.any():
                # A few links keep the connectivity: each left row to one node of its local component, and that component's nodes.
                reached = inner.any(axis=1)
                roots, linked, first = local_roots(inner[reached]), inner.any(axis=0), inner[reached].argmax(axis=0)
                found.append(pd.DataFrame({"a": node_a[mine][here][reached], "b": node_b[there][roots], "border": False}))
                found.append(pd.DataFrame({"a": node_b[there][linked], "b": node_b[there][roots[first[linked]]], "border": False}))
            i, j = places(touch[~here])
            found.append(pd.DataFrame({"a": a["id"].to_numpy()[mine][~here][i], "b": node_b[there][j], "border": True}))
        links = pd.concat(found[1:] or found)
        return links[links["border"].astype(bool) | (links["a"] != links["b"])].drop_duplicates()

    columns = ["leaf", "id", "features", "heavy", "node", "is_core"]
    met = compare(rows.select(*columns), rows.where("is_core").select(*columns), open_pairs, link, "a long, b long, border boolean")
    return checkpointed(known.unionByName(met))


def density_labels(points: DataFrame, eps: float, min_samples: int, leaf_rows: int | None = None) -> DataFrame:
    """``id``, ``cluster`` (null for noise) and ``is_core`` of distinct weighted points (``id, features, weight``)."""
    from .density import connected_components

    index = build(points.select("id", "features", "weight"), leaf_rows=leaf_rows)
    pairs = checkpointed(near_leaves(index, index, eps))
    rows = core_rows(index, pairs, eps, min_samples)
    links = core_links(rows, pairs, eps)
    components = connected_components(links.where("not border").select("a", "b")).withColumnRenamed("id", "node")
    # A heavy leaf's node is its smallest id, so the smallest node of a component names the cluster.
    names = checkpointed(rows.where("is_core").select("node").distinct().join(components, "node", "left").select("node", F.coalesce("component", "node").alias("name")))
    border = links.where("border").select(F.col("a").alias("id"), F.col("b").alias("node")).join(names, "node").groupBy("id").agg(F.min("name").alias("border_name"))
    return rows.join(names, "node", "left").join(border, "id", "left").select(
        "id", F.when(F.col("is_core"), F.col("name")).otherwise(F.col("border_name")).alias("cluster"), "is_core")
