"""Regression forests whose cost follows the rows, however deep the trees are.

A forest that sends a histogram of every node through the shuffle reads all rows once per group of nodes, and
deep trees have as many nodes as rows. Here only nodes of more than ``TASK_ROWS`` drawn rows are split by
histograms that tasks add up. The rows of a smaller node meet in one task, which grows the rest of that tree
level by level. A row travels once per tree that drew it, as one byte a feature. Rows are packed into blocks, and the
draws of a block follow from its number, so every pass repeats them. Grown trees stay in a table; rows
to predict are sent to a few trees at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed, held_for_training

TASK_ROWS = 1 << 21  # drawn rows a task grows a subtree of
SLICE_ROWS = 1 << 19  # rows a task predicts
BLOCK_ROWS = 1 << 16
WALK_ROWS = 1 << 14
NODES_AT_ONCE = 1 << 12  # of which a task holds the splits
NODES_A_PASS = 2048  # histograms a task holds
BATCH_ROWS = 400_000_000  # drawn rows that travel at a time
TREES_A_TASK = 5

NODE = np.dtype([("feature", np.int16), ("code", np.uint8), ("left", np.int32), ("value", np.float64)])  # feature -1: a leaf; right = left + 1
# Poisson draws with mean one by a number of 16 bits.
DRAWN = np.searchsorted(np.cumsum([math.exp(-1) / math.factorial(i) for i in range(9)]), (np.arange(1 << 16) + 0.5) / (1 << 16)).astype(np.uint8)


def leaf(value: float = 0.0) -> np.ndarray:
    return np.array([(-1, 0, -1, value)], NODE)


def walk(tree: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Place of the leaf of each row."""
    step = np.where(tree["feature"] < 0, -1, (tree["left"].astype(np.int64) << 24) | (tree["code"].astype(np.int64) << 16) | tree["feature"])  # one lookup a level
    flat, dims, out = codes.ravel(), codes.shape[1], np.zeros(len(codes), np.int32)
    for first in range(0, len(codes), WALK_ROWS):
        row = np.arange(first, min(first + WALK_ROWS, len(codes)))
        at = np.zeros(len(row), np.int64)
        while len(row):
            here = step[at]
            inner = here >= 0
            if not inner.all():
                out[row[~inner]] = at[~inner]
                row, here = row[inner], here[inner]
            at = (here >> 24) + (flat[row * dims + (here & 0xFFFF)] > ((here >> 16) & 0xFF))
    return out


def draws(seed: int, tree: int, block: int, n: int) -> np.ndarray:
    """How often each row of a block is drawn for a tree."""
    return DRAWN[np.random.default_rng([seed, tree, block]).integers(0, len(DRAWN), n, np.uint16)]


def best_splits(n: np.ndarray, s: np.ndarray, allowed: np.ndarray, min_leaf: int) -> tuple[np.ndarray, ...]:
    """Of nodes with histograms ``n`` (counts) and ``s`` (sums of centred labels), both nodes x features x bins:
    the feature (-1: none), code and gain (spread taken away, times rows) of the best split, and the rows left of it.
    """
    left_n, left_s = n.cumsum(2)[:, :, :-1], s.cumsum(2)[:, :, :-1]
    all_n, all_s = n.sum(2)[:, :, None], s.sum(2)[:, :, None]
    right_n, right_s = all_n - left_n, all_s - left_s
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left_s * left_s / left_n + right_s * right_s / right_n - all_s * all_s / all_n
    gain[(left_n < min_leaf) | (right_n < min_leaf) | ~allowed[:, :, None]] = -np.inf
    flat = gain.reshape(len(n), -1)
    best, row = flat.argmax(1), np.arange(len(n))
    feature, code = np.divmod(best, gain.shape[2])
    found = flat[row, best]
    return np.where(found > 0, feature, -1), code, np.maximum(found, 0), left_n.reshape(len(n), -1)[row, best]


def chosen_features(rng: np.random.Generator, nodes: int, dims: int, subset: int) -> np.ndarray:
    """``subset`` features for each node."""
    return rng.random((nodes, dims)).argsort(1) < subset


def subtree(codes: np.ndarray, w: np.ndarray, y: np.ndarray, depth: int, bins: int, subset: int, min_leaf: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """The tree below one node, ``depth`` levels at most, and the gain of each feature."""
    dims, gains, parts, made = codes.shape[1], np.zeros(codes.shape[1]), [], 1
    at, m = np.zeros(len(codes), np.int64), 1
    for level in range(depth + 1):
        rows = np.bincount(at, w, m)
        mean = np.bincount(at, w * y, m) / rows
        nodes = np.zeros(m, NODE)
        nodes["feature"], nodes["left"], nodes["value"] = -1, -1, mean
        parts.append(nodes)
        wide = np.flatnonzero(rows >= 2 * min_leaf)
        if level == depth or not len(wide):
            break
        slot = np.full(m, -1)
        slot[wide] = np.arange(len(wide))
        keep = slot[at] >= 0
        codes, w, y, at = codes[keep], w[keep], y[keep], at[keep]
        slots, away = slot[at], w * (y - mean[at])
        order, split, taken = chosen_features(rng, len(wide), dims, subset), np.full(len(wide), -1), np.zeros(len(wide))
        code = np.zeros(len(wide), np.int64)
        for f in range(dims):
            cell = slots * bins + codes[:, f]
            n, s = (np.bincount(cell, v, len(wide) * bins).reshape(-1, 1, bins) for v in (w, away))
            for i in range(0, len(wide), NODES_AT_ONCE):
                here = slice(i, i + NODES_AT_ONCE)
                which, at_code, gain, _ = best_splits(n[here], s[here], order[here, f:f + 1], min_leaf)
                better = i + np.flatnonzero((which >= 0) & (gain > taken[here]))
                split[better], code[better], taken[better] = f, at_code[better - i], gain[better - i]
        # A gain that is nothing but rounding is none.
        split[taken <= 1e-12 * np.maximum(rows[wide] * mean[wide] ** 2, 1e-300)] = -1
        inner = np.flatnonzero(split >= 0)
        if not len(inner):
            break
        gains += np.bincount(split[inner], taken[inner], dims)
        made_here = wide[inner]
        nodes["feature"][made_here], nodes["code"][made_here] = split[inner], code[inner]
        nodes["left"][made_here] = made + 2 * np.arange(len(inner))
        child = np.full(len(wide), -1)
        child[inner] = 2 * np.arange(len(inner))
        keep = child[slots] >= 0
        codes, w, y, slots = codes[keep], w[keep], y[keep], slots[keep]
        at = child[slots] + (codes[np.arange(len(codes)), split[slots]] > code[slots])
        m = 2 * len(inner)
        made += m
    return np.concatenate(parts), gains


def grafted(top: np.ndarray, below: dict[int, np.ndarray]) -> np.ndarray:
    """The whole tree: ``below`` replaces leaves of ``top``."""
    parts, size = [top.copy()], len(top)
    for place, tree in sorted(below.items()):
        tree = tree.copy()
        tree["left"][tree["feature"] >= 0] += size - 1
        parts[0][place] = tree[0]
        parts.append(tree[1:])
        size += len(tree) - 1
    return np.concatenate(parts)


def packed(rows: DataFrame, thresholds: list[np.ndarray], value: str) -> DataFrame:
    """Blocks of rows (``row``, ``features``, ``value``): their number, size, codes and values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            row, codes, values = (np.concatenate(c) for c in zip(*held))
            held.clear()
            return pa.record_batch([pa.array([int(row[0])]), pa.array([len(row)]), pa.array([codes.tobytes()]), pa.array([values.tobytes()])], ["block", "n", "codes", "vals"])

        for batch in batches:
            if batch.num_rows:
                x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                codes = np.stack([np.searchsorted(t, x[:, f], "left").astype(np.uint8) for f, t in enumerate(thresholds)], axis=1)
                held.append((batch.column("row").to_numpy(), codes, batch.column(value).to_numpy()))
                if sum(len(h[0]) for h in held) >= BLOCK_ROWS:
                    yield block()
        if held:
            yield block()

    return rows.select("row", "features", value).mapInArrow(run, "block long, n long, codes binary, vals binary")


def _codes(blob: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(blob, np.uint8).reshape(-1, dims)


class SubtreeForest(Model):
    """``thresholds`` of the codes, the top of each tree, and a table of the subtrees below (``tree``, ``place``, ``nodes``)."""

    def __init__(self, thresholds: list[np.ndarray], tops: list[np.ndarray], below: DataFrame, importances: np.ndarray, features: str, prediction: str = "prediction"):
        super().__init__()
        self.thresholds, self.tops, self.below, self.importances, self.features, self.prediction = thresholds, tops, below, importances, features, prediction

    @property
    def featureImportances(self):
        return Vectors.dense(self.importances)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows = checkpointed(dataset).withColumn("_row", F.monotonically_increasing_id())
        tops, dims, trees = self.tops, len(self.thresholds), len(self.tops)
        blocks = checkpointed(packed(rows.select(F.col("_row").alias("row"), vector_to_array(self.features).alias("features")).withColumn("same", F.col("row")), self.thresholds, "same"))
        slices = max(1, math.ceil((blocks.agg(F.sum("n")).first()[0] or 0) / SLICE_ROWS))
        chunks = math.ceil(trees / TREES_A_TASK)
        whole = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        asked = blocks.withColumn("slice", F.pmod(F.xxhash64("block"), F.lit(slices)).cast("int")).withColumn("chunk", whole(chunks))
        known = self.below.withColumn("chunk", F.floor(F.col("tree") / TREES_A_TASK).cast("int")).withColumn("slice", whole(slices))

        def predict(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            if left.empty:
                return pd.DataFrame({"block": [], "vals": [], "total": []})
            first, codes = int(key[0]) * TREES_A_TASK, np.concatenate([_codes(b, dims) for b in left["codes"]])
            total, ends = np.zeros(len(codes)), left["n"].cumsum().to_numpy()
            for t in range(first, min(first + TREES_A_TASK, trees)):
                mine = right[right["tree"] == t]
                tree = grafted(tops[t], {p: np.frombuffer(b, NODE) for p, b in zip(mine["place"], mine["nodes"])})
                total += tree["value"][walk(tree, codes)]
            return pd.DataFrame({"block": left["block"], "vals": left["vals"], "total": [part.tobytes() for part in np.split(total, ends[:-1])]})

        def add(part: pd.DataFrame) -> pd.DataFrame:
            total = np.sum([np.frombuffer(b) for b in part["total"]], axis=0)
            return pd.DataFrame({"_row": np.frombuffer(part["vals"].iloc[0], np.int64), "found": total / trees})

        by = ["chunk", "slice"]
        spread = min(chunks * slices, 4096)
        found = asked.repartition(spread, *by).groupBy(*by).cogroup(known.repartition(spread, *by).groupBy(*by)).applyInPandas(predict, "block long, vals binary, total binary")
        found = found.groupBy("block").applyInPandas(add, f"_row long, found double").withColumnRenamed("found", self.prediction)
        return rows.join(found, "_row").drop("_row")


def fit_subtree_forest(df: DataFrame, trees: int, depth: int, min_leaf: int, share: float, max_bins: int = 64, seed: int = 42,
                       features: str = "features_vector", label: str = "label") -> SubtreeForest:
    """Bootstrap forest by variance: ``share`` of the features a node, ``max_bins`` bins by quantiles, leaves of ``min_leaf`` drawn rows or more."""
    spark = df.sparkSession
    rows = held_for_training(df.select(vector_to_array(features).alias("features"), F.col(label).cast("double").alias("label"))).withColumn("row", F.monotonically_increasing_id())
    dims = rows.select(F.size("features")).first()[0]
    bins = min(max_bins, 256)
    probabilities = [i / bins for i in range(1, bins)]
    cut = rows.select(*[F.col("features")[i].alias(f"x{i}") for i in range(dims)]).approxQuantile([f"x{i}" for i in range(dims)], probabilities, 1 / (8 * bins))
    thresholds = [np.unique(np.array(c, float)) for c in cut]
    blocks = checkpointed(packed(rows, thresholds, "label"))
    n, subset = blocks.agg(F.sum("n")).first()[0], math.ceil(share * dims)
    cores = spark.sparkContext.defaultParallelism

    tops, gains = [leaf() for _ in range(trees)], np.zeros((trees, dims))
    depths = [{0: 0} for _ in range(trees)]
    wide = {t: [0] for t in range(trees)} if n > TASK_ROWS else {}
    small = {t: [] if wide else [0] for t in range(trees)}
    while any(wide.values()):
        asked, fresh = [(t, p) for t, places in wide.items() for p in places], {}
        for first in range(0, len(asked), NODES_A_PASS):
            group: dict[int, list[int]] = {}
            for t, p in asked[first:first + NODES_A_PASS]:
                group.setdefault(t, []).append(p)
            for r in _large_splits(blocks, tops, group, dims, bins, subset, min_leaf, seed).collect():  # a row a node
                tree = tops[r.tree]
                tree["value"][r.place] = r.mean
                if r.feature < 0:
                    continue
                tree["feature"][r.place], tree["code"][r.place], tree["left"][r.place] = r.feature, r.code, len(tree)
                gains[r.tree, r.feature] += r.gain
                tops[r.tree] = np.concatenate([tree, leaf(r.mean), leaf(r.mean)])
                for place, weight in ((len(tree), r.before), (len(tree) + 1, r.rows - r.before)):
                    depths[r.tree][place] = depths[r.tree][r.place] + 1
                    (fresh if weight > TASK_ROWS and depths[r.tree][place] < depth else small).setdefault(r.tree, []).append(place)
        wide = fresh
    batch, below = max(1, int(BATCH_ROWS // max(n, 1))), None
    for first in range(0, trees, batch):
        part = {t: small[t] for t in range(first, min(first + batch, trees)) if small.get(t)}
        if not part:
            continue
        tasks = max(3 * cores, math.ceil(n * len(part) / TASK_ROWS))
        grown = _subtrees(blocks, tops, part, depths, dims, bins, subset, min_leaf, depth, seed, tasks)
        below = grown if below is None else below.unionByName(grown)
    if below is None:
        below = spark.createDataFrame([], "tree int, place int, nodes binary, gains array<double>")
    for r in below.groupBy("tree").agg(*[F.sum(F.col("gains")[f]).alias(f"g{f}") for f in range(dims)]).collect():  # a row a tree
        gains[r["tree"]] += [r[f"g{f}"] for f in range(dims)]
    each = gains / np.maximum(gains.sum(1, keepdims=True), 1e-300)
    total = each.sum(0)
    return SubtreeForest(thresholds, tops, below.drop("gains"), total / max(total.sum(), 1e-300), features)


def _large_splits(blocks: DataFrame, tops: list[np.ndarray], group: dict[int, list[int]], dims: int, bins: int, subset: int, min_leaf: int, seed: int) -> DataFrame:
    """Best split of each node of ``group`` (places by tree) from histograms added up over the tasks."""
    trees = {t: tops[t] for t in group}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {t: np.zeros((2, len(p), dims, bins)) for t, p in group.items()}
        for batch in batches:
            for b, codes, y in zip(batch.column("block").to_pylist(), batch.column("codes").to_pylist(), batch.column("vals").to_pylist()):
                codes, y = _codes(codes, dims), np.frombuffer(y)
                for t, places in group.items():
                    slot = np.full(len(trees[t]), -1)
                    slot[places] = np.arange(len(places))
                    at, w = slot[walk(trees[t], codes)], draws(seed, t, b, len(y))
                    keep = (at >= 0) & (w > 0)
                    at, w, mine = at[keep], w[keep].astype(float), codes[keep]
                    for f in range(dims):
                        cell = at * bins + mine[:, f]
                        for i, v in enumerate((w, w * y[keep])):
                            held[t][i, :, f] += np.bincount(cell, v, len(places) * bins).reshape(-1, bins)
        for t, places in group.items():
            yield pa.record_batch([pa.array(np.full(len(places), t, np.int32)), pa.array(np.array(places, np.int32)), pa.array([held[t][:, i].tobytes() for i in range(len(places))])], ["tree", "place", "table"])

    def split(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        n, s = np.sum([np.frombuffer(b) for b in part["table"]], axis=0).reshape(2, 1, dims, bins)
        rows = n[0, 0].sum()
        mean = s[0, 0].sum() / rows
        rng = np.random.default_rng([seed, int(key[0]), int(key[1]), 1])
        feature, code, gain, before = best_splits(n, s - n * mean, chosen_features(rng, 1, dims, subset), min_leaf)
        return pd.DataFrame({"tree": [key[0]], "place": [key[1]], "feature": feature, "code": code, "gain": gain, "rows": [rows], "before": before, "mean": [mean]})

    tables = blocks.select("block", "codes", "vals").mapInArrow(count, "tree int, place int, table binary")
    return tables.groupBy("tree", "place").applyInPandas(split, "tree int, place int, feature int, code int, gain double, rows double, before double, mean double")


def _subtrees(blocks: DataFrame, tops: list[np.ndarray], group: dict[int, list[int]], depths: list[dict[int, int]], dims: int, bins: int, subset: int, min_leaf: int, depth: int, seed: int, tasks: int) -> DataFrame:
    """The trees below the nodes of ``group`` (places by tree), each grown by one task from the rows of its node."""
    trees = {t: tops[t] for t in group}
    left = {(t, p): depth - depths[t][p] for t, places in group.items() for p in places}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b, codes, y in zip(batch.column("block").to_pylist(), batch.column("codes").to_pylist(), batch.column("vals").to_pylist()):
                codes, y = _codes(codes, dims), np.frombuffer(y)
                for t, places in group.items():
                    w = draws(seed, t, b, len(y))
                    at = walk(trees[t], codes)
                    taken = np.isin(at, places) & (w > 0)
                    order = np.flatnonzero(taken)
                    order = order[at[order].argsort(kind="stable")]
                    found, start = np.unique(at[order], return_index=True)
                    pieces = np.split(order, start[1:]) if len(found) else []
                    yield pa.record_batch([pa.array(np.full(len(found), t, np.int32)), pa.array(found.astype(np.int32)), pa.array([codes[i].tobytes() for i in pieces], pa.binary()),
                                           pa.array([w[i].tobytes() for i in pieces], pa.binary()), pa.array([y[i].tobytes() for i in pieces], pa.binary())], ["tree", "place", "codes", "w", "y"])

    def grow(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        codes = np.concatenate([_codes(b, dims) for b in part["codes"]])
        w = np.concatenate([np.frombuffer(b, np.uint8) for b in part["w"]]).astype(float)
        y = np.concatenate([np.frombuffer(b) for b in part["y"]])
        at = (int(key[0]), int(key[1]))
        nodes, gains = subtree(codes, w, y, left[at], bins, subset, min_leaf, np.random.default_rng([seed, *at]))
        return pd.DataFrame({"tree": [at[0]], "place": [at[1]], "nodes": [nodes.tobytes()], "gains": [gains.tolist()]})

    dealt = blocks.select("block", "codes", "vals").mapInArrow(deal, "tree int, place int, codes binary, w binary, y binary")
    return checkpointed(dealt.repartition(tasks, "tree", "place").groupBy("tree", "place").applyInPandas(grow, "tree int, place int, nodes binary, gains array<double>"))
