"""A metric index for distance joins in any number of dimensions.

Pivots are chosen farthest first from a bounded sample; they steer the work and never the result. Every
row goes to its nearest pivot, and what a pivot holds is halved, each time between two far rows, until
a leaf has a few hundred rows. A leaf keeps its centre and radius. By the triangle inequality two leaves
are at least ``d - r1 - r2`` and at most ``d + r1 + r2`` apart, so leaf pairs out of reach are never
compared, and pairs wholly within reach need no comparison either. Pivots are paired the same way
first, so leaves far from each other do not even meet in a join.

Leaf pairs are compared in tasks of bounded size: a bundle of neighbouring leaves with a slice of the
leaves near it. A large table makes about ``BUNDLES`` bundles, so that a row travels to a set number of tasks
however many rows there are, until bundles have the size of a slice. Tasks return summaries per row, never pairs.

Distances come from one matrix product first. Only the rows that may be among the nearest by it, or within
reach, are measured dimension by dimension, so results are the same as if all were.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpointed
from .cluster import squared_distance

LEAF_ROWS = 256
GROUP_ROWS = 16_384  # rows that are halved into leaves together
PIVOT_ROWS = 8_192
MAX_PIVOTS = 2_048
SAMPLE_ROWS = 16_384
BUNDLE_LEAVES = 8  # at least
BUNDLES = 24
CHUNK_ROWS = 2_048  # of the right side that are compared at once
SLICE_ROWS = 16_384
IN_PLACE_ROWS, IN_PLACE_VALUES = 8_192, 4 << 20  # a table so small travels to the queries; no index is built
ROOM = 1e-9  # relative slack of bounds; distances themselves are compared exactly


def matrix(frame: pd.DataFrame) -> np.ndarray:
    return np.vstack(frame["features"].to_numpy()).astype(float) if len(frame) else np.zeros((0, 1))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances, summed dimension by dimension as SQL does it."""
    total = np.zeros((len(a), len(b)))
    for d in range(a.shape[1]):
        step = a[:, d][:, None] - b[:, d][None, :]
        total += step * step
    return np.sqrt(total)


def places(found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of what is true; far faster than ``nonzero`` on a matrix with little of it."""
    return np.divmod(np.flatnonzero(found.ravel()), found.shape[1]) if found.size else (np.zeros(0, int), np.zeros(0, int))


class Lines:
    """Rows to measure distances to, with what every product with them needs."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows, self.middle = rows, rows.mean(0) if len(rows) else 0.0
        y = rows - self.middle
        self.lengths = (y * y).sum(1)
        self.longest = self.lengths.max(initial=0)
        self.whole = np.hstack([-2 * y, np.ones((len(y), 1)), self.lengths[:, None]])
        self.short = None

    def squares(self, a: np.ndarray, want: float = 0.0) -> Iterator[tuple[int, np.ndarray, float]]:
        """Squared distances from matrix products, some rows at a time: first row, squares, how far they may be off.

        Single precision will do where what it may be off is little beside ``want``.
        """
        x = a - self.middle
        lengths = (x * x).sum(1)
        scale = lengths.max(initial=0) + self.longest
        x, lines, slack = np.hstack([x, lengths[:, None], np.ones((len(x), 1))]), self.whole, 1e-11 * scale
        rounding = 4 * (x.shape[1] + 8) * 2.0**-24 * scale  # each term and each step of a sum, terms up to twice the scale
        if 1e-25 < rounding <= 1e-3 * want < 1e30:
            if self.short is None:
                self.short = self.whole.astype(np.float32)
            x, lines, slack = x.astype(np.float32), self.short, rounding
        for start in range(0, len(lines), CHUNK_ROWS):
            yield start, x @ lines[start:start + CHUNK_ROWS].T, slack


class Neighbours:
    """Rows of a right side by the leaves they are taken from; the last ones are kept, as the next leaf often meets the same."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows, self.near, self.lines = rows, None, None

    def take(self, near: list[tuple[int, slice]]) -> tuple[np.ndarray, Lines]:
        if near != self.near:
            self.near, self.there = near, joined(near)
            self.lines = Lines(self.rows[self.there])
        return self.there, self.lines


def lines_of(b: np.ndarray | Lines) -> Lines:
    return b if isinstance(b, Lines) else Lines(b)


def exact(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The distances of some pairs, summed dimension by dimension as SQL does it."""
    total = np.zeros(len(i))
    for d in range(a.shape[1]):
        step = a[i, d] - b[j, d]
        total += step * step
    return np.sqrt(total)


def within(a: np.ndarray, b: np.ndarray | Lines, eps: float) -> np.ndarray:
    """Which distances are at most ``eps``. One matrix product decides all but those on the edge."""
    b = lines_of(b)
    near = np.zeros((len(a), len(b.rows)), bool)
    for start, square, slack in b.squares(a, eps * eps):
        slack += 1e-11 * eps * eps
        found = square <= eps * eps + slack
        i, j = places(found)
        edge = square[i, j] >= eps * eps - slack
        if edge.any():
            i, j = i[edge], j[edge]
            found[i, j] = exact(a, b.rows, i, j + start) <= eps
        near[:, start:start + square.shape[1]] = found
    return near


def pairs_within(a: np.ndarray, b: np.ndarray | Lines, eps: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of ``a`` and of ``b`` at most ``eps`` apart and their distances, some rows of ``b`` at a time."""
    b = lines_of(b)
    for start, square, slack in b.squares(a, eps * eps):
        i, j = places(square <= eps * eps + slack + 1e-11 * eps * eps)
        d = exact(a, b.rows, i, j + start)
        here = d <= eps
        yield i[here], j[here] + start, d[here]


def nearest_pairs(a: np.ndarray, b: np.ndarray | Lines, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers and distances of at least the ``k`` nearest rows of ``b`` of every row of ``a``, all ties included."""
    b = lines_of(b)
    count = len(b.rows)
    k = min(k, count)
    if k == count or not (np.isfinite(a).all() and np.isfinite(b.rows).all()):
        i, j = np.indices((len(a), count)).reshape(2, -1)
        return i, j, exact(a, b.rows, i, j)
    edge, found = np.full(len(a), np.inf), []
    first, square, slack = next(b.squares(a))
    if square.shape[1] > k:
        edge = np.partition(square, k - 1, axis=1)[:, k - 1] + 2 * slack
    for start, square, slack in b.squares(a, max(0.0, edge.min()) if np.isfinite(edge).all() else 0.0):
        i, j = places(square <= (edge + 2 * slack)[:, None])
        found.append((i, j + start, square[i, j]))
    i, j, square = (np.concatenate(c) for c in zip(*found))
    order = np.lexsort((square, i))
    i, j, square = i[order], j[order], square[order]
    first = np.searchsorted(i, np.arange(len(a)))
    may_be = square <= square[first + k - 1][i] + 2 * slack
    i, j = i[may_be], j[may_be]
    return i, j, exact(a, b.rows, i, j)


def touches(a: np.ndarray, b: np.ndarray, eps: float, chunk: int = 256) -> bool:
    """Whether any row of ``a`` is within ``eps`` of any of ``b``; stops at the first contact."""
    return any(within(a[i:i + chunk], b, eps).any() for i in range(0, len(a), chunk))


def farthest_first(x: np.ndarray, count: int) -> np.ndarray:
    """``count`` rows, each the farthest from those before it; fewer if the rows run out."""
    picked = [0]
    away = ((x - x[0]) ** 2).sum(1)
    while len(picked) < min(count, len(x)):
        best = int(away.argmax())
        if away[best] == 0:
            break
        picked.append(best)
        away = np.minimum(away, ((x - x[best]) ** 2).sum(1))
    return x[picked]


def halved(x: np.ndarray, size: int) -> list[np.ndarray]:
    """Row numbers of each leaf: rows are halved between two far ones until at most ``size`` are left."""
    out, open_parts = [], [np.arange(len(x))]
    while open_parts:
        part = open_parts.pop()
        if len(part) <= size:
            out.append(part)
            continue
        here = x[part]
        far = here[((here - here.mean(0)) ** 2).sum(1).argmax()]
        from_far = ((here - far) ** 2).sum(1)
        lean = from_far - ((here - here[from_far.argmax()]) ** 2).sum(1)
        order = part[np.argsort(lean, kind="stable")]
        open_parts += [order[len(order) // 2:], order[:len(order) // 2]]
    return out


@dataclass
class MetricIndex:
    """``rows``: the indexed columns with ``leaf``. ``leaves``: ``leaf``, ``pivot``, ``centre``,
    ``radius``, ``span`` (no row is farther from the pivot), ``rows``, ``mass`` (sum of weights)."""

    rows: DataFrame
    leaves: DataFrame
    pivots: np.ndarray


def choose_pivots(points: DataFrame) -> np.ndarray:
    """Farthest-first pivots of at most ``SAMPLE_ROWS`` rows, taken by hash; one per 8,192 rows, 2,048 at most."""
    count = min(MAX_PIVOTS, max(1, -(-points.count() // PIVOT_ROWS)))
    sample = points.select("features", F.xxhash64("features").alias("order")).orderBy("order", "features").limit(SAMPLE_ROWS)
    return farthest_first(np.array([r["features"] for r in sample.collect()], float), count)


def build(points: DataFrame, pivots: np.ndarray | None = None, leaf_rows: int | None = None, group_rows: int | None = None) -> MetricIndex:
    """Index ``points`` (``id``, ``features``, optionally ``weight``, and columns to carry), not empty."""
    if "weight" not in points.columns:
        points = points.withColumn("weight", F.lit(1).cast("long"))
    pivots = choose_pivots(points) if pivots is None else pivots
    leaf_rows, group_rows = leaf_rows or LEAF_ROWS, group_rows or GROUP_ROWS
    squares = (pivots ** 2).sum(1)

    @F.pandas_udf("int")
    def nearest(features: pd.Series) -> pd.Series:
        x, out = np.vstack(features.to_numpy()), []
        for i in range(0, len(x), 4096):
            out.append((squares[None, :] - 2 * (x[i:i + 4096] @ pivots.T)).argmin(1))
        return pd.Series(np.concatenate(out).astype("int32"))

    placed = checkpointed(points.withColumn("pivot", nearest("features")))
    sizes = placed.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / group_rows).cast("long").alias("parts"))  # a row a pivot
    placed = placed.join(F.broadcast(sizes), "pivot").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))).drop("parts")
    extra = [T.StructField("leaf", T.LongType()), T.StructField("centre", T.ArrayType(T.DoubleType())), T.StructField("radius", T.DoubleType()), T.StructField("span", T.DoubleType())]
    schema = T.StructType([*placed.schema.fields, *extra])

    def grow(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id", ignore_index=True)
        x, home = matrix(frame), pivots[frame["pivot"].iloc[0]]
        first = (int(frame["pivot"].iloc[0]) << 40) + (int(frame["part"].iloc[0]) << 20)
        leaf, centre, radius, span = np.zeros(len(x), np.int64), [None] * len(x), np.full(len(x), np.nan), np.full(len(x), np.nan)
        for n, rows in enumerate(halved(x, leaf_rows)):
            middle = x[rows].mean(0)
            leaf[rows], centre[rows[0]] = first + n, middle
            radius[rows[0]] = np.sqrt(((x[rows] - middle) ** 2).sum(1).max()) * (1 + ROOM)
            span[rows[0]] = np.sqrt(((x[rows] - home) ** 2).sum(1).max()) * (1 + ROOM)
        return frame.assign(leaf=leaf, centre=centre, radius=radius, span=span)[schema.names]

    grown = checkpointed(placed.groupBy("pivot", "part").applyInPandas(grow, schema))
    heads = grown.where("centre is not null").select("leaf", "pivot", "centre", "radius", "span")
    figures = grown.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows"), F.sum("weight").alias("mass"))
    return MetricIndex(grown.select("leaf", *points.columns), checkpointed(heads.join(figures, "leaf")), pivots)


def near_leaves(left: MetricIndex, right: MetricIndex, reach: float | None = None) -> DataFrame:
    """Leaf pairs that may hold rows within ``reach`` of each other, or within the left leaf's own column ``reach``.

    Rows: ``a``, ``b``, ``high`` (no two rows of the pair are farther apart), ``reach``, ``rows_a``, ``rows_b``, ``mass_b``.
    """
    limit = F.lit(float(reach)) if reach is not None else F.col("reach")
    spans = {r["pivot"]: (r["span"], r["reach"]) for r in left.leaves.groupBy("pivot").agg(F.max("span").alias("span"), F.max(limit).alias("reach")).collect()}
    others = {r["pivot"]: r["span"] for r in right.leaves.groupBy("pivot").agg(F.max("span").alias("span")).collect()}  # a row a pivot each
    p, q = np.array(sorted(spans)), np.array(sorted(others))
    apart = np.sqrt(np.maximum(0, ((left.pivots[p] ** 2).sum(1))[:, None] + ((right.pivots[q] ** 2).sum(1))[None, :] - 2 * left.pivots[p] @ right.pivots[q].T))
    most = np.array([sum(spans[i]) for i in p])[:, None] + np.array([others[i] for i in q])[None, :]
    i, j = np.nonzero(apart * (1 - ROOM) <= most * (1 + ROOM) + 1e-6 * np.abs(left.pivots).max(initial=0))
    pairs = left.rows.sparkSession.createDataFrame(pd.DataFrame({"pivot": p[i].astype("int32"), "other": q[j].astype("int32")}))
    a = left.leaves.select("pivot", F.col("leaf").alias("a"), F.col("centre").alias("centre_a"), F.col("radius").alias("radius_a"), F.col("rows").alias("rows_a"), limit.alias("reach"))
    b = right.leaves.select(F.col("pivot").alias("other"), F.col("leaf").alias("b"), F.col("centre").alias("centre_b"), F.col("radius").alias("radius_b"), F.col("rows").alias("rows_b"), F.col("mass").alias("mass_b"))
    met = a.join(pairs, "pivot").join(b, "other").withColumn("between", F.sqrt(squared_distance(F.col("centre_a"), F.col("centre_b"))))
    both = F.col("radius_a") + F.col("radius_b")
    near = met.where(F.col("between") * (1 - ROOM) - both <= F.col("reach") * (1 + ROOM))
    return near.select("a", "b", ((F.col("between") + both) * (1 + ROOM)).alias("high"), "reach", "rows_a", "rows_b", "mass_b")


def compared(pairs: DataFrame, left: MetricIndex, right: MetricIndex) -> DataFrame:
    """How many row pairs the leaf pairs stand for, and how many there would be without an index."""
    whole = left.leaves.agg(F.sum("rows")).first()[0] * right.leaves.agg(F.sum("rows")).first()[0]
    return pairs.agg(F.coalesce(F.sum(F.col("rows_a") * F.col("rows_b")), F.lit(0)).alias("compared"), F.lit(whole).alias("all_pairs"))


def in_leaves(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Leaf numbers, where each leaf ends, centres and radii of rows sorted by leaf."""
    x, leaf = matrix(frame), frame["leaf"].to_numpy()
    starts = np.flatnonzero(np.diff(leaf, prepend=leaf[0] - 1))
    bounds = np.append(starts, len(leaf))
    centre = np.add.reduceat(x, starts, axis=0) / np.diff(bounds)[:, None]
    away = np.sqrt(((x - np.repeat(centre, np.diff(bounds), axis=0)) ** 2).sum(1))
    return leaf[starts], bounds, centre, np.maximum.reduceat(away, starts) * (1 + ROOM)


def products(a: pd.DataFrame, b: pd.DataFrame, reach: float | np.ndarray) -> Iterator[tuple[int, slice, list[tuple[int, slice]]]]:
    """Each leaf of ``a`` and its rows with the leaves of ``b`` in reach; both frames are sorted by leaf."""
    (names, ends, centre, radius), (others, stops, middle, width) = in_leaves(a), in_leaves(b)
    apart = distances(centre, middle) * (1 - ROOM) - radius[:, None] - width[None, :]
    reach = np.maximum.reduceat(reach, ends[:-1])[:, None] if isinstance(reach, np.ndarray) else reach
    for i, row in enumerate(apart <= reach * (1 + ROOM)):
        near = [(int(others[j]), slice(stops[j], stops[j + 1])) for j in np.flatnonzero(row)]
        if near:
            yield int(names[i]), slice(ends[i], ends[i + 1]), near


def joined(near: list[tuple[int, slice]]) -> np.ndarray:
    """Row numbers of several leaves."""
    return np.concatenate([np.arange(s.start, s.stop) for _, s in near])


def compare(left: DataFrame, right: DataFrame, pairs: DataFrame, run: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """``run`` on every bundle of left leaves with each slice of the right leaves paired with any of them.

    ``left`` and ``right`` are index rows, perhaps only some. ``run`` gets frames sorted by ``leaf``
    that are never empty. A task holds at most a bundle and about ``SLICE_ROWS`` rows.
    """
    sizes = {r["pivot"]: r["n"] for r in left.groupBy(F.shiftright("leaf", 40).alias("pivot")).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a pivot
    target = max(BUNDLE_LEAVES * LEAF_ROWS, min(SLICE_ROWS, sum(sizes.values()) // BUNDLES))
    groups, full = [], 0
    for pivot, n in sorted(sizes.items()):  # small pivots share a bundle, large ones are cut into several
        if n < target:
            groups.append((int(pivot), -1 - full // target))
            full += n
    shared = F.broadcast(left.sparkSession.createDataFrame(groups, "pivot long, together long"))

    def bundled(df: DataFrame, leaf: str) -> DataFrame:
        placed = df.withColumn("pivot", F.shiftright(leaf, 40)).join(shared, "pivot", "left")
        return placed.withColumn("bundle", F.coalesce("together", F.floor(F.col(leaf) / max(BUNDLE_LEAVES, target // LEAF_ROWS)))).drop("pivot", "together")

    need = checkpointed(bundled(pairs, "a").select("bundle", "b", "rows_b").distinct())
    sizes = need.groupBy("bundle").agg(F.ceil(F.sum("rows_b") / max(SLICE_ROWS, target)).cast("long").alias("slices"))
    need = need.join(sizes, "bundle").select("bundle", F.pmod(F.xxhash64("b"), F.col("slices")).alias("slice"), "b")
    lefts = bundled(left, "leaf").join(sizes, "bundle")
    lefts = lefts.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1))).drop("slices")
    rights = right.join(need, right["leaf"] == need["b"]).drop("b")
    # Both sides may come from one frame, so the right columns get identities of their own.
    rights = rights.select(*[F.col(c).alias(c) for c in rights.columns])
    empty = pd.DataFrame({part.split()[0]: [] for part in schema.split(", ")})

    def both(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return empty
        return run(a.sort_values(["leaf", "id"], ignore_index=True), b.sort_values(["leaf", "id"], ignore_index=True))

    return lefts.groupBy("bundle", "slice").cogroup(rights.groupBy("bundle", "slice")).applyInPandas(both, schema)


def held(points: DataFrame) -> pd.DataFrame | None:
    """The points themselves if they are few enough to travel to any number of queries, else nothing."""
    first = points.select(F.size("features").alias("n")).first()
    limit = min(IN_PLACE_ROWS, IN_PLACE_VALUES // max(1, first["n"] if first else 1))
    rows = points.limit(limit + 1).toPandas()
    return rows.sort_values("id", ignore_index=True) if len(rows) <= limit else None


def in_place(queries: DataFrame, run: Callable[[np.ndarray, np.ndarray], pd.DataFrame], schema: str) -> DataFrame:
    """``run(ids, matrix)`` on the queries where they are, some hundred at a time."""
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), 512):
                part = batch.iloc[i:i + 512]
                yield run(part["id"].to_numpy(), matrix(part))

    return queries.select("id", "features").mapInPandas(scan, schema)


def nearest_one(a: np.ndarray, b: np.ndarray | Lines, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest row of ``b``, of the smallest name on ties, of every row of ``a``, and its distance."""
    i, j, d = nearest_pairs(a, b, 1)
    order = np.lexsort((names[j], d, i))
    first = order[np.searchsorted(i[order], np.arange(len(a)))]
    return j[first], d[first]


def nearest(queries: DataFrame, points: DataFrame, eps: float) -> DataFrame:
    """``id``, ``distance``, ``point``, ``label`` of each query's nearest point within ``eps``, the smallest id on ties.

    ``queries`` has ``id`` and ``features``, ``points`` also ``label``; queries without such a point are left out.
    """
    if (few := held(points)) is not None:
        known, names, labels = Lines(matrix(few)), few["id"].to_numpy(), few["label"].to_numpy()
        def look(ids: np.ndarray, x: np.ndarray) -> pd.DataFrame:
            best, d = nearest_one(x, known, names)
            found = pd.DataFrame({"id": ids, "distance": d, "point": names[best], "label": labels[best]})
            return found[found["distance"] <= eps]
        return in_place(queries, look, "id long, distance double, point long, label long")
    right = build(points)
    left = build(queries, right.pivots)

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        x, y, ids, labels = matrix(a), Neighbours(matrix(b)), b["id"].to_numpy(), b["label"].to_numpy()
        out = []
        for _, rows, near in products(a, b, eps):
            there, lines = y.take(near)
            best, d = nearest_one(x[rows], lines, ids[there])
            out.append(pd.DataFrame({"id": a["id"].to_numpy()[rows], "distance": d, "point": ids[there][best], "label": labels[there][best]}))
        found = pd.concat(out) if out else pd.DataFrame({"id": [], "distance": [], "point": [], "label": []})
        return found[found["distance"] <= eps]

    hits = compare(left.rows, right.rows, near_leaves(left, right, eps), run, "id long, distance double, point long, label long")
    return hits.groupBy("id").agg(F.min(F.struct("distance", "point", "label")).alias("best")).select("id", "best.*")


def smallest(a: np.ndarray, b: np.ndarray | Lines, weight: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row of ``a``, the smallest distances to rows of ``b`` that weigh ``k`` together: row numbers, distances, weights."""
    i, j, d = nearest_pairs(a, b, k)
    order = np.lexsort((d, i))
    i, d, heavy = i[order], d[order], weight[j[order]]
    total = np.cumsum(heavy) - heavy
    needed = total - total[np.searchsorted(i, i)] < k
    return i[needed], d[needed], heavy[needed]


def kth_of(local: DataFrame, k: int) -> DataFrame:
    """``id`` and ``distance`` of the k-th nearest row, from the nearest ones of every task (``id``, ``distance``, ``weight``)."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("at"))
    def add(a: Column, p: Column) -> Column:
        n = a["n"] + p["weight"]
        return F.struct(n.alias("n"), F.when(a["at"].isNull() & (n >= k), p["distance"]).otherwise(a["at"]).alias("at"))
    near = local.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("distance", "weight"))).alias("near"))
    return near.select("id", F.aggregate("near", start, add, lambda a: a["at"]).alias("distance"))


def kth(points: DataFrame, queries: DataFrame, k: int, cap: float | None = None, leaf_rows: int | None = None) -> DataFrame:
    """``id``, ``distance``: from each query to its ``k``-th nearest row, copies counted by ``weight``.

    Queries are null where the table has fewer than ``k`` rows, or, with ``cap``, none within it.
    """
    if (few := held(points)) is not None:
        known, weight = Lines(matrix(few)), few["weight"].to_numpy()
        def look(ids: np.ndarray, x: np.ndarray) -> pd.DataFrame:
            i, d, w = smallest(x, known, weight, k)
            near = pd.DataFrame({"i": i, "distance": d, "upto": w})
            near["upto"] = near.groupby("i")["upto"].cumsum()
            at = near[near["upto"] >= k].groupby("i")["distance"].first()
            out = np.full(len(ids), np.nan)
            out[at.index.to_numpy(int)] = at.to_numpy()
            out[out > (np.inf if cap is None else cap)] = np.nan
            return pd.DataFrame({"id": ids, "distance": out})
        kind = queries.schema["id"].dataType.simpleString()
        return in_place(queries, look, f"id {kind}, distance double").select("id", F.nullif(F.col("distance"), F.lit(float("nan"))).alias("distance"))
    right = build(points, leaf_rows=leaf_rows)
    left = build(queries.withColumn("weight", F.lit(1).cast("long")), right.pivots, leaf_rows)
    return queries.select("id").join(kth_in(left, right, k, cap), "id", "left")


def kth_in(left: MetricIndex, right: MetricIndex, k: int, cap: float | None = None) -> DataFrame:
    """``kth`` between two indexes; queries without a result may be left out.

    A first round compares each leaf with the closest leaves that hold ``k`` rows. The largest distance
    found there bounds how far the second, full round has to look.
    """
    id_type = left.rows.schema["id"].dataType.simpleString()
    if (right.leaves.agg(F.sum("mass")).first()[0] or 0) < k:
        return left.rows.select("id", F.lit(None).cast("double").alias("distance"))

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        x, y, weight, ids = matrix(a), Neighbours(matrix(b)), b["weight"].to_numpy(), a["id"].to_numpy()
        out = [pd.DataFrame({"id": ids[:0], "distance": [], "weight": []})]
        for _, rows, near in products(a, b, a["reach"].to_numpy(float)):
            there, lines = y.take(near)
            i, d, w = smallest(x[rows], lines, weight[there], k)
            out.append(pd.DataFrame({"id": ids[rows][i], "distance": d, "weight": w}))
        found = pd.concat(out[1:] or out)
        return found[found["distance"] <= cap] if cap is not None else found

    def nearest_rows(leaves: DataFrame, pairs: DataFrame) -> DataFrame:
        return kth_of(compare(left.rows.join(leaves.select("leaf", "reach"), "leaf"), right.rows, pairs, run, f"id {id_type}, distance double, weight long"), k)

    wide = left.leaves.join(first_bounds(left, right, k), "leaf")
    wide = checkpointed(wide if cap is None else wide.withColumn("reach", F.least("reach", F.lit(float(cap)))))
    closest = near_leaves(MetricIndex(left.rows, wide, left.pivots), right).where(F.col("high") <= F.col("reach"))
    first = nearest_rows(wide, closest)
    # A leaf with a query that did not find k rows so far keeps its wide bound.
    found = left.rows.join(first, "id", "left").groupBy("leaf").agg(F.when(F.count("distance") == F.count(F.lit(1)), F.max("distance")).alias("found"))
    tight = checkpointed(wide.join(found, "leaf").withColumn("reach", F.coalesce("found", "reach")).drop("found"))
    return nearest_rows(tight, near_leaves(MetricIndex(left.rows, tight, left.pivots), right))


def first_bounds(left: MetricIndex, right: MetricIndex, k: int) -> DataFrame:
    """``leaf``, ``reach``: each left leaf has right leaves of ``k`` rows wholly within ``upper``.

    Leaves at the same pivot are looked at first; where they hold too few rows, whole pivots bound it.
    """
    held = {r["pivot"]: (r["span"], r["mass"]) for r in right.leaves.groupBy("pivot").agg(F.max("span").alias("span"), F.sum("mass").alias("mass")).collect()}
    q = np.array(sorted(held))
    far = distances(left.pivots, right.pivots[q]) + np.array([held[i][0] for i in q])[None, :]
    order = np.argsort(far, axis=1, kind="stable")
    enough = np.cumsum(np.array([held[i][1] for i in q])[order], axis=1) >= k
    at = enough.argmax(axis=1)
    bounds = [(i, float(far[i, order[i, n]])) for i, n in enumerate(at)]
    spark = left.rows.sparkSession
    whole = F.broadcast(spark.createDataFrame(bounds, "pivot int, whole double"))  # a row a pivot
    a = left.leaves.select("leaf", "pivot", F.col("centre").alias("ca"), F.col("radius").alias("ra"))
    b = right.leaves.select("pivot", F.col("centre").alias("cb"), F.col("radius").alias("rb"), "mass")
    high = (F.sqrt(squared_distance(F.col("ca"), F.col("cb"))) + F.col("ra") + F.col("rb")) * (1 + ROOM)
    same = a.join(b, "pivot").select("leaf", high.alias("distance"), F.col("mass").alias("weight"))
    near = kth_of(same.withColumnRenamed("leaf", "id"), k).select(F.col("id").alias("leaf"), F.col("distance").alias("own"))
    joined_bounds = left.leaves.select("leaf", "pivot", "span").join(whole, "pivot").join(near, "leaf", "left")
    return joined_bounds.select("leaf", (F.least(F.coalesce("own", F.col("span") + F.col("whole")), F.col("span") + F.col("whole")) * (1 + ROOM)).alias("reach"))
