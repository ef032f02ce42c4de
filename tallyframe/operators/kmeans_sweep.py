"""Many K-means models over one table, advanced together.

Every pass over the rows serves all models (each number of clusters with each seed): the distances to
all their centres are one matrix product per batch, and a task hands on counts and sums per centre, so a
sweep takes about as many passes as its slowest model instead of the sum over models. Models that have
settled drop out. Starting centres are drawn the same way, by k-means|| over all rows. Bounds that
spare distances would have to be stored per row and model and rewritten in every pass, which costs more
than the product they save, so distances are always computed. A sweep may take hundreds of passes, so rows are
packed once into blocks of bytes, and a pass is one stage that hands a table of numbers per task to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpointed
from .shared_silhouette import Clusters, Members, groups, score

BLOCK_VALUES = 1 << 19  # numbers in a block
PIECE_ROWS = 4096  # of a block that are measured at once, so that their distances stay in the processor's cache
TASKS_A_CORE = 4  # tasks of a pass; each hands on one table
ROUNDS = 2  # of oversampling; each draws about 2 K candidates a model
TOLERANCE = 1e-4
LOCAL_STEPS = 30
GOLDEN = 0x9E3779B97F4A7C15


@dataclass
class CentreModel:
    """One model: ``centres``, whether they have ``settled``, passes taken, and the ``cost`` of all rows."""

    k: int
    seed: int
    centres: np.ndarray
    settled: bool = False
    passes: int = 0
    cost: float = np.nan
    sizes: np.ndarray | None = None  # rows, mean and summed distance to it of each cluster, once measured
    means: np.ndarray | None = None
    away: np.ndarray | None = None
    figures: dict = field(default_factory=dict)

    def clusterCenters(self) -> list[np.ndarray]:
        return list(self.centres)


def blocks_of(rows: DataFrame) -> DataFrame:
    """``rows`` (``hash``, ``features``) as blocks (``n``, ``hashes``, ``block``), written for many passes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def block() -> pa.RecordBatch:
            hashes, x = (np.concatenate(c) for c in zip(*held))
            held.clear()
            return pa.record_batch([pa.array([len(x)]), pa.array([hashes.tobytes()]), pa.array([x.tobytes()])], ["n", "hashes", "block"])

        for batch in batches:
            if batch.num_rows:
                column = batch.column("features")
                x = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(float)
                step = max(1, BLOCK_VALUES // max(x.shape[1], 1))
                for i in range(0, len(x), step):
                    held.append((batch.column("hash").to_numpy()[i:i + step], x[i:i + step]))
                    if sum(len(h) for h, _ in held) >= step:
                        yield block()
        if held:
            yield block()

    found = checkpointed(rows.select("hash", "features").mapInArrow(run, "n long, hashes binary, block binary"))
    return found.coalesce(TASKS_A_CORE * rows.sparkSession.sparkContext.defaultParallelism)


def vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes and vectors of each block."""
    for n, hashes, block in zip(batch.column("n").to_pylist(), batch.column("hashes"), batch.column("block")):
        yield np.frombuffer(hashes.as_buffer(), np.int64), np.frombuffer(block.as_buffer()).reshape(n, -1)


def nearest(x: np.ndarray, stacks: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per stack of centres: the nearest one of each row (the first on ties) and the squared distance."""
    every = np.vstack(stacks)
    square = x @ every.T
    square *= -2
    square += (x * x).sum(1)[:, None]
    square += (every * every).sum(1)
    np.maximum(square, 0, out=square)
    at = 0
    for centres in stacks:
        part = square[:, at:at + len(centres)]
        best = part.argmin(1)
        yield best, part[np.arange(len(x)), best]
        at += len(centres)


def sums(blocks: DataFrame, measure: Callable[[np.ndarray], Iterator[tuple[int, int, np.ndarray]]]) -> dict[tuple[int, int], np.ndarray]:
    """Add up ``measure``: it yields (model, cluster, numbers) per block; a line a task returns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for _, x in vectors(batch):
                for i in range(0, len(x), PIECE_ROWS):
                    for m, c, numbers in measure(x[i:i + PIECE_ROWS]):
                        total[m, c] = total[m, c] + numbers if (m, c) in total else np.array(numbers, float)
        if total:
            where, numbers = np.array(list(total), np.int32), np.array(list(total.values()))
            yield pa.record_batch([pa.array([len(where)]), pa.array([where.tobytes()]), pa.array([numbers.tobytes()])], ["n", "at", "numbers"])

    out: dict[tuple[int, int], np.ndarray] = {}
    for r in blocks.select("n", "hashes", "block").mapInArrow(run, "n long, at binary, numbers binary").collect():
        for (m, c), numbers in zip(np.frombuffer(r["at"], np.int32).reshape(-1, 2).tolist(), np.frombuffer(r["numbers"]).reshape(r["n"], -1)):
            out[m, c] = out[m, c] + numbers if (m, c) in out else numbers
    return out


def by_cluster(stacks: list[np.ndarray], row_numbers: Callable[[np.ndarray, int, np.ndarray, np.ndarray], np.ndarray] | None = None):
    """A measure that adds the numbers of each row (one and its vector, if not given) to the cluster that has its nearest centre."""
    def measure(x: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        counted = np.hstack([np.ones((len(x), 1)), x]) if row_numbers is None else None
        for m, (best, square) in enumerate(nearest(x, stacks)):
            member = np.zeros((len(stacks[m]), len(x)))
            member[best, np.arange(len(x))] = 1
            table = member @ (counted if row_numbers is None else row_numbers(x, m, best, square))
            for c in np.flatnonzero(member.any(1)):
                yield m, int(c), table[c]
    return measure


def uniform(hashes: np.ndarray, salt: int) -> np.ndarray:
    """A reproducible number in [0, 1) for each hashed key."""
    h = hashes.view(np.uint64) ^ np.uint64((salt * GOLDEN) & (2**64 - 1))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return ((h ^ (h >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2.0**53


def drawn(blocks: DataFrame, stacks: list[np.ndarray], chance: list[float], salts: list[int]) -> list[np.ndarray]:
    """New candidates per model: a row is drawn with its squared distance times the model's ``chance``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, x in vectors(batch):
                for m, (_, square) in enumerate(nearest(x, stacks)):
                    hit = np.flatnonzero(uniform(keys, salts[m]) < square * chance[m])
                    if len(hit):
                        yield pa.record_batch([pa.array(np.full(len(hit), m, np.int32)), pa.array(x[hit].tolist(), pa.list_(pa.float64()))], ["m", "features"])

    # Equal rows may all be drawn; one of them is enough.
    found = blocks.select("n", "hashes", "block").mapInArrow(run, "m int, features array<double>").distinct().collect()
    out: list[list] = [[] for _ in stacks]
    for r in sorted(found, key=lambda r: (r.m, r.features)):
        out[r.m].append(r.features)
    return [np.array(v, float).reshape(-1, stacks[0].shape[1]) for v in out]


def seeded(candidates: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """K centres of a few weighted candidates: k-means++ and some steps of Lloyd's, on the driver."""
    rng = np.random.default_rng(seed)
    centres = candidates[[rng.choice(len(candidates), p=weights / weights.sum())]]
    while len(centres) < min(k, len(candidates)):
        square = ((candidates[:, None] - centres[None]) ** 2).sum(2).min(1) * weights
        if not square.sum():
            break
        centres = np.vstack([centres, candidates[rng.choice(len(candidates), p=square / square.sum())]])
    for _ in range(LOCAL_STEPS):
        best = ((candidates[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        held = np.bincount(best, weights, len(centres))
        moved = np.stack([np.bincount(best, weights * candidates[:, d], len(centres)) for d in range(candidates.shape[1])], axis=1)
        moved = np.where(held[:, None] > 0, moved / np.maximum(held, 1e-300)[:, None], centres)
        if np.allclose(moved, centres, rtol=0, atol=1e-12):
            break
        centres = moved
    return centres


def starting_models(rows: DataFrame, blocks: DataFrame, settings: Sequence[tuple[int, int]]) -> list[CentreModel]:
    """k-means|| for all (k, seed) in shared passes over the ``blocks`` of ``rows`` (``hash``, ``features``)."""
    seeds = sorted({s for _, s in settings})
    first = rows.agg(*[F.min_by("features", F.struct(F.xxhash64("hash", F.lit(s)), "features")).alias(f"s{s}") for s in seeds]).first()
    stacks = [np.array([first[f"s{seed}"]], float) for _, seed in settings]
    for turn in range(ROUNDS):
        cost = sums(blocks, by_cluster(stacks, lambda x, m, best, square: square[:, None]))
        total = [sum(v[0] for (model, _), v in cost.items() if model == m) for m in range(len(stacks))]
        chance = [2 * k / t if t > 0 else 0.0 for (k, _), t in zip(settings, total)]
        more = drawn(blocks, stacks, chance, [(seed * 1009 + k) * ROUNDS + turn + 1 for k, seed in settings])
        stacks = [np.unique(np.vstack([a, b]), axis=0) for a, b in zip(stacks, more)]
    weight = sums(blocks, by_cluster(stacks, lambda x, m, best, square: np.ones((len(x), 1))))
    held = [np.array([weight.get((m, c), [0.0])[0] for c in range(len(s))]) for m, s in enumerate(stacks)]
    return [CentreModel(k, seed, seeded(s[h > 0], h[h > 0], k, seed)) for (k, seed), s, h in zip(settings, stacks, held)]


def advanced(blocks: DataFrame, models: list[CentreModel], tol: float = TOLERANCE) -> None:
    """One pass: every model that has not settled gets the means of its clusters; an empty one keeps its centre."""
    open_models = [m for m in models if not m.settled]
    stacks = [m.centres for m in open_models]
    found = sums(blocks, by_cluster(stacks))
    for i, model in enumerate(open_models):
        moved = np.array([found[i, c][1:] / found[i, c][0] if (i, c) in found else old for c, old in enumerate(model.centres)])
        model.settled = bool((((moved - model.centres) ** 2).sum(1) <= tol * tol).all())
        model.centres, model.passes = moved, model.passes + 1


def fit_all(rows: DataFrame, settings: Sequence[tuple[int, int]], max_iter: int = 100, tol: float = TOLERANCE, blocks: DataFrame | None = None) -> list[CentreModel]:
    """Models of all (k, seed) over ``rows`` (``hash``, ``features``), with their costs; ``blocks`` are those of the rows, if there are any yet."""
    blocks = blocks_of(rows) if blocks is None else blocks
    models = starting_models(rows, blocks, settings)
    for _ in range(max_iter):
        if all(m.settled for m in models):
            break
        advanced(blocks, models, tol)
    cost = sums(blocks, by_cluster([m.centres for m in models], lambda x, m, best, square: square[:, None]))
    for i, model in enumerate(models):
        model.cost = sum(v[0] for (m, _), v in cost.items() if m == i)
    return models


def measure_all(rows: DataFrame, models: list[CentreModel], blocks: DataFrame | None = None) -> None:
    """Calinski-Harabasz and Davies-Bouldin of all models into ``figures``, in two shared passes."""
    blocks = blocks_of(rows) if blocks is None else blocks
    stacks = [m.centres for m in models]
    held = sums(blocks, by_cluster(stacks))
    means = [np.array([held[m, c][1:] / held[m, c][0] if (m, c) in held else s[c] for c in range(len(s))]) for m, s in enumerate(stacks)]
    def away(x: np.ndarray, m: int, best: np.ndarray, square: np.ndarray) -> np.ndarray:
        own = ((x - means[m][best]) ** 2).sum(1)
        return np.stack([own, np.sqrt(own)], axis=1)
    spread = sums(blocks, by_cluster(stacks, away))
    for m, model in enumerate(models):
        model.sizes = np.array([held[m, c][0] if (m, c) in held else 0.0 for c in range(len(stacks[m]))])
        model.away = np.array([spread[m, c][1] if (m, c) in spread else 0.0 for c in range(len(stacks[m]))])
        model.means = means[m]
        live = [c for c in range(len(stacks[m])) if (m, c) in held]
        n, centre = np.array([held[m, c][0] for c in live]), means[m][live]
        square, mean_away = np.array([spread[m, c][0] for c in live]), np.array([spread[m, c][1] for c in live]) / n
        middle = (n[:, None] * centre).sum(0) / n.sum()
        between = (n * ((centre - middle) ** 2).sum(1)).sum()
        k, free = len(live), n.sum() - len(live)
        apart = np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(2))
        with np.errstate(divide="ignore", invalid="ignore"):
            worst = np.where(np.eye(k, dtype=bool) | (apart == 0), -np.inf, (mean_away[:, None] + mean_away[None]) / apart).max(1)
        model.figures = {
            "calinski_harabasz": float(between / (k - 1) / (square.sum() / free)) if k > 1 and free > 0 and square.sum() > 0 else None,
            "davies_bouldin": float(worst[np.isfinite(worst)].mean()) if np.isfinite(worst).any() else None}


def drawn_together(blocks: DataFrame, models: list[CentreModel], draws: float, seed: int = 42) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Members that stand for the clusters of all models: rows, weights (one over the chance) and a label in each model.

    A row is drawn with the largest of the chances that its clusters give it (``silhouette.drawn_members``), so each of
    them gets at least the members that it would get by itself, and one of ``draws`` rows or half as many whole.
    """
    stacks = [m.centres for m in models]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, x in vectors(batch):
                chance, labels = np.zeros(len(x)), np.zeros((len(x), len(models)), np.int64)
                for m, (best, _) in enumerate(nearest(x, stacks)):
                    model, labels[:, m] = models[m], best
                    even, far = 1 / model.sizes[best], np.sqrt(((x - model.means[best]) ** 2).sum(1))
                    with np.errstate(divide="ignore", invalid="ignore"):
                        share = np.where(model.away[best] > 0, far / model.away[best], even)
                    chance = np.maximum(chance, np.minimum(1.0, (even + share) / 2 * draws))
                hit = np.flatnonzero(uniform(keys, seed) < chance)
                yield pa.record_batch([pa.array([np.ascontiguousarray(a[hit]).tobytes()], pa.binary()) for a in (x, 1 / chance, labels)], ["x", "weight", "labels"])

    found = blocks.select("n", "hashes", "block").mapInArrow(run, "x binary, weight binary, labels binary").collect()  # bounded by clusters and draws
    x = np.concatenate([np.frombuffer(r["x"]).reshape(-1, stacks[0].shape[1]) for r in found])
    labels = np.concatenate([np.frombuffer(r["labels"], np.int64).reshape(-1, len(models)) for r in found])
    order = np.lexsort((*x.T, *labels.T))
    return x[order], np.concatenate([np.frombuffer(r["weight"]) for r in found])[order], labels[order]


def drawn_scores(blocks: DataFrame, models: list[CentreModel], draws: float, asked: DataFrame | None = None) -> list[float | None]:
    """Mean silhouette of all rows in each model that was measured (``measure_all``), from members drawn for all of them together.

    Every row meets the members where it is: a distance serves all models and nothing is shuffled. ``asked`` are the
    blocks to take the mean over, if not all.
    """
    x, weight, labels = drawn_together(blocks, models, draws)
    starts, stacks = groups(labels), [m.centres for m in models]
    members, levels = Members(x, weight, starts), [Clusters(labels[starts, m], np.ones(len(starts))) for m in range(len(models))]

    def measure(rows: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        best = [b for b, _ in nearest(rows, stacks)]
        total = np.zeros((len(models), 2))
        for part, sums in members.sums(rows):
            for m, found in enumerate(levels):
                mean, mine = found.sums(sums), best[m][part]
                row, at = found.places(mine)
                inside = np.zeros(len(mine))
                inside[row] = mean[at, row]
                mean /= models[m].sizes[found.names][:, None]
                mean[at, row] = np.inf
                scores = score(inside, mean.min(0), models[m].sizes[mine])
                total[m] += len(mine), scores.sum()
        for m, numbers in enumerate(total):
            yield m, 0, numbers

    found = sums(blocks if asked is None else asked, measure)
    return [float(found[m, 0][1] / found[m, 0][0]) if len(levels[m].names) > 1 else None for m in range(len(models))]
