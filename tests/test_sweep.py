import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import cluster as cl
from tallyframe.operators import kmeans_sweep as ks
from tallyframe.operators import silhouette as si
from tests.test_clusters import distances


def rows_of(spark, x, parts=5):
    frame = spark.createDataFrame(pd.DataFrame({"id": range(len(x)), "features": [list(map(float, r)) for r in x]}))
    return frame.repartition(parts, "id").select("id", F.xxhash64("id").alias("hash"), "features")


def blobs(rng, n, dims=4, centres=6):
    return rng.uniform(-6, 6, (centres, dims))[rng.integers(0, centres, n)] + rng.normal(0, 0.4, (n, dims))


def test_models_advance_together_as_they_do_alone(spark):
    """A third of the rows are copies of one row; more clusters than distinct rows are not made."""
    rng = np.random.default_rng(1)
    rows = rows_of(spark, np.vstack([blobs(rng, 400), np.full((200, 4), 2.5)]))
    settings = [(2, 42), (5, 42), (5, 43)]
    together = ks.fit_all(rows, settings, 50)
    for model, setting in zip(together, settings):
        alone = ks.fit_all(rows.repartition(3), [setting], 50)[0]
        assert model.cost == pytest.approx(alone.cost, rel=1e-6) and model.settled and len(model.centres) == setting[0]
    few = ks.fit_all(rows_of(spark, np.repeat([[0.0, 1.0], [3.0, 1.0]], 40, 0)), [(5, 1)])[0]
    assert len(few.centres) == 2 and few.cost < 1e-18


def test_quality_of_fits_and_measures(spark):
    """Costs come near the best of many plain runs; measures equal their definitions."""
    rng = np.random.default_rng(2)
    x = blobs(rng, 500)
    models = ks.fit_all(rows_of(spark, x), [(6, s) for s in (1, 2, 3)])
    best = min(models, key=lambda m: m.cost)
    label = distances(x, best.centres).argmin(1)
    assert best.cost == pytest.approx((distances(x, best.centres).min(1) ** 2).sum(), rel=1e-9)
    assert best.cost < 1.05 * sum(((x[label == c] - x[label == c].mean(0)) ** 2).sum() for c in range(6)) and best.cost < 500 * 4 * 0.4**2 * 1.3
    ks.measure_all(rows_of(spark, x), [best])
    means = np.array([x[label == c].mean(0) for c in range(6)])
    n, within = np.bincount(label), ((x - means[label]) ** 2).sum()
    between = (n * ((means - x.mean(0)) ** 2).sum(1)).sum()
    assert best.figures["calinski_harabasz"] == pytest.approx(between / 5 / (within / (500 - 6)), rel=1e-9)
    s = np.array([distances(x[label == c], means[[c]]).mean() for c in range(6)])
    worst = [max((s[i] + s[j]) / np.linalg.norm(means[i] - means[j]) for j in range(6) if j != i) for i in range(6)]
    assert best.figures["davies_bouldin"] == pytest.approx(np.mean(worst), rel=1e-9)


def plain_silhouette(x, label):
    d, out = distances(x, x), []
    for i, own in enumerate(label):
        same = label == own
        inside = d[i, same].sum() / max(same.sum() - 1, 1)
        outside = min(d[i, label == o].mean() for o in set(label) - {own})
        out.append(0.0 if same.sum() == 1 or max(inside, outside) == 0 else (outside - inside) / max(inside, outside))
    return np.array(out)


def test_silhouettes_of_several_labellings(spark):
    """Noise, a cluster of one, copies, a labelling with one cluster; blocks of any size."""
    rng = np.random.default_rng(3)
    x = np.vstack([blobs(rng, 120, 3, 3), np.full((40, 3), 1.5)])
    labels = {0: rng.integers(0, 3, 160), 1: np.where(np.arange(160) == 7, 9, rng.integers(-1, 2, 160)), 2: np.zeros(160, int)}
    frame = pd.concat([pd.DataFrame({"part": p, "id": range(160), "cluster": c, "features": list(map(list, x))}) for p, c in labels.items()])
    df = spark.createDataFrame(frame)
    got = {(r.part, r.id): r.silhouette for r in si.silhouettes(df, 0).collect()}
    want = {(p, i): s for p in (0, 1) for keep in [np.flatnonzero(labels[p] >= 0)] for i, s in zip(keep, plain_silhouette(x[keep], labels[p][keep]))}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], abs=1e-7) for k in want)
    members = si.drawn_members(df.where("part = 0"), df.where("part = 0").groupBy("part", "cluster").agg(F.count("*").alias("size"), F.array(F.avg(F.col("features")[0]), F.avg(F.col("features")[1]), F.avg(F.col("features")[2])).alias("mean")), 0)
    few = si.distance_sums(df.where("part = 0"), members, block_rows=30).toPandas().groupby("id")["total"].sum()
    assert np.allclose(few.sort_index(), distances(x, x).sum(1), rtol=1e-6)


def test_drawn_members_keep_the_stated_error(spark):
    """Root mean square of the relative error of every row's mean distance, over several draws, is below the bound."""
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(0, 1, (1900, 2)), rng.normal(60, 0.1, (100, 2))])  # a few far members carry most of the distance
    df = spark.createDataFrame(pd.DataFrame({"part": 0, "id": range(2000), "cluster": 0, "features": list(map(list, x))}))
    clusters = spark.createDataFrame([(0, 0, 2000, x.mean(0).tolist())], "part long, cluster long, size long, mean array<double>")
    true, error = distances(x, x).sum(1), 0.2
    off = []
    for seed in range(12):
        members = si.drawn_members(df, clusters, error, seed).toPandas()
        assert 60 < len(members) < 250
        off.append((distances(x, x[members["id"]]) @ members["weight"].to_numpy()) / true - 1)
    assert np.sqrt(np.mean(np.square(off))) < error and abs(np.mean(off)) < error / 4
    two = df.withColumn("cluster", (F.col("id") % 2).cast("long"))
    assert si.euclidean_silhouette(two, "id", error=0.1).first()[0] == pytest.approx(plain_silhouette(x, np.arange(2000) % 2).mean(), abs=0.05)


def test_many_small_clusters_send_on_two_sums_a_row(spark):
    """Of clusters that fit into a block a row keeps its own and the nearest; scores stay those of all pairs."""
    rng = np.random.default_rng(6)
    x, label = rng.normal(0, 1, (240, 5)), np.arange(240) // 3
    df = spark.createDataFrame(pd.DataFrame({"part": 0, "id": range(240), "cluster": label, "features": list(map(list, x))}))
    members = df.withColumns({"weight": F.lit(1.0), "size": F.lit(3)})
    assert si.distance_sums(df, members, only_nearest=True).count() == 2 * 240
    got = {r.id: r.silhouette for r in si.silhouettes(df, 0).collect()}
    assert all(got[i] == pytest.approx(s, abs=1e-7) for i, s in enumerate(plain_silhouette(x, label)))
    split = si.distance_sums(df, members, block_rows=2, only_nearest=True)  # clusters larger than a block keep every sum
    assert split.count() == 240 * 80


def test_a_pass_is_one_stage_over_blocks(spark, monkeypatch):
    """Rows are packed once, whole and in blocks of a set size; a pass shuffles nothing."""
    monkeypatch.setattr(ks, "BLOCK_VALUES", 4 * 30)
    rng = np.random.default_rng(7)
    x = blobs(rng, 200)
    blocks = ks.blocks_of(rows_of(spark, x, 3))
    sizes = [r.n for r in blocks.collect()]
    assert sum(sizes) == 200 and max(sizes) == 30
    spark.sparkContext.setJobGroup("sweep", "")
    found = ks.sums(blocks, ks.by_cluster([x[:2], x[:5]]))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    assert [len(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup("sweep")] == [1]
    best = distances(x, x[:5]).argmin(1)
    assert all(np.allclose(found[1, c], [(best == c).sum(), *x[best == c].sum(0)]) for c in range(5))


def test_models_share_the_members_drawn_for_their_silhouettes(spark):
    """Whole clusters give exact scores; drawn ones come near them with fewer members than each model would draw by itself."""
    rng = np.random.default_rng(8)
    x = blobs(rng, 900)
    blocks = ks.blocks_of(rows_of(spark, x, 4))
    models = ks.fit_all(rows_of(spark, x, 4), [(k, 1) for k in (1, 3, 5, 8)], blocks=blocks)
    ks.measure_all(rows_of(spark, x), models, blocks)
    d, want = distances(x, x), [None]
    for model in models[1:]:
        label = distances(x, model.centres).argmin(1)
        means = np.stack([d[:, label == c].sum(1) / np.maximum((label == c).sum() - (label == c), 1) for c in range(model.k)], axis=1)
        inside = means[np.arange(900), label]
        means[np.arange(900), label] = np.inf
        want.append(((means.min(1) - inside) / np.maximum(means.min(1), inside)).mean())
    assert ks.drawn_scores(blocks, models, float("inf")) == [None, *(pytest.approx(w, rel=1e-6) for w in want[1:])]
    drawn, weight, _ = ks.drawn_together(blocks, models, 60.0)
    assert len(drawn) < 0.6 * 60 * (1 + 3 + 5 + 8) and weight.sum() == pytest.approx(900, rel=0.15)
    assert ks.drawn_scores(blocks, models, 60.0)[1:] == [pytest.approx(w, abs=0.03) for w in want[1:]]


def test_a_repeated_row_is_one_row_of_the_mean_silhouette(spark):
    """It still counts in its cluster as often as it comes."""
    x = np.array([[0.0], [1.0], [1.0], [8.0], [9.5], [9.5], [9.5]])
    ids = [0, 1, 1, 2, 3, 3, 4]
    df = spark.createDataFrame(pd.DataFrame({"id": ids, "features": [list(map(float, r)) for r in x]}))
    table, _ = cl.kmeans_sweep(df, "id", [2], seeds=[1])
    label, d, scores = (x[:, 0] > 4).astype(int), distances(x, x), []
    for i in (0, 1, 3, 4, 6):
        inside, outside = d[i, label == label[i]].sum() / ((label == label[i]).sum() - 1), d[i, label != label[i]].mean()
        scores.append((outside - inside) / max(inside, outside))
    assert table.first()["silhouette"] == pytest.approx(np.mean(scores), rel=1e-6)
