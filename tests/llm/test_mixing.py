import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.llm.mixing import drawn, fill_block, in_blocks, mixed_counts, mixed_documents, numbered, op5_source_mixing, plan, split_draws


def shares(sizes):
    """Iterative definition: source -> target."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        if not free:
            return fixed
        rest = total - sum(fixed.values())
        fair = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if fair[s] > 3 * sizes[s]]
        if not above:
            return fixed | fair
        fixed.update({s: 3.0 * sizes[s] for s in above})


def check(rows, docs):
    sizes, taken = {}, {}
    source = {i: s for i, _, s in docs}
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in docs}
    for i, _, s in docs:
        sizes[s] = sizes.get(s, 0) + words[i]
    want = shares(sizes)
    for r in rows:
        s = source[r.doc_id]
        assert r.size == words[r.doc_id] and r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6 * max(1, want[s])
        assert 0 <= r.taken <= 3 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(3, 0.01 * t), (s, taken[s], t)


def test_tree_keeps_sums_and_shard_sizes():
    draws = np.array([1000, 0, 37, 5])
    for shards in (1, 7, 16):
        got = split_draws(draws, shards)
        assert (got.sum(axis=0) == draws).all() and got.min() >= 0
        assert got.sum(axis=1).max() - got.sum(axis=1).min() <= 1
        assert (got == split_draws(draws, shards)).all()
    assert abs(np.mean([split_draws(np.array([300, 100]), 4, seed)[2, 0] for seed in range(400)]) - 75) < 1


def test_fill_block_is_near():
    assert sorted(fill_block([0, 1, 2], [5, 9, 4], 9)) in ([1], [0, 2])
    assert fill_block([0, 1, 2], [50, 30, 61], 60) == [2]
    assert fill_block([0], [10], 6) == [0] and fill_block([0], [10], 4) == [] and fill_block([], [], 4) == []
    rng = random.Random(2)
    for _ in range(100):
        sizes = [rng.randint(0, 30) for _ in range(9)]
        budget = rng.randint(1, sum(sizes) + 5)
        best = min(abs(budget - sum(x for i, x in enumerate(sizes) if m >> i & 1)) for m in range(512))
        assert abs(budget - sum(sizes[i] for i in fill_block(list(range(9)), sizes, budget))) == best
    sizes = [rng.randint(1, 900) for _ in range(3000)]
    assert abs(sum(sizes[i] for i in fill_block(list(range(3000)), sizes, 70000)) - 70000) <= 1


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(8)
    names = ["a"] * 500 + ["b", "c", "Z", None, "d"] * 12
    return [(i, " ".join("w" * rng.randint(1, 40)), rng.choice(names)) for i in range(900)] + [(2000, None, "empty"), (2001, " ", None)]


def test_targets_and_takings(spark, docs):
    df = spark.createDataFrame([(i, t, s, 0) for i, t, s in docs], "doc_id long, text string, source string, size int")
    rows = mixed_counts(df).collect()
    assert len(rows) == len(docs)
    check(rows, docs)
    again = mixed_counts(df.repartition(5)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mix_holds_what_is_taken(spark, docs):
    df = spark.createDataFrame([(i, t, s) for i, t, s in docs], "doc_id long, text string, source string")
    want = {r.doc_id: r.taken for r in mixed_counts(df).collect() if r.taken}
    got = {}
    mix = mixed_documents(df)
    assert mix.columns == ["doc_id", "text", "source", "mix_copy", "mix_shard"]
    shards = {}
    for r in mix.collect():
        n = len(r.text.split())
        got[r.doc_id] = got.get(r.doc_id, 0) + n
        shards[r.mix_shard] = shards.get(r.mix_shard, 0) + 1
    assert {k: v for k, v in got.items() if v} == want and len(shards) > 1


def test_shards_of_documents_follow_the_tree(spark, docs):
    df = spark.createDataFrame([(i, t, s) for i, t, s in docs], "doc_id long, text string, source string")
    rows = numbered(df)
    sources, draws, shards = plan(rows, shard_words=500)
    dealt = draws.collect()
    keys = sorted({d._key for d in dealt})
    table = np.zeros((shards, len(keys)), int)
    for d in dealt:
        table[d._shard, keys.index(d._key)] += 1
    assert (table == split_draws(table.sum(axis=0), shards)).all() and shards > 16
    want = {}
    for r in drawn(rows, sources, draws).collect():
        want.setdefault(r.doc_id, []).append(r._shard)
    assert len(in_blocks(rows, sources).where("_block is null").collect()) == 0
    got = {r.doc_id: r.shards for r in mixed_counts(df).collect()}
    tree = {}
    for r in mixed_documents(df).collect():
        tree.setdefault(r.doc_id, []).append(r.mix_shard)
    assert got == {i: ",".join(map(str, sorted(tree.get(i, [])))) for i, _, _ in docs}
    assert {i: len(s) for i, s in want.items()} == {i: len(s) for i, s in tree.items()}  # shards move rows, they change no copies


def test_names_may_clash(spark):
    names = ["_row", "_SIZE", "_key", "_block", "_copy", "carried_0", "times", "MIX_COPY"]
    df = spark.createDataFrame([(i, "a b", "x" if i % 2 else "y") for i in range(50)], "doc_id long, text string, source string")
    mix = mixed_documents(df.select(*[F.lit("mine").alias(n) for n in names], "*"))
    assert mix.columns == names[:-1] + ["doc_id", "text", "source", "mix_copy", "mix_shard"]
    assert mix.where("_row = 'mine' and _SIZE = 'mine' and carried_0 = 'mine'").count() == mix.count() > 0


def test_edges(spark):
    one = spark.createDataFrame([(None, "a b", None), (1, "c", None), (1, "c", None)], "doc_id long, text string, source string")
    assert sum(r.taken for r in mixed_counts(one).collect()) == 4
    assert mixed_counts(one.limit(0)).count() == 0 and mixed_documents(one.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, None, "x")], "doc_id long, text string, source string")
    assert [(r.size, r.target, r.taken) for r in mixed_counts(blank).collect()] == [(0, 0.0, 0)]


def test_all_test_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    check(op5_source_mixing(spark, folder).collect(), docs)
