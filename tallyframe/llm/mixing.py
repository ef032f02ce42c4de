"""Mixing sources to target weights by a multivariate hypergeometric splitting tree.

Every source owes the mix a number of words. Its documents are dealt into blocks by a hash, and whole
blocks are drawn: each block once per full round of the source, then a random part of the blocks for
the remainder, then single documents of one more block to come as near to the target as they can.

Which output shard gets how many draws of which source is decided by a tree. The root holds the draw
counts of all sources; a node splits its draws evenly between its two halves of the shards, and how
many of each source go left is one multivariate hypergeometric draw. So shard sizes and source totals
are both exact, and each shard's composition is that of a uniformly shuffled mix, although no shuffle
of all rows takes place. Each source's draws are permuted, and shards take disjoint ranges of that
permutation; inside a shard rows are ordered by a hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACES, read_table, written

CAP = 3.0
WEIGHTS = (1.0, 2.0, 3.0)
BLOCKS = 512  # most blocks of a source
BLOCK_ROWS = 64  # fewest rows of a block, where a source has so many
SHARDS = 16  # fewest shards
SHARD_WORDS = 8_000_000
BROADCAST_DRAWS = 100_000  # some 5 MB; more draws (hundreds of sources) are joined by shuffle
SEED = 11


def word_count(text: Column) -> Column:
    """Number of words; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, f"{SPACES}+", -1))).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, cap: float = CAP) -> DataFrame:
    """``source``, ``source_size`` and their ``target``.

    Weights go round in code point order of the sources, null last. Sources share the total by weight;
    none gets more than ``cap`` times its size. In order of size per weight the capped sources are a
    prefix, so the level of the others follows from running sums over the list of sources, which has
    a row a source.
    """
    ordered = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.array(*[F.lit(w) for w in weights])[F.pmod(F.row_number().over(ordered) - 1, F.lit(len(weights)))]
    rows = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size") * F.lit(cap))
    full = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before, whole = full.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    rest = F.sum("source_size").over(whole).cast("double") - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    rows = rows.withColumn("level", rest / left).withColumn("turn", F.row_number().over(full))
    # The first source whose fair share at its turn stays within its cap sets the level for all after it.
    free = F.col("level") * F.col("weight") <= F.col("most")
    level = F.min(F.when(free, F.struct("turn", "level"))).over(whole)["level"]
    return rows.select("source", "source_size", F.coalesce(F.least("most", F.col("weight") * level), F.col("most")).alias("target"))


def split_draws(draws: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """Draws of each source in each shard (a row a shard); shard sizes differ by one at most."""
    out = np.zeros((shards, len(draws)), np.int64)

    def node(low: int, high: int, counts: np.ndarray) -> None:
        if high - low == 1:
            out[low] = counts
            return
        middle, total = (low + high) // 2, int(counts.sum())
        take = total * (middle - low) // (high - low)
        left = np.zeros_like(counts)
        if take:
            rng = np.random.default_rng([seed, low, high])
            left = rng.multivariate_hypergeometric(counts, take, method="marginals")
        node(low, middle, left)
        node(middle, high, counts - left)

    node(0, shards, np.asarray(draws, np.int64))
    return out


def nearest_subset(sizes: list[int], budget: int) -> list[int]:
    """Positions whose sizes add up nearest to ``budget``: exact, by a bit set of reachable sums."""
    reach = [1]
    for n in sizes:
        reach.append(reach[-1] | reach[-1] << n)
    below = (reach[-1] & ((1 << budget + 1) - 1)).bit_length() - 1
    above = reach[-1] >> budget + 1
    over = budget + (above & -above).bit_length() if above else None
    total = over if over is not None and over - budget < budget - below else below
    chosen = []
    for i in range(len(sizes) - 1, -1, -1):
        if not reach[i] >> total & 1:
            chosen.append(i)
            total -= sizes[i]
    return chosen


def fill_block(rows: list[int], sizes: list[int], budget: int, swaps: int = 8) -> list[int]:
    """Rows of one block, in permuted order, whose sizes come near ``budget``.

    Small blocks are solved exactly. Larger ones take each row that still fits and then exchange a
    taken row for another one a few times, each time the pair that comes nearest; with so many rows
    hardly a word is left.
    """
    if len(rows) <= 2 * BLOCK_ROWS:
        return [rows[i] for i in nearest_subset(sizes, budget) if sizes[i]]
    size, taken, left = np.asarray(sizes, np.int64), np.zeros(len(rows), bool), budget
    for i, n in enumerate(sizes):
        if 0 < n <= left:
            taken[i], left = True, left - n
    for _ in range(swaps):
        inside, outside = np.flatnonzero(taken), np.flatnonzero(~taken & (size > 0))
        if not left or not len(inside) or not len(outside):
            break
        outside = outside[np.argsort(size[outside], kind="stable")]
        at = np.searchsorted(size[outside], size[inside] + left)
        near = np.stack([np.maximum(at - 1, 0), np.minimum(at, len(outside) - 1)])
        miss = np.abs(size[inside] + left - size[outside[near]])
        if miss.min() >= abs(left):
            break
        side, i = np.unravel_index(miss.argmin(), miss.shape)
        o = outside[near[side, i]]
        left += size[inside[i]] - size[o]
        taken[inside[i]], taken[o] = False, True
    return [rows[i] for i in np.flatnonzero(taken)]


def numbered(docs: DataFrame, without: tuple = ()) -> DataFrame:
    """``docs`` with a row number, word count, null-safe source key and hash order; written once, some columns left out."""
    key = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))
    return written(docs.withColumns({
        "_row": F.monotonically_increasing_id(), "_size": word_count(F.col("text")), "_key": key,
        "_spread": F.xxhash64(F.lit(SEED), "doc_id", key), "_place": F.xxhash64(F.lit(SEED + 1), "doc_id", key)}).drop(*without), "numbered")


def plan(rows: DataFrame, weights: tuple = WEIGHTS, cap: float = CAP, blocks: int = BLOCKS, shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame, int]:
    """(sources, draws, shards) of a mix of numbered ``rows``.

    ``sources``: ``source``, ``_key``, ``source_size``, ``target``, ``_blocks``. ``draws``: one row a
    draw of a block: ``_key``, ``_block``, ``_copy``, ``_shard``, ``_budget`` (null: the whole block, else
    the words to take from it).
    """
    sizes = written(rows.groupBy("source", "_key").agg(F.sum("_size").alias("source_size"), F.count("*").alias("n")), "sizes")
    count = F.least(F.lit(blocks), F.greatest(F.lit(1), F.col("n") / BLOCK_ROWS)).cast("int")
    sources = targets(sizes.select("source", "source_size"), weights, cap).join(
        sizes.select(F.col("source").alias("_s"), "_key", count.alias("_blocks")), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    sources = written(sources, "targets")
    words = in_blocks(rows, sources).groupBy("_key", "_block").agg(F.sum("_size").alias("words"))
    owed = F.round("target").cast("long")
    facts = sources.where("source_size > 0").select("_key", F.expr("source_size").alias("size"), owed.alias("owed"))
    order = Window.partitionBy("_key").orderBy(F.xxhash64(F.lit(SEED + 2), "_key", "_block"), "_block")
    table = words.join(facts, "_key").withColumns({
        "rounds": F.expr("owed div size"), "rest": F.expr("owed % size"),
        "before": F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))})
    whole = F.col("before") + F.col("words") <= F.col("rest")
    edge = ~whole & (F.col("before") < F.col("rest"))
    copies = F.col("rounds") + (whole | edge).cast("long")
    one = F.transform(F.sequence(F.lit(1).cast("long"), copies), lambda i: F.struct(
        i.alias("_copy"), F.when(edge & (i > F.col("rounds")), F.col("rest") - F.col("before")).alias("_budget")))
    draws = written(table.where(copies > 0).select("_key", "_block", F.inline(one)), "draws")

    owing = sorted((r["_key"], r["n"]) for r in draws.groupBy("_key").agg(F.count("*").alias("n")).collect())  # a row a source
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    shards = max(SHARDS, -(-total // shard_words))
    cuts = split_draws(np.array([n for _, n in owing]), shards).cumsum(axis=0)
    spark = rows.sparkSession
    ranges = spark.createDataFrame([(k, cuts[:, i].tolist()) for i, (k, _) in enumerate(owing)], "_key string, cuts array<long>")
    permuted = Window.partitionBy("_key").orderBy(F.xxhash64(F.lit(SEED + 3), "_key", "_block", "_copy"), "_block", "_copy")
    draws = draws.withColumn("_turn", F.row_number().over(permuted)).join(ranges, "_key")
    shard = F.size(F.filter("cuts", lambda c: c < F.col("_turn")))
    draws = written(draws.select("_key", "_block", "_copy", "_budget", shard.alias("_shard")), "dealt")
    return sources, F.broadcast(draws) if sum(n for _, n in owing) <= BROADCAST_DRAWS else draws, shards


def in_blocks(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``rows`` with the block of their source that their hash deals them to."""
    dealt = rows.join(sources.select("_key", "_blocks"), "_key")
    return dealt.withColumn("_block", F.pmod("_spread", F.col("_blocks")).cast("int")).drop("_blocks")


def drawn(rows: DataFrame, sources: DataFrame, draws: DataFrame) -> DataFrame:
    """The mix: every drawn row with ``_copy`` and ``_shard``; rows drawn twice appear twice."""
    dealt = in_blocks(rows, sources)
    whole = dealt.join(draws.where("_budget is null").drop("_budget"), ["_key", "_block"])
    # One block a source is drawn in part; its rows (numbers only) meet in one task.
    part = dealt.join(draws.where("_budget is not null"), ["_key", "_block"])

    def fill(table: pa.Table) -> pa.Table:
        at = np.lexsort((table.column("_row").to_numpy(), table.column("_place").to_numpy()))
        rows, sizes = table.column("_row").to_numpy()[at].tolist(), table.column("_size").to_numpy()[at].tolist()
        return pa.table({"_row": pa.array(fill_block(rows, sizes, table.column("_budget")[0].as_py()), pa.int64())})

    chosen = part.select("_key", "_block", "_row", "_size", "_place", "_budget").groupBy("_key", "_block").applyInArrow(fill, "_row long")
    # An inner join: a semi join would be pushed below the join with the draws and shuffle every row.
    return whole.unionByName(part.join(chosen, "_row").drop("_budget"))


def mixed_counts(docs: DataFrame, weights: tuple = WEIGHTS, cap: float = CAP) -> DataFrame:
    """What the mix takes of every document.

    Needs ``doc_id``, ``text`` and ``source``; other columns are ignored. One row a row: ``doc_id``,
    ``size`` (words), ``source_size``, ``target`` (of its source), ``taken`` (words, repeats counted;
    at most ``cap`` rounded up times the size), ``shards`` (where its copies lie, rising, joined by commas;
    empty if it is not taken). Null and blank texts have size 0. A null source is a source. Repeated rows are taken on their own. The draw depends on ids and sources alone, so reruns
    agree. An empty table gives no rows. A very long text is taken whole or left out, like any other.
    """
    rows = numbered(docs.select("doc_id", "source", "text"), ("text",))
    sources, draws, _ = plan(rows, weights, cap)
    # A row has at most ``cap`` rounded up copies, so its list of shards is short.
    times = drawn(rows, sources, draws).groupBy("_row").agg(F.count("*").alias("times"), F.array_join(F.sort_array(F.collect_list("_shard")), ",").alias("shards"))
    return rows.join(times, "_row", "left").join(sources.select("_key", "source_size", "target"), "_key").select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target",
        (F.coalesce("times", F.lit(0)) * F.col("_size")).alias("taken"), F.coalesce("shards", F.lit("")).alias("shards"))


def mixed_documents(docs: DataFrame, weights: tuple = WEIGHTS, cap: float = CAP) -> DataFrame:
    """The mix itself: the columns of ``docs`` with ``mix_copy`` and ``mix_shard``, a shard a partition in random order.

    Texts are written once with their row number and travel once, to their shard. Columns of ``docs`` may have
    any name; its own ``mix_copy`` and ``mix_shard`` give way to those of the mix.
    """
    needed, others = ("doc_id", "text", "source"), [c for c in docs.columns if c.lower() not in ("doc_id", "text", "source")]
    carried = {c: f"carried_{i}" for i, c in enumerate(others)}
    rows = numbered(docs.select(*needed, *[F.col(f"`{c}`").alias(name) for c, name in carried.items()]))
    sources, draws, shards = plan(rows.drop("text"), weights, cap)
    mix = drawn(rows, sources, draws)
    dealt = mix.repartition(shards, "_shard").sortWithinPartitions("_shard", F.xxhash64(F.lit(SEED + 4), "_row", "_copy"))
    kept = [F.col(carried.get(c, c)).alias(c) for c in docs.columns if c.lower() not in ("mix_copy", "mix_shard")]
    return dealt.select(*kept, F.col("_copy").alias("mix_copy"), F.col("_shard").alias("mix_shard"))


def op5_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """The mix of all documents with weights 1, 2, 3 and at most three rounds of a source."""
    return mixed_counts(read_table(spark, folder, "documents"))
