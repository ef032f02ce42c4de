"""Shards of near-equal size: longest processing time first, copies of a text kept together.

Equal texts are one group. Groups are sorted by size, largest first, and each goes to the shard that
holds least so far, which a heap names. Only groups of at least 1/2048 of a shard are dealt one by
one, so there are never more than 2048 a shard. The many smaller ones are first bundled by their
digest, 2048 bundles a shard, and a bundle is dealt like a group. So the heap sees a bounded list
however many groups there are, and what is dealt last is a few thousandths of a shard at most.

Rows get their shard by two joins with that list and never meet by text, so a text with copies in a
third of all rows costs no more than any other. Slots are numbered in buckets of digests.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table, unused, written

SHARDS = 24
SHARE = 2048  # items of a shard: groups from this fraction of a shard are dealt alone, and as many bundles
OVERHEAD = 8  # bytes a row takes besides its text
BUCKET_ROWS = 50_000
COPIES = 1024


def digest_of(text: Column) -> Column:
    """The name of a text's group; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def bundle_of(digest: Column, bundles: int) -> Column:
    number = F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") % bundles
    return F.concat(F.lit("bundle"), number.cast("string"))


def longest_first(items: Iterable[tuple[str, int]], shards: int) -> list[tuple[str, int]]:
    """Deal items (name, size), largest first and by name on ties, each to the least loaded shard."""
    heap = [(0, shard) for shard in range(shards)]
    out = []
    for size, name in sorted((-size, name) for name, size in items):
        load, shard = heapq.heappop(heap)
        out.append((name, shard))
        heapq.heappush(heap, (load - size, shard))
    return out


def dealt(sized: DataFrame, shards: int = SHARDS, share: int = SHARE) -> DataFrame:
    """The shard of every item: rows (``item``, ``to_shard``), at most 2 * shards * share of them.

    ``sized`` has a row a document with ``digest`` and ``size``; sizes of copies are added up before
    they are shuffled.
    """
    total = sized.agg(F.sum("size")).first()[0] or 0
    least = max(1, -(-total // (shards * share)))
    groups = sized.groupBy("digest").agg(F.sum("size").alias("size"))
    alone = groups.where(F.col("size") >= least).select(F.col("digest").alias("item"), "size")
    rest = groups.where(F.col("size") < least).groupBy(bundle_of(F.col("digest"), shards * share).alias("item")).agg(F.sum("size").alias("size"))
    items = [tuple(r) for r in alone.unionByName(rest).collect()]
    return sized.sparkSession.createDataFrame(longest_first(items, shards), "item string, to_shard int")


def placed(rows: DataFrame, plan: DataFrame, digest: str, shard: str, shards: int = SHARDS, share: int = SHARE) -> DataFrame:
    """``rows`` and their ``shard``, looked up by ``digest``; the plan's size is bounded, so it is broadcast."""
    alone, bundle, item = (unused(rows.columns, n) for n in ("alone", "bundle", "item"))
    def side(name: str) -> DataFrame:
        return F.broadcast(plan.select(F.col("item").alias(item), F.col("to_shard").alias(name)))
    out = rows.join(side(alone), F.col(digest) == F.col(item), "left").drop(item)
    out = out.join(side(bundle), bundle_of(F.col(digest), shards * share) == F.col(item), "left").drop(item)
    return out.withColumn(shard, F.coalesce(alone, bundle)).drop(alone, bundle)


def numbered(rows: DataFrame, count: int, shards: int = SHARDS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``rows`` (written, with ``shard``, ``mark`` and ``copies``) as often as they have copies, with ``slot``.

    Slots run from 0 without a gap inside a shard, in the order of ``mark``. Buckets are the marks'
    first digits, as many as ``count`` rows ask for, so no window holds more than a bucket.
    """
    digits = max(0, math.ceil(math.log(max(1, count) / (shards * bucket_rows), 16)))
    rows = rows.withColumn("bucket", F.substring("mark", 1, digits))
    ahead = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    here = Window.partitionBy("shard", "bucket").orderBy("mark").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "bucket").agg(F.sum("copies").alias("held")).select("shard", "bucket", F.coalesce(F.sum("held").over(ahead), F.lit(0)).alias("start"))
    out = rows.join(starts, ["shard", "bucket"]).withColumn("first", F.col("start") + F.coalesce(F.sum("copies").over(here), F.lit(0)))
    few, many = out.where(F.col("copies") <= COPIES), out.where(F.col("copies") > COPIES)
    # A row with very many copies is cut into runs, which are dealt out before they become rows.
    run = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES))).alias("run")
    many = many.select("*", run).repartition("shard", "mark", "run")
    many = many.withColumn("first", F.col("first") + F.col("run") * COPIES).withColumn("copies", F.least(F.col("copies") - F.col("run") * COPIES, F.lit(COPIES))).drop("run")
    both = few.unionByName(many)
    return both.withColumn("step", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))).withColumn("slot", F.col("first") + F.col("step"))


def shard_table(docs: DataFrame, shards: int = SHARDS, share: int = SHARE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Shard and slot of every document, near-equal in bytes.

    Needs ``doc_id`` and ``text``; other columns are ignored. One row a row: ``doc_id``, ``size``
    (UTF-8 bytes of the text plus 8), ``text_crc32`` (unsigned; 0 for no text), ``law`` (``bytes``),
    ``shard``, ``slot`` (from 0 in each shard, no gaps), ``grown_shard`` (null). Null and empty texts
    are one group, like any equal texts. Repeated rows stay and take slots of their own; null ids
    are ids like any other. A text may be of any length. An empty table gives no rows. One group
    larger than a shard's share makes its shard as large; no law could split it.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    read = docs.select("doc_id", digest_of(F.col("text")).alias("digest"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    keyed = written(read, "sizes")
    rows = placed(keyed, dealt(keyed, shards, share), "digest", "shard", shards, share)
    mark = F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("digest")), 256)
    rows = written(rows.groupBy("doc_id", "size", "text_crc32", "shard", mark.alias("mark")).agg(F.count("*").alias("copies")), "placed")
    out = numbered(rows, rows.count(), shards, bucket_rows)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def with_shard(docs: DataFrame, column: str = "shard", shards: int = SHARDS, share: int = SHARE) -> DataFrame:
    """``docs``, whole rows, with their shard in ``column`` (one of that name is replaced).

    The same shards as in ``shard_table``. Texts are read twice and not shuffled.
    """
    kept = [c for c in docs.columns if c.lower() != column.lower()]
    digest = unused([*kept, column], "digest")
    sized = docs.select(digest_of(F.col("text")).alias("digest"), (F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + OVERHEAD).cast("long").alias("size"))
    keyed = docs.select(*[F.col(f"`{c}`") for c in kept], digest_of(F.col("text")).alias(digest))
    return placed(keyed, dealt(sized, shards, share), digest, column, shards, share).select(*[F.col(f"`{c}`") for c in kept], column)


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write the documents as Parquet, one folder ``shard=N`` each."""
    with_shard(docs, "shard", shards).write.mode("errorifexists").partitionBy("shard").parquet(path)


def op12_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 24 shards."""
    return shard_table(read_table(spark, folder, "documents"))


#: Independent SQL over the whole table: the heap becomes a recursion that names the least loaded shard.
OP12_SQL = f"""
WITH RECURSIVE codes(i, c, k) AS (
    SELECT i, i, 0 FROM range(256) t(i)
    UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM codes WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM codes WHERE k = 8),
docs AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
sized AS (
    SELECT doc_id, sha256(body) AS digest, strlen(body) + {OVERHEAD} AS size,
           xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda p: ('0x' || p)::BIGINT)),
                                       lambda a, x: xor(a >> 8, t[1 + (xor(a, x) & 255)]))) AS text_crc32
    FROM docs, crc),
least AS (SELECT greatest(1, ceil(sum(size) / {SHARDS * SHARE}.0))::BIGINT AS least FROM sized),
groups AS (SELECT digest, sum(size)::BIGINT AS size FROM sized GROUP BY 1),
named AS (
    SELECT digest, size, CASE WHEN size >= least THEN digest ELSE 'bundle' || ('0x' || substr(digest, 1, 12))::BIGINT % {SHARDS * SHARE} END AS item
    FROM groups, least),
items AS (SELECT item, sum(size)::BIGINT AS size, row_number() OVER (ORDER BY sum(size) DESC, item) AS place FROM named GROUP BY 1),
heap(place, item, shard, loads) AS (
    SELECT 0::BIGINT, NULL::VARCHAR, NULL::BIGINT, list_transform(range({SHARDS}), lambda x: 0::BIGINT)
    UNION ALL
    SELECT i.place, i.item, list_position(loads, list_min(loads)) - 1,
           list_transform(loads, lambda l, j: CASE WHEN j = list_position(loads, list_min(loads)) THEN l + i.size ELSE l END)
    FROM heap h JOIN items i ON i.place = h.place + 1)
SELECT s.doc_id, s.size::BIGINT AS size, s.text_crc32::BIGINT AS text_crc32, 'bytes' AS law, h.shard::INT AS shard,
       row_number() OVER (PARTITION BY h.shard ORDER BY sha256(coalesce(s.doc_id::VARCHAR, '') || ':' || s.digest)) - 1 AS slot, NULL::INT AS grown_shard
FROM sized s JOIN named n USING (digest) JOIN heap h ON h.item = n.item
"""
