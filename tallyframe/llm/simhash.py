"""SimHash near-duplicates: fingerprints that differ in few bits, found by covering bit masks.

The masks come from a covering code: bit i of a fingerprint has a non-zero label of r + 1 bits, and
table v keeps the bits whose label has an odd inner product with v. For any r differing bits some v
is orthogonal to all r labels, so that table keeps none of them and the pair shares its bucket: no
pair within the radius is ever missed. Radius 2 takes seven tables of about 37 bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import blocks, read_table, unused, written
from .graph import components

SHINGLE = 3
SEED = 42
RADIUS = 2
SMALL_BUCKET = 32
BLANK = re.compile(rb"[\x20\x09-\x0D]")
LANES = np.uint64(0x0101010101010101)


def signed(bits: int) -> int:
    """The signed 64-bit integer with these bits."""
    return bits - (1 << 64) if bits >> 63 else bits


def word_runs(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text in lists from about ``size`` bytes each, in order."""
    at = 0
    while at < len(data):
        cut = BLANK.search(data, at + size)
        end = cut.start() if cut else len(data)
        yield data[at:end].split()
        at = end


def ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set; byte lanes are added 255 rows at a time."""
    total = np.zeros(64, np.int64)
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & LANES, np.arange(0, len(hashes), 255))
        total[bit::8] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return total


def fingerprint(data: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of one text (UTF-8), as a signed 64-bit integer."""
    from xxhash import xxh64_intdigest

    total, n, carry = np.zeros(64, np.int64), 0, []
    for run in word_runs(data.lower()):
        carry += run
        if len(carry) < shingle:
            continue
        shingles = list(map(b" ".join, zip(*(carry[i:] for i in range(shingle)))))
        total += ones(np.fromiter(map(xxh64_intdigest, shingles, repeat(seed)), np.uint64, len(shingles)))
        n += len(shingles)
        carry = carry[len(carry) - shingle + 1:]
    if not n:
        if not carry:
            return 0
        total, n = ones(np.array([xxh64_intdigest(b" ".join(carry), seed)], np.uint64)), 1
    return signed(int.from_bytes(np.packbits(2 * total > n, bitorder="little").tobytes(), "little"))


def with_fingerprint(docs: DataFrame, column: str = "fp", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` and a column with the signed 64-bit fingerprint of ``text``; no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            texts = block.column("text").cast(pa.large_binary())
            found = pa.array([fingerprint(t.as_py() or b"", shingle) for t in texts], pa.int64())
            yield block.append_column(column, found)

    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.LongType())])
    return docs.mapInArrow(run, schema)


def covering_masks(radius: int = RADIUS) -> list[int]:
    """2**(radius + 1) - 1 signed 64-bit masks; labels go round so that the tables keep equal shares."""
    size = (1 << (radius + 1)) - 1
    labels = [1 + i % size for i in range(64)]
    masks = [sum(1 << i for i in range(64) if (labels[i] & v).bit_count() % 2) for v in range(1, size + 1)]
    return [signed(m) for m in masks]


def close_pairs(fingerprints: DataFrame, radius: int = RADIUS, small: int = SMALL_BUCKET) -> DataFrame:
    """Links (``a``, ``b``) that join every two distinct fingerprints (``fp``) within the radius.

    Buckets of at most ``small`` members compare their members. Larger ones do not: two members
    differ only in bits that their table leaves out, so (for radius 2) both stand one flip of such a
    bit away from a common point. Each member is sent to its points, at most one per left-out bit,
    and the members that meet at a point, never more than those bits, hang under the smallest.
    """
    if radius != 2:
        raise ValueError("large buckets are split for radius 2")
    masks = covering_masks(radius)
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("k"), F.lit(m).alias("mask")) for t, m in enumerate(masks)])
    entries = fingerprints.select("fp", F.inline(tables))
    full = entries.groupBy("t", "k").agg(F.count("*").alias("n")).where("n > 1")
    marked = entries.join(full, ["t", "k"])

    groups = marked.where(F.col("n") <= small).groupBy("t", "k").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
    def linked(fps: Column) -> Column:
        return F.flatten(F.transform(fps, lambda x, i: F.transform(
            F.filter(F.slice(fps, i + 2, small), lambda y: F.bit_count(x.bitwiseXOR(y)) <= radius),
            lambda y: F.struct(x.alias("a"), y.alias("b")))))
    near = groups.select(F.inline(linked(F.col("fps"))))

    flips = F.filter(F.array(*[F.lit(signed(1 << i)) for i in range(64)]), lambda bit: bit.bitwiseAND(F.col("mask")) == 0)
    points = F.concat(F.array("fp"), F.transform(flips, lambda bit: F.col("fp").bitwiseXOR(bit)))
    met = (marked.where(F.col("n") > small).select("t", "fp", F.explode(points).alias("z"))
           .groupBy("t", "z").agg(F.sort_array(F.collect_list("fp")).alias("fps")).where(F.size("fps") > 1))
    hung = met.select(F.col("fps")[0].alias("a"), F.explode(F.slice("fps", 2, 64)).alias("b"))
    return near.unionByName(hung)


def near_duplicates(keyed: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The class of every row: ``keyed`` (written, with ``doc_id`` and ``fp``) plus ``component_id``.

    ``component_id`` is the smallest non-null ``doc_id`` reachable over links; null if there is none.
    Equal fingerprints are one node, so copies collapse before anything is compared.
    """
    nodes = written(keyed.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(close_pairs(nodes, radius)).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return keyed.join(named, "fp")


def simhash_components(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Fingerprint and near-duplicate class of every document.

    Needs ``doc_id`` and ``text``; other columns are ignored. One row a row: ``doc_id``,
    ``fingerprint`` (16 hex digits), ``component_id``. Null and blank texts have fingerprint zero and
    link like any other; texts of fewer than three words are one shingle. Repeated rows stay. A null
    ``doc_id`` takes part in linking but names no class. An empty table gives no rows.
    """
    keyed = written(with_fingerprint(docs.select("doc_id", "text")).select("doc_id", "fp"), "fingerprints")
    return near_duplicates(keyed, radius).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def least_row(docs: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``columns`` of one row for each value of ``keys``, merged on the map side: that of the smallest text digest.

    Of equal texts the row of the smallest hash over the other columns stays; maps and variants do not count.
    """
    hashed = [f"`{c}`" for c in columns if not any(x in docs.schema[c].dataType.simpleString() for x in ("map<", "variant"))]
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)])
    order = F.struct(F.sha2(F.col("text"), 256), F.xxhash64(*hashed))
    name = unused(columns, "_least")
    least = docs.groupBy(*[f"`{k}`" for k in keys]).agg(F.min_by(row, order).alias(name))
    return least.select(*[F.col(name)[f"c{i}"].alias(c) for i, c in enumerate(columns)])


def one_of_each(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row of each near-duplicate class: that of the smallest ``doc_id``.

    Rows that share their ``doc_id`` are one document and leave one row, that of the smallest text digest.
    Rows without an id stay only where their class has no id at all, again one row a class. Columns may have
    any names. Texts are read twice and travel once.
    """
    fp, root = unused(docs.columns, "_fp"), unused(docs.columns, "_root")
    keyed = written(with_fingerprint(docs.select("doc_id", "text")).select("doc_id", "fp"), "fingerprints")
    classes = written(near_duplicates(keyed, radius).select("doc_id", "fp", "component_id"), "classes")
    stay = classes.where("doc_id = component_id").select("doc_id").distinct()
    named = least_row(docs.join(stay, "doc_id", "left_semi"), ["doc_id"], docs.columns)
    # Nameless classes are rare: their rows find each other by the class's smallest fingerprint.
    nameless = classes.where("component_id is null")
    if nameless.isEmpty():
        return named
    nodes = nameless.select("fp").distinct()
    roots = components(close_pairs(nodes, radius)).withColumnsRenamed({"node": "fp", "root": "top"})
    roots = nodes.join(roots, "fp", "left").select(F.col("fp").alias(fp), F.coalesce("top", "fp").alias(root))
    rest = with_fingerprint(docs.where("doc_id is null"), fp).join(roots, fp)
    return named.unionByName(least_row(rest, [root], docs.columns))


def op9_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate classes of all documents."""
    return simhash_components(read_table(spark, folder, "documents"))
