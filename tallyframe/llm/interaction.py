"""Audit of five filters: what each removes, alone and behind the others, in every order.

Four filters look at one text; the fifth removes texts that are identical to one with a smaller id. To
tell identical texts, whole texts are put into radix tries, one per range of texts. Ranges are adaptive
prefixes: a prefix whose distinct texts weigh too much is lengthened (2, 4, 8, ... characters) until
what shares it fits a task, so texts that begin alike are told apart as far in as it takes.

Each trie keeps the smallest id at the node where a text ends. A task first fills a trie of its own:
every row that has a smaller id in it is a duplicate there and then, and only the smallest of each text
goes on to its range, so a text with copies in a third of all rows is sent a few times a task. The tries
of the ranges settle the rest, and every row is left with a mask of five bits.

Masks are counted by part, at most 32 a part. The 120 orders are read off these counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, give_back, read_table, written
from .wordblocks import WordBlock

FILTERS = "ABCDE"
MIN_WORDS = 100
RANGE_BYTES = 1 << 20
MOST_RANGES = 1 << 18
HELD_CHARS = 8 << 20  # characters of distinct texts that a task keeps in its own trie
HEAD = 64  # characters of a text that decide its range unless a longer prefix is too heavy
FILTER_BYTES = 1 << 20  # text a task looks at together
SIGNS = np.isin(np.arange(256), [ord(c) for c in "#$%&*|"])
CAPITALS = np.isin(np.arange(256), range(ord("A"), ord("Z") + 1))
STARTS = np.array([i & 0xC0 != 0x80 for i in range(256)])  # bytes that begin a code point


# --- the four filters on one text -----------------------------------------------------------------

def text_bounds(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in one array and where each one begins; nulls are empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return raw, offsets - offsets[0]


def counts_in(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many flags are set between neighbouring bounds."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(sums[bounds])


def distinct_words(block: WordBlock) -> np.ndarray:
    """Distinct words of each text, exact: words are numbered by a dictionary over the block."""
    n = len(block.starts)
    if not n:
        return np.zeros(len(block.n_words), np.int64)
    # Each word with the blank behind it; that blank is the same everywhere.
    offsets = np.append(block.starts, block.ends[-1] + 1).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(block.data)])
    codes = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    pairs = np.unique(block.text_of() * (codes.max() + 1) + codes)
    return np.bincount(pairs // (codes.max() + 1), minlength=len(block.n_words))


def failed_alone(texts: pa.Array) -> np.ndarray:
    """Bits 0 to 3: whether each text fails A, B, C and D."""
    raw, bounds = text_bounds(texts)
    block = WordBlock(texts)
    words = block.n_words
    a = words < MIN_WORDS
    b = 100 * distinct_words(block) < 80 * words
    c = 100 * counts_in(CAPITALS[raw], bounds) > 10 * counts_in(STARTS[raw], bounds)
    d = counts_in(SIGNS[raw], bounds) > 0
    return a | b << 1 | c << 2 | d << 3


# --- identical texts ------------------------------------------------------------------------------

class RadixTrie:
    """Compressed trie of whole texts. A node where a text ends holds its smallest id so far and, while
    the verdict on them is open, how many rows of each part have that id."""

    __slots__ = ("edges", "least", "mask", "rows")

    def __init__(self) -> None:
        self.edges: dict[str, tuple[str, RadixTrie]] = {}
        self.least: int | None = None
        self.mask = 0
        self.rows: Counter[str] = Counter()

    def insert(self, text: str) -> tuple[RadixTrie, int]:
        """The node where ``text`` ends, made if need be, and how many characters had to be added."""
        node, at = self, 0
        while at < len(text):
            edge = node.edges.get(text[at])
            if edge is None:
                leaf = RadixTrie()
                node.edges[text[at]] = (text[at:], leaf)
                return leaf, len(text) - at
            label, below = edge
            shared = len(label) if text.startswith(label, at) else common(label, text, at)
            if shared < len(label):
                middle = RadixTrie()
                middle.edges[label[shared]] = (label[shared:], below)
                node.edges[text[at]] = (label[:shared], middle)
                below = middle
            node, at = below, at + shared
        return node, 0

    def terminals(self) -> Iterator[RadixTrie]:
        """All nodes with open rows."""
        open_nodes = [self]
        while open_nodes:
            node = open_nodes.pop()
            if node.rows:
                yield node
            open_nodes.extend(below for _, below in node.edges.values())

    def meet(self, key: int, part: str, mask: int, n: int) -> Iterator[tuple]:
        """Put ``n`` rows at this end of a text; yields the rows (key, part, mask, n) that are now known to be duplicates."""
        if self.least is None or key < self.least:
            yield from self.settled(16)
            self.least, self.mask = key, mask
        if key == self.least:
            self.rows[part] += n
        else:
            yield key, part, mask | 16, n

    def settled(self, bit: int) -> Iterator[tuple]:
        """The open rows with ``bit`` added to their mask; they are open no longer."""
        for part, n in self.rows.items():
            yield self.least, part, self.mask | bit, n
        self.rows = Counter()


def common(label: str, text: str, at: int) -> int:
    """How many characters ``label`` shares with ``text`` from ``at`` on."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if label[low:middle] == text[at + low:at + middle]:
            low = middle
        else:
            high = middle - 1
    return low


def heavy_prefixes(docs: DataFrame, range_bytes: int = RANGE_BYTES, most: int = MOST_RANGES) -> dict[int, set[str]]:
    """By length: the prefixes that more text shares than one range may hold.

    Weights are bytes of distinct texts (by hash, which only balances the work). The first lengths are
    read off a table of heads; whole texts are read again only if whole heads are too heavy. A heavy
    prefix weighs at least ``range_bytes`` or the ``most``-th part of all, so their number is bounded.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    def distinct(rows: DataFrame, kept: Column) -> DataFrame:
        return rows.groupBy(kept.alias("head"), F.xxhash64("body").alias("hash")).agg(F.max(F.octet_length("body")).alias("bytes"), F.max(F.length("body")).alias("chars"))
    bodies = docs.select(text.alias("body"))
    heads = written(distinct(bodies, F.left(F.col("body"), F.lit(HEAD))), "heads")
    limit = max(range_bytes, (heads.agg(F.sum("bytes")).first()[0] or 0) // most)
    found: dict[int, set[str]] = {}
    length, source = 2, heads
    while True:
        if length > HEAD:
            begins = F.left(F.col("body"), F.lit(length // 2))
            known = F.broadcast(docs.sparkSession.createDataFrame([(p,) for p in found[length // 2]], "known string"))
            source = distinct(bodies.join(known, begins == F.col("known"), "left_semi"), F.left(F.col("body"), F.lit(length)))
        elif length > 2:
            known = F.broadcast(docs.sparkSession.createDataFrame([(p,) for p in found[length // 2]], "known string"))
            source = heads.join(known, F.left(F.col("head"), F.lit(length // 2)) == F.col("known"), "left_semi")
        # A prefix that is the whole text of all that share it cannot be lengthened and need not be.
        sums = source.groupBy(F.left(F.col("head"), F.lit(length)).alias("prefix")).agg(F.sum("bytes").alias("bytes"), F.max("chars").alias("chars"))
        heavy = {r.prefix for r in sums.where((F.col("bytes") > limit) & (F.col("chars") > length)).select("prefix").collect()}
        if not heavy:
            return found
        found[length] = heavy
        length *= 2


def range_of(text: str, heavy: dict[int, set[str]]) -> str:
    """The shortest of the tried prefixes that is light: its range of texts goes to one trie."""
    length = 2
    while text[:length] in heavy.get(length, ()):
        length *= 2
    return text[:length]


MASKED = "doc_id {id}, part string, mask int, n long"
SENT = MASKED + ", place string, body string"


def masked(docs: DataFrame, range_bytes: int = RANGE_BYTES, most: int = MOST_RANGES) -> DataFrame:
    """Rows ``doc_id``, ``part``, ``mask`` (bit i: fails the i-th filter) and ``n``, how many documents they are."""
    heavy = heavy_prefixes(docs, range_bytes, most)
    key = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(F.col("lang"), F.lit("")).alias("part"), "text")

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The text filters, and all that a task can tell about duplicates from the texts it has seen itself."""
        trie, held = RadixTrie(), 0
        for block in blocks(batches, "text", FILTER_BYTES):
            masks = failed_alone(block.column("text")).tolist()
            keys, parts, texts = (block.column(c).to_pylist() for c in ("doc_id", "part", "text"))
            known, touched = Counter(), {}
            for i, text in enumerate(texts):
                if keys[i] is None:
                    known[None, parts[i], masks[i]] += 1
                    continue
                end, added = trie.insert(text or "")
                held += added
                touched[id(end)] = end, i
                for k, part, mask, n in end.meet(keys[i], parts[i], masks[i], 1):
                    known[k, part, mask] += n
            out = [(*k, n, None, None) for k, n in known.items()]
            for end, i in touched.values():
                body = texts[i] or ""
                out += [(*row, range_of(body, heavy), body) for row in end.settled(0)]
            types = [block.schema.field("doc_id").type, pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], ["doc_id", "part", "mask", "n", "place", "body"])
            if held > HELD_CHARS:
                trie, held = RadixTrie(), 0
        del trie
        give_back()

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One trie a range; rows come sorted by range, those without one are settled already."""
        names = ["doc_id", "part", "mask", "n"]
        place, trie, types, out = None, RadixTrie(), None, []
        def rest() -> list[tuple]:
            return [row for end in trie.terminals() for row in end.settled(0)]
        for block in blocks(batches, "body"):
            types = [block.schema.field(c).type for c in names]
            yield block.filter(block.column("place").is_null()).select(names)
            bound = block.filter(block.column("place").is_valid())
            for k, part, mask, n, here, body in zip(*(bound.column(c).to_pylist() for c in (*names, "place", "body"))):
                if here != place:
                    out += rest()
                    place, trie = here, RadixTrie()
                out.extend(trie.insert(body)[0].meet(k, part, mask, n))
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                out = []
        if last := rest():
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*last), types)], names)
        del trie
        give_back()

    sent = rows.mapInArrow(local, SENT.format(id=key))
    # Rows without a range are spread by what they are; repeated ones have been counted together.
    spread = F.when(F.col("place").isNull(), F.xxhash64("doc_id", "part", "mask")).otherwise(F.xxhash64("place"))
    return sent.repartition(spread).sortWithinPartitions("place").mapInArrow(settle, MASKED.format(id=key))


# --- all orders -----------------------------------------------------------------------------------

def mask_counts(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents, good ones and toxic ones by ``part`` and ``mask``: at most 32 rows a part.

    A document is good (toxic) if any of its labels says so. Rows of one id are counted before they
    are shuffled, and null ids, which no label can have, never meet the labels.
    """
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"), F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic"))
    labelled = flags.where("doc_id is not null").groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n")).join(marks, "doc_id")
    zero = F.lit(0).cast("long")
    counted = flags.groupBy("part", "mask").agg(F.sum("n").alias("n"))
    marked = labelled.groupBy("part", "mask").agg(F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
    return counted.withColumns({"good": zero, "toxic": zero}).unionByName(marked.withColumn("n", zero)).groupBy("part", "mask").agg(
        *[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def all_orders(counts: DataFrame) -> DataFrame:
    """What each filter does at each step of each order, from the counts by mask."""
    steps = ", ".join(
        f"struct('{''.join(order)}', {step}, {FILTERS.index(f)}, {sum(1 << FILTERS.index(g) for g in order[:step - 1])})"
        for order in permutations(FILTERS) for step, f in enumerate(order, 1))
    met = counts.select("*", F.expr(f"inline(array({steps})) AS (filter_order, step, filter, before)"))
    def count(what: Column, when: Column) -> Column:
        return F.sum(F.when(when, what).otherwise(0))
    mask, n = F.col("mask"), F.col("n")
    bit = F.call_function("shiftleft", F.lit(1), F.col("filter"))
    fails, earlier = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(F.col("before")) != 0
    here = fails & ~earlier
    out = met.groupBy("part", "filter_order", "step", "filter").agg(
        count(n, ~fails & ~earlier).alias("kept"), count(n, here).alias("removed"), count(n, fails & earlier).alias("redundant"),
        count(n, mask == bit).alias("unique_fails"), count(F.col("good"), here).alias("good_lost"), count(F.col("toxic"), here).alias("toxic_lost"))
    shares = out.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    return out.join(shares, ["part", "filter"]).drop("filter")


def interaction_audit(docs: DataFrame, labels: DataFrame, range_bytes: int = RANGE_BYTES, most: int = MOST_RANGES) -> DataFrame:
    """Every filter at every step of all 120 orders, by language.

    Needs ``doc_id``, ``text`` and ``lang`` of ``docs`` and ``doc_id``, ``quality`` and ``toxic`` of
    ``labels``; other columns are ignored. A text fails A with under 100 words, B with less than 80
    distinct in 100 words, C with more than 10 capitals in 100 code points, D with any of ``#$%&*|``,
    E if a smaller id has the identical text anywhere in the table. Rows: ``part`` (null: empty
    string), ``filter_order``, ``step``, ``kept``, ``removed``, ``redundant``, ``unique_fails``,
    ``good_lost``, ``toxic_lost``, ``shapley``; 600 a part, zeros included. Null texts are empty
    texts. Rows that share id and text are no duplicates of each other and all count; a null id is
    never smaller nor larger, so such rows pass E, and no label is theirs. Texts of any length are
    compared whole. An empty table gives no rows.
    """
    flags = written(masked(docs, range_bytes, most), "masks")
    return all_orders(written(mask_counts(flags, labels), "mask_counts"))


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """The five filters audited over all documents."""
    return interaction_audit(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


#: Independent SQL over the whole tables: windows by text instead of tries, one pass an order.
OP13_SQL = r"""
WITH RECURSIVE docs AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body FROM documents),
marks AS (SELECT doc_id, max(coalesce((quality = 1)::INT, 0)) AS good, max(coalesce((toxic = 1)::INT, 0)) AS toxic FROM labels GROUP BY 1),
words AS (SELECT *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS w FROM docs),
judged AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, map {
        'A': len(w) < 100, 'B': 100 * len(list_distinct(w)) < 80 * len(w),
        'C': 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 10 * length(body), 'D': regexp_matches(body, '[#$%&*|]'),
        'E': coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false)} AS fails
    FROM words LEFT JOIN marks USING (doc_id)),
orders(filter_order) AS (
    SELECT '' UNION ALL SELECT filter_order || f FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f) WHERE NOT contains(filter_order, f)),
steps AS (SELECT filter_order, step::INT AS step, filter_order[step] AS f, list_transform(range(1, step), lambda i: filter_order[i]) AS before
          FROM orders, range(1, 6) t(step) WHERE length(filter_order) = 5),
seen AS (SELECT part, filter_order, step, f, good, toxic, fails[f] AS now, list_bool_or(list_transform(before, lambda g: fails[g])) IS TRUE AS earlier,
                len(list_filter(map_values(fails), lambda v: v)) AS failures FROM judged, steps),
told AS (
    SELECT part, filter_order, step, f, count(*) FILTER (NOT now AND NOT earlier) AS kept, count(*) FILTER (now AND NOT earlier) AS removed,
           count(*) FILTER (now AND earlier) AS redundant, count(*) FILTER (now AND failures = 1) AS unique_fails,
           coalesce(sum(good) FILTER (now AND NOT earlier), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (now AND NOT earlier), 0)::BIGINT AS toxic_lost
    FROM seen GROUP BY ALL)
SELECT * EXCLUDE (f), sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley FROM told
"""
