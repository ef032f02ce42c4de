"""Substring dedup: word windows that already occurred, counted in super-k-mer buckets.

A window is ``size`` consecutive words. Its minimiser is the smallest hash of its word triples;
consecutive windows with the same minimiser travel as one packed string (a super-k-mer) to the
bucket of that minimiser, so equal windows always meet and each word is sent about three times
instead of ``size`` times. A bucket sorts its windows and finds where each word sequence starts
first; hashes only order the windows, word numbers decide equality.

Hot passages: within a task's block of texts a super-k-mer's string is sent once however often it
occurs. Only its first place there has to be judged by the bucket. The other places certainly come
later, so their removal is already known and goes to any bucket, spread evenly. Repeated rows are the
same place and go nowhere.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, read_table, written
from .simhash import word_runs
from .wordblocks import WordBlock, mixed, run_hashes, sliding

WINDOW = 20
TRIPLE = 3
BUCKET_BYTES = 8 << 20
PACKED = "bucket int, packed binary, places binary"
SPANS = "doc_id long, low long, high long"


def super_kmers(block: pa.RecordBatch, size: int, buckets: int) -> Iterator[tuple]:
    """Rows of PACKED for a block of (doc_id, text): ``packed`` null means removals already known.

    A packed row holds one string for each of its places. A place is a document, a first word and the
    end (exclusive) of the windows that start there and are to be judged.
    """
    import zstandard

    text = WordBlock(block.column("text"))
    ids = block.column("doc_id").to_numpy(zero_copy_only=False)
    if len(text.ends) < size:
        return
    least = sliding(run_hashes(text.hashes(), TRIPLE), size - TRIPLE + 1)
    owner = text.text_of()
    inside = owner[:len(least)] == owner[size - 1:]
    breaks = np.ones(len(least) + 1, bool)
    breaks[1:-1] = (least[1:] != least[:-1]) | (owner[1:len(least)] != owner[:len(least) - 1]) | ~inside[1:] | ~inside[:-1]
    begin = np.flatnonzero(breaks)
    begin, end = begin[:-1], begin[1:]
    begin, end = begin[inside[begin]], end[inside[begin]]
    if not len(begin):
        return
    doc, start = ids[owner[begin]], begin - text.first[owner[begin]]
    bucket = (mixed(least[begin] ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(buckets)).astype(np.int32)
    order = np.lexsort((start, doc, bucket))  # the first place of a string comes first
    data, low, high = text.data.tobytes(), text.starts[begin], text.ends[end + size - 2]
    packer, later = zstandard.ZstdCompressor(level=3), []

    def places(at: np.ndarray) -> bytes:
        return packer.compress(np.concatenate([np.diff(doc[at], prepend=0), start[at], end[at] - begin[at]]).tobytes())

    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket[order])) + 1, [len(order)]])
    for a, b in zip(cuts[:-1], cuts[1:]):
        strings, here = {}, []
        for i in order[a:b].tolist():
            string = data[low[i]:high[i]]
            first = strings.setdefault(string, i)
            if first == i:
                here.append(i)
            elif (doc[i], start[i]) != (doc[first], start[first]):  # else a repeated row: the same place
                later.append(i)
        yield int(bucket[here[0]]), packer.compress(b"\n".join(strings)), places(np.array(here))
    if later:
        yield zlib.crc32(data[:256]) % buckets, None, places(np.array(later))


def repeated_starts(strings: bytes, doc: np.ndarray, start: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(doc, start) of every window in a bucket whose word sequence starts earlier elsewhere.

    ``strings`` holds one super-k-mer a line, in the order of ``doc`` and ``start``.
    """
    data = np.frombuffer(strings, np.uint8)
    blank = (data == 0x20) | (data == 0x0A)
    edges = np.concatenate([[0], np.flatnonzero(blank) + 1]).astype(np.int64)
    spaced = np.where(blank, np.uint8(0x20), data)
    words = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(spaced)])
    number = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.uint64)
    last = data[edges[1:] - 1] == 0x0A  # word ends a super-k-mer
    line = np.concatenate([[0], np.cumsum(last[:-1])])
    first_word = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1])
    at = np.flatnonzero(line[:len(line) - size + 1] == line[size - 1:])  # windows by their first word
    key = run_hashes(number, size)[at]
    doc, start = doc[line[at]], start[line[at]] + at - first_word[line[at]]
    order = np.argsort(key, kind="stable")
    same = np.concatenate([[False], key[order][1:] == key[order][:-1]])
    part = same.copy()
    part[:-1] |= same[1:]
    order = order[part]  # only windows whose hash occurs twice
    if not len(order):
        return doc[:0], start[:0]
    # Equal hashes are put to the test: all words of a window against the first window of its hash.
    span, key = np.arange(size), key[order]
    group = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])) - 1
    head = at[order[np.searchsorted(group, np.arange(group[-1] + 1))]]
    equal = np.ones(len(order), bool)
    for i in range(0, len(order), 1 << 18):
        part = slice(i, i + (1 << 18))
        equal[part] = (number[at[order[part]][:, None] + span] == number[head[group[part]][:, None] + span]).all(axis=1)
    if not equal.all():  # different windows under one hash: number the windows by their words
        group = np.unique(number[at[order][:, None] + span], axis=0, return_inverse=True)[1].ravel()
    doc, start = doc[order], start[order]
    by = np.lexsort((start, doc, group))
    doc, start, group = doc[by], start[by], group[by]
    head = np.concatenate([[True], group[1:] != group[:-1]])
    head = np.flatnonzero(head)[np.cumsum(head) - 1]
    repeat = (doc != doc[head]) | (start != start[head])
    return doc[repeat], start[repeat]


def merged_spans(doc: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    """Word ranges [low, high) of documents with overlapping ones joined."""
    by = np.lexsort((high, low, doc))
    doc, low, high = doc[by], low[by], high[by]
    cut = np.ones(len(doc), bool)
    # Ranges of one document are sorted by low and differ little in length, so the last end is enough
    # to join most; what stays apart is joined later by the reader of the spans.
    cut[1:] = (doc[1:] != doc[:-1]) | (low[1:] > high[:-1])
    begin = np.flatnonzero(cut)
    return pa.record_batch([pa.array(doc[begin]), pa.array(low[begin]), pa.array(np.maximum.reduceat(high, begin) if len(begin) else high)], ["doc_id", "low", "high"])


def repeated_spans(docs: DataFrame, size: int = WINDOW, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Word ranges (``doc_id``, ``low``, ``high``) covered by windows that start earlier elsewhere."""
    if size < TRIPLE:
        raise ValueError(f"a window has at least {TRIPLE} words")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, -(-3 * total // bucket_bytes))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text"):
            rows = list(super_kmers(block, size, buckets))
            kinds = [pa.int32(), pa.binary(), pa.binary()]
            yield pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["bucket", "packed", "places"])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack, held, bucket = zstandard.ZstdDecompressor(), [], None

        def settle():
            found = [np.frombuffer(unpack.decompress(p), np.int64).reshape(3, -1) for _, p in held]
            found = [(np.cumsum(d), low, low + n) for d, low, n in found]
            known = [f for f, h in zip(found, held) if h[0] is None]
            new = [f for f, h in zip(found, held) if h[0] is not None]
            parts = [(d, s, e + size - 1) for d, s, e in known]
            if new:
                strings = b"".join(unpack.decompress(h[0]) + b"\n" for h in held if h[0] is not None)
                doc, start = repeated_starts(strings, *(np.concatenate(c) for c in list(zip(*new))[:2]), size)
                parts.append((doc, start, start + size))
            return merged_spans(*(np.concatenate(c) for c in zip(*parts)))

        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != bucket and held:
                    yield settle()
                    held = []
                bucket = row["bucket"]
                held.append((row["packed"], row["places"]))
        if held:
            yield settle()

    named = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long"), "text")
    packed = named.mapInArrow(pack, PACKED).repartition(max(1, buckets // 4), "bucket").sortWithinPartitions("bucket")
    return packed.mapInArrow(judge, SPANS)


def substring_dedup(docs: DataFrame, size: int = WINDOW, with_text: bool = False) -> DataFrame:
    """Remove every word covered by a window whose word sequence also starts earlier.

    Needs ``doc_id`` (an integer that names the document; earlier means smaller) and ``text``; other
    columns are ignored. One row a row: ``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` (of
    the kept words joined by one space) and, if asked for, ``kept_text``. Null, blank and short texts
    keep all their words. Rows with a null ``doc_id`` are compared with nothing and kept whole.
    Repeated rows (same ``doc_id`` and text) start at the same place, so they get the same result.
    An empty table gives no rows.
    """
    spans = written(repeated_spans(docs, size), "spans")
    spans = spans.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("spans"))

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        packer = zstandard.ZstdCompressor(level=1)
        for block in blocks(batches, "text"):
            texts = [packer.compress((t or "").encode()) for t in block.column("text").to_pylist()]
            yield pa.record_batch([block.column("doc_id"), pa.array(texts, pa.binary())], ["doc_id", "packed"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor()
        for block in blocks(batches, "packed"):
            rows = [kept(unpack.decompress(t), s or []) for t, s in zip(block.column("packed").to_pylist(), block.column("spans").to_pylist())]
            columns = [pa.array(c) for c in zip(*rows)]
            yield pa.record_batch([block.column("doc_id"), *columns][:len(names)], names)

    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept_text"] * with_text
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    texts = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(shrink, "doc_id long, packed binary")
    return texts.join(spans, "doc_id", "left").mapInArrow(cut, schema)


def kept(text: bytes, spans: list[dict]) -> tuple[int, int, str, str]:
    """Words, removed words, SHA-256 of the kept words, the kept words; ``spans`` sorted by ``low``."""
    found = [w for run in word_runs(text) for w in run]
    left, at = [], 0
    for span in spans:
        left += found[at:span["low"]] if span["low"] > at else []
        at = max(at, span["high"])
    left += found[at:]
    out = b" ".join(left)
    return len(found), len(found) - len(left), hashlib.sha256(out).hexdigest(), out.decode()


def op10_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated passages of 20 words removed from all documents."""
    return substring_dedup(read_table(spark, folder, "documents"))
