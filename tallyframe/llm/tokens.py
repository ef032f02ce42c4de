"""Exact token counts of whole texts, huge ones by overlapping chunks.

Encoding a huge text at once needs memory and time that grow faster than the text. It is cut into
chunks that overlap; both encodings of an overlap carry byte offsets, and the chunks are spliced at a
boundary that both encodings share and that no piece of the vocabulary can cross.

Why such a boundary is stable: the vocabulary has no piece in which the space mark follows another
character. A merge therefore never joins a space mark to what stands before it, so the pieces left
and right of "space after non-space" do not depend on each other. ``Splicer`` checks this property
of the vocabulary before it relies on it; without it texts are encoded whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, read_table

MODEL = "piece_bpe_32k.model"
CHUNK_BYTES = 1 << 15
OVERLAP_BYTES = 256
TOKEN_LIMIT = 4096
MARK = "▁"  # stands for a space inside the vocabulary; a literal one in a text acts as a space
MARK_BYTES = MARK.encode()


class Splicer:
    """Counts tokens of one text, by spliced chunks when it is longer than ``chunk`` bytes."""

    def __init__(self, path: str, chunk: int = CHUNK_BYTES, overlap: int = OVERLAP_BYTES):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        self.splits = not any(MARK in p.lstrip(MARK) for p in pieces)
        self.chunk, self.overlap, self.widened = chunk, overlap, 0

    def count_all(self, texts: list[str]) -> list[int]:
        """Token counts in order; short texts go to the encoder together."""
        out = [0] * len(texts)
        short = [i for i, t in enumerate(texts) if t and len(t) <= self.chunk // 4]
        for i, ids in zip(short, self.model.encode([texts[i] for i in short], num_threads=1)):
            out[i] = len(ids)
        for i, t in enumerate(texts):
            if len(t) > self.chunk // 4:
                out[i] = self.count(t)
        return out

    def count(self, text: str) -> int:
        data = text.encode()
        if len(data) <= self.chunk or not self.splits:
            return len(self.model.encode(text, num_threads=1))
        total, begin = 0, 0
        cut = min(len(data), self.chunk)
        starts = self._starts(data, begin, self._char(data, cut))
        while cut < len(data):
            # The next chunk begins `width` bytes before the cut; both encodings cover the overlap.
            width = self.overlap
            while True:
                low = self._stable(data, max(begin, cut - width), cut, begin)
                if low is None:  # no stable place to begin: look further back, at last extend this chunk
                    if cut - width <= begin:
                        break
                    width, self.widened = width * 2, self.widened + 1
                    continue
                end = min(len(data), low + self.chunk)
                ahead = self._starts(data, low, self._char(data, end))
                at = self._common(data, starts, ahead, low, cut)
                if at is not None:
                    break
                if cut - width <= begin:
                    low = None
                    break
                width, self.widened = width * 2, self.widened + 1
            if low is None:
                cut, self.widened = min(len(data), cut + self.chunk), self.widened + 1
                starts = self._starts(data, begin, self._char(data, cut))
                continue
            total += int(np.searchsorted(starts, at))
            begin, cut = at, end
            starts = ahead[np.searchsorted(ahead, at):]
        return total + len(starts)

    def _starts(self, data: bytes, begin: int, end: int) -> np.ndarray:
        """Byte offsets in the text at which the pieces of data[begin:end] begin.

        A chunk begins with a space (or with the text); the encoder adds one in front, so that the
        chunk's own is left out and its first piece gets the chunk's start.
        """
        skip = 0
        if begin:
            skip = 1 if data[begin] == 0x20 else len(MARK_BYTES)
        pieces = self.model.encode(data[begin + skip:end].decode(), return_type="proto").pieces
        starts = np.fromiter((p.begin for p in pieces), np.int64, len(pieces)) + (begin + skip)
        if begin and len(starts):
            starts[0] = begin
        return starts

    @staticmethod
    def _char(data: bytes, at: int) -> int:
        """The last character boundary at or before ``at``."""
        while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
            at -= 1
        return at

    @staticmethod
    def _is_stable(data: bytes, at: int) -> bool:
        mark = data[at] == 0x20 or data.startswith(MARK_BYTES, at)
        return mark and at > 0 and data[at - 1] != 0x20 and not data.endswith(MARK_BYTES, 0, at)

    def _stable(self, data: bytes, low: int, high: int, after: int) -> int | None:
        """The first stable boundary in [low, high) that is beyond ``after``."""
        return next((i for i in range(max(low, after + 1), high) if self._is_stable(data, i)), None)

    def _common(self, data: bytes, left: np.ndarray, right: np.ndarray, low: int, high: int) -> int | None:
        """The last stable boundary at which both encodings of the overlap start a piece."""
        both = np.intersect1d(left[(left >= low) & (left < high)], right[right < high])
        return next((int(i) for i in both[::-1] if self._is_stable(data, int(i))), None)


@lru_cache(maxsize=4)
def splicer(path: str, chunk: int, overlap: int) -> Splicer:
    """One encoder a Python worker."""
    return Splicer(path, chunk, overlap)


def token_counts(
    docs: DataFrame, tokenizer: str = MODEL, limit: int = TOKEN_LIMIT, chunk: int = CHUNK_BYTES, overlap: int = OVERLAP_BYTES,
) -> DataFrame:
    """Count the tokens of every whole text.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. One row a row: ``doc_id``,
    ``n_bytes`` (UTF-8), ``n_tokens`` (without begin, end or special tokens) and ``over_limit``
    (``n_tokens > limit``). A null or empty text has 0 bytes and 0 tokens; a null ``doc_id`` stays
    null; repeated rows stay; an empty table gives no rows. Nothing is shuffled.
    """
    def count_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        count = splicer(public_tokenizers.path(tokenizer), chunk, overlap).count_all
        for block in blocks(batches, "text"):
            column = block.column("text")
            n_bytes = pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())
            n_tokens = pa.array(count([t or "" for t in column.to_pylist()]), pa.int64())
            yield pa.record_batch([block.column("doc_id"), n_bytes, n_tokens], ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    counted = docs.select("doc_id", "text").mapInArrow(count_block, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts of all documents with the 32k piece vocabulary."""
    return token_counts(read_table(spark, folder, "documents"))
