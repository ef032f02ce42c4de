"""Shared pieces of the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.session import use_checkpoint_dir
from tallyframe.sources.tables import read_table  # noqa: F401

#: The characters that separate words in every operator: space and U+0009 to U+000D.
SPACES = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text a Python task looks at together; one longer text is a block of its own.
BLOCK_BYTES = 1 << 21


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts lineage like ``checkpoint()``: lost executors lose nothing that is already written. Columns
    can still be pruned afterwards.
    """
    spark = df.sparkSession
    use_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts give an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"{SPACES}+", -1), lambda w: w != "")


def blocks(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``limit`` bytes of ``column`` at most.

    A text above the limit travels alone and whole.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def give_back() -> None:
    """Return memory that this worker has freed to the system, where the C library can.

    For the end of a task whose worker may idle beside tasks of another kind.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)



def unused(columns: list[str], name: str) -> str:
    """``name``, or with underscores behind it, so that no column is called so; Spark ignores case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
