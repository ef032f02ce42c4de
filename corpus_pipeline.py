"""The corpus pipeline: quality rules, near-duplicates, decontamination, personal data, mixing.

Every stage takes ``(spark, docs, sf_dir)``: ``docs`` are the rows that the stage before it kept, with
the columns of ``documents``. All but the last return those columns. Stages are lazy; the runner
writes each result as Parquet and reads it back for the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyframe.llm import decontaminate, mixing, pii, quality, simhash
from tallyframe.llm.common import read_table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the risk-controlled cutoffs; the labels set the cutoffs."""
    return quality.good_documents(docs, read_table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate group, the one with the smallest id."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by placeholders."""
    return pii.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix at its target weights: rows as often as they are drawn, with ``mix_copy`` and ``mix_shard``."""
    return mixing.mixed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_good),
    ("simhash_near_dedup", keep_one_of_each),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", redact),
    ("source_mixing", mix),
]

#: The learned cutoffs, edit distances and random draws have no SQL form; tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
