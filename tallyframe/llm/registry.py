"""The queries of the training-data operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline

from . import chat, decontaminate, interaction, langid, mixing, pii, quality, sharding, simhash, substrings, tokens, warc, whitening

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    found = [decontaminate.op1_benchmark_decontamination, langid.op2_language_id, tokens.op3_token_counts, chat.op4_chat_formatting, mixing.op5_source_mixing, pii.op6_personal_data, quality.op7_quality_rules, warc.op8_warc_fixity, simhash.op9_simhash_near_dedup, substrings.op10_substring_dedup, whitening.op11_embedding_whitening, sharding.op12_sharding, interaction.op13_filter_audit]
    return {q.__name__: q for q in found} | {"pipeline": corpus_pipeline.run}


def oracles() -> dict[str, str]:
    return {"op8_warc_fixity": warc.OP8_SQL, "op12_sharding": sharding.OP12_SQL, "op13_filter_audit": interaction.OP13_SQL}
