"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidemark.llm import covertree, divergence, licences, lines, lm, mixing, periodic, pieces, pii, quality, sharding, simhash, urls

Query = Callable[[SparkSession, str], DataFrame]


def build() -> dict[str, Query]:
    return {
        "pipeline": corpus_pipeline.run,
        "op1_embedding_near_dedup": covertree.op1_embedding_near_dedup,
        "op2_sentencepiece": pieces.op2_sentencepiece,
        "op3_simhash_near_dedup": simhash.op3_simhash_near_dedup,
        "op4_line_dedup": lines.op4_line_dedup,
        "op5_sharding": sharding.op5_sharding,
        "op6_url_filter": urls.op6_url_filter,
        "op7_licence_scan": licences.op7_licence_scan,
        "op8_lm_scoring": lm.op8_lm_scoring,
        "op9_quality_rules": quality.op9_quality_rules,
        "op10_source_mixing": mixing.op10_source_mixing,
        "op11_source_divergence": divergence.op11_source_divergence,
        "op12_periodic_runs": periodic.op12_periodic_runs,
        "op13_pii": pii.op13_pii,
    }


def oracles() -> dict[str, str]:
    return {
        "op4_line_dedup": lines.OP4_SQL,
        "op9_quality_rules": quality.OP9_SQL,
        "op10_source_mixing": mixing.OP10_SQL,
        "op11_source_divergence": divergence.OP11_SQL,
    }
