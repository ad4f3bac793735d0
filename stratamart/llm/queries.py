"""One query per operator over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from stratamart.llm import (
    ball_kmeans, bitplanes, char_models, covering, mixing, prefix_counts, pu_quality, quality_rules, repeat_spans, secret_scan, templates, token_alignment, transcripts,
)
from stratamart.llm.common import table
from stratamart.llm.sql import STATEMENTS


def _over_documents(operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: operator(table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bit_planes": _over_documents(bitplanes.op1),
        "op2_templates": lambda spark, folder: templates.op2(table(spark, folder, "documents"), table(spark, folder, "benchmark")),
        "op3_quality_rules": _over_documents(quality_rules.op3),
        "op4_transcripts": lambda spark, folder: transcripts.op4(table(spark, folder, "conversations")),
        "op5_secret_scan": _over_documents(secret_scan.op5),
        "op6_covering_simhash": _over_documents(covering.op6),
        "op7_char_models": _over_documents(char_models.op7),
        "op8_prefix_counts": _over_documents(prefix_counts.op8),
        "op9_pu_quality": lambda spark, folder: pu_quality.op9(table(spark, folder, "documents"), table(spark, folder, "labels")),
        "op10_source_mix": _over_documents(mixing.op10),
        "op11_ball_kmeans": lambda spark, folder: ball_kmeans.op11(table(spark, folder, "embeddings")),
        "op12_prefix_free_parsing": _over_documents(repeat_spans.op12),
        "op13_pointer_jumping": _over_documents(token_alignment.op13),
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return dict(STATEMENTS)
