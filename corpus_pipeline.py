"""The training-data pipeline: documents through quality rules, near-duplicate removal, decontamination, mixing and binary output.

Each stage takes (spark, docs, sf_dir) and returns rows; ``run`` writes each stage's rows as Parquet in the shared folder and
hands the reread table to the next.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from stratamart.llm import bitplanes, covering, mixing, quality_rules, similar, templates  # noqa: E402
from stratamart.llm.common import scratch_table, table  # noqa: E402


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that break a rule go."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6 on five-word shingles: of each group linked by a Jaccard similarity of at least 0.8 the document with the smallest id stays."""
    return covering.one_per_group(docs, similar.groups)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that leak a benchmark item go."""
    return templates.clean(docs, table(spark, sf_dir, "benchmark"))


def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: each source by its weight; documents repeat by epochs, and one per source is cut at the budget."""
    return mixing.mixed(docs)


def to_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: token ids in bit planes; returns each document's place and checksum as read back from the files."""
    return bitplanes.op1(docs)


STAGES = [
    ("quality_rules", good_quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("source_mix", to_weights),
    ("token_ids", to_token_ids),
]

#: The tokenizer and the fingerprints have no SQL form; tests/llm/test_pipeline.py compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch_table(stage(spark, docs, sf_dir), f"pipeline/{name}")
    return docs
