"""Membership of text tokens in a word set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stratamart.operators.merge import join_salted


def tokens(text: str):
    """Distinct lower-case words of a text."""
    return F.array_distinct(F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def flag_words(df: DataFrame, words: DataFrame, text: str, keys: Sequence[str]) -> DataFrame:
    """Adds ``hits``: how many different words of the set occur in the text.

    The texts become one row per distinct word and meet the word set by join, so
    the set may be of any size; the rows of a frequent word are spread over many tasks,
    and the count per text combines before its shuffle.
    """
    listed = words.select(F.lower("word").alias("_w")).distinct()
    found = df.select(*keys, F.explode(tokens(text)).alias("_w"))
    found = join_salted(found, listed, ["_w"], keys, "left_semi")
    counts = found.groupBy(*keys).agg(F.count(F.lit(1)).alias("hits"))
    return df.join(counts, list(keys), "left").withColumn("hits", F.coalesce("hits", F.lit(0)))
