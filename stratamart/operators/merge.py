"""Putting measures of different facts on one grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F


def stack_sums(keys: Sequence[str], inputs: Sequence[DataFrame], measures: Mapping[str, str]) -> DataFrame:
    """Full outer join of facts on a shared grain, as union then one aggregate.

    ``measures`` maps each measure to its SQL type.  A measure that no input
    gives for a key stays null, as in the join.  Null keys meet, which a join
    would not do, and a hot key is combined before the shuffle.  The same plan
    works on streams, where two aggregates cannot be joined.
    """
    parts = []
    for df in inputs:
        have = set(df.columns)
        cols = [F.col(k) for k in keys]
        cols += [
            (F.col(m).cast(t) if m in have else F.lit(None).cast(t)).alias(m) for m, t in measures.items()
        ]
        parts.append(df.select(*cols))
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


#: Tasks among which rows without a key are dealt; they meet nothing.
KEYLESS = 4096


def join_salted(fact: DataFrame, one_per_key: DataFrame, on: Sequence[str], spread_by: Sequence[str], how: str = "left", salts: int = 16) -> DataFrame:
    """Join of a fact with a table of one row per key, where one key may hold most of the fact.

    A side that is an aggregate on the join key keeps adaptive execution from splitting a hot key, so the fact is spread over
    ``salts`` by a hash of ``spread_by`` and the small side is copied to each.  Rows of the fact with a null key go along under salts that no copy has, so the fact is made and read once.
    """
    has_key = F.col(on[0]).isNotNull()
    for k in on[1:]:
        has_key = has_key & F.col(k).isNotNull()
    spread = F.xxhash64(*spread_by)
    salted = fact.withColumn("_salt", F.when(has_key, F.pmod(spread, F.lit(salts))).otherwise(-1 - F.pmod(spread, F.lit(KEYLESS))).cast("int"))
    copies = one_per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def signed_balance(plus: DataFrame, minus: DataFrame, measures: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """What came in less what went out."""
    gone = minus.select(*keys, *[(-F.col(m)).alias(m) for m in measures])
    both = plus.select(*keys, *measures).unionByName(gone)
    return both.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])


def sum_once(df: DataFrame, once: Sequence[str], amount: str, grain: Sequence[str], count: str, total: str) -> DataFrame:
    """Sum an amount that is repeated on several rows: largest per ``once``, then per grain."""
    single = df.groupBy(*dict.fromkeys([*once, *grain])).agg(F.max(amount).alias("_amount"))
    return single.groupBy(*grain).agg(F.count(F.lit(1)).alias(count), F.sum("_amount").alias(total))


def beside(*one_row: DataFrame) -> DataFrame:
    """One-row aggregates side by side: stacked with nulls for what the others hold, then merged into one row."""
    stacked = one_row[0]
    for df in one_row[1:]:
        stacked = stacked.unionByName(df, allowMissingColumns=True)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def latest_per_key(df: DataFrame, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    """Current row of each key in a table that is written by appending versions."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*version)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def accumulate(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Add rows to a report so that a repeated run changes nothing."""
    return existing.unionByName(new).distinct()


def without_keys(df: DataFrame, keys_gone: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(keys_gone, list(on), "left_anti")
