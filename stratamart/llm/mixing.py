"""Mixing sources to target weights.

Every document gets a hash-random key.  Documents are range-sorted by source and key, distributed prefix sums of their
sizes say how many words of the source lie before each, and each source is cut at its exact budget: as many whole epochs
as the budget holds, and from one more epoch the documents before the cut and the words of one document up to it.

Budgets share all words by weight.  A source cannot give more than ``MAX_EPOCHS`` times its size; what it leaves is
shared again by weight among the rest.  That is a level L with sum(min(cap, L * weight)) = all words, found from prefix
sums over the sources sorted by cap / weight.

Defined cases: a null or empty text has size 0 and is taken 0 times; null sources form one source, the last; rows
repeated in id and text share a key, and where the cut falls among them each takes the same whole number of words, so a source may
end below its budget by fewer words than there are repeats; no rows give no rows; extra columns are not read by ``plan_mix``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stratamart.llm.common import BLANK, WORD, running_totals, stored

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 17
#: Rows up to which the table of sources may be broadcast; larger ones are joined by a shuffle.
BROADCAST_SOURCES = 100_000


def size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def random_key(doc_id: Column, text: Column) -> Column:
    """The same on every run; the text tells rows with one id apart."""
    part = lambda c: F.coalesce(c.cast("string"), F.lit("-"))
    return F.md5(F.concat_ws("/", F.lit(str(SEED)), part(doc_id), F.md5(F.coalesce(text, F.lit("")).cast("binary"))).cast("binary"))


def _source(df: DataFrame) -> DataFrame:
    """Sources as two columns without nulls, in the order of the weights."""
    return df.withColumns({"no_source": F.col("source").isNull(), "source_key": F.coalesce("source", F.lit(""))})


SOURCE = ["no_source", "source_key"]


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sources`` (SOURCE, source_size) with ``target``."""
    ranked = running_totals(sources.withColumn("one", F.lit(1).cast("bigint")), [], SOURCE, {"rank": "one"}).drop("one")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")).cast("bigint")
    s = ranked.withColumns({"weight": weight, "cap": max_epochs * F.col("source_size")}).withColumn("reach", F.col("cap") / F.col("weight"))
    s = stored(running_totals(s, [], ["reach", *SOURCE], {"caps_before": "cap", "weights_before": "weight"}))
    whole = s.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weights")).first()
    level = (F.lit(whole["words"]) - F.col("caps_before")) / (F.lit(whole["weights"]) - F.col("weights_before"))
    found = s.withColumn("level", level).filter("level <= reach").agg(F.min_by("level", F.struct("reach", *SOURCE))).first()[0]
    return s.select(*SOURCE, "source_size", F.least(F.lit(found).cast("double") * F.col("weight"), F.col("cap").cast("double")).alias("target"))


def plan_mix(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What each document gives (doc_id, key, SOURCE, size, source_size, target, taken), and each source's cut (SOURCE, epochs, cut_key, cut_words)."""
    rows = _source(docs.select("doc_id", "source", size(F.col("text")).alias("size"), random_key(F.col("doc_id"), F.col("text")).alias("key")))
    rows = rows.drop("source")
    rows = stored(running_totals(rows, SOURCE, ["key"], {"before": "size"}))
    sources = targets(rows.groupBy(*SOURCE).agg(F.sum("size").alias("source_size")))
    budget = F.floor(F.col("target") + 0.5)
    whole = F.coalesce(F.floor(budget / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0))
    sources = sources.withColumn("epochs", whole).withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    sources = stored(sources)
    rows = rows.join(_small(sources), SOURCE)
    # Rows of one key (repeats of one text under one id) are cut alike.
    at = F.col("before") < F.col("rest")
    cut = rows.filter(at).groupBy(*SOURCE).agg(F.max("key").alias("cut_key"))
    group = rows.join(_small(cut), SOURCE).filter(F.col("key") == F.col("cut_key"))
    cut = group.groupBy(*SOURCE, "cut_key").agg(
        F.least(F.floor((F.first("rest") - F.min("before")) / F.count(F.lit(1))), F.first("size")).alias("cut_words")
    )
    cuts = stored(sources.join(cut, SOURCE, "left").select(*SOURCE, "epochs", "cut_key", "cut_words"))
    given = rows.drop("epochs").join(_small(cuts), SOURCE).withColumn("taken", taken(F.col("size")))
    return given.select("doc_id", "key", *SOURCE, "size", "source_size", "target", "taken"), cuts


def taken(whole: Column) -> Column:
    """Words of a document of this size that the mix takes, in terms of its source's cut."""
    part = F.when(F.col("key") < F.col("cut_key"), whole).when(F.col("key") == F.col("cut_key"), F.col("cut_words")).otherwise(F.lit(0))
    return (F.col("epochs") * whole + part).cast("bigint")


def _small(sources: DataFrame) -> DataFrame:
    """Broadcast a table with one row per source if its counted size allows it."""
    return F.broadcast(sources) if sources.count() <= BROADCAST_SOURCES else sources


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, with all its columns.

    The document that a source's budget cuts comes once more with its text up to the last word taken.
    Only the cuts, one row per source, are joined: texts are not shuffled.
    """
    _, cuts = plan_mix(docs)
    rows = docs.select(F.struct(*docs.columns).alias("row"), "source", random_key(F.col("doc_id"), F.col("text")).alias("key"))
    rows = _source(rows).drop("source").join(_small(cuts), SOURCE)
    at_cut = (F.col("key") == F.col("cut_key")) & (F.col("cut_words") > 0)
    pieces = F.regexp_extract_all(F.col("row.text"), F.lit(f"{BLANK}*{WORD}"), F.lit(0))
    head = F.when(at_cut, F.array_join(F.slice(pieces, F.lit(1), F.col("cut_words").cast("int")), ""))
    whole = F.array_repeat(F.lit(False), (F.col("epochs") + F.coalesce(F.col("key") < F.col("cut_key"), F.lit(False)).cast("int")).cast("int"))
    copies = F.concat(whole, F.when(at_cut, F.array(F.lit(True))).otherwise(F.array().cast("array<boolean>")))
    rows = rows.select("row", F.explode(copies).alias("part"), head.alias("head"))
    return rows.select(*[(F.when(F.col("part"), F.col("head")).otherwise(F.col("row.text")) if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns])


def op10(docs: DataFrame) -> DataFrame:
    given, _ = plan_mix(docs)
    return given.select("doc_id", "size", "source_size", "target", "taken")
