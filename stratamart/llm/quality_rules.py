"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

A rule bounds the ratio of two measures of a text.  ``verdicts`` computes each measure once per document, in arrays
inside the row: nothing is shuffled, and no user function runs.

Defined cases: a null text has no words; a document without words fails the base; a ratio over zero breaks no rule;
repeated rows each get their verdict; extra columns of the input are not read, so their names cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from stratamart.llm.common import words

#: Frequent short words of the languages that the corpus holds.
STOP_WORDS = {
    "en": "the of and to in a is that for it with was be by on are this from or an as at",
    "de": "der die das und in zu den von mit ist des im dem nicht ein eine auf für sich als",
    "fr": "de la le les et des en un une du dans est que pour qui par sur au avec pas",
    "es": "de la el los y en que las un una del por con para es se no al su lo",
}
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """``low`` <= ``top`` / ``bottom`` <= ``high``; the measures are named in ``MEASURES``."""

    name: str
    top: str
    bottom: str
    low: float
    high: float


#: The production thresholds.
RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 12.0),
    Rule("symbols_per_word", "n_symbols", "n_words", 0.0, 0.1),
    Rule("marks_per_word", "n_marks", "n_words", 0.0, 0.5),
    Rule("letters", "n_letters", "word_chars", 0.6, 1.0),
    Rule("capitals", "n_capitals", "word_chars", 0.0, 0.4),
    Rule("stop_words", "n_stop_words", "n_words", 0.02, 1.0),
    Rule("repeated_lines", "n_dup_lines", "n_lines", 0.0, 0.4),
    Rule("repeated_words", "n_repeat_words", "n_words", 0.0, 0.4),
)
MIN_WORDS = 50


def _only(text: Column, kept: str) -> Column:
    """Number of characters of a class."""
    return F.length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("bigint")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _stop(word: Column) -> Column:
    return word.isin(*sorted({w for line in STOP_WORDS.values() for w in line.split()}))


def measures(docs: DataFrame) -> DataFrame:
    """``doc_id`` with all measures.  Each step names what the next uses more than once, so nothing is computed twice."""
    size = lambda a: F.size(a).cast("bigint")
    after = lambda a, k: F.slice(a, k + 1, F.greatest(F.size(a) - k, F.lit(0)))
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    d = d.select("*", words(F.col("t")).alias("w"), F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    triples = F.arrays_zip(F.col("w").alias("a"), after(F.col("w"), 1).alias("b"), after(F.col("w"), 2).alias("c"))
    windows = F.transform(
        F.slice(triples, 1, F.greatest(F.size("w") - 2, F.lit(0))),
        lambda x, i: F.struct(F.xxhash64(x["a"], x["b"], x["c"]).alias("h"), i.alias("i")),
    )
    d = d.select(
        "doc_id",
        size("w").alias("n_words"),
        F.length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
        _only(F.col("t"), SYMBOLS).alias("n_symbols"),
        _only(F.col("t"), "!?").alias("n_marks"),
        _only(F.col("t"), r"\p{L}").alias("n_letters"),
        _only(F.col("t"), r"\p{Lu}").alias("n_capitals"),
        size("lines").alias("n_lines"),
        (size("lines") - size(F.array_distinct("lines"))).alias("n_dup_lines"),
        size(F.filter("w", _stop)).alias("n_stop_words"),
        F.sort_array(windows).alias("s"),
    )
    # Equal windows are neighbours in s (64-bit hashes stand for them); "same" tells whether the next one is equal.
    d = d.select("*", F.zip_with("s", after(F.col("s"), 1), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))).alias("same"))
    d = d.select(
        *[c for c in d.columns if c not in ("s", "same")],
        F.sort_array(
            F.transform(
                F.filter(
                    F.arrays_zip(F.col("s.i").alias("i"), F.col("same").alias("x"), F.concat(F.array(F.lit(False)), "same").alias("y")),
                    lambda z: z["x"] | (z["y"] & z["i"].isNotNull()),
                ),
                lambda z: z["i"],
            )
        ).alias("p"),
    )
    covered = F.zip_with("p", after(F.col("p"), 1), lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3)).cast("bigint"))
    return d.select(*[c for c in d.columns if c != "p"], _sum(covered).alias("n_repeat_words"))


def passes(rule: Rule) -> Column:
    ratio = F.col(rule.top) / F.nullif(F.col(rule.bottom), F.lit(0))
    return F.coalesce(ratio.between(rule.low, rule.high), F.lit(True))


def verdicts(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures, ``base_failed``, ``kept`` and ``broken``, the names of the rules that a document breaks."""
    m = measures(docs).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    )
    broken = F.filter(F.array(*[F.when(~passes(r), F.lit(r.name)) for r in rules]), lambda x: x.isNotNull())
    m = m.withColumn("broken", broken)
    return m.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows, with all their columns, whose text passes."""
    rows = docs.select(F.struct(*docs.columns).alias("doc_id"), "text")  # the whole row travels in the place of the id
    # A filter would be pushed below the projections and compute every measure once more for each use; an explode stays above them.
    kept = verdicts(rows, rules).select(F.explode(F.when(F.col("kept"), F.array("doc_id"))).alias("row"))
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def op3(docs: DataFrame) -> DataFrame:
    return verdicts(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.array_join("broken", ",").alias("broken"),
    )
