"""Secret scan: fixed patterns, and character Markov models of random strings against ordinary identifiers.

Everything runs in built-in functions.  The patterns give the base spans.  The models are two tables of transitions between
characters of an alphabet, counted over every text: values of base spans are random strings, runs of letters, digits and
joiners without any base span are ordinary identifiers.  The texts are searched once; the models and the verdicts read what was found.  The samples of random strings are few for so many transitions, so their rows lean on their common distribution
by ``LEAN`` counts.  A run of ``LEAST`` characters or more that no base span touches is a secret if its mean log-likelihood
ratio per character exceeds the threshold of its length band: short runs scatter wider, so each of ``BANDS`` has its own, above all but one in ``FALSE_ALARMS`` of the samples'
identifiers in the band, and halfway to the random strings cut to the band's length, where these lie higher.

Spans are (kind, start, end) in code points, end exclusive; an ``assign`` span covers the whole match, name and value.

Defined cases: null and empty texts have no spans; without samples of either kind, as without rows, the models find nothing; spans that begin together are listed in the
order of their kinds; repeated rows get equal spans; texts of any length are read whole; extra columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from stratamart.llm.common import scratch_table, stored

#: Kind, pattern, group that must have so many characters.
BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
)
#: What the models judge.
LEAST = 8
RUN = ("markov", r"[A-Za-z0-9+/_=-]{8,}", 0, LEAST)
#: Least lengths of the bands.
BANDS = (8, 12, 16, 20, 32)
#: Counts by which a row of the random strings' table leans on the distribution common to its rows.
LEAN = 50.0
KINDS = [k for k, *_ in BASE] + ["markov"]
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
SIZE = len(ALPHABET)
#: An identifier of a band may pass for a secret once in so many.
FALSE_ALARMS = 10_000


def spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Leftmost non-overlapping matches with a group of enough characters, as array<struct<start, stop, kind, value>>.

    The pieces between the matches and the matches themselves give the places.
    """
    # A hex run of less than the wanted length is no match whichever way; asking for the length at once spares the short ones.
    quick = {"hex": r"[0-9a-f]{24,}", "access": r"AKIA[A-Z0-9]{16,}"}.get(kind, pattern)
    found = F.regexp_extract_all(text, F.lit(quick), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(quick), F.lit(group)) if group else found
    steps = F.arrays_zip(F.split(text, quick).alias("gap"), found.alias("whole"), values.alias("value"))
    none = F.array().cast("array<struct<start:int,stop:int,kind:string,value:string>>")
    placed = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda a, s: F.struct(
            (a["at"] + F.length(s["gap"]) + F.coalesce(F.length(s["whole"]), F.lit(0))).alias("at"),
            F.when(s["whole"].isNull() | (F.length(s["value"]) < least), a["out"]).otherwise(
                F.concat(
                    a["out"],
                    F.array(
                        F.struct(
                            (a["at"] + F.length(s["gap"])).alias("start"),
                            (a["at"] + F.length(s["gap"]) + F.length(s["whole"])).alias("stop"),
                            F.lit(kind).alias("kind"),
                            s["value"].alias("value"),
                        )
                    ),
                )
            ).alias("out"),
        ),
    )["out"]
    return F.when(text.rlike(quick), placed).otherwise(none)


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text and an array of spans per kind."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return d.select("*", *[spans(F.col("text"), *b).alias(b[0]) for b in BASE])


def _untouched(run: Column, *kinds: Column) -> Column:
    touches = lambda s: (s["start"] < run["stop"]) & (run["start"] < s["stop"])
    none = F.lit(True)
    for k in kinds:
        none = none & ~F.exists(k, touches)
    return none


def _runs(based: DataFrame) -> Column:
    """Runs that no base span touches."""
    kinds = [F.col(k) for k, *_ in BASE]
    return F.filter(spans(F.col("text"), *RUN), lambda r: _untouched(r, *kinds))


def _codes(value: Column) -> Column:
    """Places of a value's characters in the alphabet, from 1; characters outside it are left out."""
    return F.filter(F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c)), lambda i: i > 0)


@dataclass(frozen=True)
class Model:
    """``ratio``: log-likelihood ratios of transitions, by (from - 1) * SIZE + to - 1; ``thresholds`` of the bands in nats per transition."""

    ratio: tuple[float, ...]
    thresholds: tuple[float, ...]


def score(value: Column, ratio: Column) -> Column:
    """Mean log-likelihood ratio per transition."""
    codes = _codes(value)
    steps = F.zip_with(codes, F.slice(codes, 2, F.greatest(F.size(codes) - 1, F.lit(0))), lambda a, b: F.get(ratio, (a - 1) * SIZE + b - 1))
    return F.aggregate(steps, F.lit(0.0), lambda s, x: s + F.coalesce(x, F.lit(0.0))) / F.greatest(F.size(codes) - 1, F.lit(1))


def found(docs: DataFrame) -> DataFrame:
    """``base_spans`` and the values of the runs that no base span touches."""
    based = base_spans(docs)
    # Most texts have no base span: their runs need no places yet.
    bare = F.size(F.concat(*[F.col(k) for k, *_ in BASE])) == 0
    return based.select("*", F.when(bare, F.regexp_extract_all("text", F.lit(RUN[1]), F.lit(0))).otherwise(F.transform(_runs(based), lambda s: s["value"])).alias("plain"))


def labelled(rows: DataFrame) -> DataFrame:
    """(random, value) of rows of ``found``."""
    secret = F.concat(*[F.transform(F.col(k), lambda s: s["value"]) for k, *_ in BASE])
    both = F.array(F.struct(F.lit(True).alias("random"), secret.alias("v")), F.struct(F.lit(False).alias("random"), F.col("plain").alias("v")))
    # Exploded as expressions: of a named column Spark would infer a filter, push it down and run the patterns once more.
    return rows.select(F.explode(both).alias("x")).select("x.random", F.explode(F.col("x.v")).alias("value"))


def samples(docs: DataFrame, sample_docs: int) -> DataFrame:
    """(random, value) from about ``sample_docs`` documents, chosen by a hash of their text, to look at; the models learn from all."""
    share = min(1.0, sample_docs / max(docs.count(), 1))
    return labelled(found(docs.filter(F.pmod(F.xxhash64(F.lit(5), "text"), F.lit(1 << 50)) / F.lit(float(1 << 50)) < F.lit(share))))


def train(docs: DataFrame) -> Model | None:
    """Both models from every row; None without values of both kinds."""
    return fitted(labelled(found(docs)))


def fitted(values: DataFrame) -> Model | None:
    """Both models from all of (random, value).

    Gathered are at most 2 * SIZE^2 counts, and two quantiles for each band.
    """
    rows = stored(values.groupBy("random", "value").agg(F.count(F.lit(1)).alias("n")))
    # Values count once: copies of a document must not teach one secret many times.
    coded = rows.select("random", _codes(F.col("value")).alias("c"))
    steps = coded.select("random", F.explode(F.zip_with("c", F.slice("c", 2, F.greatest(F.size("c") - 1, F.lit(0))), lambda a, b: F.when(b.isNotNull(), (a - 1) * SIZE + b - 1))).alias("step"))
    counts = {(r["random"], r["step"]): r["n"] for r in steps.filter("step is not null").groupBy("random", "step").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not any(k for k, _ in counts) or all(k for k, _ in counts):
        return None

    def logs(random: bool, lean: float, common: list[float]) -> list[float]:
        """Log-probabilities of the transitions; each row leans on ``common`` by so many counts."""
        out = []
        for a in range(SIZE):
            row = [counts.get((random, a * SIZE + b), 0) + lean * common[b] for b in range(SIZE)]
            out += [math.log(x / sum(row)) for x in row]
        return out

    even = [1 / SIZE] * SIZE
    pooled = [sum(counts.get((True, a * SIZE + b), 0) for a in range(SIZE)) + 0.5 for b in range(SIZE)]
    # Few samples must not forbid a character: half of the common distribution is even.
    common = [0.5 * x / sum(pooled) + 0.5 / SIZE for x in pooled]
    ratio = tuple(round(a - b, 4) for a, b in zip(logs(True, LEAN, common), logs(False, 0.5 * SIZE, even)))
    return Model(ratio, tuple(thresholds(rows, ratio)))


def _band(length: Column) -> Column:
    """The number of a length's band, from 1."""
    return F.size(F.filter(F.array(*[F.lit(b) for b in BANDS]), lambda b: b <= length))


def thresholds(rows: DataFrame, ratio: tuple[float, ...]) -> list[float]:
    """The threshold of each band; one without identifiers has that of the band below it, for longer runs scatter less."""
    plain = rows.filter(~F.col("random")).select(_band(F.length("value")).alias("band"), score(F.col("value"), _literal(ratio)).alias("s"))
    high = {r["band"]: r["s"] for r in plain.groupBy("band").agg(F.percentile_approx("s", 1 - 1 / FALSE_ALARMS, 100_000).alias("s")).collect()}
    cut = F.explode(F.filter(F.array(*[F.lit(b) for b in BANDS]), lambda b: b <= F.length("value")))
    secret = rows.filter("random").select("value", cut.alias("length")).select(_band(F.col("length")).alias("band"), score(F.expr("left(value, length)"), _literal(ratio)).alias("s"))
    low = {r["band"]: r["s"] for r in secret.groupBy("band").agg(F.percentile_approx("s", 0.02, 100_000).alias("s")).collect()}
    out, before = [], math.inf
    for band in range(1, len(BANDS) + 1):
        top = high.get(band, before)
        out.append(max(top, (top + low.get(band, top)) / 2))
        before = top
    return out


def _literal(ratio: tuple[float, ...]) -> Column:
    """The table as one constant, not thousands of expressions."""
    return F.split(F.lit(",".join(map(str, ratio))), ",").cast("array<double>")


def scan(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and an array of spans (start, stop, kind) per kind, ``markov`` last."""
    return judged(found(docs), model)


def judged(rows: DataFrame, model: Model | None) -> DataFrame:
    """``scan`` for rows of ``found``; only texts with a secret run are searched for its place."""
    shape = lambda a: F.transform(a, lambda s: F.struct(s["start"], s["stop"], s["kind"]))
    none = F.filter(F.col("hex"), lambda s: F.lit(False))
    if model is None:
        rows = rows.select("*", none.alias("markov"))
    else:
        limit = lambda v: F.element_at(F.array(*[F.lit(t) for t in model.thresholds]), _band(F.length(v)))
        secret = lambda v: score(v, _literal(model.ratio)) > limit(v)
        rows = rows.select("*", F.when(F.exists("plain", secret), F.filter(_runs(rows), lambda r: secret(r["value"]))).otherwise(none).alias("markov"))
    return rows.select("doc_id", *[shape(F.col(k)).alias(k) for k in KINDS])


def _listed(kinds: list[str]) -> Column:
    """kind:start:end by start, then kind in its order, comma-joined."""
    tagged = F.concat(*[F.transform(F.col(k), lambda s, i=i: F.struct(s["start"].alias("a"), F.lit(i).alias("k"), s["stop"].alias("b"), s["kind"].alias("n"))) for i, k in enumerate(kinds)])
    return F.array_join(F.transform(F.sort_array(tagged), lambda s: F.concat_ws(":", s["n"], s["a"], s["b"])), ",")


def op5(docs: DataFrame) -> DataFrame:
    read = scratch_table(found(docs), "found")
    rows = judged(read, fitted(labelled(read)))
    return rows.select(
        "doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(_listed(KINDS[:3]), 256).alias("base_sha256"),
        _listed(KINDS).alias("spans"),
    )
