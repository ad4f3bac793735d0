"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled rows of quality 1; unlabelled text is any text.  A text becomes a short vector of shape features, and a logistic
model minimises the non-negative unbiased risk

    prior * R+(positives)  +  max(0, R-(unlabelled) - prior * R-(positives))

where R+ and R- are mean losses of calling a text good or bad; while the second part is negative, steps go the other way for it, so it
cannot be driven below zero.  The class prior is estimated from the same two samples: a first model tells positives from unlabelled text, and
at each threshold the share of unlabelled text above it cannot fall below prior times the share of positives above it.

The fit reads at most ``POSITIVES`` and ``UNLABELLED`` rows in expectation, picked by a hash; every text is scored whole.  Labels other
than 1 are never read.

Defined cases: null and empty texts are scored like any other, by features of no words; without positives every score is
0.5; rows repeated in labels count once; rows without id are scored and teach nothing; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from stratamart.llm.common import fold, stored, texts

POSITIVES, UNLABELLED = 8_000, 16_000
FOLDS, HELD_OUT = 5, 0
#: Labelled ids up to which they may be broadcast.
BROADCAST_IDS = 500_000
CUT = 0.3
STEPS, RATE, DECAY = 600, 0.05, 1e-4
_SYMBOLS = "#*$%&|<>"
FEATURES = (
    "symbols", "marks", "capital words", "distinct words", "commonest word", "word after itself", "repeated triples", "repeated lines",
    "bare symbols", "digits", "stops", "word length", "words", "words per line", "few words",
)


def features(text: str) -> list[float]:
    words = text.split()
    n, m = len(words), max(len(words), 1)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    seen = Counter(words)
    triples = Counter(zip(words, words[1:], words[2:]))
    return [
        min(2.0, sum(map(text.count, _SYMBOLS)) / m),
        min(2.0, (text.count("!") + text.count("?")) / m),
        sum(map(str.isupper, words)) / m,
        len(seen) / m,
        max(seen.values(), default=0) / m,
        sum(map(str.__eq__, words, words[1:])) / m,
        1 - len(triples) / max(n - 2, 1) if n > 2 else 0.0,
        1 - len(set(lines)) / max(len(lines), 1),
        sum(c for w, c in seen.items() if not w[0].isalnum() and not w[-1].isalnum()) / m,
        min(1.0, sum(map(text.count, "0123456789")) / m),
        min(2.0, (text.count(".") + text.count(",")) / m),
        min(3.0, len(text) / m / 10),
        np.log1p(n) / 10,
        min(3.0, np.log1p(n / max(len(lines), 1)) / 3),
        1.0 if n < 10 else 0.0,
    ]


def _table(rows: DataFrame) -> DataFrame:
    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"x": [features(t or "") for t in b["text"]]})

    return texts(rows).mapInPandas(make, "x array<double>")


@dataclass(frozen=True)
class Model:
    prior: float
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_wide((x - self.centre) / self.scale) @ self.weights, -30, 30)))


def _wide(z: np.ndarray) -> np.ndarray:
    """Features, their squares and a constant; far outliers weigh no more than near ones."""
    z = np.clip(z, -5, 5)
    return np.hstack([z, z * z / 5, np.ones((len(z), 1))])


def _descend(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None) -> np.ndarray:
    """Weights that minimise the non-negative risk, or plain positives against unlabelled where no prior is given."""
    w, first, second = (np.zeros(positive.shape[1]) for _ in range(3))
    loss = lambda f: np.logaddexp(0, -f)  # noqa: E731  of calling f good
    slope = lambda f: -1 / (1 + np.exp(np.clip(f, -30, 30)))
    for step in range(1, STEPS + 1):
        p, u = positive @ w, unlabelled @ w
        good = positive.T @ slope(p) / len(p)
        bad_p, bad_u = positive.T @ -slope(-p) / len(p), unlabelled.T @ -slope(-u) / len(u)
        if prior is None:
            grad = good + bad_u
        else:
            rest = loss(-u).mean() - prior * loss(-p).mean()
            grad = prior * good + (bad_u - prior * bad_p) if rest >= 0 else -(bad_u - prior * bad_p)
        grad = grad + DECAY * w
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        w = w - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The smallest ratio of unlabelled to positive shares above a threshold, where enough positives are above it."""
    cuts = np.quantile(positive, np.linspace(0.0, 0.8, 81))
    p = np.array([(positive >= c).mean() for c in cuts])
    u = np.array([(unlabelled >= c).mean() for c in cuts])
    spread = np.sqrt(u * (1 - u) / len(unlabelled) + 1e-12) + np.sqrt(p * (1 - p) / len(positive) + 1e-12)
    return float(np.clip(((u + spread) / p).min(), 0.02, 0.98))


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model | None:
    """Fit on rows outside the held-out fold; None without positives."""
    # A row's chance follows its id and text; rows alike in both are one example, so neither an id nor a text that is repeated without end fills the sample.
    part = F.pmod(F.xxhash64(F.lit(11), "doc_id", "text"), F.lit(1 << 40)) / F.lit(1 << 40)
    with_id = lambda df: df.filter(F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    good = stored(with_id(labels).filter(F.col("quality") == 1).select("doc_id").distinct())
    open_rows = with_id(docs)
    small = good.count() <= BROADCAST_IDS
    trusted = open_rows.join(F.broadcast(good) if small else good, "doc_id", "left_semi")

    def some(df: DataFrame, most: int) -> DataFrame:
        of = df.count()
        return df.filter(part < F.lit(most / max(of, 1))).dropDuplicates(["doc_id", "text"])

    p = _table(some(trusted, positives)).toPandas()
    u = _table(some(open_rows, unlabelled)).toPandas()
    if not len(p) or not len(u):
        return None
    p, u = np.array(p["x"].tolist()), np.array(u["x"].tolist())
    centre, scale = u.mean(axis=0), u.std(axis=0) + 1e-3
    zp, zu = _wide((p - centre) / scale), _wide((u - centre) / scale)
    apart = _descend(zp, zu, None)
    prior = estimate_prior(zp @ apart, zu @ apart)
    return Model(prior, centre, scale, _descend(zp, zu, prior))


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in batches:
            x = np.array([features(t or "") for t in b["text"]]).reshape(len(b), len(FEATURES))
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": m.scores(x) if m else np.full(len(b), 0.5)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts(docs).mapInPandas(score, f"doc_id {kind}, score double")


def op9(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = scored(docs, train(docs, labels))
    return rows.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
