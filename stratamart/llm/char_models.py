"""Language identification by interpolated Kneser-Ney character models, one per language.

A model scores a word as characters between word bounds.  Orders from ``ORDER`` down are interpolated: an n-gram keeps its count less a discount,
and the discount's share goes to the next shorter context; below the highest order, counts are continuation counts (how many
different characters come before).  All n-grams of all languages sit in one sorted array of 64-bit hashes with a row of log-weights each, looked up by
binary search.  The language with the lowest cross-entropy per character wins.

The score is the winner's share after a softmax of the cross-entropies; a prediction is accepted where the winner's
cross-entropy stays under a quantile of that of texts of its language from which nothing was learned, so text in no learned language is rejected.

Training reads at most ``DOCS_PER_LANGUAGE`` texts of a language in expectation, picked by a hash, one in ``CALIBRATION`` of them for the limits alone; so many fewer
of each language that the table keeps within ``CELLS``.  Every text is scored whole.

Defined cases: a text that is null or has no letter is ``und`` with score 0, as is every text if nothing was learned (no rows, or none with lang); of languages
with equal cross-entropy the first by name wins; rows without lang teach nothing; a language without a text for its limit accepts all; repeated rows are scored alike; texts of any
length are read whole; extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from stratamart.llm.common import fold, stored, texts

ORDER = 4
DISCOUNT = 0.75
#: Probability of a character never seen, before discounts.
UNIFORM = 1.0 / 4096
#: Marks around a word that say nothing about its language.
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
DOCS_PER_LANGUAGE = 3_000
#: One training text in so many is kept apart to set the limits of acceptance.
CALIBRATION = 5
#: Cells of the table of n-grams by languages that is sent to all tasks; with more languages fewer texts of each are read.
CELLS = 1 << 26
SHARPNESS = 6.0
ACCEPT_QUANTILE = 0.999
UNKNOWN = "und"
#: Languages up to which their sizes may be broadcast; beyond, texts are shuffled by language.
BROADCAST_LANGUAGES = 100_000
_LETTER = re.compile(r"[^\W\d_]")
#: The edge of a word.  Not NUL, at which the hash tables of pandas end a string.
_EDGE = "\x02"
FOLDS, HELD_OUT = 3, 1


def _mix(codes: np.ndarray, length: int) -> np.ndarray:
    """64-bit hashes of the n-grams of this length that end at each place from ``length - 1`` on."""
    n = len(codes) - length + 1
    h = np.full(max(n, 0), length, dtype=np.uint64)
    for j in range(length):
        h = (h ^ codes[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    return h


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64)


def _padded(word: str) -> str:
    return _EDGE * (ORDER - 1) + word + _EDGE


@dataclass
class Models:
    """``hashes``: the n-grams, sorted.  Per n-gram and language, ``prob`` is its probability behind its context and ``back`` the share
    that it leaves, as a context, to shorter ones.  ``limits`` are the entropies up to which a language is accepted."""

    languages: list[str]
    hashes: np.ndarray
    prob: np.ndarray
    back: np.ndarray
    empty: np.ndarray
    limits: np.ndarray

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of n-grams, and which of them are there."""
        i = np.minimum(np.searchsorted(self.hashes, grams), len(self.hashes) - 1)
        return i, self.hashes[i] == grams

    def logs(self, words: list[str]) -> np.ndarray:
        """Log-probability of each word, with its end, per language."""
        codes = _codes("".join(map(_padded, words)))
        sizes = np.array([len(w) + 1 for w in words])
        first = np.cumsum(sizes + ORDER - 1) - sizes  # the first character that is predicted
        at = np.arange(sizes.sum()) + np.repeat(first - np.cumsum(sizes) + sizes, sizes)
        p = np.ones((len(at), len(self.languages)))
        todo = np.arange(len(at))
        for length in range(ORDER, 0, -1):
            i, there = self.find(_mix(codes, length)[at[todo] - length + 1])
            p[todo[there]] *= self.prob[i[there]]
            todo = todo[~there]
            if not len(todo):
                break
            if length > 1:
                i, there = self.find(_mix(codes, length - 1)[at[todo] - length + 1])
                p[todo[there]] *= self.back[i[there]]
            else:
                p[todo] *= self.empty * UNIFORM
        return np.add.reduceat(np.log(p), np.cumsum(sizes) - sizes, axis=0)


def _pairs(docs: DataFrame) -> DataFrame:
    """(lang, word, n) over the training texts."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seen: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(b["lang"], b["text"]):
                seen[lang].update(w for raw in text.lower().split() if (w := raw.strip(_MARKS)) and _LETTER.search(w))
            yield pd.DataFrame([(k, w, n) for k, c in seen.items() for w, n in c.items()], columns=["lang", "word", "n"])

    return texts(docs, F.col("lang")).mapInPandas(count, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def sample(docs: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT, per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """Texts to learn from: not held out, with a language, at most about ``per_language`` of each."""
    rows = docs.select("doc_id", "lang", "text").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), folds) != held_out))
    sizes = stored(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("of")))
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_LANGUAGES else sizes
    chance = F.pmod(F.xxhash64(F.lit(7), "doc_id", "text"), F.lit(1 << 20)) / F.lit(1 << 20)
    return rows.join(sizes, "lang").filter(chance < F.lit(float(per_language)) / F.col("of")).select("doc_id", "lang", "text")


def grams(pairs: DataFrame) -> DataFrame:
    """(lang, gram, n, before): counts of the n-grams of all orders, and how many different characters come before each."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out: Counter = Counter()
            for lang, word, n in zip(b["lang"], b["word"], b["n"]):
                s = _padded(word)
                for end in range(ORDER, len(s) + 1):
                    for length in range(1, ORDER + 1):
                        out[lang, s[end - length : end], s[end - length - 1] if length < ORDER else ""] += n
            yield pd.DataFrame([(*k, n) for k, n in out.items()], columns=["lang", "gram", "before", "n"])

    rows = pairs.mapInPandas(cut, "lang string, gram string, before string, n bigint")
    rows = rows.groupBy("lang", "gram", "before").agg(F.sum("n").alias("n"))
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("before"))


def train(docs: DataFrame, **how) -> Models | None:
    """Learn one model per language; None without any text to learn from.

    The sample's bound, and ``CELLS``, also bound what is gathered: its distinct n-grams.
    """
    picked = stored(sample(docs, **how))
    apart = F.pmod(F.xxhash64(F.lit(13), "doc_id", "text"), F.lit(CALIBRATION)) == 0
    learnt = picked.filter(~apart)
    share = 1.0
    while True:
        counted = stored(grams(_pairs(learnt.filter(F.pmod(F.xxhash64(F.lit(17), "doc_id", "text"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)))))))
        size = counted.agg(F.countDistinct("gram").alias("grams"), F.countDistinct("lang").alias("languages")).first()
        if size["grams"] * size["languages"] <= CELLS or share < 1e-5:
            break
        share /= 2
    found = counted.toPandas()
    if not len(found):
        return None
    languages = sorted(found["lang"].unique())
    column = {k: i for i, k in enumerate(languages)}
    found["order"] = found["gram"].str.len()
    # The highest order keeps counts; shorter ones count the characters before them.
    found["mass"] = np.where(found["order"] == ORDER, found["n"], found["before"]).astype(float)
    found["context"] = found["gram"].str[:-1]
    by = found.groupby(["lang", "context"])["mass"].agg(["sum", "size"]).reset_index()
    by["back"] = DISCOUNT * by["size"] / by["sum"]
    found = found.merge(by[["lang", "context", "sum"]], on=["lang", "context"])
    found["top"] = np.maximum(found["mass"] - DISCOUNT, 0) / found["sum"]
    names = sorted(set(found["gram"]) | set(filter(None, found["context"])), key=lambda g: (len(g), g))  # the edge before a word is a context only
    place = {g: i for i, g in enumerate(names)}
    top, back, empty = np.zeros((len(names), len(languages))), np.ones((len(names), len(languages))), np.ones(len(languages))
    top[found["gram"].map(place), found["lang"].map(column)] = found["top"]
    for lang, context, share in zip(by["lang"], by["context"], by["back"]):
        if context in place:
            back[place[context], column[lang]] = share
        elif not context:
            empty[column[lang]] = share
    prob = np.zeros_like(top)
    for g, i in place.items():  # shorter n-grams come first
        prob[i] = top[i] + ((back[place[g[:-1]]] if g[:-1] in place else 1.0) * prob[place[g[1:]]] if len(g) > 1 and g[1:] in place else empty * UNIFORM)
    hashes = np.array([_mix(_codes(g), len(g))[0] for g in names], dtype=np.uint64)
    rank = np.argsort(hashes)
    models = Models(languages, hashes[rank], prob[rank], back[rank], empty, np.full(len(languages), np.inf))
    own = predictions(picked.filter(apart), models, keep=["lang"]).filter("lang = lang_pred").groupBy("lang").agg(F.percentile_approx("entropy", ACCEPT_QUANTILE).alias("q")).collect()
    for r in own:
        models.limits[column[r["lang"]]] = r["q"]
    return models


class Scorer:
    """Scores texts by the log-probabilities of their words, which are kept up to a bound."""

    LIMIT = 1 << 18

    def __init__(self, models: Models):
        self.models = models
        self.place: dict[str, int] = {}
        self.rows = np.zeros((self.LIMIT, len(models.languages)))
        self.sizes = np.zeros(self.LIMIT, dtype=np.int64)

    def entropies(self, many: list[str]) -> list[np.ndarray | None]:
        """Nats per character and language of each text; None for a text without letters."""
        split = [t.lower().split() for t in many]
        new = set().union(*split).difference(self.place)
        if len(self.place) + len(new) > self.LIMIT:
            self.place.clear()
            new = set().union(*split)
            if len(new) > self.LIMIT:
                self.rows, self.sizes = np.zeros((len(new), self.rows.shape[1])), np.zeros(len(new), dtype=np.int64)
                self.LIMIT = len(new)
        raw = list(new)
        at = np.arange(len(self.place), len(self.place) + len(raw))
        self.place.update(zip(raw, at.tolist()))
        bare = [w.strip(_MARKS) for w in raw]
        good = np.array([bool(_LETTER.search(w)) for w in bare], dtype=bool)
        self.rows[at], self.sizes[at] = 0, 0
        for k in range(0, len(raw), 20_000):
            part = [w for w, g in zip(bare[k : k + 20_000], good[k : k + 20_000]) if g]
            if part:
                to = at[k : k + 20_000][good[k : k + 20_000]]
                self.rows[to], self.sizes[to] = self.models.logs(part), [len(w) + 1 for w in part]
        out = []
        for words in split:
            i = np.fromiter(map(self.place.__getitem__, words), dtype=np.int64, count=len(words))
            n = self.sizes[i].sum()
            out.append(-self.rows[i].sum(axis=0) / n if n else None)
        return out


def predictions(docs: DataFrame, models: Models | None, keep: list[str] | None = None) -> DataFrame:
    """doc_id, the columns of ``keep``, lang_pred, score, entropy and accepted."""
    keep = keep or []
    rows = texts(docs, *[F.col(c) for c in keep])
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        scorer = Scorer(m) if m else None
        for b in batches:
            many = [t or "" for t in b["text"]]
            out = []
            for t, e in zip(many, scorer.entropies(many) if scorer else [None] * len(many)):
                if e is None:
                    out.append((UNKNOWN, 0.0, None, False))
                    continue
                k = int(e.argmin())
                share = np.exp(SHARPNESS * (e[k] - e))
                out.append((m.languages[k], float(1 / share.sum()), float(e[k]), bool(e[k] <= m.limits[k])))
            made = pd.DataFrame(out, columns=["lang_pred", "score", "entropy", "accepted"])
            yield pd.concat([b.drop(columns="text").reset_index(drop=True), made], axis=1)

    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in rows.schema if f.name != "text")
    return rows.mapInPandas(predict, f"{kinds}lang_pred string, score double, entropy double, accepted boolean")


def op7(docs: DataFrame) -> DataFrame:
    found = predictions(docs, train(docs))
    return found.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score", "accepted")
