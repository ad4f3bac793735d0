"""Benchmark decontamination by template canonicalisation.

Words become template tokens: numbers, units and names turn into typed placeholders (slots), other words lose case and outer
punctuation.  Slots that stand side by side in a sentence are one: a number with its unit or number words ("$ 40", "40 dollars", "twenty five"), a name of several
words.  Windows of ``WINDOW`` template tokens of documents and benchmark items meet in a hash join.  Matches of one document
and item on neighbouring alignments (``NEAR`` tokens apart at most) add up, so a word more or less does not part them; an item counts as leaked where at least ``MIN_SHARE`` of its
windows match, or as many as cover ``MIN_TOKENS`` of its tokens.  Slots under matched windows are then compared: each value in the item must stand for one value in the
document and the other way round, so a re-parameterised question is caught and a chance meeting of placeholders is not.

A name is a capitalised word that does not begin a sentence.  A window with fewer plain words than slots is kept by its literal values instead of placeholders: it tells
only verbatim copies, but those it does.  Items of fewer than ``WINDOW`` tokens are one window of their own length, below ``MIN_ITEM`` tokens by their literal values.

Documents first pass a bitmap of the benchmark's window hashes, of fixed size whatever the benchmark's, so only windows that may match are shuffled.

Defined cases: null and empty texts, and items without a word, have no windows; an empty benchmark leaks nothing; rows repeated in id and text, or items repeated in text, are
counted once per document and item; an item that repeats a window, or a document that holds an item twice, is aligned at its best
place (the most windows, then the later place); texts of any length are read whole; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from stratamart.llm.common import found_by_workers, kept, stored, texts

WINDOW, MIN_ITEM = 6, 5
MIN_SHARE, MIN_TOKENS, MIN_CONSISTENT = 0.5, 13, 0.75
#: Alignments of a document and an item that are taken together: their shifts differ by this at most.
NEAR = 8
#: Bits of the map of benchmark windows: 2^22 are 512 KB.
MAP_BITS = 22
#: Contaminated documents up to which their keys may be broadcast.
BROADCAST_KEYS = 500_000

#: Measures that follow a number, and number words.
UNITS = (
    "% percent km m cm mm mi miles mile ft feet foot in inch inches kg g mg lb lbs pounds pound oz tons ton l ml liters litres gallons "
    "s sec seconds second min minutes minute h hr hours hour days day weeks week months month years year mph kmh km/h m/s "
    "$ € £ usd eur dollars dollar euros euro cents cent °c °f degrees w kw kwh v hz"
).split()
NUMBER_WORDS = "one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million".split()

_NUMBER = re.compile(r"([$€£]?)([+-]?\d(?:[\d.,:/]*\d)?)([^\W\d_]*|%|[$€£]|°[cf]|km/h|m/s)$")
_OUTER = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "%$+-") + "«»“”„’‘…¿¡"
_PLAIN, _NUM, _UNIT, _NAME = 0, 1, 2, 3
_PLACEHOLDER = {_NUM: "<number>", _UNIT: "<unit>", _NAME: "<name>"}
_units, _numbers = frozenset(UNITS), frozenset(NUMBER_WORDS)


def tokens(word: str) -> list[tuple[int, str]]:
    """Template tokens (type, value) of one word inside a sentence; none for bare punctuation."""
    bare = word.strip(_OUTER)
    low = bare.lower()
    if not low:
        return []
    if not low.isalpha() and (m := _NUMBER.match(low)):
        before, number, after = m.groups()
        return [(_UNIT, u) for u in (before,) if u] + [(_NUM, number)] + [(_UNIT, u) for u in (after,) if u]
    if low in _numbers or "-" in low and all(part in _numbers for part in low.split("-")):
        return [(_NUM, low.replace("-", " "))]
    if low in _units and (len(low) > 2 or not low.isalpha() or low in ("km", "kg", "cm", "mm", "mg", "ml", "lb", "oz")):
        return [(_UNIT, low)]
    if bare[0].isupper() and bare[1:].islower() and len(bare) > 1:
        return [(_NAME, low)]
    return [(_PLAIN, low)]


class _Places(dict):
    """The place of each word in the lexicon's arrays; a new word gets the next one."""

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> int:
        i = self[word] = len(self)
        self.lexicon.fill(i, word)
        return i


class Lexicon:
    """Template tokens of words, as arrays.  Words seen are kept up to a bound, then forgotten."""

    LIMIT = 1 << 18

    def __init__(self) -> None:
        self.reset()

    def reset(self) -> None:
        self.places = _Places(self)
        n = self.LIMIT
        self.count = np.zeros(n, dtype=np.int8)
        self.ends = np.zeros(n, dtype=bool)
        self.kind, self.hash, self.value = (np.zeros((3, n), dtype=t) for t in (np.int8, np.uint64, np.uint64))

    def fill(self, i: int, word: str) -> None:
        made = tokens(word) if word != "\0" else []
        self.count[i], self.ends[i] = len(made), word == "\0" or word[-1] in ".!?:;"
        for k, (kind, value) in enumerate(made):
            self.kind[k, i] = kind
            self.value[k, i] = xxhash.xxh64_intdigest(value)
            self.hash[k, i] = xxhash.xxh64_intdigest(_PLACEHOLDER[kind]) if kind else self.value[k, i]

    def read(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(type, template hash, value hash) of each token of a text."""
        words = text.replace("\n", " \0 ").split()
        if len(self.places) + len(words) > self.LIMIT:
            self.LIMIT = max(self.LIMIT, len(words))
            self.reset()
        ids = np.fromiter(map(self.places.__getitem__, words), dtype=np.int64, count=len(words))
        starts = np.r_[True, self.ends[ids[:-1]]] if len(ids) else np.zeros(0, dtype=bool)
        count = self.count[ids]
        one = count == 1
        if (count > 1).any():
            begin = np.repeat(np.cumsum(count) - count, count)
            ids, starts = np.repeat(ids, count), np.repeat(starts, count)
            nth = np.arange(len(ids)) - begin
            starts &= nth == 0
            kind, hashes, values = (t[nth, ids] for t in (self.kind, self.hash, self.value))
        else:
            ids, starts = ids[one], starts[one]
            kind, hashes, values = (t[0][ids] for t in (self.kind, self.hash, self.value))
        first = (kind == _NAME) & starts  # the capital of a sentence's first word says nothing
        return collapsed(np.where(first, _PLAIN, kind), np.where(first, values, hashes), values, starts)


_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SLOT_HASH = {kind: np.uint64(xxhash.xxh64_intdigest(name)) for kind, name in _PLACEHOLDER.items()}


def collapsed(kind: np.ndarray, hashes: np.ndarray, values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of one sort that follow each other in a sentence as one; numbers and units are one sort.  The value of such a slot is that of the sequence."""
    sort = np.where(kind == _UNIT, _NUM, kind)
    joins = (sort[1:] == sort[:-1]) & (sort[1:] != _PLAIN) & ~starts[1:]
    if not joins.any():
        return kind, hashes, values
    begin = np.flatnonzero(np.r_[True, ~joins])
    nth = np.arange(len(kind)) - np.repeat(begin, np.diff(np.r_[begin, len(kind)]))
    power = np.cumprod(np.r_[np.uint64(1), np.full(int(nth.max()), _FACTOR, dtype=np.uint64)])
    value = np.add.reduceat(values * power[nth], begin)
    several = np.diff(np.r_[begin, len(kind)]) > 1
    has_number = np.logical_or.reduceat(kind == _NUM, begin)
    made = np.where(several & has_number, _NUM, kind[begin])
    hashed = hashes[begin]
    for k, h in _SLOT_HASH.items():
        hashed = np.where(several & (made == k), h, hashed)
    return made, hashed, value


def windows(kind: np.ndarray, hashes: np.ndarray, values: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each window of this length, of its template or, where plain words are too few to tell it, of its literal values; and which are literal."""
    n = len(kind) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
    h = np.full(n, length, dtype=np.uint64)
    plain = np.zeros(n, dtype=np.int16)
    for j in range(length):
        h = (h ^ hashes[j : j + n]) * _FACTOR
        h ^= h >> np.uint64(29)
        plain += kind[j : j + n] == _PLAIN
    by_value = 2 * plain < length if length >= MIN_ITEM else np.ones(n, dtype=bool)
    if by_value.any():
        literal = np.flatnonzero(by_value)
        g = np.full(len(literal), ~np.uint64(length), dtype=np.uint64)
        for j in range(length):
            g = (g ^ values[literal + j]) * _FACTOR
            g ^= g >> np.uint64(29)
        h[literal] = g
    return h, by_value


def _rows(key: dict, lexicon: Lexicon, text: str | None, lengths: list[int], wanted: np.ndarray | None) -> dict[str, list]:
    kind, hashes, values = lexicon.read(text or "")
    out: dict[str, list] = {"at": [], "size": [], "hash": [], "slots": []}
    for length in lengths if wanted is not None else [min(WINDOW, len(kind))] * (len(kind) > 0):
        h, by_value = windows(kind, hashes, values, length)
        if wanted is not None and len(h):
            bit = h >> np.uint64(64 - MAP_BITS)
            at = np.flatnonzero(wanted[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1)
        else:
            at = np.arange(len(h))
        signed = h[at].view(np.int64)
        for a, x in zip(at.tolist(), signed.tolist()):
            slots = values[a : a + length][(kind[a : a + length] != _PLAIN) & ~by_value[a]].view(np.int64)  # literal values are equal as they are
            out["at"].append(a)
            out["size"].append(length)
            out["hash"].append(x)
            out["slots"].append(slots.tolist())
    return out | {k: [v] * len(out["at"]) for k, v in key.items()}


def _frame(parts: list[dict[str, list]], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame({c: pd.Series([x for p in parts for x in p[c]], dtype=object) for c in names})


def item_windows(benchmark: DataFrame) -> DataFrame:
    """(item_id, at, size, hash, slots) of the benchmark's windows, ``at`` relative to the item."""
    found_by_workers(benchmark.sparkSession)

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon()
        for b in batches:
            for i, t in zip(b["item_id"], b["text"]):
                yield _frame([_rows({"item_id": i}, lexicon, t, [], None)], ["item_id", "at", "size", "hash", "slots"])

    kind = benchmark.schema["item_id"].dataType.simpleString()
    return benchmark.select("item_id", "text").mapInPandas(make, f"item_id {kind}, at bigint, size bigint, hash bigint, slots array<bigint>")


def bitmap(items: DataFrame) -> np.ndarray:
    """The benchmark's window hashes as a map of 2^MAP_BITS bits, gathered as at most 2^(MAP_BITS - 6) longs."""
    bit = F.shiftrightunsigned("hash", 64 - MAP_BITS)
    words = items.groupBy(F.shiftright(bit, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(hash, {64 - MAP_BITS}) & 63 AS INT))")).alias("bits"))
    out = np.zeros(1 << (MAP_BITS - 6), dtype="<i8")
    for r in words.collect():
        out[r["word"]] = r["bits"]
    return out.view(np.uint8)


def document_windows(docs: DataFrame, wanted: np.ndarray, lengths: list[int]) -> DataFrame:
    """Windows of documents that the map lets through."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = kept("template words", Lexicon)
        for b in batches:
            parts = [_rows({"doc_id": i, "text_hash": h}, lexicon, t, lengths, shared.value) for i, h, t in zip(b["doc_id"], b["text_hash"], b["text"])]
            yield _frame(parts, ["doc_id", "text_hash", "at", "size", "hash", "slots"])

    rows = texts(docs, F.xxhash64("text").alias("text_hash"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(make, f"doc_id {kind}, text_hash bigint, at bigint, size bigint, hash bigint, slots array<bigint>")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per leaked item of a document: doc_id, text_hash, item_id, matched, share, consistency, reworded."""
    items = stored(item_windows(benchmark.filter("text is not null")))
    lengths = [r[0] for r in items.select("size").distinct().collect()]  # at most WINDOW values
    found = document_windows(docs, bitmap(items), lengths)
    key = ["doc_id", "text_hash", "item_id"]
    i = items.select("item_id", F.col("at").alias("item_at"), "hash", F.col("slots").alias("item_slots"))
    # The hash joins; a document's window meets an item's once per place of the window in the item.
    # Each shift is judged alone (even numbers) and in bands twice as wide as NEAR that overlap by half, so shifts within NEAR of each other share one (odd numbers).
    shift = F.col("at") - F.col("item_at")
    band = F.floor(shift / NEAR) * NEAR
    met = stored(found.join(i, "hash").withColumn("shift", F.explode(F.array(2 * shift, 2 * band + 1, 2 * (band - NEAR) + 1))).drop("hash", "at"))
    runs = met.groupBy(*key, "shift").agg(F.countDistinct("item_at").alias("matched"), F.max("item_at").alias("hi"), F.min("item_at").alias("lo"), F.max("size").alias("size"))
    totals = items.groupBy("item_id").agg(F.countDistinct("at").alias("windows"))
    runs = runs.join(totals, "item_id").withColumn("share", F.col("matched") / F.col("windows"))
    enough = (F.col("share") >= MIN_SHARE) | (F.col("matched") + F.col("size") - 1 >= MIN_TOKENS)
    runs = stored(runs.filter(enough).select(*key, "shift", "matched", "share"))
    # Slots under each such alignment: distinct pairs against distinct values on either side.
    place = [*key, "shift"]
    same = [F.col(f"m.{c}").eqNullSafe(F.col(f"r.{c}")) for c in place]
    pairs = met.alias("m").join(runs.alias("r"), same, "left_semi").select(*place, F.explode(F.arrays_zip("item_slots", "slots")).alias("p")).distinct()
    slots = pairs.groupBy(*place).agg(
        F.count(F.lit(1)).alias("pairs"), F.countDistinct("p.item_slots").alias("item_values"), F.countDistinct("p.slots").alias("doc_values"),
        F.max(F.col("p.item_slots") != F.col("p.slots")).alias("reworded"),
    )
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"s.{c}")) for c in place]
    out = runs.alias("r").join(slots.alias("s"), same, "left").select(
        *[f"r.{c}" for c in place], "matched", "share",
        F.coalesce(F.least("item_values", "doc_values") / F.col("pairs"), F.lit(1.0)).alias("consistency"),
        F.coalesce("reworded", F.lit(False)).alias("reworded"),
    )
    # The best of the alignments that pass.
    columns = ["matched", "share", "consistency", "reworded"]
    best = F.max_by(F.struct(*columns), F.struct("matched", "shift")).alias("b")
    return out.filter(F.col("consistency") >= MIN_CONSISTENT).groupBy(*key).agg(best).select(*key, "b.*")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows without a leak, with all their columns."""
    leaked = stored(leaks(docs, benchmark).select("doc_id", "text_hash").distinct())
    leaked = F.broadcast(leaked) if leaked.count() <= BROADCAST_KEYS else leaked
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", F.xxhash64("text").alias("text_hash")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("d.text_hash") == F.col("l.text_hash"))
    return rows.join(leaked.alias("l"), same, "left_anti").select(*[F.col("row")[c].alias(c) for c in docs.columns])


def op2(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return leaks(docs, benchmark).select("doc_id", "item_id", "matched", "share", "consistency", "reworded")
