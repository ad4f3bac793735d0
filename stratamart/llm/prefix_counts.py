"""Exact token counts of every prefix of a text, by dynamic programming over the pieces of a byte-pair vocabulary.

A greedy merge never crosses a boundary between two of its final pieces, and which merges happen left of it does not depend on what
follows.  So the pieces of a prefix are the pieces of a shorter prefix plus one last piece: among the pieces that end the prefix, the last one is
the one that stays apart from the last piece of the shorter prefix when the two are merged alone.  Counting along this chain gives
the exact count of each prefix in one pass, and the table answers every budget question about the text without encoding again.

No piece of the vocabulary continues behind a word into the next blank or across a line feed, so a text falls into chunks (blanks and
the word behind them) with a table of their own.  Totals of chunks seen before are kept, up to a bound.  A character outside the
vocabulary counts as its UTF-8 bytes and joins nothing.

Counts are those of the library for the file: white space other than blanks is a character like any other, a
blank is put before a text that is not empty, special strings are ordinary text.

Defined cases: null and empty texts have no tokens; repeated rows are counted alike; extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from stratamart.llm.common import Memory, kept, texts

VOCABULARY = "piece_bpe_32k.model"
LIMIT = 4096
SPACE = "▁"
_CHUNK = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")


class _Totals(Memory):
    """Tokens of the parts between blanks."""

    LIMIT = 1 << 19

    def __init__(self, counter: PrefixCounter):
        super().__init__()
        self.counter = counter

    def make(self, part: str) -> int:
        return 1 + self.counter.total(part[1:]) if part[:1] == "\n" else self.counter.total(SPACE + part)


class PrefixCounter:
    """Counts by the pieces and scores of a sentencepiece byte-pair file without text normalisation."""

    #: Prefixes and pairs of pieces remembered at once in a task.
    KEPT = 1 << 19
    #: Characters up to which a chunk's prefixes are remembered.
    SHARED = 40

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.scores = {model.id_to_piece(i): model.get_score(i) for i in ids}
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.scores):
            raise ValueError("a piece continues behind a word into the next blank or line: texts cannot be cut into chunks")
        if model.normalize(" ﬁ  a ") != f"{SPACE}{SPACE}ﬁ{SPACE}{SPACE}a{SPACE}":
            raise ValueError("the file asks for a normalisation of texts that this counter does not make")
        # Every ending of a piece, and whether it is a piece itself.
        self.endings = {p[i:]: p[i:] in self.scores for p in self.scores for i in range(len(p))}
        self.apart: dict[tuple[str, str], bool] = {}
        self.states: dict[str, tuple[int, str]] = {"": (0, "")}
        self.totals = _Totals(self)

    def merged(self, text: str) -> list[str]:
        """Greedy merging: the best pair anywhere, the leftmost of equals, until no pair is a piece."""
        get, none = self.scores.get, -np.inf
        parts = list(text)
        scores = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while scores and (best := max(scores)) > none:
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = get(parts[at - 1] + parts[at], none)
            if at < len(scores):
                scores[at] = get(parts[at] + parts[at + 1], none)
        return parts

    def _last_pieces(self, chunk: str, end: int) -> list[int]:
        """Where pieces that end at ``end`` begin, the longest piece first."""
        begin, found, endings = end - 1, [], self.endings
        while begin >= 0 and (piece := endings.get(chunk[begin:end])) is not None:
            if piece:
                found.append(begin)
            begin -= 1
        return found[::-1]

    def _stay_apart(self, a: str, b: str) -> bool:
        if (known := self.apart.get((a, b))) is None:
            if len(self.apart) >= self.KEPT:
                self.apart.clear()
            known = self.apart[a, b] = self.merged(a + b) == [a, b]
        return known

    def table(self, chunk: str) -> list[int]:
        """Tokens of every prefix of a chunk, from the empty one on."""
        counts, last = [0], [""]
        for end in range(1, len(chunk) + 1):
            for begin in self._last_pieces(chunk, end):
                piece = chunk[begin:end]
                if not begin or self._stay_apart(last[begin], piece):
                    counts.append(counts[begin] + 1)
                    break
            else:  # no piece ends here: the character is outside the vocabulary
                piece = chunk[end - 1]
                counts.append(counts[end - 1] + len(piece.encode()))
            last.append(piece)
        return counts

    def total(self, chunk: str) -> int:
        return self._state(chunk)[0] if len(chunk) <= self.SHARED else self.table(chunk)[-1]

    def _state(self, chunk: str) -> tuple[int, str]:
        """The last entry of a short chunk's table.  Words begin alike, so entries are kept by prefix; with a prefix, all shorter ones are there."""
        states = self.states
        if len(states) >= self.KEPT:
            states.clear()
            states[""] = (0, "")
        known = len(chunk)
        while chunk[:known] not in states:
            known -= 1
        for end in range(known + 1, len(chunk) + 1):
            for begin in self._last_pieces(chunk, end):
                piece = chunk[begin:end]
                count, before = states[chunk[:begin]]
                if not begin or self._stay_apart(before, piece):
                    states[chunk[:end]] = (count + 1, piece)
                    break
            else:
                piece = chunk[end - 1]
                states[chunk[:end]] = (states[chunk[: end - 1]][0] + len(piece.encode()), piece)
        return states[chunk]

    def chunks(self, text: str) -> tuple[list[str], np.ndarray]:
        """The chunks of a text, with the blank that the library puts before it, and the tokens of each."""
        parts = _CHUNK.findall(SPACE + text.replace(" ", SPACE))
        return parts, np.fromiter(map(self.total, parts), dtype=np.int64, count=len(parts))

    def count(self, text: str) -> int:
        if not text:
            return 0
        if text[0] == " " or "  " in text or " \n" in text or SPACE in text:
            return int(self.chunks(text)[1].sum())
        self.totals.renew()
        # One blank before each part, but none before one that a line feed begins.
        return sum(map(self.totals.__getitem__, text.replace("\n", " \n").split(" ")))

    def every_prefix(self, text: str) -> np.ndarray:
        """Tokens of text[:0], text[:1], ... text[:n]."""
        if not text:
            return np.zeros(1, dtype=np.int64)
        parts, totals = self.chunks(text)
        before = np.cumsum(totals) - totals
        out = np.concatenate([b + np.array(self.table(c)[1:]) for b, c in zip(before, parts)])
        out[0] = 0  # the blank alone: the empty prefix has no token
        return out

    def fitting(self, text: str, budget: int) -> int:
        """Characters of the longest prefix of at most ``budget`` tokens."""
        if not text:
            return 0
        self.totals.renew()
        left, chars = budget, 0
        for found in _CHUNK.finditer(SPACE + text.replace(" ", SPACE)):
            chunk = found.group()
            n = self.totals[chunk[1:]] if chunk[0] == SPACE else self.total(chunk)
            if n > left:
                chars += max(i for i, k in enumerate(self.table(chunk)) if k <= left)
                break
            left, chars = left - n, chars + len(chunk)
        return max(0, chars - 1)


def _counter(vocabulary: str | None) -> PrefixCounter:
    import public_tokenizers

    path = vocabulary or public_tokenizers.path(VOCABULARY)
    return kept(f"pieces {path}", lambda: PrefixCounter(path))


def counts(docs: DataFrame, limit: int = LIMIT, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, fits): ``fits`` characters of the text are its longest prefix of at most ``limit`` tokens."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _counter(vocabulary)
        for b in batches:
            texts = [t or "" for t in b["text"]]
            n = [counter.count(t) for t in texts]
            fits = [len(t) if k <= limit else counter.fitting(t, limit) for t, k in zip(texts, n)]
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_bytes": b["n_bytes"], "n_tokens": n, "fits": fits})

    rows = texts(docs, F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, fits bigint")


def prefix_table(docs: DataFrame, block: int = 4096, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, first, counts): tokens of the prefixes of first, first + 1, ... characters, in blocks, so that no row grows with its text."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _counter(vocabulary)
        for b in batches:
            for i, t in zip(b["doc_id"].astype(object), b["text"]):
                every = counter.every_prefix(t or "").astype(np.int32)
                firsts = range(0, len(every), block)
                yield pd.DataFrame({"doc_id": [i] * len(firsts), "first": firsts, "counts": pd.Series([every[k : k + block] for k in firsts], dtype=object)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return texts(docs).mapInPandas(rows, f"doc_id {kind}, first bigint, counts array<int>")


def tokens_of_prefix(table: DataFrame, asked: DataFrame) -> DataFrame:
    """Answer ``asked`` (doc_id, chars) from a prefix table: (doc_id, chars, n_tokens)."""
    block = asked.alias("a").join(table.alias("t"), (F.col("a.doc_id") == F.col("t.doc_id")) & (F.col("chars") >= F.col("first")) & (F.col("chars") < F.col("first") + F.size("counts")))
    return block.select("a.doc_id", "chars", F.get("counts", (F.col("chars") - F.col("first")).cast("int")).cast("bigint").alias("n_tokens"))


def longest_prefix(table: DataFrame, budget: int) -> DataFrame:
    """(doc_id, chars) of each document's longest prefix of at most ``budget`` tokens, from a prefix table."""
    last = F.aggregate(F.transform("counts", lambda n, i: F.when(n <= budget, i)), F.lit(-1), lambda a, i: F.coalesce(i, a))
    return table.withColumn("last", last).filter("last >= 0").groupBy("doc_id").agg(F.max(F.col("first") + F.col("last")).alias("chars"))


def op8(docs: DataFrame) -> DataFrame:
    return counts(docs).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"), F.col("fits").alias("fits_chars"))
