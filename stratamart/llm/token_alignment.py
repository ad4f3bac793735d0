"""Two tokenizers' tokens of one text, aligned by the bytes they cover.

Both tokenizations cut the same bytes.  Tokens that overlap belong together; a group ends where a token of either ends.  Groups are found by
pointer jumping: every token points to the farthest-right token of the other tokenizer that overlaps it, the one with its last byte.  Ends never
go back along pointers, and where both end together the pointers meet in the token of the first tokenizer, which points to itself.  So
doubling all pointers at once (successor of the successor) until none changes leaves in every token the last token of its component, which
labels the group; a component of k tokens takes log2(k) steps over whole arrays.

No token of either vocabulary reaches from a word into the blank or line feed behind it, so texts are cut there, and a cut piece met
before is looked up: the memory is bounded and changes no result.  Pieces not met before are tokenized and aligned many at a time.  Texts with
other white space, or vocabularies of another kind, are taken whole.

Links are counted over the corpus: in how many documents (rows) does a pair of ids overlap?  Texts are tokenized once and kept in the shared folder as lists of
pieces; tasks then send each pair once with its count.  The table of pairs is bounded by the two vocabularies alone, not by the texts; up to ``LOOKUP`` pairs it goes to all tasks, beyond it meets the documents' pairs
in a shuffled join with the same result.

Defined cases: texts that are null or empty, or whose tokens do not give back a blank and the text (U+2581 in a text, say), have no tokens: zeros and ''.
Special strings inside texts are plain text.  Repeated rows are documents of their own; rows without id are treated like others.  Texts of any
length are aligned whole.  No rows give no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratamart.llm.common import Memory, found_by_workers, kept, stored

FIRST, SECOND = "byte_bpe_50k.json", "piece_bpe_32k.model"
SPACE = "▁"
#: Pairs of ids up to which their table is sent to all tasks.
LOOKUP = 1 << 21
BATCH_ROWS = 1000
#: Characters of new pieces that are tokenized in one go.
RUN = 1 << 16
_PIECE = re.compile("[ \n]*[^ \n]+|[ \n]+")
#: White space, in any reading of the word, that is neither a blank nor a line feed.
_OTHER_BLANK = re.compile("[" + "".join(map(chr, [9, 11, 12, 13, 28, 29, 30, 31, 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF])) + "]")


def terminal_tokens(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Group labels of both sides' tokens, and the linked token of either side for each link, from left to right.

    ``ends_*``: byte offsets behind each token, ascending; both end with the text's length.  A label is the index of the group's last first-side token.
    """
    n = len(ends_a)
    over_a, over_b = (np.searchsorted(e, o, side="left") for e, o in ((ends_b, ends_a), (ends_a, ends_b)))  # the other side's token with the last byte
    successor = np.concatenate([np.where(ends_b[over_a] > ends_a, n + over_a, np.arange(n)), over_b])
    while True:
        doubled = successor[successor]
        if np.array_equal(doubled, successor):
            break
        successor = doubled
    # Two cuts of one stretch of bytes overlap in as many places as their ends together make.
    cuts = np.union1d(ends_a, ends_b)
    return successor[:n], successor[n:], np.searchsorted(ends_a, cuts, side="left"), np.searchsorted(ends_b, cuts, side="left")


class Piece(tuple):
    """(tokens of A, tokens of B, groups, links, the groups as text, linked pairs as bytes) of a piece of text."""


class Aligner(Memory):
    """Aligned pieces of text, met before or new."""

    LIMIT = 1 << 17

    def __init__(self, first: str, second: str):
        import sentencepiece
        from tokenizers import Tokenizer

        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks fill the cores
        self.a = Tokenizer.from_file(first)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=second)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that byte-level vocabularies spell as themselves
        spelled = {chr(c): c for c in plain} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in plain)}
        size = max(self.a.get_vocab_size(), 1 + max(self.a.get_vocab().values()))
        entries = [self.a.id_to_token(i) or "" for i in range(size)]
        self.bytes_a = [bytes(spelled[c] for c in t) if all(c in spelled for c in t) else t.encode() for t in entries]
        model = self.b
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.length_a, self.length_b = (np.array([len(t) for t in table], dtype=np.int64) for table in (self.bytes_a, self.bytes_b))
        number = [str(i) for i in range(max(len(entries), len(pieces)))]
        self.names = [n + mark for mark in (",", "|", ";") for n in number]
        self.width = len(number)
        kind = str(self.a.pre_tokenizer)
        cut_a = self.a.normalizer is None and kind.startswith("ByteLevel(") and "add_prefix_space=False" in kind and "use_regex=True" in kind
        normal = [p for i, p in enumerate(pieces) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        cut_b = not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in normal) and model.normalize(" ﬁ  a ") == f"{SPACE}{SPACE}ﬁ{SPACE}{SPACE}a{SPACE}"
        self.start = model.piece_to_id(SPACE + "a")
        self.cut = cut_a and cut_b and model.id_to_piece(self.start) == SPACE + "a"

    def ids(self, text: str, begins: bool = False) -> tuple[np.ndarray, np.ndarray] | None:
        """Both tokenizations of a piece (or, if ``begins``, of a whole text behind its blank), or None if their bytes are not those of the piece."""
        a = self.a.encode(text, add_special_tokens=False).ids
        if begins:
            b = self.b.encode(text[1:])
        else:  # the letter keeps the library from putting a blank before the piece
            first, *b = self.b.encode("a" + text)
            if first != self.start:
                return None
        raw = text.encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw:
            return None
        return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)

    def pieces(self, a: np.ndarray, b: np.ndarray, ends: np.ndarray) -> list[Piece] | None:
        """The aligned pieces of one stretch that ends at these bytes; None if a token crosses one of them."""
        length_a, length_b = self.length_a[a], self.length_b[b]
        if not (length_a.all() and length_b.all()):
            return None
        ends_a, ends_b = np.cumsum(length_a), np.cumsum(length_b)
        last_a, last_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        if (ends_a[last_a] != ends).any() or (ends_b[last_b] != ends).any():
            return None
        group_a, group_b, link_a, link_b = terminal_tokens(ends_a, ends_b)
        # All tokens by group, A before B; each with the mark behind it.
        side = np.r_[np.zeros(len(a), dtype=np.int64), np.ones(len(b), dtype=np.int64)]
        place = np.r_[group_a, group_b] * 2 + side
        order = np.argsort(place, kind="stable")
        step = np.diff(place[order], append=place[order][-1] + 2)
        # From A to B of one group, the place goes up by one; within a side not at all; else a new group begins.
        mark = np.where(step == 0, 0, np.where((step == 1) & (side[order] == 0), 1, 2))
        names = list(map(self.names.__getitem__, (mark * self.width + np.r_[a, b][order]).tolist()))
        pairs = (a[link_a] << 32 | b[link_b]).astype("<i8")
        upto_link = np.searchsorted(link_a, last_a, side="right")
        upto_group = np.cumsum(np.r_[True, np.diff(group_a) > 0])[last_a]
        upto = np.stack([last_a + 1, last_b + 1, upto_group, upto_link], axis=1)
        each = np.diff(upto, axis=0, prepend=np.zeros((1, 4), dtype=upto.dtype)).tolist()
        out, token, link = [], 0, 0
        for n_a, n_b, n_groups, n_links in each:
            text = "".join(names[token : token + n_a + n_b])[:-1]
            out.append(Piece((n_a, n_b, n_groups, n_links, text, pairs[link : link + n_links].tobytes())))
            token, link = token + n_a + n_b, link + n_links
        return out

    def one(self, text: str, begins: bool = False) -> Piece | None:
        found = self.ids(text, begins)
        made = found and self.pieces(*found, np.array([len(text.encode())]))
        return made[0] if made else None

    def learn(self, new: list[str]) -> None:
        """Align pieces not met before.  Pieces from a blank or line feed to the end of a word follow each other as in a text."""
        runs: list[list[str]] = [[]]
        filled = 0
        for p in new:
            if p[0] not in " \n" or p[-1] in " \n":
                self[p] = self.one(p)
                continue
            if filled > RUN:
                runs.append([])
                filled = 0
            runs[-1].append(p)
            filled += len(p)
        for run in filter(None, runs):
            found = self.ids("".join(run))
            made = found and self.pieces(*found, np.cumsum([len(p.encode()) for p in run]))
            for p, x in zip(run, made or map(self.one, run)):  # one odd piece spoils a run: each for itself then
                self[p] = x

    def block(self, texts: list[str | None]) -> Block:
        self.renew()
        cut: list = []
        whole: list[Piece | None] = []
        for t in texts:
            if t and self.cut and not _OTHER_BLANK.search(t):
                cut.append(_PIECE.findall(" " + t))
            elif t:
                cut.append([-1 - len(whole)])  # a number, so that no cut piece equals it
                whole.append(self.one(" " + t, begins=True))
            else:
                cut.append([])
        every = dict.fromkeys(chain.from_iterable(cut))
        new = []
        for p in every:
            if p not in self and isinstance(p, str):
                if (known := self.old.get(p, every)) is every:
                    new.append(p)
                else:
                    self[p] = known
        self.learn(new)
        found = [self[p] if isinstance(p, str) else whole[-1 - p] for p in every]
        place = {p: i for i, p in enumerate(every)}
        pieces = np.fromiter(map(place.__getitem__, chain.from_iterable(cut)), dtype=np.int32)
        ends = np.cumsum([len(c) for c in cut], dtype=np.int64)
        odd = np.array([p is None for p in found], dtype=bool)
        none = np.array([not p or bool(odd[pieces[e - len(p) : e]].any()) for p, e in zip(cut, ends)], dtype=bool) if odd.any() else np.array([not p for p in cut], dtype=bool)
        if none.any():  # documents without tokens have no pieces
            stay = np.repeat(~none, np.diff(ends, prepend=0))
            pieces, ends = pieces[stay], np.cumsum(np.where(none, 0, np.diff(ends, prepend=0)))
        return Block(found, pieces, ends)


class Block(NamedTuple):
    """Documents as the pieces they consist of."""

    found: list[Piece | None]  #: the different pieces
    pieces: np.ndarray  #: all documents' pieces, as places in ``found``
    ends: np.ndarray  #: where each document's pieces end

    def numbers(self) -> np.ndarray:
        """(documents, 4): tokens of A and B, groups, links."""
        each = np.array([p[:4] if p else (0, 0, 0, 0) for p in self.found], dtype=np.int64).reshape(-1, 4)
        return totals(each, self.pieces, self.ends)

    def texts(self) -> Iterator[str | None]:
        """The groups of each document."""
        text, begin = [p and p[4] for p in self.found], 0
        for end in self.ends.tolist():
            yield ";".join(map(text.__getitem__, self.pieces[begin:end].tolist())) if end > begin else None
            begin = end


def totals(each: np.ndarray, pieces: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums over each document's pieces of what each piece has."""
    upto = np.concatenate([np.zeros((1, each.shape[1]), dtype=np.int64), np.cumsum(each[pieces], axis=0)])
    return upto[ends] - upto[np.concatenate([[0], ends[:-1]])] if len(ends) else upto[:0]


def _aligner(first: str | None, second: str | None) -> Aligner:
    import public_tokenizers

    a, b = first or public_tokenizers.path(FIRST), second or public_tokenizers.path(SECOND)
    return kept(f"aligner {a} {b}", lambda: Aligner(a, b))


def blocks(docs: DataFrame, first: str | None = None, second: str | None = None) -> DataFrame:
    """Documents tokenized and aligned, some thousand to a row: numbers and digests of each, its pieces, and the linked pairs of the different pieces."""
    found_by_workers(docs.sparkSession)
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(first, second)
        for b in batches:
            if not b.num_rows:
                continue
            block = aligner.block(b.column("text").to_pylist())
            links = [p[5] if p else b"" for p in block.found]
            upto = np.cumsum([len(x) // 8 for x in links], dtype="<i8")
            shas = ["" if t is None else hashlib.sha256(t.encode()).hexdigest() for t in block.texts()]
            ids = b.column("doc_id")
            binary = [x.tobytes() for x in (block.numbers().astype("<i8"), block.ends.astype("<i8"), block.pieces.astype("<i4"), upto)] + [b"".join(links)]
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays([0, len(ids)], ids), pa.array([shas], pa.list_(pa.string())), *[pa.array([x], pa.binary()) for x in binary]],
                names=["doc_ids", "shas", "numbers", "ends", "pieces", "upto", "links"],
            )

    return docs.select("doc_id", "text").mapInArrow(work, f"doc_ids array<{kind}>, shas array<string>, numbers binary, ends binary, pieces binary, upto binary, links binary")


def _array(batch: pa.RecordBatch, column: str, row: int, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(batch.column(column)[row].as_py(), dtype=kind)


def _pairs_of(batch: pa.RecordBatch, row: int) -> Iterator[np.ndarray]:
    """The linked pairs of each document of a block."""
    ends, pieces, upto, links = (_array(batch, c, row, k) for c, k in (("ends", "<i8"), ("pieces", "<i4"), ("upto", "<i8"), ("links", "<i8")))
    size, begin = np.diff(upto, prepend=0), 0
    for end in ends.tolist():
        own = pieces[begin:end]
        n = size[own]
        yield links[np.repeat(upto[own] - np.cumsum(n), n) + np.arange(n.sum())] if end > begin else links[:0]
        begin = end


def pair_counts(made: DataFrame) -> DataFrame:
    """(pair, n, best): in how many documents a pair (id of A times 2^32, plus id of B) is linked, and whether no pair of the same id of A is in more.  ``made``: stored blocks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                each = [np.unique(x) for x in _pairs_of(b, row)]
                pairs, n = np.unique(np.concatenate([np.empty(0, dtype="<i8"), *each]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], names=["pair", "n"])

    each = made.select("ends", "pieces", "upto", "links").mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    each = stored(each.withColumn("a", F.shiftright("pair", 32)))
    most = stored(each.groupBy("a").agg(F.max("n").alias("most")))
    return each.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


_NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def _looked_up(made: DataFrame, counts: DataFrame, kind: str) -> DataFrame:
    table = counts.toArrow()
    pairs, n, best = (table.column(c).to_numpy() for c in ("pair", "n", "best"))
    order = np.argsort(pairs)
    shared = made.sparkSession.sparkContext.broadcast((pairs[order], np.stack([best[order], n[order]], axis=1).astype(np.int64)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, values = shared.value
        for b in batches:
            for row in range(b.num_rows):
                upto = _array(b, "upto", row)
                sums = np.concatenate([np.zeros((1, 2), dtype=np.int64), np.cumsum(values[np.searchsorted(known, _array(b, "links", row))], axis=0)])
                each = sums[upto] - sums[np.concatenate([[0], upto[:-1]]).astype(np.int64)] if len(upto) else sums[:0]
                found = totals(each, _array(b, "pieces", row, "<i4"), _array(b, "ends", row))
                columns = np.concatenate([_array(b, "numbers", row).reshape(-1, 4), found], axis=1).T
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_ids")[row].values, *[pa.array(np.ascontiguousarray(c)) for c in columns], b.column("shas")[row].values],
                    names=["doc_id", *_NUMBERS, "n_best", "count_sum", "groups_sha256"],
                )

    numbers = ", ".join(f"{c} bigint" for c in [*_NUMBERS, "n_best", "count_sum"])
    return made.mapInArrow(work, f"doc_id {kind}, {numbers}, groups_sha256 string")


def _joined(made: DataFrame, counts: DataFrame, kind: str) -> DataFrame:
    """The same by a join: the pairs of different pieces of each block meet the counts; their sums go back to the blocks' documents."""
    made = made.withColumn("block", F.xxhash64("doc_ids", "shas", "links", "pieces"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                for i, pairs in enumerate(_pairs_of(b, row)):
                    pairs, times = np.unique(pairs, return_counts=True)
                    same = [pa.array([v] * len(pairs), pa.int64()) for v in (b.column("block")[row].as_py(), i)]
                    yield pa.RecordBatch.from_arrays([*same, pa.array(pairs), pa.array(times)], names=["block", "at", "pair", "times"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                ids, columns = b.column("doc_ids")[row].values, _array(b, "numbers", row).reshape(-1, 4).T
                place = [pa.array([b.column("block")[row].as_py()] * len(ids), pa.int64()), pa.array(range(len(ids)), pa.int64())]
                yield pa.RecordBatch.from_arrays([*place, ids, *[pa.array(np.ascontiguousarray(c)) for c in columns], b.column("shas")[row].values], names=["block", "at", "doc_id", *_NUMBERS, "groups_sha256"])

    each = made.select("block", "ends", "pieces", "upto", "links").mapInArrow(work, "block bigint, at bigint, pair bigint, times bigint")
    # Equal blocks share their number: their documents are alike, and so are their sums.
    sums = each.distinct().join(stored(counts), "pair").groupBy("block", "at").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum")
    )
    numbers = ", ".join(f"{c} bigint" for c in _NUMBERS)
    out = made.select("block", "doc_ids", "numbers", "shas").mapInArrow(rows, f"block bigint, at bigint, doc_id {kind}, {numbers}, groups_sha256 string")
    found = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    return out.join(stored(sums), ["block", "at"], "left").select("doc_id", *_NUMBERS, *found, "groups_sha256")


def align(docs: DataFrame, lookup: int = LOOKUP, first: str | None = None, second: str | None = None) -> DataFrame:
    """One row per document: tokens, groups, links, links that are their A id's most frequent, their counts' sum, and the groups' digest.

    ``first`` and ``second``: files of the tokenizers on every executor; public ones by default.  ``lookup``: pairs of ids up to which their table is sent to all tasks.
    """
    made, kind = stored(blocks(docs, first, second)), docs.schema["doc_id"].dataType.simpleString()
    made.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")  # a row holds a block
    counts = stored(pair_counts(made))
    return (_looked_up if counts.count() <= lookup else _joined)(made, counts, kind)


def groups(docs: DataFrame, first: str | None = None, second: str | None = None) -> DataFrame:
    """(doc_id, groups): the groups of each text, `a1,a2|b1;a3|b2,b3`; null without tokens."""
    found_by_workers(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(first, second)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(list(aligner.block(b.column("text").to_pylist()).texts()), pa.string())], names=["doc_id", "groups"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, groups string")


def op13(docs: DataFrame) -> DataFrame:
    return align(docs)
