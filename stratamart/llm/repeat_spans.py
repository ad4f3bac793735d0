"""Repeated passages: every byte covered by a string of ``LENGTH`` bytes that also starts earlier in the corpus, found by prefix-free parsing.

A rolling hash of eight bytes picks triggers: the first place in a window at which the hash is divisible by ``DIVISOR``, or, where there is none, the
window's least hash.  Each start of a string belongs to the trigger of its window, so equal strings stand at equal distance before equal triggers,
wherever they are.  The starts of one trigger are consecutive: together with the bytes that their strings cover they are a phrase.  The corpus
becomes its dictionary of different phrases and its parse, the places where they stand.

* Equal phrases are found by their hashes alone (128 bits), one shuffle of numbers; all but the first in corpus order repeat.  However often
  a passage is copied, its inside costs one entry.
* Different phrases can share strings only if the ``STEM`` bytes from the trigger on, which all strings of a phrase contain, are equal.  Such phrases meet by the
  stem's hash.  Their tails before the trigger are sorted from the trigger leftwards, what follows the stem from there rightwards: the suffix orders of
  dictionary and parse, each with the length that neighbours have in common.  The string t bytes before the trigger is told from others by its class among
  tails of t bytes and its class among continuations of ``REACH`` - t bytes; equal pairs of classes are equal strings, the first of them in corpus order stays.

Corpus order is that of doc_id, then the text's hash: documents are range-partitioned by them once and packed into compressed blocks, and a place's number (partition,
block, offset) follows the order.  All later shuffles carry such numbers, besides the bytes round triggers of phrases that share a stem.

A stem that very many different phrases share (found in a sample of blocks, which changes the cost only) is dealt to many tasks, and a long run is taken in pieces; what
is first in its piece is compared across pieces by the strings' hashes (128 bits), one row per string and piece.

Defined cases: texts are whole, of any length; null is empty; shorter texts keep everything.  Documents without id come first; documents of one id follow
each other by their texts' hashes; rows repeated in id and text are documents of their own, and all but one of them lose what repeats.  Matches
never cross documents.  No rows give no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stratamart.llm.common import found_by_workers, released, scratch_table

LENGTH = 100
#: Starts per window, and the bytes from the trigger on that all strings of a phrase contain.
WINDOW = 67
REACH = WINDOW - 1
STEM = LENGTH - REACH
DIVISOR = 64
#: Bytes of text in a block, and starts parsed at once.
BLOCK, SEGMENT = 1 << 21, 1 << 20
#: A place is partition, block and offset, the offset in so many bits, the block in so many.
OFFSET_BITS, BLOCK_BITS = 30, 15
#: Blocks sampled for frequent stems, different phrases of a stem in them that make it frequent, and tasks that share one.
SAMPLE_BLOCKS, FREQUENT, SALTS = 16, 64, 256
#: Phrases of one stem that are compared at once.
RUN = 1 << 14
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))


def triggers(data: np.ndarray) -> np.ndarray:
    """For each start the trigger of its window; ``data`` holds at least ``LENGTH`` bytes, the last starts lack a window and are left out."""
    x = data.astype(np.uint64)
    x = x[:-1] | x[1:] << np.uint64(8)
    x = x[:-2] | x[2:] << np.uint64(16)
    x = x[:-4] | x[4:] << np.uint64(32)
    x *= _MIX[0]
    x ^= x >> np.uint64(32)
    x *= _MIX[1]
    x >>= np.uint64(32)
    x[x % np.uint64(DIVISOR) == 0] = 0
    x = x << np.uint64(32) | np.arange(len(x), dtype=np.uint64)
    span = 1
    while 2 * span <= WINDOW:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    rest = WINDOW - span
    x = np.minimum(x[: len(x) - rest], x[rest:]) if rest else x
    return (x & np.uint64(0xFFFFFFFF)).astype(np.int64)


def parse(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First start, last start and trigger of each phrase of a block's documents, in order."""
    out = []
    stops = ends - (LENGTH - 1)
    for s in range(0, len(data), SEGMENT):
        e = min(len(data), s + SEGMENT)
        b, c = np.clip(begins, s, e), np.clip(stops, s, e)
        n = np.maximum(c - b, 0)
        if not n.any():
            continue
        start = np.repeat(b - s - (np.cumsum(n) - n), n) + np.arange(n.sum())
        trigger = triggers(data[s : e + LENGTH])[start]
        new = np.flatnonzero(np.r_[True, (np.diff(trigger) != 0) | (np.diff(start) != 1)])
        out.append((start[new] + s, start[np.r_[new[1:], len(start)] - 1] + s, trigger[new] + s))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, dtype=np.int64),) * 3


class Parsed:
    """A block's text, documents and phrases."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        self.place = batch.column("place")[row].as_py()
        self.raw = zstandard.ZstdDecompressor().decompress(batch.column("text")[row].as_py(), max_output_size=1 << OFFSET_BITS)
        self.data = np.frombuffer(self.raw, dtype=np.uint8)
        self.ends = np.frombuffer(batch.column("ends")[row].as_py(), dtype="<i8")
        self.begins = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.ids = batch.column("ids")[row].values
        self.first, self.last, self.trigger = parse(self.data, self.begins, self.ends)
        raw, digest = self.raw, xxhash.xxh3_128_digest
        self.phrases = [digest(raw[a:b]) for a, b in zip(self.first.tolist(), (self.last + LENGTH).tolist())]
        self.repeated = pd.Series(self.phrases, dtype=object).duplicated().to_numpy(dtype=bool)

    def stems(self, of: np.ndarray) -> np.ndarray:
        raw, digest = self.raw, xxhash.xxh3_64_digest
        return np.frombuffer(b"".join([digest(raw[q : q + STEM]) for q in self.trigger[of].tolist()]), dtype="<i8")

    def hashes(self, of: np.ndarray) -> np.ndarray:
        return np.frombuffer(b"".join(self.phrases), dtype="<i8")[::2][of]


def blocks(docs: DataFrame) -> DataFrame:
    """(place, ids, ends, text): the documents in corpus order, packed."""
    spark = docs.sparkSession
    found_by_workers(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, filled = TaskContext.get().partitionId(), 0, 0
        ids: list = []
        texts: list[bytes] = []

        def made() -> pa.RecordBatch:
            place = (part << BLOCK_BITS | number) << OFFSET_BITS
            ends = np.cumsum([len(t) for t in texts], dtype="<i8").tobytes()
            values = [[place], [ids], [ends], [zstandard.ZstdCompressor(level=1).compress(b"".join(texts))]]
            kinds = [pa.int64(), pa.list_(id_kind), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=["place", "ids", "ends", "text"])

        for b in batches:
            id_kind = b.column("doc_id").type
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                t = t or b""
                if texts and filled + len(t) > BLOCK:
                    yield made()
                    number, filled, ids, texts = number + 1, 0, [], []
                ids.append(i)
                texts.append(t)
                filled += len(t)
        if texts:
            yield made()

    order = ["doc_id", "text_hash", "row"]
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("row"), F.col("text").cast("binary").alias("text"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return scratch_table(rows.mapInArrow(pack, f"place bigint, ids array<{kind}>, ends binary, text binary"), "blocks")


def _over_blocks(made: DataFrame, work: Callable[[Parsed, pa.RecordBatch, int], pa.RecordBatch | None], schema: str) -> DataFrame:
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                out = work(Parsed(b, row), b, row)
                if out is not None and out.num_rows:
                    yield out

    return made.mapInArrow(each, schema)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) if isinstance(v, np.ndarray) else v for v in columns.values()], names=list(columns))


def frequent_stems(made: DataFrame, limit: int = FREQUENT) -> np.ndarray:
    """Stems with many different phrases in a sample of blocks, sorted."""
    share = max(1, made.count() // SAMPLE_BLOCKS)

    def work(block: Parsed, batch: pa.RecordBatch, row: int) -> pa.RecordBatch:
        own = np.flatnonzero(~block.repeated)
        return _batch(stem=block.stems(own), phrase=block.hashes(own))

    some = _over_blocks(made.filter(F.pmod(F.xxhash64("place"), F.lit(share)) == 0), work, "stem bigint, phrase bigint")
    found = some.distinct().groupBy("stem").count().filter(F.col("count") >= limit).orderBy(F.desc("count"), "stem").limit(1 << 16)
    return np.sort(np.array([r["stem"] for r in found.collect()], dtype=np.int64))


def _is_in(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values if len(table) else np.zeros(len(values), dtype=bool)


def _salts(stems: np.ndarray, hashes: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """-1 for usual stems; the phrases of frequent ones are dealt to many."""
    return np.where(_is_in(stems, hot), hashes & (SALTS - 1), -1)


def _equal_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (stem, salt, phrase, at): places of repeated phrases, and of first ones whose stem has others (``twin`` false, true)."""
    held = None  # the last stem's last phrase so far: (stem, salt, phrase, at), whether its place is out, whether its stem has others
    for b in batches:
        if not b.num_rows:
            continue
        stem, salt, phrase, at = (b.column(c).to_numpy() for c in ("stem", "salt", "phrase", "at"))
        done = others = False
        if held:
            (s, a, p, q), done, others = held
            stem, salt, phrase, at = np.r_[s, stem], np.r_[a, salt], np.r_[p, phrase], np.r_[q, at]
        new_stem = np.r_[True, (np.diff(stem) != 0) | (np.diff(salt) != 0)]
        new = new_stem | np.r_[True, np.diff(phrase) != 0]
        run = np.cumsum(new_stem) - 1
        several = np.bincount(run, weights=new) > 1
        several[0] |= others
        first = new & (several[run] | (salt >= 0))
        if held:
            first[0] &= not done
        out = np.where(first | ~new)[0]
        yield _batch(at=at[out], twin=first[out])
        k = np.flatnonzero(new)[-1]  # the last phrase's first place
        held = (stem[k], salt[k], phrase[k], at[k]), bool(first[k]) or (k == 0 and done), bool(several[run[k]])


def _dictionary(made: DataFrame, hot: np.ndarray) -> DataFrame:
    """(at, twin): repeated phrases' places, and those of different phrases with a common stem."""
    shared = made.sparkSession.sparkContext.broadcast(hot)

    def work(block: Parsed, batch: pa.RecordBatch, row: int) -> pa.RecordBatch:
        own = np.flatnonzero(~block.repeated)  # what repeats within the block is known there
        stems, hashes = block.stems(own), block.hashes(own)
        return _batch(stem=stems, salt=_salts(stems, hashes, shared.value), phrase=hashes, at=block.place + block.first[own])

    rows = _over_blocks(made, work, "stem bigint, salt bigint, phrase bigint, at bigint")
    rows = rows.repartition("stem", "salt").sortWithinPartitions("stem", "salt", "phrase", "at")
    return scratch_table(rows.mapInArrow(_equal_phrases, "at bigint, twin boolean"), "phrases")


def _by_block(places: DataFrame, value: str) -> DataFrame:
    """(place, values): what is known of each block's places; at most some ten thousand to a block."""
    return scratch_table(places.groupBy(F.shiftleft(F.shiftright("at", OFFSET_BITS), OFFSET_BITS).alias("place")).agg(F.collect_list(value).alias("values")), "by_block")


def _contexts(made: DataFrame, twins: DataFrame, hot: np.ndarray) -> DataFrame:
    """(stem, salt, at, left, bytes): the bytes before the trigger and behind the stem of phrases that share a stem."""
    shared = made.sparkSession.sparkContext.broadcast(hot)

    def work(block: Parsed, batch: pa.RecordBatch, row: int) -> pa.RecordBatch:
        own = np.searchsorted(block.first, np.sort(batch.column("values")[row].values.to_numpy()) - block.place)
        stems, raw = block.stems(own), block.raw
        first, trigger, end = block.first[own], block.trigger[own], block.last[own] + LENGTH
        around = [raw[a:q] + raw[q + STEM : z] for a, q, z in zip(first.tolist(), trigger.tolist(), end.tolist())]
        return _batch(stem=stems, salt=_salts(stems, block.hashes(own), shared.value), at=block.place + first, left=trigger - first, bytes=pa.array(around, pa.binary()))

    return _over_blocks(made.join(twins, "place"), work, "stem bigint, salt bigint, at bigint, left bigint, bytes binary")


def _sorted_classes(rows: list[bytes], run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of byte strings within their runs, and how many bytes each has in common with the one before it (-1 in another run)."""
    width = -(-REACH // 8) * 8
    bytes_ = np.frombuffer(b"".join([r.ljust(width, b"\0") for r in rows]), dtype=np.uint8).reshape(-1, width)
    words = bytes_.view(">u8")
    order = np.lexsort((*[words[:, k] for k in range(words.shape[1] - 1, -1, -1)], run))
    differ = bytes_[order[1:]] != bytes_[order[:-1]]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return order, np.r_[-1, np.where(np.diff(run[order]) != 0, -1, common)]


def first_strings(run: np.ndarray, left: np.ndarray, around: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(exists, repeats), phrases x starts: has the phrase a start t bytes before its trigger, and is the string there equal to one of an earlier phrase in its run?

    Phrases come sorted by run, then in corpus order.
    """
    n = len(run)
    right = np.array([len(x) for x in around]) - left
    tails, tails_common = _sorted_classes([x[:k][::-1] for x, k in zip(around, left.tolist())], run)
    nexts, nexts_common = _sorted_classes([x[k:] for x, k in zip(around, left.tolist())], run)
    exists, repeats = np.zeros((n, WINDOW), dtype=bool), np.zeros((n, WINDOW), dtype=bool)
    tail_class, next_class = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for t in range(WINDOW):
        exists[:, t] = (left >= t) & (right >= REACH - t)
        own = np.flatnonzero(exists[:, t])
        tail_class[tails] = np.cumsum(tails_common < t)
        next_class[nexts] = np.cumsum(nexts_common < REACH - t)
        place = tail_class[own] * (n + 1) + next_class[own]
        order = np.argsort(place, kind="stable")
        repeats[own[order[1:]], t] = np.diff(place[order]) == 0
    return exists, repeats


def _ranges(at: np.ndarray, left: np.ndarray, marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First starts and lengths of the ranges of marked starts; column t of ``marked`` is the start t bytes before the trigger."""
    edges = np.diff(marked[:, ::-1].astype(np.int8), axis=1, prepend=0, append=0)
    row, begin = np.nonzero(edges == 1)
    end = np.nonzero(edges == -1)[1]
    return at[row] + left[row] - (WINDOW - 1 - begin), end - begin


def _compare(rows: pa.Table | pa.RecordBatch, opened: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Repeated ranges (at, n), and first strings (at, stem, string) of runs that go on elsewhere."""
    stem, salt, at, left = (rows.column(c).to_numpy() for c in ("stem", "salt", "at", "left"))
    around = rows.column("bytes").to_pylist()
    run = np.cumsum(np.r_[True, (np.diff(stem) != 0) | (np.diff(salt) != 0)])
    exists, repeats = first_strings(run, left, around)
    begin, n = _ranges(at, left, repeats)
    none = pa.nulls(len(n), pa.int64())
    yield _batch(at=begin, n=n, stem=none, string=none)
    row, t = np.nonzero(exists & ~repeats & opened[:, None])
    if len(row):
        text = [around[r][k - d : k] + around[r][k : k + REACH - d] + bytes([d]) for r, d, k in zip(row.tolist(), t.tolist(), left[row].tolist())]
        string = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, text)), dtype="<i8")
        yield _batch(at=at[row] + left[row] - t, n=np.zeros(len(row), dtype=np.int64), stem=stem[row], string=string)


def _shared_strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (stem, salt, at).  A run longer than ``RUN`` is compared in pieces, like one dealt to many tasks."""
    held: pa.Table | None = None
    going_on = None  # the run whose beginning has been compared already
    for b in batches:
        rows = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
        if not rows.num_rows:
            continue
        key = np.stack([rows.column(c).to_numpy() for c in ("stem", "salt")], axis=1)
        cuts = np.r_[0, np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1]
        last = int(cuts[-1])
        if rows.num_rows - last > RUN:  # the last run's beginning goes out with the rest
            yield from _taken(rows, key, going_on, len(key) - 1)
            going_on, held = tuple(key[-1]), None
        else:
            if last:
                yield from _taken(rows.slice(0, last), key[:last], going_on, None)
                going_on = None if going_on != tuple(key[last]) else going_on
            held = rows.slice(last)
    if held is not None and held.num_rows:
        key = np.stack([held.column(c).to_numpy() for c in ("stem", "salt")], axis=1)
        yield from _taken(held, key, going_on, None)


def _taken(rows: pa.Table, key: np.ndarray, going_on: tuple | None, unfinished: int | None) -> Iterator[pa.RecordBatch]:
    """Compare whole runs, ``RUN`` phrases or more at once; single phrases of finished runs have nothing to be compared with."""
    opened = key[:, 1] >= 0
    for other in (going_on, None if unfinished is None else tuple(key[unfinished])):
        if other is not None:
            opened |= (key == np.array(other)).all(axis=1)
    new = np.r_[True, (key[1:] != key[:-1]).any(axis=1)]
    run = np.cumsum(new) - 1
    many = np.flatnonzero(opened | (np.bincount(run)[run] > 1))
    starts = many[new[many] | np.r_[True, np.diff(many) > 1]] if len(many) else many
    begin = 0
    while begin < len(many):
        limit = starts[np.searchsorted(starts, many[begin], side="right") :]
        ends = np.searchsorted(many, limit)
        ends = np.r_[ends[ends - begin >= min(RUN, 4096)][:1], len(many)][:1]
        part = many[begin : int(ends[0])]
        yield from _compare(rows.take(pa.array(part)).combine_chunks(), opened[part])
        begin = int(ends[0])


def repeated_starts(made: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """(place, values): of each block the ranges (at, n) of starts whose string starts earlier too.  What repeats within a block is left to its parse."""
    spark = made.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50000")
    hot = frequent_stems(made, frequent)
    places = _dictionary(made, hot)
    released(spark)
    twins = _by_block(places.filter("twin"), "at")
    rows = _contexts(made, twins, hot).repartition("stem", "salt").sortWithinPartitions("stem", "salt", "at")
    found = scratch_table(rows.mapInArrow(_shared_strings, "at bigint, n bigint, stem bigint, string bigint"), "strings")
    released(spark)
    # A piece sends each string once, so a string has as many rows as pieces.
    earlier = F.row_number().over(Window.partitionBy("stem", "string").orderBy("at")) > 1
    across = found.filter("n = 0").select("at", F.lit(1).cast("bigint").alias("n"), earlier.alias("earlier")).filter("earlier").drop("earlier")
    whole = places.filter(~F.col("twin")).select("at", F.lit(0).cast("bigint").alias("n"))
    return _by_block(whole.union(found.filter("n > 0").select("at", "n")).union(across).withColumn("range", F.struct("at", "n")), "range")


def _covered(block: Parsed, known: pa.StructScalar | None) -> np.ndarray:
    """Which bytes of the block go."""
    change = np.zeros(len(block.data) + 1, dtype=np.int32)
    marked = block.repeated.copy()
    if known is not None and len(known):
        at, n = (known.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
        at = at - block.place
        marked[np.searchsorted(block.first, at[n == 0])] = True
        np.add.at(change, at[n > 0], 1)
        np.add.at(change, (at + n)[n > 0] + LENGTH - 1, -1)
    np.add.at(change, block.first[marked], 1)
    np.add.at(change, block.last[marked] + LENGTH, -1)
    return np.cumsum(change[:-1]) > 0


def removals(docs: DataFrame, digest: Callable[[bytes], object], kind: str, frequent: int = FREQUENT) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of each document: the removed spans (begin, end) in bytes, and ``digest`` of the bytes that are left."""
    made = blocks(docs)
    released(docs.sparkSession)
    known = repeated_starts(made, frequent)
    id_kind = docs.schema["doc_id"].dataType.simpleString()

    def work(block: Parsed, batch: pa.RecordBatch, row: int) -> pa.RecordBatch:
        values = batch.column("values")[row]
        gone = _covered(block, values.values if values.is_valid else None)
        edges = np.diff(gone.astype(np.int8), prepend=0, append=0)
        # A span that goes on into the next document is cut there.
        inside = block.begins[(block.begins > 0) & (block.begins < len(gone))]
        cut = np.unique(inside[gone[inside] & gone[inside - 1]]) if len(inside) else inside
        begin, end = np.sort(np.r_[np.flatnonzero(edges == 1), cut]), np.sort(np.r_[np.flatnonzero(edges == -1), cut])
        upto, spans, kept = np.searchsorted(begin, block.ends), [], []
        b, e, done = begin.tolist(), end.tolist(), 0
        for start, stop, k in zip(block.begins.tolist(), block.ends.tolist(), upto.tolist()):
            own = list(zip(b[done:k], e[done:k]))
            at, left = start, []
            for x, y in own:
                left.append(block.raw[at:x])
                at = y
            left.append(block.raw[at:stop])
            kept.append(digest(b"".join(left)))
            spans.append([{"begin": x - start, "end": y - start} for x, y in own])
            done = k
        pairs = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        return _batch(doc_id=block.ids, n_bytes=block.ends - block.begins, spans=pa.array(spans, pairs), kept=pa.array(kept))

    schema = f"doc_id {id_kind}, n_bytes bigint, spans array<struct<begin:bigint,end:bigint>>, kept {kind}"
    return _over_blocks(made.join(known, "place", "left"), work, schema)


def cleaned(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, spans, kept): ``kept`` the bytes that are left."""
    return removals(docs, lambda kept: kept, "binary")


def op12(docs: DataFrame) -> DataFrame:
    rows = removals(docs, lambda kept: hashlib.sha256(kept).hexdigest(), "string")
    n_removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["begin"])
    return rows.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.col("kept").alias("kept_sha256"))
