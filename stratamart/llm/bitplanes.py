"""Token-ID output: ids in fixed-size blocks, transposed into planes, each plane compressed, with a chunk index.

A block holds ``BLOCK`` ids (the last of a shard may hold fewer).  Ids of one block share their high bits more than their
bytes do, so the block is transposed: plane p holds bit (or byte) p of every id, planes beyond the block's largest id are left out,
and each plane is compressed with zstandard.  A block's payload is self-contained.

Format: a Parquet table with one file per shard and one row per block; shards follow each other in ascending order of ids.

    shard int, block int       place of the block
    first bigint, n int        ids of the shard before the block, ids in it
    bits int                   1 for bit planes, 8 for byte planes
    ends array<int>            where each plane ends in the payload
    payload binary             the planes, compressed
    pieces array<struct<doc_id, row bigint, skip bigint, at int, n int, rest bigint>>
                               the documents in the block: row number in the shard, ids of the document before, where the
                               piece begins in the block, its length, ids of the document after it

All columns but the payload are the chunk index; reading them reads no payload.  Spark's writer commits the files, so lost executors leave
no half-written shard.  Ids are unsigned 32-bit.

Defined cases: a null or empty text has only its end id; rows without id come first; rows with one id are separate
documents in the order of their texts' hashes; no rows give an empty table; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stratamart.llm.common import kept, scratch_folder, texts
from stratamart.llm.word_ids import WordIds

BLOCK = 1 << 16
END_ID = 1
LEVEL = 3
VOCABULARY = "word_bpe_49k.json"


def pack(ids: np.ndarray, bits: int, level: int = LEVEL) -> tuple[list[int], bytes]:
    """Ends and payload of a block of uint32 ids."""
    compress = zstandard.ZstdCompressor(level=level).compress
    used = int(ids.max()).bit_length() if len(ids) else 0
    if bits == 8:
        planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)[: -(-used // 8)]
    else:
        planes = [np.packbits((ids >> np.uint32(p) & np.uint32(1)).astype(np.uint8)) for p in range(used)]
    parts = [compress(p.tobytes()) for p in planes]
    return np.cumsum([len(p) for p in parts], dtype=int).tolist(), b"".join(parts)


def unpack(n: int, bits: int, ends: list[int], payload: bytes) -> np.ndarray:
    """The block's ids."""
    inflate = zstandard.ZstdDecompressor().decompress
    planes = [np.frombuffer(inflate(payload[a:b]), dtype=np.uint8) for a, b in zip([0, *ends], ends)]
    if bits == 8:
        out = np.zeros((n, 4), dtype=np.uint8)
        for p, plane in enumerate(planes):
            out[:, p] = plane
    else:
        out = np.zeros(n, dtype="<u4")
        for p, plane in enumerate(planes):
            out |= np.unpackbits(plane, count=n).astype("<u4") << np.uint32(p)
    return out.reshape(-1).view("<u4")


class _Shard:
    """Cuts the documents of one shard into blocks."""

    def __init__(self, shard: int, bits: int, size: int):
        self.shard, self.bits, self.size = shard, bits, size
        self.block = self.rows = self.filled = self.first = 0
        self.held: list[np.ndarray] = []
        self.pieces: list[dict] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[dict]:
        done = 0
        while done < len(ids):
            n = min(self.size - self.filled, len(ids) - done)
            self.held.append(ids[done : done + n])
            self.pieces.append({"doc_id": doc_id, "row": self.rows, "skip": done, "at": self.filled, "n": n, "rest": len(ids) - done - n})
            self.filled, done = self.filled + n, done + n
            if self.filled == self.size:
                yield self.close()
        self.rows += 1

    def close(self) -> dict:
        ids = np.concatenate(self.held)
        ends, payload = pack(ids, self.bits)
        row = {"shard": self.shard, "block": self.block, "first": self.first, "n": len(ids), "bits": self.bits, "ends": ends, "payload": payload, "pieces": self.pieces}
        self.block, self.first, self.filled, self.held, self.pieces = self.block + 1, self.first + len(ids), 0, [], []
        return row


COLUMNS = ["shard", "block", "first", "n", "bits", "ends", "payload", "pieces"]


def write(docs: DataFrame, path: str, encoder: Callable[[], Callable[[str], np.ndarray]], end_id: int | None = END_ID, bits: int = 1, block: int = BLOCK) -> None:
    """Encode the texts and write them in ascending order of doc_id.  ``encoder`` makes a task's text-to-ids function."""

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, end = encoder(), np.array([] if end_id is None else [end_id], dtype="<u4")
        shard = _Shard(TaskContext.get().partitionId(), bits, block)
        for b in batches:
            made = []
            for i, t in zip(b["doc_id"].astype(object), b["text"]):
                made += shard.add(None if i is None or i != i else int(i), np.concatenate([encode(t or ""), end]))
            if made:
                yield pd.DataFrame(made, columns=COLUMNS)
        if shard.held:
            yield pd.DataFrame([shard.close()], columns=COLUMNS)

    kind = docs.schema["doc_id"].dataType.simpleString()
    piece = f"doc_id {kind}, row bigint, skip bigint, at int, n int, rest bigint"
    rows = texts(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    rows.mapInPandas(blocks, f"shard int, block int, first bigint, n int, bits int, ends array<int>, payload binary, pieces array<struct<{piece}>>").write.parquet(path)


def _shards(index: DataFrame) -> DataFrame:
    """(shard, base): ids in the shards before.  One row per shard."""
    totals = index.groupBy("shard").agg(F.sum("n").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def pieces(blocks: DataFrame, digest: Callable[[np.ndarray, int], object], kind: str) -> DataFrame:
    """(doc_id, shard, row, begin, n, skip, out): ``digest(ids, ids after the piece)`` of each piece; ``begin`` counts within the shard."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                ids = unpack(r.n, r.bits, list(r.ends), r.payload)
                out += [(p["doc_id"], r.shard, p["row"], r.first + p["at"], p["n"], p["skip"], digest(ids[p["at"] : p["at"] + p["n"]], p["rest"])) for p in r.pieces]
            yield pd.DataFrame(out, columns=["doc_id", "shard", "row", "begin", "n", "skip", "out"])

    id_kind = blocks.schema["pieces"].dataType.elementType["doc_id"].dataType.simpleString()
    return blocks.select(COLUMNS).mapInPandas(decode, f"doc_id {id_kind}, shard int, row bigint, begin bigint, n bigint, skip bigint, out {kind}")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, skip, ids): the documents' ids in pieces; ``skip`` ids of the document come before the piece."""
    blocks = spark.read.parquet(path)
    rows = pieces(blocks, lambda ids, rest: ids.astype("int64"), "array<bigint>")
    return rows.join(_shards(blocks), "shard").select("doc_id", (F.col("base") + F.col("begin") - F.col("skip")).alias("start"), "skip", F.col("out").alias("ids"))


_POLYNOMIAL = 0xEDB88320  # crc32, reflected


def _zeros(k: int) -> list[int]:
    """The linear map over crc states of 2^k zero bytes, as the images of the 32 bits."""
    one = [_POLYNOMIAL, *(1 << i for i in range(31))]  # of one zero bit
    for _ in range(3 + k):
        one = [_apply(one, x) for x in one]
    return one


def _apply(columns: list[int], state: int) -> int:
    out = 0
    for i in range(32):
        if state >> i & 1:
            out ^= columns[i]
    return out


_ZEROS = [_zeros(k) for k in range(48)]


def crc_part(data: bytes, after: int) -> int:
    """What these bytes, followed by ``after`` more, give to a crc32: the parts of a text XOR to its crc32."""
    state = zlib.crc32(data)
    for k in range(after.bit_length()):
        if after >> k & 1:
            state = _apply(_ZEROS[k], state)
    return state


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files.

    Each piece is digested where it is read and the digests of a document's pieces combine by XOR: ids are not shuffled.
    """
    blocks = spark.read.parquet(path)
    rows = pieces(blocks, lambda ids, rest: crc_part(ids.astype("<u4").tobytes(), 4 * rest), "bigint")
    each = rows.groupBy("shard", "row").agg(
        F.first("doc_id").alias("doc_id"), F.min(F.col("begin") - F.col("skip")).alias("begin"), F.sum("n").alias("n_tokens"), F.bit_xor("out").alias("ids_crc32")
    )
    return each.join(_shards(blocks), "shard").select("doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")


def word_encoder(vocabulary: str | None = None) -> Callable[[], Callable[[str], np.ndarray]]:
    """``vocabulary``: a file's path on every executor; the public one by default."""

    def make() -> Callable[[str], np.ndarray]:
        import public_tokenizers

        path = vocabulary or public_tokenizers.path(VOCABULARY)
        return kept(f"word ids {path}", lambda: WordIds(path)).encode

    return make


def op1(docs: DataFrame) -> DataFrame:
    path = scratch_folder(docs.sparkSession, "token_ids")
    write(docs, path, word_encoder())
    return digests(docs.sparkSession, path)
