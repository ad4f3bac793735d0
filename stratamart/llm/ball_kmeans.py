"""Vector codes: each vector cut into equal parts, each part coded by the nearest entry of its place's codebook, learnt by ball k-means.

A codebook's entry and the parts assigned to it form a ball: the entry is its centre, the farthest member its radius.  By the triangle inequality
a member at distance d from its own entry can only move to entries at most 2d away from that entry, so

* neighbours of an entry are those at most two radii away; no member of the ball ever leaves for another;
* members closer than half the way to the nearest neighbour are the stable core: they stay without further work;
* the others lie in rings bounded by half the ways to the neighbours, nearest first; a member of ring k is compared with the k nearest neighbours alone.

Codebooks are whole numbers (components are floor(256 * x)) and so is every comparison: squares only, ties to the lower index.  After a round an
entry has moved by s, so its ball's radius is at most the old one plus s; no pass over the vectors is spent on it.  The first assignment has no
balls yet and compares with all entries.

Vectors never leave their partitions: tasks send sums per entry (parts x entries x components numbers, whatever the table's size), and the
codebooks, of the same size, are all that reaches the driver.  Each round is written to the shared folder.

Defined cases: rows whose vector is null, or holds a null or a component that is not finite, are dropped.  All vectors must be as long as most of
them are (the shorter length at a tie), this length a positive multiple of ``parts``, and components below 65,536 in size; a row that departs from this stays with null code and
error and teaches nothing.  Rows without id are coded but start no codebook.  Of rows with one id those with the lesser vector come first.  Fewer
rows than entries make a smaller codebook.  Repeated rows count each.  No rows give no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stratamart.llm.common import found_by_workers, scratch_table, stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components from here on are outside the grid, so that squared distances stay exact in 64 bits.
GRID = SCALE << 16
BATCH_ROWS = 8192


class Balls(NamedTuple):
    """The neighbours of each entry of one codebook within its ball's reach, nearest first."""

    first: np.ndarray  #: where each entry's neighbours begin
    other: np.ndarray  #: the neighbours
    square: np.ndarray  #: squared distance from the entry to each


def balls(book: np.ndarray, reach: list[int]) -> Balls:
    """``reach``: at least the squared radius of each entry's ball."""
    square = ((book[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
    first, other, far = [0], [], []
    for i, radius in enumerate(reach):
        near = [j for j in np.argsort(square[i], kind="stable").tolist() if j != i and int(square[i, j]) <= 4 * radius]
        other += near
        far += square[i, near].tolist()
        first.append(len(other))
    return Balls(np.array(first), np.array(other, dtype=np.int64), np.array(far, dtype=np.int64))


def moved_reach(radius: int, shift: int) -> int:
    """An upper bound of (sqrt(radius) + sqrt(shift)) ** 2."""
    return radius + shift + (math.isqrt(4 * radius * shift) + 1 if radius and shift else 0)


def nearest_of_all(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry to each row of ``x``."""
    square = np.zeros((len(x), len(book)), dtype=np.int64)
    for c in range(x.shape[1]):
        square += (x[:, c, None] - book[None, :, c]) ** 2
    at = square.argmin(axis=1)
    return at, square[np.arange(len(x)), at]


def nearest_in_ball(x: np.ndarray, book: np.ndarray, own: np.ndarray, ball: Balls) -> tuple[np.ndarray, np.ndarray]:
    """The same, for rows that belong to the balls of the entries ``own``."""
    at, best = own.copy(), ((x - book[own]) ** 2).sum(axis=1)
    begin, end = ball.first[own], ball.first[own + 1]
    touched = end > begin
    touched[touched] = 4 * best[touched] >= ball.square[begin[touched]]  # the rest is core
    rows = np.flatnonzero(touched)
    if not len(rows):
        return at, best
    # The ring of a row: how many neighbours are at most twice its distance away.
    ring = np.empty(len(rows), dtype=np.int64)
    order = np.argsort(own[rows], kind="stable")
    for same in np.split(order, np.flatnonzero(np.diff(own[rows][order])) + 1):
        entry = own[rows[same[0]]]
        ring[same] = np.searchsorted(ball.square[ball.first[entry] : ball.first[entry + 1]], 4 * best[rows[same]], side="right")
    starts = np.cumsum(ring) - ring
    member = np.repeat(rows, ring)
    other = ball.other[np.arange(ring.sum()) - np.repeat(starts, ring) + np.repeat(begin[rows], ring)]
    square = np.zeros(len(member), dtype=np.int64)
    for c in range(x.shape[1]):
        square += (x[member, c] - book[other, c]) ** 2
    least = np.minimum.reduceat(square, starts)
    index = np.minimum.reduceat(np.where(square == np.repeat(least, ring), other, len(book)), starts)
    better = (least < best[rows]) | ((least == best[rows]) & (index < at[rows]))
    at[rows[better]], best[rows[better]] = index[better], least[better]
    return at, best


def _components(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    """(rows, parts, components of a part) of a batch."""
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(batch.num_rows, parts, -1)


def _codes(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("codes").to_pylist()), dtype="<u2").reshape(-1, parts).astype(np.int64)


def assign(rows: DataFrame, books: np.ndarray, near: list[Balls] | None) -> DataFrame:
    """``rows`` (vec_id, label, v, codes) with new codes (unsigned 16-bit indexes) and ``error``; without ``near``, by all entries."""
    parts = len(books)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _components(b, parts)
            own = _codes(b, parts) if near else None
            found = [nearest_in_ball(x[:, p], books[p], own[:, p], near[p]) if near else nearest_of_all(x[:, p], books[p]) for p in range(parts)]
            codes = np.stack([at for at, _ in found], axis=1).astype("<u2")
            error = np.sum([square for _, square in found], axis=0)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), b.column("label"), b.column("v"), pa.array([r.tobytes() for r in codes], pa.binary()), pa.array(error, pa.int64())],
                names=["vec_id", "label", "v", "codes", "error"],
            )

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    return rows.select("vec_id", "label", "v", "codes").mapInArrow(work, f"vec_id {kinds['vec_id']}, label {kinds['label']}, v array<int>, codes binary, error bigint")


def sums(rows: DataFrame, books: np.ndarray) -> list:
    """(part, entry, c, total, radius) of the assigned rows: component sums, and under c = -1 the count and the ball's squared radius.

    Each task adds up what it has and sends one row per part, entry and component.
    """
    parts, entries, width = books.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, radius = np.zeros((parts, entries, width + 1), dtype=np.int64), np.zeros((parts, entries), dtype=np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            x, own = _components(b, parts), _codes(b, parts)
            for p in range(parts):
                order = np.argsort(own[:, p], kind="stable")
                starts = np.r_[0, np.flatnonzero(np.diff(own[order, p])) + 1]
                entry, part = own[order[starts], p], x[order, p]
                total[p, entry, :width] += np.add.reduceat(part, starts, axis=0)
                total[p, entry, width] += np.diff(np.r_[starts, len(order)])
                away = ((part - books[p][own[order, p]]) ** 2).sum(axis=1)
                radius[p, entry] = np.maximum(radius[p, entry], np.maximum.reduceat(away, starts))
        p, e, c = np.nonzero(np.broadcast_to(total[:, :, width :] > 0, total.shape))
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in (p, e, c, total[p, e, c], radius[p, e])], names=["part", "entry", "c", "total", "radius"])

    each = rows.select("v", "codes").mapInArrow(work, "part bigint, entry bigint, c bigint, total bigint, radius bigint")
    return each.groupBy("part", "entry", "c").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.max("radius").alias("radius")).collect()


def updated(books: np.ndarray, found: list) -> tuple[np.ndarray, list[Balls]]:
    """The moved codebooks, and the balls round their entries; unused entries stay."""
    parts, entries, width = books.shape
    total = {(r["part"], r["entry"], r["c"]): int(r["total"]) for r in found}
    radius = {(r["part"], r["entry"]): int(r["radius"]) for r in found}
    new, near = books.copy(), []
    for p in range(parts):
        reach = []
        for e in range(entries):
            if count := total.get((p, e, width)):
                new[p, e] = [total[p, e, c] // count for c in range(width)]
            reach.append(moved_reach(radius.get((p, e), 0), int(((new[p, e] - books[p, e]) ** 2).sum())))
        near.append(balls(new[p], reach))
    return new, near


def digest(books: np.ndarray) -> str:
    """sha256 of all components by part, entry and position within the part."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def scaled(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v, size) of the rows whose vectors are whole and finite; ``v`` is null where a component leaves the grid."""
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda c: F.coalesce(F.abs(c) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(c))
    inside = F.forall(x, lambda c: F.abs(c) < GRID / scale)
    v = F.when(inside, F.transform(x, lambda c: F.floor(c * scale).cast("int")))
    return vectors.filter(F.col("embedding").isNotNull() & finite).select("vec_id", "label", v.alias("v"), F.size("embedding").alias("size"))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, codes, error) of each kept row, and the codebooks (parts, entries, components)."""
    spark = vectors.sparkSession
    found_by_workers(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    whole = scratch_table(scaled(vectors, scale), "vectors")
    usual = whole.filter(F.col("v").isNotNull() & (F.col("size") > 0) & (F.col("size") % parts == 0)).groupBy("size").count().orderBy(F.desc("count"), "size").first()
    fits = F.col("v").isNotNull() & (F.col("size") == (usual["size"] if usual else -1))
    rows = whole.filter(fits).select("vec_id", "label", "v", F.lit(None).cast("binary").alias("codes"))
    begin = [r["v"] for r in rows.filter("vec_id is not null").orderBy("vec_id", "v").limit(entries).collect()]
    others = whole.filter(~fits).select("vec_id", "label", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("bigint").alias("error"))
    if not begin:  # nothing to code by
        return others.union(rows.select("vec_id", "label", "codes", F.lit(None).cast("bigint"))), np.zeros((parts, 0, 0), dtype=np.int64)
    books = np.array(begin, dtype=np.int64).reshape(len(begin), parts, -1).transpose(1, 0, 2).copy()
    near = None
    for _ in range(rounds):
        rows = scratch_table(assign(rows, books, near), "vectors")
        books, near = updated(books, sums(rows, books))
    rows = scratch_table(assign(rows, books, near).drop("v"), "vectors")
    return rows.union(others), books


def op11(vectors: DataFrame) -> DataFrame:
    rows, books = compress(vectors)
    pairs = F.regexp_replace(F.hex("codes"), "(..)00", "$1")  # indexes are below 256: the second byte of each is zero
    rows = rows.select("vec_id", "label", F.lower(pairs).alias("code"), "error", F.coalesce(F.col("label").cast("string"), F.lit("")).alias("name"), F.col("label").isNull().alias("none"))
    labels = stored(rows.groupBy("name", "none").agg(F.sum("error").alias("label_error")))
    out = rows.join(labels, ["name", "none"])
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
