"""SimHash near-duplicates by covering locality-sensitive hashing.

Bit i of a fingerprint carries a vector m(i) of RADIUS + 1 bits; table v (any non-zero vector) keeps the bits whose m(i) has an odd
product with v.  Two fingerprints that differ in at most RADIUS bits involve at most RADIUS vectors, so some v is orthogonal to all
of them: the table of v ignores every differing bit, and the pair meets there.  No pair within the radius can be missed.

Equal fingerprints are one node.  Members of a bucket are checked exactly and leave as a spanning forest of their links, never
as all pairs.  A bucket of over ``SPLIT`` members passes its members on to a second covering over the bits that its table ignores;
there, members agree in all but ``second_level_free()`` bits, which bounds what one task can hold.

Defined cases: a text without words (null, empty, blanks) has fingerprint zero, linked like any other; fewer words than a shingle make one
shingle; repeated rows share a fingerprint; rows without id get a component from the others in theirs, null if none has an id;
no rows give no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from stratamart.llm.common import stored, texts
from stratamart.llm.components import components

BITS, RADIUS, SHINGLE, SEED = 64, 3, 3, 42
SPLIT = 4096
_BLOCK = 1 << 16


def masks(positions: list[int], radius: int = RADIUS) -> list[int]:
    """The covering masks over these bit positions."""
    top = 1 << (radius + 1)
    vectors = {p: 1 + i % (top - 1) for i, p in enumerate(positions)}
    return [sum(1 << p for p, m in vectors.items() if (m & v).bit_count() % 2) for v in range(1, top)]


FIRST = masks(list(range(BITS)))
SECOND = [masks([p for p in range(BITS) if not mask >> p & 1]) for mask in FIRST]


def second_level_free() -> int:
    """Bits in which members of one second-level bucket may differ, at most."""
    return max(BITS - mask.bit_count() - sub.bit_count() for mask, subs in zip(FIRST, SECOND) for sub in subs)


def fingerprint(text: str | None) -> int:
    words = (text or "").encode().lower().split()  # bytes: A-Z only are lowered, the six ASCII blanks split
    if not words:
        return 0
    ones, n = np.zeros(BITS, dtype=np.int64), max(1, len(words) - SHINGLE + 1)
    for at in range(0, n, _BLOCK):
        some = words[at : at + _BLOCK + SHINGLE - 1]
        shingles = map(b" ".join, zip(*(some[k:] for k in range(SHINGLE)))) if len(words) >= SHINGLE else [b" ".join(words)]
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp) of each row."""

    def prints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "text_hash": b["text_hash"], "fp": [fingerprint(t) for t in b["text"]]})

    rows = texts(docs, F.xxhash64("text").alias("text_hash"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(prints, f"doc_id {kind}, text_hash bigint, fp bigint")


def forest(values: np.ndarray, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links of a spanning forest over distinct fingerprints (uint64): pairs of indexes."""
    parent = np.arange(len(values))
    out: list[tuple[int, int]] = []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def visit(members: np.ndarray) -> None:
        part = values[members]
        if len(members) > 512:
            varying = int(np.bitwise_or.reduce(part ^ part[0]))
            for mask in masks([p for p in range(BITS) if varying >> p & 1], radius):
                keys = part & np.uint64(mask)
                order = np.argsort(keys, kind="stable")
                for run in np.split(order, np.flatnonzero(np.diff(keys[order])) + 1):
                    if len(run) > 1:
                        visit(members[run])
            return
        for i in range(len(part) - 1):
            for j in np.flatnonzero(np.bitwise_count(part[i + 1 :] ^ part[i]) <= radius) + i + 1:
                a, b = root(members[i]), root(members[j])
                if a != b:
                    parent[a] = b
                    out.append((int(members[i]), int(members[j])))

    if len(values) > 1:
        visit(np.arange(len(values)))
    return out


def _buckets(batches: Iterator[pd.DataFrame], keys: list[str], limit: int | None) -> Iterator[pd.DataFrame]:
    """Links within each run of equal keys of a sorted partition; members of runs beyond ``limit`` go out as they come.

    Output rows (a, b, k): a link has k = -1; a passed-on member a carries its table k.
    """
    held: list[pd.DataFrame] = []
    passing = None  # the key whose members are being passed on

    def passed(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"a": part["fp"], "b": part["fp"], "k": part["k"]})

    def links(part: pd.DataFrame) -> pd.DataFrame:
        a, b = [], []
        fps = part["fp"].to_numpy()
        cuts = np.flatnonzero((part[keys].to_numpy()[1:] != part[keys].to_numpy()[:-1]).any(axis=1)) + 1
        starts, ends = np.r_[0, cuts], np.r_[cuts, len(part)]
        many = ends - starts > 1
        for s, e in zip(starts[many], ends[many]):
            for i, j in forest(fps[s:e].astype("<i8").view("<u8")):
                a.append(fps[s + i])
                b.append(fps[s + j])
        return pd.DataFrame({"a": np.array(a, dtype="int64"), "b": np.array(b, dtype="int64"), "k": np.full(len(a), -1, dtype="int64")})

    for batch in batches:
        if not len(batch):
            continue
        rows = pd.concat([*held, batch], ignore_index=True) if held else batch.reset_index(drop=True)
        key = rows[keys].to_numpy()
        if passing is not None:
            same = (key == passing).all(axis=1)
            yield passed(rows[same])
            rows, key = rows[~same].reset_index(drop=True), key[~same]
            if not len(rows):
                held = []
                continue
            passing = None
        last = (key == key[-1]).all(axis=1)
        done, held = rows[~last], [rows[last]]
        if limit and len(done):
            sizes = done.groupby(keys, sort=False)["fp"].transform("size")
            yield passed(done[sizes > limit])
            done = done[sizes <= limit]
        if len(done):
            yield links(done)
        if limit and last.sum() > limit:
            yield passed(rows[last])
            passing, held = key[-1], []
    for rest in held:
        yield links(rest)


def links(fps: DataFrame, split: int = SPLIT) -> DataFrame:
    """(a, b): links that connect the same fingerprints as all pairs within the radius.  ``fps`` has distinct values of ``fp``."""
    signed = lambda m: m - (1 << BITS) if m >> (BITS - 1) else m
    first = F.explode(F.array(*[F.struct(F.lit(k).cast("bigint").alias("k"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("m")) for k, m in enumerate(FIRST)]))
    rows = fps.select(first.alias("x"), "fp").select("x.k", "x.m", "fp").repartition("k", "m").sortWithinPartitions("k", "m")
    found = stored(rows.mapInPandas(lambda it: _buckets(it, ["k", "m"], split), "a bigint, b bigint, k bigint"))
    subs = F.array(*[F.array(*[F.lit(signed(s)) for s in subs]) for subs in SECOND])
    large = found.filter("k >= 0").select("k", F.col("a").alias("fp"), F.element_at(subs, (F.col("k") + 1).cast("int")).alias("subs"))
    large = large.select("k", "fp", F.posexplode("subs").alias("j", "sub"))
    large = large.select("k", F.col("j").cast("bigint").alias("j"), F.col("fp").bitwiseAND(F.col("sub")).alias("s"), F.col("fp").bitwiseAND(
        F.element_at(F.array(*[F.lit(signed(m)) for m in FIRST]), (F.col("k") + 1).cast("int"))).alias("m"), "fp")
    keys = ["k", "m", "j", "s"]
    large = large.repartition(*keys).sortWithinPartitions(*keys)
    deeper = large.mapInPandas(lambda it: _buckets(it, keys, None), "a bigint, b bigint, k bigint")
    return found.filter("k < 0").union(deeper).select("a", "b")


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp, component_id) of each row."""
    rows = stored(fingerprints(docs))
    fps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    roots = components(links(fps)).withColumnRenamed("node", "fp")
    fps = stored(fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    ids = stored(fps.groupBy("root").agg(F.min("least_id").alias("component_id")))
    return rows.join(stored(fps.join(ids, "root").select("fp", "component_id", "root")), "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def one_per_group(docs: DataFrame, grouped: Callable[[DataFrame], DataFrame] = groups) -> DataFrame:
    """Of each component the row with the smallest id (then the smallest hash of its text), with all its columns.

    ``grouped`` gives (doc_id, text_hash, root) of each row.
    """
    key = lambda: [F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), "text_hash"]
    winners = stored(grouped(docs).groupBy("root").agg(F.min(F.struct(*key())).alias("w")).select("w.*"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", F.xxhash64("text").alias("text_hash")).select("row", *key())
    names = ["no_id", "id", "text_hash"]
    # Rows repeated in id and text share a key; one of them stays.
    kept = rows.join(winners, names).groupBy(*names).agg(F.first("row").alias("row"))
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def op6(docs: DataFrame) -> DataFrame:
    return groups(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
