"""Near-duplicates by exact Jaccard similarity of word shingles, found by prefix filtering.

Order all shingles in one way, whatever it is.  Two sets whose Jaccard similarity is at least 4/5 share a shingle among the first
n - ceil(4n/5) + 1 of either, so documents meet in these shingles and no pair is missed.  The order puts shingles that
are frequent in a sample last, so that common passages don't bring unrelated documents together; it changes the cost only.

First, most links are found cheaply.  Operator 6 links the sets' fingerprints by its covering masks: each set is compared with the least one of its fingerprint, and these with each other along
the forest of links.  Beside that, as near copies at this similarity often differ in more bits, each is compared, for each of ``ORDERS`` hashes, with one of those that have the same least hash:
another one for each hash, so that a large group of near copies holds together by many links.  Pairs that sizes or sketches (below) rule out are not compared.
Then only shingles that hold texts of different components matter, and only pairs of different components.  A pair goes where it meets if the sizes differ too much, if what comes
from the shingle on is too little in either text (their first common shingle leaves enough), or if their sketches differ in more bits than the sets may in shingles:
a sketch holds for each of its classes whether the set has an odd number of shingles in it, so each shingle that only one set has changes one bit.  All three bounds are exact.
There are ``SKETCH`` classes for a short text and more for longer ones, as unrelated sets would else fill all classes alike; they fold into fewer.  A pair that met in
one of the ``BEFORE`` shingles before goes too: it leaves from there or from before, so a pair leaves where it first meets and hardly again.
Each other pair is checked by the sets themselves.  So a large group of copies does not leave as all its pairs; texts that share a first shingle without being linked are
compared as numbers, and only those that all bounds leave are sent.

Words are those of operator 6.  Defined cases: texts without words are one group; fewer words than a shingle make one shingle; equal sets are one node; rows repeated or without id
get a component from the others in theirs; texts of any length are taken whole; no rows give no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from stratamart.llm import covering
from stratamart.llm.common import Memory, kept, released, scratch_table, stored, texts
from stratamart.llm.components import components

SHINGLE = 5
#: Similarity of near copies as a fraction, so that the check is exact.
TOP, BOTTOM = 4, 5
#: Documents whose shingles give the order, and shingles put last at most.
SAMPLE, FREQUENT = 20_000, 1 << 16
#: Rows up to which a counted table of numbers may be broadcast, and pairs of one text that a task checks together, on average.
BROADCAST_KEYS, PART = 500_000, 1024
#: Hashes that give each text likely partners.
ORDERS = 16
#: Bits of a set's sketch at least and at most.
SKETCH, FINEST = 512, 1 << 14
#: Shingles before a common one, in either text, that are looked at for an earlier common one.
BEFORE = 2
_FACTORS = [0x9E3779B97F4A7C15 * (2 * k + 1) * (2 * k + 3) % 2**64 | 1 for k in range(ORDERS)]


class WordHashes(Memory):
    def make(self, word: bytes) -> int:
        return xxhash.xxh64_intdigest(word)


def shingles(text: str | None, memory: WordHashes) -> np.ndarray:
    """The distinct shingles of a text as sorted hashes."""
    words = (text or "").encode().lower().split()
    memory.renew()
    hashes = np.fromiter(map(memory.__getitem__, words), dtype=np.uint64, count=len(words))
    length = min(SHINGLE, len(words))
    n, factor = len(words) - length + 1 if length else 0, np.uint64(0x9E3779B97F4A7C15)
    h = np.full(n, length, dtype=np.uint64)
    for j in range(length):
        h = (h ^ hashes[j : j + n]) * factor
        h ^= h >> np.uint64(29)
    return np.unique(h.view(np.int64))


def prefix_length(n: int) -> int:
    return n + (-TOP * n) // BOTTOM + 1 if n else 0


def prefix(found: np.ndarray, last: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The first shingles of a set: those not in ``last`` (sorted), then those of the least weight."""
    k = prefix_length(len(found))
    if not len(last):
        return found[:k]
    at = np.minimum(np.searchsorted(last, found), len(last) - 1)
    return found[np.lexsort((found, np.where(last[at] == found, weight[at], 0)))[:k]]


def _sets(docs: DataFrame) -> DataFrame:
    """(text_hash, shingles) of each row of (doc_id, text)."""

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory = kept("shingle words", WordHashes)
        for b in batches:
            yield pd.DataFrame({"text_hash": b["text_hash"], "shingles": [shingles(t, memory) for t in b["text"]]})

    return texts(docs, F.xxhash64("text").alias("text_hash")).mapInPandas(make, "text_hash bigint, shingles array<bigint>")


def frequent(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Shingles met more than once in the sample, sorted, and how often."""
    share = max(1, docs.count() // SAMPLE)
    some = _sets(docs.filter(F.pmod(F.xxhash64(F.xxhash64("text"), F.lit(1)), F.lit(share)) == 0))
    counts = stored(some.select(F.explode("shingles").alias("s")).groupBy("s").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    # From how often on: a sort's limit would bring that many rows of each part to the driver.
    least, left = 0, FREQUENT
    for n, many in counts.groupBy("n").count().orderBy(F.desc("n")).collect():
        if many > left:
            # Of those met equally often about as many as are left, by hash.
            least = n
            equal = F.pmod(F.xxhash64("s"), F.lit(many)) < left
            break
        left -= many
    taken = counts if not least else counts.filter((F.col("n") > least) | ((F.col("n") == least) & equal))
    top = taken.toArrow().sort_by("s")
    return top["s"].to_numpy(), top["n"].to_numpy()


def fingerprint(found: np.ndarray) -> int:
    """Operator 6's fingerprint of a set of shingles: the bits set in over half of their hashes; zero without any."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(found), 1 << 16):
        ones += np.unpackbits(found[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(found), bitorder="little").view("<i8")[0])


def least_hashes(found: np.ndarray) -> list[int]:
    """The least shingle by each of ``ORDERS`` hashes."""
    return [int((found.view(np.uint64) * np.uint64(k)).min().view(np.int64)) for k in _FACTORS] if len(found) else [0] * ORDERS


def sketch_bits(n: int) -> int:
    """Bits of the sketch of a set of n shingles: a power of two; sets similar in size have equal ones or one twice the other."""
    return min(FINEST, max(SKETCH if n <= SKETCH // 2 else 2 * SKETCH, 1 << (max(n - 1, 1) // 2).bit_length()))


def sketch(found: np.ndarray) -> list[int]:
    """For each class of shingles whether their number is odd, as longs."""
    bits = sketch_bits(len(found))
    odd = np.bincount((found.view(np.uint64) * np.uint64(_FACTORS[0]) >> np.uint64(40)).astype(np.int64) % bits, minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8").tolist()


def prefixes(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, node, n, keys, fp, least, sketch) of each row: the set's hash and size, its first shingles in order, its fingerprint, least hashes and sketch."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent(docs))

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory = kept("shingle words", WordHashes)
        for b in batches:
            found = [shingles(t, memory) for t in b["text"]]
            nodes = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in found], dtype=np.uint64).view(np.int64)
            yield pd.DataFrame({
                "doc_id": b["doc_id"], "text_hash": b["text_hash"], "node": nodes, "n": np.array([len(s) for s in found], dtype=np.int64),
                "keys": [prefix(s, *shared.value) for s in found],
                "fp": np.array([fingerprint(s) for s in found], dtype=np.int64), "least": [least_hashes(s) for s in found],
                "sketch": [sketch(s) for s in found],
            })

    rows = texts(docs, F.xxhash64("text").alias("text_hash"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(make, f"doc_id {kind}, text_hash bigint, node bigint, n bigint, keys array<bigint>, fp bigint, least array<bigint>, sketch array<bigint>")


def _small(df: DataFrame, times: int = 1) -> DataFrame:
    """A stored table to be broadcast if it is counted to be small; ``times`` more rows may be of one number each."""
    return F.broadcast(df) if df.count() <= BROADCAST_KEYS * times else df


def checked(docs: DataFrame, rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """The links among stored candidate pairs (a, b) of nodes, by their whole sets."""
    # Each b's text goes to its a; the pairs of an a with many are dealt over parts, and its own text goes to each of them first.
    parts = stored(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PART).alias("parts")))
    seconds = pairs.join(parts, "a").select("a", F.expr("pmod(xxhash64(b), parts)").alias("part"), F.lit(True).alias("second"), F.col("b").alias("node"))
    heads = parts.select("a", F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"), F.lit(False).alias("second"), F.col("a").alias("node"))
    asked = stored(seconds.union(heads))
    one = rows.select("node", "doc_id", "text_hash").join(_small(stored(asked.select("node").distinct())), "node", "left_semi")
    one = one.groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("one")).select("node", "one.*")
    wanted = _small(stored(asked.join(one, "node")))
    d = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    same = d["doc_id"].eqNullSafe(wanted["doc_id"]) & (d["text_hash"] == wanted["text_hash"])
    order = ["a", "part", "second", "node"]
    sent = d.join(wanted, same).select(*order, "text").repartition("a", "part").sortWithinPartitions(*order)

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory, head = kept("shingle words", WordHashes), None
        for b in batches:
            out = []
            for a, second, node, text in zip(b["a"], b["second"], b["node"], b["text"]):
                found = shingles(text, memory)
                if not second:
                    head = found
                else:
                    both = len(np.intersect1d(head, found, assume_unique=True))
                    if (TOP + BOTTOM) * both >= TOP * (len(head) + len(found)):
                        out.append((a, node))
            yield pd.DataFrame(np.array(out, dtype=np.int64).reshape(-1, 2), columns=["a", "b"])

    return stored(sent.mapInPandas(check, "a bigint, b bigint"))


def covering_pairs(once: DataFrame) -> DataFrame:
    """(a, b): each set beside the least one of its fingerprint, and these along operator 6's links between fingerprints."""
    heads = stored(once.groupBy("fp").agg(F.min("node").alias("head")))
    same = once.select("node", "fp").join(heads, "fp").filter("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b"))
    met = covering.links(heads.select("fp"))
    for x in "ab":
        met = met.join(heads.select(F.col("fp").alias(x), F.col("head").alias(f"head_{x}")), x)
    return same.union(met.select(F.least("head_a", "head_b").alias("a"), F.greatest("head_a", "head_b").alias("b")))


def likely_pairs(once: DataFrame) -> DataFrame:
    """(a, b): each node beside one of the nodes with which it shares a least hash, for each hash another."""
    each = once.select("node", F.posexplode("least").alias("k", "m"))
    heads = each.groupBy("k", "m").agg(F.min(F.struct(F.xxhash64("node", "k").alias("h"), F.col("node").alias("a"))).alias("head"), F.count(F.lit(1)).alias("members"))
    heads = stored(heads.filter("members > 1").select("k", "m", "head.a"))
    return each.join(heads, ["k", "m"]).filter("node <> a").select("a", F.col("node").alias("b"))


_WORDS = [f"s{k}" for k in range(SKETCH // 64)]
#: Bits that differ between the finer sketches of a pair; the longer one is folded, as similar sizes give at most twice the other's bits.
_FINE = """aggregate(zip_with(
    CASE WHEN size(fine_a) > size(fine_b) THEN zip_with(slice(fine_a, 1, size(fine_b)), slice(fine_a, size(fine_b) + 1, size(fine_b)), (x, y) -> x ^ y) ELSE fine_a END,
    CASE WHEN size(fine_b) > size(fine_a) THEN zip_with(slice(fine_b, 1, size(fine_a)), slice(fine_b, size(fine_a) + 1, size(fine_a)), (x, y) -> x ^ y) ELSE fine_b END,
    (x, y) -> bit_count(x ^ y)), 0, (sum, x) -> sum + x)"""


def _may_link() -> Column:
    """Whether sizes and sketches of a pair, as columns n_a, n_b, s0_a and so on, leave it similar enough."""
    both = F.col("n_a") + F.col("n_b")
    fits = (BOTTOM * F.col("n_a") >= TOP * F.col("n_b")) & (BOTTOM * F.col("n_b") >= TOP * F.col("n_a"))
    # Similar sets differ in at most (BOTTOM - TOP) / (BOTTOM + TOP) of both sizes together.
    close = lambda differ: (BOTTOM + TOP) * differ <= (BOTTOM - TOP) * both
    fine = F.col("fine_a").isNull() | F.col("fine_b").isNull() | close(F.expr(_FINE))
    return fits & close(sum(F.bit_count(F.col(f"{w}_a").bitwiseXOR(F.col(f"{w}_b"))) for w in _WORDS)) & fine


def sketches(once: DataFrame) -> DataFrame:
    """(node, n, s0 and so on, fine) of each set: its sketch folded into ``SKETCH`` bits, and as it is if it has more."""
    size = len(_WORDS)
    folded = [F.expr(f"aggregate(filter(sketch, (x, i) -> i % {size} = {k}), 0L, (all, x) -> all ^ x)").alias(w) for k, w in enumerate(_WORDS)]
    return stored(once.select("node", "n", *folded, F.when(F.size("sketch") > size, F.col("sketch")).alias("fine")))


def bounded(pairs: DataFrame, sketched: DataFrame) -> DataFrame:
    """The pairs whose sizes and sketches leave them similar enough."""
    pairs = stored(pairs.distinct())
    for x in "ab":
        pairs = pairs.join(sketched.select(F.col("node").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in ("n", *_WORDS, "fine")]), x)
    return pairs.filter(_may_link()).select("a", "b")


def pairs_apart(once: DataFrame, roots: DataFrame, sketched: DataFrame) -> DataFrame:
    """(a, b): pairs of nodes of different components that the bounds leave."""
    rooted = once.select("node", "keys").join(_small(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))
    # The shingles before each one, null where there are none.
    before = [f"p{k}" for k in range(1, BEFORE + 1)]
    keyed = rooted.select("node", "root", "keys", F.posexplode("keys").alias("at", "key"))
    keyed = keyed.select("node", "root", "at", "key", *[F.get("keys", F.col("at") - k).alias(p) for k, p in enumerate(before, 1)])
    apart = stored(keyed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("key"))
    met = keyed.join(_small(apart, 4), "key").join(_small(sketched), "node")
    kept = ["n", "root", "at", *before, *_WORDS, "fine"]
    a, b = (met.select("key", F.col("node").alias(x), *[F.col(c).alias(f"{c}_{x}") for c in kept]) for x in "ab")
    # Where the first common shingle is met, all that is common lies from there on.
    enough = (TOP + BOTTOM) * F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) >= TOP * (F.col("n_a") + F.col("n_b"))
    # A shingle before that both have is met as well, with more left from there on and the same other bounds.
    earlier = F.lit(False)
    for p in before:
        for q in before:
            earlier = earlier | F.coalesce(F.col(f"{p}_a") == F.col(f"{q}_b"), F.lit(False))
    met = (a["key"] == b["key"]) & (F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b")) & enough & ~earlier & _may_link()
    return a.join(b, met).select("a", "b").distinct()


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, root) of each row."""
    spark = docs.sparkSession
    rows = scratch_table(prefixes(docs), "prefixes")
    # One row stands for all that have its set, however many.
    once = scratch_table(rows.select("node", "n", "keys", "fp", "least", "sketch").dropDuplicates(["node"]), "sets")
    sketched = sketches(once)
    first = checked(docs, rows, stored(bounded(covering_pairs(once).union(likely_pairs(once)), sketched)))
    released(spark)
    roots = stored(components(first))
    rest = checked(docs, rows, stored(pairs_apart(once, roots, sketched)))
    released(spark)
    roots = stored(components(first.union(rest)))
    return rows.select("doc_id", "text_hash", "node").join(roots, "node", "left").select("doc_id", "text_hash", F.coalesce("root", "node").alias("root"))
