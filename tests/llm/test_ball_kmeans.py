"""Vector codes against brute-force k-means over whole numbers."""

import hashlib
import random

import numpy as np
import pytest
from conftest import rows

from stratamart.llm import ball_kmeans
from stratamart.llm.common import table
from stratamart.llm.sql import STATEMENTS


def brute_force(vectors, parts=16, entries=64, rounds=2):
    kept = [(i, label, np.floor(256 * np.array(e, dtype=np.float64)).astype(int)) for i, e, label in vectors
            if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    first = sorted([k for k in kept if k[0] is not None], key=lambda k: (k[0], k[2].tolist()))[:entries]
    book = np.array([k[2].reshape(parts, -1) for k in first]).transpose(1, 0, 2).copy()
    x = np.array([k[2].reshape(parts, -1) for k in kept])

    def nearest():
        square = ((x[:, :, None, :] - book[None]) ** 2).sum(-1)
        return square.argmin(-1), square.min(-1).sum(-1)

    for _ in range(rounds):
        at, _ = nearest()
        for p in range(parts):
            for e in range(book.shape[1]):
                members = x[at[:, p] == e, p]
                if len(members):
                    book[p, e] = np.floor_divide(members.sum(0), len(members))
    at, error = nearest()
    by_label = {}
    for (_, label, _), n in zip(kept, error):
        by_label[label] = by_label.get(label, 0) + int(n)
    sha = hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()
    return sorted([(i, "".join(f"{c:02x}" for c in a), int(n), by_label[label], sha) for (i, label, _), a, n in zip(kept, at, error)], key=str)


def odd_vectors(n=500):
    """Ties (few different components), copies, repeated and missing ids, null and broken vectors, one label for most."""
    pick = random.Random(5)
    out = []
    for i in range(n):
        v = [pick.choice([-0.5, -0.25, 0.0, 0.001, 0.25, 1.0, pick.uniform(-2, 2)]) for _ in range(64)]
        if i % 50 == 0:
            v = None
        elif i % 41 == 0:
            v[i % 64] = [None, float("nan"), float("inf"), float("-inf")][i % 4]
        elif i % 7 == 0 and i > 20:
            v = out[10][1]
        out.append((None if i % 90 == 3 else i // 2 if i % 33 == 0 else i, v, None if i % 10 == 0 else 1 if i % 3 else i % 5))
    return out


SCHEMA = "vec_id bigint, embedding array<double>, label int"


def test_codes_equal_brute_force(spark):
    vectors = odd_vectors()
    got = ball_kmeans.op11(spark.createDataFrame(vectors, SCHEMA).repartition(5))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert rows(got) == brute_force(vectors)


def test_supplied_vectors_equal_brute_force_and_sql(spark, small):
    import duckdb

    df = table(spark, small, "embeddings")
    want = brute_force([tuple(r) for r in df.select("vec_id", "embedding", "label").collect()])
    assert rows(ball_kmeans.op11(df)) == want
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '{small}/embeddings.parquet'")
    assert sorted(duckdb.sql(STATEMENTS["op11_ball_kmeans"]).fetchall(), key=str) == want


def test_balls_restrict_candidates_and_miss_none():
    pick = np.random.default_rng(3)
    skipped = 0
    for width in (1, 4, 9):
        book = pick.integers(-30, 30, (40, width))
        book[7] = book[3]  # equal entries: the lower index wins
        x = pick.integers(-40, 40, (3000, width))
        own, _ = ball_kmeans.nearest_of_all(x, book)
        moved = book + pick.integers(-2, 3, book.shape)
        radius = [int(((x[own == e] - book[e]) ** 2).sum(1).max(initial=0)) for e in range(40)]
        reach = [ball_kmeans.moved_reach(r, int(((m - b) ** 2).sum())) for r, m, b in zip(radius, moved, book)]
        for e in range(40):
            assert ((x[own == e] - moved[e]) ** 2).sum(1).max(initial=0) <= reach[e]
        near = ball_kmeans.balls(moved, reach)
        got, want = ball_kmeans.nearest_in_ball(x, moved, own, near), ball_kmeans.nearest_of_all(x, moved)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
        skipped += 40 * 39 - len(near.other)
    assert skipped > 0


def test_few_no_and_odd_rows(spark):
    frame = lambda r: spark.createDataFrame(r, SCHEMA)
    assert ball_kmeans.op11(frame([])).count() == 0
    assert ball_kmeans.op11(frame([(1, None, 1), (2, [None] * 64, 1)])).count() == 0
    one = ball_kmeans.op11(frame([(1, [0.5] * 64, None)])).first()
    assert (one["code"], one["error"], one["label_error"]) == ("00" * 16, 0, 0)
    no_ids = ball_kmeans.op11(frame([(None, [0.5] * 64, None)])).first()  # nothing to code by
    assert (no_ids["code"], no_ids["error"]) == (None, None)
    mixed = rows(ball_kmeans.op11(frame([(1, [0.5] * 64, 1), (2, [0.25] * 64, 1), (3, [0.5] * 7, 1), (4, [1e30] * 64, 2), (5, [], 1)])))
    assert [(r[0], r[1] is None, r[2]) for r in mixed] == [(1, False, 0), (2, False, 0), (3, True, None), (4, True, None), (5, True, None)]


def test_general_form_and_clashing_columns(spark):
    vectors = [(i, [float(i % 3), float(i % 5), i / 7, -i / 9], i % 2, "x", i) for i in range(60)]
    df = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>, label int, codes string, error int")
    out, books = ball_kmeans.compress(df, parts=2, entries=5, rounds=3, scale=16)
    assert books.shape == (2, 5, 2) and out.count() == 60 and out.columns == ["vec_id", "label", "codes", "error"]
    assert ball_kmeans.op11(df.withColumn("name", df.codes)).count() == 60


@pytest.mark.parametrize("copies", [1, 7])
def test_sums_are_exact_whatever_the_partitions(spark, copies):
    vectors = odd_vectors(80) * copies
    a = ball_kmeans.op11(spark.createDataFrame(vectors, SCHEMA).repartition(1))
    b = ball_kmeans.op11(spark.createDataFrame(vectors[::-1], SCHEMA).repartition(9))
    assert rows(a) == rows(b)
