"""Long blocks and partition borders of transcripts against a line by line Viterbi and one partition."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratamart.llm import transcripts


def model():
    emit = {s: np.r_[np.log(p), transcripts.NEVER] for s, p in {"text": (0.6, 0.1, 0.3), "list": (0.2, 0.2, 0.6), "code": (0.7, 0.2, 0.1), "empty": (0.3, 0.4, 0.3)}.items()}
    turn = np.full((4, 4), transcripts.NEVER)
    turn[:, :3] = np.log([[0.1, 0.1, 0.8], [0.3, 0.1, 0.6], [0.8, 0.1, 0.1], [0.2, 0.3, 0.5]])
    marker = np.r_[-15.0, -15.0, 0.0, transcripts.NEVER]
    return transcripts.Model(("assistant", "system", "user"), turn, emit, np.r_[np.zeros(3), transcripts.NEVER], {"user": marker})


def line_by_line(m, marker, lines):
    first, *rest = transcripts.symbols(marker, lines)
    out = m.turn + m.emission(first)
    inside = np.full((4, 4), np.log((1 - transcripts.STAY) / 2))
    np.fill_diagonal(inside, np.log(transcripts.STAY))
    inside[3, :] = inside[:, 3] = transcripts.NEVER
    for s in rest:
        step = inside + m.emission(s)
        out = np.array([[max(out[i, k] + step[k, j] for k in range(4)) for j in range(4)] for i in range(4)])
    return out


@pytest.mark.parametrize("n", [1, 2, 40, 64, 65, 66, 300])
def test_blocks_of_every_length_follow_one_rule(n):
    pick = random.Random(n)
    shapes = ["words", "- item", "    code", ""]
    mixed = [x for _ in range(n) for x in [pick.choice(shapes)] * pick.randint(1, 5)][:n]
    for lines in (["words"] * n, mixed, sorted(mixed)):
        got, want = model().step("user", ["head", *lines]), line_by_line(model(), "user", ["head", *lines])
        assert np.allclose(got[:, :3], want[:, :3])


def test_turns_across_partitions_are_counted(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    one = table.select(F.lit(1).cast("bigint").alias("conv_id"), (F.col("conv_id") * 100 + F.col("turn")).alias("turn"), "role", "text")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    found = []
    for parts in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        found.append([transcripts.train(transcripts._sorted(x)).turn for x in (one, table)])
    for k, v in kept.items():
        spark.conf.set(k, v)
    for a, b in zip(*found):
        assert np.allclose(a, b)
