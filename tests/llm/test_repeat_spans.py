"""Repeated spans against a set of all strings of 100 bytes."""

import hashlib
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from stratamart.llm import repeat_spans
from stratamart.llm.common import table


def brute_force(documents):
    """``documents`` in corpus order."""
    seen, out = set(), []
    for i, text in documents:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - 99):
            s = b[k : k + 100]
            if s in seen:
                gone[k : k + 100] = b"\1" * 100
            else:
                seen.add(s)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def in_order(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text", F.xxhash64("text").alias("h")).orderBy("doc_id", "h").collect()]


def odd_documents():
    """A passage in parts, whole copies, runs and periods, no id, one id for many, null and empty texts."""
    pick = random.Random(3)
    words = [f"w{pick.randint(0, 300)}" for _ in range(400)]
    passage = " ".join(pick.choice(words) for _ in range(60))
    out = []
    for i in range(300):
        text, kind = " ".join(pick.choice(words) for _ in range(pick.randint(0, 80))), pick.random()
        if kind < 0.3:
            at = pick.randint(0, len(passage) // 2)
            text = f"{text} {passage[at : at + pick.randint(50, 300)]} {text[:150]}"
        elif kind < 0.4:
            text = "a" * pick.randint(90, 700)
        elif kind < 0.5:
            text = "ab é" * pick.randint(10, 120)
        elif kind < 0.55:
            text += "\x00" * pick.randint(0, 300)
        elif kind < 0.65:
            text = passage
        out.append((i if pick.random() > 0.1 else None, text))
    return [*out, (7, out[3][1]), (7, out[3][1]), (8, None), (9, ""), (10, "x" * 99), (11, "x" * 100), (12, "x" * 101)]


def answer(df, **options):
    found = repeat_spans.removals(df, lambda kept: hashlib.sha256(kept).hexdigest(), "string", **options).collect()
    return sorted([(r["doc_id"], r["n_bytes"], sum(s["end"] - s["begin"] for s in r["spans"]), len(r["spans"]), r["kept"]) for r in found], key=str)


@pytest.mark.parametrize("frequent,run,block", [(64, 1 << 14, 1 << 21), (2, 1 << 14, 3000), (2, 40, 3000), (64, 40, 20_000)])
def test_odd_texts_equal_brute_force(spark, monkeypatch, frequent, run, block):
    monkeypatch.setattr(repeat_spans, "RUN", run)
    monkeypatch.setattr(repeat_spans, "BLOCK", block)
    df = spark.createDataFrame(odd_documents(), "doc_id bigint, text string").repartition(5)
    assert answer(df, frequent=frequent) == brute_force(in_order(df))


def test_supplied_documents_equal_brute_force(spark, small):
    df = table(spark, small, "documents")
    got = repeat_spans.op12(df)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    want = brute_force(in_order(df))
    assert rows(got) == want and sum(w[2] for w in want) > 0


def test_a_long_text_is_parsed_in_segments(spark, monkeypatch):
    monkeypatch.setattr(repeat_spans, "SEGMENT", 1000)
    pick = random.Random(8)
    text = " ".join(f"{pick.randint(0, 10**9)}" for _ in range(3000))
    documents = [(1, text + text[500:2500] + "é" * 300), (2, "start " + text[10_000:12_000] + " end")]
    df = spark.createDataFrame(documents, "doc_id bigint, text string")
    assert answer(df) == brute_force(documents)


def test_what_is_left_and_the_spans_make_the_text(spark):
    df = spark.createDataFrame(odd_documents()[:80], "doc_id bigint, text string").filter("doc_id is not null").dropDuplicates(["doc_id"])
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in df.collect()}
    for r in repeat_spans.cleaned(df).collect():
        text, left, at = texts[r["doc_id"]], b"", 0
        for s in r["spans"]:
            left += text[at : s["begin"]]
            at = s["end"]
        assert left + text[at:] == bytes(r["kept"])


def test_no_rows_and_clashing_columns(spark):
    assert repeat_spans.op12(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    df = spark.createDataFrame([(1, "y" * 300, 3, "x"), (2, "y" * 120, 4, "z")], "doc_id bigint, text string, row int, text_hash string")
    assert [r[2] for r in rows(repeat_spans.op12(df))] == [299, 120]


def test_equal_strings_stand_before_equal_triggers():
    pick = np.random.default_rng(4)
    common = pick.integers(97, 105, 400, dtype=np.uint8)
    a, b = (np.r_[pick.integers(97, 123, n, dtype=np.uint8), common, pick.integers(97, 123, 200, dtype=np.uint8)] for n in (37, 311))
    first, second = repeat_spans.triggers(a), repeat_spans.triggers(b)
    assert (first[37 : 37 + 301] - 37 == second[311 : 311 + 301] - 311).all()
    starts = np.arange(len(first))
    assert ((first >= starts) & (first <= starts + repeat_spans.REACH)).all()
