"""Operators without user functions, against SQL and plain Python."""

import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from stratamart.llm import mixing, quality_rules, secret_scan, sql
from stratamart.llm.common import fold, running_totals

CASES = "doc_id bigint, text string, lang string, source string, n_words bigint, kept string"


@pytest.fixture(scope="module")
def docs(spark):
    long = "the cat sat on the mat and of to in a is it " * 40
    rows = [
        (1, None, "en", "b", 1, "x"), (2, "", "en", "b", 1, "x"), (3, " \t\n ", "en", None, 1, "x"), (4, long, "en", "a", 1, "x"),
        (5, "x\n" * 300, "en", "a", 1, "x"), (5, "x\n" * 300, "en", "a", 1, "x"), (None, "one two three", "en", "a", 1, "x"),
        (6, " ".join(f"the w{i} of" for i in range(200)), "en", None, 1, "x"), (7, "é ü 中 文 # $ % " * 30, None, "", 1, "x"),
        (8, " ".join(f"w{i}" for i in range(20_000)), "en", "a", 1, "x"), (9, "a b c a b c d", "en", "b", 1, "x"), (10, "q r s t", "en", "c", 1, "x"),
    ]
    return spark.createDataFrame(rows, CASES)


def by_sql(docs, statement):
    con = duckdb.connect()
    con.register("frame", docs.toPandas())
    con.execute("CREATE TABLE documents AS SELECT doc_id::BIGINT AS doc_id, text::VARCHAR AS text, source::VARCHAR AS source FROM frame")
    return sorted(map(str, con.execute(statement).fetchall()))


def test_quality_rules_and_mix_equal_sql_on_odd_rows(docs):
    for statement, made in ((sql.OP3, quality_rules.op3(docs)), (sql.OP10, mixing.op10(docs))):
        assert sorted(str(tuple(r)) for r in made.collect()) == by_sql(docs, statement)


def test_quality_rules_against_plain_python(docs):
    for r in quality_rules.op3(docs.filter("text is not null")).join(docs.select("doc_id", "text"), "doc_id").collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r["text"])
        windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        hit = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(3)} if len(w) < 3000 else set()
        lines = [x for x in r["text"].split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r["n_words"], r["word_chars"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(hit))


def test_keep_good_keeps_columns_that_share_names_with_measures(docs):
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert {(r["doc_id"], r["n_words"], r["kept"]) for r in kept.collect()} == {(6, 1, "x")}


def test_empty_tables(spark, docs):
    none = docs.filter("false")
    assert quality_rules.op3(none).count() == mixing.op10(none).count() == secret_scan.op5(none).count() == 0
    assert mixing.mixed(none).columns == docs.columns and mixing.mixed(none).count() == 0


def test_mixed_texts_hold_the_words_that_the_plan_takes(docs):
    plan = {}
    for r in mixing.op10(docs).collect():
        plan[r["doc_id"]] = plan.get(r["doc_id"], 0) + r["taken"]
        assert r["taken"] <= 3 * r["size"]
    out = {}
    for r in mixing.mixed(docs).collect():
        out[r["doc_id"]] = out.get(r["doc_id"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    assert {k: v for k, v in out.items() if v} == {k: v for k, v in plan.items() if v}


def test_running_totals_spread_over_partitions(spark):
    rows = spark.range(1000).select((F.col("id") % 3 > 0).alias("g"), F.md5(F.col("id").cast("string").cast("binary")).alias("k"), F.col("id").alias("v"))
    got = running_totals(rows, ["g"], ["k"], {"before": "v"}).collect()
    total = {}
    for r in sorted(got, key=lambda r: (r["g"], r["k"])):
        assert r["before"] == total.get(r["g"], 0)
        total[r["g"]] = r["before"] + r["v"]


def test_fold_is_crc32_of_the_id_as_text(spark):
    import zlib

    rows = spark.range(50).select("id", fold(F.col("id"), 3).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 3 for r in rows)


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def test_secret_spans_against_plain_python(spark):
    import random

    pick = random.Random(3)
    bits = ["token", "secret: ", "=", "'", '"', " ", "abc", "PASSWORD", "api_key:", "apikey", "AKIA", "ABCDEFGH01234567", "0123456789abcdef", "é", "👍", "-", "ſecret="]
    texts = ["".join(pick.choice(bits) for _ in range(pick.randint(0, 14))) for _ in range(400)]
    texts += ["token: token: abcdefgh", "secret=token=abcdef", "x" * 50_000 + " token=abcdef1", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in secret_scan.op5(rows).collect():
        want = base(texts[r["doc_id"]] or "")
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert [s for s in r["spans"].split(",") if s and not s.startswith("markov")] == [s for s in want.split(",") if s]


def test_markov_models_find_random_strings_and_leave_identifiers(spark):
    import random

    pick = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    names = ["customer", "order", "payment", "history", "connection", "manager", "account", "service", "request", "handler", "update", "factory"]
    rows = [(i, f"api_key = {''.join(pick.choices(letters, k=32))} then " + " ".join("_".join(pick.choices(names, k=4)) for _ in range(6))) for i in range(200)]
    model = secret_scan.train(spark.createDataFrame(rows, "doc_id bigint, text string"))
    probe = [(0, "key " + "".join(pick.choices(letters, k=40))), (1, "payment_history_request_handler_factory"), (2, "customer_account_service_manager_update")]
    found = {r["doc_id"]: len(r["markov"]) for r in secret_scan.scan(spark.createDataFrame(probe, "doc_id bigint, text string"), model).collect()}
    assert found == {0: 1, 1: 0, 2: 0}


def test_recall_and_false_alarms_by_length_on_supplied_texts(spark):
    """Random strings outside every pattern, hidden in supplied texts whose words are the identifiers."""
    import random

    pick = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = secret_scan.train(table)
    texts = [r["text"] for r in table.filter("text is not null").orderBy("doc_id").limit(300).collect()]
    hidden, rows = {}, []
    for i, t in enumerate(texts):
        length = (10, 14, 18, 26, 40)[i % 5]
        key = "".join(pick.choices(letters, k=length))
        rows.append((i, f"{t}\nthe key {key} is new"))
        hidden[i] = (length, len(t) + 9)
    got = secret_scan.scan(spark.createDataFrame(rows, "doc_id bigint, text string"), model).select("doc_id", "markov").collect()
    hit, all_, alarms = {}, {}, 0
    for r in got:
        length, at = hidden[r["doc_id"]]
        starts = [s["start"] for s in r["markov"]]
        all_[length] = all_.get(length, 0) + 1
        hit[length] = hit.get(length, 0) + (at in starts)
        alarms += sum(s != at for s in starts)
    recall = {k: hit[k] / all_[k] for k in sorted(all_)}
    print(recall, alarms)
    assert min(recall[k] for k in (18, 26, 40)) > 0.9 and recall[14] > 0.5 and alarms <= 30


def test_a_sample_of_any_share_is_picked(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    few = secret_scan.samples(table, 1).select("value").count()
    assert few <= secret_scan.samples(table, 10**9).count()


def test_models_count_every_row(spark):
    """One of 40,000 rows holds the only random string; a sample of 20,000 by the hash of the text did not have it."""
    text = F.concat(F.lit("customer_history_"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij"))
    rows = spark.range(40_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 20_011, "token=Zq9XvK2mPw7").otherwise(text).alias("text"))
    assert secret_scan.train(rows) is not None
    assert secret_scan.labelled(secret_scan.found(rows)).count() == 40_000
