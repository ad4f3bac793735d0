"""Operators against brute force and hand-made rows."""

import datetime as dt
import decimal
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stratamart.functions import columns as C
from stratamart.operators import cohorts, merge, paths, ranking, windows, zipper
from stratamart.plans import product_360, shop_ads

DAY = dt.date(2024, 1, 30)


def one(spark, expr, **values):
    names = ", ".join(values)
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return df.select(expr).first()[0], names


def test_masks(spark):
    df = spark.createDataFrame([("Ann", "13812345678", "a_b@x.org"), ("B", "99812345678", "nomail"), (None, None, None)], "n string, p string, e string")
    got = df.select(C.mask_name("n"), C.mask_mobile("p"), C.mask_email("e"), C.hash_mobile("p")).collect()
    assert tuple(got[0])[:3] == ("A*", "138*", "*@x.org") and got[0][3] is not None
    assert tuple(got[1]) == ("B*", None, None, None)
    assert tuple(got[2]) == (None, None, None, None)


def test_hash_buckets(spark):
    import hashlib

    keys = [f"k{i}" for i in range(50)]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    got = {r[0]: (r[1], r[2]) for r in df.select("k", C.hash_bucket("k", 16), C.hash_bucket_reserved("k", 16, ["k7", "k9"])).collect()}
    for k in keys:
        want = f"{int(hashlib.md5(k.encode()).hexdigest()[-3:], 16) % 16:04d}"
        assert got[k][0] == want
        assert got[k][1] == {"k7": "9001", "k9": "9002"}.get(k, want)


def test_text_helpers(spark):
    df = spark.createDataFrame([("0x" + "a" * 64 + "b" * 64, '["x"]', "y", "0x0de0b6b3a7640000", "12.5")], "h string, l string, e string, wei string, d string")
    row = df.select(C.fixed_words("h"), C.append_to_json_list("l", "e"), C.amount_from_text("wei", True), C.amount_from_text("d")).first()
    assert row[0] == ["a" * 64, "b" * 64] and row[1] == '["x","y"]'
    assert row[2] == "1" and row[3] == "12.5"
    days = spark.range(1).select(C.day_ints(F.lit("2024-02-28"), F.lit("2024-03-01"))).first()[0]
    assert days == [20240228, 20240229, 20240301]
    iso = spark.range(1).select(C.iso_to_text(F.lit("2025-07-17T08:00:00.000Z")), C.only_allowed(F.lit("a_1")), C.only_allowed(F.lit("a-1"))).first()
    assert tuple(iso) == ("2025-07-17 08:00:00", True, False)


def test_active_days_hold_sixty_three_days(spark):
    log = spark.createDataFrame([("u", DAY), ("u", DAY - dt.timedelta(days=40)), ("u", DAY - dt.timedelta(days=63))], "u string, dt date")
    assert cohorts.active_days(log, "u", DAY, span=63).first()["days"] == 1 + (1 << 40)
    with pytest.raises(ValueError):
        cohorts.active_days(log, "u", DAY, span=64)


def test_amounts_of_any_length(spark):
    hexes = ["0x" + "f" * n for n in (1, 7, 8, 30, 31, 40, 63, 64, 200)] + ["0x" + "0" * 62 + "ff", "0x0", "0X00de0B6b3a7640001"]
    rows = spark.createDataFrame([(h,) for h in hexes], "h string").select("h", C.amount_from_text("h").alias("v"), C.amount_from_text("h", True).alias("w")).collect()
    decimal.getcontext().prec = 400
    for r in rows:
        n = int(r["h"], 16)
        assert r["v"] == str(n)
        scaled = f"{decimal.Decimal(n) / 10**18:f}"
        assert r["w"] == (scaled.rstrip("0").rstrip(".") if "." in scaled else scaled)
    texts = spark.createDataFrame([("007.50",), ("-3",), ("x",), (None,), ("1" * 60,)], "t string").select(C.amount_from_text("t")).collect()
    assert [r[0] for r in texts] == ["7.5", "-3", None, "0", "1" * 60]


def test_rates_round_exact_ties(spark):
    rows = spark.createDataFrame([(1, 8, 2), (3, 8, 2), (249999999999999, 1000000000000000, 1), (-1, 8, 2), (5, 0, 2), (9007199254740993, 1, 0)], "n bigint, d bigint, k int")
    got = [rows.filter(F.col("k") == k).select(C.rate_or_null("n", "d", k)).collect() for k in (2, 1, 0)]
    assert [r[0] for r in got[0]] == [0.13, 0.38, -0.13, None] and got[1][0][0] == 0.2 and got[2][0][0] == 9007199254740993.0


def test_bands(spark):
    df = spark.createDataFrame([(50.0,), (50.01,), (100.0,), (300.0,), (300.01,), (None,)], "v double")
    bands = [(50, "0-50"), (100, "51-100"), (300, "101-300")]
    assert [r[0] for r in df.select(C.band("v", bands, "300+", "none")).collect()] == ["0-50", "51-100", "51-100", "101-300", "300+", "none"]


def test_rates(spark):
    df = spark.createDataFrame([(1.0, 3.0), (1.0, 0.0), (604526.94, 12.0)], "n double, d double")
    assert [r[0] for r in df.select(C.rate("n", "d", 2)).collect()] == [0.33, 0.0, 50377.25]
    assert df.select(C.rate_or_null("n", "d", 2)).collect()[1][0] is None


@pytest.mark.parametrize("seed", range(4))
def test_numbered_steps_is_row_number_and_lead(spark, seed):
    """One session holds most rows; equal times and empty minutes occur."""
    rng = random.Random(seed)
    data = []
    for i in range(400):
        session = "hot" if rng.random() < 0.7 else f"s{rng.randrange(9)}"
        ts = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.choice([0, 5, 30, 90, 1000, 1001, 5000]) * rng.randrange(3))
        data.append((session, ts, i, f"p{rng.randrange(5)}"))
    df = spark.createDataFrame(data, "s string, ts timestamp_ntz, id int, page string")
    got = paths.numbered_steps(df, ["s"], ["ts", "id"], "page", F.date_trunc("minute", "ts"))
    want = []
    for s in {d[0] for d in data}:
        seq = sorted((d for d in data if d[0] == s), key=lambda d: (d[1], d[2]))
        for i, d in enumerate(seq):
            want.append((*d, i + 1, seq[i + 1][3] if i + 1 < len(seq) else None))
    assert rows(got) == sorted(want, key=str)


@pytest.mark.parametrize("seed", range(4))
def test_top_ranked_is_rank(spark, seed):
    rng = random.Random(seed)
    data = [(rng.choice(["a", "a", "a", "b", None]), i, rng.choice([1, 2, 2, 3, None])) for i in range(120)]
    df = spark.createDataFrame(data, "g string, id int, v int")
    from pyspark.sql import Window

    plain = df.withColumn("rk", F.rank().over(Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last()))).filter("rk <= 3")
    assert rows(ranking.top_ranked(df, ["g"], "v", 3).select("g", "id", "v", "rk")) == rows(plain)


def test_recent_days_edges(spark):
    days = [0, 1, 6, 7, 29, 30, -1]
    df = spark.createDataFrame([(DAY - dt.timedelta(days=d), d) for d in days], "dt date, d int")
    got = {(r["d"], r["recent_days"]) for r in windows.recent_days(df, DAY).collect()}
    assert got == {(0, 1), (0, 7), (0, 30), (1, 7), (1, 30), (6, 7), (6, 30), (7, 30), (29, 30)}
    sums = windows.rolled_sums(df.withColumn("k", F.lit(1)).withColumn("n_1d", F.lit(1)), ["k"], {"n": "n_1d"}, DAY).first()
    assert (sums["n_7d"], sums["n_30d"]) == (3, 5)
    assert rows(windows.unpivot_windows(spark.createDataFrame([(1, 3, 5)], "k int, n_7d int, n_30d int"), ["k"], ["n"], [7, 30])) == [(1, 30, 5), (1, 7, 3)]


@pytest.mark.parametrize("seed", range(3))
def test_four_forms_of_consecutive_days(spark, seed):
    rng = random.Random(seed)
    data = {(u, DAY - dt.timedelta(days=rng.randrange(9))) for u in range(60) for _ in range(rng.randrange(6))}
    df = spark.createDataFrame(sorted(data), "user_id int, dt date")
    forms = [f(df, DAY).first()["order_continuously_user_count"] for f in (
        shop_ads.ads_continuous_order, shop_ads.ads_continuous_order_islands, shop_ads.ads_continuous_order_bitmap, shop_ads.ads_continuous_order_gap)]
    week = {u: sorted(d for x, d in data if x == u and (DAY - d).days < 7) for u in range(60)}
    three = sum(any((b - a).days == 2 for a, b in zip(d, d[2:])) for d in week.values())
    near = sum(any((b - a).days <= 3 for a, b in zip(d, d[2:])) for d in week.values())
    assert forms == [three, three, three, near]
    bits = cohorts.active_days(df, "user_id", DAY).filter(cohorts.has_cluster(F.col("days"), 3, 4)).count()
    assert bits == near


def test_first_login_fixture(spark):
    """New and returning users per day, worked out by hand."""
    log = [(101, 1), (101, 2), (101, 3), (102, 2), (102, 4), (103, 1), (103, 1), (103, 5), (104, 3), (105, 4)]
    df = spark.createDataFrame([(u, "d", dt.date(2024, 5, d)) for u, d in log], "user_id int, device_id string, login_date date")
    got = [(r[0].day, r[1], r[2]) for r in product_360.ads_new_old_users(df).collect()]
    assert got == [(1, 2, 0), (2, 1, 1), (3, 1, 1), (4, 1, 1), (5, 0, 1)]


def test_new_buyers(spark):
    df = spark.createDataFrame([(1, DAY), (2, DAY - dt.timedelta(days=6)), (3, DAY - dt.timedelta(days=7)), (4, DAY - dt.timedelta(days=40))], "user_id int, order_date_first date")
    got = {r["recent_days"]: r["new_order_user_count"] for r in shop_ads.ads_new_order_user(df, DAY).collect()}
    assert got == {1: 1, 7: 2, 30: 3}


def test_retention(spark):
    early = DAY - dt.timedelta(days=3)
    df = spark.createDataFrame([(1, early, DAY), (2, early, early), (3, DAY, DAY), (4, DAY - dt.timedelta(days=8), DAY)], "u int, f date, l date")
    got = cohorts.retention(df, DAY, "f", "l").collect()
    assert [(r["retention_day"], r["retention_count"], r["new_user_count"], r["retention_rate"]) for r in got] == [(3, 1, 2, 50.0)]


def test_merge_operators(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2), (None, 5)], "k string, a int")
    b = spark.createDataFrame([("y", 3), ("z", 4), (None, 6)], "k string, b int")
    got = merge.stack_sums(["k"], [a, b], {"a": "bigint", "b": "bigint"})
    assert rows(got) == rows(spark.createDataFrame([("x", 1, None), ("y", 2, 3), ("z", None, 4), (None, 5, 6)], "k string, a bigint, b bigint"))
    assert merge.signed_balance(a.select("a"), b.select(F.col("b").alias("a")), ["a"]).first()[0] == -5
    twice = spark.createDataFrame([(1, "g", 10), (1, "g", 10), (2, "g", 5)], "o int, g string, amount int")
    assert tuple(merge.sum_once(twice, ["o"], "amount", ["g"], "n", "total").first()) == ("g", 2, 15)
    versions = spark.createDataFrame([("k", 1, "old"), ("k", 3, "new"), ("j", 1, None)], "k string, v int, x string")
    assert rows(merge.latest_per_key(versions, ["k"], ["v"])) == [("j", 1, None), ("k", 3, "new")]
    assert merge.accumulate(a, a).count() == 3
    assert rows(merge.without_keys(a, spark.createDataFrame([("x",)], "k string"), ["k"])) == rows(a.filter("k is null or k = 'y'"))


def test_zipper_merge(spark):
    current = spark.createDataFrame([(1, "a", "2024-01-01", "9999-12-31"), (2, "b", "2024-01-01", "9999-12-31"), (1, "z", "2023-01-01", "2023-12-31")],
                                    "id int, name string, start_date string, end_date string")
    incoming = spark.createDataFrame([(1, "a2"), (3, "c"), (2, "b")], "id int, name string")
    got = rows(zipper.zipper_merge(current, incoming, "id", dt.date(2024, 2, 1)))
    assert got == sorted([
        (1, "z", "2023-01-01", "2023-12-31"), (1, "a", "2024-01-01", "2024-01-31"), (1, "a2", "2024-02-01", "9999-12-31"),
        (2, "b", "2024-01-01", "9999-12-31"), (3, "c", "2024-02-01", "9999-12-31")], key=str)
    again = rows(zipper.zipper_merge(spark.createDataFrame(got, current.schema), incoming, "id", dt.date(2024, 2, 1)))
    assert again == got


def test_word_flags(spark):
    from stratamart.operators.words import flag_words

    docs = spark.createDataFrame([(1, "A bad, word."), (2, "all fine"), (3, None), (4, "bad bad")], "id int, text string")
    words = spark.createDataFrame([("bad",), ("worse",)], "word string")
    got = rows(flag_words(docs, words, "text", ["id"]).select("id", "hits"))
    assert got == [(1, 1), (2, 0), (3, 0), (4, 1)]


def test_closure_of_a_deep_tree_and_circles(spark, tmp_path):
    from stratamart.operators.hierarchy import closure

    tree = [(i, i - 1 if i else None) for i in range(13)] + [(100, 12), (101, 999)]  # depth 12, a branch, a parent that is no row
    circle = [(201, 202), (202, 203), (203, 201), (204, 203)]
    written = []

    def stored(df):
        written.append(str(tmp_path / str(len(written))))
        df.coalesce(1).write.parquet(written[-1])
        return spark.read.parquet(written[-1])

    up, lost = closure(spark.createDataFrame(tree + circle, "id int, parent_id int"), stored)
    parent = dict(tree)
    want = set()
    for i in parent:
        at, d = i, 0
        while at is not None and at in parent:
            want.add((i, at, d))
            at, d = parent[at], d + 1
    assert {tuple(r) for r in up.collect()} == want
    assert {tuple(r) for r in lost.collect()} == {(201, 201), (202, 201), (203, 201), (204, 201)}


def test_lookup_as_of_equals_a_scan_over_all_states(spark):
    import random

    from stratamart.operators.versions import as_of, validity_ranges

    pick = random.Random(4)
    changes = [(f"c{pick.randint(0, 4)}", pick.randint(-50, 5000), f"n{i}", i, pick.random() < 0.2) for i in range(60)]
    facts = [(i, None if i % 40 == 0 else f"c{min(pick.randint(0, 30), 5)}", None if i % 55 == 0 else pick.randint(-100, 6000)) for i in range(1500)]
    ranges = validity_ranges(spark.createDataFrame(changes, "code string, ts bigint, name string, pos int, gone boolean"), ["code"], "ts", ["pos"], F.col("gone"))
    got = as_of(spark.createDataFrame(facts, "id int, code string, at bigint"), ranges, {"code": "code"}, "at", {"name": "label"}, width=700)
    want = []
    for i, code, at in facts:
        before = [(ts, pos, gone, name) for c, ts, name, pos, gone in changes if c == code and at is not None and ts <= at]
        last = max(before, default=None)
        want.append((i, code, at, None if last is None or last[2] else last[3]))
    assert rows(got) == sorted(want, key=str)
    inner = as_of(spark.createDataFrame(facts, "id int, code string, at bigint"), ranges, {"code": "code"}, "at", {"name": "label"}, width=700, how="inner")
    assert inner.count() == sum(w[3] is not None for w in want)


def test_hex_amounts_of_any_length_make_their_text_once(spark):
    pick = random.Random(1)
    texts = ["0x" + "".join(pick.choice("0123456789abcdefABCDEF") for _ in range(n)) for n in [*range(1, 50), 75, 200]]
    texts += ["0x" + "f" * n for n in range(1, 70)] + ["0x" + "0" * n for n in (1, 14, 15, 40)] + ["0X" + "0" * 50 + "a1", "0x1" + "0" * 45]
    made = spark.createDataFrame([(t,) for t in texts], "t string").select("t", C.amount_from_text("t").alias("a"))
    assert [r["a"] for r in made.collect()] == [str(int(t, 16)) for t in texts]
    made = spark.range(1).select(C.amount_from_text(F.concat(F.lit("0x"), F.md5(F.col("id").cast("string")))).alias("a"))
    assert made._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1


def test_parts_of_shuffles_stay_small_when_tables_grow(spark, small):
    from __spark_entry__ import queries

    queries()["dws_user_order_1d"](spark, small)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 1000



def test_days_and_names_that_follow_from_other_columns_do_not_travel(spark, small):
    from stratamart.sources.supplied import warehouse

    plans = {n: warehouse(spark, small).table(n)._jdf.queryExecution().optimizedPlan().toString() for n in ("dwd_order_detail", "dwd_pay_suc_detail")}
    lines = plans["dwd_order_detail"]
    assert "AS date_id" in lines[: lines.index("Join LeftOuter")] and "AS date_id" not in lines[lines.index("Join LeftOuter") :]
    paid = plans["dwd_pay_suc_detail"]
    assert paid.index("_code") < paid.index("Join LeftOuter, (id")
