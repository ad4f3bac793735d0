"""Sources and sinks on local folders."""

import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stratamart.operators.surrogates import NUMBER, assign_keys
from stratamart.sinks import keyed, tables
from stratamart.sources import readers
from stratamart.streaming import jobs, times


def test_partition_overwrite_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, dt string")
    tables.write_partitions(df, path)
    tables.write_partitions(df.filter("dt = '2024-01-02'").withColumn("id", F.lit(9)), path, files_per_day=2)
    tables.write_partition(spark.createDataFrame([(7,)], "id int"), path, dt.date(2024, 1, 3))
    tables.write_partition(spark.createDataFrame([(7,)], "id int"), path, dt.date(2024, 1, 3))
    got = spark.read.schema("id int, dt string").parquet(path)
    assert rows(got) == [(1, "2024-01-01"), (7, "2024-01-03"), (9, "2024-01-02")]


def test_counted_needs_no_second_job(spark, tmp_path):
    df, seen = tables.counted(spark.range(42), "load")
    df.write.parquet(str(tmp_path / "t"))
    assert seen.get == {"rows": 42}


def test_merged_rows(spark, tmp_path):
    path = str(tmp_path / "k")
    table = lambda *r: spark.createDataFrame(list(r), "id string, v string, ts bigint")
    read = lambda: rows(tables.current_rows(spark, path).select("id", "v"))
    first = table(("a", "1", 1), ("a", "2", 2), ("b", "1", 1))
    for _ in range(2):  # delivered again
        tables.merge_rows(first, path, ["id"], ["ts"])
    tables.merge_rows(table(("b", "late", 0), ("c", "1", 5)), path, ["id"], ["ts"])
    assert read() == [("a", "2"), ("b", "1"), ("c", "1")]
    gone = spark.createDataFrame([("a",), ("zz",)], "id string")
    for _ in range(2):  # a repeated delete
        tables.delete_rows(gone, path, ["id"], {"ts": 9})
        assert read() == [("b", "1"), ("c", "1")]
    tables.merge_rows(table(("a", "old", 8), ("zz", "old", 3)), path, ["id"], ["ts"])  # late old rows
    assert read() == [("b", "1"), ("c", "1")]
    tables.merge_rows(table(("a", "new", 10)), path, ["id"], ["ts"])
    assert read() == [("a", "new"), ("b", "1"), ("c", "1")]
    tables.forget_deleted(spark, path, F.col("_version.ts") < 10)
    assert read() == [("a", "new"), ("b", "1"), ("c", "1")]


def test_a_delete_may_come_before_the_first_row(spark, tmp_path):
    path = str(tmp_path / "k")
    tables.delete_rows(spark.createDataFrame([("a",)], "id string"), path, ["id"], {"ts": 5})
    assert tables.current_rows(spark, path).count() == 0
    rows_ = spark.createDataFrame([("a", "old", 4, 1.5), ("b", "x", 1, 2.5)], "id string, v string, ts bigint, w double")
    tables.merge_rows(rows_, path, ["id"], ["ts"])
    assert rows(tables.current_rows(spark, path).select("id", "v", "w")) == [("b", "x", 2.5)]
    tables.merge_rows(spark.createDataFrame([("a", "new", 6)], "id string, v string, ts bigint"), path, ["id"], ["ts"])
    assert rows(tables.current_rows(spark, path).select("id", "v", "w")) == [("a", "new", None), ("b", "x", 2.5)]


def test_forgotten_rows_leave_also_a_bucket_that_ends_empty(spark, tmp_path):
    path = str(tmp_path / "k")
    tables.delete_rows(spark.createDataFrame([("a",), ("b",)], "id string"), path, ["id"], {"ts": 5})
    assert keyed.stored_rows(spark, path).count() == 2
    tables.forget_deleted(spark, path, F.col("_version.ts") < 6)
    assert keyed.stored_rows(spark, path).count() == 0 and keyed.manifest(spark, path).held == {}


def test_a_small_load_touches_few_buckets_of_a_large_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "BUCKET_ROWS", 100)
    path = str(tmp_path / "k")
    big = spark.range(20_000).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("v"), F.lit(1).alias("ts"))
    tables.merge_rows(big, path, ["id"], ["ts"])
    before = keyed.manifest(spark, path)
    assert before.buckets == 256 and before.rows == 20_000  # the number of buckets follows the table
    tables.merge_rows(big.filter("id < 10").withColumn("v", F.lit(2)).withColumn("ts", F.lit(2)), path, ["id"], ["ts"])
    after = keyed.manifest(spark, path)
    changed = [b for b in after.held if after.held[b] != before.held.get(b)]
    assert len(changed) <= 10 and sum(after.held[b][1] for b in changed) < 2_000
    assert tables.current_rows(spark, path).agg(F.sum("v")).first()[0] == 20_010


def test_a_load_that_fails_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "k")
    first = spark.createDataFrame([("a", 1)], "id string, ts bigint")
    tables.merge_rows(first, path, ["id"], ["ts"])
    monkeypatch.setattr(keyed, "_add", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        tables.merge_rows(spark.createDataFrame([("a", 2), ("b", 2)], "id string, ts bigint"), path, ["id"], ["ts"])
    assert rows(tables.current_rows(spark, path)) == [("a", 1)]
    monkeypatch.undo()
    tables.merge_rows(spark.createDataFrame([("a", 2), ("b", 2)], "id string, ts bigint"), path, ["id"], ["ts"])
    assert rows(tables.current_rows(spark, path)) == [("a", 2), ("b", 2)]


@pytest.mark.parametrize("order", [(0, 1), (1, 0)])
def test_delete_wins_within_one_millisecond(spark, tmp_path, order):
    both = [("a", "x", 5, False), ("a", None, 5, True)]
    df = spark.createDataFrame([both[i] for i in order], "id string, v string, ts bigint, gone boolean").coalesce(1)
    tables.merge_rows(df, str(tmp_path / "k"), ["id"], ["ts"], F.col("gone"))
    assert tables.current_rows(spark, str(tmp_path / "k")).count() == 0


def test_report_accumulates_once(spark, tmp_path):
    new = spark.createDataFrame([("2024-01-01", 1)], "dt string, n int")
    path = tables.accumulate_report(spark, new, str(tmp_path / "r"))
    again = tables.accumulate_report(spark, new, path)
    more = tables.accumulate_report(spark, spark.createDataFrame([("2024-01-02", 2)], "dt string, n int"), again)
    assert rows(spark.read.parquet(more)) == [("2024-01-01", 1), ("2024-01-02", 2)]


def test_day_buckets(spark, tmp_path):
    lines = [json.dumps({"ts": 1704067200000}), json.dumps({"ts": 1704067200}), json.dumps({"x": 1}), "{bad"]
    out = tables.with_day_bucket(spark.createDataFrame([(v,) for v in lines], "value string"))
    assert [r["day"] for r in out.collect()] == ["20240101", "20240101", "error_bucket", "error_bucket"]
    for _ in range(2):  # a batch written again
        tables.write_day_buckets(out, str(tmp_path / "b"), 1)
    assert spark.read.text(str(tmp_path / "b")).count() == 4


def test_small_files_of_a_day_are_packed(spark, tmp_path):
    path = str(tmp_path / "b")
    texts = [json.dumps({"ts": 1704067200000 + i, "pad": "x" * 200}) for i in range(400)]
    for batch in range(20):
        some = spark.createDataFrame([(v,) for v in texts[batch * 20 : batch * 20 + 20]], "value string")
        tables.write_day_buckets(tables.with_day_bucket(some), path, batch)
    read = lambda: sorted(r[0] for r in tables.day_lines(spark, path, "20240101").collect())
    assert read() == sorted(texts)
    assert tables.pack_day(spark, path, "20240101", file_bytes=20_000, older_than="15") == 4
    assert read() == sorted(texts)
    tables.write_day_buckets(tables.with_day_bucket(some), path, 19)  # a young batch is written again
    tables.pack_day(spark, path, "20240101", file_bytes=1 << 20)
    assert tables.pack_day(spark, path, "20240101", file_bytes=1 << 20) == 0
    assert read() == sorted(texts)
    assert len(list((tmp_path / "b").rglob("part-*.txt"))) <= 6


def test_a_stopped_packing_loses_and_repeats_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "b")
    lines = tables.with_day_bucket(spark.createDataFrame([(json.dumps({"ts": 1704067200000 + i}),) for i in range(30)], "value string"))
    for batch in range(3):
        tables.write_day_buckets(lines.filter(f"pmod(xxhash64(value), 3) = {batch}"), path, batch)
    for broken in ("_add", "drop_folder"):  # before the packed files count, and before the small ones go
        with monkeypatch.context() as m:
            m.setattr(tables, broken, lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                tables.pack_day(spark, path, "20240101")
        assert tables.day_lines(spark, path, "20240101").count() == 30
    tables.pack_day(spark, path, "20240101")
    assert tables.day_lines(spark, path, "20240101").count() == 30


def test_messages_of_a_repeated_batch_are_read_once(spark, tmp_path):
    sent = str(tmp_path / "topic")
    sink = tables.outbox_sink(str(tmp_path / "outbox"), lambda m: m.write.mode("append").parquet(sent), "id", "sink")
    batch = spark.createDataFrame([("a", 1, "t1"), ("a", 1, "t1"), ("b", 2, "t2")], "id string, v int, sink string")
    for number in (0, 0, 1):
        sink(batch, number)
    messages = spark.read.parquet(sent)
    assert messages.count() == 9
    once = tables.received_once(messages)
    assert once.count() == 6 and once.filter("key = 'a'").count() == 4
    stream = spark.readStream.schema(messages.schema).parquet(sent).withColumn("timestamp", F.current_timestamp())
    got = []
    jobs.run(tables.received_once(stream, "1 hour"), str(tmp_path / "cp"), lambda b, n: got.extend(b.collect())).awaitTermination(120)
    assert len(got) == 6
    with pytest.raises(ValueError):
        tables.received_once(stream)


def test_surrogate_keys_are_dense_and_stable(spark, tmp_path):
    path = str(tmp_path / "map")
    first = spark.range(1000).select(F.concat(F.lit("k"), F.col("id")).alias("code"), F.col("id").alias("v"))
    one = assign_keys(first.unionByName(first), path, ["code"])
    assert one.count() == 2000
    numbers = sorted({r[NUMBER] for r in one.collect()})
    assert numbers == list(range(1, 1001))
    again = {r["code"]: r[NUMBER] for r in assign_keys(first, path, ["code"]).collect()}
    assert again == {r["code"]: r[NUMBER] for r in one.collect()}
    more = spark.createDataFrame([("k5", 1), ("new", 2), (None, 3), (None, 4)], "code string, v bigint")
    got = {r["code"]: r[NUMBER] for r in assign_keys(more, path, ["code"]).collect()}
    assert got["k5"] == again["k5"] and sorted([got["new"], got[None]]) == [1001, 1002]


def test_surrogate_keys_do_not_repeat_at_a_million(spark, tmp_path):
    many = spark.range(1_000_000).select(F.md5(F.col("id").cast("string")).alias("code"))
    got = assign_keys(many, str(tmp_path / "map"), ["code"]).agg(F.countDistinct(NUMBER).alias("n"), F.min(NUMBER).alias("a"), F.max(NUMBER).alias("b")).first()
    assert tuple(got) == (1_000_000, 1, 1_000_000)


def view(ts, page, session="s1", mid="m1", channel="c"):
    return json.dumps({"common": {"mid": mid, "sid": session, "ch": channel, "is_new": "1"}, "page": {"page_id": page, "during_time": 5}, "ts": ts})


def test_the_log_is_loaded_in_steps_and_reports_prune_its_days(spark, tmp_path):
    from stratamart.sinks import log_layer
    from stratamart.warehouse import Warehouse

    day, t0 = 86_400_000, 1_704_067_200_000
    steps = [
        [view(t0 + i, "home") for i in range(3)] + [view(t0 + day, "home", "s2")],
        [view(t0 + 40 * day, "home", "s3", "m2"), view(t0 + 5, "cart")],  # a late line goes to its own day
        [view(t0 + 39 * day, "cart", "s4", "m3", "d")],
    ]
    import stratamart.plans  # noqa: F401

    log = lambda lines: spark.createDataFrame([(v,) for v in lines], "log string")
    path = str(tmp_path / "views")
    for number in (0, 1, 1, 2):  # a step run again replaces itself
        assert log_layer.load_step(log(steps[number]), path, number, "GMT+8") == len(steps[number])
    stored = log_layer.page_views(spark, path)
    settings = dict(as_of=dt.date(2024, 2, 10), zone="GMT+8")
    raw = Warehouse(lambda name: {"ods_log": log(sum(steps, []))}[name], **settings)
    kept = Warehouse(lambda name: {"dwd_page_view": stored}[name], stored={"dwd_page_view"}, **settings)
    want = raw.table("dwd_page_view")
    assert rows(stored.select(*want.columns)) == rows(want)
    report = kept.table("ads_traffic_by_channel")
    want = raw.table("ads_traffic_by_channel")
    assert rows(report.select(*want.columns)) == rows(want) and want.count() > 0
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "from_json" not in plan
    assert log_layer.views_of_day(spark, path, dt.date(2024, 1, 1)).count() == 4
    untouched = {f: f.stat().st_mtime_ns for f in (tmp_path / "views").rglob("*.parquet")}
    log_layer.load_step(log([view(t0 + 6, "pay")]), path, 3, "GMT+8")
    assert all(f.stat().st_mtime_ns == t for f, t in untouched.items())


def test_topic_messages(spark):
    df = spark.createDataFrame([(1, "t1")], "id int, sink string")
    row = tables.topic_messages(df, key="id", topic_column="sink").first()
    assert (row["key"], json.loads(row["value"]), row["topic"]) == ("1", {"id": 1}, "t1")


def test_readers(spark, tmp_path):
    (tmp_path / "d.json").write_text('{"brand": "x", "ip": "1.1.1.1"}\nnot json\n')
    good, bad = readers.device_records(spark, str(tmp_path / "d.json"))
    assert good.first()["brand"] == "x" and [r[0] for r in bad.collect()] == ["not json"]
    log = readers.json_table(spark, str(tmp_path / "d.json"), "brand STRING", corrupt="bad")
    assert sorted((r["brand"], r["bad"]) for r in log.filter("bad is null").collect()) == [("x", None)]
    (tmp_path / "c.csv").write_text("1,2024-01-01 00:00:00\n2,\n")
    table = readers.delimited_table(spark, str(tmp_path / "c.csv"), "id INT, t TIMESTAMP")
    assert [r["t"] is None for r in table.orderBy("id").collect()] == [False, True]
    assert readers.camel_columns(spark.createDataFrame([(1, 2)], "user_id int, n int")).columns == ["userId", "n"]
    assert [readers.table_type(t) for t in ("varchar(20)", "int(11)", "bigint", "decimal(16,2)", "datetime")] == [
        "STRING", "INT", "BIGINT", "DECIMAL(16,2)", "STRING"]
    assert readers.schema_of_columns([("id", "bigint"), ("price", "decimal(10,2)")]).simpleString() == "struct<id:bigint,price:decimal(10,2)>"
    keyed = spark.createDataFrame([("k",)], "id string").withColumn("row_key", F.md5("id"))
    assert readers.keyed_row(keyed, "k").count() == 1 and readers.rows_as_json(keyed, 5).count() == 1


def test_table_lifecycle(spark):
    spark.sql("DROP TABLE IF EXISTS life_dim_x")
    change = "struct<op:string>"  # noqa: F841
    rows_ = [("c", None, {"sink_table": "dim_x", "sink_columns": "id,name"}, 1), ("u", {"sink_table": "dim_x", "sink_columns": "id"}, {"sink_table": "dim_x", "sink_columns": "id,age"}, 2)]
    df = spark.createDataFrame(rows_, "op string, before map<string,string>, after map<string,string>, ts_ms bigint")
    jobs.apply_table_lifecycle(spark, df, prefix="life_")
    assert spark.table("life_dim_x").columns == ["row_key", "id", "age"]
    gone = spark.createDataFrame([("d", {"sink_table": "dim_x", "sink_columns": "id"}, None, 3)], df.schema)
    jobs.apply_table_lifecycle(spark, gone, prefix="life_")
    assert not spark.catalog.tableExists("life_dim_x")


def test_current_config(spark):
    def row(op, ts, table, sink):
        cfg = {"source_table": table, "sink_table": sink, "sink_columns": "id", "sink_row_key": "id"}
        return (op, cfg if op == "d" else None, None if op == "d" else cfg, ts)

    df = spark.createDataFrame([row("r", 1, "a", "x"), row("u", 2, "a", "y"), row("r", 1, "b", "z"), row("d", 3, "b", "z")],
                               "op string, before map<string,string>, after map<string,string>, ts_ms bigint")
    assert [(r["source_table"], r["sink_table"]) for r in jobs.current_config(df).collect()] == [("a", "y")]


def test_event_times(spark):
    lines = ['{"ts": 1704067200000, "a": 1704067200}', '{"a": null, "b": 1704067201}', '[{"w": 1704067200000}]', "{bad"]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    assert [r["et"] is not None for r in times.by_field(df, "ts", "3 seconds").collect()] == [True, False, False, False]
    assert [r["et"] is not None for r in times.by_field_or(df, "a", "b", "3 seconds").collect()] == [True, True, False, False]
    assert [r["et"] is not None for r in times.by_first_element(df, "w", "3 seconds").collect()] == [False, False, True, False]
    assert times.without_time(times.by_field(df, "ts", "3 seconds")).count() == 3
