"""Streams give what their batch twins give, however the input is cut into files."""

import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from stratamart.operators.cdc import decode
from stratamart.operators.logs import parse, repair_is_new, split
from stratamart.plans import realtime
from stratamart.sinks.tables import current_rows
from stratamart.sources.readers import file_stream
from stratamart.streaming import jobs, touched

ZONE = "GMT+8"
DAY = 86_400_000
T0 = 1_704_067_200_000  # 2024-01-01 00:00 UTC


def write_files(folder, lines, files):
    folder.mkdir(parents=True, exist_ok=True)
    size = -(-len(lines) // files)
    for i in range(files):
        add_file(folder / f"part-{i:03d}.txt", lines[i * size:(i + 1) * size], i)
    return str(folder)


def add_file(path, lines, number):
    """Files are taken in order of their time, so each gets its own."""
    path.write_text("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + 10 * number,) * 2)


def log_line(mid, ts, is_new, **blocks):
    return json.dumps({"common": {"mid": mid, "is_new": is_new, "uid": "7"}, "ts": ts, **blocks})


LOGS = [
    log_line("a", T0, "1", page={"page_id": "home", "during_time": 5}, displays=[{"item": "x"}, {"item": "y"}], actions=[{"action_id": "cart"}]),
    log_line("a", T0 + 1000, "1", page={"page_id": "detail"}),
    log_line("b", T0, "0", page={"page_id": "home"}),
    "{not json",
    log_line("a", T0 + DAY, "1", page={"page_id": "home"}),
    log_line("b", T0 + DAY, "1", start={"entry": "icon"}, err={"error_code": 1}),
    log_line("c", T0 + DAY, "1", err={"error_code": 2}, page={"page_id": "home"}),
    log_line("c", T0 + 2 * DAY, "0", page={"page_id": "home"}),
]


def test_split_log_routes(spark):
    df = spark.createDataFrame([(v,) for v in LOGS], "value string")
    out = split(repair_is_new(parse(df), ZONE))
    counts = {r["route"]: r["count"] for r in out.groupBy("route").count().collect()}
    assert counts == {"dirty": 1, "err": 2, "start": 1, "display": 2, "action": 1, "page": 6}
    flags = {(r["mid"], r["ts"]): r["is_new"] for r in out.filter("route in ('page', 'start')").collect()}
    assert flags[("a", T0)] == "1" and flags[("a", T0 + 1000)] == "1"
    assert flags[("a", T0 + DAY)] == "0"  # not the first day any more
    assert flags[("b", T0 + DAY)] == "0"  # was old from the start
    assert flags[("c", T0 + DAY)] == "1"
    page = json.loads(out.filter("route = 'page' and mid = 'a'").orderBy("ts").first()["value"])
    assert page["page"] == {"page_id": "home", "during_time": 5}


def test_other_fields_of_a_line_travel_on(spark):
    line = log_line("a", T0, "1", page={"page_id": "home", "x": {"y": [1, 2]}}, extra={"deep": [1, {"z": None}]}, flag=True)
    plain = log_line("b", T0, "1", start={"entry": "icon"}, version=3)
    out = split(parse(spark.createDataFrame([(line,), (plain,), ("[1]",), ('"text"',)], "value string")))
    got = {r["route"]: r["value"] for r in out.collect()}
    page = json.loads(got["page"])
    assert page["extra"] == {"deep": [1, {"z": None}]} and page["flag"] is True and page["page"]["x"] == {"y": [1, 2]}
    assert json.loads(got["start"])["version"] == 3 and out.filter("route = 'dirty'").count() == 2


@pytest.mark.parametrize("files", [1, 4])
def test_log_split_stream_equals_batch(spark, tmp_path, files):
    source = write_files(tmp_path / "in", LOGS, files)
    stream = file_stream(spark, source, files_per_batch=1)
    jobs.log_split_job(stream, str(tmp_path / "out"), str(tmp_path / "cp"), ZONE).awaitTermination(120)
    got = spark.read.json(str(tmp_path / "out")).select("route", "value", "mid", "ts", "is_new")
    batch = split(repair_is_new(parse(spark.read.text(source)), ZONE)).select("route", "value", "mid", "ts", "is_new")
    assert rows(got) == rows(batch)
    assert [r["value"] for r in got.filter("route = 'dirty'").collect()] == ["{not json"]


@pytest.mark.parametrize("chunk", ["1", "10000"])
def test_first_visit_does_not_depend_on_order_or_chunks(spark, tmp_path, chunk):
    late_first = [log_line("z", T0 + DAY, "1", page={"page_id": "b"}), log_line("z", T0, "1", page={"page_id": "a"})]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", chunk)
    stream = file_stream(spark, write_files(tmp_path / "in", late_first, 1), files_per_batch=1)
    jobs.log_split_job(stream, str(tmp_path / "out"), str(tmp_path / "cp"), ZONE).awaitTermination(120)
    assert rows(spark.read.json(str(tmp_path / "out")).select("ts", "is_new")) == [(T0, "1"), (T0 + DAY, "0")]


def test_devices_not_seen_for_long_start_anew(spark, tmp_path):
    lines = [log_line("z", T0, "1", page={"page_id": "a"}), log_line("z", T0 + 10 * DAY, "1", page={"page_id": "b"})]
    for name, ttl, flags in (("short", 5 * DAY, ["1", "1"]), ("long", 20 * DAY, ["1", "0"])):
        stream = file_stream(spark, write_files(tmp_path / name / "in", lines, 2), files_per_batch=1)
        jobs.log_split_job(stream, str(tmp_path / name / "out"), str(tmp_path / name / "cp"), ZONE, ttl).awaitTermination(120)
        assert [r[1] for r in rows(spark.read.json(str(tmp_path / name / "out")).select("ts", "is_new"))] == flags


def change(table, op, ts, after, before=None):
    text = {k: None if v is None else str(v) for k, v in after.items()}
    return json.dumps({"op": op, "before": before, "after": text, "source": {"db": "shop", "table": table}, "ts_ms": ts})


def order(i, ts, user="u1", province="9"):
    return [
        change("order_info", "c", ts, {"id": i, "user_id": user, "province_id": province, "order_status": "1001"}),
        change("order_detail", "c", ts, {"id": f"{i}-1", "order_id": i, "sku_id": "s1", "sku_name": "n", "create_time": ts, "sku_num": 2, "order_price": "1.50",
                                         "split_total_amount": "2.50", "split_activity_amount": "0.50", "split_coupon_amount": "0.00"}),
        change("order_detail", "c", ts, {"id": f"{i}-2", "order_id": i, "sku_id": "s2", "sku_name": "n", "create_time": ts, "sku_num": 1, "order_price": "4.00",
                                         "split_total_amount": "4.00", "split_activity_amount": "0.00", "split_coupon_amount": "0.00"}),
        change("order_detail_activity", "c", ts, {"id": i, "order_detail_id": f"{i}-1", "activity_id": "a1", "activity_rule_id": "r1"}),
    ]


def pay(i, ts, status="1602"):
    return change("payment_info", "u", ts, {"id": i, "order_id": i, "payment_type": "1101", "callback_time": "2024-01-01 00:00:00", "payment_status": status})


MINUTE = 60_000
CDC = (
    order("1", T0) + [pay("1", T0 + 29 * MINUTE)]
    + order("2", T0 + MINUTE) + [pay("2", T0 + MINUTE + 31 * MINUTE)]  # too late
    + order("3", T0 + 2 * MINUTE) + [pay("3", T0 + 2 * MINUTE - 4000)]  # just before
    + order("4", T0 + 3 * MINUTE, "u2") + [pay("4", T0 + 4 * MINUTE, "1601")]  # not paid
    + [
        change("cart_info", "r", T0, {"id": "1", "user_id": "u1", "sku_id": "s1", "sku_num": 3}),
        change("cart_info", "u", T0, {"id": "1", "user_id": "u1", "sku_id": "s1", "sku_num": 5}, {"sku_num": "3"}),
        change("cart_info", "u", T0, {"id": "1", "user_id": "u1", "sku_id": "s1", "sku_num": 1}, {"sku_num": "5"}),
        change("cart_info", "c", T0 + DAY, {"id": "2", "user_id": "u2", "sku_id": "s1", "sku_num": 1}),
        change("comment_info", "c", T0, {"id": "1", "user_id": "u1", "sku_id": "s1", "appraise": "1201", "comment_txt": "t"}),
        change("order_info", "u", T0 + 5 * MINUTE, {"id": "4", "operate_time": "2024-01-01 00:05:00", "order_status": "1003"}, {"order_status": "1001"}),
        "{broken",
    ]
)


@pytest.fixture()
def dic(spark):
    return spark.createDataFrame([("1101", "card", "11"), ("1201", "good", "12")], "dic_code string, dic_name string, parent_code string")


def changes(spark):
    return decode(spark.createDataFrame([(v,) for v in CDC], "value string"))


def test_detail_tables(spark, dic):
    ch = changes(spark)
    lines = realtime.rt_dwd_order_detail(ch)
    by_id = {r["id"]: r for r in lines.collect()}
    assert len(by_id) == 8
    assert by_id["1-1"]["activity_id"] == "a1" and by_id["1-2"]["activity_id"] is None
    assert by_id["1-1"]["split_original_amount"] == "3.00"
    paid = realtime.rt_dwd_pay_suc(lines, ch, dic)
    assert sorted(r["order_detail_id"] for r in paid.collect()) == ["1-1", "1-2", "3-1", "3-2"]
    assert sorted(r["sku_num"] for r in realtime.rt_dwd_cart_add(ch).collect()) == [1, 2, 3]
    assert sorted(r["id"] for r in realtime.rt_dwd_order_cancel(lines, ch).collect()) == ["4-1", "4-2"]
    province = realtime.rt_dws_province(lines).collect()
    assert [(r["order_count"], r["order_num"], float(r["order_total_amount"])) for r in province] == [(4, 12, 26.0)]


@pytest.mark.parametrize("files", [1, 5])
def test_summary_streams_equal_batch(spark, tmp_path, dic, files):
    source = write_files(tmp_path / "in", CDC, files)
    ch = decode(file_stream(spark, source, files_per_batch=1))
    carts, comments = realtime.rt_dwd_cart_add(ch), realtime.rt_dwd_comment(ch, dic)
    path = str(tmp_path / "user")
    for run in ("cp1", "cp2"):  # a new checkpoint writes the same rows again
        jobs.summary_job(jobs.interaction_user_stream(carts, comments), path, ["user_id", "date_id"], str(tmp_path / run)).awaitTermination(120)
    batch = changes(spark)
    want = realtime.rt_dws_interaction_user(realtime.rt_dwd_cart_add(batch), realtime.rt_dwd_comment(batch, dic))
    assert rows(current_rows(spark, path).select(*want.columns)) == rows(want)


def test_province_stream_counts_orders_once(spark, tmp_path):
    lines = realtime.rt_dwd_order_detail(changes(spark))
    repeated = lines.unionByName(lines.filter("id = '1-1'"))
    repeated.coalesce(1).write.json(str(tmp_path / "lines"))
    stream = spark.readStream.schema(lines.schema).json(str(tmp_path / "lines"))
    unique = jobs.once(stream, ["id"], None, "")
    jobs.summary_job(jobs.province_stream(unique), str(tmp_path / "p"), ["province_id", "date_id"], str(tmp_path / "cp")).awaitTermination(120)
    want = realtime.rt_dws_province(lines)
    assert [(r["order_count"], r["order_num"], float(r["order_total_amount"])) for r in current_rows(spark, str(tmp_path / "p")).collect()] == [
        (r["order_count"], r["order_num"], float(r["order_total_amount"])) for r in want.collect()]


def test_interval_join_stream(spark, tmp_path, dic):
    lines = realtime.rt_dwd_order_detail(changes(spark))
    lines.coalesce(1).write.json(str(tmp_path / "lines"))
    source = write_files(tmp_path / "in", CDC, 1)
    line_stream = spark.readStream.schema(lines.schema).json(str(tmp_path / "lines"))
    out = jobs.pay_suc_stream(line_stream, file_stream(spark, source), dic)
    got = []
    jobs.run(out, str(tmp_path / "cp"), lambda b, n: got.extend(tuple(r) for r in b.collect())).awaitTermination(120)
    want = realtime.rt_dwd_pay_suc(lines, changes(spark), dic)
    assert sorted(got, key=str) == rows(want)


def test_order_detail_stream(spark, tmp_path):
    later = order("99", T0 + 3 * DAY)  # moves the watermark past every spread
    folder = tmp_path / "in"
    write_files(folder, CDC, 1)
    add_file(folder / "zz.txt", later, 1)
    add_file(folder / "zzz.txt", order("100", T0 + 6 * DAY), 2)
    jobs.order_detail_job(spark, file_stream(spark, str(folder), files_per_batch=1), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(180)
    got = current_rows(spark, str(tmp_path / "out")).select(*realtime.DETAIL).filter("order_id not in ('99', '100')")
    want = realtime.rt_dwd_order_detail(changes(spark)).select(*realtime.DETAIL)
    assert rows(got) == rows(want)


def test_dimension_store_follows_config(spark, tmp_path):
    source = write_files(tmp_path / "in", CDC, 2)
    config = spark.createDataFrame([("order_info", "dim_order", "id,order_status", "id")], "source_table string, sink_table string, sink_columns string, sink_row_key string")
    jobs.dimension_job(file_stream(spark, source, 1), lambda: config, str(tmp_path / "dim"), str(tmp_path / "cp")).awaitTermination(120)
    stored = current_rows(spark, str(tmp_path / "dim"))
    cells = {(r["column_name"], r["column_value"]) for r in stored.collect()}
    assert ("order_status", "1003") in cells and ("id", "4") in cells
    assert stored.filter("column_name = 'order_status'").count() == 4


def test_lake_table_drops_deleted_rows(spark, tmp_path):
    lines = [
        change("t", "c", T0, {"id": "1", "v": "a"}), change("t", "u", T0 + 5, {"id": "1", "v": "b"}, {"id": "1", "v": "a"}),
        change("t", "c", T0, {"id": "2", "v": "x"}),
        json.dumps({"op": "d", "before": {"id": "2", "v": "x"}, "after": None, "source": {"table": "t"}, "ts_ms": T0 + 9}),
    ]
    source = write_files(tmp_path / "in", lines, 2)
    for run in ("cp", "cp2"):  # a new checkpoint delivers all again
        jobs.lake_job(file_stream(spark, source, 1), "t", ["id", "v"], str(tmp_path / "lake"), str(tmp_path / run)).awaitTermination(120)
        assert [(r["id"], r["v"]) for r in current_rows(spark, str(tmp_path / "lake")).collect()] == [("1", "b")]


REFUNDS = CDC + [
    change("order_refund_info", "c", T0 + MINUTE, {"id": "r1", "user_id": "u1", "order_id": "1", "sku_id": "s1", "refund_type": "1501", "refund_num": 1, "refund_amount": "2.00",
                                                    "refund_reason_type": "1301", "refund_reason_txt": "t", "create_time": "2024-01-01 00:01:00"}),
    change("order_info", "u", T0 + 2 * MINUTE, {"id": "1", "user_id": "u1", "province_id": "9", "order_status": "1005"}, {"order_status": "1002"}),
    change("refund_payment", "u", T0 + 5 * MINUTE, {"id": "p1", "order_id": "1", "sku_id": "s1", "payment_type": "1101", "callback_time": "2024-01-01 00:05:00", "total_amount": "2.00",
                                                     "refund_status": "1602"}, {"refund_status": "0701"}),
    change("order_refund_info", "u", T0 + 4 * MINUTE, {"id": "r1", "order_id": "1", "sku_id": "s1", "refund_num": 1, "refund_status": "0705"}, {"refund_status": "0701"}),
    change("order_info", "u", T0 + 6 * MINUTE, {"id": "1", "user_id": "u1", "province_id": "9", "order_status": "1006"}, {"order_status": "1005"}),
]


LATE = REFUNDS + [
    # the cancel of order 3 comes three days later, and so do refund states of order 2
    change("order_info", "u", T0 + 3 * DAY, {"id": "3", "operate_time": "2024-01-04 00:00:00", "order_status": "1003"}, {"order_status": "1001"}),
    change("order_refund_info", "c", T0 + MINUTE, {"id": "r2", "user_id": "u1", "order_id": "2", "sku_id": "s2", "refund_type": "1501", "refund_num": 1, "refund_amount": "4.00",
                                                    "refund_reason_type": "1301", "refund_reason_txt": "t", "create_time": "2024-01-01 00:01:00"}),
    change("order_info", "u", T0 + 5 * DAY, {"id": "2", "user_id": "u1", "province_id": "9", "order_status": "1005"}, {"order_status": "1002"}),
    change("refund_payment", "u", T0 + 6 * DAY, {"id": "p2", "order_id": "2", "sku_id": "s2", "payment_type": "1101", "callback_time": "2024-01-07 00:00:00", "total_amount": "4.00",
                                                  "refund_status": "1602"}, {"refund_status": "0701"}),
    change("order_refund_info", "u", T0 + 2 * DAY, {"id": "r2", "order_id": "2", "sku_id": "s2", "refund_num": 1, "refund_status": "0705"}, {"refund_status": "0701"}),
    change("order_info", "u", T0 + 9 * DAY, {"id": "2", "user_id": "u1", "province_id": "9", "order_status": "1006"}, {"order_status": "1005"}),
]


def line_stream(spark, tmp_path, lines, files=1):
    lines.repartition(files).write.json(str(tmp_path / "lines"))
    return spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "lines"))


@pytest.mark.parametrize("files", [1, 4])
def test_late_cancels_and_refunds_equal_batch(spark, tmp_path, files):
    dic = spark.createDataFrame([("1101", "card", "11"), ("1501", "money", "15"), ("1301", "late", "13")], "dic_code string, dic_name string, parent_code string")
    ch = decode(spark.createDataFrame([(v,) for v in LATE], "value string"))
    lines = realtime.rt_dwd_order_detail(ch)
    source = write_files(tmp_path / "in", LATE, files)
    cdc = file_stream(spark, source, files_per_batch=1)
    order_lines = line_stream(spark, tmp_path, lines, files)
    wanted = {
        "cancel": (realtime.rt_dwd_order_cancel(lines, ch), lambda p, c: jobs.order_cancel_job(order_lines, cdc, p, c)),
        "refund": (realtime.rt_dwd_refund(ch, dic), lambda p, c: jobs.refund_job(cdc, p, c, lambda r: realtime.named_refunds(r, dic))),
        "pay": (realtime.rt_dwd_refund_pay(ch, dic), lambda p, c: jobs.refund_pay_job(cdc, p, c, lambda r: realtime.named_refund_payments(r, dic))),
    }
    for name, (want, job) in wanted.items():
        job(str(tmp_path / name), str(tmp_path / f"{name}-cp")).awaitTermination(180)
        assert rows(touched.result(spark, str(tmp_path / name)).select(*want.columns)) == rows(want) and want.count() >= 2


@pytest.mark.parametrize("files", [1, 4])
def test_user_goods_are_kept_up_by_retraction(spark, tmp_path, dic, files):
    ch = decode(spark.createDataFrame([(v,) for v in CDC], "value string"))
    lines = realtime.rt_dwd_order_detail(ch)
    source = write_files(tmp_path / "in", CDC[::-1], files)  # carts and comments before the orders
    jobs.user_goods_job(line_stream(spark, tmp_path, lines, files), file_stream(spark, source, 1), str(tmp_path / "g"), str(tmp_path / "cp"), lambda: dic).awaitTermination(180)
    want = realtime.rt_dws_user_goods(lines, realtime.rt_dwd_cart_add(ch), realtime.rt_dwd_comment(ch, dic))
    assert rows(touched.result(spark, str(tmp_path / "g")).select(*want.columns)) == rows(want)


def test_province_days_count_each_order_once_however_late(spark, tmp_path):
    lines = realtime.rt_dwd_order_detail(changes(spark))
    stream = line_stream(spark, tmp_path, lines.unionByName(lines.filter("id = '1-1'")), 4)
    late = order("50", T0 + 5000) + order("51", T0 + 9 * DAY)
    out = str(tmp_path / "p")
    query = jobs.province_job(stream, out, str(tmp_path / "cp"), "a")
    query.awaitTermination(180)
    assert query.lastProgress is None or not query.lastProgress["stateOperators"]  # nothing is held between batches
    everything = lines.unionByName(realtime.rt_dwd_order_detail(decode(spark.createDataFrame([(v,) for v in late], "value string"))))
    everything.filter("order_id in ('50', '51')").coalesce(1).write.mode("append").json(str(tmp_path / "lines"))
    for run in ("cp", "cp2"):  # goes on; and a new checkpoint that delivers all again
        jobs.province_job(stream, out, str(tmp_path / run), run).awaitTermination(180)
        want = realtime.rt_dws_province(everything)
        got = jobs.province_totals(spark, out)
        assert rows(got.select(*want.columns)) == rows(want)
    touched.fold_deltas(spark, out, jobs.PROVINCE_DAY, jobs.PROVINCE_MEASURES, "cp2/3")
    assert rows(jobs.province_totals(spark, out).select(*want.columns)) == rows(want)


def test_a_repeated_batch_changes_no_sum(spark, tmp_path):
    lines = realtime.rt_dwd_order_detail(changes(spark))
    sides = {"lines": touched.Side(lambda b: b, ["order_id", "id"])}
    build = lambda lines: lines.groupBy("order_id", "user_id").agg(F.count(F.lit(1)).alias("n"))
    each = touched.deltas_by_touched_keys(str(tmp_path / "t"), sides, ["order_id"], build, ["user_id"], ["n"], "r")
    for number in (0, 1, 1, 1, 2):
        each(lines.filter(f"pmod(xxhash64(id), 3) = {number}"), number)
    want = lines.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    assert rows(touched.summed_deltas(spark, str(tmp_path / "t"), ["user_id"], ["n"]).select("user_id", "n")) == rows(want)


def dictionary(op, ts, code, name, parent="12"):
    return change("base_dic", op, ts, {"dic_code": code, "parent_code": parent, "dic_name": name})


@pytest.mark.parametrize("files", [1, 3])
def test_comments_bear_the_label_of_their_own_time(spark, tmp_path, files):
    say = lambda i, ts: change("comment_info", "c", ts, {"id": i, "user_id": "u", "sku_id": "s", "appraise": "1201", "comment_txt": "t"})
    lines = [dictionary("r", T0, "1201", "good"), say("1", T0 + 1), say("2", T0 + DAY), dictionary("u", T0 + 2 * DAY, "1201", "very good"), say("3", T0 + 2 * DAY),
             say("0", T0 - 1), say("4", T0 + 40 * DAY), dictionary("c", T0, "1201", "other", "99")]
    jobs.comment_job(file_stream(spark, write_files(tmp_path / "in", lines, files), 1), str(tmp_path / "c"), str(tmp_path / "cp")).awaitTermination(180)
    got = {r["id"]: r["appraise_name"] for r in touched.result(spark, str(tmp_path / "c")).collect()}
    assert got == {"1": "good", "2": "good", "3": "very good", "4": "very good"}


def test_paid_lines_are_named_as_of_the_payment(spark, tmp_path):
    lines = realtime.rt_dwd_order_detail(changes(spark))
    kept = str(tmp_path / "dic")
    versions = [dictionary("r", T0, "1101", "old", "11"), dictionary("u", T0 + 10 * MINUTE, "1101", "new", "11")]
    jobs.keep_dictionary(spark.createDataFrame([(v,) for v in versions], "value string"), kept)
    stream = jobs.pay_suc_stream(line_stream(spark, tmp_path, lines), file_stream(spark, write_files(tmp_path / "in", CDC, 1)))
    name = lambda b: realtime.paid_columns(jobs.named_as_of(b, kept, "payment_type", "payment_type_name", "11", "pay_ts_ms"))
    jobs.detail_job(spark, stream, str(tmp_path / "paid"), str(tmp_path / "cp"), ["order_detail_id"], name).awaitTermination(180)
    got = {r["order_detail_id"]: r["payment_type_name"] for r in current_rows(spark, str(tmp_path / "paid")).collect()}
    assert got == {"1-1": "new", "1-2": "new", "3-1": "old", "3-2": "old"}  # paid after 29 minutes and after two


@pytest.mark.parametrize("files", [1, 2, 5])
def test_a_long_silence_starts_a_device_anew_however_lines_are_batched(spark, tmp_path, files):
    days = [0, 1, 2, 9, 10, 30, 30, 31]
    lines = [log_line("z", T0 + d * DAY + i, "1", page={"page_id": "a"}) for i, d in enumerate(days)] + [log_line(None, T0, "1", page={"page_id": "x"})]
    stream = file_stream(spark, write_files(tmp_path / "in", lines, files), files_per_batch=1)
    jobs.log_split_job(stream, str(tmp_path / "out"), str(tmp_path / "cp"), ZONE, 5 * DAY).awaitTermination(180)
    got = {(r["mid"], r["ts"]): r["is_new"] for r in spark.read.json(str(tmp_path / "out")).collect()}
    fresh = {0, 9, 30}  # the days on which a life begins
    assert got == {("z", T0 + d * DAY + i): "1" if d in fresh else "0" for i, d in enumerate(days)} | {(None, T0): "1"}


def test_typed_log_job(spark, tmp_path):
    source = write_files(tmp_path / "in", [*LOGS, json.dumps({"log_type": "x", "ts": T0})], 3)
    jobs.typed_log_job(file_stream(spark, source, 1), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    from stratamart.plans.refund import rf_log_route

    want = rf_log_route(spark.read.text(source))
    got = spark.read.json(str(tmp_path / "out")).select(*want.columns)
    assert rows(got) == rows(want) and want.count() > 0


def test_topic_sink_sends_the_newest_row_of_a_key(spark, tmp_path):
    sent = []
    batch = spark.createDataFrame([("a", "1", 1, "t1"), ("a", "2", 2, "t1"), ("b", "1", 1, "t2")], "id string, v string, ts_ms bigint, topic string")
    jobs.topic_sink(lambda m: sent.extend(m.collect()), "id", "ts_ms", "topic")(batch, 0)
    assert sorted((r["key"], json.loads(r["value"])["v"], r["topic"]) for r in sent) == [("a", "2", "t1"), ("b", "1", "t2")]
