"""Plans against their SQL statements, and the shape of physical plans."""

import datetime as dt

import pytest

import __spark_entry__ as entry
from stratamart.sources.supplied import RAW, warehouse
from stratamart.warehouse import PLANS, Warehouse

SAMPLE = [
    "dwd_order_detail", "dws_user_sku_order_nd", "ads_order_by_brand", "ads_page_path", "ads_cart_top3_by_cate", "ads_user_action", "ads01_range_analysis",
    "ads03_item_360", "dws10_page_path_1d", "ads10_user_preference", "ads_tms_driver_stats", "ads_tms_express_city", "dws_activity_effect",
    "rf_ads_user_profile", "rt_dwd_pay_suc", "word_check",
]


@pytest.fixture(scope="module")
def duck(small):
    import duckdb

    con = duckdb.connect()
    for t in RAW:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def plain(v):
    return "" if v is None else repr(round(v, 6)) if isinstance(v, float) else f"{type(v).__name__}:{v}"


@pytest.mark.parametrize("name", SAMPLE)
def test_plan_equals_sql(spark, small, duck, name):
    df = entry.queries()[name](spark, small)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    cur = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted(tuple(plain(dict(zip(names, r))[c]) for c in cols) for r in cur.fetchall())
    assert got == want


def test_every_query_has_a_statement():
    assert set(entry.queries()) & set(PLANS) == set(entry.oracle_sql()) & set(PLANS) == set(PLANS) - entry.INTERNAL


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_day_filter_and_columns_reach_the_scan(spark, small):
    text = physical(entry.queries()["dws_user_sku_order_nd"](spark, small))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate," in text
    assert "l_returnflag" not in text and "l_linenumber" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_no_plan_uses_python_or_products(spark, small):
    w = warehouse(spark, small)
    for name in ["ads_page_path", "ads_user_action", "rf_dwd_order_wide", "ads_tms_city_stats", "rt_log_split", "ads10_page_module"]:
        text = physical(w.table(name))
        assert "EvalPython" not in text and "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_stored_layers_are_read_not_rebuilt(spark):
    day = dt.date(2024, 1, 30)
    stored = spark.createDataFrame([(1, day, 1, 2, 3.0, 0.0, 0.0, 3.0)],
                                   "user_id int, dt date, order_count_1d int, order_num_1d int, order_original_amount_1d double, activity_reduce_amount_1d double, "
                                   "coupon_reduce_amount_1d double, order_total_amount_1d double")
    w = Warehouse(lambda name: {"dws_user_order_1d": stored}[name], day, stored={"dws_user_order_1d"})
    assert w.table("dws_user_order_td").first()["order_count_td"] == 1
    assert w.table("ads_new_order_user").count() == 3


def test_plan_names_are_unique_and_documented():
    assert len(PLANS) > 190


@pytest.mark.parametrize("name", ["ads_order_by_brand", "ads_order_by_cate", "ads_order_by_province"])
def test_reports_read_the_daily_layer_once(spark, small, name):
    text = physical(entry.queries()[name](spark, small))
    assert text.count("lineitem.parquet") == text.count("orders.parquet") == 1


def test_hot_keys_are_salted(spark, small):
    w = warehouse(spark, small)
    for name in ["rf_dwd_order_wide", "rf_dwd_behavior_wide", "rt_log_split", "word_check"]:
        assert "_salt" in w.table(name)._jdf.queryExecution().optimizedPlan().toString(), name


def test_page_path_reads_and_shuffles_the_log_once(spark, small):
    df = entry.queries()["ads_page_path"](spark, small)
    df.collect()
    final = physical(df).split("Initial Plan")[0]  # after adaptive execution found what it can reuse
    assert final.count("FileScan") == 1 and final.count("ReusedExchange") == 1
