"""Column helpers and table operators, each over a whole supplied table.

The shop and logistics plans use the masking, hashing and time helpers; these
plans exercise the ones that stand alone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from stratamart.functions import columns as C
from stratamart.operators.merge import accumulate, latest_per_key, without_keys
from stratamart.operators.words import flag_words, tokens
from stratamart.operators.zipper import zipper_merge
from stratamart.sinks.tables import with_day_bucket
from stratamart.warehouse import plan


@plan
def fx_hash_bucket(ods_user_info):
    """Bucket of each user, with two known hot users alone in theirs."""
    hot = ["Customer#000000003", "Customer#000000007"]
    return ods_user_info.select("id", C.hash_bucket("name", 64).alias("bucket"), C.hash_bucket_reserved("name", 64, hot).alias("reserved_bucket"))


@plan
def fx_bucket_load(ods_order_info):
    """Orders per user bucket."""
    return ods_order_info.groupBy(C.hash_bucket(F.col("user_id").cast("string"), 64).alias("bucket")).agg(F.count(F.lit(1)).alias("orders"))


@plan
def fx_order_days(ods_order_info):
    """Every day from an order to two days later, as numbers."""
    return ods_order_info.select("id", F.explode(C.day_ints("create_time", F.date_add("create_time", 2))).alias("day"))


@plan
def fx_hex_words(ods_user_info):
    """The words of a fixed-width hex payload made of two md5 pairs."""
    payload = F.concat(F.lit("0x"), F.md5("name"), F.md5("name"), F.md5("user_level"), F.md5("gender"))
    return ods_user_info.select("id", F.posexplode(C.fixed_words(payload)).alias("position", "word"))


@plan
def fx_amount_text(ods_order_info):
    """Amounts as hex and decimal texts, read back exactly: short ones, and ones of 31, 40 and 64 hex digits."""
    cents = (F.col("original_total_amount") * 100).cast("bigint")
    key = F.col("id").cast("string")
    long = {n: F.left(F.concat(F.lit("f"), F.md5(key), F.md5(F.concat(key, F.lit("b")))), F.lit(n)) for n in (31, 40)}
    return ods_order_info.select(
        "id",
        C.amount_from_text(F.concat(F.lit("0x"), F.hex(cents))).cast("decimal(20,0)").alias("cents"),
        C.amount_from_text(F.col("original_total_amount").cast("string")).cast("decimal(20,2)").alias("amount"),
        *[C.amount_from_text(F.concat(F.lit("0x"), v)).alias(f"hex_{n}") for n, v in long.items()],
        C.amount_from_text(F.concat(F.lit("0x"), F.lpad(F.hex(cents), 64, "0")), True).alias("hex_64"),
    )


@plan
def fx_json_append(ods_cart_info):
    """A JSON list column with one more element."""
    listed = F.to_json(F.array("sku_name", "is_ordered"))
    return ods_cart_info.select("id", C.append_to_json_list(listed, F.col("user_id").cast("string")).alias("items"))


@plan
def fx_allowed_characters(ods_user_info):
    return ods_user_info.select("id", C.only_allowed("name").alias("name_ok"), C.only_allowed("phone_num").alias("phone_ok"))


@plan
def word_check(conversations, benchmark):
    """How many different words of a set each message holds; the set is the words of the benchmark items."""
    words = benchmark.select(F.explode(tokens("text")).alias("word"))
    return flag_words(conversations.select("conv_id", "turn", "text"), words, "text", ["conv_id", "turn"]).select("conv_id", "turn", "hits")


@plan
def zipper_user(ods_user_info, log_as_of: dt.date):
    """Users after a day on which every third one changed level and some are new."""
    current = ods_user_info.filter(F.col("create_time") < F.lit(log_as_of)).select("id", "user_level", F.lit("2024-01-01").alias("start_date"), F.lit(C.OPEN_END).alias("end_date"))
    changed = F.when(F.col("id") % 3 == 0, F.lit("RAISED")).otherwise(F.col("user_level"))
    incoming = ods_user_info.select("id", changed.alias("user_level"))
    return zipper_merge(current, incoming, "id", log_as_of)


@plan
def keyed_latest(ods_order_status_log):
    """The newest state of each order in its log of states."""
    return latest_per_key(ods_order_status_log, ["order_id"], ["operate_time"])


@plan
def keys_deleted(ods_order_info, ods_payment_info):
    """Orders after the paid ones are deleted by key."""
    return without_keys(ods_order_info.select("id", "user_id", "order_status"), ods_payment_info.select(F.col("order_id").alias("id")), ["id"])


@plan
def report_accumulated(dws_province_order_1d, as_of: dt.date):
    """A report of two days to which a run adds the second once more and a third."""
    first, second = ((F.col("dt") >= F.lit(as_of - dt.timedelta(days=n))) & (F.col("dt") < F.lit(as_of - dt.timedelta(days=n - 2))) for n in (3, 2))
    return accumulate(dws_province_order_1d.filter(first), dws_province_order_1d.filter(second))


@plan
def day_buckets(ods_log):
    """Log lines per day bucket of their time field; unreadable lines go to the error bucket."""
    return with_day_bucket(ods_log, "ts", "log").groupBy("day").agg(F.count(F.lit(1)).alias("lines"))
