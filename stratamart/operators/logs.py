"""App logs: parsing, new-visitor repair and splitting into event kinds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stratamart.functions.columns import in_zone, millis_to_ts
from stratamart.operators.merge import join_salted

# A line is read once, as a variant, so whatever fields a client sends travel on unchanged.
# Only the common block, whose values are texts, is opened.
BLOCKS = ("common", "page", "start", "err", "displays", "actions")
OBJECT = "MAP<STRING,STRING>"
KINDS = {"common": OBJECT, "displays": "ARRAY<VARIANT>", "actions": "ARRAY<VARIANT>"}


def parse(df: DataFrame, value: str = "value") -> DataFrame:
    """Blocks of each log line, its other fields (``rest``), the device, the event time; ``dirty`` marks lines that are not JSON objects."""
    text = F.col(value).cast("string")
    keep = [c for c in df.columns if c != value]
    parsed = df.filter(F.col(value).isNotNull()).select(*keep, text.alias("value"), F.try_parse_json(text).alias("_d"))
    blocks = [F.try_variant_get("_d", f"$.{b}", KINDS.get(b, "VARIANT")).alias(b) for b in BLOCKS]
    parsed = parsed.select(
        *keep, "value", *blocks, F.try_variant_get("_d", "$.ts", "BIGINT").alias("ts"), F.try_variant_get("_d", "$", "MAP<STRING,VARIANT>").alias("_all")
    )
    return parsed.select(
        *keep, "value", F.col("_all").isNull().alias("dirty"), *BLOCKS, F.map_filter("_all", lambda k, v: ~k.isin(*BLOCKS, "ts")).alias("rest"), "ts",
        F.col("common")["mid"].alias("mid"), F.col("common")["is_new"].alias("is_new"),
    )


def first_visits(parsed: DataFrame) -> DataFrame:
    """Per device (_mid) its first line (_first: time, whether it says the visitor is old) and the time of its last (_last)."""
    return parsed.filter(~F.col("dirty") & F.col("mid").isNotNull()).groupBy(F.col("mid").alias("_mid")).agg(
        F.min(F.struct(F.col("ts"), (F.col("is_new") != "1").alias("old"))).alias("_first"), F.max("ts").alias("_last")
    )


def with_first_visits(parsed: DataFrame, visits: DataFrame, zone: str) -> DataFrame:
    """Lines whose new-visitor flag agrees with their device's first visit.  A busy device, or lines without one, are spread over many tasks."""
    local = lambda ts: in_zone(millis_to_ts(ts), zone).cast("date")
    joined = join_salted(parsed.withColumn("_mid", F.col("mid")), visits.select("_mid", "_first"), ["_mid"], ["value"])
    first_day = F.when(F.col("_first.old"), F.date_sub(local("_first.ts"), 1)).otherwise(local("_first.ts"))
    fixed = F.when((F.col("is_new") == "1") & (first_day != local("ts")), F.lit("0")).otherwise(F.col("is_new"))
    return joined.withColumn("is_new", fixed).drop("_mid", "_first")


def repair_is_new(parsed: DataFrame, zone: str) -> DataFrame:
    """New-visitor flags corrected by the first event of each device.

    A device is new only on the day of its first event, and only if that event
    says so.
    """
    return with_first_visits(parsed, first_visits(parsed), zone)


def split(parsed: DataFrame) -> DataFrame:
    """One row per event: ``route`` is dirty, err, start, display, action or page.

    An error is sent on its own and taken out of its line.  A start line is
    nothing else.  Displays and actions keep the common block, the page and the
    time.  What is left of the line, with every other field of it, goes to page or start.
    One pass over the lines makes all routes, so a sink can write them by ``route``.
    """
    common = F.when(F.col("common").isNotNull(), F.map_from_entries(F.filter(
        F.map_entries("common"), lambda e: e["key"] != "is_new"))).otherwise(F.create_map().cast(OBJECT))
    # a column of its own, so that it is made once per line and not once per event
    made = parsed.withColumn("_common", F.map_concat(common, F.create_map(F.lit("is_new"), F.col("is_new"))))
    common = F.col("_common")

    others = F.when(F.size("rest") > 0, F.concat(F.lit(","), F.substring(F.to_json("rest"), 2, 1 << 30))).otherwise(F.lit("}"))

    def event(route, whole_line=False, **blocks):
        body = F.to_json(F.struct(*[b.alias(name) for name, b in blocks.items()]))
        if whole_line:  # the closing brace makes room for the other fields
            body = F.concat(F.left(body, F.length(body) - 1), others)
        return F.struct(F.lit(route).alias("route"), body.alias("value"))

    page, ts = F.col("page"), F.col("ts")
    dirty = F.array(F.struct(F.lit("dirty").alias("route"), F.col("value").alias("value")))
    none = F.filter(dirty, lambda e: F.lit(False))
    err = F.when(F.col("err").isNotNull(), F.array(event("err", err=F.col("err"), common=common, ts=ts))).otherwise(none)
    start = F.array(event("start", whole_line=True, common=common, start=F.col("start"), ts=ts))
    displays = F.coalesce(F.transform("displays", lambda d: event("display", common=common, page=page, display=d, ts=ts)), none)
    actions = F.coalesce(F.transform("actions", lambda a: event("action", common=common, page=page, action=a, ts=ts)), none)
    rest = F.array(event("page", whole_line=True, common=common, page=page, ts=ts))
    whole = F.when(F.col("start").isNotNull(), F.concat(err, start)).otherwise(F.concat(err, displays, actions, rest))
    keep = [c for c in parsed.columns if c not in (*BLOCKS, "rest", "value", "dirty")]
    return made.select(*keep, F.inline(F.when(F.col("dirty"), dirty).otherwise(whole)))
