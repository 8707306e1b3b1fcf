"""Nested analytics-export rows (one per hit), built from the flat raw events.

The export shape (FIXTURES.md section 2) carries the session id inside an
``event_params`` key/value array, items in an ``items`` array and scalars in
structs. This builder is a narrow projection of the raw events, so its size
follows the driver tables. Fixture rules: every 50th event has no params, and
every 10th add-to-cart carries a second item of quantity 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EMPTY_PARAMS_EVERY = 50
SECOND_ITEM_EVERY = 10
ENGAGEMENT_MSEC = 100
PARAMS_TYPE = "array<struct<key:string,value:struct<int_value:bigint>>>"
ITEMS_TYPE = "array<struct<item_id:string,item_name:string,item_category:string,quantity:bigint>>"


def event_number() -> Column:
    return F.regexp_extract("event_id", r"^evt_(\d+)$", 1).cast("bigint")


def session_number() -> Column:
    """Integer session id: days since epoch * 1e6 + user number."""
    user_no = F.regexp_extract("ga_session_id", r"^u(\d+)\.", 1).cast("bigint")
    return F.unix_date("event_date").cast("bigint") * F.lit(1_000_000) + user_no


def epoch_micros(ts: str | Column) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)


def ga4_export(raw_events: DataFrame) -> DataFrame:
    n = event_number()
    param = lambda k, v: F.struct(F.lit(k).alias("key"), F.struct(v.cast("bigint").alias("int_value")).alias("value"))
    params = F.when(n % EMPTY_PARAMS_EVERY == 0, F.array().cast(PARAMS_TYPE)).otherwise(
        F.array(param("engagement_time_msec", F.lit(ENGAGEMENT_MSEC)), param("ga_session_id", session_number()))
    )
    item = lambda iid, name, cat, q: F.struct(
        iid.alias("item_id"), name.alias("item_name"), cat.alias("item_category"), q.cast("bigint").alias("quantity")
    )
    first = item(F.col("item_id"), F.col("item_name"), F.col("item_category"), F.rint("quantity"))
    second = item(
        F.concat(F.col("item_id"), F.lit("_b")), F.concat(F.col("item_name"), F.lit(" B")), F.col("item_category"), F.lit(1)
    )
    items = (
        F.when(F.col("item_id").isNull(), F.array().cast(ITEMS_TYPE))
        .when((F.col("event_name") == "add_to_cart") & (n % SECOND_ITEM_EVERY == 0), F.array(first, second))
        .otherwise(F.array(first))
    )
    return raw_events.select(
        F.date_format("event_date", "yyyyMMdd").alias("event_date"),
        epoch_micros("event_timestamp").alias("event_timestamp"),
        "event_name",
        "user_pseudo_id",
        F.col("customer_id").alias("user_id"),
        params.alias("event_params"),
        F.struct(F.col("device_category").alias("category")).alias("device"),
        F.struct(F.col("country").alias("country")).alias("geo"),
        F.struct(
            F.col("campaign_id").alias("name"), F.col("traffic_source").alias("source"), F.col("traffic_medium").alias("medium")
        ).alias("traffic_source"),
        items.alias("items"),
        F.struct(F.col("purchase_revenue").alias("purchase_revenue_in_usd")).alias("ecommerce"),
    )
