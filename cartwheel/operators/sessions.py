"""Session grain (M5): one hash aggregation over the clean events.

``any_value`` of the reference is a free choice of one non-NULL value; ``min``
is a legal, deterministic choice (trap T2). The aggregation is partial + final,
so a hot session is combined map-side before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions import MONEY, flag, money


def _is(name: str):
    return F.col("event_name") == name


def int_sessions(events: DataFrame) -> DataFrame:
    return events.groupBy("ga_session_id").agg(
        F.min("user_pseudo_id").alias("user_pseudo_id"),
        F.max("customer_id").alias("customer_id"),
        F.min("device_category").alias("device_category"),
        F.min("country").alias("country"),
        F.min("campaign_id").alias("campaign_id"),
        F.min("traffic_source").alias("traffic_source"),
        F.min("event_timestamp").alias("session_start_ts"),
        F.max("event_timestamp").alias("session_end_ts"),
        F.min("event_date").alias("session_date"),
        F.count(F.lit(1)).alias("event_count"),
        F.max(flag(_is("view_item"))).alias("did_view"),
        F.max(flag(_is("add_to_cart"))).alias("did_add_to_cart"),
        F.max(flag(_is("begin_checkout"))).alias("did_checkout"),
        F.max(flag(_is("purchase"))).alias("did_purchase"),
        F.count_distinct(F.when(_is("view_item"), F.col("item_id"))).alias("products_viewed"),
        F.coalesce(
            F.sum(F.when(_is("purchase"), money("purchase_revenue")).otherwise(F.lit(0).cast(MONEY))),
            F.lit(0).cast(MONEY),
        )
        .cast("double")
        .alias("revenue"),
    )
