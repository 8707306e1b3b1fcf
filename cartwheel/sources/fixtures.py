"""Adapter: the driver's TPC-H-style tables -> the raw zone of the shop-event models.

The rules are fixed test-fixture definitions (FIXTURES.md section 3). Each output
is a plain projection of one large table plus broadcast joins with dimension
tables whose size is fixed by the TPC-H definition (nation: 25 rows, region: 5),
so the adapter is a single map-side stage over ``events`` / ``orders`` /
``customer`` and grows linearly with them.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.sources import sinks


# ---- fixed values of the fixture mapping -------------------------------------------
# driver event_type -> shop event_name
EVENT_NAME_BY_TYPE = {
    "signup": "session_start",
    "view": "view_item",
    "click": "add_to_cart",
    "error": "begin_checkout",
    "purchase": "purchase",
}
# user_id % 3 -> device category
DEVICES = ["mobile", "desktop", "tablet"]
ITEM_EVENT_TYPES = ["view", "click", "purchase"]
QUANTITY_EVENT_TYPES = ["click", "purchase"]
NULL_USER_EVERY = 331  # event_id % 331 = 0 -> user_pseudo_id NULL
NEGATIVE_REVENUE_EVERY = 97  # purchase with event_id % 97 = 0 -> revenue negated
DUPLICATE_EVERY = 167  # event_id % 167 = 0 -> row appears twice
N_CAMPAIGNS = 8
N_SOURCES = 5
N_CHANNELS = 3
FREE_CAMPAIGN = 7  # cmp_7 costs nothing
SIGNUP_BASE = "2024-01-01"
SIGNUP_SPREAD_DAYS = 28
SPEND_DAYS = 30
IMPRESSIONS_PER_CLICK = 50
COST_DIVISOR = 10000
# -------------------------------------------------------------------------------------


# Columns of the driver tables the adapter reads. An explicit read schema skips
# the footer-inference job per table and pins the types.
DRIVER_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "orders": "o_orderkey BIGINT, o_totalprice DOUBLE",
    "customer": "c_custkey BIGINT, c_nationkey INT, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table."""
    reader = spark.read.schema(DRIVER_SCHEMAS[name]) if name in DRIVER_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def _case(col: Column, mapping: dict) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(col == k, F.lit(v))) if out is None else out.when(col == k, F.lit(v))
    return out


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw shop events (17 columns, reference raw shape) derived from ``events``."""
    ev = sinks.spread(_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value", "props"))
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    eid, uid, et = F.col("event_id"), F.col("user_id"), F.col("event_type")
    k = F.get_json_object("props", "$.k").try_cast("int")
    day = F.dayofmonth("ts")
    campaign_no = (uid + day) % N_CAMPAIGNS
    is_item = et.isin(ITEM_EVENT_TYPES)
    devices = {i: d for i, d in enumerate(DEVICES)}

    # exact duplicates: every 167th event is emitted twice (one scan, no union)
    copies = F.sequence(F.lit(1), F.when(eid % DUPLICATE_EVERY == 0, F.lit(2)).otherwise(F.lit(1)))
    ev = ev.withColumn("_copy", F.explode(copies)).withColumn("_nk", (uid % 25).cast("int"))

    out = ev.join(F.broadcast(nation), F.col("_nk") == F.col("n_nationkey"), "left").select(
        F.concat(F.lit("evt_"), eid.cast("string")).alias("event_id"),
        F.col("ts").cast("timestamp_ntz").alias("event_timestamp"),
        F.to_date("ts").alias("event_date"),
        _case(et, EVENT_NAME_BY_TYPE).alias("event_name"),
        F.when(eid % NULL_USER_EVERY != 0, F.concat(F.lit("u"), uid.cast("string"))).alias("user_pseudo_id"),
        F.when(uid % 2 == 0, F.concat(F.lit("cust_"), uid.cast("string"))).alias("customer_id"),
        F.concat(F.lit("u"), uid.cast("string"), F.lit("."), F.to_date("ts").cast("string")).alias("ga_session_id"),
        _case(uid % 3, devices).alias("device_category"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("cmp_"), campaign_no.cast("string")).alias("campaign_id"),
        F.concat(F.lit("src_"), (campaign_no % N_SOURCES).cast("string")).alias("traffic_source"),
        F.lit("cpc").alias("traffic_medium"),
        F.when(is_item, F.concat(F.lit("prod_"), k.cast("string"))).alias("item_id"),
        F.when(is_item, F.concat(F.lit("cat_"), (k % 6).cast("string"))).alias("item_category"),
        F.when(is_item, F.concat(F.lit("Item "), k.cast("string"))).alias("item_name"),
        F.when(et.isin(QUANTITY_EVENT_TYPES), (F.lit(1) + k % 3).cast("double")).alias("quantity"),
        F.when(
            et == "purchase",
            F.when(eid % NEGATIVE_REVENUE_EVERY == 0, -F.col("value")).otherwise(F.col("value")),
        ).alias("purchase_revenue"),
    )
    return out


def raw_crm_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CRM master from ``customer`` joined with its nation and region."""
    cust = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = _table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (
        cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey)
        .join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat(F.lit("cust_"), F.col("c_custkey").cast("string")).alias("customer_id"),
            F.date_add(F.lit(SIGNUP_BASE).cast("date"), (F.col("c_custkey") % SIGNUP_SPREAD_DAYS).cast("int")).alias(
                "signup_date"
            ),
            F.col("c_mktsegment").alias("plan"),
            F.col("r_name").alias("region"),
        )
    )


def raw_ad_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign x day spend aggregated from ``orders`` (partial + final hash aggregate)."""
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    cno = (F.expr(f"o_orderkey div {SPEND_DAYS}") % N_CAMPAIGNS).alias("cno")
    day = F.date_add(F.lit(SIGNUP_BASE).cast("date"), (F.col("o_orderkey") % SPEND_DAYS).cast("int")).alias("date")
    g = o.groupBy(day, cno).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("price"),
    )
    return g.select(
        "date",
        F.concat(F.lit("cmp_"), F.col("cno").cast("string")).alias("campaign_id"),
        F.concat(F.lit("ch_"), (F.col("cno") % N_CHANNELS).cast("string")).alias("channel"),
        F.concat(F.lit("src_"), (F.col("cno") % N_SOURCES).cast("string")).alias("source"),
        (F.col("n") * IMPRESSIONS_PER_CLICK).cast("bigint").alias("impressions"),
        F.col("n").cast("bigint").alias("clicks"),
        F.when(F.col("cno") == FREE_CAMPAIGN, F.lit(0.0))
        .otherwise(F.col("price").cast("double") / F.lit(float(COST_DIVISOR)))
        .alias("cost"),
    )


def raw_zone(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The raw zone as lazy DataFrames over the driver tables."""
    return {
        "raw_events": raw_events(spark, sf_dir),
        "raw_ad_spend": raw_ad_spend(spark, sf_dir),
        "raw_crm_customers": raw_crm_customers(spark, sf_dir),
    }
