"""Staging models: validate, quarantine, de-duplicate, type.

``stg_events`` filters *before* it de-duplicates, so an invalid copy of an
event never shadows a valid one. De-duplication is ``row_number() = 1`` per
``event_id``; Catalyst turns that into a WindowGroupLimit that also runs
*before* the shuffle, so a hot event id is cut to one row per map task before
it reaches its reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CLEAN_COLUMNS = [
    "event_id",
    "event_timestamp",
    "event_date",
    "event_name",
    "user_pseudo_id",
    "customer_id",
    "ga_session_id",
    "device_category",
    "country",
    "campaign_id",
    "traffic_source",
    "traffic_medium",
    "item_id",
    "item_category",
    "item_name",
    "quantity",
    "purchase_revenue",
]


def _bad_revenue() -> Column:
    return (F.col("event_name") == "purchase") & (
        F.col("purchase_revenue").isNull() | (F.col("purchase_revenue") <= 0)
    )


def is_valid(strict: bool = False) -> Column:
    """Validity predicate (three-valued, trap T1).

    With the reference semantics a row with NULL ``event_name`` and NULL or
    non-positive revenue is neither valid nor rejected. ``strict=True`` also
    requires a non-NULL ``event_name`` and ``event_id``: without an id (a surrogate id
    with a NULL part has none) all such rows would count as copies of one event.
    """
    cond = F.col("user_pseudo_id").isNotNull() & ~_bad_revenue()
    if strict:
        cond = cond & F.col("event_name").isNotNull() & F.col("event_id").isNotNull()
    return cond


def is_rejected(strict: bool = False) -> Column:
    cond = F.col("user_pseudo_id").isNull() | _bad_revenue()
    if strict:
        cond = cond | F.col("event_name").isNull() | F.col("event_id").isNull()
    return cond


def reject_reason(strict: bool = False) -> Column:
    """First matching reason; NULL user wins over bad revenue. No ELSE branch."""
    r = F.when(F.col("user_pseudo_id").isNull(), F.lit("null_user_id")).when(
        _bad_revenue(), F.lit("non_positive_revenue")
    )
    if strict:
        r = r.when(F.col("event_name").isNull(), F.lit("null_event_name")).when(F.col("event_id").isNull(), F.lit("null_event_id"))
    return r


def dedup_first(
    df: DataFrame, key: str = "event_id", order: str = "event_timestamp"
) -> DataFrame:
    """Keep the earliest row per ``key`` (NULL times last).

    Copies with the same key and time but another payload are told apart by a hash of
    the whole row, so a retried task or a second scan keeps the same one.
    """
    rest = F.xxhash64(*[F.col(c) for c in df.columns if c not in (key, order)])
    w = Window.partitionBy(key).orderBy(F.col(order).asc_nulls_last(), rest)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def typed_events(df: DataFrame) -> DataFrame:
    """Rename + cast projection to the 17 clean columns."""
    return df.select(
        "event_id",
        F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp"),
        F.col("event_date").cast("date").alias("event_date"),
        "event_name",
        "user_pseudo_id",
        "customer_id",
        "ga_session_id",
        "device_category",
        "country",
        "campaign_id",
        "traffic_source",
        "traffic_medium",
        "item_id",
        "item_category",
        "item_name",
        # DOUBLE -> INT as the SQL cast does: to the nearest, halves to even (trap T10)
        F.rint(F.col("quantity")).cast("int").alias("quantity"),
        F.col("purchase_revenue").cast("double").alias("purchase_revenue"),
    )


def stg_events(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Valid events, one row per id, in the types of the warehouse (M1)."""
    return typed_events(dedup_first(raw.select(*CLEAN_COLUMNS).filter(is_valid(strict))))


def stg_events_rejected(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Quarantine: raw rows failing validation plus ``reject_reason`` (M2). Not de-duplicated."""
    return raw.filter(is_rejected(strict)).withColumn("reject_reason", reject_reason(strict))


def reject_counts(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows"))


def stg_ad_spend(raw: DataFrame) -> DataFrame:
    """Daily spend per campaign, typed (M3)."""
    return raw.select(
        F.col("date").cast("date").alias("spend_date"),
        "campaign_id",
        "channel",
        "source",
        F.col("impressions").cast("bigint").alias("impressions"),
        F.col("clicks").cast("bigint").alias("clicks"),
        F.col("cost").cast("double").alias("cost"),
    )


def stg_crm_customers(raw: DataFrame) -> DataFrame:
    """CRM customer master, typed (M4)."""
    return raw.select("customer_id", F.col("signup_date").cast("date").alias("signup_date"), "plan", "region")


# ------------------------------------------------------------------ nested export
def _param_int(key: str):
    """``(SELECT value.int_value FROM UNNEST(event_params) WHERE key = k)`` without a join."""
    hit = F.filter("event_params", lambda p: p["key"] == F.lit(key))
    return F.get(hit, 0)["value"]["int_value"]


def _items_quantity():
    """Sum of item quantities; NULL when no item has one (like SUM over an empty set)."""
    q = F.filter(F.transform("items", lambda i: i["quantity"]), lambda v: v.isNotNull())
    return F.when(F.size(q) > 0, F.aggregate(q, F.lit(0).cast("bigint"), lambda acc, v: acc + v))


def flatten_ga4(export: DataFrame) -> DataFrame:
    """Nested export rows -> flat event shape (higher-order functions, no UNNEST join)."""
    sess = _param_int("ga_session_id")
    first = F.get(F.col("items"), 0)
    ts = F.expr("timestampadd(MICROSECOND, event_timestamp, TIMESTAMP_NTZ'1970-01-01 00:00:00')")
    return export.select(
        F.md5(
            F.concat(
                F.col("user_pseudo_id"),
                F.col("event_timestamp").cast("string"),
                F.col("event_name"),
                F.coalesce(sess.cast("string"), F.lit("")),
            )
        ).alias("event_id"),
        ts.alias("event_timestamp"),
        F.to_date(F.col("event_date"), "yyyyMMdd").alias("event_date"),
        "event_name",
        "user_pseudo_id",
        F.col("user_id").alias("customer_id"),
        sess.alias("ga_session_id"),
        F.col("device.category").alias("device_category"),
        F.col("geo.country").alias("country"),
        F.col("traffic_source.name").alias("campaign_id"),
        F.col("traffic_source.source").alias("traffic_source"),
        F.col("traffic_source.medium").alias("traffic_medium"),
        first["item_id"].alias("item_id"),
        first["item_category"].alias("item_category"),
        first["item_name"].alias("item_name"),
        _items_quantity().alias("quantity"),
        F.col("ecommerce.purchase_revenue_in_usd").alias("purchase_revenue"),
    )


def stg_events_ga4(export: DataFrame, strict: bool = False) -> DataFrame:
    """Warehouse staging model: flatten, validate, de-duplicate on the surrogate id."""
    return dedup_first(flatten_ga4(export).filter(is_valid(strict)))


def ga4_rejected(export: DataFrame, strict: bool = True) -> DataFrame:
    """Quarantine of the nested export: flattened rows that fail validation, with the reason."""
    return flatten_ga4(export).filter(is_rejected(strict)).withColumn("reject_reason", reject_reason(strict))
