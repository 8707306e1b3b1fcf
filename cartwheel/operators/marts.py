"""Decision marts over sessions / events.

Joins are written without hints: both sides are aggregates keyed on the join
key, so sort-merge needs no extra exchange, and AQE switches to a broadcast
at runtime when a side is measured small. Only provably one-row frames are
broadcast explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.functions import MONEY, day_diff, flag, money, round_half_up, safe_div, week_diff


def _dec_sum(c: str):
    return F.sum(money(c)).cast("double")


# ----------------------------------------------------------------- M6 customer features
def mart_customer_features(sessions: DataFrame) -> DataFrame:
    """RFM-style features per user; recency against the data's last session date.

    Two decomposable levels: (user, campaign) then user. The most frequent
    campaign (lowest id on ties, trap T3) is a ``min_by`` over
    (-sessions, campaign) at the second level, so no per-user buffer grows
    with the user's history and a hot user is combined map-side at both levels.
    """
    as_of = sessions.agg(F.max("session_date")).scalar()  # one value, uncorrelated subquery
    per_campaign = sessions.groupBy("user_pseudo_id", "campaign_id").agg(
        F.max("customer_id").alias("customer_id"),
        F.min("device_category").alias("device_category"),
        F.min("country").alias("country"),
        F.count(F.lit(1)).alias("sessions"),
        F.sum("did_purchase").cast("bigint").alias("purchasing_sessions"),
        F.sum("did_add_to_cart").cast("bigint").alias("cart_sessions"),
        F.sum(money("revenue")).alias("monetary"),
        F.sum("event_count").cast("bigint").alias("total_events"),
        F.max("products_viewed").alias("max_products_viewed"),
        F.min("session_date").alias("first_seen"),
        F.max("session_date").alias("last_seen"),
    )
    rank_key = F.struct((-F.col("sessions")).alias("neg_sessions"), F.col("campaign_id").alias("campaign_id"))
    a = per_campaign.groupBy("user_pseudo_id").agg(
        F.max("customer_id").alias("customer_id"),
        F.min("device_category").alias("device_category"),
        F.min("country").alias("country"),
        F.min_by(F.col("campaign_id"), F.when(F.col("campaign_id").isNotNull(), rank_key)).alias("primary_campaign"),
        F.sum("sessions").alias("sessions"),
        F.sum("purchasing_sessions").cast("bigint").alias("purchasing_sessions"),
        F.sum("cart_sessions").cast("bigint").alias("cart_sessions"),
        F.sum("monetary").cast("double").alias("monetary"),
        F.sum("total_events").cast("bigint").alias("total_events"),
        F.max("max_products_viewed").alias("max_products_viewed"),
        F.min("first_seen").alias("first_seen"),
        F.max("last_seen").alias("last_seen"),
    ).withColumn("as_of_date", as_of)
    return a.select(
        "user_pseudo_id",
        "customer_id",
        F.col("customer_id").isNotNull().alias("is_known_customer"),
        "device_category",
        "country",
        "primary_campaign",
        "sessions",
        "purchasing_sessions",
        day_diff("last_seen", "as_of_date").alias("recency_days"),
        "monetary",
        "total_events",
        F.when(F.col("purchasing_sessions") > 0, F.col("monetary") / F.col("purchasing_sessions"))
        .otherwise(F.lit(0.0))
        .alias("avg_order_value"),
        F.when(F.col("sessions") > 0, F.col("purchasing_sessions").cast("double") / F.col("sessions"))
        .otherwise(F.lit(0.0))
        .alias("conversion_rate"),
        F.when(
            F.col("cart_sessions") > 0,
            F.lit(1.0) - F.col("purchasing_sessions").cast("double") / F.col("cart_sessions"),
        )
        .otherwise(F.lit(0.0))
        .alias("funnel_abandon_rate"),
        day_diff("first_seen", "last_seen").alias("tenure_days"),
        (F.col("monetary") > 0).alias("has_purchased"),
    )


# ----------------------------------------------------------------- M7 funnel
FUNNEL_STAGES = ["view_item", "add_to_cart", "begin_checkout", "purchase"]


def mart_funnel(sessions: DataFrame, total_label: str = "ALL", ordered: bool = True) -> DataFrame:
    """Stage counts and rates per traffic source plus a grand-total row.

    The total is summed from the group totals (not a second pass over sessions),
    and is a UNION rather than ``rollup`` so empty input still yields the
    total row (trap T6).
    """
    per_source = sessions.groupBy("traffic_source").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("did_view").cast("bigint").alias("view_item"),
        F.sum("did_add_to_cart").cast("bigint").alias("add_to_cart"),
        F.sum("did_checkout").cast("bigint").alias("begin_checkout"),
        F.sum("did_purchase").cast("bigint").alias("purchase"),
        _dec_sum("revenue").alias("revenue"),
    )
    total = per_source.agg(
        F.lit(total_label).alias("traffic_source"),
        F.sum("sessions").cast("bigint").alias("sessions"),
        *[F.sum(s).cast("bigint").alias(s) for s in FUNNEL_STAGES],
        _dec_sum("revenue").alias("revenue"),
    )
    u = per_source.unionByName(total)
    out = u.select(
        "traffic_source",
        "sessions",
        *FUNNEL_STAGES,
        "revenue",
        round_half_up(safe_div("view_item", "sessions"), 4).alias("view_rate"),
        round_half_up(safe_div("add_to_cart", "view_item"), 4).alias("view_to_cart_rate"),
        round_half_up(safe_div("begin_checkout", "add_to_cart"), 4).alias("cart_to_checkout_rate"),
        round_half_up(safe_div("purchase", "begin_checkout"), 4).alias("checkout_to_purchase_rate"),
        round_half_up(safe_div("purchase", "sessions"), 4).alias("overall_conversion_rate"),
    )
    if ordered:
        out = out.orderBy((F.col("traffic_source") == total_label).asc_nulls_last(), F.desc("sessions"))
    return out


# ----------------------------------------------------------------- M8 campaign efficiency
def spend_by_campaign(spend: DataFrame) -> DataFrame:
    return spend.groupBy("campaign_id").agg(
        F.min("channel").alias("channel"),
        _dec_sum("cost").alias("spend"),
        F.sum("impressions").cast("bigint").alias("impressions"),
        F.sum("clicks").cast("bigint").alias("clicks"),
    )


def mart_campaign_efficiency(sessions: DataFrame, spend: DataFrame, ordered: bool = True) -> DataFrame:
    """Conversion, CAC, ROAS per campaign. Campaigns without sessions drop;
    campaigns without spend get NULL money metrics; zero spend gives NULL ROAS."""
    campaign_cost = spend_by_campaign(spend)
    campaign_sessions = sessions.groupBy("campaign_id").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.sum("did_purchase").cast("bigint").alias("buyers"),
        _dec_sum("revenue").alias("revenue"),
        F.count_distinct("user_pseudo_id").alias("users"),
    )
    j = campaign_sessions.join(campaign_cost, "campaign_id", "left")
    out = j.select(
        "campaign_id",
        "channel",
        "spend",
        "sessions",
        "users",
        "buyers",
        "revenue",
        round_half_up(safe_div("buyers", "sessions"), 4).alias("conversion_rate"),
        round_half_up(safe_div("spend", "buyers"), 2).alias("cac"),
        round_half_up(safe_div("revenue", "spend"), 2).alias("roas"),
        round_half_up(safe_div("spend", "sessions"), 3).alias("cost_per_session"),
        round_half_up(safe_div("revenue", "buyers"), 2).alias("revenue_per_buyer"),
    )
    return out.orderBy(F.desc("revenue")) if ordered else out


# ----------------------------------------------------------------- M9 product affinity
def mart_product_affinity(
    events: DataFrame, min_views: int = 300, max_purchase_rate: float = 0.05, ordered: bool = True
) -> DataFrame:
    """View / cart / purchase efficiency per item with an under-performer flag."""
    ev = events.filter(F.col("item_id").isNotNull())
    is_ = lambda n: F.col("event_name") == n
    per_item = ev.groupBy("item_id").agg(
        F.min("item_name").alias("item_name"),
        F.min("item_category").alias("item_category"),
        F.sum(flag(is_("view_item"))).cast("bigint").alias("views"),
        F.sum(flag(is_("add_to_cart"))).cast("bigint").alias("carts"),
        F.sum(flag(is_("purchase"))).cast("bigint").alias("purchases"),
        F.coalesce(F.sum(F.when(is_("purchase"), money("purchase_revenue"))).cast("double"), F.lit(0.0)).alias(
            "revenue"
        ),
    )
    out = per_item.select(
        "item_id",
        "item_name",
        "item_category",
        "views",
        "carts",
        "purchases",
        "revenue",
        round_half_up(safe_div("purchases", "views"), 4).alias("view_to_purchase_rate"),
        round_half_up(safe_div("carts", "views"), 4).alias("view_to_cart_rate"),
        ((F.col("views") >= min_views) & (safe_div("purchases", "views") < max_purchase_rate)).alias(
            "is_showcase_underperformer"
        ),
    )
    return out.orderBy(F.desc("views")) if ordered else out


# ----------------------------------------------------------------- M10 cohort retention
def mart_cohort_retention(
    sessions: DataFrame, crm: DataFrame, max_week: int = 12, calendar_weeks: bool = False, ordered: bool = True
) -> DataFrame:
    """Weekly signup-cohort retention (weeks 0..max_week) of known customers.

    Sessions are first reduced to distinct (customer, day) pairs, which bounds
    a hot customer to one row per day before the join with the CRM table.
    """
    signups = crm.select("customer_id", "signup_date", F.trunc("signup_date", "week").alias("cohort_week"))
    days = sessions.filter(F.col("customer_id").isNotNull()).select("customer_id", "session_date").distinct()
    active = (
        days.join(signups, "customer_id")
        .filter(F.col("session_date") >= F.col("signup_date"))
        .select(
            "customer_id",
            "cohort_week",
            week_diff("signup_date", "session_date", calendar_weeks).alias("weeks_since_signup"),
        )
        .filter(F.col("weeks_since_signup").between(0, max_week))
    )
    cohort_sizes = signups.groupBy("cohort_week").agg(F.count(F.lit(1)).alias("cohort_size"))
    retained = active.groupBy("cohort_week", "weeks_since_signup").agg(
        F.count_distinct("customer_id").alias("retained_customers")
    )
    out = retained.join(cohort_sizes, "cohort_week").select(
        "cohort_week",
        "cohort_size",
        "weeks_since_signup",
        "retained_customers",
        round_half_up(F.col("retained_customers").cast("double") / F.col("cohort_size"), 4).alias("retention_rate"),
    )
    return out.orderBy("cohort_week", "weeks_since_signup") if ordered else out


# ----------------------------------------------------------------- M12 event-grain campaign view
def campaign_efficiency_events(events: DataFrame, spend: DataFrame, ordered: bool = True) -> DataFrame:
    """Event-grain campaign efficiency (warehouse variant).

    ``count(DISTINCT session)`` and the conditional distinct count of buying
    sessions are computed exactly as a two-level aggregate (campaign, session)
    -> campaign, which avoids Catalyst's Expand for two distinct aggregates.
    """
    is_buy = F.col("event_name") == "purchase"
    per_session = events.groupBy("campaign_id", "ga_session_id").agg(
        F.max(flag(is_buy)).alias("_buy"),
        F.sum(F.when(is_buy, money("purchase_revenue")).otherwise(F.lit(0).cast(MONEY))).alias("_rev"),
    )
    by_campaign = per_session.groupBy("campaign_id").agg(
        F.count("ga_session_id").alias("sessions"),
        F.count(F.when((F.col("_buy") == 1) & F.col("ga_session_id").isNotNull(), F.lit(1))).alias("buyers"),
        F.sum("_rev").cast("double").alias("revenue"),
    )
    cost = spend.groupBy("campaign_id").agg(_dec_sum("cost").alias("spend"))
    out = by_campaign.join(cost, "campaign_id", "left").select(
        "campaign_id",
        "spend",
        "sessions",
        "buyers",
        "revenue",
        round_half_up(safe_div("buyers", "sessions"), 4).alias("conversion_rate"),
        round_half_up(safe_div("spend", "buyers"), 2).alias("cac"),
        round_half_up(safe_div("revenue", "spend"), 2).alias("roas"),
    )
    return out.orderBy(F.desc("revenue")) if ordered else out


# ----------------------------------------------------------------- M13 remarketing audience
def remarketing_audience(scores: DataFrame, min_decile: int = 9) -> DataFrame:
    """Users in the top decile(s) of the propensity table (``decile`` is 0..10)."""
    return scores.filter(F.col("decile") >= min_decile).select("entity_id", "as_of_date", "propensity", "decile")
