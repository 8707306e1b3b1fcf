"""Mart semantics on micro frames (FIXTURES 4.5-4.8)."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from cartwheel.operators import marts, sessions, staging
from cartwheel.schema import RAW_AD_SPEND, RAW_CRM
from conftest import raw_row


def _sessions(make_raw, rows):
    return sessions.int_sessions(staging.stg_events(make_raw(rows)))


def test_any_value_skips_null_and_mode_tie_takes_lowest(make_raw):
    rows = [
        raw_row(event_id="1", ga_session_id="s1", device_category=None, campaign_id="cmp_2"),
        raw_row(event_id="2", ga_session_id="s1", device_category="tablet", campaign_id="cmp_2"),
        raw_row(event_id="3", ga_session_id="s2", campaign_id="cmp_1"),
    ]
    s = _sessions(make_raw, rows)
    assert {r.ga_session_id: r.device_category for r in s.collect()}["s1"] == "tablet"
    cf = marts.mart_customer_features(s).first()
    assert cf.primary_campaign == "cmp_1"  # one session each: lowest id wins (T3)
    assert cf.sessions == 2


def test_cohort_weeks_are_whole_seven_day_spans(spark, make_raw):
    # signup on a Sunday; next day is a new calendar week but week 0 here (T4)
    signup = date(2024, 1, 7)
    crm = spark.createDataFrame([("c1", signup, "p", "r")], RAW_CRM)
    rows = [
        raw_row(event_id="a", customer_id="c1", ga_session_id="a", event_timestamp=datetime(2024, 1, 8, 9), event_date=date(2024, 1, 8)),
        raw_row(event_id="b", customer_id="c1", ga_session_id="b", event_timestamp=datetime(2024, 1, 14, 9), event_date=date(2024, 1, 14)),
        raw_row(event_id="c", customer_id="c1", ga_session_id="c", event_timestamp=datetime(2024, 4, 7, 9), event_date=date(2024, 4, 7)),
    ]
    out = marts.mart_cohort_retention(_sessions(make_raw, rows), staging.stg_crm_customers(crm)).collect()
    assert [(r.cohort_week, r.weeks_since_signup, r.retained_customers) for r in out] == [
        (date(2024, 1, 1), 0, 1),
        (date(2024, 1, 1), 1, 1),
    ]


def test_campaign_without_spend_and_zero_spend(spark, make_raw):
    rows = [
        raw_row(event_id="1", ga_session_id="s1", campaign_id="cmp_a", event_name="purchase", purchase_revenue=10.0),
        raw_row(event_id="2", ga_session_id="s2", campaign_id="cmp_b"),
    ]
    spend = spark.createDataFrame(
        [(date(2024, 1, 5), "cmp_a", "ch", "src", 10, 1, 0.0), (date(2024, 1, 5), "cmp_z", "ch", "src", 10, 1, 5.0)],
        RAW_AD_SPEND,
    )
    out = {r.campaign_id: r for r in marts.mart_campaign_efficiency(_sessions(make_raw, rows), staging.stg_ad_spend(spend)).collect()}
    assert set(out) == {"cmp_a", "cmp_b"}  # spend without sessions drops
    assert out["cmp_a"].roas is None and out["cmp_a"].cac == 0.0  # zero spend -> NULL ROAS
    assert out["cmp_b"].spend is None and out["cmp_b"].cac is None


def test_funnel_total_row_on_empty_input(make_raw):
    s = _sessions(make_raw, [raw_row(event_id="1")]).filter(F.lit(False))
    out = marts.mart_funnel(s).collect()
    assert len(out) == 1 and out[0].traffic_source == "ALL" and out[0].sessions is None


def test_funnel_total_is_sum_of_sources(spark):
    from cartwheel.plans.models import Models

    f = Models(spark, "/root/testdata/sf0.001").mart_funnel.collect()
    total = [r for r in f if r.traffic_source == "ALL"][0]
    assert total.sessions == sum(r.sessions for r in f if r.traffic_source != "ALL")
    assert f[-1].traffic_source == "ALL"


def test_models_are_queryable_with_sql(spark):
    from cartwheel.plans.models import Models

    Models(spark, "/root/testdata/sf0.001").register_views()
    out = spark.sql(
        "SELECT traffic_source, sessions FROM mart_funnel WHERE traffic_source = 'ALL'"
    ).collect()
    total = spark.sql("SELECT count(*) AS n FROM int_sessions").first().n
    assert out[0].sessions == total
