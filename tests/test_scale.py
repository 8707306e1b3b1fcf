"""Plan shape and hot-key behaviour (what must hold at 100 TB, checked on small data)."""

from __future__ import annotations

import contextlib
import io
from datetime import datetime, timedelta

import pytest

from cartwheel.operators import marts, sessions, staging
from cartwheel.plans import catalog
from conftest import SF_SMALL, raw_row

# plans are built once per query; model queries fit a model while being built
MODEL_QUERIES = {"propensity_scores", "feature_weights", "model_metrics", "remarketing_audience", "roc_auc_improvement"}
PLAN_QUERIES = sorted(set(catalog.QUERIES) - MODEL_QUERIES)


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", PLAN_QUERIES)
def test_no_pairwise_join_and_no_python_worker(spark, name):
    plan = _plan(catalog.QUERIES[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow"):
        assert bad not in plan, f"{name}: {bad}"


def test_dedup_limits_before_the_shuffle(spark):
    plan = _plan(catalog.QUERIES["stg_events"](spark, SF_SMALL))
    partial = plan.index("WindowGroupLimit")
    # the formatted plan lists operators bottom-up in its detail section; the
    # partial limit must appear together with an exchange on event_id
    assert "Partial" in plan[partial:] and "hashpartitioning(event_id" in plan


def test_sessions_aggregate_partially_before_the_shuffle(spark):
    plan = _plan(catalog.QUERIES["int_sessions"](spark, SF_SMALL))
    assert "partial_count" in plan and "partial_max" in plan


def test_driver_scans_read_only_needed_columns(spark):
    from cartwheel.sources import fixtures

    plan = _plan(fixtures.raw_crm_customers(spark, SF_SMALL))
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int,c_mktsegment:string>" in plan


def test_marts_prune_raw_columns_through_the_dedup(spark):
    plan = _plan(catalog.QUERIES["mart_funnel"](spark, SF_SMALL))
    reads = [line for line in plan.splitlines() if "ReadSchema" in line and "event_id" in line]
    assert reads and all("item_name" not in line and "country" not in line for line in reads)


def test_hot_keys_stay_exact(make_raw):
    base = datetime(2024, 1, 5, 8)
    hot_copies = [raw_row(event_id="hot", event_timestamp=base + timedelta(minutes=i), item_id=f"h{i}") for i in range(60)]
    hot_session = [
        raw_row(event_id=f"s{i}", ga_session_id="big", user_pseudo_id="whale", campaign_id=f"cmp_{i % 3}",
                event_timestamp=base + timedelta(seconds=i), event_name="view_item", item_id=f"p{i % 7}")
        for i in range(60)
    ]
    other = [raw_row(event_id=f"o{i}", ga_session_id=f"g{i}", user_pseudo_id=f"u{i}") for i in range(60)]
    ev = staging.stg_events(make_raw(hot_copies + hot_session + other))
    kept = [r for r in ev.collect() if r.event_id == "hot"]
    assert len(kept) == 1 and kept[0].item_id == "h0"
    s = {r.ga_session_id: r for r in sessions.int_sessions(ev).collect()}
    assert s["big"].event_count == 60 and s["big"].products_viewed == 7
    cf = {r.user_pseudo_id: r for r in marts.mart_customer_features(sessions.int_sessions(ev)).collect()}
    assert cf["whale"].sessions == 1 and cf["whale"].total_events == 60


def test_a_bucketed_layer_needs_no_exchange_on_its_key(spark):
    plan = _plan(catalog.QUERIES["mart_funnel_bucketed"](spark, SF_SMALL))
    assert "hashpartitioning(ga_session_id" not in plan and "Bucketed: true" in plan
    plan = _plan(catalog.QUERIES["mart_customer_features_bucketed"](spark, SF_SMALL))
    assert "hashpartitioning(user_pseudo_id" not in plan and "Bucketed: true" in plan


def test_a_layer_with_a_hot_key_is_not_bucketed(spark):
    from cartwheel.sources import sinks

    even = spark.range(4000).selectExpr("id % 500 AS k", "id AS v")
    hot = spark.range(4000).selectExpr("if(id % 3 = 0, 7, id) AS k", "id AS v")
    assert "Bucketed: true" in _plan(sinks.write_bucketed(even, "even", "k").groupBy("k").count())
    assert sinks.write_bucketed(hot, "hot", "k") is hot
    assert sinks.write_bucketed(even.limit(0), "none", "k").count() == 0
