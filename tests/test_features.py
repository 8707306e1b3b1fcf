"""Point-in-time feature store (FIXTURES 4.9-4.11, spec validation)."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import staging
from cartwheel.plans import features as feat
from conftest import raw_row

SPEC = feat.FeatureSpec(
    entity="user_pseudo_id",
    cutoffs=("2024-01-10",),
    label=feat.Label("bought_next_1d", "purchase", 1),
    features=(
        feat.Feature("events_7d", "count", 7),
        feat.Feature("sessions_7d", "count_distinct", 7, column="ga_session_id"),
        feat.Feature("rev_7d", "sum", 7, column="purchase_revenue", filter="event_name = 'purchase'"),
        feat.Feature("recency", "recency", 90),
    ),
)
HI = datetime(2024, 1, 10, 23, 59, 59)


def _ev(i, ts, user="u1", name="view_item", rev=None):
    return raw_row(event_id=f"e{i}", event_timestamp=ts, event_date=ts.date(), user_pseudo_id=user,
                   event_name=name, ga_session_id=f"{user}.{ts.date()}", purchase_revenue=rev)


def _store(make_raw, rows, spec=SPEC):
    ev = staging.stg_events(make_raw(rows))
    return {r.entity_id: r for r in feat.build_feature_store(ev, spec).collect()}


def test_window_edges_and_label_second(make_raw):
    rows = [
        _ev(1, HI),  # at the cutoff: feature
        _ev(2, HI + timedelta(microseconds=500_000), name="purchase", rev=3.0),  # in the last second: label
        _ev(3, HI - timedelta(days=7)),  # exactly 7 days before: excluded
        _ev(4, HI - timedelta(days=7) + timedelta(microseconds=1)),  # just inside
    ]
    r = _store(make_raw, rows)["u1"]
    assert r.events_7d == 2 and r.rev_7d == 0.0 and r.bought_next_1d == 1
    assert r.as_of_date == date(2024, 1, 10) and r.recency == 0


def test_future_events_do_not_change_features(make_raw):
    past = [_ev(1, HI - timedelta(days=1)), _ev(2, HI - timedelta(days=3), name="purchase", rev=4.0)]
    future = [_ev(9, HI + timedelta(days=3), name="purchase", rev=99.0), _ev(8, HI + timedelta(hours=2))]
    a = _store(make_raw, past)["u1"]
    b = _store(make_raw, past + future)["u1"]
    names = [f.name for f in SPEC.features]
    assert [a[n] for n in names] == [b[n] for n in names]
    assert a.bought_next_1d == 0 and b.bought_next_1d == 0  # the purchase is 3 days out, beyond the horizon
    c = _store(make_raw, past + [_ev(7, HI + timedelta(hours=5), name="purchase", rev=1.0)])["u1"]
    assert c.bought_next_1d == 1


def test_old_entity_gets_defaults_and_new_entity_is_absent(make_raw):
    rows = [_ev(1, HI - timedelta(days=200), user="old"), _ev(2, HI + timedelta(hours=1), user="new")]
    s = _store(make_raw, rows)
    assert set(s) == {"old"}
    assert s["old"].recency == 999 and s["old"].events_7d == 0 and s["old"].sessions_7d == 0


def test_spec_validation():
    with pytest.raises(ValueError, match="unknown aggregation"):
        feat.Feature("x", "median", 7).validate()
    with pytest.raises(ValueError, match="needs a column"):
        feat.Feature("x", "sum", 7).validate()
    spec = feat.load_spec()
    assert len(spec.features) == 9 and spec.label.horizon_days == 1


def test_shipped_store_has_no_leakage(spark):
    from cartwheel.plans.models import Models

    store = feat.build_feature_store(Models(spark, "/root/testdata/sf0.001").stg_events, audit=True)
    assert feat.leakage_violations(store).first().violations == 0
    rep = {r.as_of_date: r for r in feat.feature_store_report(store, "purchased_next_1d").collect()}
    assert len(rep) == 3 and all(r.rows > 0 for r in rep.values())


def test_planted_leak_is_seen(spark):
    from cartwheel.plans.models import Models

    store = feat.build_feature_store(Models(spark, "/root/testdata/sf0.001").stg_events, audit=True)
    cutoff = F.timestamp_add("SECOND", F.lit(86_399), F.col("as_of_date").cast("timestamp_ntz"))
    at, past = cutoff, F.timestamp_add("MICROSECOND", F.lit(1), cutoff)
    n = store.count()
    assert feat.leakage_violations(store.withColumn("newest_event_ts", at)).first().violations == 0
    assert feat.leakage_violations(store.withColumn("newest_event_ts", past)).first().violations == n


def test_sums_and_distinct_keys_do_not_depend_on_order_or_cutoffs(make_raw):
    spec = feat.FeatureSpec(
        entity="user_pseudo_id", cutoffs=("2024-01-10",), label=feat.Label("y", "purchase", 1),
        features=(feat.Feature("s", "sum", 30, column="purchase_revenue"), feat.Feature("d", "count_distinct", 30, column="purchase_revenue")),
    )
    rows = [_ev(i, HI - timedelta(days=i), name="view_item", rev=v) for i, v in enumerate((0.1, 0.2, 0.3, 1e16, -1e16, 0.0, -0.0))]
    for cutoffs in (spec.cutoffs, tuple(str(date(2024, 1, 10) + timedelta(days=7 * i)) for i in range(20))):
        many = feat.FeatureSpec(spec.entity, cutoffs, spec.label, spec.features)
        for order in (rows, rows[::-1]):
            ev = staging.stg_events(make_raw(order))
            r = next(x for x in feat.build_feature_store(ev, many).collect() if str(x.as_of_date) == "2024-01-10")
            assert (r.s, r.d) == (0.6, 6)


def _history(n_days=30, users=4):
    """A few events a day of every user, with repeats of sessions and items between days."""
    rows, i = [], 0
    for d in range(n_days):
        for u in range(users):
            for k in range((d * 7 + u) % 3):
                i += 1
                name = ("view_item", "purchase", "add_to_cart")[(d + k) % 3]
                r = _ev(i, datetime(2024, 1, 1, 8 + k) + timedelta(days=d), f"u{u}", name, 2.5 if name == "purchase" else None)
                rows.append({**r, "ga_session_id": f"u{u}.{(d + k) % 5}"})
    return rows


WIDE = feat.FeatureSpec(
    entity="user_pseudo_id", cutoffs=("2024-01-12", "2024-01-20"), label=feat.Label("y", "purchase", 3),
    features=(
        *SPEC.features,
        feat.Feature("bought_sessions_14d", "count_distinct", 14, column="ga_session_id", filter="event_name = 'purchase'"),
        feat.Feature("avg_rev_9d", "avg", 9, column="purchase_revenue"),
    ),
)


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_state_grown_by_days_equals_a_full_run(spark, make_raw, tmp_path):
    from dataclasses import replace

    events = staging.stg_events(make_raw(_history()))
    root = str(tmp_path)
    early = events.filter("event_timestamp <= TIMESTAMP_NTZ'2024-01-13 23:59:59'")
    feat.update_state(early, WIDE, root)
    # old events that change later are not read again
    changed = events.withColumn("ga_session_id", F.when(F.col("event_date") < "2024-01-10", F.concat("event_id", F.lit("x"))).otherwise(F.col("ga_session_id")))
    state = feat.update_state(changed, WIDE, root)
    assert _rows(feat.store_from_state(state, WIDE)) == _rows(feat.build_feature_store(events, WIDE))
    # a further cutoff needs the state only, and running a step twice changes nothing
    more = replace(WIDE, cutoffs=(*WIDE.cutoffs, "2024-01-25", "2024-01-26"))
    state = feat.update_state(changed, more, root)
    assert _rows(feat.store_from_state(state, more)) == _rows(feat.build_feature_store(events, more))
    # days named to be redone are read again
    redone = feat.update_state(changed, WIDE, root, redo=[date(2024, 1, d) for d in range(1, 10)])
    assert _rows(feat.store_from_state(redone, WIDE)) == _rows(feat.build_feature_store(changed, WIDE))


def test_the_store_reads_events_once_and_repeats_no_rows_per_cutoff(spark, make_raw):
    from dataclasses import replace

    events = staging.stg_events(make_raw(_history(40)))
    state = feat.daily_state(events, WIDE)
    plan = state._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
    many = replace(WIDE, cutoffs=tuple(str(date(2024, 1, 5) + timedelta(days=d)) for d in range(30)))
    few, lots = (feat._changes(state, s, ["_lab", "_ts", *[f"_f{i}" for i in range(6)], "_n5"]).count() for s in (WIDE, many))
    assert few == lots
    assert len(_rows(feat.build_feature_store(events, many))) == sum(1 for _ in range(30)) * 4
