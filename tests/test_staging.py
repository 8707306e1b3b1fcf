"""Micro frames for the staging traps."""

from __future__ import annotations

from datetime import datetime

from cartwheel.operators import staging
from conftest import raw_row


def test_null_event_name_lands_in_neither_table(make_raw):
    raw = make_raw(
        [
            raw_row(event_id="a", event_name=None, purchase_revenue=None),
            raw_row(event_id="b", event_name=None, purchase_revenue=-1.0),
            raw_row(event_id="c", event_name=None, purchase_revenue=5.0),
        ]
    )
    clean = {r.event_id for r in staging.stg_events(raw).collect()}
    rej = {r.event_id for r in staging.stg_events_rejected(raw).collect()}
    # NOT (NULL AND ...) is NULL for a and b: neither valid nor rejected
    assert clean == {"c"} and rej == set()
    strict_clean = {r.event_id for r in staging.stg_events(raw, strict=True).collect()}
    strict_rej = {(r.event_id, r.reject_reason) for r in staging.stg_events_rejected(raw, strict=True).collect()}
    assert strict_clean == set()
    assert strict_rej == {("a", "null_event_name"), ("b", "null_event_name"), ("c", "null_event_name")}


def test_invalid_copy_never_shadows_valid_copy(make_raw):
    t0, t1 = datetime(2024, 1, 5, 9), datetime(2024, 1, 5, 10)
    raw = make_raw(
        [
            raw_row(event_id="p", event_timestamp=t0, event_name="purchase", purchase_revenue=-3.0),
            raw_row(event_id="p", event_timestamp=t1, event_name="purchase", purchase_revenue=7.0),
        ]
    )
    clean = staging.stg_events(raw).collect()
    assert [(r.event_id, r.purchase_revenue) for r in clean] == [("p", 7.0)]
    assert [r.reject_reason for r in staging.stg_events_rejected(raw).collect()] == ["non_positive_revenue"]


def test_dedup_keeps_earliest_and_null_time_last(make_raw):
    raw = make_raw(
        [
            raw_row(event_id="d", event_timestamp=None, item_id="x"),
            raw_row(event_id="d", event_timestamp=datetime(2024, 1, 5, 12), item_id="late"),
            raw_row(event_id="d", event_timestamp=datetime(2024, 1, 5, 8), item_id="early"),
        ]
    )
    assert [r.item_id for r in staging.stg_events(raw).collect()] == ["early"]


def test_null_user_reason_wins_over_revenue(make_raw):
    raw = make_raw([raw_row(event_id="r", user_pseudo_id=None, event_name="purchase", purchase_revenue=0.0)])
    assert [r.reject_reason for r in staging.stg_events_rejected(raw).collect()] == ["null_user_id"]


def test_quantity_rounds_not_truncates(make_raw):
    raw = make_raw([raw_row(event_id="q", quantity=1.7)])
    assert staging.stg_events(raw).first().quantity == 2


def test_ties_do_not_depend_on_input_order(make_raw):
    t = datetime(2024, 1, 5, 9)
    rows = [raw_row(event_id="t", event_timestamp=t, item_id=i) for i in ("b", "a", "c", "d")]
    kept = {staging.stg_events(make_raw(rows[k:] + rows[:k]).repartition(3)).first().item_id for k in range(4)}
    assert len(kept) == 1


def test_quantity_halves_round_to_even(make_raw):
    raw = make_raw([raw_row(event_id=f"q{q}", quantity=q) for q in (0.5, 1.5, 2.5, 3.5)])
    assert sorted(r.quantity for r in staging.stg_events(raw).collect()) == [0, 2, 2, 4]


def test_money_below_a_cent_is_kept(make_raw):
    from cartwheel.operators import sessions

    raw = make_raw([raw_row(event_id=f"p{i}", event_name="purchase", purchase_revenue=0.004) for i in range(1000)])
    assert sessions.int_sessions(staging.stg_events(raw)).first().revenue == 4.0


def test_a_missing_event_id_is_quarantined_when_strict(make_raw):
    raw = make_raw([raw_row(event_id=None), raw_row(event_id=None, item_id="prod_2"), raw_row(event_id="e1")])
    assert staging.stg_events(raw).count() == 2  # rows without an id count as copies of one event
    assert [r.event_id for r in staging.stg_events(raw, strict=True).collect()] == ["e1"]
    assert [r.reject_reason for r in staging.stg_events_rejected(raw, strict=True).collect()] == ["null_event_id"] * 2
