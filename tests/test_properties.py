"""Property tests on random raw frames."""

from __future__ import annotations

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cartwheel.operators import marts, sessions, staging
from conftest import raw_row

NAMES = [None, "session_start", "view_item", "add_to_cart", "begin_checkout", "purchase"]

row = st.fixed_dictionaries(
    {
        "event_id": st.sampled_from([f"e{i}" for i in range(12)]),
        "minute": st.integers(0, 3000),
        "event_name": st.sampled_from(NAMES),
        "user_pseudo_id": st.sampled_from([None, "u1", "u2", "u3"]),
        "purchase_revenue": st.sampled_from([None, -2.0, 0.0, 3.5, 10.0]),
        "traffic_source": st.sampled_from(["a", "b", "c"]),
    }
)


def _raw(make_raw, rows):
    base = datetime(2024, 1, 1)
    out = []
    for r in rows:
        ts = base + timedelta(minutes=r["minute"])
        out.append(
            raw_row(
                event_id=r["event_id"], event_timestamp=ts, event_date=ts.date(), event_name=r["event_name"],
                user_pseudo_id=r["user_pseudo_id"], purchase_revenue=r["purchase_revenue"],
                traffic_source=r["traffic_source"], ga_session_id=f"{r['user_pseudo_id']}.{ts.date()}",
            )
        )
    return make_raw(out)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=30))
def test_every_raw_row_is_accounted_for(make_raw, rows):
    raw = _raw(make_raw, rows)
    clean = staging.stg_events(raw).count()
    rejected = staging.stg_events_rejected(raw).count()
    # rows in neither table: NULL event name with NULL/non-positive revenue (trap T1)
    lost = raw.filter(~staging.is_valid() & ~staging.is_rejected()).count()
    lost_null = raw.filter("(user_pseudo_id IS NOT NULL) AND (event_name IS NULL) AND "
                           "(purchase_revenue IS NULL OR purchase_revenue <= 0)").count()
    valid_ids = raw.filter(staging.is_valid()).select("event_id").distinct().count()
    dups = raw.filter(staging.is_valid()).count() - valid_ids
    assert clean == valid_ids
    assert clean + rejected + lost_null + dups == raw.count()
    assert lost == 0  # the Column predicates never both evaluate to FALSE...
    # ...the lost rows are the ones where both predicates are NULL
    assert raw.filter(staging.is_valid().isNull() & staging.is_rejected().isNull()).count() == lost_null


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=30))
def test_funnel_total_equals_union_of_sources(make_raw, rows):
    s = sessions.int_sessions(staging.stg_events(_raw(make_raw, rows)))
    f = marts.mart_funnel(s, ordered=False).collect()
    total = [r for r in f if r.traffic_source == "ALL"]
    parts = [r for r in f if r.traffic_source != "ALL"]
    assert len(total) == 1
    if parts:
        for col in ("sessions", "view_item", "add_to_cart", "begin_checkout", "purchase"):
            assert total[0][col] == sum(r[col] for r in parts)
        assert abs(total[0].revenue - sum(r.revenue for r in parts)) < 1e-9


edge_row = st.fixed_dictionaries(
    {
        "event_id": st.integers(0, 10_000).map(lambda i: f"e{i}"),
        "day": st.integers(0, 40),
        # plain seconds of the day, or the last second of the day with a fraction
        "second": st.one_of(st.integers(0, 86_398), st.just(86_399)),
        "micros": st.sampled_from([0, 1, 500_000, 999_999]),
        "event_name": st.sampled_from(NAMES[1:]),
        "user_pseudo_id": st.sampled_from(["u1", "u2", "u3"]),
        "item": st.sampled_from([None, "p1", "p2"]),
        "purchase_revenue": st.sampled_from([None, 3.5, 10.0]),
    }
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(edge_row, min_size=1, max_size=40))
def test_feature_store_matches_its_definition_at_window_edges(make_raw, rows):
    from cartwheel.plans import features as feat

    base = datetime(2024, 1, 1)
    out = []
    for r in rows:
        ts = base + timedelta(days=r["day"], seconds=r["second"], microseconds=r["micros"])
        out.append(
            raw_row(
                event_id=r["event_id"], event_timestamp=ts, event_date=ts.date(), event_name=r["event_name"],
                user_pseudo_id=r["user_pseudo_id"], item_id=r["item"], ga_session_id=f"{r['user_pseudo_id']}.{ts.date()}",
                purchase_revenue=r["purchase_revenue"] if r["event_name"] == "purchase" else None,
            )
        )
    ev = staging.stg_events(make_raw(out))
    spec = feat.load_spec()
    store = {(r.entity_id, str(r.as_of_date)): r for r in feat.build_feature_store(ev, spec).collect()}
    events = ev.collect()
    for c in spec.cutoffs:  # window by window, straight from the definition
        hi = datetime.fromisoformat(c) + timedelta(hours=23, minutes=59, seconds=59)
        for user in {e.user_pseudo_id for e in events if e.event_timestamp <= hi}:
            own = [e for e in events if e.user_pseudo_id == user]
            within = lambda days: [e for e in own if hi - timedelta(days=days) < e.event_timestamp <= hi]
            r = store[(user, c)]
            assert r.events_last_7d == len(within(7))
            assert r.sessions_last_30d == len({e.ga_session_id for e in within(30)})
            assert r.views_last_14d == sum(e.event_name == "view_item" for e in within(14))
            assert r.purchased_next_1d == any(e.event_name == "purchase" and hi < e.event_timestamp <= hi + timedelta(days=1) for e in own)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=30, unique_by=lambda r: (r["event_id"], r["minute"])))
def test_staging_matches_the_sql_oracle_on_random_raw_frames(spark, make_raw, rows):
    """Random raw frames (NULL names and users, bad revenue, copies at different
    times) through Spark staging and through the oracle's staging SQL in DuckDB."""
    import duckdb

    from cartwheel import oracle

    raw = _raw(make_raw, rows)
    pdf = raw.toPandas()
    con = duckdb.connect()
    con.register("raw_events", pdf)
    sql = "WITH " + oracle.STAGING.strip().rstrip(",") + "\nSELECT event_id, event_timestamp, event_name, user_pseudo_id, purchase_revenue FROM stg_events"
    want = sorted(tuple(r) for r in con.execute(sql).fetchall())
    got = sorted(
        tuple(r) for r in staging.stg_events(raw).select("event_id", "event_timestamp", "event_name", "user_pseudo_id", "purchase_revenue").collect()
    )
    assert got == want
    rej_sql = "WITH " + oracle.STAGING.strip().rstrip(",") + "\nSELECT event_id, reject_reason FROM stg_events_rejected"
    assert sorted(con.execute(rej_sql).fetchall()) == sorted(
        tuple(r) for r in staging.stg_events_rejected(raw).select("event_id", "reject_reason").collect()
    )
