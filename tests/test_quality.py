"""Check runner: every type passes/fails, NULL and empty edges, errors, score, audit (FIXTURES 4.13-4.14)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cartwheel.operators import quality as q

SCHEMA = "id string, d date, v double, cat string"


@pytest.fixture
def tables(spark):
    t = spark.createDataFrame(
        [("a", "2024-01-30", 1.0, "x"), ("b", "2024-01-29", None, "y"), ("b", "2024-01-29", 3.0, None)],
        "id string, d string, v double, cat string",
    ).withColumn("d", F.to_date("d"))
    empty = t.filter(F.lit(False))
    ref = spark.createDataFrame([("a",), ("c",)], "id string")
    return {"t": t, "empty": empty, "ref": ref, "rej": t.limit(1), "raw": t}


def _run(spark, tables, *checks):
    res = q.check_results(spark, [q.Check.from_dict(c) for c in checks], tables, "2024-01-31")
    return {r.check_name: r for r in res.collect()}


def test_each_type_pass_and_fail(spark, tables):
    r = _run(
        spark,
        tables,
        dict(name="rc_ok", type="row_count_min", table="t", min=3),
        dict(name="rc_bad", type="row_count_min", table="t", min=4),
        dict(name="fresh_ok", type="freshness", table="t", column="d", max_days=1),
        dict(name="fresh_bad", type="freshness", table="t", column="d", max_days=0),
        dict(name="nn_bad", type="not_null", table="t", column="v", max_null_rate=0.0),
        dict(name="uniq_bad", type="unique", table="t", column="id"),
        dict(name="acc_ok", type="accepted_values", table="t", column="cat", values=["x", "y"]),
        dict(name="min_ok", type="min_value", table="t", column="v", min=0),
        dict(name="rng_bad", type="range_agg", table="t", expr="max(v)", min=0, max=2),
        dict(name="rec_bad", type="reconcile_count", table="t", source_table="t", source_expr="count(DISTINCT id)"),
        dict(name="rel_bad", type="relationship", table="t", column="id", to_table="ref", to_column="id"),
        dict(name="qr_bad", type="quarantine_rate", rejected_table="rej", raw_table="raw", max_rate=0.1),
    )
    st = {k: v.status for k, v in r.items()}
    assert st == {
        "rc_ok": "pass", "rc_bad": "fail", "fresh_ok": "pass", "fresh_bad": "fail", "nn_bad": "fail",
        "uniq_bad": "fail", "acc_ok": "pass", "min_ok": "pass", "rng_bad": "fail", "rec_bad": "fail",
        "rel_bad": "fail", "qr_bad": "fail",
    }
    assert r["nn_bad"].observed == pytest.approx(1 / 3)
    assert r["rel_bad"].observed == 2.0  # both "b" rows are orphans
    assert r["rng_bad"].threshold == 2.0  # only the max is stored


def test_null_and_empty_edges(spark, tables):
    r = _run(
        spark,
        tables,
        dict(name="nn_empty", type="not_null", table="empty", column="v", max_null_rate=0.0),
        dict(name="min_empty", type="min_value", table="empty", column="v", min=0),
        dict(name="rng_empty", type="range_agg", table="empty", expr="max(v)", min=0, max=2),
        dict(name="fresh_empty", type="freshness", table="empty", column="d", max_days=2),
        dict(name="qr_empty", type="quarantine_rate", rejected_table="empty", raw_table="empty", max_rate=0.0),
    )
    assert r["nn_empty"].status == "pass" and r["nn_empty"].observed == 0.0
    assert r["min_empty"].status == "pass"  # NULL minimum passes
    assert r["rng_empty"].status == "fail"  # NULL aggregate fails
    assert r["fresh_empty"].status == "error" and r["fresh_empty"].error
    assert r["qr_empty"].status == "pass" and r["qr_empty"].observed == 0.0


def test_errors_do_not_stop_the_run(spark, tables):
    r = _run(
        spark,
        tables,
        dict(name="unknown", type="telepathy", table="t"),
        dict(name="missing_table", type="row_count_min", table="nope", min=1),
        dict(name="missing_col", type="not_null", table="t", column="nope", max_null_rate=0.0),
        dict(name="fine", type="row_count_min", table="t", min=1),
    )
    assert {k: v.status for k, v in r.items()} == {
        "unknown": "error", "missing_table": "error", "missing_col": "error", "fine": "pass"
    }
    assert "unknown check type" in r["unknown"].error


def test_score_weights_and_gate(spark, tables):
    checks = [
        dict(name="c1", type="row_count_min", table="t", min=99, severity="critical"),
        dict(name="h1", type="row_count_min", table="t", min=1, severity="high"),
        dict(name="m1", type="row_count_min", table="t", min=1),
        dict(name="l1", type="row_count_min", table="t", min=1, severity="low"),
    ]
    res = q.check_results(spark, [q.Check.from_dict(c) for c in checks], tables, "2024-01-31")
    s = q.quality_score(res).first()
    assert s.quality_score == 60.0 and s.critical_failures == 1 and s.checks_passed == 3
    with pytest.raises(q.QualityGateError):
        q.gate(s)


def test_row_returning_assertions(spark, tables):
    t = tables["t"]
    assert sorted(r.id for r in q.assert_unique_rows(t, ["id"]).collect()) == ["b", "b"]
    assert [r.id for r in q.assert_non_null_rows(t, ["v", "cat"]).collect()] == ["b", "b"]
    bad = q.assert_row_conditions(t, ["v >= 2", "cat IN ('x')"]).collect()
    assert sorted((r.id, r.failed_condition) for r in bad) == [
        ("a", "v >= 2"), ("b", "cat IN ('x')")
    ]  # NULL v and NULL cat do not fail


def test_unique_assertion_with_a_hot_key(spark):
    rows = [("hot", i) for i in range(400)] + [("a", 1), ("a", 2), ("b", 3)] + [(f"u{i}", i) for i in range(200)]
    df = spark.createDataFrame(rows, "id string, v int")
    got = q.assert_unique_rows(df, ["id"], hot_fraction=0.1).collect()
    assert len(got) == 402 and {r.id for r in got} == {"hot", "a"}


def test_quarantine_rate_reads_a_raw_parquet_glob(spark, tables, tmp_path):
    path = str(tmp_path / "raw")
    tables["raw"].write.parquet(path)
    r = _run(spark, tables, dict(name="qr", type="quarantine_rate", rejected_table="rej", raw_glob=path, max_rate=0.5))
    assert r["qr"].status == "pass" and r["qr"].observed == pytest.approx(1 / 3)
