"""Run ledger and trend queries on small ledger / audit frames."""

from __future__ import annotations

from datetime import datetime

from cartwheel.operators import ledger


def test_latency_index_rule(spark):
    secs = [0.5, 0.1, 0.3, 0.2, 0.4, 0.9, 0.6, 0.7, 0.8, 1.0]
    rows = [("r1", datetime(2024, 1, 1), f"m{i}", "marts", 1, s, "success", None) for i, s in enumerate(secs)]
    rows[3] = ("r1", datetime(2024, 1, 1), "m3", "marts", 0, 0.2, "failed", "boom")
    led = spark.createDataFrame(rows, ledger.LEDGER_SCHEMA)
    s = ledger.run_summary(led).first()
    srt = sorted(secs)
    assert s.latency_p50_s == srt[min(9, int(0.5 * 10))]
    assert s.latency_p95_s == srt[min(9, int(0.95 * 10))]  # the slowest of ten
    assert s.models_run == 10 and s.models_succeeded == 9 and s.success_rate == 0.9


def test_dq_trend(spark):
    rows = [
        (datetime(2024, 1, 1), "critical", "pass"),
        (datetime(2024, 1, 1), "medium", "fail"),
        (datetime(2024, 1, 2), "critical", "fail"),
    ]
    audit = spark.createDataFrame(rows, "run_ts timestamp, severity string, status string")
    out = [(r.severity, r.checks, r.passed) for r in ledger.dq_trend(audit).collect()]
    assert out == [("critical", 1, 1), ("medium", 1, 0), ("critical", 1, 0)]
