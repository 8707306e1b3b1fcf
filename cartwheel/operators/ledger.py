"""Run ledger, reconciliation and trend queries (R1-R4, R7) as DataFrame functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions import round_half_up
from cartwheel.operators import staging
from cartwheel.operators.quality import SEVERITY_WEIGHT

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_ts", T.TimestampType()),
        T.StructField("model", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
    ]
)

# ---- fixed values: display order of severities in the quality trend ----
SEVERITY_RANK = {"critical": 0, "high": 1, "medium": 2, "low": 3}


def run_reconciliation(raw: DataFrame, clean: DataFrame, rejected: DataFrame) -> DataFrame:
    """raw = clean + quarantined + removed duplicates (+ rows in neither table, trap T1)."""
    j = raw.agg(F.count(F.lit(1)).alias("raw_events")).select(
        "raw_events",
        clean.agg(F.count(F.lit(1))).scalar().alias("events_processed"),
        rejected.agg(F.count(F.lit(1))).scalar().alias("records_quarantined"),
    )
    return _reconciled(j)


def _reconciled(j: DataFrame) -> DataFrame:
    rate = F.when(F.col("raw_events") > 0, F.col("records_quarantined") / F.col("raw_events")).otherwise(F.lit(0.0))
    return j.select(
        "raw_events",
        "events_processed",
        "records_quarantined",
        round_half_up(rate, 5).alias("quarantine_rate"),
        F.greatest(
            F.lit(0).cast("bigint"), F.col("raw_events") - F.col("records_quarantined") - F.col("events_processed")
        ).alias("dedup_removed"),
    )


def raw_reconciliation(raw: DataFrame) -> DataFrame:
    """The same numbers from one pass over the raw events: an event id with a valid row is
    processed once, rejected rows are quarantined each."""
    per_id = raw.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("rows"), F.max(staging.is_valid()).alias("valid"), F.count(F.when(staging.is_rejected(), 1)).alias("rejected")
    )
    n = per_id.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("raw_events"),
        F.count(F.when(F.col("valid"), 1)).alias("events_processed"),
        F.coalesce(F.sum("rejected"), F.lit(0)).cast("bigint").alias("records_quarantined"),
    )
    return _reconciled(n)


def _index_pick(df: DataFrame, group: list[str], value: str, p: float) -> DataFrame:
    """``sorted(values)[min(n - 1, int(p * n))]`` per group (an index rule, not interpolation)."""
    w = Window.partitionBy(*group).orderBy(F.col(value).asc_nulls_last())
    ranked = df.select(*group, value, F.row_number().over(w).alias("_i"), F.count(F.lit(1)).over(Window.partitionBy(*group)).alias("_n"))
    idx = F.least(F.col("_n") - 1, F.floor(F.col("_n") * F.lit(float(p)))) + 1
    return ranked.filter(F.col("_i") == idx).select(*group, F.col(value).alias(f"p{int(p * 100)}"))


def run_summary(ledger: DataFrame) -> DataFrame:
    """Per run: models run / succeeded, success rate, total seconds, latency p50 / p95."""
    agg = ledger.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("models_run"),
        F.count(F.when(F.col("status") == "success", 1)).alias("models_succeeded"),
        F.sum("seconds").alias("total_seconds"),
    )
    p50 = _index_pick(ledger, ["run_id"], "seconds", 0.50).withColumnRenamed("p50", "latency_p50_s")
    p95 = _index_pick(ledger, ["run_id"], "seconds", 0.95).withColumnRenamed("p95", "latency_p95_s")
    return (
        agg.join(p50, "run_id", "left")
        .join(p95, "run_id", "left")
        .withColumn("success_rate", round_half_up(F.col("models_succeeded") / F.col("models_run"), 4))
    )


def model_history(ledger: DataFrame) -> DataFrame:
    """Per model across the ledger history: runs, success rate, total and p50 / p95 seconds."""
    agg = ledger.groupBy("model").agg(
        F.count(F.lit(1)).alias("runs"),
        (F.count(F.when(F.col("status") == "success", 1)) / F.count(F.lit(1))).alias("success_rate"),
        F.max("rows").alias("max_rows"),
        F.sum("seconds").alias("total_seconds"),
    )
    p50 = _index_pick(ledger, ["model"], "seconds", 0.50).withColumnRenamed("p50", "latency_p50_s")
    p95 = _index_pick(ledger, ["model"], "seconds", 0.95).withColumnRenamed("p95", "latency_p95_s")
    return agg.join(p50, "model", "left").join(p95, "model", "left")


def dq_trend(audit: DataFrame, by: str = "severity") -> DataFrame:
    """Quality trend over the audit history: per run and severity (or ``check_name``),
    checks, passes, pass rate (R7)."""
    rank = F.coalesce(*[F.when(F.col("severity") == k, F.lit(v)) for k, v in SEVERITY_RANK.items()], F.lit(9))
    return (
        audit.groupBy("run_ts", by)
        .agg(
            F.count(F.lit(1)).alias("checks"),
            F.count(F.when(F.col("status") == "pass", 1)).alias("passed"),
            F.min(rank).alias("severity_rank"),
        )
        .select("run_ts", by, "checks", "passed", (F.col("passed") / F.col("checks")).alias("pass_rate"), "severity_rank")
        .orderBy("run_ts", "severity_rank", by)
    )


def dq_scores(audit: DataFrame) -> DataFrame:
    """Severity-weighted score, checks and passes of every run of the audit."""
    w = F.coalesce(*[F.when(F.col("severity") == k, F.lit(v)) for k, v in SEVERITY_WEIGHT.items()], F.lit(max(SEVERITY_WEIGHT.values())))
    passed = F.col("status") == "pass"
    return audit.groupBy("run_ts").agg(
        F.count(F.lit(1)).alias("checks"),
        F.count(F.when(passed, 1)).alias("passed"),
        round_half_up(F.lit(100.0) * F.sum(F.when(passed, w).otherwise(0)) / F.sum(w), 1).alias("quality_score"),
    )
