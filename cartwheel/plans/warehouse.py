"""End-to-end run: raw zone -> layered models -> feature store -> model -> checks.

Each model is written to the warehouse folder and the next layer reads the
written table, so lineage is cut at every layer (a lost executor recomputes
from the last written table, not from the raw zone). Row counts are read back
from the written Parquet (row-group metadata, no data pages). The ledger and
the audit table are append-only Parquet folders, one partition per run, that survive
re-runs; replaced tables are swapped in whole, so a failed job leaves the old one.
"""

from __future__ import annotations

import os
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel import schema
from cartwheel.operators import ledger, marts, quality, sessions, staging
from cartwheel.plans import features as feat
from cartwheel.plans import propensity
from cartwheel.plans.models import Models
from cartwheel.sources import fixtures, sinks

BUILDERS: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {
    "stg_ad_spend": lambda t: staging.stg_ad_spend(t["raw_ad_spend"]),
    "stg_crm_customers": lambda t: staging.stg_crm_customers(t["raw_crm_customers"]),
    "stg_events": lambda t: staging.stg_events(t["raw_events"]),
    "stg_events_rejected": lambda t: staging.stg_events_rejected(t["raw_events"]),
    "int_sessions": lambda t: sessions.int_sessions(t["stg_events"]),
    "mart_campaign_efficiency": lambda t: marts.mart_campaign_efficiency(
        t["int_sessions"], t["stg_ad_spend"], ordered=False
    ),
    "mart_cohort_retention": lambda t: marts.mart_cohort_retention(
        t["int_sessions"], t["stg_crm_customers"], ordered=False
    ),
    "mart_customer_features": lambda t: marts.mart_customer_features(t["int_sessions"]),
    "mart_funnel": lambda t: marts.mart_funnel(t["int_sessions"], ordered=False),
    "mart_product_affinity": lambda t: marts.mart_product_affinity(t["stg_events"], ordered=False),
}


def _run_all(fn, items: list, parallel: bool) -> list:
    """Apply ``fn`` to every item, submitting the Spark jobs concurrently when asked."""
    if not parallel or len(items) < 2:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=len(items)) as pool:
        return list(pool.map(fn, items))


class WarehouseRun:
    def __init__(
        self,
        spark: SparkSession,
        warehouse: str,
        raw: dict[str, DataFrame] | None = None,
        sf_dir: str | None = None,
        feature_spec: feat.FeatureSpec | None = None,
        checks_path: str | None = None,
    ):
        self.spark = spark
        self.warehouse = warehouse
        self.raw = raw if raw is not None else fixtures.raw_zone(spark, sf_dir)
        self.spec = feature_spec or feat.load_spec()
        self.checks_path = checks_path
        self.run_id = sinks.new_run_id()
        self.run_ts = datetime.now(timezone.utc).replace(tzinfo=None)
        self.tables: dict[str, DataFrame] = {}

    @classmethod
    def from_raw_paths(
        cls, spark: SparkSession, warehouse: str, events: str, spend: str, crm: str, **kw
    ) -> WarehouseRun:
        """Run over a raw zone of Parquet files read with explicit schemas."""
        raw = {
            "raw_events": sinks.read_raw(spark, events, schema.RAW_EVENTS),
            "raw_ad_spend": sinks.read_raw(spark, spend, schema.RAW_AD_SPEND),
            "raw_crm_customers": sinks.read_raw(spark, crm, schema.RAW_CRM),
        }
        run = cls(spark, warehouse, raw=raw, **kw)
        run.tables.update(raw)  # already Parquet: the models read it directly, nothing to land
        return run

    def path(self, name: str) -> str:
        return os.path.join(self.warehouse, name)

    def _read(self, name: str) -> DataFrame:
        return sinks.read_table(self.spark, self.path(name))

    # ------------------------------------------------------------ raw zone
    def land_raw(self, parallel: bool = True) -> None:
        def land(name: str) -> tuple[str, DataFrame]:
            sinks.replace_table(self.raw[name], self.path(os.path.join("raw", name)))
            return name, self._read(os.path.join("raw", name))

        for name, df in _run_all(land, list(self.raw), parallel):
            self.tables[name] = df

    # ------------------------------------------------------------ models + ledger
    def _materialise(self, layer: str, model: str) -> tuple[tuple, DataFrame | None]:
        t0 = time.perf_counter()
        status, n, err, table = "success", 0, None, None
        try:
            sinks.replace_table(BUILDERS[model](self.tables), self.path(model))
            table = self._read(model)
            # a count of the written Parquet is answered from file footers
            n = table.count()
        except Exception as exc:  # noqa: BLE001 - recorded in the ledger, the run goes on
            status, err = "failed", str(exc).strip() or type(exc).__name__
        row = (self.run_id, self.run_ts, model, layer, n, round(time.perf_counter() - t0, 4), status, err)
        return row, table

    def materialise_models(self, parallel: bool = True) -> DataFrame:
        """Write every model, layer by layer. Models of one layer never read each
        other, so with ``parallel`` their jobs are submitted together and share the
        cluster instead of queueing behind each other."""
        if not self.tables:
            self.land_raw(parallel)
        rows = []
        for layer in ("staging", "intermediate", "marts"):
            names = [m for lay, m in Models.LAYERED if lay == layer]
            for (row, table), model in zip(_run_all(lambda m: self._materialise(layer, m), names, parallel), names):
                rows.append(row)
                if table is not None:
                    self.tables[model] = table
        led = self.spark.createDataFrame(rows, ledger.LEDGER_SCHEMA)
        sinks.append_run(led, self.path("_run_ledger"), self.run_id)
        # Run-level numbers over the whole ledger history
        sinks.replace_table(ledger.run_summary(self.ledger()), self.path("run_summary"))
        return led

    def register_views(self) -> list[str]:
        """Temporary views over every written table of this run (for ``spark.sql``)."""
        for name, df in self.tables.items():
            df.createOrReplaceTempView(name)
        return sorted(self.tables)

    def ledger(self) -> DataFrame:
        return self._read("_run_ledger")

    def reconciliation(self) -> DataFrame:
        return ledger.run_reconciliation(
            self.tables["raw_events"], self.tables["stg_events"], self.tables["stg_events_rejected"]
        )

    # ------------------------------------------------------------ feature store (FS11, FS12, S8)
    def backfill_features(self, incremental: bool = False) -> DataFrame:
        """Daily state, store, leakage guard and report. ``incremental`` keeps the state of
        the last run and reads only the events of later days; else all are read once."""
        state = feat.update_state(self.tables["stg_events"], self.spec, self.warehouse, rebuild=not incremental)
        store = feat.store_from_state(state, self.spec, audit=True)
        sinks.overwrite_partitions(store, self.path("feature_store"), "as_of_date")
        self.tables["feature_store"] = self._read("feature_store")
        leaks = feat.leakage_violations(self.tables["feature_store"]).first()["violations"]
        if leaks:
            raise AssertionError(f"point-in-time violation: {leaks} rows read an event past their cutoff")
        report = feat.feature_store_report(self.tables["feature_store"], self.spec.label.name)
        sinks.replace_table(report, self.path("feature_store_report"))  # S12
        return self._read("feature_store_report")

    # ------------------------------------------------------------ model (ML*, S10)
    def fit_model(self, embargo_days: int = 0) -> propensity.PropensityRun:
        run = propensity.train_propensity(self.tables["feature_store"], self.spec, embargo_days=embargo_days)
        # scores, metrics and weights are independent outputs of the fitted model
        writes = [
            lambda: sinks.overwrite_partitions(run.scores, self.path("mart_propensity_scores"), "as_of_date"),
            lambda: sinks.replace_table(run.metrics, self.path("model_metrics")),
            lambda: sinks.replace_table(run.weights, self.path("feature_weights")),
        ]
        _run_all(lambda w: w(), writes, parallel=True)
        self.tables["mart_propensity_scores"] = self._read("mart_propensity_scores")
        return run

    # ------------------------------------------------------------ checks (DQ13-DQ15, S9)
    def check_quality(self, fail_on_critical: bool = False, run_id: str | None = None):
        """One quality run; with the ``run_id`` of an earlier one its rows are replaced."""
        run_id = run_id or sinks.new_run_id()
        ref, checks = quality.load_checks(self.checks_path)
        run_ts = datetime.now(timezone.utc).replace(tzinfo=None)

        def stamped(df: DataFrame) -> DataFrame:
            return df.withColumn("run_ts", F.lit(run_ts).cast("timestamp")).withColumn("run_date", F.to_date("run_ts"))

        try:
            # all checks in one job (plain checks fused per table)
            sinks.append_run(stamped(quality.check_results(self.spark, checks, self.tables, ref)),
                             self.path("dq_audit_results"), run_id, ("run_date",))
        except Exception:  # noqa: BLE001 - a check failed while running: isolate it
            # the failed append committed nothing; evaluate check by check (one
            # result row each) so the failing ones are recorded as errors
            parts = []
            for c in checks:
                try:
                    rows = quality.check_results(self.spark, [c], self.tables, ref).collect()
                    parts.append(self.spark.createDataFrame(rows, quality.RESULT_SCHEMA))
                except Exception as exc:  # noqa: BLE001
                    msg = str(exc).strip() or type(exc).__name__
                    parts.append(quality.error_row(self.spark, c, msg))
            res = parts[0]
            for p in parts[1:]:
                res = res.unionByName(p)
            sinks.append_run(stamped(res), self.path("dq_audit_results"), run_id, ("run_date",))
        audit = self._read("dq_audit_results")
        # date and run are partition columns: only this run's files are read
        this_run = audit.filter((F.col("run_date") == F.lit(run_ts.date())) & (F.col("run_id") == run_id))
        summary = quality.quality_score(this_run).withColumn("run_ts", F.lit(run_ts).cast("timestamp"))
        sinks.append_run(summary, self.path("dq_scores"), run_id)  # S12: one row per quality run
        score = summary.first()
        if fail_on_critical:
            quality.gate(score)
        return this_run, score

    # ------------------------------------------------------------ consolidated metrics
    def summary(self) -> DataFrame:
        """One row of headline numbers, each a scalar subquery over a written table."""
        t = self.tables
        rec = ledger.run_reconciliation(t["raw_events"], t["stg_events"], t["stg_events_rejected"])
        runs = self._read("run_summary").filter(F.col("run_id") == self.run_id)
        model = self._read("model_metrics")
        dq = self._read("dq_scores").orderBy(F.desc("run_ts")).limit(1)  # the latest quality run
        one = lambda df, col: df.select(col).scalar()
        return rec.select(
            F.lit(self.run_id).alias("run_id"),
            "*",
            one(runs, "models_run").alias("models_run"),
            one(runs, "success_rate").alias("pipeline_success_rate"),
            one(runs, "latency_p50_s").alias("model_latency_p50_s"),
            one(runs, "latency_p95_s").alias("model_latency_p95_s"),
            one(self._read("feature_store_report"), F.sum("rows")).alias("feature_store_rows"),
            one(model.filter(F.col("ranker") == "model"), "auc").alias("roc_auc_model"),
            one(model.filter(F.col("ranker") != "model"), "auc").alias("roc_auc_baseline"),
            one(model.filter(F.col("ranker") == "model"), "lift").alias("top_decile_lift_model"),
            one(dq, "quality_score").alias("quality_score"),
            one(dq, "critical_failures").alias("critical_failures"),
        )

    def write_reports(self) -> None:
        """The small metric tables also as JSON (one file each) under ``reports/``."""
        small = ["run_summary", "feature_store_report", "model_metrics", "feature_weights", "dq_scores"]
        for name in small:
            self._read(name).coalesce(1).write.mode("overwrite").json(self.path(os.path.join("reports", name)))
        self.summary().coalesce(1).write.mode("overwrite").json(self.path(os.path.join("reports", "summary")))

    def run_all(self, fail_on_critical: bool = False) -> dict:
        led = self.materialise_models()
        report = self.backfill_features()
        run = self.fit_model()
        _, score = self.check_quality(fail_on_critical=False)
        self.write_reports()
        if fail_on_critical:
            quality.gate(score)
        return {"ledger": led, "feature_report": report, "model": run, "quality": score}


def main(argv: list[str] | None = None) -> int:
    """``spark-submit cartwheel/plans/warehouse.py --warehouse W --events E --spend S --crm C``"""
    import argparse
    import sys

    ap = argparse.ArgumentParser(description="end-to-end shop-event run")
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--events", required=True)
    ap.add_argument("--spend", required=True)
    ap.add_argument("--crm", required=True)
    ap.add_argument("--fail-on-critical", action="store_true")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("cartwheel-run").getOrCreate()
    run = WarehouseRun.from_raw_paths(spark, a.warehouse, a.events, a.spend, a.crm)
    try:
        run.run_all(fail_on_critical=a.fail_on_critical)
    except quality.QualityGateError as exc:
        print(exc, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
