"""Declarative data-quality checks -> one result row each -> audit table, score, gate.

Every check compiles to a one-row DataFrame with a fixed schema. All checks that need
aggregates of whole tables only (row count, freshness, null rate, accepted values,
minimum, aggregate range, reconciliation, quarantine rate) share **one** ``agg`` per
table, a scalar subquery each; uniqueness is a grouped count and relationships an anti
join. A check whose table or column does not resolve yields an ``error`` row and the run
goes on.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

import yaml
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import PySparkException

from cartwheel.functions import round_half_up
from cartwheel.sources import sinks

# ---- fixed values: severity weights of the quality score ----
SEVERITY_WEIGHT = {"critical": 4, "high": 3, "medium": 2, "low": 1}
CHECK_TYPES = (
    "row_count_min",
    "freshness",
    "not_null",
    "unique",
    "accepted_values",
    "min_value",
    "range_agg",
    "reconcile_count",
    "relationship",
    "quarantine_rate",
)
NEEDS = {
    "row_count_min": ("table", "min"),
    "freshness": ("table", "column", "max_days"),
    "not_null": ("table", "column", "max_null_rate"),
    "unique": ("table", "column"),
    "accepted_values": ("table", "column", "values"),
    "min_value": ("table", "column", "min"),
    "range_agg": ("table", "expr", "min", "max"),
    "reconcile_count": ("table", "source_table", "source_expr"),
    "relationship": ("table", "column", "to_table", "to_column"),
    "quarantine_rate": ("rejected_table", "max_rate"),
}
STANDALONE = ("unique", "relationship")  # need more than one aggregate
ROWS = "_rows"
DEFAULT_CHECKS = os.path.join(os.path.dirname(os.path.dirname(__file__)), "conf", "checks.yaml")

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("check_name", T.StringType()),
        T.StructField("check_type", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("observed", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
)
RESULT_COLUMNS = [f.name for f in RESULT_SCHEMA.fields]


@dataclass(frozen=True)
class Check:
    name: str
    type: str
    table: str | None = None
    column: str | None = None
    severity: str = "medium"
    params: dict = field(default_factory=dict, hash=False, compare=False)

    @property
    def table_name(self) -> str | None:
        return self.table or self.params.get("rejected_table")

    def __post_init__(self) -> None:
        if self.severity not in SEVERITY_WEIGHT:
            raise ValueError(f"check {self.name}: unknown severity {self.severity!r}")

    def missing(self) -> list[str]:
        """Parameters its type needs and it does not have."""
        given = {**self.params, "table": self.table, "column": self.column}
        return [p for p in NEEDS.get(self.type, ()) if given.get(p) is None]

    @staticmethod
    def from_dict(d: dict) -> Check:
        d = dict(d)
        base = {k: d.pop(k) for k in ("name", "type", "table", "column", "severity") if k in d}
        return Check(params=d, **base)


def load_checks(path: str | None = None) -> tuple[str, list[Check]]:
    with open(path or DEFAULT_CHECKS) as fh:
        spec = yaml.safe_load(fh)
    return str(spec["reference_date"]), [Check.from_dict(c) for c in spec["checks"]]


# ------------------------------------------------------------------ result rows
def _row(
    check: Check, status: Column, observed: Column, threshold: Column | float | None, error: Column | None = None
) -> list[Column]:
    thr = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return [
        F.lit(check.name).alias("check_name"),
        F.lit(check.type).alias("check_type"),
        F.lit(check.table_name).cast("string").alias("table_name"),
        F.lit(check.column).cast("string").alias("column_name"),
        F.lit(check.severity).alias("severity"),
        status.alias("status"),
        observed.cast("double").alias("observed"),
        thr.cast("double").alias("threshold"),
        (error if error is not None else F.lit(None)).cast("string").alias("error"),
    ]


def error_row(spark: SparkSession, check: Check, message: str) -> DataFrame:
    return spark.createDataFrame(
        [(check.name, check.type, check.table_name, check.column, check.severity, "error", None, None, message)],
        RESULT_SCHEMA,
    )


def _pass(cond: Column) -> Column:
    return F.when(cond, F.lit("pass")).otherwise(F.lit("fail"))


# A check that needs nothing but aggregates names them as {(table, alias): expression} and
# builds its result row from the values; the aggregates of all checks on one table are one
# pass over it, whichever checks they belong to.
Needs = dict[tuple[str, str], Column]


def _aggregates(check: Check, reference_date: str) -> tuple[Needs, Callable[[Callable[[str, str], Column]], list[Column]]]:
    p, col, t = check.params, check.column, check.table
    key = "_v_" + re.sub(r"\W", "_", check.name)
    if check.type == "row_count_min":
        return {(t, ROWS): F.count(F.lit(1))}, lambda v: _row(check, _pass(v(t, ROWS) >= p["min"]), v(t, ROWS), float(p["min"]))
    if check.type == "freshness":

        def fresh(v):
            days = F.datediff(F.lit(reference_date).cast("date"), F.to_date(v(t, key)))
            # an empty table has no newest value: that is an error, not a pass
            status = F.when(v(t, key).isNull(), F.lit("error")).otherwise(_pass(days <= p["max_days"]))
            empty = F.when(v(t, key).isNull(), F.lit("no rows to measure freshness on"))
            return _row(check, status, days, float(p["max_days"]), empty)

        return {(t, key): F.max(F.col(col))}, fresh
    if check.type == "not_null":

        def rate(v):
            # share of NULLs; an empty table has none
            x = F.when(v(t, ROWS) > 0, (v(t, ROWS) - v(t, key)).cast("double") / v(t, ROWS)).otherwise(F.lit(0.0))
            return _row(check, _pass(x <= p["max_null_rate"]), x, float(p["max_null_rate"]))

        return {(t, ROWS): F.count(F.lit(1)), (t, key): F.count(F.col(col))}, rate
    if check.type == "accepted_values":
        bad = F.count(F.when(~F.col(col).isin(list(p["values"])), F.lit(1)))
        return {(t, key): bad}, lambda v: _row(check, _pass(v(t, key) == 0), v(t, key), 0.0)
    if check.type == "min_value":
        return {(t, key): F.min(F.col(col))}, lambda v: _row(
            check, _pass(v(t, key).isNull() | (v(t, key) >= p["min"])), v(t, key), float(p["min"])
        )
    if check.type == "range_agg":

        def plausible(v):
            ok = v(t, key).isNotNull() & (v(t, key) >= p["min"]) & (v(t, key) <= p["max"])
            return _row(check, F.coalesce(_pass(ok), F.lit("fail")), v(t, key), float(p["max"]))

        return {(t, key): F.expr(p["expr"])}, plausible
    if check.type == "reconcile_count":
        other = p["source_table"]
        return {(t, ROWS): F.count(F.lit(1)), (other, key): F.expr(p["source_expr"])}, lambda v: _row(
            check, _pass(v(t, ROWS) == v(other, key)), v(t, ROWS), v(other, key)
        )
    if check.type == "quarantine_rate":
        bad, raw = p["rejected_table"], p["raw_glob"] if "raw_glob" in p else p.get("raw_table", "raw_events")

        def quarantined(v):
            x = F.when(v(raw, ROWS) > 0, v(bad, ROWS) / v(raw, ROWS)).otherwise(F.lit(0.0))
            return _row(check, _pass(x <= p["max_rate"]), x, float(p["max_rate"]))

        return {(bad, ROWS): F.count(F.lit(1)), (raw, ROWS): F.count(F.lit(1))}, quarantined
    raise ValueError(f"unknown check type: {check.type}")


def _standalone(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    p, col = check.params, check.column
    if check.type == "unique":
        t = tables[check.table]
        dupes = t.groupBy(F.col(col)).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
        r = dupes.agg(F.count(F.lit(1)).alias("_d"))
        return r.select(*_row(check, _pass(F.col("_d") == 0), F.col("_d"), 0.0))
    # relationship: count per child key first (a hot or NULL key becomes one row), then
    # anti-join the distinct parent keys; NULL never matches, so it is an orphan
    a = tables[check.table].groupBy(F.col(col).alias("_k")).agg(F.count(F.lit(1)).alias("_c"))
    b = tables[p["to_table"]].select(F.col(p["to_column"]).alias("_k")).distinct()
    orphans = a.join(b, "_k", "left_anti").agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("_o"))
    return orphans.select(*_row(check, _pass(F.col("_o") == 0), F.col("_o"), 0.0))


def _message(exc: Exception) -> str:
    return str(exc).strip() or type(exc).__name__


def check_results(
    spark: SparkSession, checks: list[Check], tables: Mapping[str, DataFrame], reference_date: str
) -> DataFrame:
    """All check results as one DataFrame (lazy; fused aggregates per table)."""
    parts: list[DataFrame] = []
    needs: Needs = {}
    rows: list[Callable] = []

    def table(name: str, check: Check) -> DataFrame:
        # a raw side may be a Parquet path or glob instead of a table of the run
        return spark.read.parquet(name) if name == check.params.get("raw_glob") else tables[name]

    sources: dict[str, DataFrame] = {}
    for ch in checks:
        try:
            if ch.type not in CHECK_TYPES:
                raise ValueError(f"unknown check type: {ch.type}")
            if ch.missing():
                raise ValueError(f"missing parameter: {', '.join(ch.missing())}")
            if ch.type in STANDALONE:
                df = _standalone(ch, tables)
                df.schema
                parts.append(df)
                continue
            own, build = _aggregates(ch, reference_date)
            found = {name: table(name, ch) for name, _ in own}
            one_row(spark, found, own, [build]).schema  # resolve now: what cannot be becomes an error row
            sources |= found
            needs |= own
            rows.append(build)
        except KeyError as exc:
            parts.append(error_row(spark, ch, f"missing table: {exc}"))
        except (TypeError, ValueError, PySparkException) as exc:
            parts.append(error_row(spark, ch, _message(exc)))
    if rows:
        parts.append(one_row(spark, sources, needs, rows))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(*RESULT_COLUMNS)


def one_row(spark: SparkSession, tables: Mapping[str, DataFrame], needs: Needs, builds: list[Callable]) -> DataFrame:
    """The result rows of some checks from one aggregate per table, each a scalar subquery."""
    names = sorted({name for name, _ in needs})
    values = {}
    for i, name in enumerate(names):
        aggs = [e.alias(alias) for (t, alias), e in needs.items() if t == name]
        values[name] = tables[name].agg(*aggs).select(F.struct("*")).scalar().alias(f"_t{i}")
    base = spark.range(1, numPartitions=1).select(*values.values())

    def value(name: str, alias: str) -> Column:
        return F.col(f"_t{names.index(name)}")[alias]

    return base.select(F.inline(F.array(*[F.struct(*b(value)) for b in builds])))


def quality_score(results: DataFrame) -> DataFrame:
    """Severity-weighted pass rate (0..100, one decimal), counts and critical failures, one row.

    Checks cannot be built with an unknown severity; a row that has one all the same (an
    audit written elsewhere) counts as critical, so that no failure can hide behind it.
    """
    w = F.coalesce(
        *[F.when(F.col("severity") == k, F.lit(v)) for k, v in SEVERITY_WEIGHT.items()], F.lit(max(SEVERITY_WEIGHT.values()))
    )
    critical = ~F.coalesce(F.col("severity").isin([k for k in SEVERITY_WEIGHT if k != "critical"]), F.lit(False))
    passed = F.col("status") == "pass"
    agg = results.agg(
        F.count(F.lit(1)).alias("checks_total"),
        F.count(F.when(passed, 1)).alias("checks_passed"),
        F.count(F.when(~passed, 1)).alias("checks_failed"),
        F.count(F.when(~passed & critical, 1)).alias("critical_failures"),
        F.sum(w).alias("_wsum"),
        F.sum(F.when(passed, w).otherwise(0)).alias("_wpass"),
    )
    score = F.when(
        F.col("_wsum") > 0, round_half_up(F.lit(100.0) * F.col("_wpass") / F.col("_wsum"), 1)
    ).otherwise(F.lit(0.0))
    return agg.select(
        F.col("checks_total").cast("bigint").alias("checks_total"),
        F.col("checks_passed").cast("bigint").alias("checks_passed"),
        F.col("checks_failed").cast("bigint").alias("checks_failed"),
        F.col("critical_failures").cast("bigint").alias("critical_failures"),
        score.alias("quality_score"),
    )


class QualityGateError(RuntimeError):
    pass


def gate(score_row) -> None:
    """Raise when any critical check did not pass (DQ15)."""
    if score_row["critical_failures"]:
        raise QualityGateError(f"{score_row['critical_failures']} critical data-quality check(s) failed")


# ------------------------------------------------------------------ row-returning assertions
HOT_FRACTION = 1e-3


def assert_unique_rows(df: DataFrame, keys: list[str], hot_fraction: float = HOT_FRACTION) -> DataFrame:
    """Rows whose key occurs more than once (grouped count + semi joins, no window).

    A duplicated key may hold a third of all rows. Keys holding more than
    ``hot_fraction`` of the duplicated rows are fewer than ``1 / hot_fraction``,
    so their list is broadcast: their rows are found map-side, and only the
    remaining rows are shuffled for the semi join with the other duplicated keys. The
    duplicated keys are counted once and written.
    """
    dup = sinks.written(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1"), "duplicated-keys")
    limit = dup.agg(F.sum("_n")).scalar() * F.lit(float(hot_fraction))
    hot = F.broadcast(dup.filter(F.col("_n") > limit).select(*keys))
    cold = dup.filter(F.col("_n") <= limit).select(*keys)

    def on(other: DataFrame):
        return [df[k].eqNullSafe(other[k]) for k in keys]

    hot_rows = df.join(hot, on(hot), "left_semi")
    cold_rows = df.join(hot, on(hot), "left_anti").join(cold, on(cold), "left_semi")
    return hot_rows.unionByName(cold_rows)


def assert_non_null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows where any listed column is NULL, with the NULL columns listed."""
    nulls = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return df.withColumn("null_columns", nulls).filter(F.size("null_columns") > 0)


def assert_row_conditions(df: DataFrame, conditions: list[str]) -> DataFrame:
    """One row per (row, condition) that evaluates to FALSE; NULL does not fail."""
    failed = F.array_compact(
        F.array(*[F.when(~F.coalesce(F.expr(c), F.lit(True)), F.lit(c)) for c in conditions])
    )
    return df.withColumn("_failed", failed).filter(F.size("_failed") > 0).select(
        *df.columns, F.explode("_failed").alias("failed_condition")
    )
