"""Registry of the queries of the driver contract and their SQL oracles.

Every query reads the driver tables (through the fixture adapter) or data
Spark derives from them, over whole tables, and executes in full: nothing is
kept from one query for the next. A query that needs a model several times
writes it to the shared scratch folder once (``Models.written``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel import oracle
from cartwheel.functions import round_half_up
from cartwheel.operators import ledger, marts, quality, ranking, staging
from cartwheel.plans import features, propensity
from cartwheel.plans.models import Models, ModelTables
from cartwheel.sources import ga4, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


def models_for(spark: SparkSession, sf_dir: str) -> Models:
    """The model DAG over an input folder."""
    return Models(spark, sf_dir)


# ---------------------------------------------------------------- staging, sessions, marts
def _model(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = models_for(spark, sf_dir)
        if name == "mart_customer_features":  # reads the sessions twice (their last day bounds the recency)
            m.written("int_sessions")
        return m.table(name)

    run.__name__ = name
    return run


for _name in [
    "stg_events",
    "stg_events_rejected",
    "stg_ad_spend",
    "stg_crm_customers",
    "int_sessions",
    "mart_customer_features",
    "mart_funnel",
    "mart_campaign_efficiency",
    "mart_product_affinity",
    "mart_cohort_retention",
    "campaign_efficiency_events",
]:
    QUERIES[_name] = _model(_name)


@register("reject_counts")
def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.reject_counts(models_for(spark, sf_dir).stg_events_rejected)


@register("stg_events_strict")
def stg_events_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging with ``strict=True``: a NULL event name is quarantined instead of lost."""
    return staging.stg_events(models_for(spark, sf_dir).raw_events, strict=True)


@register("stg_events_rejected_strict")
def stg_events_rejected_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_events_rejected(models_for(spark, sf_dir).raw_events, strict=True)


@register("mart_cohort_retention_calendar_weeks")
def mart_cohort_retention_calendar_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohort retention counting Monday boundaries crossed instead of whole 7-day spans (T4)."""
    m = models_for(spark, sf_dir)
    return marts.mart_cohort_retention(m.int_sessions, m.stg_crm_customers, calendar_weeks=True)


@register("mart_funnel_bucketed")
def mart_funnel_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The funnel on clean events bucketed by session: sessions need no exchange."""
    return models_for(spark, sf_dir).bucketed(stg_events="ga_session_id").mart_funnel


@register("mart_customer_features_bucketed")
def mart_customer_features_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer features on sessions bucketed by user: both aggregates need no exchange."""
    return models_for(spark, sf_dir).bucketed(int_sessions="user_pseudo_id").mart_customer_features


@register("ga4_flatten")
def ga4_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_events_ga4(ga4.ga4_export(models_for(spark, sf_dir).raw_events))


@register("ga4_rejected")
def ga4_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the nested export that strict validation quarantines."""
    return staging.ga4_rejected(ga4.ga4_export(models_for(spark, sf_dir).raw_events))


PRUNE_RANGE = ("2024-01-08", "2024-01-14")


@register("partition_pruned_scan")
def partition_pruned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the clean events day-partitioned and clustered, then read one week back."""
    path = sinks.scratch_root(spark, "stg_events_by_day")
    sinks.write_partitioned(models_for(spark, sf_dir).stg_events, path)
    return sinks.read_date_range(spark, path, *PRUNE_RANGE)


@register("run_reconciliation")
def run_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.raw_reconciliation(models_for(spark, sf_dir).raw_events)


# ---------------------------------------------------------------- feature store
def _store(spark: SparkSession, sf_dir: str, spec: features.FeatureSpec | None = None, audit: bool = False) -> DataFrame:
    return features.build_feature_store(models_for(spark, sf_dir).stg_events, spec or features.load_spec(), audit=audit)


def avg_spec() -> features.FeatureSpec:
    """Default spec plus one ``avg`` feature (FIXTURES section 5)."""
    base = features.load_spec()
    extra = features.Feature(
        name="avg_order_value_30d",
        aggregation="avg",
        column="purchase_revenue",
        filter="event_name = 'purchase'",
        window_days=30,
    )
    return features.FeatureSpec(
        entity=base.entity, cutoffs=base.cutoffs, label=base.label, features=base.features + (extra,)
    ).validate()


def published_spec() -> features.FeatureSpec:
    """The spec with the 21-day label it was first published with (a fixed value)."""
    base = features.load_spec()
    return replace(base, label=features.Label("purchased_next_21d", base.label.event, 21))


@register("feature_store_21d_label")
def feature_store_21d_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir, published_spec())


def daily_spec() -> features.FeatureSpec:
    """A cutoff on every day of the data: the state and the running sums stay the same size."""
    base = features.load_spec()
    return replace(base, cutoffs=tuple(str(date(2024, 1, d)) for d in range(1, 31)))


@register("feature_store_daily_cutoffs")
def feature_store_daily_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir, daily_spec())


@register("feature_store")
def feature_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir)


STATE_UNTIL = "2024-01-15"


@register("feature_store_daily_rollup")
def feature_store_daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same store from a kept daily state that grew in two steps: the events up to
    STATE_UNTIL first, then the days after them, without reading the first ones again."""
    spec, root = features.load_spec(), sinks.scratch_root(spark, "state")
    events = models_for(spark, sf_dir).written("stg_events").stg_events
    features.update_state(events.filter(features.window_day(F.col(spec.timestamp)) <= F.lit(STATE_UNTIL).cast("date")), spec, root)
    return features.store_from_state(features.update_state(events, spec, root), spec)


@register("feature_store_report")
def feature_store_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = features.load_spec()
    return features.feature_store_report(_store(spark, sf_dir, spec), spec.label.name)


@register("label_base_rate")
def label_base_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = features.load_spec()
    return features.label_base_rate(_store(spark, sf_dir, spec), spec.label.name)


@register("leakage_violations")
def leakage_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.leakage_violations(_store(spark, sf_dir, audit=True))


@register("feature_avg")
def feature_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _store(spark, sf_dir, avg_spec()).select("entity_id", "as_of_date", "avg_order_value_30d")


# ---------------------------------------------------------------- ranking metrics and model
def _validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last-cutoff rows scored by the baseline ranker (recent cart count).

    Written: the rank kit reads its input more than once, and the feature store behind it
    should be computed once per query, not once per read.
    """
    spec = features.load_spec()
    valid = date.fromisoformat(sorted(spec.cutoffs)[-1])
    st = _store(spark, sf_dir, spec).filter(F.col("as_of_date") == F.lit(valid))
    rows = st.select(
        "entity_id",
        "as_of_date",
        F.col(propensity.BASELINE_FEATURE).cast("double").alias("score"),
        F.col(spec.label.name).cast("bigint").alias("y"),
    )
    return sinks.written(rows, "validation")


@register("baseline_auc")
def baseline_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.roc_auc(_validation(spark, sf_dir), "score", "y")


@register("baseline_average_precision")
def baseline_average_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.average_precision(_validation(spark, sf_dir), "score", "y")


@register("baseline_lift")
def baseline_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_fraction_lift(_validation(spark, sf_dir), "score", "y", "entity_id")


@register("propensity_decile")
def propensity_decile(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = ranking.percent_rank_average(_validation(spark, sf_dir), "score", "pct_rank")
    return v.select("entity_id", "as_of_date", "score", "pct_rank", ranking.decile_from_pct("pct_rank").alias("decile"))


def _model_run(spark: SparkSession, sf_dir: str) -> propensity.PropensityRun:
    """The fitted model, on a written store: the fit, the scoring and the metrics all
    read it, and none of them should recompute the feature store."""
    spec = features.load_spec()
    return propensity.train_propensity(sinks.written(_store(spark, sf_dir, spec), "store"), spec)


@register("propensity_scores")
def propensity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _model_run(spark, sf_dir).scores


@register("feature_weights")
def feature_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _model_run(spark, sf_dir).weights


@register("model_metrics")
def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _model_run(spark, sf_dir).metrics


@register("roc_auc_improvement")
def roc_auc_improvement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return propensity.auc_improvement(_model_run(spark, sf_dir).metrics)


@register("remarketing_audience")
def remarketing_audience(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.remarketing_audience(_model_run(spark, sf_dir).scores)


@register("model_gradient")
def model_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gradient of the training objective at the fitted weights: zero, if they minimise it."""
    return _model_run(spark, sf_dir).gradient


# a weight vector kept as a specification, so that scores and audience can be checked in SQL
FIXED_WEIGHTS = {"sessions_last_7d": 0.4, "views_last_14d": -0.05, "add_to_cart_last_14d": 0.3, "days_since_last_event": -0.02}
FIXED_INTERCEPT = -0.7


@register("propensity_fixed_weights")
def propensity_fixed_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores and deciles of the last cutoff under FIXED_WEIGHTS."""
    valid = date.fromisoformat(sorted(features.load_spec().cutoffs)[-1])
    st = _store(spark, sf_dir).filter(F.col("as_of_date") == F.lit(valid))
    z = F.lit(FIXED_INTERCEPT)
    for name, w in FIXED_WEIGHTS.items():
        z = z + F.col(name).cast("double") * F.lit(w)
    scored = sinks.written(st.select("entity_id", "as_of_date", round_half_up(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)), 9).alias("propensity")), "fixed-scores")
    ranked = ranking.percent_rank_average(scored, "propensity", "_pct")
    return ranked.select("entity_id", "as_of_date", "propensity", ranking.decile_from_pct("_pct").alias("decile"))


@register("remarketing_audience_fixed_weights")
def remarketing_audience_fixed_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.remarketing_audience(propensity_fixed_weights(spark, sf_dir))


# ---------------------------------------------------------------- data quality
# check name -> registered query name
DQ_QUERIES = {
    "events_volume": "dq_row_count",
    "events_freshness": "dq_freshness",
    "user_id_not_null": "dq_not_null",
    "event_id_unique": "dq_unique",
    "event_name_accepted": "dq_accepted_values",
    "revenue_non_negative": "dq_min_value",
    "conversion_rate_plausible": "dq_range_agg",
    "sessions_reconcile_events": "dq_reconcile",
    "propensity_scores_not_orphaned": "dq_relationship",
    "quarantine_rate_within_slo": "dq_quarantine_rate",
}
# ---- fixed values: asserted columns and conditions ----
NON_NULL_COLUMNS = ["event_id", "event_timestamp", "user_pseudo_id", "event_name"]
ROW_CONDITIONS = [
    "event_name IN ('session_start','page_view','view_item','add_to_cart','begin_checkout','purchase')",
    "purchase_revenue IS NULL OR purchase_revenue >= 0",
]
CAMPAIGN_CONDITIONS = ["conversion_rate BETWEEN 0 AND 1", "roas >= 0"]


def sql_checks() -> tuple[str, list[quality.Check]]:
    """Default checks; the orphan check reads the feature store (same entities as the
    scores, which need the fitted model) so that every check has an SQL oracle."""
    ref, checks = quality.load_checks()
    out = []
    for c in checks:
        if c.type == "relationship" and c.table == "mart_propensity_scores":
            c = quality.Check(c.name, c.type, "feature_store", c.column, c.severity, c.params)
        out.append(c)
    return ref, out


def _tables(spark: SparkSession, sf_dir: str) -> ModelTables:
    """Raw events read once; clean events, sessions and customer features each computed once."""
    m = models_for(spark, sf_dir).sorted_out().written("stg_events", "int_sessions", "mart_customer_features")
    return ModelTables(m, {"feature_store": features.build_feature_store(m.stg_events, features.load_spec())})


def _dq(check_name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ref, checks = sql_checks()
        m = models_for(spark, sf_dir)
        tables = ModelTables(m, {"feature_store": features.build_feature_store(m.stg_events, features.load_spec())})
        return quality.check_results(spark, [c for c in checks if c.name == check_name], tables, ref)

    run.__name__ = DQ_QUERIES[check_name]
    return run


for _check, _qname in DQ_QUERIES.items():
    QUERIES[_qname] = _dq(_check)


@register("dq_results")
def dq_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, checks = sql_checks()
    return quality.check_results(spark, checks, _tables(spark, sf_dir), ref)


@register("dq_score")
def dq_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_score(dq_results(spark, sf_dir))


def failing_checks() -> tuple[str, list[quality.Check]]:
    """Every check type with a bound that the data must break."""
    broken = {
        "row_count_min": {"min": 10**12},
        "freshness": {"max_days": -100_000},
        "not_null": {"max_null_rate": -1.0},
        "accepted_values": {"values": ["purchase"]},
        "min_value": {"min": 1_000_000_000},
        "range_agg": {"min": 2, "max": 3},
        "reconcile_count": {"source_expr": "count(*) + 1"},
        "relationship": {"to_table": "int_sessions", "to_column": "ga_session_id"},
        "quarantine_rate": {"max_rate": -1.0},
    }
    ref, checks = sql_checks()
    out = {}
    for c in checks:
        column = "event_name" if c.type == "unique" else c.column
        out.setdefault(c.type, quality.Check(f"broken_{c.type}", c.type, c.table, column, c.severity, {**c.params, **broken.get(c.type, {})}))
    return ref, list(out.values())


@register("dq_results_failing")
def dq_results_failing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, checks = failing_checks()
    return quality.check_results(spark, checks, _tables(spark, sf_dir), ref)


@register("dq_trend")
def dq_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and pass rate per run over an audit of the checks at several reference dates."""
    return ledger.dq_scores(_audit(spark, sf_dir))


@register("dq_trend_per_check")
def dq_trend_per_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.dq_trend(_audit(spark, sf_dir), "check_name").drop("severity_rank")


@register("dq_trend_per_severity")
def dq_trend_per_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pass rate per run and severity, the most severe first."""
    return ledger.dq_trend(_audit(spark, sf_dir))


def erring_checks() -> tuple[str, list[quality.Check]]:
    """One sound check among checks that cannot be evaluated, each for another reason."""
    ref, checks = sql_checks()
    out = [checks[0]]
    for name, kind, table, column, params in (
        ("err_missing_table", "row_count_min", "no_such_table", None, {"min": 1}),
        ("err_missing_column", "not_null", "stg_events", "no_such_column", {"max_null_rate": 0.0}),
        ("err_unknown_type", "no_such_check", "stg_events", None, {}),
        ("err_missing_parameter", "min_value", "stg_events", "purchase_revenue", {}),
        ("err_bad_expression", "range_agg", "stg_events", None, {"expr": "max(no_such_column)", "min": 0, "max": 1}),
    ):
        out.append(quality.Check(name, kind, table, column, "low", params))
    return ref, out


@register("dq_results_with_errors")
def dq_results_with_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks that cannot be evaluated become error rows, and the run goes on."""
    ref, checks = erring_checks()
    found = quality.check_results(spark, checks, ModelTables(models_for(spark, sf_dir)), ref)
    return found.withColumn("error", F.col("error").isNotNull())


def shipped_checks() -> tuple[str, list[quality.Check]]:
    """The checks with the thresholds they were first published with."""
    ref, checks = sql_checks()
    # ---- fixed values: the published volume minimum and conversion range ----
    published = {"events_volume": {"min": 100_000}, "conversion_rate_plausible": {"min": 0.01, "max": 0.20}}
    return ref, [quality.Check(c.name, c.type, c.table, c.column, c.severity, {**c.params, **published.get(c.name, {})}) for c in checks]


@register("dq_results_published_thresholds")
def dq_results_published_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    ref, checks = shipped_checks()
    return quality.check_results(spark, checks, _tables(spark, sf_dir), ref)


TREND_DATES = ("2024-01-20", "2024-01-31", "2024-03-31")


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks as of TREND_DATES: only the freshness of the data changes between runs."""
    tables, (_, checks) = _tables(spark, sf_dir), sql_checks()
    out = None
    for day in TREND_DATES:
        one = quality.check_results(spark, checks, tables, day).withColumn("run_ts", F.lit(day).cast("timestamp_ntz"))
        out = one if out is None else out.unionByName(one)
    return out


@register("dq_scores_orphans")
def dq_scores_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shipped orphan check on the model's own scores table."""
    ref, checks = quality.load_checks()
    m = models_for(spark, sf_dir)
    tables = ModelTables(m, {"mart_propensity_scores": _model_run(spark, sf_dir).scores})
    return quality.check_results(spark, [c for c in checks if c.type == "relationship"], tables, ref)


@register("dq_assert_clean_events_unique_rows")
def dq_assert_clean_events_unique_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assert_unique_rows(models_for(spark, sf_dir).written("stg_events").stg_events, ["event_id"])


@register("dq_assert_clean_events_non_null_rows")
def dq_assert_clean_events_non_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assert_non_null_rows(models_for(spark, sf_dir).stg_events, NON_NULL_COLUMNS).drop("null_columns")


@register("dq_assert_clean_events_row_conditions")
def dq_assert_clean_events_row_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assert_row_conditions(models_for(spark, sf_dir).stg_events, ROW_CONDITIONS)


@register("dq_assert_campaign_non_null_rows")
def dq_assert_campaign_non_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assert_non_null_rows(models_for(spark, sf_dir).mart_campaign_efficiency, ["campaign_id"]).drop("null_columns")


@register("dq_assert_campaign_row_conditions")
def dq_assert_campaign_row_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assert_row_conditions(models_for(spark, sf_dir).mart_campaign_efficiency, CAMPAIGN_CONDITIONS)


@register("dq_assert_unique_rows")
def dq_assert_unique_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assert_unique_rows(models_for(spark, sf_dir).raw_events, ["event_id"])


@register("dq_assert_non_null_rows")
def dq_assert_non_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assert_non_null_rows(models_for(spark, sf_dir).raw_events, NON_NULL_COLUMNS).drop("null_columns")


@register("dq_assert_row_conditions")
def dq_assert_row_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assert_row_conditions(models_for(spark, sf_dir).raw_events, ROW_CONDITIONS)


# ---------------------------------------------------------------- oracles
def oracles() -> dict[str, str]:
    spec = features.load_spec()
    out: dict[str, str] = {}
    out.update(oracle.staging_and_marts())
    for name in ("mart_funnel", "mart_customer_features"):
        out[f"{name}_bucketed"] = out[name]
    campaign = f"mart_campaign_efficiency AS ({oracle.campaign_sql()})"
    out.update(oracle.build_options())
    out.update(oracle.features(spec))
    out["feature_store_daily_rollup"] = out["feature_store"]
    out.update(oracle.baseline_metrics(spec))
    out.update(oracle.model(spec, *propensity.split_cutoffs(spec), propensity.BASELINE_FEATURE))
    out["feature_avg"] = oracle.with_base(
        "SELECT entity_id, as_of_date, avg_order_value_30d FROM feature_store", oracle.feature_store_cte(avg_spec())
    )
    for name, other in (("feature_store_21d_label", published_spec()), ("feature_store_daily_cutoffs", daily_spec())):
        out[name] = oracle.with_base("SELECT * FROM feature_store", oracle.feature_store_cte(other))
    out["ga4_flatten"] = oracle.ga4_flatten()
    out["ga4_rejected"] = oracle.ga4_rejected()
    out["partition_pruned_scan"] = oracle.with_base(
        f"SELECT * FROM stg_events WHERE event_date BETWEEN DATE '{PRUNE_RANGE[0]}' AND DATE '{PRUNE_RANGE[1]}'"
    )
    out["run_reconciliation"] = oracle.with_base(
        f"""SELECT r AS raw_events, c AS events_processed, q AS records_quarantined,
               {oracle.rnd('CASE WHEN r > 0 THEN CAST(q AS DOUBLE) / r ELSE 0.0 END', 5)} AS quarantine_rate,
               CAST(greatest(0, r - q - c) AS BIGINT) AS dedup_removed
        FROM (SELECT (SELECT count(*) FROM raw_events) AS r, (SELECT count(*) FROM stg_events) AS c,
                     (SELECT count(*) FROM stg_events_rejected) AS q)"""
    )
    ref, checks = sql_checks()
    for c in checks:
        if c.name in DQ_QUERIES:
            out[DQ_QUERIES[c.name]] = oracle.with_base(oracle.dq_check_sql(c, ref), oracle.dq_ctes(spec))
    out["dq_results"] = oracle.with_base(
        "\nUNION ALL\n".join(oracle.dq_check_sql(c, ref) for c in checks), oracle.dq_ctes(spec)
    )
    out["dq_score"] = oracle.dq_score_sql(checks, ref, spec)
    out["dq_assert_unique_rows"] = oracle.with_base(
        "SELECT * FROM raw_events WHERE event_id IN "
        "(SELECT event_id FROM raw_events GROUP BY event_id HAVING count(*) > 1)"
    )
    nn = " OR ".join(f"{c} IS NULL" for c in NON_NULL_COLUMNS)
    out["dq_assert_non_null_rows"] = oracle.with_base(f"SELECT * FROM raw_events WHERE {nn}")
    out["dq_assert_row_conditions"] = oracle.with_base(
        "\nUNION ALL\n".join(
            f"SELECT *, {oracle.quote(c)} AS failed_condition FROM raw_events WHERE NOT coalesce(({c}), TRUE)"
            for c in ROW_CONDITIONS
        )
    )
    for name, columns in (("clean_events", NON_NULL_COLUMNS), ("campaign", ["campaign_id"])):
        model, body = ("stg_events", "") if name == "clean_events" else ("mart_campaign_efficiency", campaign)
        conditions = ROW_CONDITIONS if name == "clean_events" else CAMPAIGN_CONDITIONS
        nulls = " OR ".join(f"{c} IS NULL" for c in columns)
        out[f"dq_assert_{name}_non_null_rows"] = oracle.with_base(f"SELECT * FROM {model} WHERE {nulls}", body)
        out[f"dq_assert_{name}_row_conditions"] = oracle.with_base(
            "\nUNION ALL\n".join(f"SELECT *, {oracle.quote(c)} AS failed_condition FROM {model} WHERE NOT coalesce(({c}), TRUE)" for c in conditions), body
        )
    out["dq_assert_clean_events_unique_rows"] = oracle.with_base(
        "SELECT * FROM stg_events WHERE event_id IN (SELECT event_id FROM stg_events GROUP BY event_id HAVING count(*) > 1)"
    )
    ref_f, broken = failing_checks()
    out["dq_results_failing"] = oracle.with_base("\nUNION ALL\n".join(oracle.dq_check_sql(c, ref_f) for c in broken), oracle.dq_ctes(spec))
    audit = "\nUNION ALL\n".join(
        f"SELECT *, TIMESTAMP '{day}' AS run_ts FROM ({oracle.dq_check_sql(c, day)})" for day in TREND_DATES for c in checks
    )
    out["dq_trend"] = oracle.dq_trend_sql(audit, spec)
    out["dq_trend_per_severity"] = oracle.dq_trend_sql(audit, spec, "severity", ledger.SEVERITY_RANK)
    ref_s, published = shipped_checks()
    out["dq_results_published_thresholds"] = oracle.with_base("\nUNION ALL\n".join(oracle.dq_check_sql(c, ref_s) for c in published), oracle.dq_ctes(spec))
    ref_e, erring = erring_checks()
    head = f"SELECT * REPLACE (error IS NOT NULL AS error) FROM ({oracle.dq_check_sql(erring[0], ref_e)})"
    tail = [f"SELECT {oracle.quote(c.name)}, {oracle.quote(c.type)}, {oracle.quote(c.table)}, CAST({oracle.quote(c.column)} AS VARCHAR), 'low', 'error', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), TRUE" for c in erring[1:]]
    out["dq_results_with_errors"] = oracle.with_base("\nUNION ALL\n".join([head, *tail]))
    out["dq_trend_per_check"] = oracle.dq_trend_sql(audit, spec, "check_name")
    orphan = next(c for c in quality.load_checks()[1] if c.type == "relationship")
    last = sorted(spec.cutoffs)[-1]
    out["dq_scores_orphans"] = oracle.with_base(
        oracle.dq_check_sql(orphan, ref),
        oracle.dq_ctes(spec) + f", mart_propensity_scores AS (SELECT entity_id FROM feature_store WHERE as_of_date = DATE '{last}')",
    )
    z = " + ".join([str(FIXED_INTERCEPT), *(f"{n} * CAST({w} AS DOUBLE)" for n, w in FIXED_WEIGHTS.items())])
    fixed = f"""
SELECT entity_id, as_of_date, propensity, CAST(floor(least(10.0 * (below + (same + 1) / CAST(2.0 AS DOUBLE)) / n, 10.0)) AS INTEGER) AS decile
FROM (SELECT *, CAST(rank() OVER (ORDER BY propensity) - 1 AS DOUBLE) AS below, CAST(count(*) OVER (PARTITION BY propensity) AS DOUBLE) AS same,
             CAST(count(*) OVER () AS DOUBLE) AS n
      FROM (SELECT entity_id, as_of_date, {oracle.rnd(f'1 / (1 + exp(-({z})))', 9)} AS propensity FROM feature_store WHERE as_of_date = DATE '{last}'))"""
    out["propensity_fixed_weights"] = oracle.with_base(fixed, oracle.feature_store_cte(spec))
    out["remarketing_audience_fixed_weights"] = oracle.with_base(f"SELECT * FROM ({fixed}) WHERE decile >= 9", oracle.feature_store_cte(spec))
    out["model_gradient"] = "SELECT * FROM (VALUES " + ", ".join(f"('{f.name}', CAST(0.0 AS DOUBLE))" for f in spec.features) + ") AS v(feature, gradient)"
    return {k: v for k, v in out.items() if k in QUERIES}
