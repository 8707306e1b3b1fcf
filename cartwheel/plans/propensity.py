"""Walk-forward purchase-propensity model on the feature store (ML1-ML11, M14).

* split: every cutoff but the last trains, the last validates (optional
  embargo drops training cutoffs whose label window reaches the validation
  cutoff);
* scaling with the population standard deviation (zero-variance columns keep
  scale 1), computed by one aggregate;
* logistic regression with balanced class weights ``n / (2 * n_class)`` and an L2 penalty
  (C = 1, intercept free), fitted by Newton steps: one aggregate per step sums the weighted
  moments of all training rows (with map-side combine), and the driver solves one system of
  as many unknowns as there are features. Some six steps reach the optimum to the last
  digits, where a first-order method needs dozens of passes;
* metrics (ROC-AUC, step-wise AP, top-decile lift) through the distributed
  rank kit, for the model and for the baseline ranker (recent cart count).

Only a handful of numbers reach the driver: the class counts, one mean and one
deviation per feature, and the moments of each step.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property
from datetime import date, timedelta

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions import round_half_up
from cartwheel.operators import ranking
from cartwheel.plans.features import FeatureSpec
from cartwheel.sources import sinks

BASELINE_FEATURE = "add_to_cart_last_14d"
SCORE_DIGITS, WEIGHT_DIGITS = 9, 8  # digits reported; the fit is right to some 12
STEPS, STEP_SIZE = 50, 1e-12  # Newton steps at most, and the step that ends them


@dataclass
class PropensityRun:
    scores: DataFrame  # entity_id, as_of_date, propensity, decile, actual_label
    weights: DataFrame  # rank, feature, weight (signed), by |weight| desc
    scored: DataFrame  # validation rows with model and baseline scores
    train_cutoffs: list[str]
    valid_cutoff: str
    n_train: int
    gradient: DataFrame  # feature, gradient of the training objective at the fit, to 5 digits

    @cached_property
    def metrics(self) -> DataFrame:
        """One row per ranker: ROC-AUC, step-wise AP, top-decile lift (computed on first use).

        Model and baseline are stacked into one long frame keyed by ``ranker``,
        so the two rankers share each range-partitioned pass.
        """
        rankers = F.array(
            F.struct(F.lit("model").alias("ranker"), F.col("propensity").alias("score")),
            F.struct(F.lit("baseline_" + BASELINE_FEATURE).alias("ranker"), F.col("_baseline").alias("score")),
        )
        long = self.scored.select("entity_id", "actual_label", F.inline(rankers))
        return ranking_metrics(long, "score", "actual_label", "entity_id", by=("ranker",)).withColumns(
            {
                "valid_cutoff": F.lit(self.valid_cutoff).cast("date"),
                "train_cutoffs": F.lit(",".join(self.train_cutoffs)),
                "n_train": F.lit(self.n_train).cast("bigint"),
            }
        )


def split_cutoffs(spec: FeatureSpec, embargo_days: int = 0) -> tuple[list[str], str]:
    cutoffs = sorted(spec.cutoffs)
    if len(cutoffs) < 2:
        raise ValueError("walk-forward needs at least two cutoffs")
    train, valid = cutoffs[:-1], cutoffs[-1]
    if embargo_days:
        limit = date.fromisoformat(valid) - timedelta(days=int(spec.label.horizon_days) + int(embargo_days))
        train = [c for c in train if date.fromisoformat(c) <= limit]
    return train, valid


def feature_columns(spec: FeatureSpec) -> list[str]:
    return [f.name for f in spec.features]


def _scaled(df: DataFrame, cols: list[str], stats: dict[str, tuple[float, float]]) -> DataFrame:
    exprs = []
    for c in cols:
        mean, sd = stats[c]
        scale = sd if sd and sd > 0 else 1.0
        exprs.append(((F.col(c).cast("double") - F.lit(mean)) / F.lit(scale)).alias(c))
    return df.select(*[x for x in df.columns if x not in cols], *exprs)


def ranking_metrics(df: DataFrame, score: str, label: str, key: str, by: tuple[str, ...] = ()) -> DataFrame:
    """ROC-AUC, AP and top-decile lift per group of ``by``: one pass over distinct
    scores for AUC and AP, a selection for the lift; ``df`` is written first."""
    df = sinks.written(df, "ranked-rows")
    st = ranking.score_table(df, score, label, by)
    auc = ranking.roc_auc(df, score, label, table=st, by=by)
    ap = ranking.average_precision(df, score, label, table=st, by=by).select(*by, "average_precision")
    lift = ranking.top_fraction_lift(df, score, label, key, by=by).select(
        *by, "k", "top_positives", "base_rate", "lift"
    )
    if by:
        # one row per group on every side
        return auc.join(ap, list(by)).join(lift, list(by))
    ap_v = ap.select(F.struct("*")).scalar()
    lift_v = lift.select(F.struct("*")).scalar()
    return auc.select(
        "*",
        ap_v["average_precision"].alias("average_precision"),
        *[lift_v[c].alias(c) for c in ("k", "top_positives", "base_rate", "lift")],
    )


def _linear(columns: list[str], weights: np.ndarray) -> Column:
    """Intercept (first) plus the weighted columns."""
    z = F.lit(float(weights[0]))
    for c, w in zip(columns, weights[1:]):
        z = z + F.col(c) * F.lit(float(w))
    return z


def fit_logistic(rows: DataFrame, columns: list[str], label: str, weight: str, penalty: float = 1.0, steps: int = STEPS) -> np.ndarray:
    """Weights (intercept first) that minimise the weighted log loss plus
    ``penalty / 2`` times the squared weights but the intercept's.

    A Newton step reads ``rows`` once; a step that does not lower the loss is halved, so the
    fit cannot diverge. ``rows`` should be a written table.
    """
    d = len(columns) + 1
    ridge = np.diag([0.0] + [penalty] * (d - 1))
    x = [F.lit(1.0), *[F.col(c) for c in columns]]
    pairs = [(i, j) for i in range(d) for j in range(i, d)]

    def at(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Loss, gradient and curvature of the objective."""
        base = rows.withColumn("_z", _linear(columns, beta)).withColumn("_p", 1.0 / (1.0 + F.exp(-F.col("_z"))))
        base = base.withColumns({"_e": F.col(weight) * (F.col("_p") - F.col(label)), "_c": F.col(weight) * F.col("_p") * (1.0 - F.col("_p"))})
        # log(1 + exp(z)) - y z, without overflow
        loss = F.col(weight) * (F.greatest(F.col("_z"), F.lit(0.0)) + F.log1p(F.exp(-F.abs("_z"))) - F.col(label) * F.col("_z"))
        r = base.agg(
            F.sum(loss).alias("loss"), *[F.sum(F.col("_e") * x[i]).alias(f"g{i}") for i in range(d)], *[F.sum(F.col("_c") * x[i] * x[j]).alias(f"h{i}_{j}") for i, j in pairs]
        ).first()
        h = np.zeros((d, d))
        for i, j in pairs:
            h[i, j] = h[j, i] = r[f"h{i}_{j}"]
        return r["loss"] + 0.5 * beta @ ridge @ beta, np.array([r[f"g{i}"] for i in range(d)]) + ridge @ beta, h + ridge

    beta = np.zeros(d)
    loss, g, h = at(beta)
    for _ in range(steps):
        step = np.linalg.solve(h, g)
        while np.abs(step).max() > STEP_SIZE:
            new = at(beta - step)
            if new[0] <= loss * (1 + 1e-12):
                break
            step = step / 2
        else:
            break
        beta, (loss, g, h) = beta - step, new
    return beta


def train_propensity(store: DataFrame, spec: FeatureSpec, embargo_days: int = 0, max_iter: int = STEPS) -> PropensityRun:
    """Split, scale, fit, score and rank. ``store`` should be a written table: every Newton
    step reads the training rows."""
    label = spec.label.name
    cols = feature_columns(spec)
    train_cutoffs, valid_cutoff = split_cutoffs(spec, embargo_days)
    tr = store.filter(F.col("as_of_date").isin([date.fromisoformat(c) for c in train_cutoffs]))
    va = store.filter(F.col("as_of_date") == F.lit(valid_cutoff).cast("date"))

    # class counts and per-feature mean / population deviation: one aggregate
    stat_row = tr.agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.col(label).cast("bigint")).alias("_pos"),
        *[F.avg(F.col(c).cast("double")).alias(f"_m_{c}") for c in cols],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"_s_{c}") for c in cols],
    ).first()
    n, n_pos = int(stat_row["_n"]), int(stat_row["_pos"] or 0)
    n_neg = n - n_pos
    if n == 0 or n_pos == 0 or n_neg == 0:
        raise ValueError("training data needs both classes")
    stats = {c: (float(stat_row[f"_m_{c}"]), float(stat_row[f"_s_{c}"] or 0.0)) for c in cols}
    w_pos, w_neg = n / (2.0 * n_pos), n / (2.0 * n_neg)
    train_x = _scaled(tr, cols, stats).withColumns(
        {"_w": F.when(F.col(label) == 1, F.lit(w_pos)).otherwise(F.lit(w_neg)), "_y": F.col(label).cast("double")}
    )
    beta = fit_logistic(train_x, cols, "_y", "_w", steps=max_iter)

    scored = _scaled(va.withColumn("_baseline", F.col(BASELINE_FEATURE).cast("double")), cols, stats).select(
        "entity_id",
        "as_of_date",
        round_half_up(1.0 / (1.0 + F.exp(-_linear(cols, beta))), SCORE_DIGITS).alias("propensity"),
        F.col(label).cast("int").alias("actual_label"),
        "_baseline",
    )
    ranked = ranking.percent_rank_average(scored, "propensity", "_pct")
    scores = ranked.select(
        "entity_id",
        "as_of_date",
        "propensity",
        ranking.decile_from_pct("_pct").alias("decile"),
        "actual_label",
    )

    spark: SparkSession = store.sparkSession
    rounded = [(c, round(float(w), WEIGHT_DIGITS)) for c, w in zip(cols, beta[1:])]
    weights = spark.createDataFrame(
        [(i + 1, c, w) for i, (c, w) in enumerate(sorted(rounded, key=lambda kv: -abs(kv[1])))],
        T.StructType(
            [
                T.StructField("rank", T.IntegerType()),
                T.StructField("feature", T.StringType()),
                T.StructField("weight", T.DoubleType()),
            ]
        ),
    )

    # mean weighted (p - y) * x + weight / n: zero where the objective is least
    err = F.col("_w") * (1.0 / (1.0 + F.exp(-_linear(cols, beta))) - F.col("_y"))
    slopes = train_x.agg(
        *[F.abs(F.sum(err * F.col(c)) / F.sum("_w") + F.lit(float(w) / n)).alias(c) for c, w in zip(cols, beta[1:])]
    )
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), round_half_up(F.col(c), 5).alias("gradient")) for c in cols])
    return PropensityRun(scores, weights, scored, train_cutoffs, valid_cutoff, n, slopes.select(F.inline(rows)))


def auc_improvement(metrics: DataFrame) -> DataFrame:
    """Model ROC-AUC minus baseline ROC-AUC (ML9), one row."""
    return metrics.agg(
        (
            F.max(F.when(F.col("ranker") == "model", F.col("auc")))
            - F.max(F.when(F.col("ranker") != "model", F.col("auc")))
        ).alias("roc_auc_improvement")
    )
