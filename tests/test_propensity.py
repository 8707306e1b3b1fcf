"""Walk-forward split and model plumbing (ML1-ML4, ML10)."""

from __future__ import annotations

import pytest

from cartwheel.plans import features as feat
from cartwheel.plans import propensity


def _spec(cutoffs, horizon=21):
    return feat.FeatureSpec(
        entity="user_pseudo_id",
        cutoffs=tuple(cutoffs),
        label=feat.Label("y", "purchase", horizon),
        features=(feat.Feature("events_7d", "count", 7),),
    )


def test_walk_forward_split_and_embargo():
    spec = _spec(["2025-05-22", "2025-05-08", "2025-06-05"])
    assert propensity.split_cutoffs(spec) == (["2025-05-08", "2025-05-22"], "2025-06-05")
    # a 21-day label from 2025-05-22 reads past the validation cutoff: the embargo drops it
    assert propensity.split_cutoffs(spec, embargo_days=1) == (["2025-05-08"], "2025-06-05")
    with pytest.raises(ValueError):
        propensity.split_cutoffs(_spec(["2025-05-08"]))


def test_model_outputs_on_driver_data(spark):
    import __spark_entry__ as E

    q = E.queries()
    scores = q["propensity_scores"](spark, "/root/testdata/sf0.01")
    rows = scores.collect()
    assert len(rows) == 150 and all(0.0 <= r.propensity <= 1.0 for r in rows)
    assert {r.decile for r in rows} <= set(range(11)) and max(r.decile for r in rows) == 10
    w = q["feature_weights"](spark, "/root/testdata/sf0.01").collect()
    assert [r.rank for r in w] == list(range(1, 10))
    assert all(abs(w[i].weight) >= abs(w[i + 1].weight) for i in range(len(w) - 1))
    m = {r.ranker: r for r in q["model_metrics"](spark, "/root/testdata/sf0.01").collect()}
    assert m["model"].n == 150 and m["model"].k == 15
    aud = q["remarketing_audience"](spark, "/root/testdata/sf0.01").collect()
    assert all(r.decile >= 9 for r in aud)


def _planted_store(spark, rows=3000, seed=3):
    """Two features carry the label, one is noise, one is constant; the baseline ranker's
    feature (recent carts) is noise here."""
    import numpy as np
    from datetime import date

    rng = np.random.default_rng(seed)
    x = rng.normal(size=(rows, 3))
    p = 1 / (1 + np.exp(-(1.8 * x[:, 0] - 1.2 * x[:, 1] - 2.0)))
    y = rng.random(rows) < p
    cut = [date(2024, 1, 10), date(2024, 1, 17), date(2024, 1, 24)]
    data = [(f"u{i}", cut[i % 3], *map(float, x[i]), float(rng.integers(0, 4)), 7.0, int(y[i])) for i in range(rows)]
    schema = "entity_id string, as_of_date date, a double, b double, c double, add_to_cart_last_14d double, same double, y int"
    spec = feat.FeatureSpec(
        entity="user_pseudo_id", cutoffs=("2024-01-10", "2024-01-17", "2024-01-24"), label=feat.Label("y", "purchase", 1),
        features=tuple(feat.Feature(n, "count", 7) for n in ("a", "b", "c", "add_to_cart_last_14d", "same")),
    )
    return spark.createDataFrame(data, schema).repartition(4), spec, data


def test_the_model_finds_a_planted_signal(spark):
    store, spec, _ = _planted_store(spark)
    run = propensity.train_propensity(store, spec)
    m = {r.ranker: r for r in run.metrics.collect()}
    model, base = m["model"], m["baseline_add_to_cart_last_14d"]
    assert model.auc > 0.8 and model.auc > base.auc + 0.2 and model.lift > 1.5
    assert propensity.auc_improvement(run.metrics).first().roc_auc_improvement == model.auc - base.auc
    w = {r.feature: r.weight for r in run.weights.collect()}
    assert w["a"] > 1 and w["b"] < -0.6 and abs(w["c"]) < 0.2 and w["same"] == 0


def test_newton_fit_equals_gradient_descent(spark):
    """The same objective minimised the slow way, on scaled columns computed apart."""
    import numpy as np

    store, spec, data = _planted_store(spark, rows=600, seed=5)
    run = propensity.train_propensity(store, spec)
    rows = [r for r in data if str(r[1]) != "2024-01-24"]
    x = np.array([r[2:7] for r in rows])
    sd = x.std(0)
    x = (x - x.mean(0)) / np.where(sd > 0, sd, 1)
    y = np.array([r[7] for r in rows], float)
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    beta, b0 = np.zeros(5), 0.0
    for _ in range(20_000):
        e = w * (1 / (1 + np.exp(-(x @ beta + b0))) - y)
        beta, b0 = beta - 0.004 * (x.T @ e + beta), b0 - 0.004 * e.sum()
    got = {r.feature: r.weight for r in run.weights.collect()}
    assert [got[f.name] for f in spec.features] == pytest.approx(beta.tolist(), abs=1e-6)
    valid = {r[0]: r for r in data if str(r[1]) == "2024-01-24"}
    scores = {r.entity_id: r.propensity for r in run.scores.collect()}
    raw = np.array([r[2:7] for r in rows])
    for k in list(valid)[:50]:
        z = ((np.array(valid[k][2:7]) - raw.mean(0)) / np.where(sd > 0, sd, 1)) @ beta + b0
        assert scores[k] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-6)


def test_one_class_cannot_be_fitted(spark):
    store, spec, _ = _planted_store(spark, rows=60)
    with pytest.raises(ValueError, match="both classes"):
        propensity.train_propensity(store.filter("y = 0"), spec)
