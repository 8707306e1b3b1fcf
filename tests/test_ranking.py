"""Distributed rank kit against brute force (FIXTURES 4.12)."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwheel.operators import ranking


def test_percent_rank_and_decile_with_ties(spark):
    df = spark.createDataFrame([(1, 0.1), (2, 0.1), (3, 0.5), (4, 0.9)], "id int, score double")
    out = ranking.percent_rank_average(df, "score", "p").withColumn("d", ranking.decile_from_pct("p"))
    got = {r.id: (r.p, r.d) for r in out.collect()}
    assert got == {1: (0.375, 3), 2: (0.375, 3), 3: (0.75, 7), 4: (1.0, 10)}


def _brute_auc(y, s):
    pos = [si for yi, si in zip(y, s) if yi == 1]
    neg = [si for yi, si in zip(y, s) if yi == 0]
    tot = sum((1.0 if p > n else 0.5 if p == n else 0.0) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def _brute_ap(y, s):
    order = np.argsort(-np.asarray(s), kind="stable")
    ys, ss = np.asarray(y)[order], np.asarray(s)[order]
    P = ys.sum()
    ap, i = 0.0, 0
    while i < len(ss):
        j = i
        while j < len(ss) and ss[j] == ss[i]:
            j += 1
        tp, seen = ys[:j].sum(), j
        ap += ys[i:j].sum() / P * tp / seen
        i = j
    return ap


@pytest.mark.parametrize("seed", [1, 2])
def test_auc_ap_lift_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    n = 400
    s = [rnd.choice([0.0, 0.0, 0.0, 1.0, 2.0, rnd.random()]) for _ in range(n)]  # heavy ties
    y = [1 if rnd.random() < 0.2 + 0.2 * (si > 0.5) else 0 for si in s]
    df = spark.createDataFrame([(f"k{i:04d}", s[i], y[i]) for i in range(n)], "k string, s double, y int")
    auc = ranking.roc_auc(df, "s", "y").first()
    ap = ranking.average_precision(df, "s", "y").first()
    lift = ranking.top_fraction_lift(df, "s", "y", "k").first()
    assert auc.auc == pytest.approx(_brute_auc(y, s), abs=1e-9)
    assert ap.average_precision == pytest.approx(_brute_ap(y, s), abs=1e-9)
    k = max(1, int(n * 0.1))
    order = sorted(range(n), key=lambda i: (-s[i], f"k{i:04d}"))
    top = sum(y[i] for i in order[:k])
    assert lift.k == k and lift.top_positives == top
    assert lift.lift == pytest.approx((top / k) / (sum(y) / n), abs=1e-9)


def test_prefix_sums_cross_partitions(spark):
    df = spark.range(0, 1000).select(F.col("id"), F.lit(1).cast("bigint").alias("one"))
    out = ranking.prefix_sums(df, [F.col("id").asc()], ["one"], num_partitions=7).collect()
    assert all(r.one_before == r.id for r in out)


def test_percent_rank_with_a_hot_score_matches_pandas(spark):
    import pandas as pd

    vals = [0.0] * 300 + [float(i % 17) for i in range(100)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id int, score double")
    got = {r.id: r.p for r in ranking.percent_rank_average(df, "score", "p", salts=4).collect()}
    want = pd.Series(vals).rank(pct=True)
    assert len(got) == len(vals)
    assert all(got[i] == want[i] for i in range(len(vals)))


def test_grouped_metrics_equal_per_group_runs(spark):
    rnd = random.Random(7)
    rows = [(g, f"k{i:03d}", float(rnd.choice([0, 1, 2, 3])), int(rnd.random() < 0.3)) for g in ("a", "b") for i in range(150)]
    df = spark.createDataFrame(rows, "g string, k string, s double, y int")
    grouped = {r.g: r for r in ranking.roc_auc(df, "s", "y", by=("g",)).collect()}
    ap = {r.g: r for r in ranking.average_precision(df, "s", "y", by=("g",)).collect()}
    lift = {r.g: r for r in ranking.top_fraction_lift(df, "s", "y", "k", by=("g",)).collect()}
    for g in ("a", "b"):
        one = df.filter(F.col("g") == g)
        assert grouped[g].auc == ranking.roc_auc(one, "s", "y").first().auc
        assert ap[g].average_precision == ranking.average_precision(one, "s", "y").first().average_precision
        solo = ranking.top_fraction_lift(one, "s", "y", "k").first()
        assert (lift[g].k, lift[g].top_positives, lift[g].lift) == (solo.k, solo.top_positives, solo.lift)


def test_prefix_sums_are_stable_when_recomputed(spark):
    """The running sums are recomputed from the checkpointed range partitions on every
    action (as after a lost executor): the result must not change."""
    df = spark.range(0, 5000).select((F.col("id") % 97).alias("s"), F.col("id").alias("k"), F.lit(1).cast("bigint").alias("one"))
    out = ranking.prefix_sums(df, [F.col("s").desc(), F.col("k").asc()], ["one"])
    first = sorted((r.k, r.one_before) for r in out.collect())
    second = sorted((r.k, r.one_before) for r in out.collect())
    assert first == second
    assert sorted(b for _, b in first) == list(range(5000))
