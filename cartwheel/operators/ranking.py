"""Distributed ranks and ranking metrics without a single-partition window.

``Window.orderBy`` with no partition moves every row to one task. Instead:

1. range-partition the rows on the sort key, number the partitions and write the rows to
   the shared scratch folder, so the sampled range bounds, and with them every row's
   partition number, stay fixed whatever is recomputed later;
2. running sums inside each partition number: an ordinary window partitioned by it;
3. per-partition totals (one row per partition, bounded by the partition
   count chosen here) -> exclusive offsets -> broadcast back.

Everything stays in the JVM. Metrics first collapse rows to one row per distinct score
(partial aggregation, so a score shared by a third of all rows is one row). A top fraction
is not sorted at all: a quantile sketch brackets the score of the cut, and only the rows
inside the bracket are ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions import round_half_up
from cartwheel.sources import sinks

METRIC_DIGITS = 10


def prefix_sums(
    df: DataFrame,
    order: Sequence[Column],
    sum_cols: Sequence[str],
    num_partitions: int | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Add ``<c>_before`` = sum of ``c`` over all rows strictly before each row in
    ``order``, and ``<c>_total`` = the sum over all rows.

    With ``partition_by`` the sums restart for every group (NULL keys form
    groups too): one range-partitioned pass serves all groups, and each group's
    start is subtracted afterwards.

    ``order`` must be a total order on the rows for a row-level meaning; with
    ties the split between tied rows follows the range partitioning.
    Sum columns must be integral and non-negative.
    """
    if partition_by:
        glob = prefix_sums(df, [F.col(g).asc() for g in partition_by] + list(order), sum_cols, num_partitions)
        # one row per group: where the group starts in the global order, and its total
        starts = glob.groupBy(*partition_by).agg(
            *[F.min(f"{c}_before").alias(f"_{c}_start") for c in sum_cols],
            *[F.sum(F.coalesce(F.col(c).cast("bigint"), F.lit(0))).alias(f"_{c}_gtot") for c in sum_cols],
            F.count(F.lit(1)).alias("_rows"),
        )
        # NULL keys are a group like any other, and a group of a third of all rows is split
        key = F.struct(*[F.col(g) for g in partition_by])
        n_total = starts.agg(F.sum("_rows")).scalar()
        table = starts.withColumns({"_s": key, "n": F.col("_rows"), "n_total": n_total})
        base = glob.drop(*[f"{c}_total" for c in sum_cols]).withColumn("_group", key)
        found = [f"_{c}_{x}" for c in sum_cols for x in ("start", "gtot")]
        j = lookup_by_score(base, "_group", table, found)
        return j.select(
            *df.columns,
            *[(F.col(f"{c}_before") - F.col(f"_{c}_start")).alias(f"{c}_before") for c in sum_cols],
            *[F.col(f"_{c}_gtot").alias(f"{c}_total") for c in sum_cols],
        )
    # without an explicit count AQE sizes the range partitions from the data
    # (contiguous ranges are merged, so partition order still follows ``order``)
    ranged = df.repartitionByRange(num_partitions, *order) if num_partitions else df.repartitionByRange(*order)
    ranged = sinks.written(ranged.withColumn("_pid", F.spark_partition_id()), "ranked")
    ahead = Window.partitionBy("_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    value = {c: F.coalesce(F.col(c).cast("bigint"), F.lit(0)) for c in sum_cols}
    within = ranged.withColumns({f"_{c}_in": F.coalesce(F.sum(v).over(ahead), F.lit(0)) for c, v in value.items()})
    totals = ranged.groupBy("_pid").agg(*[F.sum(v).alias(f"_{c}_tot") for c, v in value.items()])
    # one row per range partition: windows here touch k rows only
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    offsets = totals.select(
        "_pid",
        *[F.coalesce(F.sum(f"_{c}_tot").over(before), F.lit(0)).alias(f"_{c}_off") for c in sum_cols],
        *[F.sum(f"_{c}_tot").over(everything).alias(f"{c}_total") for c in sum_cols],
    )
    out = within.join(F.broadcast(offsets), "_pid", "left")
    return out.select(
        *df.columns,
        *[(F.coalesce(F.col(f"_{c}_off"), F.lit(0)) + F.col(f"_{c}_in")).alias(f"{c}_before") for c in sum_cols],
        *[F.col(f"{c}_total") for c in sum_cols],
    )


def score_counts(df: DataFrame, score: str, label: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score (per group): ``n`` rows, and ``pos`` / ``neg`` when a label is given."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if label:
        aggs += [
            F.sum(F.col(label).cast("bigint")).alias("pos"),
            (F.count(F.lit(1)) - F.sum(F.col(label).cast("bigint"))).alias("neg"),
        ]
    return df.groupBy(*[F.col(b) for b in by], F.col(score).alias("_s")).agg(*aggs)


def score_table(df: DataFrame, score: str, label: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score (ascending, NULL lowest) with its counts, the counts
    of all lower scores (``<c>_before``) and the totals (``<c>_total``).

    Percent rank, ROC-AUC and average precision all read this one table, so a
    ranker costs one range-partitioned pass over its distinct scores.
    """
    cols = ["n"] + (["pos", "neg"] if label else [])
    return prefix_sums(
        score_counts(df, score, label, by), [F.col("_s").asc_nulls_first()], cols, partition_by=tuple(by)
    )


def percent_rank_average(
    df: DataFrame, score: str, out: str = "pct_rank", table: DataFrame | None = None, salts: int = 64
) -> DataFrame:
    """Percentile rank with tied rows sharing their average rank (pandas ``rank(pct=True)``)."""
    st = table if table is not None else score_table(df, score)
    ranks = st.select(
        "_s", "n", "n_total", ((F.col("n_before") + (F.col("n") + F.lit(1)) / F.lit(2.0)) / F.col("n_total")).alias(out)
    )
    return lookup_by_score(df, score, ranks, [out], salts=salts)


HOT_FRACTION = 1e-3  # a score held by more than this share of rows is split over salts


def lookup_by_score(
    df: DataFrame, score: str, table: DataFrame, cols: Sequence[str], salts: int = 64, hot_fraction: float = HOT_FRACTION
) -> DataFrame:
    """Attach per-score columns of ``table`` (one row per distinct score, with ``n`` and
    ``n_total``) to every row of ``df`` without a skewed join.

    Scores holding more than ``hot_fraction`` of all rows are "hot": there are
    fewer than ``1 / hot_fraction`` of them, so their list is broadcast with a
    proven size bound. Rows with a hot score are spread over ``salts`` join keys
    and the hot table rows are replicated to match; every other score joins
    on salt 0.
    """
    is_hot = F.col("n") > F.col("n_total") * F.lit(float(hot_fraction))
    hot = table.filter(is_hot).select(F.col("_s").alias("_hs"), F.lit(True).alias("_hot"))
    right = table.select(
        F.col("_s").alias("_ls"),
        *cols,
        F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))).alias("_salt"),
    )
    left = df.join(F.broadcast(hot), F.col(score).eqNullSafe(F.col("_hs")), "left").withColumn(
        "_salt",
        F.when(F.col("_hot"), F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts))).otherwise(F.lit(0)),
    )
    joined = left.join(right, F.col(score).eqNullSafe(F.col("_ls")) & (left["_salt"] == right["_salt"]), "left")
    return joined.select(*[df[c] for c in df.columns], *[F.col(c) for c in cols])


def decile_from_pct(pct: str | Column) -> Column:
    """``int(clip(pct * 10, upper=10))`` -> 0..10 (10 only for the very top, trap T12)."""
    c = F.col(pct) if isinstance(pct, str) else pct
    return F.least(c * F.lit(10.0), F.lit(10.0)).cast("int")


def _agg(df: DataFrame, by: Sequence[str], *aggs: Column) -> DataFrame:
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def roc_auc(
    df: DataFrame, score: str, label: str, table: DataFrame | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Exact ROC-AUC with ties counted half, as one row ``(auc, n, positives)``.

    ``sum_s pos_s * (2 * neg_below_s + neg_s)`` is summed in integers, so the
    result does not depend on summation order.
    """
    st = table if table is not None else score_table(df, score, label, by)
    r = _agg(
        st,
        by,
        F.sum(F.col("pos") * (F.lit(2) * F.col("neg_before") + F.col("neg"))).alias("_num2"),
        F.first("pos_total").alias("positives"),
        F.first("neg_total").alias("_negatives"),
        F.first("n_total").alias("n"),
    )
    pairs = F.lit(2.0) * F.col("positives").cast("double") * F.col("_negatives").cast("double")
    return r.select(
        *by,
        # undefined (NULL) when only one class is present
        F.when(pairs > 0, round_half_up(F.col("_num2").cast("double") / pairs, METRIC_DIGITS)).alias("auc"),
        F.col("n").cast("bigint").alias("n"),
        F.col("positives").cast("bigint").alias("positives"),
    )


def average_precision(
    df: DataFrame, score: str, label: str, table: DataFrame | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Step-wise average precision ``sum_s pos_s * precision(>= s) / P`` (not the PR trapezoid)."""
    st = table if table is not None else score_table(df, score, label, by)
    tp = F.col("pos_total") - F.col("pos_before")  # positives scored >= s
    seen = F.col("n_total") - F.col("n_before")  # rows scored >= s
    r = _agg(
        st,
        by,
        F.sum(F.when(F.col("pos") > 0, F.col("pos").cast("double") * tp / seen)).alias("_num"),
        F.first("pos_total").alias("positives"),
        F.first("n_total").alias("n"),
    )
    return r.select(
        *by,
        F.when(F.col("positives") > 0, round_half_up(F.col("_num") / F.col("positives"), METRIC_DIGITS)).alias(
            "average_precision"
        ),
        F.col("n").cast("bigint").alias("n"),
        F.col("positives").cast("bigint").alias("positives"),
    )


BRACKET = 2e-4  # half width, in quantiles, of the bracket around the cut
SKETCH_ACCURACY = 20_000  # of the quantile sketch: ranks are right to one part in so many


def _with_group(rows: DataFrame, small: list[Row], schema: T.StructType, by: Sequence[str], name: str) -> DataFrame:
    """``rows`` with the row of its group in ``small`` as a struct column."""
    fields = [f for f in schema.fields if f.name not in by]
    if not by:
        return rows.withColumn(name, F.struct(*[F.lit(small[0][f.name]).cast(f.dataType).alias(f.name) for f in fields]))
    groups = rows.sparkSession.createDataFrame(small, schema)
    right = groups.select(F.struct(*[f.name for f in fields]).alias(name), *[F.col(b).alias(f"_g_{b}") for b in by])
    match = F.lit(True)
    for b in by:
        match = match & F.col(b).eqNullSafe(F.col(f"_g_{b}"))
    return rows.join(F.broadcast(right), match).drop(*[f"_g_{b}" for b in by])


def top_fraction_lift(
    df: DataFrame, score: str, label: str, key: str, fraction: float = 0.10, by: Sequence[str] = ()
) -> DataFrame:
    """Positive rate in the top ``max(1, int(n * fraction))`` rows over the base rate.

    Rows are ordered by score descending (NULL last), then ``key`` ascending, so tied
    scores are cut reproducibly. One aggregate counts the rows and sketches the quantiles
    around the cut; a second one counts the rows above that bracket; only the rows inside
    it are ordered. Should the bracket miss the cut (few rows, or a sketch beyond its
    error), all rows count as inside, so the result is always exact. ``df`` is read
    three times: pass a written table. Groups (``by``) are rankers to compare: one row of
    numbers for each reaches the driver.
    """
    number = F.when(F.isnan("_s"), F.lit(float("inf"))).otherwise(F.coalesce("_s", F.lit(float("-inf"))))
    rows = df.select(
        *[F.col(b) for b in by], F.col(score).cast("double").alias("_s"), F.col(key).alias("_k"), F.col(label).cast("bigint").alias("_y")
    ).withColumn("_r", number)
    cut = 1.0 - float(fraction)
    ends = [max(0.0, cut - BRACKET), min(1.0, cut + BRACKET)]
    groups = _agg(
        rows, by, F.count(F.lit(1)).alias("n"), F.sum("_y").alias("positives"),
        F.percentile_approx("_r", ends, SKETCH_ACCURACY).alias("ends"),
    ).withColumns({"k": F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(float(fraction)))).cast("bigint"), "lo": F.col("ends")[0], "hi": F.col("ends")[1]}).drop("ends")
    placed = _with_group(rows, groups.collect(), groups.schema, by, "_g").withColumns({"_above": F.col("_r") > F.col("_g.hi"), "_in": F.col("_r").between(F.col("_g.lo"), F.col("_g.hi"))})
    counts = _agg(
        placed, by, F.first("_g").alias("_g"), F.count_if("_above").alias("above"), F.count_if("_in").alias("inside"),
        F.sum(F.when(F.col("_above"), F.col("_y"))).alias("above_positives"),
    )
    hit = (F.col("above") < F.col("_g.k")) & (F.col("above") + F.col("inside") >= F.col("_g.k"))
    counts = counts.select(
        *by, "_g.n", "_g.positives", "_g.k",
        F.when(hit, F.col("_g.lo")).alias("lo"), F.when(hit, F.col("_g.hi")).alias("hi"),
        F.when(hit, F.col("above")).otherwise(0).alias("above"), F.when(hit, F.coalesce("above_positives", F.lit(0))).otherwise(0).alias("above_positives"),
    )
    found = counts.collect()
    inside = _with_group(rows, found, counts.schema, by, "_c").filter(F.col("_c.lo").isNull() | F.col("_r").between(F.col("_c.lo"), F.col("_c.hi")))
    inside = inside.select(*by, "_s", "_k", "_y", (F.col("_c.k") - F.col("_c.above")).alias("_left"), F.lit(1).cast("bigint").alias("_one"))
    ordered = prefix_sums(inside, [F.col("_s").desc_nulls_last(), F.col("_k").asc_nulls_last()], ["_one"], partition_by=tuple(by))
    taken = _agg(ordered, by, F.sum(F.when(F.col("_one_before") < F.col("_left"), F.col("_y"))).alias("top"))
    r = (_with_group(taken, found, counts.schema, by, "_c")).select(*by, "_c.*", "top")
    r = r.withColumn("top_positives", F.col("above_positives") + F.coalesce("top", F.lit(0)))
    base = F.col("positives").cast("double") / F.col("n")
    top_rate = F.col("top_positives").cast("double") / F.col("k")
    return r.select(
        *by,
        F.col("n").cast("bigint").alias("n"),
        F.col("k").cast("bigint").alias("k"),
        F.col("top_positives").cast("bigint").alias("top_positives"),
        round_half_up(base, METRIC_DIGITS).alias("base_rate"),
        round_half_up(F.when(base > 0, top_rate / base).otherwise(F.lit(0.0)), METRIC_DIGITS).alias("lift"),
    )
