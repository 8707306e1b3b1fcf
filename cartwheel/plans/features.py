"""Point-in-time feature store: spec -> Column expressions -> Spark aggregations.

Two steps, and only the first one reads events:

1. **Daily state** (:func:`daily_state`). One pass over the events gives one row per
   (entity, window day) with partial counts, sums, maximum times and the label flag, and
   one row per (entity, window day, distinct key). These rows merge by plain aggregation, so
   the state can be kept as a table and grown by new days only (:func:`update_state`).
2. **Store** (:func:`store_from_state`). Windows become differences: what a day adds to a
   window of w days from day d on, it takes back on day d + w. A distinct key counts from
   its day until the day it occurs again or leaves the window, whichever comes first, so no
   window regroups raw keys; the forward label counts from h days before its event.
   The differences and one marker row per (entity, cutoff) are merged in day order, and one
   running sum per entity gives every feature at every marker. The work does not depend on
   how many cutoffs there are or how far their windows overlap; only the result does.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, timedelta

import yaml
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from cartwheel.functions import money
from cartwheel.sources import sinks

AGGREGATIONS = ("count", "count_distinct", "sum", "avg", "recency")
RECENCY_MISSING = 999
DEFAULT_SPEC = os.path.join(os.path.dirname(os.path.dirname(__file__)), "conf", "features.yaml")


@dataclass(frozen=True)
class Feature:
    name: str
    aggregation: str
    window_days: int
    column: str | None = None
    filter: str | None = None

    def validate(self) -> None:
        if self.aggregation not in AGGREGATIONS:
            raise ValueError(f"unknown aggregation: {self.aggregation}")
        if self.aggregation in ("count_distinct", "sum", "avg") and not self.column:
            raise ValueError(f"feature {self.name}: aggregation {self.aggregation} needs a column")
        if int(self.window_days) <= 0:
            raise ValueError(f"feature {self.name}: window_days must be positive")

    @property
    def default(self) -> int:
        return RECENCY_MISSING if self.aggregation == "recency" else 0


@dataclass(frozen=True)
class Label:
    name: str
    event: str
    horizon_days: int


@dataclass(frozen=True)
class FeatureSpec:
    entity: str
    cutoffs: tuple[str, ...]
    label: Label
    features: tuple[Feature, ...] = field(default_factory=tuple)
    timestamp: str = "event_timestamp"
    event_column: str = "event_name"

    def validate(self) -> FeatureSpec:
        names = [f.name for f in self.features]
        if len(set(names)) != len(names):
            raise ValueError("feature names must be unique")
        if not self.cutoffs:
            raise ValueError("at least one cutoff is needed")
        for f in self.features:
            f.validate()
        return self

    @staticmethod
    def from_dict(d: dict) -> FeatureSpec:
        return FeatureSpec(
            entity=d["entity"],
            cutoffs=tuple(str(c) for c in d["backfill_as_of_dates"]),
            label=Label(**d["label"]),
            features=tuple(Feature(**f) for f in d["features"]),
        ).validate()


def load_spec(path: str | None = None) -> FeatureSpec:
    with open(path or DEFAULT_SPEC) as fh:
        return FeatureSpec.from_dict(yaml.safe_load(fh))


def _out_type(f: Feature) -> str:
    return "double" if f.aggregation in ("sum", "avg") else "bigint"


# Every window is (C - w days, C] in *window days*, where an event's window day
# is the D with  D-1 23:59:59 < ts <= D 23:59:59  (the cutoff instant is 23:59:59,
# trap T11). So events can be rolled up per (entity, window day) before any cutoff is known.


def window_day(ts: Column) -> Column:
    """The day D with ``D-1 23:59:59 < ts <= D 23:59:59``."""
    return F.to_date(F.timestamp_add("MICROSECOND", F.lit(999_999), ts))


NEWEST = "newest_event_ts"
ADDITIVE = ("count", "sum", "avg")


def _distinct_columns(spec: FeatureSpec) -> list[str]:
    return sorted({f.column for f in spec.features if f.aggregation == "count_distinct"})


def daily_state(events: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Mergeable daily rows, from one pass over ``events``.

    ``entity_id``, ``_d`` (window day), ``_kind``: 0 for the rows that carry the partial
    values ``_f<i>`` / ``_n<i>`` of feature i, ``_lab`` and ``_ts``; k for the rows that
    carry one distinct key ``_v`` (in the column's own type) of the k-th distinct column,
    with a flag ``_q<i>`` per distinct feature whose filter it passes. Partial aggregation
    happens before the shuffle, so a hot entity is a few rows per task.
    """
    ts, columns = F.col(spec.timestamp), _distinct_columns(spec)
    types = {c: events.select(F.expr(c)).schema[0].dataType for c in columns}

    def key(own: int | None) -> Column:
        """A struct with one field per distinct column keeps every key in its own type."""
        return F.struct(*[(F.expr(c) if n == own else F.lit(None).cast(types[c])).alias(f"_{n}") for n, c in enumerate(columns)] or [F.lit(None).cast("int").alias("_")])

    kinds = [F.struct(F.lit(0).alias("kind"), key(None).alias("v"))]
    kinds += [F.when(F.expr(c).isNotNull(), F.struct(F.lit(k + 1).alias("kind"), key(k).alias("v"))) for k, c in enumerate(columns)]
    rows = events.select("*", window_day(ts).alias("_d"), F.explode(F.array_compact(F.array(*kinds))).alias("_x"))
    base = F.col("_x.kind") == 0
    aggs: list[Column] = [
        F.max(F.when(base & (F.col(spec.event_column) == spec.label.event), F.lit(1))).alias("_lab"),
        F.max(F.when(base, ts)).alias("_ts"),
    ]
    for i, f in enumerate(spec.features):
        passes = F.expr(f.filter) if f.filter else F.lit(True)
        if f.aggregation == "count":
            aggs.append(F.count(F.when(base & passes, F.lit(1))).alias(f"_f{i}"))
        elif f.aggregation in ("sum", "avg"):
            value = F.when(base & passes, money(F.expr(f.column)))
            aggs.append(F.sum(value).alias(f"_f{i}"))
            if f.aggregation == "avg":
                aggs.append(F.count(value).alias(f"_n{i}"))
        elif f.aggregation == "recency":
            aggs.append(F.max(F.when(base & passes, ts)).alias(f"_f{i}"))
        else:
            own = F.col("_x.kind") == columns.index(f.column) + 1
            aggs.append(F.coalesce(F.max(own & passes), F.lit(False)).alias(f"_q{i}"))
    return rows.groupBy(F.col(spec.entity).alias("entity_id"), "_d", F.col("_x.kind").alias("_kind"), F.col("_x.v").alias("_v")).agg(*aggs)


def state_path(root: str, spec: FeatureSpec) -> str:
    """Folder of the daily state of everything in ``spec`` but its cutoffs and windows."""
    parts = [spec.entity, spec.timestamp, spec.event_column, spec.label.event]
    parts += [f"{f.name}|{f.aggregation}|{f.column}|{f.filter}" for f in spec.features]
    return os.path.join(root, "daily_state_" + hashlib.md5("\n".join(parts).encode()).hexdigest()[:12])


def update_state(events: DataFrame, spec: FeatureSpec, root: str, redo: Sequence[date] = (), rebuild: bool = False) -> DataFrame:
    """The daily state kept under ``root``, grown by the days after its last one.

    Only events of new days are read (by ``event_date`` too, where the table has that
    column, which prunes its partitions), and only their partitions are written; ``redo``
    names days to compute again, for events that came late. A step that runs twice leaves
    the same state. The first call, or ``rebuild``, reads all events.
    """
    spark, path = events.sparkSession, state_path(root, spec)
    if rebuild:
        sinks.replace_table(daily_state(events, spec), path, partition_by=["_d"])
        return spark.read.parquet(path)
    days = sinks.partition_values(spark, path, "_d")
    if days:
        last = max(days)
        new = window_day(F.col(spec.timestamp)) > F.lit(last)
        if "event_date" in events.columns:  # days that start a second early belong to the day before
            new = new & (F.col("event_date") >= F.lit(last))
        again = [date.fromisoformat(str(x)) for x in redo]
        if again:
            late = window_day(F.col(spec.timestamp)).isin(again)
            if "event_date" in events.columns:
                late = late & F.col("event_date").isin([x - timedelta(days=k) for x in again for k in (0, 1)])
            new = new | late
        events = events.filter(new)
    sinks.overwrite_partitions(daily_state(events, spec), path, "_d")
    return spark.read.parquet(path)


def _changes(state: DataFrame, spec: FeatureSpec, names: list[str]) -> DataFrame:
    """(entity_id, _day, <names>): what each day adds to or takes from the running values."""
    d, kind = F.col("_d"), F.col("_kind")
    types = dict(state.dtypes)

    def change(day: Column, values: dict[str, Column]) -> Column:
        null = lambda n: F.lit(None).cast(types.get(n, "bigint"))
        return F.struct(day.alias("_day"), *[values.get(n, null(n)).cast(types.get(n, "bigint")).alias(n) for n in names])

    daily = state.filter(kind == 0)
    first = {n: F.col(n) for n in names if n in types} | {"_lab": -F.col("_lab")}
    items = [change(d, first), change(F.date_sub(d, int(spec.label.horizon_days)), {"_lab": F.col("_lab")})]
    for w in sorted({int(f.window_days) for f in spec.features if f.aggregation in ADDITIVE}):
        own = [c for i, f in enumerate(spec.features) if f.aggregation in ADDITIVE and int(f.window_days) == w for c in (f"_f{i}", f"_n{i}") if c in types]
        items.append(change(F.date_add(d, w), {c: -F.col(c) for c in own}))
    out = daily.select("entity_id", F.inline(F.array(*items)))

    distinct = [(i, f) for i, f in enumerate(spec.features) if f.aggregation == "count_distinct"]
    if distinct:
        later = W.Window.partitionBy("entity_id", "_kind", "_v").orderBy(F.col("_d").desc()).rowsBetween(W.Window.unboundedPreceding, -1)
        keys = state.filter(kind > 0).withColumns({f"_next{i}": F.min(F.when(F.col(f"_q{i}"), d)).over(later) for i, _ in distinct})
        items = []
        for i, f in distinct:
            end = F.least(F.date_add(d, int(f.window_days)), F.col(f"_next{i}"))  # least() skips nulls
            items.append(F.when(F.col(f"_q{i}"), change(d, {f"_f{i}": F.lit(1)})))
            items.append(F.when(F.col(f"_q{i}"), change(end, {f"_f{i}": F.lit(-1)})))
        out = out.unionByName(keys.select("entity_id", F.inline(F.array_compact(F.array(*items)))))
    return out


def store_from_state(state: DataFrame, spec: FeatureSpec, audit: bool = False) -> DataFrame:
    """``(entity_id, as_of_date, <features...>, <label>)`` for every cutoff of the spec, from
    a written daily state (read twice or three times, column-pruned)."""
    spark = state.sparkSession
    names = ["_lab", "_ts"]
    for i, f in enumerate(spec.features):
        names += [f"_f{i}"] + ([f"_n{i}"] if f.aggregation == "avg" else [])
    latest = {"_ts"} | {f"_f{i}" for i, f in enumerate(spec.features) if f.aggregation == "recency"}

    cutoffs = spark.createDataFrame([(date.fromisoformat(c),) for c in spec.cutoffs], "as_of_date date").agg(F.collect_list("as_of_date")).scalar()
    seen = state.filter("_kind = 0").groupBy("entity_id").agg(F.min("_d").alias("_first"))
    marks = seen.withColumn("_day", F.explode(cutoffs)).filter("_day >= _first").select("entity_id", "_day", F.lit(True).alias("_mark"))

    changes = _changes(state, spec, names).unionByName(marks, allowMissingColumns=True)
    per_day = changes.groupBy("entity_id", "_day").agg(F.max("_mark").alias("_mark"), *[(F.max(n) if n in latest else F.sum(n)).alias(n) for n in names])
    so_far = W.Window.partitionBy("entity_id").orderBy("_day").rowsBetween(W.Window.unboundedPreceding, 0)
    running = per_day.select("entity_id", F.col("_day").alias("as_of_date"), "_mark", *[(F.max(n) if n in latest else F.sum(n)).over(so_far).alias(n) for n in names])
    at = running.filter("_mark")

    def inside(ts: str, days: int) -> Column:
        """The latest time, if its day lies in the window: none in the window can be later."""
        return F.when(window_day(F.col(ts)) > F.date_sub("as_of_date", days), F.col(ts))

    cols = [F.col("entity_id"), F.col("as_of_date")]
    for i, f in enumerate(spec.features):
        value = F.col(f"_f{i}")
        if f.aggregation == "avg":
            value = F.when(F.col(f"_n{i}") > 0, value.cast("double") / F.col(f"_n{i}"))
        elif f.aggregation == "recency":
            value = F.datediff("as_of_date", F.to_date(inside(f"_f{i}", int(f.window_days))))
        cols.append(F.coalesce(value.cast(_out_type(f)), F.lit(f.default)).cast(_out_type(f)).alias(f.name))
    cols.append((F.coalesce("_lab", F.lit(0)) > 0).cast("int").alias(spec.label.name))
    if audit:
        widest = max([int(f.window_days) for f in spec.features] or [0])
        cols.append((inside("_ts", widest) if widest else F.lit(None).cast("timestamp_ntz")).alias(NEWEST))
    return at.select(*cols)


def build_feature_store(events: DataFrame, spec: FeatureSpec | None = None, audit: bool = False) -> DataFrame:
    """The store straight from events, which are read once: their daily state is written to
    the scratch folder. Sums and averages add decimals, distinct counts keep the column's
    own type. ``audit`` adds ``newest_event_ts``, the time of the newest event that any
    feature of the row has read (NULL if none), for the leakage guard."""
    spec = (spec or load_spec()).validate()
    return store_from_state(sinks.written(daily_state(events, spec), "daily-state"), spec, audit)


def feature_store_report(store: DataFrame, label: str) -> DataFrame:
    """Rows and positives per cutoff (FS13) with the label base rate."""
    return store.groupBy("as_of_date").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(label).cast("bigint").alias("positives"),
        (F.sum(label).cast("double") / F.count(F.lit(1))).alias("base_rate"),
    )


def label_base_rate(store: DataFrame, label: str) -> DataFrame:
    """Share of positive labels per cutoff (R6); NULL for a cutoff without rows."""
    return store.groupBy("as_of_date").agg(
        F.try_divide(F.sum(F.col(label).cast("double")), F.count(F.lit(1)).cast("double")).alias("label_base_rate")
    )


def leakage_violations(store: DataFrame) -> DataFrame:
    """One row: rows of an audited store whose newest event used lies past the cutoff
    instant (``as_of_date`` 23:59:59)."""
    instant = F.timestamp_add("SECOND", F.lit(86_399), F.col("as_of_date").cast("timestamp_ntz"))
    return store.agg(F.count(F.when(F.col(NEWEST) > instant, F.lit(1))).alias("violations"))
