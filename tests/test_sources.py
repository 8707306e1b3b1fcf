"""Sinks and nested export (S4, S6, S8, M11; FIXTURES 4.15)."""

from __future__ import annotations

import os
import tempfile
from datetime import date, datetime

import pytest


from cartwheel.operators import staging
from cartwheel.sources import ga4, sinks
from conftest import raw_row


def test_day_partitioned_write_prunes_on_read(spark, make_raw):
    rows = [
        raw_row(event_id=f"e{i}", event_timestamp=datetime(2024, 1, d, 12), event_date=date(2024, 1, d))
        for i, d in enumerate([1, 2, 3, 9, 10, 20])
    ]
    path = os.path.join(tempfile.mkdtemp(prefix="cartwheel-sink-", dir="/tmp"), "events")
    sinks.write_partitioned(staging.stg_events(make_raw(rows)), path, num_partitions=3)
    assert sorted(d for d in os.listdir(path) if d.startswith("event_date=")) == [
        f"event_date=2024-01-{d:02d}" for d in [1, 2, 3, 9, 10, 20]
    ]
    df = sinks.read_date_range(spark, path, "2024-01-02", "2024-01-10")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert sorted(r.event_id for r in df.collect()) == ["e1", "e2", "e3", "e4"]


def test_dynamic_partition_overwrite_keeps_other_cutoffs(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="cartwheel-fs-", dir="/tmp"), "store")
    first = spark.createDataFrame([("a", date(2024, 1, 10), 1), ("a", date(2024, 1, 17), 2)], "entity_id string, as_of_date date, v int")
    sinks.overwrite_partitions(first, path)
    sinks.overwrite_partitions(spark.createDataFrame([("a", date(2024, 1, 17), 9)], first.schema), path)
    got = sorted((str(r.as_of_date), r.v) for r in spark.read.parquet(path).collect())
    assert got == [("2024-01-10", 1), ("2024-01-17", 9)]


def test_nested_export_edges(make_raw):
    rows = [
        # every 50th event: no event_params -> NULL session id, id hashed with ''
        raw_row(event_id="evt_50", ga_session_id="u1.2024-01-05", event_name="view_item"),
        # add-to-cart, every 10th: two items, quantities summed, first item's fields
        raw_row(event_id="evt_10", ga_session_id="u1.2024-01-05", event_name="add_to_cart", quantity=2.0),
        # no item: empty items array -> NULL item fields and NULL quantity
        raw_row(event_id="evt_7", ga_session_id="u1.2024-01-05", event_name="session_start",
                item_id=None, item_name=None, item_category=None),
    ]
    export = ga4.ga4_export(make_raw(rows))
    sizes = {r.event_name: (len(r.event_params), len(r.items)) for r in export.collect()}
    assert sizes == {"view_item": (0, 1), "add_to_cart": (2, 2), "session_start": (2, 0)}
    flat = {r.event_name: r for r in staging.flatten_ga4(export).collect()}
    assert flat["view_item"].ga_session_id is None and flat["view_item"].event_id is not None
    assert flat["add_to_cart"].quantity == 3 and flat["add_to_cart"].item_id == "prod_1"
    assert flat["session_start"].item_id is None and flat["session_start"].quantity is None
    assert flat["add_to_cart"].ga_session_id == (date(2024, 1, 5) - date(1970, 1, 1)).days * 1_000_000 + 1
    assert flat["add_to_cart"].event_timestamp == datetime(2024, 1, 5, 10, 0, 0)


def _failing(spark, n=1000):
    """Rows of which one fails while the job writes them, after others were written."""
    from pyspark.sql import functions as F

    return spark.range(n).repartition(8).select(F.when(F.col("id") == n - 1, F.raise_error(F.lit("killed")).cast("long")).otherwise(F.col("id")).alias("v"))


def test_a_killed_replace_leaves_the_old_table(spark, tmp_path):
    path = str(tmp_path / "wh" / "model")
    sinks.replace_table(spark.range(5).toDF("v"), path)
    with pytest.raises(Exception, match="killed"):
        sinks.replace_table(_failing(spark), path)
    assert sorted(r.v for r in sinks.read_table(spark, path).collect()) == [0, 1, 2, 3, 4]
    assert os.listdir(tmp_path / "wh") == ["model"]  # nothing half-written stays
    sinks.replace_table(sinks.read_table(spark, path).selectExpr("v + 10 AS v"), path)  # may read what it replaces
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [10, 11, 12, 13, 14]


def test_a_driver_lost_between_the_renames_loses_no_table(spark, tmp_path):
    path = str(tmp_path / "model")
    sinks.replace_table(spark.range(3).toDF("v"), path)
    os.rename(path, tmp_path / "_model.old-0123456789ab")
    assert sinks.read_table(spark, path).count() == 3
    os.rename(path, tmp_path / "_model.old-0123456789ab")
    with pytest.raises(Exception, match="killed"):
        sinks.replace_table(_failing(spark), path)
    assert spark.read.parquet(path).count() == 3


def test_a_killed_partition_overwrite_leaves_the_old_cutoff(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = spark.createDataFrame([(1, date(2024, 1, 10)), (2, date(2024, 1, 17))], "v long, as_of_date date")
    sinks.overwrite_partitions(rows, path)
    with pytest.raises(Exception, match="killed"):
        sinks.overwrite_partitions(_failing(spark).selectExpr("v", "DATE'2024-01-17' AS as_of_date"), path)
    assert sorted((r.v, str(r.as_of_date)) for r in spark.read.parquet(path).collect()) == [(1, "2024-01-10"), (2, "2024-01-17")]


def test_a_repeated_append_leaves_one_copy(spark, tmp_path):
    path = str(tmp_path / "audit")
    one, two = sinks.new_run_id(), sinks.new_run_id()
    for run, rows in ((one, 3), (two, 2), (one, 3)):
        sinks.append_run(spark.range(rows).toDF("v"), path, run)
    assert {r.run_id: r["count"] for r in spark.read.parquet(path).groupBy("run_id").count().collect()} == {one: 3, two: 2}
