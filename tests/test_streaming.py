"""Streaming intake reproduces the batch staging counts on landed raw files."""

from __future__ import annotations

import os
import tempfile

from cartwheel.operators import staging
from cartwheel.sources import fixtures
from cartwheel.streaming import intake
from conftest import SF_SMALL


def test_intake_matches_batch_staging(spark):
    root = tempfile.mkdtemp(prefix="cartwheel-stream-", dir="/tmp")
    raw = fixtures.raw_events(spark, SF_SMALL)
    raw.write.parquet(os.path.join(root, "landing"))
    clean_q, rej_q = intake.start_intake(
        spark, os.path.join(root, "landing"), os.path.join(root, "out"), os.path.join(root, "ckpt"), once=True
    )
    clean_q.awaitTermination(120)
    rej_q.awaitTermination(120)
    clean = spark.read.parquet(os.path.join(root, "out", "stg_events"))
    rej = spark.read.parquet(os.path.join(root, "out", "stg_events_rejected"))
    assert clean.count() == staging.stg_events(raw).count()
    assert rej.count() == staging.stg_events_rejected(raw).count()
    assert clean.groupBy("event_id").count().filter("count > 1").count() == 0


def test_copies_split_across_micro_batches_are_deduplicated_at_the_sink(spark):
    """Each exact copy lands in a different file batch; the second run resumes from the
    checkpoint and leaves out the ids the first has written."""
    from pyspark.sql import functions as F

    root = tempfile.mkdtemp(prefix="cartwheel-stream2-", dir="/tmp")
    raw = fixtures.raw_events(spark, SF_SMALL).withColumn("_i", F.monotonically_increasing_id()).cache()
    landing, out, ckpt = (os.path.join(root, d) for d in ("landing", "out", "ckpt"))
    raw.filter(F.col("_i") % 2 == 0).drop("_i").write.parquet(os.path.join(landing, "part1"))
    for q in intake.start_intake(spark, os.path.join(landing, "*"), out, ckpt, once=True):
        q.awaitTermination(120)
    raw.filter(F.col("_i") % 2 == 1).drop("_i").write.parquet(os.path.join(landing, "part2"))
    for q in intake.start_intake(spark, os.path.join(landing, "*"), out, ckpt, once=True):
        q.awaitTermination(120)
    clean = spark.read.parquet(os.path.join(out, "stg_events"))
    assert clean.groupBy("event_id").count().filter("count > 1").count() == 0
    assert clean.count() == staging.stg_events(raw.drop("_i")).count()


def test_late_rows_are_not_lost(spark, make_raw):
    from datetime import datetime

    from conftest import raw_row

    root = tempfile.mkdtemp(prefix="cartwheel-stream3-", dir="/tmp")
    landing, out, ckpt = (os.path.join(root, d) for d in ("landing", "out", "ckpt"))
    for part, rows in (
        ("a", [raw_row(event_id="new", event_timestamp=datetime(2024, 1, 20))]),
        ("b", [raw_row(event_id="old", event_timestamp=datetime(2024, 1, 2)), raw_row(event_id="new", event_timestamp=datetime(2024, 1, 21))]),
    ):
        make_raw(rows).write.parquet(os.path.join(landing, part))
        for q in intake.start_intake(spark, os.path.join(landing, "*"), out, ckpt, once=True):
            q.awaitTermination(120)
    assert sorted(r.event_id for r in spark.read.parquet(os.path.join(out, "stg_events")).collect()) == ["new", "old"]
