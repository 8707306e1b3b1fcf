"""Incremental intake of raw-event files with Structured Streaming.

The batch staging rules applied to files as they land (the reference lists
batch + stream ingestion on its roadmap only, so this module adds no operator
of its own; it re-uses the staging predicates):

* quarantine branch: stateless ``is_rejected`` filter + ``reject_reason``;
* clean branch: ``is_valid`` filter, then de-duplication at the sink: within a micro-batch
  the earliest copy of an event id stays, and ids that an earlier micro-batch has written
  are left out. It keeps the first copy to *arrive*; the batch model keeps the earliest
  *timestamp*. There is no watermark, so no row is ever too late: a valid row lands in the
  clean table however old it is.

The clean table is partitioned by ``batch_id`` and every micro-batch replaces its own
partition, so a batch that is run again after a failure writes the same rows once. Each
batch reads the event-id column of the table (no other column) for the anti join.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartwheel.operators import staging
from cartwheel.schema import RAW_EVENTS


def read_raw_stream(spark: SparkSession, path: str, max_files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(RAW_EVENTS).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)


def clean_stream(raw: DataFrame) -> DataFrame:
    return raw.select(*staging.CLEAN_COLUMNS).filter(staging.is_valid())


def admit(target: str) -> Callable[[DataFrame, int], None]:
    """Writer of one micro-batch into the clean table at ``target``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        new = staging.typed_events(staging.dedup_first(batch))
        try:
            seen = batch.sparkSession.read.parquet(target).filter(F.col("batch_id") != batch_id).select(F.col("event_id").alias("_seen"))
        except AnalysisException as exc:
            if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
        else:
            new = new.join(seen, F.col("event_id").eqNullSafe(F.col("_seen")), "left_anti")
        out = new.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
        out.option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(target)

    return write


def rejected_stream(raw: DataFrame) -> DataFrame:
    return staging.stg_events_rejected(raw)


def start_intake(spark: SparkSession, source: str, target: str, checkpoints: str, once: bool = False) -> tuple[StreamingQuery, StreamingQuery]:
    """Start the clean and quarantine streams; ``once`` processes what is there and stops."""
    raw = read_raw_stream(spark, source)
    clean, rejected = (os.path.join(target, name) for name in ("stg_events", "stg_events_rejected"))
    writers = {
        "stg_events": clean_stream(raw).writeStream.foreachBatch(admit(clean)),
        "stg_events_rejected": rejected_stream(raw).writeStream.format("parquet").option("path", rejected).outputMode("append"),
    }
    queries = []
    for name, w in writers.items():
        w = w.option("checkpointLocation", os.path.join(checkpoints, name))
        queries.append((w.trigger(availableNow=True) if once else w.trigger(processingTime="1 minute")).start())
    return queries[0], queries[1]
