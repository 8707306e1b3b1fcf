"""Readers and writers of the warehouse zone.

Paths are parameters; on a cluster they name shared storage. The default
scratch root (tests only) is a folder under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.session import ensure_checkpoint_dir


def scratch_root(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder, removed when the session ends."""
    path = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(where)  # only a path that exists can be marked
    files.deleteOnExit(where)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a scratch folder and read back: computed once, whoever reads it
    again, and safe from lost executors."""
    path = scratch_root(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Deal a scan of fewer splits than the cluster has cores out to all of them, before
    work that costs more than the shuffle of its few rows; a scan of as many splits or more
    (any table of size) stays as it is, so nothing is shuffled at scale."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def read_raw(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Raw-zone Parquet with an explicit schema (no inference job, no drift)."""
    return spark.read.schema(schema).parquet(path)


def write_table(df: DataFrame, path: str, max_records_per_file: int = 5_000_000) -> None:
    """Write a model to a folder of its own (scratch copies; see :func:`replace_table`)."""
    df.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_col: str = "event_date",
    cluster_cols: tuple[str, ...] = ("event_name",),
    num_partitions: int | None = None,
    mode: str = "overwrite",
) -> None:
    """Partition by day and cluster files by ``cluster_cols``.

    By default the rows are redistributed with a REBALANCE hint on the day:
    each writer task holds few days (no writer touches every day folder), and
    AQE splits a day that holds a large share of the rows into several
    advisory-sized tasks and merges small ones. With ``num_partitions`` a range
    partitioning on (day, cluster columns) is used instead. Sorting inside
    tasks keeps each file clustered, so Parquet min/max statistics skip row groups.
    """
    if num_partitions:
        spread = df.repartitionByRange(num_partitions, partition_col, *cluster_cols)
    else:
        spread = df.hint("rebalance", partition_col)
    (
        spread.sortWithinPartitions(partition_col, *cluster_cols)
        .write.mode(mode)
        .option("maxRecordsPerFile", 5_000_000)
        .partitionBy(partition_col)
        .parquet(path)
    )


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int | None = None) -> DataFrame:
    """A layer bucketed and sorted by ``key`` (S6), so that later aggregates and joins on it
    need no exchange; ``df`` should be a written table.

    Rows of one key lie in one bucket and are read by one task, which Spark cannot split.
    So the largest key is counted first: if it holds more than twice an even bucket, ``df``
    is returned as it is, and the usual exchanges with partial aggregation stay.
    """
    spark = df.sparkSession
    buckets = buckets or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    most, total = df.groupBy(key).count().agg(F.max("count"), F.sum("count")).first()
    if not total or most * buckets > 2 * max(total, buckets):
        return df
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    path = scratch_root(spark, name)
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return spark.table(table)


def read_date_range(spark: SparkSession, path: str, start: str, end: str, column: str = "event_date") -> DataFrame:
    """Date-range scan of a day-partitioned table; the range becomes a PartitionFilter."""
    return spark.read.parquet(path).filter(F.col(column).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def partition_values(spark: SparkSession, path: str, column: str) -> list[date]:
    """The days a table partitioned by a date column holds, from its folder names alone."""
    files, make = _files(spark, path)
    if not files.exists(make(path)):
        return []
    names = [f.getPath().getName() for f in files.listStatus(make(path)) if f.isDirectory()]
    return [date.fromisoformat(n.split("=", 1)[1]) for n in names if n.startswith(f"{column}=") and "__HIVE" not in n]


def overwrite_partitions(df: DataFrame, path: str, partition_col: str = "as_of_date") -> None:
    """Replace only the partitions present in ``df`` (S8, S10): a re-run of one
    cutoff rewrites that cutoff and leaves the others in place. Rows are staged beside
    the table until the job commits, so a failed job changes nothing."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .parquet(path)
    )


def append_run(df: DataFrame, path: str, run_id: str, partition_cols: tuple[str, ...] = ()) -> None:
    """Append-only history (S9, DQ13) that may run twice: the rows of a run are one
    partition, which a repeated append replaces. The folder is created on first write."""
    (
        df.withColumn("run_id", F.lit(run_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols, "run_id")
        .parquet(path)
    )


def new_run_id() -> str:
    """A run id that no reader takes for a number (partition values are typed by their look)."""
    return "run-" + uuid.uuid4().hex[:12]


def _files(spark: SparkSession, path: str):
    """(file system, maker of its paths) of a path."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _beside(path: str, what: str) -> str:
    """A sibling of a table's folder whose name Spark's readers skip."""
    parent, name = os.path.split(path.rstrip("/"))
    return os.path.join(parent, f"_{name}.{what}-{uuid.uuid4().hex[:12]}")


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), max_records_per_file: int = 5_000_000) -> None:
    """Materialise a model, replacing the previous version (S5) so that a failed or killed
    job leaves that version in place: the new rows are written beside the table, and only
    when all of them are there the two folders change places by rename. ``df`` may read
    the table it replaces."""
    files, make = _files(df.sparkSession, path)
    new, old = _beside(path, "new"), _beside(path, "old")
    recover(df.sparkSession, path)
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).option("partitionOverwriteMode", "static")
    try:
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(new)
    except BaseException:
        files.delete(make(new), True)
        raise
    files.mkdirs(make(path).getParent())
    had = files.exists(make(path))
    if had and not files.rename(make(path), make(old)):
        raise OSError(f"cannot move {path}")
    if not files.rename(make(new), make(path)):
        if had:
            files.rename(make(old), make(path))
        raise OSError(f"cannot move {new}")
    files.delete(make(old), True)


def recover(spark: SparkSession, path: str) -> None:
    """Put the previous version back if a driver died between the two renames of a swap."""
    files, make = _files(spark, path)
    where = make(path)
    if files.exists(where) or not files.exists(where.getParent()):
        return
    prefix = f"_{where.getName()}.old-"
    left = [f for f in files.listStatus(where.getParent()) if f.getPath().getName().startswith(prefix)]
    if left:
        files.rename(max(left, key=lambda f: f.getModificationTime()).getPath(), where)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table written by :func:`replace_table`: its last complete version."""
    recover(spark, path)
    return spark.read.parquet(path)
