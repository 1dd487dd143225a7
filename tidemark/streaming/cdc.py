"""Change data capture as streams: keyed upsert into a change log and onward."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from tidemark.operators.changes import (apply_cdc, as_of, bucket, expire, folders_with, log_schema, propagate, read_log,
                                        write_filters, write_version)
from tidemark.streaming.sinks import sink_batches


def _before(batch: DataFrame, log_path: str, version: int, key: str, columns: Sequence[str], buckets: int) -> DataFrame:
    """Current rows of the batch's keys, from the folders of lower versions whose key filters name one of them."""
    spark, table = batch.sparkSession, batch.select(*columns)
    schema = T.StructType([*log_schema(table.schema), T.StructField("_bucket", T.IntegerType())])
    try:
        folders = folders_with(spark, log_path, batch, key, version, buckets)
    except AnalysisException:  # nothing written yet
        folders = []
    if not folders:
        return table.limit(0)
    paths = [f"{log_path}/_commit_version={v}/_bucket={b}" for v, b in folders]
    older = spark.read.schema(schema).option("basePath", log_path).parquet(*paths).drop("_bucket")
    return as_of(older.join(batch.select(key).distinct(), key, "left_semi"), [key]).select(*columns)


def commit_time(spark: SparkSession, log_path: str, version: int) -> Column:
    """The commit time of a version, stored when the version is first tried: a replay finds it again."""
    path = f"{log_path.rstrip('/')}-commits/version={int(version)}"
    try:
        stored = spark.read.schema("at timestamp").parquet(path).first()
    except AnalysisException:
        stored = None
    if stored is None:
        spark.range(1).select(F.current_timestamp().alias("at")).write.mode("overwrite").parquet(path)
    return spark.read.schema("at timestamp").parquet(path).select("at").scalar()


def cdc_stream(ops: DataFrame, log_path: str, key: str, order: Sequence[Column], columns: Sequence[str],
               checkpoint: str, op: str = "operation", not_older: str | None = None, first_version: int = 0,
               every: str | None = None, available_now: bool = False, buckets: int = 16) -> StreamingQuery:
    """Apply a stream of operations to the table kept as a change log in key buckets.

    Batch ``n`` becomes version ``first_version + n``. It reads lower versions only, and of
    those only the folders whose key filters name one of its keys; how many versions there are
    is bounded by folding old ones (``compact_log``). A replayed batch rewrites its own folder
    with the same rows and the same commit time. Checkpoint and log belong together: a new
    checkpoint on an old log needs ``first_version`` above its last one.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        version = first_version + batch_id
        batch = batch.persist()  # the merge reads it several times
        try:
            target = _before(batch, log_path, version, key, columns, buckets)
            changes = apply_cdc(target, batch, key, order, op, not_older).changes
            write_version(changes, log_path, version, commit_time(batch.sparkSession, log_path, version), key, buckets,
                          "MERGE", f"batch {batch_id}")
        finally:
            batch.unpersist()

    return sink_batches(ops, apply, checkpoint, every, available_now)


def propagate_stream(feed: DataFrame, gold_log: str, key: str, columns: Sequence[str], checkpoint: str,
                     clean: Sequence[str] = (), every: str | None = None, available_now: bool = False,
                     from_version: int = 0, first_version: int = 0, buckets: int = 16) -> StreamingQuery:
    """Follow a change feed from ``from_version`` on and keep the downstream table as a change log of its own."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        version = first_version + batch_id
        batch = batch.persist()
        try:
            gold = _before(batch, gold_log, version, key, columns, buckets)
            write_version(propagate(gold, batch, key, clean).changes, gold_log, version,
                          commit_time(batch.sparkSession, gold_log, version), key, buckets, "MERGE", f"batch {batch_id}")
        finally:
            batch.unpersist()

    return sink_batches(feed.filter(F.col("_commit_version") >= from_version), apply, checkpoint, every, available_now)


def compact_log(spark: SparkSession, log_path: str, keys: Sequence[str], version: int, new_path: str,
                buckets: int = 16) -> None:
    """Write a log whose history up to ``version`` is one base snapshot, in buckets by the first key."""
    log = expire(read_log(spark, log_path), keys, version).withColumn("_bucket", bucket(keys[0], buckets))
    log.write.mode("overwrite").partitionBy("_commit_version", "_bucket").parquet(new_path)
    write_filters(spark, new_path, log.schema[keys[0]])
