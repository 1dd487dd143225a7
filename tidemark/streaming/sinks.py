"""Stream sinks and query control."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def _writer(df: DataFrame, checkpoint: str | None, every: str | None, available_now: bool, mode: str = "append"):
    writer = df.writeStream.outputMode(mode)
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every) if every else writer


def sink_append(df: DataFrame, path: str, checkpoint: str | None = None, every: str | None = None,
                available_now: bool = False, partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append to Parquet files, at an interval or once over what is there."""
    writer = _writer(df, checkpoint, every, available_now).format("parquet").option("path", path)
    return (writer.partitionBy(*partition_by) if partition_by else writer).start()


def sink_table(df: DataFrame, name: str, checkpoint: str | None = None, every: str | None = None,
               available_now: bool = False) -> StreamingQuery:
    """Append to a named table."""
    return _writer(df, checkpoint, every, available_now).toTable(name)


def sink_batches(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str | None = None,
                 every: str | None = None, available_now: bool = False, mode: str = "append") -> StreamingQuery:
    """Call ``fn(batch, batch_id)`` per micro-batch; ``fn`` must give the same result on a replay."""
    return _writer(df, checkpoint, every, available_now, mode).foreachBatch(fn).start()


def sink_replace(df: DataFrame, path: str, checkpoint: str | None = None, every: str | None = None,
                 available_now: bool = False) -> StreamingQuery:
    """Keep the newest complete result of a small aggregate at ``path``."""
    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return sink_batches(df, replace, checkpoint, every, available_now, mode="complete")


def set_checkpoint_root(spark: SparkSession, path: str) -> None:
    """Default folder for the checkpoints of queries that name none."""
    spark.conf.set("spark.sql.streaming.checkpointLocation", path)


def stop_all(spark: SparkSession) -> None:
    for query in spark.streams.active:
        query.stop()
