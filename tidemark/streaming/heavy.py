"""The most frequent keys of an endless stream in a summary of fixed size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import materialize
from tidemark.streaming.sinks import sink_batches


def fold(summary: DataFrame, counts: DataFrame, key: str, size: int) -> DataFrame:
    """``key, count, error``: the summary with more counts, cut back to ``size`` keys.

    The count of the first key that no longer fits is taken off all others and added to the
    error (Misra and Gries, mergeable): a key's true count lies between ``count`` and
    ``count + error``, and that of a key without a row is at most ``error``. A row without a
    key carries the error.
    """
    error = summary.where(F.col(key).isNull()).agg(F.coalesce(F.max("error"), F.lit(0))).first()[0]
    both = summary.where(F.col(key).isNotNull()).select(key, "count").unionByName(counts.where(F.col(key).isNotNull()).select(key, "count"))
    total = both.groupBy(key).agg(F.sum("count").alias("count"))
    top = total.orderBy(F.desc("count"), F.asc(key)).limit(size + 1)
    cut = top.agg(F.when(F.count("*") > size, F.min("count")).otherwise(F.lit(0)).alias("cut"))
    kept = top.crossJoin(F.broadcast(cut)).where("count > cut").select(key, (F.col("count") - F.col("cut")).alias("count"), (F.col("cut") + error).alias("error"))
    return kept.unionByName(cut.select(F.lit(None).cast(total.schema[key].dataType).alias(key), F.lit(0).cast("long").alias("count"), (F.col("cut") + error).alias("error")))


def heavy_stream(df: DataFrame, key: str, path: str, checkpoint: str, size: int = 1000, every: str | None = None,
                 available_now: bool = False) -> StreamingQuery:
    """Keep the summary of the stream's keys: batch ``n`` reads version ``n - 1`` and writes version ``n``.

    What lives between batches is ``size`` rows, however many keys the stream has. A replayed
    batch writes the same version again. Old versions may be removed.
    """
    def update(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        counts = batch.groupBy(key).agg(F.count("*").alias("count"))
        schema = f"{key} {batch.schema[key].dataType.simpleString()}, count long, error long"
        before = read_summary(spark, path, batch_id - 1, schema) if batch_id else spark.createDataFrame([], schema)
        fold(before, counts, key, size).coalesce(1).write.mode("overwrite").parquet(f"{path}/version={batch_id}")

    return sink_batches(df, update, checkpoint, every, available_now)


def read_summary(spark: SparkSession, path: str, version: int | None = None, schema: str | None = None) -> DataFrame:
    """The summary after a batch, default the last one."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    if version is not None:
        return reader.parquet(f"{path}/version={version}")
    rows = reader.parquet(path)
    last = rows.agg(F.max("version")).first()[0]
    return rows.where(F.col("version") == last).drop("version")


def verified_top(table: DataFrame, summary: DataFrame, key: str, n: int = 10) -> DataFrame:
    """``key, count, complete``: the summary's keys counted exactly in the table, the ``n`` best of them.

    ``complete`` tells whether no other key can be among them: the n-th count exceeds the error.
    With fewer than ``n`` keys that is so where the error is zero.
    """
    error = summary.agg(F.max("error").alias("error")).scalar()
    known = summary.where(F.col(key).isNotNull()).select(key)
    counts = table.join(known, key, "left_semi").groupBy(key).agg(F.count("*").alias("count"))
    top = counts.orderBy(F.desc("count"), F.asc(key)).limit(n)
    least = top.agg(F.when(F.count("*") == n, F.min("count")).otherwise(F.lit(0)).alias("least"))
    return top.crossJoin(F.broadcast(least)).select(key, "count", ((F.col("least") > error) | (error == 0)).alias("complete"))


def exact_top(table: DataFrame, summary: DataFrame, key: str, n: int = 10) -> DataFrame:
    """``verified_top`` where the summary is certain of it; otherwise the ``n`` best of all keys, counted in the table.

    Many keys that are nearly as frequent outgrow any summary of fixed size: then every key is counted.
    """
    top = materialize(verified_top(table, summary, key, n), "top")
    if top.where("complete").limit(1).count():
        return top
    counts = table.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), F.asc(key)).limit(n).withColumn("complete", F.lit(True))
