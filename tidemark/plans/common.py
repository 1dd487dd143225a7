"""Shared helpers of the query catalogue."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import DEFAULTS, scratch_dir

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_session(spark: SparkSession) -> SparkSession:
    """A session of its own for streams: UTC, RocksDB state, twice as many state partitions as cores."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", "UTC")
    own.conf.set("spark.sql.shuffle.partitions", str(2 * spark.sparkContext.defaultParallelism))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", DEFAULTS["spark.sql.streaming.stateStore.providerClass"])
    own.conf.set("spark.sql.sessionWindow.merge.sessions.in.local.partition", "true")
    return own


def replay(chunks: Iterable[DataFrame], source: str, run: Callable[[], object]) -> None:
    """Let chunks arrive one after the other: append each to ``source``, then ``run()``."""
    for chunk in chunks:
        chunk.write.mode("append").parquet(source)
        run()


def folders(spark: SparkSession, label: str, *names: str) -> list[str]:
    """Fresh folders below one scratch path."""
    base = scratch_dir(spark, label)
    return [f"{base}/{name}" for name in names]
