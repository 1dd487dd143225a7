"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Merge sessions on the map side before the shuffle by user.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    # Keeps large keyed state off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL: dict[str, str] = {}  # temporary folders of local sessions, by application


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder named in ``spark.checkpoint.dir``.

    Only a local session that names no folder gets a temporary one: on a cluster
    a machine-local path would be invisible to the other executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "unknown").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        app = spark.sparkContext.applicationId
        base = _LOCAL.setdefault(app, _LOCAL.get(app) or tempfile.mkdtemp(prefix="tidemark-"))
    return f"{base.rstrip('/')}/tidemark/{label}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Free on the driver what finished jobs left: plans, broadcasts and shuffles that nothing names any more.

    The driver's heap otherwise grows to its limit before the first full collection.
    """
    gc.collect()  # Python names keep their counterparts in the JVM alive
    spark.sparkContext._jvm.System.gc()


def materialize(df, label: str):
    """Write ``df`` once to the shared folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
