"""Batch and incremental file scans, file sinks and load-once ingestion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.operators.layout import data_files

Schema = str | T.StructType


def read_parquet(spark: SparkSession, path: str | list[str], schema: Schema | None = None) -> DataFrame:
    paths = [path] if isinstance(path, str) else path
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(*paths)


def read_csv(spark: SparkSession, path: str, schema: Schema, **options) -> DataFrame:
    return spark.read.schema(schema).options(**options).csv(path)


def read_json(spark: SparkSession, path: str | list[str], schema: Schema | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema is not None else spark.read).json(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Experiment runs with their ``metrics`` map."""
    return spark.read.schema("experiment_id string, run_id string, status string, artifact_uri string, "
                             "metrics map<string,double>").parquet(path)


def stream_files(spark: SparkSession, path: str, fmt: str, schema: Schema, max_files: int | None = 1,
                 **options) -> DataFrame:
    """Incremental file source, ``max_files`` new files per micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_table(spark: SparkSession, path: str, schema: Schema, max_files: int | None = None) -> DataFrame:
    """Stream the rows appended to a Parquet table.

    Rewritten rows do not show up here: read the change log for those.
    """
    return stream_files(spark, path, "parquet", schema, max_files)


def decode_envelope(df: DataFrame, payload: str = "value", out: str | None = None,
                    keep: Sequence[str] = ()) -> DataFrame:
    """Message payload (and the kept envelope fields) as strings where binary."""
    binary = {f.name for f in df.schema if isinstance(f.dataType, T.BinaryType)}
    text = lambda c: F.col(c).cast("string") if c in binary else F.col(c)
    return df.select(*[text(c).alias(c) for c in keep], F.col(payload).cast("string").alias(out or payload))


def with_source_file(df: DataFrame, name: str = "file_name") -> DataFrame:
    """Path of the file each row came from."""
    return df.select("*", F.col("_metadata.file_path").alias(name))


def write_parquet(df: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = ()) -> None:
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def copy_into(spark: SparkSession, source: str, fmt: str, schema: Schema, target: str, ledger: str,
              max_files: int | None = None) -> None:
    """Load every file of ``source`` into ``target`` exactly once; call it again for new ones.

    The streaming checkpoint at ``ledger`` is the list of loaded files, so a rerun
    opens no file it has seen. ``max_files`` cuts a large first load into several commits.
    """
    (stream_files(spark, source, fmt, schema, max_files)
     .writeStream.format("parquet").option("path", target).option("checkpointLocation", ledger)
     .trigger(availableNow=True).start().awaitTermination())


def pending_rows(df: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows of files that a ledger table (``file_name``) does not list yet.

    The listing is compared with the ledger first, so no file that is loaded is opened. The
    driver, which lists the files anyway, receives the names of the new ones.
    """
    names = data_files(df).select(F.col("file").alias("file_name"))
    new = names.join(ledger.select("file_name").distinct(), "file_name", "left_anti").collect()
    return with_source_file(df).filter(F.col("_metadata.file_path").isin([r[0] for r in new]))
