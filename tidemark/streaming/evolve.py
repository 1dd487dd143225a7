"""A JSON stream that stops on unknown fields, widens its schema and starts again."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.sources.schema import (apply_schema_hints, merge_schemas, parse_with_rescue, store_schema,
                                     stored_schema, unknown_fields)
from tidemark.sources.variants import infer_and_store, schema_of_lines
from tidemark.streaming.sinks import sink_batches

UNKNOWN = "unknown fields in the stream"


class UnknownFields(RuntimeError):
    """Raised inside a micro-batch after the wider schema has been stored."""


def _is_odd(schema: T.StructType) -> Column:
    return F.size(unknown_fields(F.col("value"), schema)) > 0


def start_json_stream(spark: SparkSession, source: str, target: str, schema_dir: str, checkpoint: str,
                      hints: str | None = None, rescue: str = "_incorrect_data",
                      max_files: int | None = None) -> StreamingQuery:
    """Parse JSON lines with the stored schema, at first that of all lines there are; misfits go to ``rescue``.

    A batch with unknown fields fails its write, stores the wider schema and stops the query.
    A batch writes its own folder, so a replay replaces it.
    """
    schema = infer_and_store(spark, source, schema_dir, hints)
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def widen(batch: DataFrame) -> None:
        """Infer the odd lines' fields on the cluster; only the merged schema comes back."""
        wider = merge_schemas(schema, schema_of_lines(batch.filter(_is_odd(schema))))
        store_schema(batch.sparkSession, schema_dir, apply_schema_hints(wider, hints) if hints else wider)

    def write(batch: DataFrame, batch_id: int) -> None:
        # The check rides along with the write, so a batch without news is read once.
        checked = batch.filter(F.when(_is_odd(schema), F.raise_error(F.lit(UNKNOWN)).cast("boolean"))
                                .otherwise(F.lit(True)))
        try:
            (parse_with_rescue(checked, "value", schema, rescue)
             .write.mode("overwrite").parquet(f"{target}/batch={batch_id}"))
        except Exception as error:
            if UNKNOWN in str(error):
                widen(batch)
                raise UnknownFields(UNKNOWN) from None
            raise

    return sink_batches(reader.text(source), write, checkpoint, available_now=True)


def run_with_schema_evolution(start, schema_dir: str) -> StreamingQuery:
    """Run ``start()`` to its end, again after each stop for unknown fields.

    Every stop must have widened the schema in ``schema_dir``: one that has not would
    only be repeated.
    """
    spark = SparkSession.active()
    before = stored_schema(spark, schema_dir)
    while True:
        query = start()
        try:
            query.awaitTermination()
            return query
        except StreamingQueryException as error:
            after = stored_schema(spark, schema_dir)
            if UNKNOWN not in str(error) or after == before:
                raise
            before = after


def read_evolved(spark: SparkSession, target: str) -> DataFrame:
    """Everything written so far; columns added later are NULL in earlier batches."""
    return spark.read.option("mergeSchema", "true").parquet(target).drop("batch")
