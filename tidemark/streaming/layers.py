"""Raw → typed → enriched: three restartable queries coupled only through storage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.features import enrich
from tidemark.operators.quality import enforce
from tidemark.sources.files import decode_envelope, stream_table
from tidemark.streaming.sinks import sink_append


def raw_layer(messages: DataFrame, payload: str, keep: Sequence[str], path: str, checkpoint: str,
              **trigger) -> StreamingQuery:
    """Store decoded payloads unparsed, with the kept envelope fields."""
    return sink_append(decode_envelope(messages, payload, "value", keep), path, checkpoint, **trigger)


def typed_layer(spark: SparkSession, raw_path: str, raw_schema: str, schema: str | T.StructType, path: str,
                checkpoint: str, not_null: Sequence[str] = (), checks: dict[str, str] | None = None,
                **trigger) -> StreamingQuery:
    """Parse payloads into columns, so that files can be skipped by column statistics."""
    raw = stream_table(spark, raw_path, raw_schema)
    typed = raw.select(F.from_json("value", schema).alias("data")).select("data.*")
    return sink_append(enforce(typed, not_null, checks), path, checkpoint, **trigger)


def enriched_layer(spark: SparkSession, typed_path: str, schema: str | T.StructType, static: DataFrame,
                   on: Sequence[str], path: str, checkpoint: str, salts: int = 1, **trigger) -> StreamingQuery:
    """Left join the typed stream with a label table."""
    typed = stream_table(spark, typed_path, schema)
    return sink_append(enrich(typed, static, on, salts), path, checkpoint, **trigger)
