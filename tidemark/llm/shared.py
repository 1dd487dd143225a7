"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Id and text hash as one struct, in which nulls are equal; repeated rows share it."""
    return F.struct(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"))


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint where a count proves that it has at most ``rows`` rows.

    A larger one is left to a shuffle join: same result, other plan.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; pure ASCII takes the short way, with the same result."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
