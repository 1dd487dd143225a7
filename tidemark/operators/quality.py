"""Constraints, quarantine and schema rules on append."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def _rules(not_null: Sequence[str], checks: dict[str, str]) -> dict[str, Column]:
    """Rule name → condition that is true when the row breaks it."""
    broken = {f"{c} is null": F.col(c).isNull() for c in not_null}
    # SQL rule: a CHECK that evaluates to NULL passes.
    broken.update({name: ~F.coalesce(F.expr(text), F.lit(True)) for name, text in checks.items()})
    return broken


def enforce(df: DataFrame, not_null: Sequence[str] = (), checks: dict[str, str] | None = None) -> DataFrame:
    """Fail the job on the first row that breaks a constraint."""
    ok = F.lit(True)
    for name, broken in _rules(not_null, checks or {}).items():
        ok = F.when(broken, F.raise_error(F.lit(f"constraint violated: {name}")).cast("boolean")).otherwise(ok)
    return df.filter(ok)


def violations(df: DataFrame, not_null: Sequence[str] = (), checks: dict[str, str] | None = None) -> DataFrame:
    """Add ``_violations``: the names of the constraints each row breaks."""
    found = [F.when(broken, F.lit(name)) for name, broken in _rules(not_null, checks or {}).items()]
    return df.withColumn("_violations", F.array_compact(F.array(*found)))


def quarantine(df: DataFrame, not_null: Sequence[str] = (),
               checks: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean rows, rejected rows with ``_violations``)."""
    marked = violations(df, not_null, checks)
    return marked.filter(F.size("_violations") == 0).drop("_violations"), marked.filter(F.size("_violations") > 0)


def append_merge_schema(df: DataFrame, more: DataFrame) -> DataFrame:
    """Append by name; a column missing on one side is NULL there."""
    return df.unionByName(more, allowMissingColumns=True)


# Numeric types in the order in which a value fits without loss.
WIDENS = [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()]


def check_append(target: T.StructType, df: DataFrame) -> DataFrame:
    """Refuse rows whose columns or types do not fit ``target``; widen integers.

    The result has the target's columns, order and types.
    """
    extra = sorted(set(df.columns) - set(target.names))
    missing = sorted(set(target.names) - set(df.columns))
    if extra or missing:
        raise ValueError(f"append refused: unknown columns {extra}, missing columns {missing}")
    for field in target:
        have = df.schema[field.name].dataType
        if have != field.dataType and not _fits(have, field.dataType):
            raise ValueError(f"append refused: {field.name} is {have.simpleString()}, "
                             f"table has {field.dataType.simpleString()}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target])


def _fits(have: T.DataType, want: T.DataType) -> bool:
    if have in WIDENS and want in WIDENS:
        return WIDENS.index(have) <= WIDENS.index(want)
    return isinstance(have, T.FloatType) and isinstance(want, T.DoubleType)


def insert_rows(df: DataFrame, rows: Sequence[tuple]) -> DataFrame:
    """``INSERT … VALUES``: literal rows by position, cast to the table's types."""
    spark = df.sparkSession
    values = spark.createDataFrame([tuple(r) for r in rows])
    if len(values.columns) != len(df.columns):
        raise ValueError("insert: wrong number of values")
    cast = [F.col(v).cast(f.dataType).alias(f.name) for v, f in zip(values.columns, df.schema)]
    return df.union(values.select(*cast))
