"""JSON lines as VARIANT values: parsed once, then typed, rescued and inferred by walking the value."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidemark.sources.schema import apply_schema_hints, store_schema, stored_schema

FINDINGS = "array<struct<k:string,v:string>>"
NUMBERS = ("BIGINT", "DOUBLE", "FLOAT", "DECIMAL", "INT", "SMALLINT", "TINYINT")


# ------------------------------------------------- inference

def schema_of_lines(lines: DataFrame, payload: str = "value") -> T.StructType:
    """Schema of every JSON object of the column: one distributed aggregate, no sample.

    Decimals become doubles. A field whose values agree on no type is a string, as is one that
    is always null. Lines that are no objects, or of no JSON, have no say.
    """
    value = F.try_parse_json(F.col(payload))
    objects = lines.select(value.alias("v")).where(F.schema_of_variant("v").startswith("OBJECT"))
    found = objects.agg(F.schema_of_variant_agg("v").alias("s")).first()["s"]
    return _plain(T.StructType.fromDDL(_ddl(found))) if found and found.startswith("OBJECT<") else T.StructType()


def _ddl(found: str) -> str:
    """The aggregate's type as the fields of a struct; names stay quoted as they are."""
    inner = re.sub(r"\bOBJECT<", "STRUCT<", found)
    inner = re.sub(r"\bSTRUCT<>", "STRING", inner)
    inner = re.sub(r"\bVOID\b", "STRING", re.sub(r"\bVARIANT\b", "STRING", inner))
    return inner[len("STRUCT<"):-1]


def _plain(kind):
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain(kind.elementType))
    return T.DoubleType() if isinstance(kind, T.DecimalType) else kind


def field_counts(lines: DataFrame, payload: str = "value") -> DataFrame:
    """``field, n``: how many lines hold each top-level field."""
    names = F.map_keys(_entries(F.try_parse_json(F.col(payload))))
    return lines.select(F.explode(names).alias("field")).groupBy("field").agg(F.count("*").alias("n"))


def infer_and_store(spark: SparkSession, path: str, schema_dir: str, hints: str | None = None) -> T.StructType:
    """Schema of all JSON files below ``path``, inferred once and kept for later runs."""
    schema = stored_schema(spark, schema_dir)
    if schema is None:
        schema = schema_of_lines(spark.read.text(path))
        schema = apply_schema_hints(schema, hints) if hints else schema
        store_schema(spark, schema_dir, schema)
    return schema


# ------------------------------------------------- typed columns and what they lose

def _child(value: Column, name: str) -> Column:
    quoted = name.replace("\\", "\\\\").replace("'", "\\'")
    return F.try_variant_get(value, f"$['{quoted}']", "variant")


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _text(value: Column) -> Column:
    """A string as it is, anything else as JSON."""
    return F.when(_kind(value) == "STRING", F.try_variant_get(value, "$", "string")).otherwise(F.to_json(value))


def _fits(value: Column, kind: T.DataType) -> Column:
    """Whether a plain value is of the JSON kind that the type takes: no number from a string, no whole number from a fraction."""
    found = _kind(value)
    if isinstance(kind, T.IntegralType):
        return found == "BIGINT"
    if isinstance(kind, T.NumericType):
        return F.split(found, r"\(")[0].isin(*NUMBERS)
    if isinstance(kind, T.BooleanType):
        return found == "BOOLEAN"
    return found == "STRING"


def typed(value: Column, kind: T.DataType) -> Column:
    """The value as ``kind``; NULL where it does not fit."""
    if isinstance(kind, T.StructType):
        inner = F.struct(*[typed(_child(value, f.name), f.dataType).alias(f.name) for f in kind])
        return F.when(_kind(value).startswith("OBJECT"), inner)
    if isinstance(kind, T.ArrayType):
        return F.when(_kind(value).startswith("ARRAY"), F.transform(_items(value), lambda v: typed(v, kind.elementType)))
    if isinstance(kind, T.MapType):
        return F.when(_kind(value).startswith("OBJECT"), F.transform_values(_entries(value), lambda _, v: typed(v, kind.valueType)))
    if isinstance(kind, T.StringType):
        return F.when(_kind(value) != "VOID", _text(value))
    return F.when(_fits(value, kind), F.try_variant_get(value, "$", kind.simpleString()))


def _items(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _entries(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>")


def lost(value: Column, kind: T.DataType, path: Column, extra: bool, joint: str = ".") -> Column:
    """``k, v`` (path, text) of the values that ``typed`` gives up, below and including this one; ``joint`` stands before a field."""
    none = F.array().cast(FINDINGS)
    whole = F.array(F.struct(path.alias("k"), _text(value).alias("v"))).cast(FINDINGS)
    there = value.isNotNull() & (_kind(value) != "VOID")
    if isinstance(kind, T.StructType):
        parts = [lost(_child(value, f.name), f.dataType, F.concat(path, F.lit(f"{joint}{f.name}")), extra) for f in kind]
        if extra:
            names = F.array_except(F.map_keys(_entries(value)), F.array(*[F.lit(f.name) for f in kind]).cast("array<string>"))
            parts.append(F.transform(names, lambda n: F.struct(F.concat(path, F.lit(joint), n).alias("k"), _text(F.try_element_at(_entries(value), n)).alias("v"))))
        inner = F.concat(*[F.coalesce(p, none) for p in parts]) if parts else none
        return F.when(there & _kind(value).startswith("OBJECT"), inner).when(there, whole).otherwise(none)
    if isinstance(kind, T.ArrayType):
        inner = F.flatten(F.transform(_items(value), lambda v, i: lost(v, kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), extra)))
        return F.when(there & _kind(value).startswith("ARRAY"), inner).when(there, whole).otherwise(none)
    if isinstance(kind, T.MapType):
        inner = F.flatten(F.transform(F.map_entries(_entries(value)), lambda e: lost(e["value"], kind.valueType, F.concat(path, F.lit("."), e["key"]), extra)))
        return F.when(there & _kind(value).startswith("OBJECT"), inner).when(there, whole).otherwise(none)
    return F.when(there & typed(value, kind).isNull(), whole).otherwise(none)


def parse_with_rescue(df: DataFrame, payload: str, schema: T.StructType | str, rescue: str = "_incorrect_data",
                      extra: bool = False) -> DataFrame:
    """Typed columns and a ``rescue`` column of what they cannot hold, from one parse of each line.

    The row is always kept. ``rescue`` is a JSON object of path to text, or NULL: misfits inside
    structs, arrays (``a[0].b``) and maps each under its own path, the whole line under the empty
    path where it is no JSON object. Texts are those of the parsed value: a rescued ``1.50`` reads
    ``1.5``; ``sources.schema.parse_with_rescue`` keeps the raw text and parses again for it.
    A list or map with a misfit keeps its other items. With ``extra`` unknown fields are rescued too.
    """
    schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    keep = [c for c in df.columns if c != payload]
    parsed = df.withColumn("_variant", F.try_parse_json(F.col(payload)))
    value = F.col("_variant")
    is_object = F.coalesce(_kind(value).startswith("OBJECT"), F.lit(False))
    whole = F.array(F.struct(F.lit("").alias("k"), F.col(payload).alias("v"))).cast(FINDINGS)
    bad = F.when(F.col(payload).isNull(), None).when(is_object, lost(value, schema, F.lit(""), extra, "")).otherwise(whole)
    columns = [F.when(is_object, typed(_child(value, f.name), f.dataType)).alias(f.name) for f in schema]
    found = parsed.select(*keep, *columns, bad.alias("_bad"))
    return found.select(*keep, *schema.names, F.when(F.size("_bad") > 0, F.to_json(F.map_from_entries("_bad"))).alias(rescue))
