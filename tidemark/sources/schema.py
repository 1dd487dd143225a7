"""Schema inference, hints, unknown fields and rescued values for JSON input."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException


def stored_schema(spark: SparkSession, schema_dir: str) -> T.StructType | None:
    """The newest schema kept in ``schema_dir``, or None."""
    try:
        rows = spark.read.schema("value string, version int").text(schema_dir)
        newest = rows.orderBy(F.desc("version")).limit(1).collect()
    except AnalysisException:
        return None
    return T.StructType.fromJson(json.loads(newest[0]["value"])) if newest else None


def store_schema(spark: SparkSession, schema_dir: str, schema: T.StructType) -> None:
    """Keep a schema as the next version. Spark writes it, so any shared storage works."""
    try:
        last = (spark.read.schema("value string, version int").text(schema_dir)
                     .agg(F.max("version")).first()[0])
    except AnalysisException:
        last = None
    version = 0 if last is None else last + 1
    (spark.createDataFrame([(schema.json(),)], "value string").coalesce(1)
     .write.mode("overwrite").text(f"{schema_dir}/version={version}"))


def apply_schema_hints(schema: T.StructType, hints: str | T.StructType) -> T.StructType:
    """Hinted types replace inferred ones; hinted fields that are missing are added."""
    wanted = hints if isinstance(hints, T.StructType) else T.StructType.fromDDL(hints)
    by_name = {f.name: f for f in wanted}
    kept = [by_name.pop(f.name, f) for f in schema]
    return T.StructType(kept + list(by_name.values()))


def merge_schemas(old: T.StructType, new: T.StructType) -> T.StructType:
    """``old`` plus the fields that only ``new`` has, also those inside structs, arrays and maps."""
    fresh = {f.name: f for f in new}
    fields = []
    for field in old:
        other = fresh.pop(field.name, None)
        fields.append(T.StructField(field.name, _merged(field.dataType, other.dataType), field.nullable) if other else field)
    return T.StructType(fields + list(fresh.values()))


def _merged(old: T.DataType, new: T.DataType) -> T.DataType:
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        return merge_schemas(old, new)
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(_merged(old.elementType, new.elementType), old.containsNull)
    if isinstance(old, T.MapType):
        if isinstance(new, T.StructType):  # inference sees a map's entries as fields
            inner = old.valueType
            for field in new:
                inner = _merged(inner, field.dataType)
            return T.MapType(old.keyType, inner, old.valueContainsNull)
        if isinstance(new, T.MapType):
            return T.MapType(old.keyType, _merged(old.valueType, new.valueType), old.valueContainsNull)
    return old


def unknown_fields(payload: Column, schema: T.StructType, prefix: str = "") -> Column:
    """Names of JSON fields that the schema does not have: nested ones as ``a.b``, in arrays as ``a[].b``, in maps as ``a{}.b``."""
    known = F.array(*[F.lit(f.name) for f in schema]).cast("array<string>")
    own = F.coalesce(F.array_except(F.json_object_keys(payload), known), F.array().cast("array<string>"))
    found = [F.transform(own, lambda k: F.concat(F.lit(prefix), k))]
    texts = F.from_json(payload, "map<string,string>")
    for field in schema:
        found.append(_unknown_inside(F.try_element_at(texts, F.lit(field.name)), field.dataType, f"{prefix}{field.name}"))
    return F.array_distinct(F.concat(*[f for f in found if f is not None]))


def _unknown_inside(text: Column, kind: T.DataType, path: str) -> Column | None:
    if isinstance(kind, T.StructType):
        return unknown_fields(text, kind, f"{path}.")
    if isinstance(kind, T.ArrayType):
        parts, inner, path = F.from_json(text, "array<string>"), kind.elementType, f"{path}[]"
    elif isinstance(kind, T.MapType):
        parts, inner, path = F.map_values(F.from_json(text, "map<string,string>")), kind.valueType, f"{path}{{}}"
    else:
        return None
    if _unknown_inside(F.lit(""), inner, path) is None:
        return None
    return F.coalesce(F.flatten(F.transform(parts, lambda t: _unknown_inside(t, inner, path))), F.array().cast("array<string>"))


def detect_new_fields(df: DataFrame, payload: str, schema: T.StructType) -> DataFrame:
    """Distinct unknown field names of a JSON column."""
    return df.select(F.explode(unknown_fields(F.col(payload), schema)).alias("field")).distinct()


def parse_json_col(df: DataFrame, payload: str, schema: T.StructType | str, out: str = "data") -> DataFrame:
    """JSON text to a struct column; text that is no JSON gives NULL."""
    return df.withColumn(out, F.from_json(payload, schema))


TEXTS = "map<string,string>"
NO_FINDINGS = "array<struct<k:string,v:string>>"


def _findings(texts: Column, typed: Column, struct: T.StructType, prefix: Column, extra: bool) -> Column:
    """``k, v`` (path, raw text) of the values of one JSON object that its typed struct lost.

    ``texts`` maps the object's own fields to their raw text. Structs, arrays and maps are
    entered; with ``extra`` fields that the schema does not have are findings too.
    """
    found = []
    for field in struct:
        text = F.try_element_at(texts, F.lit(field.name))
        found.append(_lost(text, typed[field.name], field.dataType, F.concat(prefix, F.lit(field.name)), extra))
    if extra:
        unknown = F.array_except(F.map_keys(texts), F.array(*[F.lit(f.name) for f in struct]).cast("array<string>"))
        found.append(F.transform(unknown, lambda k: F.struct(F.concat(prefix, k).alias("k"), F.try_element_at(texts, k).alias("v"))))
    return F.concat(*[F.coalesce(f, F.array().cast(NO_FINDINGS)) for f in found])


def _lost(text: Column, typed: Column, kind: T.DataType, path: Column, extra: bool) -> Column:
    """The findings below one value."""
    whole = F.array(F.struct(path.alias("k"), text.alias("v")))
    if isinstance(kind, T.StructType):
        inner = _findings(F.from_json(text, TEXTS), typed, kind, F.concat(path, F.lit(".")), extra)
        return F.when(text.isNull(), None).when(text.startswith("{"), inner).otherwise(whole)
    if isinstance(kind, T.ArrayType):
        items = F.from_json(text, "array<string>")
        inner = F.flatten(F.transform(items, lambda t, i: F.coalesce(
            _lost(t, F.get(typed, i), kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), extra),
            F.array().cast(NO_FINDINGS))))
        return F.when(text.isNull(), None).when(text.startswith("[") & typed.isNotNull(), inner).otherwise(whole)
    if isinstance(kind, T.MapType):
        entries = F.map_entries(F.from_json(text, TEXTS))
        inner = F.flatten(F.transform(entries, lambda e: F.coalesce(
            _lost(e["value"], F.try_element_at(typed, e["key"].cast(kind.keyType)), kind.valueType, F.concat(path, F.lit("."), e["key"]), extra),
            F.array().cast(NO_FINDINGS))))
        return F.when(text.isNull(), None).when(text.startswith("{") & typed.isNotNull(), inner).otherwise(whole)
    return F.when(text.isNotNull() & typed.isNull(), whole)


def parse_with_rescue(df: DataFrame, payload: str, schema: T.StructType | str,
                      rescue: str = "_incorrect_data", extra: bool = False) -> DataFrame:
    """Flatten JSON to typed columns; what the types cannot hold goes to ``rescue``.

    The row is always kept. ``rescue`` is a JSON object of path → raw text, or NULL. A
    value is a misfit when the raw object has it and the typed one does not, also inside
    structs, arrays (``a[0].b``) and maps; a list or map that parsing gives up as a whole
    is rescued as a whole. A line that is no JSON object is kept whole
    under the empty path. With ``extra`` unknown fields are rescued as well, for use where
    no stream stops on them.
    """
    schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    keep = [c for c in df.columns if c != payload]
    line = F.trim(F.col(payload))
    parsed = df.withColumn("_parsed", F.from_json(payload, schema)).withColumn("_texts", F.from_json(payload, TEXTS))
    is_object = line.startswith("{") & F.get_json_object(payload, "$").isNotNull()
    inside = _findings(F.col("_texts"), F.col("_parsed"), schema, F.lit(""), extra)
    whole = F.array(F.struct(F.lit("").alias("k"), F.col(payload).alias("v")))
    found = parsed.withColumn("_bad", F.when(F.col(payload).isNull(), None).when(is_object, inside).otherwise(whole))
    text = F.when(F.size("_bad") > 0, F.to_json(F.map_from_entries("_bad")))
    return found.select(*keep, "_parsed.*", text.alias(rescue))
