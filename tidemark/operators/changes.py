"""Row-level changes as DataFrame operators over a change log.

A change log holds the table's columns plus ``_change_type`` (``insert``,
``update_preimage``, ``update_postimage``, ``delete``), ``_commit_version`` and
``_commit_timestamp``. On storage it is Parquet with one folder per version, so a
version range prunes folders. One writer per log is assumed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import clean_quotes
from tidemark.operators.latest import latest_change, latest_per_key
from tidemark.session import materialize

# The published names of a change feed's own columns.
META = ["_change_type", "_commit_version", "_commit_timestamp"]


class Changed(NamedTuple):
    """The new table and the change rows that lead to it."""

    rows: DataFrame
    changes: DataFrame


@dataclass(frozen=True)
class Update:
    """``WHEN MATCHED [AND when] THEN UPDATE``; ``set`` None copies every column."""

    set: dict[str, Column] | None = None
    when: Column | None = None


@dataclass(frozen=True)
class Delete:
    """``WHEN MATCHED [AND when] THEN DELETE``."""

    when: Column | None = None


@dataclass(frozen=True)
class Insert:
    """``WHEN NOT MATCHED [AND when] THEN INSERT``; ``values`` None copies by name."""

    values: dict[str, Column] | None = None
    when: Column | None = None


def _true(cond: Column) -> Column:
    """SQL DML acts only where the predicate is true: NULL keeps the row."""
    return F.coalesce(cond, F.lit(False))


def _change(columns: Sequence[Column], kind: str) -> Column:
    return F.struct(*columns, F.lit(kind).alias("_change_type"))


# ---------------------------------------------------------------- plain DML

def delete_where(df: DataFrame, cond: Column) -> Changed:
    gone = df.filter(cond).withColumn("_change_type", F.lit("delete"))
    return Changed(df.filter(~_true(cond)), gone)


def update_where(df: DataFrame, cond: Column, sets: dict[str, Column]) -> Changed:
    """Set columns where ``cond`` is true; values keep the column's type."""
    types = {f.name: f.dataType for f in df.schema}
    new = {c: e.cast(types[c]) for c, e in sets.items()}
    rows = df.select(*[F.when(_true(cond), new[c]).otherwise(F.col(c)).alias(c) if c in new
                       else F.col(c) for c in df.columns])
    before = _change([F.col(c) for c in df.columns], "update_preimage")
    after = _change([new.get(c, F.col(c)).alias(c) for c in df.columns], "update_postimage")
    changes = df.filter(cond).select(F.inline(F.array(before, after)))
    return Changed(rows, changes)


def delete_in(df: DataFrame, key: str, keys: DataFrame) -> Changed:
    """Delete rows whose key occurs in ``keys`` (NULL-safe, unlike NOT IN)."""
    # Distinct on the map side first: a key that fills the list costs one row.
    wanted = keys.select(F.col(keys.columns[0]).alias(key)).distinct()
    gone = df.join(wanted, key, "left_semi").withColumn("_change_type", F.lit("delete"))
    return Changed(df.join(wanted, key, "left_anti"), gone.select(*df.columns, "_change_type"))


def forget(raw: DataFrame, typed: DataFrame, user: str, value, raw_key: str,
           raw_user: Column) -> tuple[Changed, Changed]:
    """Privacy delete of one user in both layers.

    ``raw_user`` extracts the user from the raw payload; raw rows go by ``raw_key``.
    """
    matching = raw.filter(raw_user == F.lit(value)).select(raw_key).distinct()
    return delete_in(raw, raw_key, matching), delete_where(typed, F.col(user) == F.lit(value))


# ---------------------------------------------------------------- merge

def merge(target: DataFrame, source: DataFrame, on: Sequence[str],
          clauses: Sequence[Update | Delete | Insert], unique_source: bool = False, one_pass: bool = False) -> Changed:
    """Ordered MERGE. Clause columns are written ``F.col("target.x")`` / ``F.col("source.x")``.

    The first clause whose condition is true wins; other target rows stay; NULL keys
    never match; two source rows for one target row raise an error. Set
    ``unique_source`` when the keys are known to be unique, which saves one aggregate.
    The source is read three times: pass a table rather than a costly plan.

    A left join keeps the target where it is when the source is small (a full outer
    join cannot be broadcast) and lets adaptive execution split hot target keys. With
    ``one_pass`` either side is read and shuffled once: for a source too large to broadcast,
    and a target whose keys are nearly unique.
    """
    on = list(on)
    types = {f.name: f.dataType for f in target.schema}
    if one_pass:
        return _merge_in_one_pass(target, source, on, clauses, types, unique_source)
    matched = [c for c in clauses if not isinstance(c, Insert)]
    inserts = [c for c in clauses if isinstance(c, Insert)]
    kept, changes = target, []
    if matched:
        kept, touched = _apply_matched(target, source, on, matched, types, unique_source)
        changes.append(touched)
    if inserts:
        new = _not_matched(target, source, on, inserts, types)
        kept = kept.unionByName(new)
        changes.append(new.withColumn("_change_type", F.lit("insert")))
    return Changed(kept, reduce(DataFrame.unionByName, changes))


def _merge_in_one_pass(target, source, on, clauses, types, unique_source) -> Changed:
    """Both sides as structs in one full outer join; a row of either result is unfolded from a joined pair.

    Keys with a NULL match nothing: a row hash as further key spreads them.
    """
    matched, inserts = [c for c in clauses if not isinstance(c, Insert)], [c for c in clauses if isinstance(c, Insert)]
    copies = F.lit(1) if unique_source else F.count("*").over(Window.partitionBy(*on))

    def side(df: DataFrame, name: str, *more: Column) -> DataFrame:
        no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
        keys = [F.col(k).alias(f"_{name}{n}") for n, k in enumerate(on)]
        spread = F.when(no_key, F.xxhash64(*df.columns)).otherwise(F.lit(0)).alias(f"_{name}_spread")
        return df.select(F.struct(*df.columns).alias(name), *keys, spread, *more)

    names = [*[str(n) for n in range(len(on))], "_spread"]
    pair = reduce(lambda a, b: a & b, [F.col(f"_target{n}") == F.col(f"_source{n}") for n in names])
    joined = side(target, "target").join(side(source, "source", copies.alias("_copies")), pair, "full_outer")
    old, new = F.col("target").isNotNull(), F.col("source").isNotNull()
    act = F.when(old & new & (F.col("_copies") > 1), F.raise_error(F.lit("merge: several source rows match one target row"))).cast("int")
    found = F.coalesce(act, F.when(old & new, _first_true(matched)) if matched else F.lit(None).cast("int"))
    fresh = F.when(~old, _first_true(inserts)) if inserts else F.lit(None).cast("int")
    planned = joined.withColumn("_act", found).withColumn("_new", fresh)
    before = [F.col(f"target.{c}").alias(c) for c in types]

    def image(column: str, kinds, number: Column, start: Column) -> Column:
        value = start
        for i, clause in reversed(list(enumerate(kinds))):
            if isinstance(clause, Delete):
                continue
            own = clause.values if isinstance(clause, Insert) else clause.set
            sets = {c: F.col(f"source.{c}") for c in types} if own is None else own
            if column in sets:
                value = F.when(number == i, sets[column].cast(types[column])).otherwise(value)
        return value.cast(types[column]).alias(column)

    after = [image(c, matched, F.col("_act"), F.col(f"target.{c}")) for c in types]
    added = [image(c, inserts, F.col("_new"), F.lit(None)) for c in types]
    deletes = [i for i, c in enumerate(matched) if isinstance(c, Delete)]
    is_delete = _true(F.col("_act").isin(deletes)) if deletes else F.lit(False)
    row = F.when(old & ~is_delete, F.struct(*after)).when(F.col("_new").isNotNull(), F.struct(*added))
    rows = planned.select(row.alias("r")).where("r IS NOT NULL").select("r.*")
    images = (F.when(is_delete, F.array(_change(before, "delete")))
               .when(F.col("_act").isNotNull(), F.array(_change(before, "update_preimage"), _change(after, "update_postimage")))
               .when(F.col("_new").isNotNull(), F.array(_change(added, "insert"))))
    return Changed(rows, planned.select(F.inline(images)))


def _first_true(clauses) -> Column:
    """Index of the first clause whose condition holds, NULL if none does."""
    tests = [F.when(F.lit(True) if c.when is None else _true(c.when), F.lit(i))
             for i, c in enumerate(clauses)]
    return F.coalesce(*tests)


def _apply_matched(target, source, on, clauses, types, unique_source):
    if unique_source:
        one = source.withColumn("_copies", F.lit(1))
    else:
        # Keys alone are counted: aggregating the columns, texts among them, would need sorts.
        one = source.join(source.groupBy(*on).agg(F.count("*").alias("_copies")), on)
    joined = target.alias("target").join(
        one.alias("source"),
        reduce(lambda a, b: a & b, [F.col(f"target.{k}") == F.col(f"source.{k}") for k in on]),
        "left")
    hit = F.col("source._copies")
    action = F.when(hit > 1, F.raise_error(F.lit("merge: several source rows match one target row")))
    action = action.when(hit == 1, _first_true(clauses)).cast("int")
    before = [F.col(f"target.{c}").alias(c) for c in target.columns]

    def image(column: str) -> Column:
        value = F.col(f"target.{column}")
        for i, clause in reversed(list(enumerate(clauses))):
            if isinstance(clause, Update):
                sets = ({c: F.col(f"source.{c}") for c in target.columns}
                        if clause.set is None else clause.set)
                if column in sets:
                    value = F.when(F.col("_act") == i, sets[column].cast(types[column])).otherwise(value)
        return value.alias(column)

    after = [image(c) for c in target.columns]
    planned = joined.withColumn("_act", action)
    deletes = [i for i, c in enumerate(clauses) if isinstance(c, Delete)]
    is_delete = F.col("_act").isin(deletes) if deletes else F.lit(False)
    rows = planned.filter(~_true(is_delete)).select(*after)
    pair = F.array(_change(before, "update_preimage"), _change(after, "update_postimage"))
    images = F.when(is_delete, F.array(_change(before, "delete"))).otherwise(pair)
    changes = planned.filter(F.col("_act").isNotNull()).select(F.inline(images))
    return rows, changes


def _not_matched(target, source, on, clauses, types):
    known = target.select(*on).join(source.select(*on).distinct(), on, "left_semi").distinct()
    fresh = (source.join(known, on, "left_anti").alias("source")
                   .withColumn("_act", _first_true(clauses)).filter("_act IS NOT NULL"))

    def value(column: str) -> Column:
        out = F.lit(None)
        for i, clause in reversed(list(enumerate(clauses))):
            values = ({c: F.col(f"source.{c}") for c in types}
                      if clause.values is None else clause.values)
            if column in values:
                out = F.when(F.col("_act") == i, values[column]).otherwise(out)
        return out.cast(types[column]).alias(column)

    return fresh.select(*[value(c) for c in types])


# ---------------------------------------------------------------- change data capture

def apply_cdc(target: DataFrame, batch: DataFrame, key: str, order: Sequence[Column],
              op: str = "operation", not_older: str | None = None, stage: bool = False) -> Changed:
    """Newest operation per key, then delete or upsert.

    A delete of an unknown key and a NULL operation do nothing. ``not_older`` names a
    column that keeps a late, older operation from overwriting a newer row. The merge
    reads the newest operations three times: ``stage`` writes them to the shared folder
    first, so that a large batch is scanned and ranked once.
    """
    newest = latest_per_key(batch, [key], order)
    newest = materialize(newest, "operations") if stage else newest
    is_delete, is_write = F.col(f"source.{op}") == "DELETE", F.col(f"source.{op}") != "DELETE"
    fresh = F.lit(True)
    if not_older:
        fresh = ~_true(F.col(f"source.{not_older}") < F.col(f"target.{not_older}"))
    return merge(target, newest, [key],
                 [Delete(is_delete & fresh), Update(None, is_write & fresh), Insert(None, is_write)],
                 unique_source=True)


def propagate(gold: DataFrame, changes: DataFrame, key: str, clean: Sequence[str] = (),
              stage: bool = False) -> Changed:
    """Apply a change feed downstream; ``clean`` columns lose their quotes. ``stage`` as in ``apply_cdc``."""
    newest = latest_change(changes, [key])
    for column in clean:
        newest = newest.withColumn(column, clean_quotes(column))
    newest = materialize(newest, "changes") if stage else newest
    kind = F.col("source._change_type")
    return merge(gold, newest, [key],
                 [Delete(kind == "delete"), Update(None, kind != "delete"), Insert(None, kind != "delete")],
                 unique_source=True)


def diff_changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Change rows between two states of a keyed table."""
    columns = before.columns
    old = before.withColumn("_in_old", F.lit(True)).alias("old")
    new = after.select(*columns).withColumn("_in_new", F.lit(True)).alias("new")
    on = reduce(lambda a, b: a & b, [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys])
    pre = [F.col(f"old.{c}").alias(c) for c in columns]
    post = [F.col(f"new.{c}").alias(c) for c in columns]
    same = reduce(lambda a, b: a & b,
                  [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in columns])
    images = (F.when(F.col("_in_old").isNull(), F.array(_change(post, "insert")))
               .when(F.col("_in_new").isNull(), F.array(_change(pre, "delete")))
               .when(~same, F.array(_change(pre, "update_preimage"), _change(post, "update_postimage"))))
    return old.join(new, on, "full_outer").select(F.inline(images))


# ---------------------------------------------------------------- the log

def stamp(changes: DataFrame, version: int | Column, ts: Column) -> DataFrame:
    version = version if isinstance(version, Column) else F.lit(version)
    return (changes.withColumn("_commit_version", version.cast("long"))
                   .withColumn("_commit_timestamp", ts.cast("timestamp")))


def init_change_log(df: DataFrame, ts: Column) -> DataFrame:
    """Turn an existing table into a log: every row an insert of version 0."""
    return stamp(df.withColumn("_change_type", F.lit("insert")), 0, ts)


def bucket(key: str, buckets: int) -> Column:
    """The log's folder for a key."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_version(changes: DataFrame, path: str, version: int, ts: Column, key: str | None = None,
                  buckets: int = 16, operation: str | None = None, source: str | None = None) -> None:
    """Write one version's folder. A replay of the same version replaces it.

    With ``key`` the version is split into ``buckets`` folders by key, and a small table of key
    filters says which of them may hold a key. All versions of a log must agree in this. With
    ``operation`` a commit record is kept, which ``commit_history`` reads; its counts come from
    the written ``_change_type`` column. ``source`` names what was committed, such as a batch.
    """
    rows, to = stamp(changes, version, ts).drop("_commit_version"), f"{path}/_commit_version={int(version)}"
    spark = changes.sparkSession
    if key is None:
        rows.write.mode("overwrite").parquet(to)
    else:
        rows.withColumn("_bucket", bucket(key, buckets)).write.mode("overwrite").partitionBy("_bucket").parquet(to)
        keys = spark.read.schema(T.StructType([changes.schema[key], T.StructField("_bucket", T.IntegerType())])).parquet(to)
        key_filter(keys, key).write.mode("overwrite").parquet(f"{_beside(path, 'keys')}/_commit_version={int(version)}")
    if operation:
        record = spark.read.schema("_change_type string").parquet(to).agg(*_kind_counts()).select(
            ts.cast("timestamp").alias("at"), F.lit(operation).alias("operation"), *KINDS, F.lit(source).cast("string").alias("source"))
        record.coalesce(1).write.mode("overwrite").parquet(f"{_beside(path, 'history')}/version={int(version)}")


KINDS = {"inserted": "insert", "updated": "update_postimage", "deleted": "delete"}


def _kind_counts() -> list[Column]:
    return [F.count_if(F.col("_change_type") == kind).alias(name) for name, kind in KINDS.items()]


def _beside(path: str, what: str) -> str:
    """A table of its own next to a log."""
    return f"{path.rstrip('/')}-{what}"


def commit_history(spark: SparkSession, path: str) -> DataFrame:
    """``version, at, operation, inserted, updated, deleted, source`` of every recorded commit, newest first.

    Reads the records only, never the log.
    """
    schema = ("at timestamp, operation string, inserted long, updated long, deleted long, source string, version long")
    return (spark.read.schema(schema).parquet(_beside(path, "history"))
                 .select("version", "at", "operation", "inserted", "updated", "deleted", "source").orderBy(F.desc("version")))


# The bits of one bitmap of the built-in bitmap functions.
BITMAP_BITS = 32768
#: Keys per bitmap beyond which a folder gets several: at this load a foreign key hits one time in nine.
BITMAP_KEYS = 4096


def _filter_bit(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(1)), F.lit(BITMAP_BITS))


def _filter_slice(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(2)), F.col("_slices"))


def key_filter(keys: DataFrame, key: str, folder: Sequence[str] = ("_bucket",)) -> DataFrame:
    """``folder, _slices, _slice, _bits``: the keys of each folder as bitmaps of one hash, as many as the keys need."""
    distinct = keys.where(F.col(key).isNotNull()).distinct()
    slices = distinct.groupBy(*folder).agg(F.pow(F.lit(2), F.ceil(F.log2(F.greatest(F.count("*") / BITMAP_KEYS, F.lit(1.0))))).cast("long").alias("_slices"))
    sliced = distinct.join(slices, list(folder))
    return sliced.groupBy(*folder, "_slices", _filter_slice(key).alias("_slice")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(_filter_bit(key) + 1)).alias("_bits"))


def write_filters(spark: SparkSession, path: str, key: T.StructField) -> None:
    """Key filters of every version of a log in key buckets that was not written by ``write_version``."""
    folder = T.StructField("_bucket", T.IntegerType()), T.StructField("_commit_version", T.LongType())
    keys = spark.read.schema(T.StructType([key, *folder])).parquet(path)
    names = ["_commit_version", "_bucket"]
    rows = key_filter(keys, key.name, names)
    rows.write.mode("overwrite").partitionBy("_commit_version").parquet(_beside(path, "keys"))


def folders_with(spark: SparkSession, path: str, keys: DataFrame, key: str, below: int, buckets: int) -> list[tuple[int, int]]:
    """(version, bucket) of the folders below a version that may hold one of the keys.

    A bitmap never misses a key, so the folders left out hold none. The driver sees folder
    numbers, which it lists anyway.
    """
    schema = "_bucket int, _slices long, _slice long, _bits binary, _commit_version long"
    filters = spark.read.schema(schema).parquet(_beside(path, "keys")).where(F.col("_commit_version") < below)
    wanted = keys.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_bucket", bucket(key, buckets))
    kinds = filters.select("_bucket", "_slices").distinct()
    asked = wanted.join(kinds, "_bucket").select("_bucket", "_slices", _filter_slice(key).alias("_slice"), _filter_bit(key).alias("_bit")).distinct()
    byte = F.conv(F.hex(F.substring("_bits", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = F.expr("shiftright(_byte, cast(_bit % 8 as int)) & 1") == 1
    hits = filters.join(asked, ["_bucket", "_slices", "_slice"]).withColumn("_byte", byte).where(held)
    return sorted((r[0], r[1]) for r in hits.select("_commit_version", "_bucket").distinct().collect())


def log_schema(columns: T.StructType) -> T.StructType:
    """Schema of the log of a table with these columns."""
    return T.StructType([*columns, T.StructField("_change_type", T.StringType()),
                         T.StructField("_commit_timestamp", T.TimestampType()),
                         T.StructField("_commit_version", T.LongType())])


def read_log(spark: SparkSession, path: str, columns: T.StructType | None = None) -> DataFrame:
    """The whole log; columns a later version added are NULL in earlier ones.

    Without the table's ``columns`` Spark opens every file's footer to merge schemas.
    """
    log = (spark.read.option("mergeSchema", "true").parquet(path) if columns is None
           else spark.read.schema(log_schema(columns)).parquet(path))
    plain = [c for c in log.columns if c not in META and c != "_bucket"]
    return log.select(*plain, "_change_type", F.col("_commit_version").cast("long").alias("_commit_version"),
                      "_commit_timestamp")


def table_changes(log: DataFrame, from_version: int, to_version: int | None = None) -> DataFrame:
    """Change feed between two versions, both included; open end without ``to_version``."""
    feed = log.filter(F.col("_commit_version") >= from_version)
    return feed if to_version is None else feed.filter(F.col("_commit_version") <= to_version)


def table_changes_between(log: DataFrame, start: Column, end: Column) -> DataFrame:
    """Change feed between two commit times, both included."""
    return log.filter(F.col("_commit_timestamp").between(start, end))


def as_of(log: DataFrame, keys: Sequence[str], version: int | None = None) -> DataFrame:
    """The table at a version (default: now): newest image per key, deletes dropped."""
    upto = log if version is None else log.filter(F.col("_commit_version") <= version)
    return latest_change(upto, keys).filter("_change_type != 'delete'").drop(*META)


def as_of_time(log: DataFrame, keys: Sequence[str], ts: Column) -> DataFrame:
    """The table at a point in time. A folder holds one commit time, so this prunes too."""
    return as_of(log.filter(F.col("_commit_timestamp") <= ts), keys)


def restore(log: DataFrame, keys: Sequence[str], version: int) -> DataFrame:
    """Change rows that bring the table back to ``version``."""
    return diff_changes(as_of(log, keys), as_of(log, keys, version), keys)


def clone(log: DataFrame, keys: Sequence[str], version: int | None, path: str) -> None:
    """Write the table at a version to ``path``."""
    as_of(log, keys, version).write.mode("overwrite").parquet(path)


def history(log: DataFrame) -> DataFrame:
    """Operation and rows written per version: ``WRITE``, ``UPDATE`` or ``DELETE`` where a
    version has one kind of change only, else ``MERGE``. ``commit_history`` knows the operation itself."""
    none = lambda *names: reduce(lambda a, b: a & b, [F.col(n) == 0 for n in names])
    operation = (F.when(none("updated", "deleted"), "WRITE").when(none("inserted", "deleted"), "UPDATE")
                 .when(none("inserted", "updated"), "DELETE").otherwise("MERGE"))
    return (log.groupBy("_commit_version", "_commit_timestamp").agg(*_kind_counts())
               .withColumn("operation", operation).orderBy(F.desc("_commit_version")))


def latest_version(log: DataFrame) -> int | None:
    """The newest version number (one value)."""
    return log.agg(F.max("_commit_version")).first()[0]


def expire(log: DataFrame, keys: Sequence[str], version: int) -> DataFrame:
    """Fold everything up to ``version`` into one base snapshot and keep later changes."""
    horizon = (log.filter(F.col("_commit_version") <= version)
                  .agg(F.max("_commit_timestamp").alias("ts")).scalar())
    base = stamp(as_of(log, keys, version).withColumn("_change_type", F.lit("insert")), version, horizon)
    return base.unionByName(table_changes(log, version + 1))
