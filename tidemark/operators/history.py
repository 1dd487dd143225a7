"""Features as of a time: label rows joined with a feature history, and feature tables that keep their versions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.utils import AnalysisException

from tidemark.operators.changes import Insert, Update, as_of, diff_changes, merge, write_version
from tidemark.operators.latest import latest_per_key
from tidemark.session import materialize


class History(NamedTuple):
    """Features of keys over time.

    ``order`` ranks rows of one key and time, best first; ``max_age`` (an interval such as
    ``"3 days"``) leaves a label without features when the newest are older than that.
    """

    table: DataFrame
    keys: Sequence[str]
    ts: str
    features: Sequence[str]
    order: Sequence[Column]
    max_age: str | None = None


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def time_ranges(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, _at, _is_feature, _is_label, _part``: each key's distinct times, sorted into ranges; stored.

    A range is a contiguous run of (key, time), so a key that holds most of the times spans
    several of them, and no task orders it alone.
    """
    times = events.groupBy(*keys, "_at").agg(F.bool_or("_is_feature").alias("_is_feature"), F.bool_or("_is_label").alias("_is_label"))
    return materialize(times.repartitionByRange(*keys, "_at").withColumn("_part", F.spark_partition_id()), "times")


def newest_times(ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, _at, _found``: for every label time the newest feature time at or before it; label times without one are left out.

    A running maximum inside each range, and what the ranges before carry on: one row per key
    that crosses a border.
    """
    feature = F.when(F.col("_is_feature"), F.col("_at"))
    inside = Window.partitionBy("_part", *keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ends = ranges.groupBy("_part", *keys).agg(F.max(feature).alias("_last"))
    carried = ends.select("_part", *keys, F.max("_last").over(before).alias("_carried")).where("_carried IS NOT NULL")
    seen = ranges.withColumn("_seen", F.max(feature).over(inside)).where("_is_label")
    found = seen.join(carried, ["_part", *keys], "left")
    return found.select(*keys, "_at", F.coalesce("_seen", "_carried").alias("_found")).where("_found IS NOT NULL")


def as_of_features(labels: DataFrame, history: History, label_ts: str, found_ts: str | None = None) -> DataFrame:
    """Every label row with the newest features of its key at or before its time.

    ``found_ts`` names a column for the features' own time. A label without earlier features, of
    a NULL key or without a time gets NULLs; features of a NULL key or time are never found.
    Only distinct times are put in order; rows then meet on key and time, so even the rows of
    a single key are spread over many tasks.
    """
    keys, features = list(history.keys), list(history.features)
    clash = {*features, *([found_ts] if found_ts else [])} & set(labels.columns)
    if clash:
        raise ValueError(f"label rows have columns {sorted(clash)} already")
    known = history.table.where(_all([F.col(k).isNotNull() for k in [*keys, history.ts]]))
    newest = latest_per_key(known, [*keys, history.ts], history.order).select(*keys, F.col(history.ts).alias("_found"), *features)
    mark = lambda df, at, is_feature: df.select(
        *keys, F.col(at).alias("_at"), F.lit(is_feature).alias("_is_feature"), F.lit(not is_feature).alias("_is_label"))
    asked = labels.where(_all([F.col(k).isNotNull() for k in [*keys, label_ts]]))
    found = newest_times(time_ranges(mark(known, history.ts, True).unionByName(mark(asked, label_ts, False)), keys), keys)
    if history.max_age:
        found = found.where(F.col("_found") >= F.col("_at") - F.expr(f"INTERVAL {history.max_age}"))
    rows = labels.withColumn("_at", F.col(label_ts)).join(found, [*keys, "_at"], "left")
    shown = [F.col("_found").alias(found_ts)] if found_ts else []
    return rows.join(newest, [*keys, "_found"], "left").select(*labels.columns, *shown, *features)


def training_set_as_of(labels: DataFrame, histories: Sequence[History], label: str, label_ts: str, exclude: Sequence[str] = ()) -> DataFrame:
    """Label rows with the features of every history as they were at each label's time, without the excluded columns."""
    rows = labels
    for history in histories:
        rows = as_of_features(rows, history, label_ts)
    plain = [c for c in labels.columns if c != label]
    return rows.select(*plain, *[f for h in histories for f in h.features], label).drop(*exclude)


# ------------------------------------------------- feature tables with versions

def _versions(spark: SparkSession, path: str, ts: Column | None) -> DataFrame | None:
    """The versions committed up to ``ts`` (default: all) with the columns they had; None without one.

    The driver sees one number: the newest of those versions.
    """
    try:
        log = spark.read.schema("_commit_timestamp timestamp, _commit_version long").parquet(path)
    except AnalysisException:  # nothing written yet
        return None
    last = (log if ts is None else log.where(F.col("_commit_timestamp") <= ts)).agg(F.max("_commit_version")).first()[0]
    if last is None:
        return None
    folders = [f"{path}/_commit_version={v}" for v in range(last + 1)]
    return spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*folders).withColumn("_commit_version", F.col("_commit_version").cast("long"))


def read_features(spark: SparkSession, path: str, keys: Sequence[str], ts: Column | None = None) -> DataFrame | None:
    """The feature table now or as of a commit time, with the columns it had then; None before its first version."""
    log = _versions(spark, path, ts)
    return None if log is None else as_of(log, keys)


def feature_history(spark: SparkSession, path: str, keys: Sequence[str], features: Sequence[str]) -> History:
    """All versions of a feature table as a history by commit time; a deleted row counts as one whose features are NULL."""
    log = _versions(spark, path, None)
    if log is None:
        raise ValueError(f"{path} holds no feature table")
    rows = log.where("_change_type != 'update_preimage'")
    gone = F.col("_change_type") == "delete"
    values = [F.when(~gone, F.col(c)).alias(c) for c in features]
    return History(rows.select(*keys, *values, "_commit_timestamp", "_commit_version"), keys, "_commit_timestamp", features,
                   [F.desc("_commit_version")])


def save_features(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], ts: Column, mode: str = "merge") -> int:
    """Commit ``new`` as the next version of the feature table at ``path``; returns the version.

    ``merge`` updates and adds rows by key and may add columns; ``overwrite`` leaves the rows
    and columns of ``new`` only. Rows that stay the same write nothing.
    """
    if mode not in ("merge", "overwrite"):
        raise ValueError(f"unknown mode {mode}")
    log = _versions(spark, path, None)
    if log is None:
        write_version(new.withColumn("_change_type", F.lit("insert")), path, 0, ts)
        return 0
    version = log.agg(F.max("_commit_version")).first()[0] + 1
    base = as_of(log, keys)
    added = [f for f in new.schema if f.name not in base.columns]
    wide = base.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in added])
    if mode == "overwrite":
        changes = diff_changes(wide.select(*new.columns), new, keys)
    else:
        from_new = {c: F.col(f"source.{c}") for c in new.columns}
        differs = ~_all([F.col(f"source.{c}").eqNullSafe(F.col(f"target.{c}")) for c in new.columns])
        changes = merge(wide, materialize(new, "features"), keys, [Update(from_new, differs), Insert(from_new)]).changes
    write_version(changes, path, version, ts)
    return version
