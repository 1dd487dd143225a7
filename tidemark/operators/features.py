"""Feature tables, lookups, training sets and enrichment joins.

No join carries a broadcast hint: Spark broadcasts a side when its measured size is
below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, where
adaptive execution splits hot keys of the left side.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalars import cyclic, is_value, is_weekend
from tidemark.operators.changes import Insert, Update, merge


class Lookup(NamedTuple):
    """Features to pick from a table by key."""

    table: DataFrame
    key: str
    features: Sequence[str]


def enrich(df: DataFrame, static: DataFrame, on: Sequence[str], salts: int = 1) -> DataFrame:
    """Left join a table or stream with a static table.

    ``salts`` > 1 spreads a hot key over that many tasks by repeating the static
    side. Streams need it (adaptive execution does not split their joins); batch
    jobs and static sides below the broadcast threshold do not.
    """
    on = list(on)
    if salts <= 1:
        return df.join(static, on, "left")
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salts)))
    copies = static.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return salted.join(copies, [*on, "_salt"], "left").drop("_salt")


def sensor_features(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    return df.select(key, *columns)


def time_features(df: DataFrame, key: str, ts: str, weekend: bool = False,
                  month_period: float = 12, hour_period: float = 24) -> DataFrame:
    """Month and hour on the circle; version 2 adds a weekend flag."""
    sin_m, cos_m = cyclic(F.month(ts), month_period)
    sin_h, cos_h = cyclic(F.hour(ts), hour_period)
    columns = [cos_m.alias("cos_month"), sin_m.alias("sin_month"),
               cos_h.alias("cos_hour"), sin_h.alias("sin_hour")]
    if weekend:
        columns.append(is_weekend(ts).alias("is_weekend"))
    return df.select(key, *columns)


def damage_label(df: DataFrame, key: str, status: str, bad: str = "damaged") -> DataFrame:
    return df.select(key, is_value(status, bad).alias("damaged"))


def lookups_for(table: DataFrame, key: str) -> Lookup:
    """Every column of a feature table but its key."""
    return Lookup(table, key, [c for c in table.columns if c != key])


def _one_per_key(lookup: Lookup) -> DataFrame:
    """The picked features, with an error if a key occurs twice."""
    # Keys alone are counted: aggregating the features, texts among them, would need sorts.
    copies = lookup.table.groupBy(lookup.key).agg(F.count("*").alias("_n"))
    checked = lookup.table.select(lookup.key, *lookup.features).join(copies, lookup.key)
    several = F.raise_error(F.lit(f"feature table has several rows for one {lookup.key}")).cast("boolean")
    return checked.filter(F.when(F.col("_n") > 1, several).otherwise(F.lit(True))).drop("_n")


def join_lookups(df: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Left join every lookup; an unknown key gives NULL features."""
    for lookup in lookups:
        df = df.join(_one_per_key(lookup), lookup.key, "left")
    return df


def build_training_set(labels: DataFrame, lookups: Sequence[Lookup], label: str,
                       exclude: Sequence[str] = ()) -> DataFrame:
    """Label rows with their features, without the excluded columns."""
    features = [f for lookup in lookups for f in lookup.features]
    keys = [c for c in labels.columns if c != label]
    return join_lookups(labels, lookups).select(*keys, *features, label).drop(*exclude)


def write_features(base: DataFrame | None, new: DataFrame, keys: Sequence[str], mode: str = "merge") -> DataFrame:
    """The feature table after an overwrite or a merge by key that may add columns."""
    if mode == "overwrite" or base is None:
        return new
    if mode != "merge":
        raise ValueError(f"unknown mode {mode}")
    added = [f for f in new.schema if f.name not in base.columns]
    wide = base.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in added])
    from_new: dict[str, Column] = {c: F.col(f"source.{c}") for c in new.columns}
    return merge(wide, new, keys, [Update(from_new), Insert(from_new)]).rows


def ml_ready(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Selected columns, rows with any NULL dropped."""
    return df.select(*columns).dropna()
