"""Scalar expressions shared by the operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def weekday_sun0(day: Column | str) -> Column:
    """Day of week, Sunday = 0 … Saturday = 6."""
    return F.dayofweek(day) - 1


def is_weekend(day: Column | str) -> Column:
    """1 on Saturday and Sunday, else 0."""
    return F.dayofweek(day).isin(1, 7).cast("int")


def month_start(day: Column | str) -> Column:
    return F.trunc(day, "MM")


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    """(sin, cos) of a value that repeats every ``period``."""
    angle = F.lit(2 * math.pi) * value / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def clean_quotes(text: Column | str) -> Column:
    return F.regexp_replace(text, '"', "")


def threshold_label(value: Column | str, threshold: float, below: str, otherwise: str) -> Column:
    """``below`` under the threshold, ``otherwise`` from it on, NULL for NULL."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(value < threshold, below).when(value >= threshold, otherwise)


def is_value(value: Column | str, wanted) -> Column:
    """Equality as a boolean label."""
    value = F.col(value) if isinstance(value, str) else value
    return value == F.lit(wanted)


def metric(metrics: Column | str, name: str) -> Column:
    """One entry of a metrics map, NULL when the run did not log it."""
    return F.try_element_at(metrics, F.lit(name))


def name_of(key: Column, names: dict[str, str]) -> Column:
    """Look a key up in a small fixed dictionary."""
    pairs = [F.lit(part) for item in names.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), key)


def cluster_name(cluster: Column | str, names: dict[str, str]) -> Column:
    """Name of a zero-based cluster id in a dictionary keyed ``cluster_1``, ``cluster_2``, …"""
    number = F.col(cluster) if isinstance(cluster, str) else cluster
    return name_of(F.concat(F.lit("cluster_"), (number + 1).cast("int").cast("string")), names)
