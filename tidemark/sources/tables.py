"""Catalog helpers: databases, tables, views, resets, and publishing to a store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from tidemark.operators.latest import latest_per_key


def use_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a database if needed and make it current."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")
    spark.sql(f"USE `{name}`")


def create_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Register Parquet files as a table."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
    return spark.table(name)


def create_table_as(df: DataFrame, name: str, mode: str = "overwrite") -> DataFrame:
    df.write.mode(mode).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def reset_tables(spark: SparkSession, names: Sequence[str]) -> None:
    """Drop tables for a fresh start."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Make a table or stream available to SQL."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def online_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The rows an online store should hold: the newest per key."""
    return latest_per_key(df, keys, order)


def publish_table(df: DataFrame, keys: Sequence[str], order: Sequence[Column], url: str, table: str,
                  properties: dict[str, str] | None = None, partitions: int = 8) -> None:
    """Write the newest row per key over JDBC; ``partitions`` bounds the connections.

    A repartition, not a coalesce: the ranking before it keeps its full parallelism.
    """
    (online_rows(df, keys, order).repartition(partitions)
     .write.jdbc(url, table, mode="overwrite", properties=properties or {}))
