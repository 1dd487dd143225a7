"""File layout: detail, compaction, clustering on several columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T

from tidemark.session import materialize

TARGET_BYTES = 128 << 20
KEY_BITS = 63      # of a signed long


def data_files(df: DataFrame) -> DataFrame:
    """``file, size`` of every file behind a file-backed DataFrame, empty ones too."""
    files = df.sparkSession.read.format("binaryFile").load(df.inputFiles())
    return files.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))


def table_detail(df: DataFrame) -> DataFrame:
    """File count, bytes and rows of a file-backed DataFrame; files without rows count."""
    rows = df.select(F.col("_metadata.file_path").alias("file")).groupBy("file").agg(F.count("*").alias("rows"))
    files = data_files(df).join(rows, "file", "left")
    return files.agg(F.count("*").alias("n_files"), F.sum("size").alias("n_bytes"),
                     F.coalesce(F.sum("rows"), F.lit(0)).alias("n_rows"))


def compact(df: DataFrame, files: int | None = None) -> DataFrame:
    """Even out partitions before a write, so that small files disappear.

    Without ``files`` adaptive execution picks the number from the real sizes.
    """
    return df.repartition(files) if files else df.hint("rebalance")


def write_compacted(df: DataFrame, path: str, max_records: int = 0) -> None:
    """Compacting write; ``max_records`` caps the rows of one file."""
    compact(df).write.option("maxRecordsPerFile", max_records).mode("overwrite").parquet(path)


def cut_points(df: DataFrame, columns: Sequence[str], cuts: int) -> dict[str, list]:
    """Per column at most ``cuts`` ascending values that split its rows into even ranges.

    Numbers and times share one aggregate; other types are counted per value and cut along
    a range sort, weighted by rows. Only the cut points reach the driver. They steer the
    layout, never the rows.
    """
    plain = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
    simple = [c for c in columns if isinstance(df.schema[c].dataType, plain)]
    at = F.array(*[F.lit((i + 1) / (cuts + 1)) for i in range(cuts)])
    row = df.agg(*[F.percentile_approx(c, at).alias(c) for c in simple]).first() if simple else {}
    found = {c: sorted(set(row[c] or [])) for c in simple}
    for c in columns:
        if c not in found:
            found[c] = _weighted_cuts(df, c, cuts)
    return found


def _weighted_cuts(df: DataFrame, column: str, cuts: int) -> list:
    """The values at which the running row count passes a multiple of 1 / (cuts + 1) of all rows."""
    values = df.select(F.col(column).alias("v")).na.drop().groupBy("v").agg(F.count("*").alias("n"))
    values = materialize(values.repartitionByRange("v").withColumn("_range", F.spark_partition_id()), "values")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = values.groupBy("_range").agg(F.sum("n").alias("s"))
    ranges = ranges.select("_range", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("_lower"), F.sum("s").over(Window.partitionBy()).alias("_all"))
    inside = Window.partitionBy("_range").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    run = values.withColumn("_upto", F.sum("n").over(inside)).join(ranges, "_range")
    share = lambda rows: F.floor(rows * F.lit(cuts + 1) / F.col("_all"))
    upto = F.col("_lower") + F.col("_upto")
    passed = run.where((share(upto) > share(upto - F.col("n"))) & (upto < F.col("_all")))
    return sorted(r["v"] for r in passed.select("v").collect())


def range_number(column: Column, cuts: Sequence) -> Column:
    """How many cut points lie below the value, found by halving; NULL counts 0."""
    def search(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(column > F.lit(cuts[mid]), search(mid + 1, hi)).otherwise(search(lo, mid))
    return search(0, len(cuts))


def zorder_key(numbers: Sequence[Column], bits: int = 6) -> Column:
    """Interleave the low bits of several range numbers into one long."""
    n = len(numbers)
    if n * bits > KEY_BITS:
        raise ValueError(f"{n} columns of {bits} bits do not fit into a key of {KEY_BITS} bits")
    parts = [F.shiftleft(F.shiftright(v.cast("long"), bit).bitwiseAND(F.lit(1).cast("long")), bit * n + i)
             for i, v in enumerate(numbers) for bit in range(bits)]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def zorder(df: DataFrame, columns: Sequence[str], files: int | None = None, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Cluster rows so that files are narrow in every column at once.

    Without ``files`` their number follows the bytes of the input's files. The bits of a
    column follow the number of files, so that cells stay smaller than files. Inside a
    cell rows are ordered by the columns, and a row hash breaks ties, so a combination
    that many rows share is cut into several partitions instead of one huge one.
    """
    if len(columns) > KEY_BITS:
        raise ValueError(f"at most {KEY_BITS} columns")
    if files is None and df.inputFiles():
        files = max(1, -(-data_files(df).agg(F.sum("size")).first()[0] // target_bytes))
    parts = files or df.sparkSession.sparkContext.defaultParallelism
    bits = min(KEY_BITS // len(columns), max(3, -(-parts.bit_length() // len(columns)) + 2))
    cuts = cut_points(df, columns, (1 << bits) - 1)
    # Stretch few ranges over all bits, so that every column weighs the same.
    numbers = [F.floor(range_number(F.col(c), cuts[c]) * (1 << bits) / (len(cuts[c]) + 1)) for c in columns]
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    keyed = df.withColumn("_z", zorder_key(numbers, bits)).withColumn("_tie", tie)
    args = [files] if files else []
    return keyed.repartitionByRange(*args, "_z", *columns, "_tie").sortWithinPartitions("_z", *columns).drop("_z", "_tie")
