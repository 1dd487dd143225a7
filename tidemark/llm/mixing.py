"""Mix sources to target weights by capped water-filling, in whole and fractional repetitions.

Every step is a pre-aggregated Spark job. The driver sees two sums per round of the
water-filling, never a source or a document. Sources are numbered by a range sort, and
the running word count that ends a fractional repetition is a prefix sum in three levels
(bucket, sub-bucket, row), so a source that holds a third of all rows is spread over
65,536 groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

# A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    """Words in a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``no``, its place (from 1) in the given order, without a global window.

    Ranges are sorted apart; a small table with one row per range carries the offsets.
    """
    ranges = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    ranges = materialize(ranges, "ranges")
    sizes = ranges.groupBy("_range").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (ranges.withColumn("_local", local).join(offsets, "_range")
            .withColumn("no", F.col("_local") + F.col("_before")).drop("_range", "_local", "_before"))


def water_level(sources: DataFrame, share: float, max_epochs: float) -> float:
    """The level L at which ``min(max_epochs * source_size, L * weight)`` sums to ``share`` of all words.

    Each round clamps the sources whose cap lies below the level and shares the rest out
    again by weight. The level only rises, so the rounds end.
    """
    level, clamped = 0.0, -1
    cap, weight = F.col("source_size") * F.lit(max_epochs), F.col("weight")
    while True:
        full = cap < weight * F.lit(level)
        row = sources.agg(
            F.sum("source_size").alias("words"), F.count(F.when(full, 1)).alias("clamped"),
            F.sum(F.when(full, cap)).alias("taken"), F.sum(F.when(~full, weight)).alias("free")).first()
        if row.clamped == clamped or not row.free:
            return level
        clamped = row.clamped
        level = (share * row.words - (row.taken or 0.0)) / row.free


def mix(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, max_epochs: float = 2.0, seed: int = 17,
        id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """How often each document is taken so that sources meet their target word counts.

    Sources in code-point order, null last, weigh ``weights`` in turn and together get
    ``share`` times all words; no source is taken more than ``max_epochs`` times. A target
    is met by whole repetitions of the source and one fractional one, which takes the
    documents in the order of a seeded hash up to the budget; the document on the border
    is taken if that comes nearer. The result depends on ids, sizes and sources only, so
    reruns and lost executors change nothing.

    Returns ``doc_id, source, size, source_size, target, copies, taken``, one row per input
    row. Null text has size 0; null ids and repeated ids are rows like others (equal rows
    are interchangeable); sources without words have target 0; an empty table gives no rows.
    Other columns are ignored.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"),
                       F.coalesce(F.col(source_col), F.lit("")).alias("_src"), F.col(source_col).isNull().alias("_nul"),
                       F.substring(digest, 1, 2).alias("_b1"), F.substring(digest, 3, 2).alias("_b2"), digest.alias("_key"))
    rows = materialize(rows, "sizes")
    key = ["_src", "_nul"]

    leaves = rows.groupBy(*key, "_b1", "_b2").agg(F.sum("size").alias("_words"))
    sources = leaves.groupBy(*key).agg(F.sum("_words").alias("source_size"))
    sources = numbered(sources, F.col("_nul").asc(), F.col("_src").asc())
    place = F.array(*[F.lit(w) for w in weights])
    sources = sources.withColumn("weight", F.element_at(place, ((F.col("no") - 1) % len(weights) + 1).cast("int")))
    sources = materialize(sources, "sources")
    level = water_level(sources, share, max_epochs)
    target = F.least(F.col("source_size") * F.lit(max_epochs), F.col("weight") * F.lit(level))
    whole = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size"))).otherwise(F.lit(0))
    sources = sources.select(*key, "source_size", target.alias("target"), whole.cast("long").alias("_whole"))

    below = Window.partitionBy(*key, "_b1").orderBy("_b2").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*key).orderBy("_b1").rowsBetween(Window.unboundedPreceding, -1)
    buckets = (leaves.groupBy(*key, "_b1").agg(F.sum("_words").alias("_sum"))
               .select(*key, "_b1", F.coalesce(F.sum("_sum").over(across), F.lit(0)).alias("_from1")))
    leaves = leaves.select(*key, "_b1", "_b2", F.coalesce(F.sum("_words").over(below), F.lit(0)).alias("_from2"))
    leaves = leaves.join(buckets.join(sources, key), [*key, "_b1"])
    leaves = leaves.withColumn("_from", F.col("_from1") + F.col("_from2")).drop("_from1", "_from2")

    inside = Window.partitionBy(*key, "_b1", "_b2").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(leaves, [*key, "_b1", "_b2"]).withColumn(
        "_at", F.col("_from") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    budget = F.col("target") - F.col("_whole") * F.col("source_size")
    part = (F.col("_at") + F.col("size") / 2 <= budget) & (budget > 0)
    copies = F.col("_whole") + F.when(part, 1).otherwise(0)
    return placed.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                         (copies * F.col("size")).alias("taken"))


def sample(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """The mixed corpus: ``doc_id, source, text, epoch, size, target``, one row per repetition.

    Of rows that repeat an id, each has its own number of repetitions where their sizes or
    sources differ; equal rows are taken alike.
    """
    taken = mix(docs, id_col=id_col, source_col=source_col, text_col=text_col, **options)
    taken = taken.where("copies > 0").groupBy("doc_id", "source", "size").agg(
        F.max("copies").alias("copies"), F.max("target").alias("target"))
    key = F.struct("doc_id", "source", "size").alias("key")  # nulls inside a struct are equal
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"),
                       n_words(F.col(text_col)).alias("size"))
    rows = rows.select(key, "doc_id", "source", "text", "size").join(taken.select(key, "copies", "target"), "key")
    epochs = F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("epoch")
    return rows.select("doc_id", "source", "text", epochs, "size", "target")
