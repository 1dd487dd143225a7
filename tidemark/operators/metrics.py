"""Evaluation of predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.session import materialize


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count("*").alias("count"))


def label_metrics(df: DataFrame, positive, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall and F1 of one label value."""
    said, is_ = F.col(prediction) == F.lit(positive), F.col(label) == F.lit(positive)
    counts = df.agg(F.count_if(said & is_).alias("tp"), F.count_if(said & ~is_).alias("fp"),
                    F.count_if(~said & is_).alias("fn"))
    ratio = lambda top, bottom: F.coalesce(F.try_divide(top.cast("double"), bottom), F.lit(0.0))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
                         ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def f1_rounded(df: DataFrame, label: str, probability: str) -> DataFrame:
    """F1 of the positive class after rounding the probability (half to even)."""
    rounded = df.withColumn("_said", F.rint(probability)).withColumn("_is", F.col(label).cast("double"))
    return label_metrics(rounded, 1.0, "_is", "_said").select("f1")


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve, exact with ties.

    Rows collapse to counts per distinct score, which a range sort deals to as many
    ranges as there are partitions. Ranks run inside a range, and each range starts at
    the total of the lower ones, so no task ever orders all scores. The ranges are
    stored, as two passes must see the same ones.
    """
    per_score = df.filter(F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).cast("double").alias("pos"),
        F.count_if(F.col(label) == 0).cast("double").alias("neg"))
    ranged = materialize(per_score.repartitionByRange("score").withColumn("_range", F.spark_partition_id()), "scores")
    inside = Window.partitionBy("_range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranged.withColumn("_below", F.coalesce(F.sum("neg").over(inside), F.lit(0.0)))
    pairs = F.col("pos") * (F.col("_below") + F.col("neg") / 2)
    per_range = ranked.groupBy("_range").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
                                             F.sum(pairs).alias("won"))
    # One row per partition is left: a small ordered pass joins the ranges up.
    lower = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    total = per_range.withColumn("_lower", F.coalesce(F.sum("neg").over(lower), F.lit(0.0)))
    won = F.sum(F.col("won") + F.col("pos") * F.col("_lower"))
    return total.agg(F.try_divide(won, F.sum("pos") * F.sum("neg")).alias("auc"))


def mean_abs(df: DataFrame, columns: Sequence[str], n: int = 6) -> DataFrame:
    """Columns with the largest mean absolute value."""
    wide = df.agg(*[F.avg(F.abs(c)).alias(c) for c in columns])
    rows = [F.struct(F.col(c).alias("mean_abs"), F.lit(c).alias("column")) for c in columns]
    return wide.select(F.inline(F.array(*rows))).orderBy(F.desc("mean_abs"), "column").limit(n)
