"""Classification, clustering and scoring with Spark ML."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import Bucketizer, MinMaxScaler, StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.util import inheritable_thread_target

from tidemark.functions.scalars import cluster_name, threshold_label
from tidemark.operators.features import Lookup, join_lookups
from tidemark.session import scratch_dir


def _prepare(features: Sequence[str], label: str) -> list:
    return [VectorAssembler(inputCols=list(features), outputCol="assembled"),
            StandardScaler(inputCol="assembled", outputCol="features"),
            StringIndexer(inputCol=label, outputCol="label")]


def damage_classifier(features: Sequence[str], label: str, depths: Sequence[int] = (3, 4, 5), iterations: int = 5,
                    folds: int = 2, weight: str | None = None, parallelism: int = 3, seed: int = 42) -> Pipeline:
    """Assemble, scale, index the label, boosted trees; depth chosen by cross-validated F1."""
    gbt = GBTClassifier(labelCol="label", featuresCol="features", maxIter=iterations, seed=seed)
    if weight:
        gbt = gbt.setWeightCol(weight)
    search = CrossValidator(estimator=gbt, numFolds=folds, parallelism=parallelism, seed=seed,
                            estimatorParamMaps=ParamGridBuilder().addGrid(gbt.maxDepth, list(depths)).build(),
                            evaluator=MulticlassClassificationEvaluator(metricName="f1"))
    return Pipeline(stages=[*_prepare(features, label), search])


def train(pipeline: Pipeline, df: DataFrame, columns: Sequence[str]) -> PipelineModel:
    """Fit ``damage_classifier``. Trees see bins only, so all rows that agree in bins, label and fold are
    one weighted row: the passes of the search run over these, whose number the bins bound, not over the rows.

    Every row is in the bins, a weight and the F1 of its fold, and counts in the nodes of the trees.
    """
    assembler, scaler, indexer, search = pipeline.getStages()
    features, gbt, evaluator = assembler.getInputCols(), search.getEstimator(), search.getEvaluator()
    weight = F.col(gbt.getWeightCol()) if gbt.isSet(gbt.weightCol) else F.lit(1.0)
    ready = df.select(*columns).persist(StorageLevel.DISK_ONLY)
    try:
        bins = tree_bins(ready, features, weight)
        marked = bins.transform(ready).withColumn("fold", F.floor(F.rand(search.getSeed()) * search.getNumFolds()).cast("int"))
        cells = marked.groupBy(*bins.getOutputCols(), indexer.getInputCol(), "fold").agg(
            F.sum(weight).alias("cell_weight"), F.count("*").cast("double").alias("rows"))
        cells = cells.repartition(df.sparkSession.sparkContext.defaultParallelism).persist()
        try:
            weighted = search.copy().setFoldCol("fold").setEvaluator(evaluator.copy({evaluator.weightCol: "rows"}))
            weighted.setEstimator(gbt.copy({gbt.weightCol: "cell_weight", gbt.maxBins: ALL_CUTS}))
            return _fit_cells(cells, bins, scaler, indexer, weighted)
        finally:
            cells.unpersist()
    finally:
        ready.unpersist()


def _fit_cells(cells: DataFrame, bins: Bucketizer, scaler: StandardScaler, indexer: StringIndexer, search: CrossValidator) -> PipelineModel:
    label = indexer.getInputCol()
    sizes = cells.where(F.col(label).isNotNull()).groupBy(label).agg(F.sum("rows").alias("n")).orderBy(F.desc("n"), label).collect()
    labels = StringIndexerModel.from_labels([r[label] for r in sizes], inputCol=label, outputCol=indexer.getOutputCol())
    assembler = VectorAssembler(inputCols=bins.getOutputCols(), outputCol=scaler.getInputCol())
    scaled = Pipeline(stages=[assembler, scaler, labels]).fit(cells)
    ready = scaled.transform(cells).select(scaler.getOutputCol(), indexer.getOutputCol(), "fold", "cell_weight", "rows").persist()
    try:
        found = search.fit(ready)
        found.bestModel = count_rows(found.bestModel, ready)
    finally:
        ready.unpersist()
    return PipelineModel([bins, *scaled.stages, found])


def count_rows(model: GBTClassificationModel, cells: DataFrame, vector: str = "features") -> GBTClassificationModel:
    """The model with the rows of ``cells`` that reach a node as its ``rawCount``; Spark counts cells."""
    spark = cells.sparkSession
    path = scratch_dir(spark, "cell-trees")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    held, schema = nodes.collect(), nodes.schema
    trees: dict[int, dict[int, tuple]] = {}
    for r in held:
        n = r["nodeData"]
        cut = n["split"]["leftCategoriesOrThreshold"]
        trees.setdefault(r["treeID"], {})[n["id"]] = (n["leftChild"], n["rightChild"], n["split"]["featureIndex"], cut[0] if cut else None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            x, rows, out = pdf.to_numpy()[:, :-1], pdf["rows"].to_numpy(), []
            for tree, kinds in trees.items():
                stack = [(0, np.arange(len(x)))]
                while stack:
                    at, here = stack.pop()
                    out.append((tree, at, rows[here].sum()))
                    left, right, feature, cut = kinds[at]
                    if left >= 0:
                        goes = x[here, feature] <= cut
                        stack += [(left, here[goes]), (right, here[~goes])]
            yield pd.DataFrame(out, columns=["tree", "node", "n"])

    values = [vector_to_array(vector)[i].alias(f"x{i}") for i in range(model.numFeatures)]
    counted = cells.select(*values, "rows").mapInPandas(run, "tree int, node int, n double")
    rows = {(r["tree"], r["node"]): int(r["n"]) for r in counted.groupBy("tree", "node").agg(F.sum("n").alias("n")).collect()}
    changed = [Row(**{**r.asDict(), "nodeData": Row(**{**r["nodeData"].asDict(), "rawCount": rows[r["treeID"], r["nodeData"]["id"]]})}) for r in held]
    spark.createDataFrame(changed, schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
    return GBTClassificationModel.load(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def best_trees(model: PipelineModel):
    """The boosted-tree model a fitted pipeline ends in."""
    last = model.stages[-1]
    return getattr(last, "bestModel", last)


BINS = 32  # Spark's trees look at no more bins of a feature by default
ALL_CUTS = 2048  # tells Spark's trees to look for cuts in all cells, up to this number's square, instead of 10,000
GRID = 1024  # a feature with more values is weighed in as many equally full intervals


def tree_cuts(held: Sequence[tuple[float, float, float]], n_bins: int) -> list[float]:
    """The cut points that Spark's trees try of a feature, given its values or intervals in order: least, greatest, weight."""
    if len(held) <= n_bins:
        return [(a[1] + b[0]) / 2 for a, b in zip(held, held[1:])]
    stride = sum(w for *_, w in held) / n_bins
    cuts, count, goal = [], held[0][2], stride
    for (_, high, _), (low, _, weight) in zip(held, held[1:]):
        before, count = count, count + weight
        if abs(before - goal) < abs(count - goal):
            cuts.append((high + low) / 2)
            goal += stride
    return cuts


def tree_bins(df: DataFrame, features: Sequence[str], weight: Column) -> Bucketizer:
    """Bins between the cut points that Spark's trees try, from the weights of all rows: Spark itself takes those of 10,000."""
    value = {f: F.col(f).cast("double") for f in features}
    row = df.agg(F.count("*").alias("n"), *[F.approx_count_distinct(value[f]).alias(f"n_{f}") for f in features]).first()
    many = [f for f in features if row[f"n_{f}"] > GRID]
    shares = F.expr(f"array({', '.join(f'{k / GRID}D' for k in range(1, GRID))})")
    edges = df.agg(*[F.percentile_approx(value[f], shares, F.lit(10000)).alias(f) for f in many]).first() if many else {}
    weighed = []
    for f in features:
        known = df.select(value[f].alias("value"), weight.alias("w")).where("value IS NOT NULL AND NOT isnan(value)")
        if f in many:
            known = Bucketizer(splits=[-np.inf, *sorted(set(edges[f])), np.inf], inputCol="value", outputCol="cell").transform(known)
        else:
            known = known.withColumn("cell", F.col("value"))
        weighed.append(known.groupBy("cell").agg(F.lit(f).alias("feature"), F.min("value").alias("low"), F.max("value").alias("high"), F.sum("w").alias("w")))
    held: dict[str, list] = {f: [] for f in features}
    for r in reduce(DataFrame.unionByName, weighed).orderBy("low").collect():
        held[r["feature"]].append((r["low"], r["high"], r["w"]))
    splits = []
    for f in features:
        # A bin begins above its cut point: trees send the point itself to the left.
        cuts = sorted({float(np.nextafter(c, np.inf)) for c in tree_cuts(held[f], min(BINS, row["n"]))})
        splits.append([-np.inf, *cuts, np.inf] if cuts else [-np.inf, 0.0, np.inf])
    return Bucketizer(splitsArray=splits, inputCols=list(features), outputCols=[f"{f}_bin" for f in features])


def binner(df: DataFrame, features: Sequence[str]) -> Bucketizer:
    """At most ``BINS`` bins per feature from all rows: one for each value where there are few, else equally full ones."""
    shares = [k / BINS for k in range(1, BINS)]
    row = df.agg(*[F.approx_count_distinct(f, 0.01).alias(f"n_{f}") for f in features],
                 *[F.percentile_approx(F.col(f).cast("double"), shares, 10000).alias(f"q_{f}") for f in features]).first()
    few = [f for f in features if row[f"n_{f}"] <= 2 * BINS]
    values = df.agg(*[F.sort_array(F.collect_set(F.col(f).cast("double"))).alias(f) for f in few]).first() if few else {}
    splits = []
    for f in features:
        held = values[f] if f in few else []
        cuts = held[1:] if f in few and len(held) <= BINS else sorted(set(row[f"q_{f}"] or []))
        splits.append([float("-inf"), *cuts, float("inf")] if cuts else [float("-inf"), 0.0, float("inf")])
    return Bucketizer(splitsArray=splits, inputCols=list(features), outputCols=[f"{f}_bin" for f in features])


def random_search(df: DataFrame, features: Sequence[str], label: str, trials: int = 16, iterations: int = 20,
                  depth: tuple[int, int] = (2, 8), parallelism: int = 4, seed: int = 123) -> tuple[PipelineModel, DataFrame]:
    """Random draws of depth, learning rate and leaf size, judged by AUC on a hold-out.

    Returns the fitted pipeline and one row per trial. Trees see bins only, so all rows that agree
    in bins, label and part are one weighted row: the passes of the trials run over these, whose
    number the bins bound, not over the rows. Every row is in the bins, a weight or the AUC. The
    least leaf is a share of the weight, so it counts rows as well.
    """
    rng = random.Random(seed)
    draws = [(rng.randint(*depth), float(np.exp(rng.uniform(-5, -0.5))), round(float(np.exp(rng.uniform(0, 3))))) for _ in range(trials)]
    bins, (assembler, scaler, indexer) = binner(df, features), _prepare([f"{f}_bin" for f in features], label)
    labels = indexer.fit(df)
    marked = labels.transform(bins.transform(df.select(*features, label))).withColumn("held_out", F.rand(seed) >= 0.8)
    cells = marked.groupBy(*bins.getOutputCols(), "label", "held_out").agg(F.count("*").cast("double").alias("rows"))
    cells = cells.repartition(df.sparkSession.sparkContext.defaultParallelism).persist()  # bounded, whatever the rows
    try:
        scaled = Pipeline(stages=[assembler, scaler]).fit(cells)
        ready = scaled.transform(cells).select("features", "label", "held_out", "rows").persist()
        judge = BinaryClassificationEvaluator(metricName="areaUnderROC", weightCol="rows")

        def fit(draw: tuple[int, float, int], part: DataFrame, n: float):
            return GBTClassifier(labelCol="label", featuresCol="features", weightCol="rows", maxIter=iterations, seed=seed, maxDepth=draw[0],
                                 stepSize=draw[1], minWeightFractionPerNode=min((draw[2] - 0.5) / n, 0.49)).fit(part)

        rows = lambda part: part.agg(F.sum("rows")).first()[0]
        train_part, test_part = ready.where("not held_out"), ready.where("held_out")
        n_train = rows(train_part)
        trial = inheritable_thread_target(df.sparkSession)(lambda draw: judge.evaluate(fit(draw, train_part, n_train).transform(test_part)))
        pool = ThreadPool(min(parallelism, trials))
        try:
            found = pool.map(trial, draws, 1)
        finally:
            pool.terminate()
        best = fit(draws[int(np.argmax(found))], ready, rows(ready))
        ready.unpersist()
    finally:
        cells.unpersist()
    model = PipelineModel([bins, *scaled.stages, labels, best])
    runs = [(i, *draw, float(m)) for i, (draw, m) in enumerate(zip(draws, found))]
    return model, df.sparkSession.createDataFrame(
        runs, "trial int, max_depth int, learning_rate double, min_leaf int, auc double")


def feature_importance(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(feature, weight), heaviest first. As many rows as features."""
    trees = best_trees(model)
    weights = [float(w) for w in trees.featureImportances.toArray()]
    spark = SparkSession.active()
    return spark.createDataFrame(list(zip(features, weights)), "feature string, weight double").orderBy(
        F.desc("weight"), "feature")


def label_index(model: PipelineModel, positive: str) -> int:
    """The index that the fitted pipeline gave to a label value (the most frequent one has 0)."""
    return next(s.labels for s in model.stages if hasattr(s, "labels")).index(positive)


def score_table(model: PipelineModel, df: DataFrame, keep: Sequence[str], positive: str) -> DataFrame:
    """Chosen columns with prediction and the probability of ``positive``; the label is not needed."""
    without_label = PipelineModel([s for s in model.stages if not hasattr(s, "labels")])
    probability = vector_to_array("probability")[label_index(model, positive)]
    return without_label.transform(df).select(*keep, "prediction", probability.alias("probability"))


def score_batch(model: PipelineModel, df: DataFrame, lookups: Sequence[Lookup], keep: Sequence[str], positive: str) -> DataFrame:
    """Look the features up by key, then predict."""
    return score_table(model, join_lookups(df, lookups), keep, positive)


def with_status(scored: DataFrame, threshold: float = 0.5, positive: str = "damaged", negative: str = "healthy") -> DataFrame:
    return scored.withColumn("status", threshold_label("probability", threshold, negative, positive))


def score_and_write(model: PipelineModel, df: DataFrame, keep: Sequence[str], path: str, positive: str = "damaged",
                    negative: str = "healthy") -> None:
    """Score, label and append the result."""
    with_status(score_table(model, df, keep, positive), 0.5, positive, negative).write.mode("append").parquet(path)


# ---------------------------------------------------------------- clusters

def scaled_vectors(columns: Sequence[str], lo: float = 0.0, hi: float = 10.0) -> list:
    return [VectorAssembler(inputCols=list(columns), outputCol="assembled"),
            MinMaxScaler(min=lo, max=hi, inputCol="assembled", outputCol="features")]


def segment_model(df: DataFrame, columns: Sequence[str], k: int = 4, seed: int = 0) -> PipelineModel:
    """Scaler and clusters in one pipeline, so that scoring scales like training."""
    return Pipeline(stages=[*scaled_vectors(columns),
                            KMeans(k=k, seed=seed, predictionCol="cluster")]).fit(df)


def segment(df: DataFrame, model: PipelineModel, names: dict[str, str]) -> DataFrame:
    """Rows with cluster id and segment name."""
    out = model.transform(df).drop("assembled", "features")
    return out.withColumn("segment", cluster_name("cluster", names))


def segment_udf(model: PipelineModel, names: dict[str, str]) -> Callable[..., Column]:
    """The same as a SQL-registrable function of the raw columns.

    Only the scaler's ends and the k centres travel; each task prepares them once.
    """
    scaler, clusters = model.stages[1], model.stages[2]
    low, high = scaler.originalMin.toArray(), scaler.originalMax.toArray()
    lo, hi = scaler.getMin(), scaler.getMax()
    centres = np.array(clusters.clusterCenters())

    def run(batches):
        width = np.where(high == low, 1.0, high - low)
        for columns in batches:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            share = np.where(high == low, 0.5, (x - low) / width)
            scaled = share * (hi - lo) + lo
            nearest = ((scaled[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
            yield pd.Series([names.get(f"cluster_{i + 1}") for i in nearest])

    # pandas_udf reads the iterator kind off these hints.
    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "string")
