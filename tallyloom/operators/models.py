"""Models on tables: pipelines, closed-form fits, metrics and bulk scoring."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    HashingTF,
    IndexToString,
    QuantileDiscretizer,
    RFormula,
    StringIndexer,
    Tokenizer,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tallyloom.workspace import materialise

BLOCK_CELLS = 1_000_000  # weights of a block of a model
BLOCK_ROWS = 4096  # rows of a block, at least
# rows a fit keeps together; the arrays of the usual 1 MB take whole heap regions each, which Spark does not count
FIT_BLOCK_MB = 0.25


def ols(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: intercept, slope, r squared and root mean squared error of y on x."""
    left_over = F.regr_syy(y, x) * (F.lit(1.0) - F.regr_r2(y, x))
    return df.agg(
        F.regr_intercept(y, x).alias("intercept"), F.regr_slope(y, x).alias("slope"),
        F.regr_r2(y, x).alias("r2"), F.sqrt(left_over / F.regr_count(y, x)).alias("rmse"))


def with_ols_residual(df: DataFrame, x: str, y: str) -> DataFrame:
    fit = df.agg(F.regr_intercept(y, x).alias("a"), F.regr_slope(y, x).alias("b")).first()
    predicted = F.lit(fit["a"]) + F.lit(fit["b"]) * F.col(x)
    return df.withColumn("prediction", predicted).withColumn("residual", F.col(y) - predicted)


def linear_regression(x: Sequence[str], y: str, **settings) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(x), outputCol="features"),
        LinearRegression(featuresCol="features", labelCol=y, **settings)])


def _indexers(columns: Sequence[str]) -> list[StringIndexer]:
    return [StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep") for c in columns]


def _tree_bins(rows: DataFrame, categories: Sequence[str]) -> int:
    """Bins enough for every category, one more for unseen ones, and not below the usual 32."""
    counts = rows.agg(*[F.count_distinct(c) for c in categories]).first()
    return max(32, *[n + 1 for n in counts])


def boosted_regression(rows: DataFrame, categories: Sequence[str], numbers: Sequence[str],
                       label: str, iterations: int = 20, seed: int = 1) -> Pipeline:
    features = [f"{c}_idx" for c in categories] + list(numbers)
    return Pipeline(stages=[
        *_indexers(categories), VectorAssembler(inputCols=features, outputCol="features"),
        GBTRegressor(featuresCol="features", labelCol=label, maxIter=iterations, seed=seed,
                     maxBins=_tree_bins(rows, categories))])


def boosted_classifier(rows: DataFrame, label: str, binned: str, categories: Sequence[str],
                       iterations: int = 10, seed: int = 1) -> Pipeline:
    """Label index, quantile bins and category indexes into boosted trees, labels mapped back."""
    labels = StringIndexer(inputCol=label, outputCol="label_idx").fit(rows)
    bins = QuantileDiscretizer(inputCol=binned, outputCol=f"{binned}_bin", numBuckets=10)
    features = [f"{c}_idx" for c in categories] + [f"{binned}_bin"]
    return Pipeline(stages=[
        labels, bins, *_indexers(categories),
        VectorAssembler(inputCols=features, outputCol="features"),
        GBTClassifier(featuresCol="features", labelCol="label_idx", maxIter=iterations, seed=seed,
                      maxBins=_tree_bins(rows, categories)),
        IndexToString(inputCol="prediction", outputCol="predicted_label", labels=labels.labels)])


def logistic(label: str, **settings) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol=label, **settings)


def formula_svm(label: str, terms: str, reg: float = 0.01, iterations: int = 10) -> Pipeline:
    """Linear SVM for a two-valued text label on a formula of other columns.

    The label is indexed apart from the formula, so that a category not seen in
    training gets a feature of its own while the label keeps its two values.
    """
    return Pipeline(stages=[
        StringIndexer(inputCol=label, outputCol="label_idx", stringOrderType="alphabetAsc"),
        RFormula(formula=f"label_idx ~ {terms}", featuresCol="features", labelCol="label_copy",
                 handleInvalid="keep"),
        LinearSVC(featuresCol="features", labelCol="label_idx", regParam=reg, maxIter=iterations)])


def text_pipeline(text: str, label: str, features: int = 1000, iterations: int = 20) -> Pipeline:
    """Words, hashed counts and an indexed label of any number of classes into logistic regression."""
    return Pipeline(stages=[
        StringIndexer(inputCol=label, outputCol="label_idx", stringOrderType="alphabetAsc"),
        Tokenizer(inputCol=text, outputCol="words"),
        HashingTF(inputCol="words", outputCol="features", numFeatures=features),
        logistic("label_idx", maxIter=iterations)])


class TableCrossValidator(CrossValidator):
    """Cross validation on a written table, of which no fold is kept in memory.

    The library keeps training and validation rows of a fold with the features
    of every setting, beside the copy that each of the fits makes of its own
    rows.  Here each fit and each evaluation reads its columns from the table,
    one after the other, so what is kept at once is the copy of one fit, which
    goes to disk where it does not fit.
    """

    def _fit(self, dataset: DataFrame) -> CrossValidatorModel:
        estimator, grid, evaluator = self.getEstimator(), self.getEstimatorParamMaps(), self.getEvaluator()
        measured = [[evaluator.evaluate(estimator.fit(train, setting).transform(validation)) for setting in grid]
                    for train, validation in self._kFold(dataset)]
        means, deviations = list(np.mean(measured, axis=0)), list(np.std(measured, axis=0))
        best = int(np.argmax(means) if evaluator.isLargerBetter() else np.argmin(means))
        return self._copyValues(CrossValidatorModel(estimator.fit(dataset, grid[best]), means, stdMetrics=deviations))


def cross_validated(rows: DataFrame, pipeline: Pipeline, feature_counts: Sequence[int],
                    fold: str, folds: int) -> CrossValidatorModel:
    """Grid search over the number of hashed features by accuracy, on folds given as a column.

    Words and their hashed counts are the same in every fold, so they are made
    once per setting in one pass over the texts and written; the folds learn
    from that table.  The best model has all stages and takes texts.
    """
    stages = pipeline.getStages()
    ready = [s for s in stages if isinstance(s, Transformer)]
    hashing = next(s for s in ready if isinstance(s, HashingTF))
    learner = next(s for s in stages if isinstance(s, HasFeaturesCol))
    settings = [hashing.copy({hashing.numFeatures: n, hashing.outputCol: f"_features_{n}"}) for n in feature_counts]
    columns = [s.getOutputCol() for s in settings]
    texts = {s.getInputCol() for s in ready}
    hashed = PipelineModel([s for s in ready if s is not hashing] + settings).transform(rows)
    table = materialise(hashed.select(*[c for c in rows.columns if c not in texts], *columns), "features")
    grid = ParamGridBuilder().baseOn({learner.maxBlockSizeInMB: FIT_BLOCK_MB}).addGrid(learner.featuresCol, columns).build()
    tuned = TableCrossValidator(
        estimator=Pipeline(stages=[s for s in stages if s not in ready]), estimatorParamMaps=grid,
        evaluator=MulticlassClassificationEvaluator(labelCol="label_idx", metricName="accuracy"),
        numFolds=folds, foldCol=fold).fit(table)
    fitted = iter(tuned.bestModel.stages)
    best = [s if s in ready else next(fitted) for s in stages]
    chosen = best[stages.index(learner)].getFeaturesCol()
    best[stages.index(learner)].setFeaturesCol(hashing.getOutputCol())
    best[stages.index(hashing)] = hashing.copy({hashing.numFeatures: feature_counts[columns.index(chosen)]})
    tuned.bestModel = PipelineModel(best)
    return tuned


def vector_features(df: DataFrame, array: str) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(array).cast("array<double>")))


def class_probabilities(scored: DataFrame) -> DataFrame:
    p = vector_to_array("probability")
    return scored.withColumns({"p0": p[0], "p1": p[1]})


def accuracy(predicted: Column, label: Column) -> Column:
    return F.avg((predicted == label).cast("double"))


def rmse(predicted: Column, label: Column) -> Column:
    return F.sqrt(F.avg((predicted - label) * (predicted - label)))


def r_squared(predicted: Column, label: Column) -> Column:
    """Share of the label's variance that the prediction explains; below 0 where it is worse than the mean."""
    return 1 - F.sum((predicted - label) * (predicted - label)) / (F.var_pop(label) * F.count(label))


def worst_rows(scored: DataFrame, predicted: str, label: str, tie: str, n: int = 10) -> DataFrame:
    return scored.orderBy(F.abs(F.col(predicted) - F.col(label)).desc(), tie).limit(n)


def centroids(df: DataFrame, array: str, label: str) -> DataFrame:
    """Mean vector per label as rows (label, weights); vectors with a null in them take no part."""
    whole = df.filter(F.col(array).isNotNull() & F.forall(array, lambda x: x.isNotNull()))
    return vector_features(whole, array).groupBy(label).agg(
        vector_to_array(Summarizer.mean(F.col("features"))).alias("weights"))


def _block_product(width: int, k: int, kind: pa.DataType):
    """The ``k`` best classes of one block of the model for each row of one block of rows."""
    found = pa.struct([("worse", pa.float64()), ("label", kind)])

    def run(rows: pa.Table, model: pa.Table) -> pa.Table:
        if not rows.num_rows or not model.num_rows:
            return pa.table({"_row": pa.array([], pa.int64()), "_best": pa.array([], pa.list_(found))})
        # in label order, so that lower labels win ties
        model = model.take(pc.sort_indices(model, sort_keys=[("_label", "ascending")], null_placement="at_start"))
        x, w = (np.asarray(pc.list_flatten(t.column(c).combine_chunks())).reshape(-1, width)
                for t, c in ((rows, "_vector"), (model, "_weights")))
        scores = x @ w.T
        places = np.argsort(-scores, axis=1, kind="stable")[:, :k]
        best = pa.StructArray.from_arrays(
            [pa.array(-np.take_along_axis(scores, places, axis=1).ravel()),
             model.column("_label").combine_chunks().take(pa.array(places.ravel()))], fields=list(found))
        ends = np.arange(len(x) + 1, dtype="int32") * places.shape[1]
        return pa.table({"_row": rows.column("_row"), "_best": pa.ListArray.from_arrays(pa.array(ends), best)})
    return run


def top_classes(df: DataFrame, array: str, weights: DataFrame, label: str, k: int = 1) -> DataFrame:
    """Add ``top``: the ``k`` best classes of a linear model per row, best first, lower label on ties.

    ``weights`` has a ``label`` of any type and its ``weights``, all of one
    length.  Rows and model are cut into blocks, every pair of blocks meets in
    one task that multiplies them, and a row's best classes of all blocks are
    merged.  No part of the model passes through the driver, and the plan is
    the same for any number of classes.  A vector that is null, holds a null
    or has another length than the model gets a null; a model without classes
    gives every row an empty array.
    """
    kind = weights.schema[label].dataType
    top = T.ArrayType(T.StructType([T.StructField("label", kind), T.StructField("score", T.DoubleType())]))
    names = [c for c in df.columns if c != "top"]
    model = materialise(weights.select(
        F.col(label).alias("_label"), F.col("weights").cast("array<double>").alias("_weights")), "model")
    classes, width = model.agg(F.count(F.lit(1)), F.max(F.size("_weights"))).first()
    if not classes:
        return df.select(*names, F.array().cast(top).alias("top"))
    rows = materialise(df.select(F.struct(*names).alias("_doc"), F.monotonically_increasing_id().alias("_row")), "rows")
    vector = F.col("_doc").getField(array)
    usable = (F.size(vector) == width) & ~F.exists(vector, lambda x: x.isNull())
    vectors = rows.where(usable).select("_row", vector.cast("array<double>").alias("_vector"))
    cuts = max(1, math.ceil(classes * width / BLOCK_CELLS))
    # a row travels once per block of the model, the model no more often than makes as many rows
    parts = max(1, math.ceil(rows.count() / max(BLOCK_ROWS, math.ceil(classes / cuts))))

    def numbers(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))

    left = vectors.withColumn("_part", F.pmod(F.xxhash64("_row"), F.lit(parts))).withColumn("_cut", numbers(cuts))
    right = model.withColumn("_cut", F.pmod(F.xxhash64("_label"), F.lit(cuts))).withColumn("_part", numbers(parts))
    schema = T.StructType([T.StructField("_row", T.LongType()), T.StructField("_best", T.ArrayType(
        T.StructType([T.StructField("worse", T.DoubleType()), T.StructField("label", kind)])))])
    found = left.groupBy("_part", "_cut").cogroup(right.groupBy("_part", "_cut")).applyInArrow(
        _block_product(width, k, to_arrow_type(kind)), schema)
    if cuts > 1:
        found = found.groupBy("_row").agg(F.slice(F.sort_array(F.flatten(F.collect_list("_best"))), 1, k).alias("_best"))
    best = F.transform("_best", lambda s: F.struct(s["label"].alias("label"), (-s["worse"]).alias("score")))
    return rows.join(found, "_row", "left").select(
        *[F.col("_doc").getField(c).alias(c) for c in names], best.cast(top).alias("top"))
