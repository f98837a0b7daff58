"""Model registry, cross-validation, champion choice and calibration on Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmart.config import Settings, ensure_checkpoint_dir
from grainmart.operators.boosting import boost, boost_in_one_task
from grainmart.operators.features import (
    FEATURES_COL, Preparation, class_weight, fit_linear_preparation, fit_tree_preparation,
)
from grainmart.operators.isotonic import monotone_steps
from grainmart.operators.rollup import union_all
from grainmart.operators.split import stratified_folds, stratified_holdout

LABEL, WEIGHT = "__label", "__weight"
ROWS_PER_TASK, MOST_ROWS_PER_TASK = 20_000, 100_000  # of a boosted fit: up to a task a core, and beyond
_COLUMNS = {"featuresCol": FEATURES_COL, "labelCol": LABEL, "weightCol": WEIGHT,
            "predictionCol": "__class"}


@dataclass(frozen=True)
class ModelSpec:
    """``build`` makes an unfitted classifier from (settings, rounds or rows, categories, seed)."""

    name: str
    is_tree: bool
    build: Callable


def _name_scores(classifier):
    return classifier.setRawPredictionCol("__raw").setProbabilityCol("__probability")


def _logistic(settings: Settings, n_rows: int, _categories: int) -> LogisticRegression:
    # An L2 penalty of 1 on the summed loss is 1 / rows on Spark's mean loss.
    return _name_scores(LogisticRegression(
        maxIter=1000, regParam=1.0 / n_rows, elasticNetParam=0.0, standardization=False, **_COLUMNS))


def _boosted(depth: int, min_rows: int) -> Callable:
    def build(settings: Settings, rounds: int, categories: int) -> GBTClassifier:
        return _name_scores(GBTClassifier(
            maxIter=rounds, maxDepth=depth, minInstancesPerNode=min_rows, stepSize=0.03,
            subsamplingRate=0.8, featureSubsetStrategy="0.8", maxBins=max(32, categories),
            seed=settings.seed, **_COLUMNS))
    return build


MODELS: dict[str, ModelSpec] = {m.name: m for m in (
    ModelSpec("logistic_regression", False, _logistic),
    ModelSpec("boosted_shallow", True, _boosted(5, 40)),
    ModelSpec("boosted_deep", True, _boosted(6, 5)),
)}


@dataclass(frozen=True)
class FeatureSet:
    """Feature names by type and the levels captured once on the whole training pool."""

    numeric: Sequence[str]
    categorical: Sequence[str]
    levels: Mapping[str, Sequence[str]]

    @property
    def names(self) -> list[str]:
        return [*self.numeric, *self.categorical]


@dataclass(frozen=True)
class Fitted:
    """A fitted preparation and classifier, and the feature behind each vector slot."""

    spec: ModelSpec
    model: PipelineModel
    slot_features: list[str]

    def probabilities(self, df: DataFrame, name: str = "probability") -> DataFrame:
        """``df`` with the probability of the positive class."""
        return with_probability(self.model, df, name)


def with_probability(model: PipelineModel, df: DataFrame, name: str = "probability") -> DataFrame:
    return model.transform(df).select(
        *df.columns, vector_to_array("__probability")[1].alias(name))


def first_rounds(model: GBTClassificationModel, keep: int) -> GBTClassificationModel:
    """The model after its first ``keep`` rounds: boosting is sequential, so these are the trees
    that a fit of ``keep`` rounds would have grown."""
    fitted = model._java_obj
    gateway = SparkSession.active().sparkContext._gateway
    trees = gateway.new_array(
        gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, keep)
    weights = gateway.new_array(gateway.jvm.double, keep)
    for i in range(keep):
        trees[i], weights[i] = fitted.trees()[i], float(fitted.treeWeights()[i])
    cut = gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        fitted.uid(), trees, weights, fitted.numFeatures(), fitted.numClasses())
    fitted.copyValues(cut, gateway.jvm.org.apache.spark.ml.param.ParamMap.empty())
    return GBTClassificationModel(cut)


def tasks_of_fit(n_rows: int, cores: int) -> int:
    """Tasks of a boosted fit's stages. Every level of every tree is a job over all of them, so small data
    gets few; beyond a task per core they hold more rows instead, as further ones only add their start."""
    return min(-(-n_rows // ROWS_PER_TASK), max(cores, -(-n_rows // MOST_ROWS_PER_TASK)))


def _fit_boosted(
    spec: ModelSpec, rows: DataFrame, prep: Preparation, settings: Settings
) -> GBTClassificationModel:
    """Boost until an inner validation slice has not improved for ``patience`` rounds.

    The slice comes from the rows given, never from the rows scored later. Every round is fitted
    once: in one task if that can hold the rows, else by Spark ML, with the prepared vectors and their margins cached.
    """
    inner = stratified_holdout(
        rows, settings.id_col, LABEL, settings.inner_validation_share, settings.seed, name="__valid")
    weight = class_weight(inner.filter(~F.col("__valid")), LABEL, balanced=False)
    prepared = prep.transform(inner.withColumn(WEIGHT, weight)).select(
        FEATURES_COL, LABEL, WEIGHT, "__valid")
    n, gbt = rows.count(), spec.build(settings, settings.max_rounds, prep.max_categories)
    if n <= MOST_ROWS_PER_TASK:
        return boost_in_one_task(gbt, prepared, "__valid", settings.patience)
    prepared = prepared.coalesce(tasks_of_fit(n, rows.sparkSession.sparkContext.defaultParallelism))
    return boost(gbt, prepared, "__valid", settings.patience)


def fit_model(spec: ModelSpec, rows: DataFrame, features: FeatureSet, settings: Settings) -> Fitted:
    """Fit preparation and classifier on labelled rows."""
    ensure_checkpoint_dir(rows.sparkSession)
    rows = rows.withColumn(LABEL, F.col(settings.label_col).cast("double")).select(
        settings.id_col, LABEL, *features.names)
    if spec.is_tree:
        prep = fit_tree_preparation(rows, features.numeric, features.levels)
        model = _fit_boosted(spec, rows, prep, settings)
    else:
        prep = fit_linear_preparation(rows, features.numeric, features.categorical)
        weighted = rows.withColumn(WEIGHT, class_weight(rows, LABEL, balanced=True))
        prepared = prep.transform(weighted).select(
            FEATURES_COL, LABEL, WEIGHT).persist(StorageLevel.MEMORY_AND_DISK)
        model = spec.build(settings, prepared.count(), prep.max_categories).fit(prepared)
        prepared.unpersist()
    return Fitted(spec, PipelineModel([*prep.stages, model]), prep.slot_features)


def out_of_fold_scores(
    pool: DataFrame, features: FeatureSet, settings: Settings, models: Sequence[str] | None = None
) -> DataFrame:
    """(id, label, model, fold, probability): every labelled row scored by each model, fitted on
    the other folds."""
    folded = stratified_folds(
        pool, settings.id_col, settings.label_col, settings.folds, settings.seed, name="__fold")
    spark = pool.sparkSession
    ensure_checkpoint_dir(spark)

    def scored(task: tuple[str, int]) -> DataFrame:
        name, fold = task
        fitted = fit_model(MODELS[name], folded.filter(F.col("__fold") != fold), features, settings)
        held = fitted.probabilities(folded.filter(F.col("__fold") == fold))
        return held.select(
            settings.id_col, settings.label_col, F.lit(name).alias("model"),
            F.lit(fold).alias("fold"), "probability")

    # The fits are independent, so a few run at a time and fill each other's idle slots.
    tasks = [(name, fold) for name in models or list(MODELS) for fold in range(settings.folds)]
    # Each has its own copy of the session's local properties: fits that share one clear each other's entries.
    threads = [inheritable_thread_target(spark)(scored) for _ in tasks]
    with ThreadPoolExecutor(settings.parallel_fits) as pool_of_fits:
        return union_all(list(pool_of_fits.map(lambda thread, task: thread(task), threads, tasks)))


def fit_calibrator(
    scored: DataFrame, score: str, label: str, ranges: int | None = None
) -> IsotonicRegressionModel:
    """One monotone fit of the label on the score.

    The steps are pooled in a reduction tree; Spark's own fit, which merges on the driver, sees
    no more than their two ends, and keeps exactly these in the model.
    """
    steps = monotone_steps(scored, score, label, ranges)
    ends = steps.select("value", "lo", "hi", "weight", F.explode(
        F.when(F.col("lo") < F.col("hi"), F.array("lo", "hi")).otherwise(F.array("lo"))).alias("__score"))
    share = F.when(F.col("lo") < F.col("hi"), F.col("weight") / 2).otherwise(F.col("weight"))
    return IsotonicRegression(
        featuresCol="__score", labelCol=LABEL, weightCol=WEIGHT, predictionCol="__calibrated"
    ).fit(ends.select("__score", F.col("value").alias(LABEL), share.alias(WEIGHT)))


def calibrated(
    df: DataFrame, model: IsotonicRegressionModel, score: str, name: str = "probability"
) -> DataFrame:
    """``df`` with the calibrated probability; scores outside the fitted range are clipped."""
    out = model.transform(df.withColumn("__score", F.col(score).cast("double")))
    return out.withColumn(name, F.col("__calibrated")).drop("__score", "__calibrated")
