"""Boosted trees grown round by round: margins travel with the rows, so no round is fitted twice.

Rows that one task can hold are grown there by one_task, without Spark jobs for every level of every tree.

A round is one Spark ML regression tree on the slopes of the loss at the margins so far, which is
what Spark's own boosting fits in that round. Growing can therefore stop after any round, and what
was grown until then is a model of Spark's own kind.
"""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from math import isnan

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmart.operators.one_task import Growth, growing_task, patient_best
from grainmart.sources.scratch import stored

MARGIN, TARGET, STEP = "__margin", "__target", "__step"
WRITE_EVERY = 25  # rounds after which rows are written with their margins, which cuts their lineage


@dataclass(frozen=True)
class Round:
    """One tree, its weight, and the mean loss on the judging rows with this tree and all before it."""

    tree: RandomForestRegressionModel
    weight: float
    loss: float


def _learner(gbt: GBTClassifier, number: int) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol=gbt.getFeaturesCol(), labelCol=TARGET, weightCol=gbt.getWeightCol(), predictionCol=STEP,
        numTrees=1, bootstrap=False, subsamplingRate=gbt.getSubsamplingRate(), maxDepth=gbt.getMaxDepth(),
        minInstancesPerNode=gbt.getMinInstancesPerNode(), maxBins=gbt.getMaxBins(),
        featureSubsetStrategy=gbt.getFeatureSubsetStrategy(), seed=gbt.getSeed() + number)


def _signed(gbt: GBTClassifier) -> Column:
    return 2 * F.col(gbt.getLabelCol()) - 1


def boosting_rounds(gbt: GBTClassifier, rows: DataFrame, judging: str) -> Iterator[Round]:
    """Up to ``gbt.getMaxIter()`` rounds, each grown when it is asked for.

    ``rows`` has the columns that ``gbt`` names and a boolean ``judging``: those rows are never
    fitted on, and without any of them the loss is NaN. Memory is one cached copy of the rows.
    """
    columns, signed = rows.columns, _signed(gbt)
    weight = F.col(gbt.getWeightCol())
    slope = 4 * signed / (1 + F.exp(2 * signed * F.col(MARGIN)))
    # log(1 + exp(-x)), written so that no exponent overflows
    x = 2 * signed * F.col(MARGIN)
    loss = 2 * (F.log1p(F.exp(-F.abs(x))) + F.greatest(-x, F.lit(0.0)))
    held = rows.withColumns({MARGIN: F.lit(0.0), TARGET: signed}).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for number in range(gbt.getMaxIter()):
            tree = _learner(gbt, number).fit(held.filter(~F.col(judging)))
            share = 1.0 if number == 0 else gbt.getStepSize()
            grown = tree.transform(held).withColumn(MARGIN, F.col(MARGIN) + share * F.col(STEP)) \
                .withColumn(TARGET, slope).select(*columns, MARGIN, TARGET)
            if (number + 1) % WRITE_EVERY == 0:
                grown = stored(grown, "margins")
            grown = grown.persist(StorageLevel.MEMORY_AND_DISK)
            judged = grown.filter(judging).agg(F.sum(weight * loss) / F.sum(weight)).first()[0]
            held.unpersist()
            held = grown
            yield Round(tree, share, float("nan") if judged is None else judged)
    finally:
        held.unpersist()


def boost(gbt: GBTClassifier, rows: DataFrame, judging: str, patience: int) -> GBTClassificationModel:
    """Grow until the loss on the judging rows has not improved for ``patience`` rounds, and keep the best.

    Without judging rows all rounds are grown and kept. Every row must have a weight, and rows to
    fit on must not be empty.
    """
    grown: list[Round] = []
    losses: list[float] = []
    growing = boosting_rounds(gbt, rows, judging)
    for one in growing:
        grown.append(one)
        if not isnan(one.loss):
            losses.append(one.loss)
            if patient_best(losses, patience)[1]:
                break
    growing.close()
    return assembled(gbt, grown[:patient_best(losses, patience)[0]] if losses else grown)


def _share_of_slots(gbt: GBTClassifier) -> float:
    """The share of slots that a node may split by; all in boosting's own mode."""
    named = gbt.getFeatureSubsetStrategy()
    if named in ("auto", "all"):
        return 1.0
    if "." not in named:
        raise ValueError(f"a share of slots is needed, not {named}")
    return float(named)


def _arity(rows: DataFrame, column: str) -> dict[int, int]:
    """The number of categories of each nominal slot, as Spark ML reads it from the column."""
    slots = rows.schema[column].metadata.get("ml_attr", {}).get("attrs", {})
    arity = {a["idx"]: 2 for a in slots.get("binary", [])}
    return arity | {a["idx"]: len(a["vals"]) if "vals" in a else a["num_vals"] for a in slots.get("nominal", []) if "vals" in a or "num_vals" in a}


def boost_in_one_task(gbt: GBTClassifier, rows: DataFrame, judging: str, patience: int) -> GBTClassificationModel:
    """What boost gives, with all rounds grown in one task: for rows that one task holds. Draws of samples differ."""
    growth = Growth(gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getStepSize(), gbt.getMaxBins(), gbt.getMinInstancesPerNode(),
                    gbt.getMinInfoGain(), gbt.getSubsamplingRate(), _share_of_slots(gbt), gbt.getSeed(), _arity(rows, gbt.getFeaturesCol()))
    weight = F.col(gbt.getWeightCol()) if gbt.isSet(gbt.weightCol) else F.lit(1.0)
    columns = rows.where(F.col(judging).isNotNull()).select(vector_to_array(gbt.getFeaturesCol()).alias("x"), F.col(gbt.getLabelCol()).cast("double").alias("y"),
                          weight.cast("double").alias("w"), F.col(judging).alias("judging"))
    grown = columns.coalesce(1).mapInArrow(growing_task(growth, patience), "share double, slots int, nodes binary").collect()
    trees = [(_java_tree(pickle.loads(r["nodes"]), r["slots"], growth.arity), r["share"]) for r in grown]
    return _model(gbt, trees, grown[0]["slots"])


def _java_tree(nodes: list[tuple], slots: int, arity: Mapping[int, int]):
    """Spark's own tree of nodes, root first; a split whose two leaves predict the same is a leaf, as in Spark."""
    jvm = SparkSession.active().sparkContext._jvm
    tree, impurity = jvm.org.apache.spark.ml.tree, jvm.org.apache.spark.mllib.tree.impurity
    parse = jvm.org.apache.spark.mllib.linalg.Vectors.parse
    made, leaves = {}, {}
    for k in range(len(nodes) - 1, -1, -1):
        prediction, spread, gain, slot, chosen, children, sums, n = nodes[k]
        stats = impurity.VarianceCalculator(parse(repr(list(sums))).toArray(), n)
        below = [leaves.get(c) for c in children]
        if not children or (below[0] is not None and below[0] == below[1]):
            leaves[k] = below[0] if children else prediction
            made[k] = tree.LeafNode(leaves[k], spread, stats)
            continue
        if isinstance(chosen, list):
            split = tree.CategoricalSplit(slot, parse(repr(chosen)).toArray(), arity[slot])
        else:
            split = tree.ContinuousSplit(slot, chosen)
        made[k] = tree.InternalNode(prediction, spread, gain, made[children[0]], made[children[1]], split, stats)
    return jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel(f"dtr_{uuid.uuid4().hex[:12]}", made[0], slots)


def assembled(gbt: GBTClassifier, grown: Sequence[Round]) -> GBTClassificationModel:
    """The classifier's model with these rounds, to be saved and applied like one that Spark fitted."""
    return _model(gbt, [(one.tree._java_obj.trees()[0], one.weight) for one in grown], grown[0].tree.numFeatures)


def _model(gbt: GBTClassifier, grown: Sequence[tuple], slots: int) -> GBTClassificationModel:
    gateway = SparkSession.active().sparkContext._gateway
    ml = gateway.jvm.org.apache.spark.ml
    trees = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(grown))
    weights = gateway.new_array(gateway.jvm.double, len(grown))
    for i, (tree, weight) in enumerate(grown):
        trees[i], weights[i] = tree, weight
    model = ml.classification.GBTClassificationModel(gbt.uid, trees, weights, slots, 2)
    gbt._to_java().copyValues(model, ml.param.ParamMap.empty())
    return GBTClassificationModel(model)
