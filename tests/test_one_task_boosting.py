"""Rounds grown in one task are those that Spark ML grows, and the registered queries train with the jobs' own settings."""

import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexerModel, VectorAssembler

from grainmart.config import MAX_ROUNDS, PATIENCE_ROUNDS
from grainmart.operators import boosting, one_task, train
from workload import models


def test_the_registered_queries_train_with_the_patience_and_rounds_of_the_jobs():
    settings = models.settings_in("somewhere")
    assert (settings.patience, settings.max_rounds) == (PATIENCE_ROUNDS, MAX_ROUNDS)


def _rows(spark, n=600):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(n):
        a, b, c = rng.normal(), float(rng.integers(0, 4)), str(rng.choice(["p", "q", "r", "s", "t"]))
        y = float(rng.random() < 1 / (1 + np.exp(-(2 * a + (c in "qs") * 2 - b / 2))))
        rows.append((a if rng.random() < .9 else 0.0, b, 7.0, c, y, 1.0 + (i % 3) / 2, i % 10 == 0))
    df = spark.createDataFrame(rows, "a double, b double, k double, c string, label double, weight double, judging boolean")
    return PipelineModel([
        StringIndexerModel.from_labels(list("pqrst"), inputCol="c", outputCol="level", handleInvalid="keep"),
        VectorAssembler(inputCols=["a", "b", "k", "level"], outputCol="features")]).transform(df).coalesce(1)


@pytest.mark.parametrize("least", [1, 20])
def test_trees_of_one_task_equal_those_of_spark(spark, least, tmp_path):
    rows = _rows(spark)
    gbt = GBTClassifier(weightCol="weight", maxIter=6, maxDepth=4, stepSize=0.3, seed=1, minInstancesPerNode=least)
    ours = boosting.boost_in_one_task(gbt, rows, "judging", 50)
    theirs = boosting.boost(gbt, rows, "judging", 50)
    assert ours.getNumTrees == theirs.getNumTrees > 1 and ours.treeWeights == theirs.treeWeights and ours.numFeatures == 4
    ours.save(str(tmp_path / "m"))
    loaded = type(ours).load(str(tmp_path / "m"))
    scores = [[tuple(r[0]) for r in m.transform(rows).select("probability").collect()] for m in (ours, loaded, theirs)]
    assert np.allclose(scores[0], scores[2], atol=1e-9) and scores[0] == scores[1]
    theirs.save(str(tmp_path / "t"))
    nodes = [{(r["treeID"], r["id"]): r["nodeData"] for r in spark.read.parquet(str(tmp_path / p / "data")).select("treeID", "nodeData", "nodeData.id").collect()}
             for p in "mt"]
    assert nodes[0].keys() == nodes[1].keys()
    for k, node in nodes[0].items():
        assert (node["leftChild"], node["rightChild"], node["rawCount"]) == tuple(nodes[1][k][c] for c in ("leftChild", "rightChild", "rawCount"))
        assert node["impurityStats"] == pytest.approx(nodes[1][k]["impurityStats"], abs=1e-9)
        assert sorted(node["split"]["leftCategoriesOrThreshold"]) == pytest.approx(sorted(nodes[1][k]["split"]["leftCategoriesOrThreshold"]))


def test_patience_ends_a_fit_in_one_task_and_no_judging_rows_let_it_go_on(spark):
    rows = _rows(spark, 200)
    gbt = GBTClassifier(weightCol="weight", maxIter=60, maxDepth=5, stepSize=1.0, seed=1, subsamplingRate=0.8, featureSubsetStrategy="0.8")
    assert 1 <= boosting.boost_in_one_task(gbt, rows, "judging", 2).getNumTrees < 60
    assert boosting.boost_in_one_task(gbt.setMaxIter(3), rows.filter("NOT judging"), "judging", 1).getNumTrees == 3


def test_workers_without_the_package_can_grow_trees(tmp_path):
    growth = one_task.Growth(2, 2, 0.3, 32, 1, 0.0, 1.0, 1.0, 1, {})
    (tmp_path / "f").write_bytes(cloudpickle.dumps(one_task.growing_task(growth, 5)))
    code = ("import pickle, pyarrow as pa; rows = pa.RecordBatch.from_arrays([pa.array([[float(i)] for i in range(9)]), "
            "pa.array([float(i > 3) for i in range(9)]), pa.array([1.0] * 9), pa.array([False] * 9)], names=list('xywj')); "
            "assert len(list(pickle.load(open('f', 'rb'))([rows]))) == 2")
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=60)


def test_rows_without_a_label_are_refused(spark):
    rows = _rows(spark, 50).selectExpr("features", "nullif(label, 1D) AS label", "weight", "judging")
    with pytest.raises(Exception, match="must have a label"):
        boosting.boost_in_one_task(GBTClassifier(weightCol="weight", maxIter=2, seed=1), rows, "judging", 2)


def test_every_fit_has_local_properties_of_its_own(spark, monkeypatch):
    seen = []
    wrap = train.inheritable_thread_target
    monkeypatch.setattr(train, "inheritable_thread_target", lambda session: seen.append(1) or wrap(session))
    monkeypatch.setattr(train, "fit_model", lambda *a: pytest.fail("no fit") if len(seen) < 6 else _Scores())
    pool = spark.range(40).selectExpr("id", "CAST(id % 2 AS DOUBLE) AS y", "id AS a")
    settings = train.Settings(id_col="id", label_col="y", folds=2)
    train.out_of_fold_scores(pool, train.FeatureSet(["a"], [], {}), settings)


class _Scores:
    def probabilities(self, df):
        return df.selectExpr("*", "0.5D AS probability")
