from itertools import combinations
from math import exp, factorial

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from grainmart.config import Settings
from grainmart.operators import boosting, explain, train
from grainmart.operators.features import FEATURES_COL
from grainmart.operators.metrics import rank_metrics

SETTINGS = Settings(id_col="id", label_col="y", folds=3, patience=2, max_rounds=5)


@pytest.fixture(scope="module")
def pool(spark):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(400):
        a, b = rng.normal(size=2)
        c = str(rng.choice(["p", "q", "r"]))
        y = int(rng.random() < 1 / (1 + exp(-(a + (c == "q") - 1.5))))
        rows.append((i, y, float(a) if rng.random() < 0.85 else None, float(b), bool(b > 0), c))
    return spark.createDataFrame(rows, "id long, y int, a double, b double, flag boolean, c string").cache()


FEATURES = train.FeatureSet(["a", "b", "flag"], ["c"], {"c": ["p", "q", "r"]})


def test_out_of_fold_scores_cover_every_row_once_per_model(pool):
    scores = train.out_of_fold_scores(pool, FEATURES, SETTINGS).cache()
    counts = {r["model"]: r["count"] for r in scores.groupBy("model").count().collect()}
    assert counts == {m: 400 for m in train.MODELS}
    assert scores.groupBy("model", "id").count().filter("count > 1").isEmpty()
    assert scores.filter("probability < 0 OR probability > 1 OR probability IS NULL").isEmpty()
    by_fold = rank_metrics(scores, "probability", "y", ["model", "fold"]).collect()
    assert len(by_fold) == 9
    assert np.mean([r["roc_auc"] for r in by_fold if r["model"] == "boosted_deep"]) > 0.6


def test_patience_rule():
    assert boosting.patient_best([5, 4, 3, 3.5, 3.6, 2], 2) == (3, True)
    assert boosting.patient_best([5, 4, 3, 3.5, 2], 2) == (5, False)


def test_early_stopping_keeps_the_best_rounds_and_never_exceeds_the_budget(pool):
    settings = Settings(id_col="id", label_col="y", patience=1, max_rounds=4)
    fitted = train.fit_model(train.MODELS["boosted_shallow"], pool, FEATURES, settings)
    assert 1 <= fitted.model.stages[-1].getNumTrees <= 4


def _vectors(spark, n=300):
    rng = np.random.default_rng(3)
    data = [(Vectors.dense(rng.normal(size=3).round(2)), float(rng.random() < 0.4), 1.0 + (i % 3) / 2, i % 10 == 0)
            for i in range(n)]
    return spark.createDataFrame([(v, y if v[0] < 0.5 else 1 - y, w, j) for v, y, w, j in data],
                                 ["features", "label", "weight", "judging"]).coalesce(1)


@pytest.mark.parametrize("write_every", [25, 2])
def test_rounds_equal_the_boosting_of_spark(spark, monkeypatch, write_every):
    monkeypatch.setattr(boosting, "WRITE_EVERY", write_every)
    rows = _vectors(spark)
    gbt = GBTClassifier(weightCol="weight", maxIter=5, maxDepth=3, stepSize=0.3, seed=1)
    grown = list(boosting.boosting_rounds(gbt, rows, "judging"))
    ours, theirs = boosting.assembled(gbt, grown), gbt.fit(rows.filter("NOT judging"))
    assert ours.treeWeights == theirs.treeWeights and ours.numFeatures == 3
    scores = [[tuple(r[0]) for r in m.transform(rows).select("probability").collect()] for m in (ours, theirs)]
    assert np.allclose(*scores, atol=1e-12)
    assert [r.loss for r in grown] == pytest.approx(theirs.evaluateEachIteration(rows.filter("judging")), abs=1e-9)
    # Fewer rounds are the beginning of a longer model.
    short = boosting.assembled(gbt, grown[:2])
    assert train.first_rounds(ours, 2).toDebugString.split("\n")[1:] == short.toDebugString.split("\n")[1:]


def test_each_round_is_fitted_once_and_no_more_than_patience_asks_for(spark, monkeypatch):
    fitted = []
    learner = boosting._learner
    monkeypatch.setattr(boosting, "_learner", lambda gbt, number: (fitted.append(number), learner(gbt, number))[1])
    gbt = GBTClassifier(weightCol="weight", maxIter=40, maxDepth=5, stepSize=1.0, seed=1)
    model = boosting.boost(gbt, _vectors(spark), "judging", patience=2)
    assert fitted == list(range(len(fitted))) and len(fitted) == model.getNumTrees + 2 < 40


def test_rounds_without_judging_rows_go_to_the_end(spark):
    rows = _vectors(spark).filter("NOT judging")
    assert boosting.boost(GBTClassifier(weightCol="weight", maxIter=2, maxDepth=2, seed=1), rows, "judging", 1).getNumTrees == 2


def test_calibration_is_monotone_and_bounded(spark):
    df = spark.createDataFrame([(i / 100, int(i % 3 == 0 and i > 30)) for i in range(100)] * 2, "s double, y int")
    model = train.fit_calibrator(df, "s", "y")
    out = train.calibrated(df.unionByName(spark.createDataFrame([(-1.0, 0), (2.0, 0)], "s double, y int")),
                           model, "s").orderBy("s").collect()
    values = [r["probability"] for r in out]
    assert values == sorted(values) and 0.0 <= values[0] and values[-1] <= 1.0
    assert out[0].asDict().keys() == {"s", "y", "probability"}


@pytest.fixture(scope="module")
def saved(pool, tmp_path_factory, spark):
    fitted = train.fit_model(train.MODELS["boosted_deep"], pool, FEATURES, SETTINGS)
    path = str(tmp_path_factory.mktemp("model") / "champion")
    fitted.model.write().overwrite().save(path)
    return fitted, explain.Explainer.load(spark, path, fitted.slot_features, "boosted_deep")


def test_base_and_contributions_add_up_to_the_log_odds(pool, saved):
    fitted, explainer = saved
    explained = explainer.explain(pool, "id").join(
        fitted.probabilities(pool).select("id", "probability"), "id").collect()
    assert len(explained) == 400
    for r in explained:
        parts = [c["contribution"] for c in r["contributions"]]
        assert r["base_value"] + sum(parts) == pytest.approx(r["predicted_score"], abs=1e-9)
        assert 1 / (1 + exp(-r["predicted_score"])) == pytest.approx(r["probability"], abs=1e-9)
        assert [abs(p) for p in parts] == sorted((abs(p) for p in parts), reverse=True)
        assert {c["feature"] for c in r["contributions"]} == set(FEATURES.names)


def test_contributions_equal_enumerated_shapley_values(spark, pool, saved, tmp_path):
    fitted, explainer = saved
    path = str(tmp_path / "m")
    fitted.model.write().save(path)
    nodes = {(r["treeID"], r["id"]): r for r in spark.read.parquet(
        f"{path}/stages/*GBT*/data").select("treeID", "nodeData.*").collect()}
    weights = fitted.model.stages[-1].treeWeights

    def expected(tree, node_id, x, known):
        node = nodes[tree, node_id]
        if node["leftChild"] < 0:
            return node["prediction"]
        split, children = node["split"], (node["leftChild"], node["rightChild"])
        if split["featureIndex"] in known:
            value, chosen = x[split["featureIndex"]], split["leftCategoriesOrThreshold"]
            left = value <= chosen[0] if split["numCategories"] < 0 else value in chosen
            return expected(tree, children[0 if left else 1], x, known)
        return sum(expected(tree, c, x, known) * nodes[tree, c]["rawCount"] for c in children) / node["rawCount"]

    rows = pool.filter("id < 4").orderBy("id")
    prepared = [list(r["v"]) for r in fitted.model.transform(rows).orderBy("id").select(
        vector_to_array(FEATURES_COL).alias("v")).collect()]
    explained = explainer.explain(rows, "id").orderBy("id").collect()
    slots = range(len(fitted.slot_features))
    for x, row in zip(prepared, explained):
        by_feature = dict.fromkeys(explainer.features, 0.0)
        for i in slots:
            others = [s for s in slots if s != i]
            for size in range(len(others) + 1):
                weight = factorial(size) * factorial(len(slots) - size - 1) / factorial(len(slots))
                for known in combinations(others, size):
                    gain = sum(w * (expected(t, 0, x, {*known, i}) - expected(t, 0, x, set(known)))
                               for t, w in enumerate(weights))
                    by_feature[fitted.slot_features[i]] += 2 * weight * gain
        for c in row["contributions"]:
            assert c["contribution"] == pytest.approx(by_feature[c["feature"]], abs=1e-9)


def test_packed_tables_equal_the_definition_of_the_game():
    leaf = explain.Leaf((0, 2, 3), (-np.inf, 0.5, -np.inf), (1.0, np.inf, np.inf), (None, None, frozenset({1, 4})), (0.3, 0.6, 0.2), 2.5)
    (piece,) = explain.pack([leaf, explain.Leaf((), (), (), (), (), 1.0)])
    (table,) = piece.tables()

    def worth(known, met):
        return leaf.value * np.prod([float(met[j]) if j in known else leaf.share[j] for j in range(3)])

    for pattern in range(8):
        met = [(pattern >> j) & 1 for j in range(3)]
        for i in range(3):
            others = [j for j in range(3) if j != i]
            want = sum(factorial(n) * factorial(2 - n) / 6 * (worth({*known, i}, met) - worth(set(known), met))
                       for n in range(3) for known in combinations(others, n))
            assert table[pattern, i] == pytest.approx(want)
    x = np.array([[0.9, 9, 0.6, 4.0], [1.1, 9, 0.5, 4.0], [0.0, 9, 0.7, 7.0], [0.0, 9, 0.7, 1.0]])
    assert piece.patterns(x)[:, 0].tolist() == [7, 4, 3, 7]


def test_the_first_rounds_of_a_fit_are_the_shorter_fit(spark, pool, tmp_path):
    prep = train.fit_tree_preparation(pool, FEATURES.numeric, FEATURES.levels)
    rows = prep.transform(pool.withColumns({train.LABEL: F.col("y").cast("double"), train.WEIGHT: F.lit(1.0)})).coalesce(1)
    build = lambda n: train.MODELS["boosted_shallow"].build(SETTINGS, n, prep.max_categories).fit(rows)
    cut, short = train.first_rounds(build(8), 3), build(3)
    cut.write().save(str(tmp_path / "cut"))
    loaded = type(cut).load(str(tmp_path / "cut"))
    for model in (cut, loaded):
        assert model.getNumTrees == 3
        a, b = (sorted(r["p"] for r in m.transform(rows).select(vector_to_array("__probability")[1].alias("p")).collect())
                for m in (model, short))
        assert a == pytest.approx(b, abs=1e-12)


def test_importance_is_non_negative_and_descending(pool, saved):
    table = saved[1].global_importance(pool, "id", 100, 42).collect()
    values = [r["mean_abs_contribution"] for r in table]
    assert len(table) == 4 and values == sorted(values, reverse=True) and values[-1] >= 0


def test_top_drivers_keep_the_strongest_and_can_be_reversed(pool, saved):
    explained = saved[1].explain(pool.filter("id < 5"), "id")
    row = explained.select("contributions", explain.top_drivers("contributions", 2).alias("top"),
                           explain.top_drivers("contributions", 2, reverse=True).alias("shown")).first()
    assert row["top"] == row["contributions"][:2] and row["shown"] == row["top"][::-1]


def test_a_linear_champion_is_refused(spark, tmp_path):
    with pytest.raises(NotImplementedError, match="not available"):
        explain.Explainer.load(spark, str(tmp_path), [], "logistic_regression")


def test_values_are_rendered_as_text_and_null_stays_null(pool, saved):
    missing = pool.filter(F.col("a").isNull()).limit(1)
    shown = {c["feature"]: c["value"] for c in saved[1].explain(missing, "id").first()["contributions"]}
    assert shown["a"] is None and shown["flag"] in ("true", "false")
