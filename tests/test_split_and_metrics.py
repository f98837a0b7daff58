import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from grainmart.operators import metrics, split
from grainmart.operators.ordered import exact_quantiles, key_value, order_key, running_totals


def order(ids, seed):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{i}:{seed}".encode()).hexdigest(), i))


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, 1 if i % 7 == 0 else 0) for i in range(3000)] + [(9000 + i, None) for i in range(10)]
    return spark.createDataFrame(rows, "id long, y int").repartition(5).cache()


def test_folds_equal_a_full_ranking_and_are_balanced(labelled):
    got = {r["id"]: (r["y"], r["fold"]) for r in split.stratified_folds(labelled, "id", "y", 5, 42).collect()}
    for label in (0, 1):
        ids = order([i for i in range(3000) if (i % 7 == 0) == bool(label)], 42)
        for rank, i in enumerate(ids):
            assert got[i] == (label, rank * 5 // len(ids))
    assert len(got) == 3000  # rows without a label are in no fold


def test_holdout_and_sample_have_exact_sizes_whatever_the_partitioning(labelled):
    held = split.stratified_holdout(labelled, "id", "y", 0.15, 1)
    sizes = {(r["y"], r["is_holdout"]): r["count"] for r in held.groupBy("y", "is_holdout").count().collect()}
    positives = len(range(0, 3000, 7))
    assert sizes[1, True] == math.ceil(0.15 * positives)
    assert sizes[0, True] == math.ceil(0.15 * (3000 - positives))
    sample = {r["id"] for r in split.seeded_sample(labelled.select("id"), "id", 200, 3).collect()}
    again = {r["id"] for r in split.seeded_sample(labelled.select("id").repartition(3), "id", 200, 3).collect()}
    everyone = [*range(3000), *range(9000, 9010)]
    assert sample == again == set(order(everyone, 3)[:200])
    assert split.seeded_sample(labelled.select("id"), "id", 10**6, 3).count() == 3010


def test_a_split_moves_no_data(labelled):
    plan = split.stratified_folds(labelled, "id", "y", 5, 42)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.split("InMemoryRelation")[0]


def test_rows_that_share_an_id_share_a_fold(spark):
    df = spark.range(900).selectExpr("CAST(CASE WHEN id % 3 = 0 THEN 5 ELSE id END AS BIGINT) AS id", "1 AS y")
    folds = split.stratified_folds(df, "id", "y", 4, 42).filter("id = 5").select("fold").distinct().collect()
    assert len(folds) == 1


def brute(pairs):
    """(AUC by pair counting, average precision, KS, Brier) by looping over thresholds."""
    pos = [s for s, y in pairs if y]
    neg = [s for s, y in pairs if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap = ks = recall = 0.0
    for t in sorted({s for s, _ in pairs}, reverse=True):
        tp, fp = sum(s >= t for s in pos), sum(s >= t for s in neg)
        ap += (tp / len(pos) - recall) * tp / (tp + fp)
        recall = tp / len(pos)
        ks = max(ks, recall - fp / len(neg))
    return auc, ap, ks, sum((s - y) ** 2 for s, y in pairs) / len(pairs)


@pytest.mark.parametrize("slices", [1, 3, 50])
def test_metrics_equal_brute_force_with_ties_and_a_hot_score(spark, slices):
    rng = random.Random(5)
    pairs = [(round(rng.random(), 2), int(rng.random() < 0.3)) for _ in range(300)]
    pairs += [(0.5, i % 4 == 0) for i in range(150)]
    df = spark.createDataFrame([(float(s), int(y)) for s, y in pairs], "s double, y int")
    row = metrics.rank_metrics(df, "s", "y", slices=slices).first()
    assert (row["n_rows"], row["n_positive"]) == (450, sum(y for _, y in pairs))
    got = [row[m] for m in metrics.METRICS]
    assert got == pytest.approx(brute(pairs), abs=1e-12)


def test_a_pool_with_one_class_has_no_ranking_metrics_and_ks_is_never_negative(spark):
    df = spark.createDataFrame([("a", 0.2, 1), ("a", 0.4, 1), ("b", 0.9, 0), ("b", 0.1, 1)],
                               "g string, s double, y int")
    got = {r["g"]: r for r in metrics.rank_metrics(df, "s", "y", ["g"]).collect()}
    assert got["a"]["roc_auc"] is None and got["a"]["pr_auc"] is None and got["a"]["ks_statistic"] is None
    assert got["a"]["brier_score"] == pytest.approx((0.64 + 0.36) / 2)
    assert got["b"]["ks_statistic"] == 0.0 and got["b"]["roc_auc"] == 0.0


def test_running_totals_per_group(spark):
    df = spark.createDataFrame([(g, v, 1) for g in "ab" for v in range(50)], "g string, v int, n int")
    for r in running_totals(df, ["g"], "v", ["n"], slices=7).collect():
        assert r["n_before"] == r["v"] and r["n_total"] == 50


@pytest.mark.parametrize("n", [1, 2, 101, 60_000])
def test_exact_quantiles_equal_linear_interpolation(spark, n):
    df = spark.range(n).selectExpr(
        f"CAST((id * 7919) % {n} AS DOUBLE) / 3 AS a", "CASE WHEN id % 3 > 0 THEN 4D ELSE id END AS b",
        "CAST(NULL AS DOUBLE) AS c", "IF(id % 2 = 0, id, NULL) AS d")
    at = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, ["a", "b", "c", "d"], at)
    pandas = df.toPandas()
    for c in "abd":
        assert got[c] == pytest.approx(np.quantile(pandas[c].dropna(), at), abs=1e-9)
    assert got["c"] == [None] * 5


EXTREMES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, 0.9999999999999999, 2.0, -2.0,
            3.0000000000000004, 1e300, -1e300, 1.7976931348623157e308, float("inf"), float("-inf"), 1 / 3, 1024.0, 1023.9999999999999]


def test_keys_are_in_the_order_of_the_numbers_and_turn_back(spark):
    rng = random.Random(1)
    values = EXTREMES + [rng.choice([-1, 1]) * rng.random() * 2.0 ** rng.randint(-1070, 1020) for _ in range(3000)]
    values += [2.0 ** e for e in range(-1074, 1024)]
    rows = order_key(spark.createDataFrame([(v,) for v in values], "v double"), "v", "k").collect()
    assert all(key_value(r["k"]) == r["v"] for r in rows)
    assert [r["v"] for r in sorted(rows, key=lambda r: r["k"])] == sorted(values)


@pytest.mark.parametrize("leaf_rows", [1, 40, 1 << 20])
def test_selection_narrows_to_any_bucket_size(spark, leaf_rows):
    rng = random.Random(2)
    columns = {"wide": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(500)],
               "narrow": [1.0 + rng.randrange(5) * 2.0 ** -52 for _ in range(500)],
               "one": [7.5] * 500, "ends": rng.choices([v for v in EXTREMES if abs(v) < 1e300], k=500)}
    df = spark.createDataFrame(list(zip(*columns.values(), strict=True)), ", ".join(f"{c} double" for c in columns))
    at = [0.0, 0.1, 0.5, 0.999, 1.0]
    got = exact_quantiles(df, list(columns), at, leaf_rows=leaf_rows)
    for c, values in columns.items():
        values = sorted(values)
        for q, x in zip(at, got[c], strict=True):
            low, high = values[int(q * 499)], values[min(499, int(q * 499) + (q * 499 > int(q * 499)))]
            assert low <= x <= high


def test_quantiles_of_no_rows_and_no_columns(spark):
    df = spark.createDataFrame([], "a double")
    assert exact_quantiles(df, ["a"], [0.5]) == {"a": [None]} and exact_quantiles(df, [], [0.5]) == {}


def test_reliability_bins_drop_empty_bins_and_put_edges_below(spark):
    df = spark.createDataFrame([(0.5, 1)] * 8 + [(0.9, 0), (0.1, 1)], "s double, y int")
    got = [tuple(r)[:2] for r in metrics.reliability_bins(df, "s", "y", 4).orderBy("bin").collect()]
    assert got == [(0, 9), (3, 1)]


def test_champion_takes_the_earlier_model_on_a_tie(spark):
    summary = spark.createDataFrame([("x", 0.4), ("y", 0.4), ("z", 0.1)], "model string, mean_pr_auc double")
    assert metrics.champion(summary, ["y", "x", "z"]).first()["model"] == "y"
    assert metrics.champion(summary, ["z", "x", "y"]).first()["model"] == "x"


def test_cv_summary_uses_the_population_deviation(spark):
    folds = spark.createDataFrame([("m", 0.5, 0.1), ("m", 0.7, 0.3)], "model string, roc_auc double, pr_auc double")
    row = metrics.cv_summary(folds).first()
    assert (row["mean_roc_auc"], row["std_roc_auc"]) == (pytest.approx(0.6), pytest.approx(0.1))


def test_mixed_label_types(spark):
    df = spark.createDataFrame([(0.1, 0.0), (0.9, 1.0)], "s double, y double")
    assert metrics.rank_metrics(df, "s", "y").first()["roc_auc"] == 1.0
    assert metrics.compare_scores(df.withColumn("t", F.col("s")), {"a": "s", "b": "t"}, "y").count() == 2
