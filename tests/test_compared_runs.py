import pickle
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from grainmart.config import Settings
from grainmart.operators import isotonic, train
from grainmart.plans import jobs
from grainmart.sources.warehouse import read_runs, record_run

TREES = ("boosted_shallow", "boosted_deep")


def test_a_recorded_comparison_is_taken_instead_of_fitting_every_fold_again(spark, tmp_path, monkeypatch):
    mart = spark.range(200).selectExpr(
        "id", "CAST(id % 3 = 0 AS DOUBLE) AS y", "id % 7 AS a", "CAST(id % 5 AS STRING) AS b", "true AS is_train")
    settings = Settings(model_dir=str(tmp_path / "m"), reports_dir=str(tmp_path / "r"), id_col="id", label_col="y",
                        folds=2, patience=1, max_rounds=1)
    full = str(tmp_path / "full")
    seen = [(m, fold, metric, value + fold / 100) for m, value in (("logistic_regression", 0.9), ("boosted_shallow", 0.3), ("boosted_deep", 0.6))
            for fold in range(2) for metric in ("roc_auc", "pr_auc")]
    record_run(spark.createDataFrame(seen, "model string, fold int, metric string, value double"), "one", "folds", full)
    record_run(spark.createDataFrame([("boosted_shallow", None, "pr_auc", 1.0)], "model string, fold int, metric string, value double"),
               "one", "holdout", full)
    monkeypatch.setattr(jobs, "out_of_fold_scores", lambda *a: pytest.fail("folds were fitted again"))
    summary = jobs.train(mart, settings, run_id="two", models=TREES, compared_in=full)
    assert summary["champion_model"] == "boosted_deep"
    again = read_runs(spark, f"{settings.reports_dir}/runs").filter(F.col("section") == "folds")
    assert sorted((r["model"], r["fold"], r["metric"], r["value"]) for r in again.collect()) == sorted(
        s for s in seen if s[0] in TREES)


def test_workers_without_the_package_can_pool_scores(tmp_path):
    (tmp_path / "f").write_bytes(cloudpickle.dumps(isotonic._pooled))
    assert pickle.loads((tmp_path / "f").read_bytes())
    subprocess.run([sys.executable, "-c", "import pickle; pickle.load(open('f', 'rb'))"], cwd=tmp_path, check=True, timeout=60)


def test_a_large_fit_has_no_more_small_tasks_than_cores():
    assert [train.tasks_of_fit(n, 12) for n in (1, 20_000, 20_001, 240_000, 960_000, 6_000_000)] == [1, 1, 2, 12, 12, 60]
