"""From eight CSV files to scores and reasons, on tables derived from the test data."""

from math import exp

import pytest
from pyspark.sql import functions as F

from conftest import TESTDATA
from grainmart.__main__ import main
from grainmart.config import Settings
from grainmart.operators.quality import QualityError
from grainmart.operators.train import MODELS
from grainmart.plans import jobs
from grainmart.plans.applicant_mart import CONTRACT, MART, declared_rules_report
from grainmart.plans.applicant_staging import stage_all
from grainmart.plans.applicant_tables import RAW_TABLES
from grainmart.sources.warehouse import Warehouse, load_mart
from workload.derived import raw_tables

pytestmark = pytest.mark.skipif(not TESTDATA.exists(), reason="no test data")
TREES = [m for m, spec in MODELS.items() if spec.is_tree]


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("jobs")
    raw = folder / "raw"
    raw.mkdir()
    tables = raw_tables(spark, str(TESTDATA))
    for spec in RAW_TABLES:
        frame = tables[spec.name]
        if spec.name == "previous_application":
            frame = frame.fillna(5, ["SK_ID_CURR"])
        pandas = frame.select(*[
            F.col(c).cast("string").alias(c) if t in ("bigint", "int") else F.col(c) for c, t in frame.dtypes
        ]).toPandas()
        pandas.to_csv(raw / spec.file_name, index=False)
    settings = Settings(
        raw_dir=str(raw), warehouse_dir=str(folder / "warehouse"), model_dir=str(folder / "models"),
        reports_dir=str(folder / "reports"), folds=2, patience=1, max_rounds=3)
    mart = jobs.build_warehouse(spark, Warehouse(spark, settings.warehouse_dir), settings)
    return settings, mart


@pytest.fixture(scope="module")
def trained(built):
    settings, mart = built
    return jobs.train(mart, settings, run_id="first", models=TREES)


def test_mart_from_csv_equals_mart_from_frames(spark, built):
    from workload.applicant import mart as direct

    _, mart = built
    assert len(mart.columns) == 135 and mart.count() == 150
    columns = ["sk_id_curr", "bureau_count", "bureau_credit_types_count", "inst_days_late_max",
               "cc_underpaid_months_count", "employed_years", "has_credit_card_history", "type_suite"]
    left, right = mart.select(columns), direct(spark, str(TESTDATA)).select(columns)
    assert left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_a_broken_staging_table_stops_the_build(spark, built):
    settings, _ = built
    warehouse = Warehouse(spark, settings.warehouse_dir)
    staged = stage_all({t.name: warehouse.read("raw", t.name) for t in RAW_TABLES})
    staged["stg_bureau"] = staged["stg_bureau"].withColumn("sk_id_curr", F.lit(10**9))
    failed = {(r["table"], r["rule"]) for r in declared_rules_report(staged).filter("failures > 0").collect()}
    assert failed == {("stg_bureau", "relationship")}


def test_training_refuses_a_mart_that_breaks_its_contract(built):
    settings, mart = built
    with pytest.raises(QualityError, match="bureau_count"):
        jobs.train(mart.withColumn("bureau_count", F.lit(-1)), settings)


def test_profile_report(built, tmp_path):
    settings, mart = built
    text = jobs.profile_report(mart, settings, str(tmp_path))
    assert "132 (116 numeric, 16 categorical)" in text and "Training rows: 120" in text


def test_training_records_models_metrics_and_artefacts(spark, built, trained):
    settings, _ = built
    assert trained["champion_model"] in TREES
    assert {r["model"] for r in trained["cv_results"]} == set(TREES)
    runs = spark.read.parquet(f"{settings.reports_dir}/runs").filter("run_id = 'first'")
    assert runs.filter("fold IS NOT NULL AND metric = 'roc_auc'").count() == 4
    assert runs.filter("model = 'holdout_calibrated'").count() == 4
    assert 0 <= trained["holdout_calibrated"]["brier_score"] <= trained["holdout_uncalibrated"]["brier_score"]
    assert jobs.Artefacts.load(spark, settings).metadata["champion"] == trained["champion_model"]
    assert not spark.read.parquet(f"{settings.reports_dir}/reliability").isEmpty()


def test_scoring_pool_is_scored_once_with_probabilities(spark, built, trained, tmp_path):
    settings, mart = built
    jobs.score_pool(mart, settings, str(tmp_path / "submission"))
    out = spark.read.option("header", True).option("inferSchema", True).csv(str(tmp_path / "submission"))
    assert out.columns == ["SK_ID_CURR", "TARGET"] and out.count() == 30
    assert out.select("SK_ID_CURR").distinct().count() == 30
    assert out.filter("TARGET < 0 OR TARGET > 1 OR TARGET IS NULL").isEmpty()


def test_score_records_for_requested_ids(spark, built, trained):
    settings, mart = built
    ids = [r[0] for r in mart.select("sk_id_curr").limit(2).collect()]
    requests = spark.createDataFrame([(i,) for i in [*ids, ids[0], -7]], "sk_id_curr long")
    got = {r["sk_id_curr"]: r for r in jobs.score_requests(mart, requests, settings).collect()}
    assert set(got) == {*ids, -7} and got[-7]["found"] is False and got[-7]["probability"] is None
    assert all(got[i]["found"] and 0 <= got[i]["probability"] <= 1 for i in ids)


def test_reasons_of_one_applicant_add_up(spark, built, trained):
    settings, mart = built
    some = mart.select("sk_id_curr").first()[0]
    row = jobs.explain_ids(mart, [some], settings).first()
    assert len(row["contributions"]) == 132
    total = row["base_value"] + sum(c["contribution"] for c in row["contributions"])
    assert total == pytest.approx(row["predicted_score"], abs=1e-9)
    fitted = jobs.Artefacts.load(spark, settings)
    from grainmart.operators.train import with_probability
    p = with_probability(fitted.model, mart.filter(F.col("sk_id_curr") == some)).first()["probability"]
    assert 1 / (1 + exp(-total)) == pytest.approx(p, abs=1e-9)
    assert len(jobs.explain_ids(mart, [some], settings, k=3).first()["contributions"]) == 3
    with pytest.raises(ValueError, match="not found"):
        jobs.explain_ids(mart, [some, -1], settings)


def test_importance_table(spark, built, trained, tmp_path):
    settings, mart = built
    jobs.importance(mart, settings, str(tmp_path / "importance"))
    assert spark.read.option("header", True).csv(str(tmp_path / "importance")).count() == 132


def test_command_line(spark, built, monkeypatch, capsys):
    settings, _ = built
    monkeypatch.setenv("WAREHOUSE_DIR", settings.warehouse_dir)
    monkeypatch.setenv("DATA_RAW_DIR", settings.raw_dir + "-absent")
    assert main(["validate"]) == 0
    assert main(["ingest"]) == 1
    assert "application_train.csv" in capsys.readouterr().err
    assert CONTRACT.id_col in load_mart(Warehouse(spark, settings.warehouse_dir), MART, "is_train").columns
