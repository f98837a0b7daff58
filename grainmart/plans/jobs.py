"""End-to-end jobs: build the warehouse, profile it, train and calibrate, score, explain."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.regression import IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmart.config import Settings
from grainmart.operators import profile
from grainmart.operators.explain import Explainer, explainable, read_leaves, top_drivers
from grainmart.operators.features import capture_levels, feature_columns, level_lists, split_types
from grainmart.operators.metrics import (
    champion, compare_scores, cv_summary, metrics_long, rank_metrics, reliability_comparison,
)
from grainmart.operators.quality import Contract, gate
from grainmart.operators.rollup import split_pools
from grainmart.operators.score import lookup_requests, require_present, score_records
from grainmart.operators.split import stratified_holdout
from grainmart.operators.train import (
    MODELS, FeatureSet, calibrated, fit_calibrator, fit_model, out_of_fold_scores, with_probability,
)
from grainmart.plans.applicant_mart import (
    CONTRACT, KEY, MART, build_mart, declared_rules_report, roll_up,
)
from grainmart.plans.applicant_staging import stage_all
from grainmart.plans.applicant_tables import RAW_TABLES
from grainmart.sources.catalog import ingest
from grainmart.sources.warehouse import (
    Warehouse, load_mart, read_metadata, read_runs, record_run, write_csv, write_metadata,
)


def build_warehouse(spark: SparkSession, warehouse: Warehouse, settings: Settings) -> DataFrame:
    """Ingest, stage, roll up, join, and stop at the first failed gate. Returns the mart.

    Staging stays lazy. Rollups and the mart are written beside those in use, because the rules and several
    later jobs read them again, and published together once both gates have passed.
    """
    ingest(spark, settings.raw_dir, RAW_TABLES, warehouse)
    staged = stage_all({t.name: warehouse.read("raw", t.name) for t in RAW_TABLES})
    warehouse.create_namespaces()
    rolled: dict[str, DataFrame] = {}
    for name, df in roll_up(staged).items():
        key = "sk_id_bureau" if name == "int_bureau_balance_agg" else KEY
        rolled[name] = warehouse.stage(df, "intermediate", name, bucket_key=key)
    flag = settings.split_col
    mart = warehouse.stage(build_mart(staged["stg_application"], rolled), "marts", MART, sort_by=KEY, partition_by=flag)
    mart = mart.withColumn(flag, F.col(flag).cast("boolean"))
    gate(declared_rules_report({**staged, **rolled, MART: mart}))
    gate(CONTRACT.report(mart))
    for name in rolled:
        warehouse.publish("intermediate", name)
    warehouse.publish("marts", MART)
    return load_mart(warehouse, MART, flag)


def feature_set(mart: DataFrame, settings: Settings) -> FeatureSet:
    numeric, categorical = split_types(mart, feature_columns(mart, settings.non_features))
    pool, _ = split_pools(mart, settings.split_col)
    return FeatureSet(numeric, categorical, level_lists(capture_levels(pool, categorical), categorical))


def profile_report(mart: DataFrame, settings: Settings, path: str | None = None) -> str:
    """The profile of the training pool as Markdown; the tables are kept under ``path``."""
    pool, _ = split_pools(mart, settings.split_col)
    features = feature_columns(mart, settings.non_features)
    numeric, categorical = split_types(mart, features)
    tables = {
        "header": profile.header(pool, numeric, categorical, settings.label_col),
        "missing": profile.missing_rates(pool, features),
        "correlation": profile.label_correlations(pool, numeric, settings.label_col),
        "level_spread": profile.level_spread(pool, categorical, settings.label_col),
    }
    if path:
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(f"{path}/{name}")
        tables = {n: pool.sparkSession.read.parquet(f"{path}/{n}") for n in tables}
        order = {"missing": [F.desc("missing_rate")], "correlation": [F.abs("correlation").desc()],
                 "level_spread": [F.desc("spread")]}
        tables = {n: t.orderBy(*order[n], "feature") if n in order else t for n, t in tables.items()}
    text = profile.render_markdown(
        tables["header"], tables["missing"], tables["correlation"], tables["level_spread"])
    if path:
        pool.sparkSession.createDataFrame([(text,)], "value string").coalesce(1).write.mode(
            "overwrite").option("lineSep", "\n").text(f"{path}/profile_md")
    return text


@dataclass(frozen=True)
class Artefacts:
    """Saved champion, calibrator and metadata of one training run."""

    metadata: dict
    model: PipelineModel
    calibrator: IsotonicRegressionModel
    model_path: str
    slot_features: list[str]

    @classmethod
    def load(cls, spark: SparkSession, settings: Settings) -> "Artefacts":
        base = settings.model_dir
        slots = spark.read.schema("slot int, feature string").json(f"{base}/slots").orderBy("slot")
        return cls(
            read_metadata(spark, f"{base}/metadata"), PipelineModel.load(f"{base}/champion"),
            IsotonicRegressionModel.load(f"{base}/calibrator"), f"{base}/champion",
            [r["feature"] for r in slots.collect()])

    def score(self, rows: DataFrame) -> DataFrame:
        """Rows with their calibrated probability; levels unknown to training count as missing."""
        return calibrated(
            with_probability(self.model, rows, "__uncalibrated"), self.calibrator,
            "__uncalibrated").drop("__uncalibrated")

    def explainer(self) -> Explainer:
        explainable(self.metadata["champion"])
        leaves = read_leaves(SparkSession.active(), self.model_path)
        return Explainer(self.model, leaves, self.slot_features)


def train(
    mart: DataFrame, settings: Settings, run_id: str | None = None,
    models: Sequence[str] = tuple(MODELS), compared_in: str | None = None,
) -> dict:
    """Compare models by cross-validation, refit the champion, calibrate it, record the run.

    ``compared_in`` names a table of one run that compared these models, perhaps among others, on this
    mart with these settings: its fold metrics are recorded again instead of fitting every fold again.
    """
    spark, run_id = mart.sparkSession, run_id or uuid.uuid4().hex
    contract = CONTRACT if settings.id_col == KEY else Contract(
        settings.id_col, settings.label_col, settings.split_col, ())
    gate(contract.report(mart))
    pool, _ = split_pools(mart, settings.split_col)
    features = feature_set(mart, settings)

    oof = None
    if compared_in:
        by_fold = read_runs(spark, compared_in).filter(F.col("fold").isNotNull() & F.col("model").isin(*models))
        record_run(by_fold, run_id, "folds", f"{settings.reports_dir}/runs")
    else:
        oof = out_of_fold_scores(pool, features, settings, models).persist(StorageLevel.MEMORY_AND_DISK)
        by_fold = rank_metrics(oof, "probability", settings.label_col, ["model", "fold"])
        record_run(metrics_long(by_fold, ["model", "fold"], ["n_rows", "n_positive"]), run_id, "folds", f"{settings.reports_dir}/runs")
    runs = read_runs(spark, f"{settings.reports_dir}/runs").filter(F.col("run_id") == run_id)
    folds = runs.groupBy("model", "fold").pivot("metric", ["roc_auc", "pr_auc"]).agg(F.first("value"))
    summary = cv_summary(folds)
    cv_rows = [r.asDict() for r in summary.collect()]
    name = champion(summary, list(models)).first()["model"]
    if oof is not None:
        oof.unpersist()

    split = stratified_holdout(
        pool, settings.id_col, settings.label_col, settings.holdout_share, settings.seed)
    fitted = fit_model(MODELS[name], split.filter(~F.col("is_holdout")), features, settings)
    held = fitted.probabilities(split.filter("is_holdout"), "uncalibrated").select(
        settings.id_col, settings.label_col, "uncalibrated").persist(StorageLevel.MEMORY_AND_DISK)
    calibrator = fit_calibrator(held, "uncalibrated", settings.label_col)
    scores = {"holdout_uncalibrated": "uncalibrated", "holdout_calibrated": "calibrated"}
    both = calibrated(held, calibrator, "uncalibrated", "calibrated")
    holdout = compare_scores(both, scores, settings.label_col).withColumn(
        "fold", F.lit(None).cast("int"))
    record_run(metrics_long(holdout, ["model", "fold"]), run_id, "holdout", f"{settings.reports_dir}/runs")
    facts = pool.agg(
        F.count(F.lit(1)).cast("double").alias("n_train_rows"),
        F.avg(F.col(settings.label_col).cast("double")).alias("label_rate"))
    facts = facts.withColumns({"n_cv_folds": F.lit(float(settings.folds)),
                               "n_features": F.lit(float(len(features.names)))})
    facts = facts.withColumns({"model": F.lit(name), "fold": F.lit(None).cast("int")}).unpivot(
        ["model", "fold"], ["n_train_rows", "label_rate", "n_cv_folds", "n_features"],
        "metric", "value")
    record_run(facts, run_id, "facts", f"{settings.reports_dir}/runs")
    reliability_comparison(both, scores, settings.label_col).write.mode("overwrite").parquet(
        f"{settings.reports_dir}/reliability")

    # The served copy, and a copy per run that later runs do not replace.
    for base in (settings.model_dir, f"{settings.model_dir}/versions/{run_id}"):
        fitted.model.write().overwrite().save(f"{base}/champion")
        calibrator.write().overwrite().save(f"{base}/calibrator")
        write_metadata(spark, f"{base}/metadata", {
            "feature_cols": features.names, "numeric_cols": list(features.numeric),
            "categorical_cols": list(features.categorical), "levels": dict(features.levels),
            "champion": name})
        spark.createDataFrame(
            list(enumerate(fitted.slot_features)), "slot int, feature string"
        ).coalesce(1).write.mode("overwrite").json(f"{base}/slots")
    metrics = {r["model"]: r.asDict() for r in read_runs(spark, f"{settings.reports_dir}/runs")
               .filter((F.col("run_id") == run_id) & F.col("fold").isNull())
               .groupBy("model").pivot("metric").agg(F.first("value")).collect()}
    held.unpersist()
    return {"run_id": run_id, "cv_results": cv_rows, "champion_model": name,
            "holdout_uncalibrated": metrics["holdout_uncalibrated"],
            "holdout_calibrated": metrics["holdout_calibrated"]}


def score_pool(mart: DataFrame, settings: Settings, path: str | None = None) -> DataFrame:
    """Calibrated probability of every row of the scoring pool; also a CSV when given a path."""
    _, pool = split_pools(mart, settings.split_col)
    scored = Artefacts.load(mart.sparkSession, settings).score(pool)
    submission = scored.select(
        F.col(settings.id_col).alias(settings.id_col.upper()),
        F.col("probability").alias(settings.label_col.upper()))
    if path:
        write_csv(submission, path)
    return submission


def score_requests(mart: DataFrame, requests: DataFrame, settings: Settings) -> DataFrame:
    """A score record per requested id; ids that are not in the mart come back with found = false."""
    answered = lookup_requests(mart, requests, settings.id_col)
    # Absent ids are scored along as rows without values and blanked after, so the join runs once.
    scored = Artefacts.load(mart.sparkSession, settings).score(answered)
    records = score_records(scored, settings.id_col, settings.split_col, settings.label_col, "found")
    return records.select(settings.id_col, *[
        F.when(F.col("found"), F.col(c)).alias(c)
        for c in records.columns if c not in (settings.id_col, "found")], "found")


def explain_requests(mart: DataFrame, requests: DataFrame, settings: Settings, k: int | None = None) -> DataFrame:
    """Contributions per requested id of a frame; ids that are not in the mart have found = false."""
    answered = lookup_requests(mart, requests, settings.id_col)
    explained = Artefacts.load(mart.sparkSession, settings).explainer().explain(
        answered, settings.id_col, "found")
    if k is not None:
        explained = explained.withColumn("contributions", top_drivers("contributions", k))
    return explained.select(settings.id_col, *[
        F.when(F.col("found"), F.col(c)).alias(c)
        for c in explained.columns if c not in (settings.id_col, "found")], "found")


def explain_ids(mart: DataFrame, ids: list, settings: Settings, k: int | None = None) -> DataFrame:
    """Contributions of the listed ids, optionally only the k strongest; unknown ids are an error."""
    explained = Artefacts.load(mart.sparkSession, settings).explainer().explain(
        require_present(mart, settings.id_col, ids), settings.id_col)
    return explained if k is None else explained.withColumn(
        "contributions", top_drivers("contributions", k))


def importance(mart: DataFrame, settings: Settings, path: str | None = None) -> DataFrame:
    """Global importance over a seeded sample of the training pool."""
    pool, _ = split_pools(mart, settings.split_col)
    table = Artefacts.load(mart.sparkSession, settings).explainer().global_importance(
        pool, settings.id_col, settings.importance_sample, settings.seed)
    if path:
        write_csv(table.coalesce(1), path)
    return table


def train_and_score(mart: DataFrame, settings: Settings) -> dict:
    summary = train(mart, settings)
    score_pool(mart, settings, f"{settings.reports_dir}/submission")
    return summary
