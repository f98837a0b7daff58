"""Training, scoring and explanation over documents: all models, all folds, the jobs' own patience and rounds.

One training run per session and input serves all queries here; the first of them pays for it. The
feature mart is written once to the session's scratch folder, so that the many passes of training
read narrow columns instead of whole texts. Fitted numbers have no SQL, so the queries named
``*_check`` reduce real output to what is determined and have an oracle.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmart.config import Settings, scratch_dir
from grainmart.operators.explain import Explainer, top_drivers
from grainmart.operators.rollup import split_pools
from grainmart.operators.split import seeded_sample
from grainmart.operators.train import MODELS, calibrated, fit_calibrator, with_probability
from grainmart.plans import jobs
from grainmart.sources.scratch import stored
from grainmart.sources.warehouse import Warehouse, load_mart, read_runs
from workload.commerce import _ranked, labelled, scored_labels, table

TREES = tuple(name for name, spec in MODELS.items() if spec.is_tree)
_SESSIONS: dict[tuple[str, ...], Settings] = {}


def settings_in(folder: str) -> Settings:
    return Settings(
        warehouse_dir=f"{folder}/warehouse", model_dir=f"{folder}/models",
        reports_dir=f"{folder}/reports", id_col="doc_id")


def document_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: shape of its whole text, language, source and label."""
    documents = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "lang", "source", "n_chars", "size(split(text, '\\\\s+')) AS n_words", "regexp_count(text, '\\n') AS n_lines",
        "nullif(regexp_count(text, '[0-9]'), 0) AS n_digits",
        "nullif(regexp_count(text, '[^\\\\x00-\\\\x7f]'), 0) AS n_accented",
        "regexp_count(text, '[.!?]') / greatest(n_chars, 1) AS stop_share",
        "regexp_count(text, '[A-Z]') / greatest(n_chars, 1) AS capital_share",
        "text LIKE '%@%' AS has_at_sign")
    return labelled(spark, sf_dir, documents).withColumn("target", 1 - F.col("target"))


def _run(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Settings]:
    """The mart and saved models of this session; trained on first use."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _SESSIONS:
        folder = f"{scratch_dir(spark)}/documents-{uuid.uuid4().hex}"
        settings = settings_in(folder)
        warehouse = Warehouse(spark, settings.warehouse_dir)
        # Sorting passes over its input twice, so the texts are measured before.
        warehouse.replace(stored(document_features(spark, sf_dir), "document-features"), "marts", "documents",
                          sort_by="doc_id", partition_by="is_train")
        jobs.train(load_mart(warehouse, "documents", "is_train"), settings)
        _SESSIONS[key] = settings
    settings = _SESSIONS[key]
    return load_mart(Warehouse(spark, settings.warehouse_dir), "documents", "is_train"), settings


def _run_of_trees(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Settings]:
    """The same mart and the best tree model by the comparison that the full run recorded, fitted on first use."""
    mart, full = _run(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir, *TREES)
    if key not in _SESSIONS:
        settings = replace(full, model_dir=f"{full.model_dir}-of-trees", reports_dir=f"{full.reports_dir}-of-trees")
        jobs.train(mart, settings, models=TREES, compared_in=f"{full.reports_dir}/runs")
        _SESSIONS[key] = settings
    return mart, _SESSIONS[key]


def _explained(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Settings, Explainer]:
    """The run to explain: the full one, or one among the trees if a linear model won that."""
    mart, settings = _run(spark, sf_dir)
    try:
        return mart, settings, jobs.Artefacts.load(spark, settings).explainer()
    except NotImplementedError:
        mart, settings = _run_of_trees(spark, sf_dir)
        return mart, settings, jobs.Artefacts.load(spark, settings).explainer()


def document_feature_mart(spark, sf_dir):
    return document_features(spark, sf_dir)


def _fold_metrics(spark, sf_dir):
    _, settings = _run(spark, sf_dir)
    runs = read_runs(spark, f"{settings.reports_dir}/runs").filter("fold IS NOT NULL")
    names = ["n_rows", "n_positive", "roc_auc", "pr_auc", "ks_statistic", "brier_score"]
    return runs.groupBy("model", "fold").pivot("metric", names).agg(F.first("value"))


def cv_fold_metrics(spark, sf_dir):
    """Every model on every fold, as the run recorded them."""
    return _fold_metrics(spark, sf_dir)


def cv_fold_check(spark, sf_dir):
    """Size and positives of every fold that each model was measured on, and whether metrics are in range."""
    inside = " AND ".join(f"{m} BETWEEN 0 AND 1" for m in ("roc_auc", "pr_auc", "ks_statistic", "brier_score"))
    return _fold_metrics(spark, sf_dir).selectExpr(
        "model", "fold", "CAST(n_rows AS BIGINT) AS n_rows", "CAST(n_positive AS BIGINT) AS n_positive",
        f"{inside} AS in_range")


def runs_table(spark, sf_dir):
    """The record of a training run: fold metrics, holdout metrics before and after calibration."""
    _, settings = _run(spark, sf_dir)
    return read_runs(spark, f"{settings.reports_dir}/runs").select("model", "fold", "metric", "value")


def reliability_table(spark, sf_dir):
    _, settings = _run(spark, sf_dir)
    return spark.read.parquet(f"{settings.reports_dir}/reliability")


def scored_pool(spark, sf_dir):
    return jobs.score_pool(*_run(spark, sf_dir))


def scored_pool_check(spark, sf_dir):
    return scored_pool(spark, sf_dir).selectExpr("DOC_ID AS doc_id", "TARGET BETWEEN 0 AND 1 AS in_range")


def _requests(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select((F.col("conv_id") * 7).alias("doc_id"))


def scored_requests(spark, sf_dir):
    mart, settings = _run(spark, sf_dir)
    return jobs.score_requests(mart, _requests(spark, sf_dir), settings)


def scored_requests_check(spark, sf_dir):
    """Every requested id once: found or absent, its label, and a tier that fits its probability."""
    tier = """CASE WHEN probability < 0.08 THEN 'Low' WHEN probability < 0.20 THEN 'Medium'
              WHEN probability <= 1 THEN 'High' END"""
    return scored_requests(spark, sf_dir).selectExpr(
        "doc_id", "found", "is_train", "actual_target", "actual_outcome", f"risk_tier <=> ({tier}) AS tier_fits",
        "(probability IS NOT NULL) = found AS answered")


def contributions(spark, sf_dir):
    """Every document, base value and contribution of each feature to its log-odds."""
    mart, _, explainer = _explained(spark, sf_dir)
    return explainer.explain(mart, "doc_id").select(
        "doc_id", "base_value", "predicted_score", F.inline("contributions"))


def contributions_check(spark, sf_dir):
    """Per document: number of features, falling magnitude, and base plus contributions against the model's own log-odds."""
    mart, _, explainer = _explained(spark, sf_dir)
    explained = explainer.explain(mart, "doc_id").join(
        with_probability(explainer.model, mart).select("doc_id", "probability"), "doc_id")
    return explained.selectExpr(
        "doc_id", "size(contributions) AS n_features",
        """forall(transform(contributions, (c, i) -> abs(c.contribution)
             - coalesce(abs(get(contributions, i + 1).contribution), 0)), x -> x >= 0) AS falling""",
        """abs(aggregate(contributions, base_value, (total, c) -> total + c.contribution)
             - ln(probability / (1 - probability))) < 1e-9 AS additive""")


def contribution_top_drivers(spark, sf_dir):
    mart, _, explainer = _explained(spark, sf_dir)
    strongest = top_drivers("contributions", 3, reverse=True)
    return explainer.explain(mart, "doc_id").select(
        "doc_id", F.posexplode(strongest).alias("place", "driver")).select("doc_id", "place", "driver.*")


def explained_requests(spark, sf_dir):
    """The two strongest features per requested id, absent ids included: the number of drivers is determined."""
    mart, settings, _ = _explained(spark, sf_dir)
    explained = jobs.explain_requests(mart, _requests(spark, sf_dir), settings, k=2)
    return explained.selectExpr("doc_id", "found", "coalesce(size(contributions), 0) AS n_drivers")


def global_importance(spark, sf_dir):
    mart, settings, _ = _explained(spark, sf_dir)
    return jobs.importance(mart, settings)


def importance_check(spark, sf_dir):
    """Per feature whether its importance is the mean magnitude of its contributions over the sample."""
    mart, settings, explainer = _explained(spark, sf_dir)
    pool, _ = split_pools(mart, "is_train")
    sample = seeded_sample(pool, "doc_id", settings.importance_sample, settings.seed)
    again = explainer.explain(sample, "doc_id").select(F.inline("contributions")).groupBy("feature").agg(
        F.avg(F.abs("contribution")).alias("mean"))
    return jobs.importance(mart, settings).join(again, "feature").selectExpr(
        "feature", "abs(mean - mean_abs_contribution) < 1e-9 AS same")


def isotonic_calibration(spark, sf_dir):
    """The monotone fit of a label on a coarse score, at every distinct score."""
    scored = scored_labels(spark, sf_dir)
    fitted = fit_calibrator(scored, "coarse", "quality")
    points = scored.select("coarse").distinct()
    return calibrated(points, fitted, "coarse").selectExpr(
        "round(coarse, 6) + 0D AS coarse", "round(probability, 6) + 0D AS probability")


QUERIES = {f.__name__: f for f in (
    document_feature_mart, runs_table, cv_fold_metrics, cv_fold_check, reliability_table, scored_pool,
    scored_pool_check, scored_requests, scored_requests_check, contributions, contributions_check,
    contribution_top_drivers, explained_requests, global_importance, importance_check, isotonic_calibration)}

_REQUESTED = "requested AS (SELECT DISTINCT conv_id * 7 AS doc_id FROM conversations)"

ORACLE = {
    "document_feature_mart": """SELECT d.doc_id, lang, source, n_chars, l.doc_id IS NOT NULL AS is_train,
      CAST(1 - quality AS DOUBLE) AS target, len(regexp_split_to_array(text, '\\s+')) AS n_words,
      len(regexp_extract_all(text, '\\n')) AS n_lines,
      nullif(len(regexp_extract_all(text, '[0-9]')), 0) AS n_digits,
      nullif(len(regexp_extract_all(text, '[^\\x00-\\x7f]')), 0) AS n_accented,
      len(regexp_extract_all(text, '[.!?]')) / CAST(greatest(n_chars, 1) AS DOUBLE) AS stop_share,
      len(regexp_extract_all(text, '[A-Z]')) / CAST(greatest(n_chars, 1) AS DOUBLE) AS capital_share,
      text LIKE '%@%' AS has_at_sign FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
    "cv_fold_check": f"""WITH folded AS (SELECT quality, CAST(floor({_ranked('doc_id', 42, 'quality')}) AS BIGINT) * 5
        // count(*) OVER (PARTITION BY quality) AS fold FROM labels JOIN documents USING (doc_id))
      SELECT model, CAST(fold AS INT) AS fold, count(*) AS n_rows, count(*) FILTER (WHERE quality = 0) AS n_positive,
        true AS in_range FROM folded,
        (VALUES ('logistic_regression'), ('boosted_shallow'), ('boosted_deep')) m(model) GROUP BY model, fold""",
    "scored_pool_check": "SELECT doc_id, true AS in_range FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "scored_requests_check": f"""WITH {_REQUESTED} SELECT r.doc_id, d.doc_id IS NOT NULL AS found,
        CASE WHEN d.doc_id IS NOT NULL THEN l.doc_id IS NOT NULL END AS is_train, 1 - quality AS actual_target,
        CASE WHEN d.doc_id IS NULL THEN NULL WHEN quality = 0 THEN 'Default' WHEN quality = 1 THEN 'No default'
          ELSE 'Unknown (scoring set)' END AS actual_outcome, true AS tier_fits, true AS answered
      FROM requested r LEFT JOIN documents d ON d.doc_id = r.doc_id LEFT JOIN labels l ON l.doc_id = r.doc_id""",
    "contributions_check": "SELECT doc_id, 10 AS n_features, true AS falling, true AS additive FROM documents",
    "explained_requests": f"""WITH {_REQUESTED} SELECT r.doc_id, d.doc_id IS NOT NULL AS found,
        CASE WHEN d.doc_id IS NULL THEN 0 ELSE 2 END AS n_drivers FROM requested r LEFT JOIN documents d ON d.doc_id = r.doc_id""",
    "importance_check": """SELECT feature, true AS same FROM (VALUES ('lang'), ('source'), ('n_chars'), ('n_words'), ('n_lines'),
        ('n_digits'), ('n_accented'), ('stop_share'), ('capital_share'), ('has_at_sign')) f(feature)""",
    # The monotone fit at a place is the largest, over starts up to it, of the smallest mean to an end from it on.
    "isotonic_calibration": """WITH s AS (SELECT CAST(n_chars % 97 AS DOUBLE) / 97 AS coarse, CAST(quality AS DOUBLE) AS y
        FROM documents JOIN labels USING (doc_id)),
      g AS (SELECT coarse, sum(y) AS y, count(*) AS n, row_number() OVER (ORDER BY coarse) AS i FROM s GROUP BY coarse),
      c AS (SELECT *, sum(y) OVER (ORDER BY i) AS sy, sum(n) OVER (ORDER BY i) AS sn FROM g),
      m AS (SELECT a.i AS a, b.i AS b, (b.sy - a.sy + a.y) / (b.sn - a.sn + a.n) AS mean FROM c a JOIN c b ON a.i <= b.i),
      low AS (SELECT g.i, m.a, min(m.mean) AS least FROM g JOIN m ON m.a <= g.i AND m.b >= g.i GROUP BY g.i, m.a)
      SELECT round(coarse, 6) + 0.0 AS coarse, round(max(least), 6) + 0.0 AS probability FROM low JOIN g USING (i) GROUP BY coarse""",
}
