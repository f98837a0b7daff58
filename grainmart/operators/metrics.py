"""Ranking and calibration metrics of scored pools, exact and distributed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmart.operators.ordered import exact_quantiles, running_totals
from grainmart.operators.rollup import union_all

METRICS = ("roc_auc", "pr_auc", "ks_statistic", "brier_score")


def rank_metrics(
    scored: DataFrame, score: str, label: str, by: Sequence[str] = (), slices: int | None = None
) -> DataFrame:
    """ROC-AUC, average precision, KS and Brier score per ``by`` group.

    Rows are merged per score first, so ties are treated as one threshold and the shuffle
    carries distinct scores only. The ranking metrics of a group with one class are null.
    """
    groups = (
        scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*by, F.col(score).cast("double").alias("__score"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("p"))
    )
    curve = running_totals(groups, by, "__score", ["n", "p"], slices)
    n, p, s = F.col("n").cast("double"), F.col("p").cast("double"), F.col("__score")
    all_rows, positives = F.col("n_total").cast("double"), F.col("p_total").cast("double")
    negatives = all_rows - positives
    found = positives - F.col("p_before")      # positives at or above this score
    taken = all_rows - F.col("n_before")       # rows at or above this score
    return curve.groupBy(*by).agg(
        F.first("n_total").alias("n_rows"),
        F.first("p_total").alias("n_positive"),
        F.sum(F.when((positives > 0) & (negatives > 0),
                     (n - p) * (found - p / 2) / (positives * negatives))).alias("roc_auc"),
        F.sum(F.when((positives > 0) & (negatives > 0), (p / positives) * (found / taken)))
        .alias("pr_auc"),
        F.max(F.when((positives > 0) & (negatives > 0), F.greatest(
            F.lit(0.0), found / positives - (taken - found) / negatives))).alias("ks_statistic"),
        (F.sum(p * (1 - s) * (1 - s) + (n - p) * s * s) / F.sum(n)).alias("brier_score"),
    )


def metrics_long(metrics: DataFrame, keys: Sequence[str], also: Sequence[str] = ()) -> DataFrame:
    """Metric columns, and other numbers such as sizes, as (keys, metric, value) rows."""
    names = [*METRICS, *also]
    return metrics.select(*keys, *[F.col(c).cast("double").alias(c) for c in names]).unpivot(
        list(keys), names, "metric", "value")


def compare_scores(scored: DataFrame, scores: dict[str, str], label: str) -> DataFrame:
    """The metrics of several score columns over the same rows, one row per name."""
    long = scored.select(label, *[F.col(c).alias(name) for name, c in scores.items()]).unpivot(
        label, list(scores), "model", "score")
    return rank_metrics(long, "score", label, by=["model"])


def reliability_bins(scored: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """Mean score against observed rate in quantile bins.

    Edges are exact quantiles; a score on an edge belongs to the bin below it. Bins left empty by
    tied edges do not appear.
    """
    pool = scored.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
    edges = exact_quantiles(pool, [score], [i / bins for i in range(1, bins)])[score]
    if edges and edges[0] is None:
        edges = []
    position = sum((F.when(F.col(score) > F.lit(e), 1).otherwise(0) for e in edges), F.lit(0))
    return pool.groupBy(position.alias("bin")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.col(score).cast("double")).alias("mean_predicted"),
        F.avg(F.col(label).cast("double")).alias("observed_rate"),
    )


def reliability_comparison(
    scored: DataFrame, scores: dict[str, str], label: str, bins: int = 10
) -> DataFrame:
    """Reliability bins of several score columns, one block per name."""
    return union_all([
        reliability_bins(scored, c, label, bins).withColumn("model", F.lit(name))
        for name, c in scores.items()
    ])


def cv_summary(fold_metrics: DataFrame) -> DataFrame:
    """Mean and population deviation of the fold metrics per model."""
    return fold_metrics.groupBy("model").agg(
        F.avg("roc_auc").alias("mean_roc_auc"), F.stddev_pop("roc_auc").alias("std_roc_auc"),
        F.avg("pr_auc").alias("mean_pr_auc"), F.stddev_pop("pr_auc").alias("std_pr_auc"),
    )


def champion(summary: DataFrame, model_order: Sequence[str]) -> DataFrame:
    """The model with the highest mean average precision; the earlier listed one wins a tie."""
    place = F.array_position(F.array(*[F.lit(m) for m in model_order]), F.col("model"))
    return summary.orderBy(F.desc_nulls_last("mean_pr_auc"), place).limit(1)
