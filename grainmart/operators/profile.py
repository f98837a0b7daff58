"""Profile of a mart: missing values, correlation with the label, label spread over levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmart.functions.sqltext import ident, literal, rows, struct


def missing_rates(df: DataFrame, columns: Sequence[str], top_n: int = 15) -> DataFrame:
    """Share of nulls per column, highest first; one pass over the frame."""
    counted = df.selectExpr(
        "count(1) AS n", *[f"count({ident(c)}) AS v{i}" for i, c in enumerate(columns)])
    rates = counted.selectExpr(rows(
        struct({"feature": literal(c), "missing_rate": f"try_divide(CAST(n - v{i} AS DOUBLE), n)"})
        for i, c in enumerate(columns)))
    return rates.orderBy(F.desc("missing_rate"), "feature").limit(top_n)


def label_correlations(
    df: DataFrame, columns: Sequence[str], label: str, top_n: int = 15
) -> DataFrame:
    """Pearson correlation of each numeric column with the label over rows that have both,
    largest magnitude first, sign kept. Constant columns have none and are left out.

    Each row fans out to (feature, value, label) and is merged again into one set of central
    moments per feature before anything is shuffled; central moments are stable in one pass.
    """
    values = df.filter(F.col(label).isNotNull()).selectExpr(
        f"CAST({ident(label)} AS DOUBLE) AS y",
        rows(struct({"feature": literal(c), "x": f"CAST({ident(c)} AS DOUBLE)"}) for c in columns))
    return (
        values.filter("x IS NOT NULL").groupBy("feature")
        .agg(F.expr("try_divide(covar_pop(x, y), stddev_pop(x) * stddev_pop(y))")
             .alias("correlation"))
        .filter("correlation IS NOT NULL")
        .orderBy(F.abs("correlation").desc(), "feature").limit(top_n)
    )


def level_rates(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """Mean label and support per (column, level); the null level is left out.

    The partial aggregate runs before the shuffle, so a level that holds most rows is no burden.
    """
    return (
        df.select(F.col(label).cast("double").alias("__y"), *columns)
        .unpivot("__y", list(columns), "feature", "level")
        .filter(F.col("level").isNotNull())
        .groupBy("feature", "level")
        .agg(F.avg("__y").alias("rate"), F.count("__y").alias("support"))
    )


def level_spread(
    df: DataFrame, columns: Sequence[str], label: str, top_n: int = 10, min_support: int = 20
) -> DataFrame:
    """Highest minus lowest mean label over the levels with enough rows, widest first."""
    return (
        level_rates(df, columns, label).filter(F.col("support") >= min_support)
        .groupBy("feature")
        .agg((F.max("rate") - F.min("rate")).alias("spread"),
             F.count(F.lit(1)).alias("n_categories"))
        .orderBy(F.desc("spread"), "feature").limit(top_n)
    )


def header(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], label: str) -> DataFrame:
    """Row count, label rate and feature counts as one row."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.col(label).cast("double")).alias("label_rate"),
        F.lit(len(numeric) + len(categorical)).alias("n_features"),
        F.lit(len(numeric)).alias("n_numeric"),
        F.lit(len(categorical)).alias("n_categorical"),
    )


def render_markdown(head: DataFrame, missing: DataFrame, corr: DataFrame, spread: DataFrame) -> str:
    """The four small profile tables as one Markdown text."""
    h = head.first()
    out = [
        "# Profile", "",
        f"- Training rows: {h['n_rows']:,}",
        f"- Label rate: {h['label_rate'] or 0.0:.2%}",
        f"- Features: {h['n_features']} ({h['n_numeric']} numeric, {h['n_categorical']} categorical)",
    ]
    sections = [
        ("Missing values", "| feature | missing rate |\n|---|---|", missing,
         lambda r: f"| `{r['feature']}` | {r['missing_rate']:.1%} |"),
        ("Correlation with the label", "| feature | correlation |\n|---|---|", corr,
         lambda r: f"| `{r['feature']}` | {r['correlation']:+.3f} |"),
        ("Label-rate spread over levels", "| feature | spread | levels |\n|---|---|---|", spread,
         lambda r: f"| `{r['feature']}` | {r['spread']:.1%} | {r['n_categories']} |"),
    ]
    for title, head_lines, table, line in sections:
        out += ["", f"## {title}", "", head_lines, *[line(r) for r in table.collect()]]
    return "\n".join(out) + "\n"
