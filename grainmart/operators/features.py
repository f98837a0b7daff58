"""What a feature is, how it is typed, and how it becomes a vector for a model.

Fitted preparations are built from Spark ML stages only (SQLTransformer, StringIndexerModel,
OneHotEncoderModel, VectorAssembler), so they persist and load as part of a PipelineModel.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainmart.functions.sqltext import ident, literal
from grainmart.operators.ordered import exact_quantiles, running_totals
from grainmart.sources.scratch import stored

FEATURES_COL = "__features"


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c not in set(exclude)]


def split_types(df: DataFrame, columns: Sequence[str]) -> tuple[list[str], list[str]]:
    """(numeric, categorical): strings are categorical, everything else is numeric."""
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return [c for c in columns if c not in text], [c for c in columns if c in text]


def level_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, level, n) over non-null levels, combined per task before the shuffle."""
    return (
        df.select(F.lit(0).alias("__one"), *columns)
        .unpivot("__one", list(columns), "feature", "level").filter(F.col("level").isNotNull())
        .groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"))
    )


def capture_levels(pool: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The written dictionary (feature, level, index) of the training pool: a level's place from 0 in code point order.

    Places come from a distributed scan over range-partitioned levels, so a column may have any number.
    """
    if not columns:
        return pool.sparkSession.createDataFrame([], "feature string, level string, index bigint")
    found = level_counts(pool, columns).select("feature", "level", F.lit(1).alias("one"))
    return stored(running_totals(found, ["feature"], "level", ["one"]).select(
        "feature", "level", F.col("one_before").alias("index")), "levels")


def level_lists(levels: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """The dictionary as sorted lists, for models: Spark ML keeps the labels of a text column in the model itself."""
    lists: dict[str, list[str]] = {c: [] for c in columns}
    for row in levels.where(F.col("feature").isin(*columns)).orderBy("feature", "index").select("feature", "level").toLocalIterator():
        lists[row["feature"]].append(row["level"])
    return lists


def conform_levels(df: DataFrame, levels: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace levels that the dictionary does not hold by null; all other columns are untouched.

    Each column meets its levels in a left join: Spark broadcasts a small dictionary and shuffles by a large one.
    """
    out = df
    for i, c in enumerate(columns):
        known = levels.where(F.col("feature") == c).select(F.col("level").alias(f"__known{i}"))
        out = out.join(known, F.col(f"`{c}`") == F.col(f"__known{i}"), "left")
    at = {c: i for i, c in enumerate(columns)}
    return out.select(*[F.col(f"__known{at[c]}").alias(c) if c in at else F.col(f"`{c}`") for c in df.columns])


def most_frequent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, level) of the most frequent level per column, the smallest one on a tie."""
    return level_counts(df, columns).groupBy("feature").agg(
        F.min_by("level", F.struct(-F.col("n"), F.col("level"))).alias("level"))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """One row: rows per class, the negative-to-positive ratio and the balanced weights."""
    y = F.col(label)
    n = F.count_if(y.isin(0, 1)).cast("double")
    negative, positive = F.count_if(y == 0), F.count_if(y == 1)
    return df.agg(
        negative.alias("n_negative"), positive.alias("n_positive"),
        F.try_divide(negative.cast("double"), positive.cast("double")).alias("positive_weight"),
        F.try_divide(n, 2 * negative.cast("double")).alias("balanced_negative"),
        F.try_divide(n, 2 * positive.cast("double")).alias("balanced_positive"),
    )


def class_weight(df: DataFrame, label: str, balanced: bool) -> Column:
    """Row weights from the class counts of ``df``: balanced, or neg/pos for positives only."""
    c = class_counts(df, label).first()
    if not c["n_negative"] or not c["n_positive"]:
        raise ValueError("training rows must hold both classes")
    up, down = (
        (c["balanced_positive"], c["balanced_negative"]) if balanced else (c["positive_weight"], 1.0)
    )
    return F.when(F.col(label) == 1, F.lit(up)).otherwise(F.lit(down))


def _as_double(column: str) -> str:
    return f"nanvl(CAST({ident(column)} AS DOUBLE), CAST(NULL AS DOUBLE))"


def _derive(expressions: Mapping[str, str]) -> SQLTransformer:
    listed = ", ".join(f"{sql} AS `{name}`" for name, sql in expressions.items())
    return SQLTransformer(statement=f"SELECT *, {listed} FROM __THIS__")


def _indexers(levels: Mapping[str, Sequence[str]], suffix: str = "") -> list[StringIndexerModel]:
    """Alphabetical level numbers; null and unseen levels share one extra number."""
    return [
        StringIndexerModel.from_labels(
            list(known), inputCol=f"{c}{suffix}", outputCol=f"{c}__level", handleInvalid="keep")
        for c, known in levels.items()
    ]


@dataclass(frozen=True)
class Preparation:
    """Fitted stages, and for each vector slot of a tree model the feature it came from."""

    stages: list
    slot_features: list[str]
    max_categories: int = 0

    def transform(self, df: DataFrame) -> DataFrame:
        return PipelineModel(self.stages).transform(df)


def numeric_fill(df: DataFrame, numeric: Sequence[str]) -> dict[str, tuple[float, float, float]]:
    """(median, mean, population deviation) per column, the last two after filling the median.

    The median is exact. A constant column gets deviation 1; a column without values is left out.
    """
    medians = {c: v[0] for c, v in exact_quantiles(df, numeric, [0.5]).items()} if numeric else {}
    usable = [c for c in numeric if medians[c] is not None]
    if not usable:
        return {}
    filled = [F.coalesce(F.expr(_as_double(c)), F.lit(medians[c])) for c in usable]
    stats = df.agg(*[
        a for i, x in enumerate(filled)
        for a in (F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}"))
    ]).first()
    return {c: (medians[c], stats[f"m{i}"], stats[f"s{i}"] or 1.0) for i, c in enumerate(usable)}


def scaled(column: str, fill: tuple[float, float, float]) -> str:
    """SQL of one imputed and standardised column."""
    median, mean, deviation = fill
    return (f"(coalesce({_as_double(column)}, {literal(median)}) - {literal(mean)})"
            f" / {literal(deviation)}")


def fit_linear_preparation(
    pool: DataFrame, numeric: Sequence[str], categorical: Sequence[str]
) -> Preparation:
    """Median fill and standardise numbers; most-frequent fill and one-hot levels.

    A level unseen in the pool gives an all-zero block.
    """
    fills = numeric_fill(pool, numeric)
    stages, assembled = [], [f"{c}__scaled" for c in fills]
    if fills:
        stages.append(_derive({f"{c}__scaled": scaled(c, f) for c, f in fills.items()}))
    levels = {c: v for c, v in level_lists(capture_levels(pool, categorical), categorical).items() if v}
    if levels:
        modes = {r["feature"]: r["level"] for r in most_frequent(pool, list(levels)).collect()}
        stages.append(_derive({
            f"{c}__filled": f"coalesce({ident(c)}, {literal(modes[c])})" for c in levels}))
        stages += _indexers(levels, "__filled")
        encoder = OneHotEncoder(
            inputCols=[f"{c}__level" for c in levels], outputCols=[f"{c}__hot" for c in levels],
            dropLast=True)
        stages.append(encoder.fit(PipelineModel(stages).transform(pool)))
        assembled += [f"{c}__hot" for c in levels]
    stages.append(VectorAssembler(inputCols=assembled, outputCol=FEATURES_COL))
    return Preparation(stages, [])


def fit_tree_preparation(
    pool: DataFrame, numeric: Sequence[str], levels: Mapping[str, Sequence[str]]
) -> Preparation:
    """A missing number becomes a value below all others plus, where the pool has missing values,
    a 0/1 column, so that a tree can split on missingness; levels become category numbers."""
    stats = pool.agg(*[
        a for i, c in enumerate(numeric) for a in (
            F.min(F.expr(_as_double(c))).alias(f"lo{i}"),
            F.count_if(F.expr(_as_double(c)).isNull()).alias(f"na{i}"))
    ]).first() if numeric else {}
    derived, slots, sources = {}, [], []
    for i, c in enumerate(numeric):
        low = stats[f"lo{i}"] if stats[f"lo{i}"] is not None else 0.0
        below = low - 1.0 - abs(low)
        derived[f"{c}__value"] = f"coalesce({_as_double(c)}, {literal(below)})"
        slots.append(f"{c}__value")
        sources.append(c)
        if stats[f"na{i}"]:
            derived[f"{c}__missing"] = f"CAST({_as_double(c)} IS NULL AS DOUBLE)"
            slots.append(f"{c}__missing")
            sources.append(c)
    stages = [_derive(derived)] if derived else []
    levels = {c: v for c, v in levels.items() if v}
    if levels:
        stages += _indexers(levels)
        slots += [f"{c}__level" for c in levels]
        sources += list(levels)
    stages.append(VectorAssembler(inputCols=slots, outputCol=FEATURES_COL))
    return Preparation(stages, sources, 1 + max([len(v) for v in levels.values()], default=1))
