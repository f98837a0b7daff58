"""Contributions of features to the log-odds of a boosted-tree score.

A leaf's share of the score is a product game over the features on its path: a feature present
in a coalition keeps the leaf if the row meets the feature's conditions, an absent one keeps it
with the share of training rows that did. The Shapley values of that game have one vector per
met/unmet pattern, so each leaf gets a lookup table and a batch of rows needs comparisons only.
Leaves are packed in arrays by their number of features and broadcast once; tables and patterns
are made for many leaves in one array operation.
Base value plus contributions equals the row's log-odds exactly.

Paths are those of path-dependent TreeSHAP (Lundberg et al., Consistent Individualized Feature
Attribution for Tree Ensembles).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmart.functions.sqltext import ident, literal
from grainmart.operators.features import FEATURES_COL
from grainmart.operators.split import seeded_sample
from grainmart.operators.train import MODELS

# Spark's boosted margin F gives the probability 1 / (1 + exp(-2 F)), so the log-odds are 2 F.
LOG_ODDS_PER_MARGIN = 2.0

LEAF_CHUNK, ROW_CHUNK = 256, 512  # leaves and rows worked on at once

# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Leaf:
    """Per distinct feature on the path: bounds (low, high], allowed categories or None, and the
    share of rows that pass. ``value`` is the leaf's log-odds contribution."""

    features: tuple[int, ...]
    low: tuple[float, ...]
    high: tuple[float, ...]
    allowed: tuple[frozenset | None, ...]
    share: tuple[float, ...]
    value: float


def read_leaves(spark: SparkSession, model_path: str) -> list[Leaf]:
    """The leaves of a saved pipeline whose last stage is a boosted-tree classifier.

    Collected are the tree nodes: at most rounds * 2 ** (depth + 1) small rows.
    """
    stage = f"{model_path}/stages/*GBTClassifier*"
    weights = {r[0]: r[2] for r in spark.read.parquet(f"{stage}/treesMetadata").collect()}
    nodes = {
        (r["treeID"], r["id"]): r
        for r in spark.read.parquet(f"{stage}/data").select("treeID", "nodeData.*").collect()
    }
    leaves: list[Leaf] = []
    for tree in weights:
        pending = [(0, {})]
        while pending:
            node_id, path = pending.pop()
            node = nodes[tree, node_id]
            if node["leftChild"] < 0:
                columns = list(zip(*[(f, *path[f]) for f in sorted(path)])) or [()] * 5
                leaves.append(Leaf(*map(tuple, columns),
                                   LOG_ODDS_PER_MARGIN * weights[tree] * node["prediction"]))
                continue
            split = node["split"]
            feature, chosen = split["featureIndex"], split["leftCategoriesOrThreshold"]
            for child_id, goes_left in ((node["leftChild"], True), (node["rightChild"], False)):
                low, high, allowed, share = path.get(feature, (-np.inf, np.inf, None, 1.0))
                if split["numCategories"] < 0:
                    low, high = (low, min(high, chosen[0])) if goes_left else (max(low, chosen[0]), high)
                else:
                    every = frozenset(range(split["numCategories"]))
                    side = frozenset(map(int, chosen)) if goes_left else every - frozenset(map(int, chosen))
                    allowed = side if allowed is None else allowed & side
                share *= nodes[tree, child_id]["rawCount"] / node["rawCount"]
                pending.append((child_id, {**path, feature: (low, high, allowed, share)}))
    return leaves


def base_value(leaves: Sequence[Leaf]) -> float:
    return float(sum(leaf.value * np.prod(leaf.share) for leaf in leaves))


@dataclass(frozen=True)
class Packed:
    """Leaves with the same number of features as arrays: a row per leaf, a column per feature.

    ``choice`` is the row of ``allowed`` that a categorical condition uses, -1 for a numeric one.
    """

    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    choice: np.ndarray
    allowed: np.ndarray
    share: np.ndarray
    value: np.ndarray

    def tables(self) -> np.ndarray:
        """Shapley values of every leaf's game for each of its 2 ** d met/unmet patterns."""
        n, d = self.share.shape
        met = ((np.arange(2 ** d)[:, None] >> np.arange(d)) & 1)[None]
        weight = np.array([factorial(k) * factorial(d - k - 1) / factorial(d) for k in range(d)])
        out = np.empty((n, 2 ** d, d))
        for i in range(d):
            by_size = np.zeros((n, 2 ** d, d))  # summed coalition products over the others, by size
            by_size[:, :, 0] = 1.0
            for j in (j for j in range(d) if j != i):
                grown = np.zeros_like(by_size)
                grown[:, :, 1:] = by_size[:, :, :-1] * met[:, :, j, None]
                by_size = by_size * self.share[:, None, j, None] + grown
            out[:, :, i] = self.value[:, None] * (met[:, :, i] - self.share[:, None, i]) * (by_size @ weight)
        return out

    def patterns(self, x: np.ndarray) -> np.ndarray:
        """For each row of x and leaf, which of the leaf's conditions the row meets, as bits."""
        value = x[:, self.features]
        met = (value > self.low) & (value <= self.high)
        if self.allowed.size:
            level = np.clip(np.nan_to_num(value), 0, self.allowed.shape[1] - 1).astype(np.int64)
            met = np.where(self.choice < 0, met, self.allowed[self.choice, level])
        return (met.astype(np.int64) << np.arange(self.features.shape[1])).sum(axis=2)


def pack(leaves: Sequence[Leaf], size: int = LEAF_CHUNK) -> list[Packed]:
    """Leaves by number of features, in pieces of ``size``; a leaf without features moves nothing."""
    by_depth: dict[int, list[Leaf]] = {}
    for leaf in leaves:
        if leaf.features:
            by_depth.setdefault(len(leaf.features), []).append(leaf)
    pieces = []
    for same in by_depth.values():
        for part in (same[i:i + size] for i in range(0, len(same), size)):
            sets = list({a for leaf in part for a in leaf.allowed if a is not None})
            place = {a: k for k, a in enumerate(sets)}
            # One more level than any set names, for levels beyond them all.
            allowed = np.zeros((len(sets), 2 + max([-1, *(max(a, default=-1) for a in sets)])), bool)
            for k, a in enumerate(sets):
                allowed[k, list(a)] = True
            pieces.append(Packed(
                np.array([leaf.features for leaf in part]), np.array([leaf.low for leaf in part]),
                np.array([leaf.high for leaf in part]),
                np.array([[-1 if a is None else place[a] for a in leaf.allowed] for leaf in part]),
                allowed if sets else np.zeros((0, 0), bool),
                np.array([leaf.share for leaf in part]), np.array([leaf.value for leaf in part])))
    return pieces


def _contributions_udf(packed, slot_feature: Sequence[int], n_features: int):
    """Vector column in, per-feature contributions out; slots of one feature are summed.

    ``packed`` is a broadcast of the packed leaves' arrays; leaves number at most rounds * 2 ** depth.
    """

    @F.pandas_udf("array<double>")
    def contributions(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        owner = np.eye(n_features)[np.asarray(slot_feature)]
        pieces = [(piece, piece.tables(), owner[piece.features.ravel()]) for piece in (Packed(**p) for p in packed.value)]
        for batch in batches:
            x = np.array(batch.tolist(), dtype=float).reshape(len(batch), -1)
            out = np.zeros((len(batch), n_features))
            for begin in range(0, len(batch), ROW_CHUNK):
                rows = slice(begin, begin + ROW_CHUNK)
                for piece, tables, owners in pieces:
                    pattern = piece.patterns(x[rows])
                    found = tables[np.arange(len(tables)), pattern]
                    out[rows] += found.reshape(len(pattern), -1) @ owners
            yield pd.Series(list(out))

    return contributions


def explainable(champion: str) -> None:
    """Only tree champions have contributions."""
    if not MODELS[champion].is_tree:
        raise NotImplementedError(
            f"contributions are not available for champion {champion!r}: it is not a tree model")


@dataclass(frozen=True)
class Explainer:
    """A saved tree champion ready to explain rows of the mart."""

    model: PipelineModel
    leaves: list[Leaf]
    slot_features: list[str]

    @classmethod
    def load(cls, spark: SparkSession, path: str, slot_features: Sequence[str], champion: str):
        explainable(champion)
        return cls(PipelineModel.load(path), read_leaves(spark, path), list(slot_features))

    @property
    def features(self) -> list[str]:
        return list(dict.fromkeys(self.slot_features))

    def _with_values(self, rows: DataFrame) -> DataFrame:
        features = self.features
        place = {f: i for i, f in enumerate(features)}
        packed = rows.sparkSession.sparkContext.broadcast([vars(p) for p in pack(self.leaves)])
        udf = _contributions_udf(packed, [place[f] for f in self.slot_features], len(features))
        prepared = PipelineModel(self.model.stages[:-1]).transform(rows)
        return prepared.select(
            *rows.columns, udf(vector_to_array(FEATURES_COL)).alias("__values"))

    def explain(self, rows: DataFrame, id_col: str, *keep: str) -> DataFrame:
        """(id, base value, predicted log-odds, contributions by falling magnitude)."""
        names = ", ".join(literal(f) for f in self.features)
        shown = ", ".join(f"CAST({ident(f)} AS STRING)" for f in self.features)
        base = literal(base_value(self.leaves))
        return self._with_values(rows).selectExpr(
            ident(id_col), f"{base} AS base_value",
            f"{base} + aggregate(__values, 0D, (total, v) -> total + v) AS predicted_score",
            # A leading sort field orders the records; it is dropped again afterwards.
            f"""transform(array_sort(transform(
                arrays_zip(array({names}), array({shown}), __values),
                r -> named_struct('place', -abs(r.__values), 'feature', r.`0`, 'value', r.`1`,
                                  'contribution', r.__values))),
                r -> named_struct('feature', r.feature, 'value', r.value,
                                  'contribution', r.contribution)) AS contributions""", *map(ident, keep))

    def global_importance(self, pool: DataFrame, id_col: str, sample: int, seed: int) -> DataFrame:
        """Mean absolute contribution per feature over a seeded sample, highest first."""
        sampled = self._with_values(seeded_sample(pool, id_col, sample, seed))
        pairs = F.arrays_zip(
            F.array(*[F.lit(f) for f in self.features]).alias("feature"),
            F.col("__values").alias("contribution"))
        return (
            sampled.select(F.inline(pairs).alias("feature", "contribution"))
            .groupBy("feature").agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))
            .orderBy(F.desc("mean_abs_contribution"), "feature")
        )


def top_drivers(contributions: Column | str, k: int = 15, reverse: bool = False) -> Column:
    """The k strongest contributions of a row; ``reverse`` puts the strongest last."""
    strongest = F.slice(contributions, 1, k)
    return F.reverse(strongest) if reverse else strongest
