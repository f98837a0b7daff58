"""Declarative rollups from a child grain to a key, and the mart that joins them to a spine."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmart.functions.measures import Measure
from grainmart.functions.scalar import typed_null
from grainmart.functions.sqltext import ident


@dataclass(frozen=True)
class Rollup:
    """One row per key. The partial aggregates run before the shuffle, so a key with very
    many children sends one buffer per task, not its rows."""

    key: str
    measures: tuple[Measure, ...]
    presence_flag: str | None = None

    def apply(self, child: DataFrame) -> DataFrame:
        return child.groupBy(self.key).agg(*[m.column() for m in self.measures])

    @property
    def names(self) -> list[str]:
        return [m.name for m in self.measures]


def enrich(child: DataFrame, rolled: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Child rows with measures of their own history: one match per row at most, none lost."""
    return child.join(rolled.select(key, *columns), key, "left")


def feature_mart(spine: DataFrame, sources: Sequence[tuple[Rollup, DataFrame]], key: str) -> DataFrame:
    """The spine and, per source, its measures and presence flag.

    ``sources`` pairs a rollup with its already rolled-up frame. Each frame is unique on the
    key and hash partitioned by it, so the joins reuse that partitioning and the spine's rows
    are neither lost nor multiplied.
    """
    joined, projection = spine, [ident(c) for c in spine.columns]
    for rollup, rolled in sources:
        marker = f"__present_{rollup.measures[0].name}"
        side = rolled.selectExpr(
            ident(key), *[ident(n) for n in rollup.names], f"true AS {ident(marker)}")
        joined = joined.join(side, key, "left")
        for m in rollup.measures:
            name = ident(m.name)
            projection.append(f"coalesce({name}, 0) AS {name}" if m.zero_default else name)
        if rollup.presence_flag:
            projection.append(f"coalesce({ident(marker)}, false) AS {ident(rollup.presence_flag)}")
    return joined.selectExpr(*projection)


def union_pools(
    labelled: DataFrame, unlabelled: DataFrame, label: str, split_flag: str, label_type: str = "long"
) -> DataFrame:
    """Both pools by column name; the pool without labels gets a typed null."""
    return labelled.withColumn(split_flag, F.lit(True)).unionByName(
        unlabelled.withColumn(label, typed_null(label_type)).withColumn(split_flag, F.lit(False))
    )


def split_pools(mart: DataFrame, split_flag: str) -> tuple[DataFrame, DataFrame]:
    """Training pool and scoring pool."""
    return mart.filter(F.col(split_flag)), mart.filter(~F.col(split_flag))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
