"""Monotone fit by pool-adjacent-violators blocks that merge in a reduction tree over score ranges."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainmart.sources.scratch import stored

FAN = 16  # neighbouring ranges merged in one step
OUT_ROWS = 10_000
_SCHEMA = "part bigint, lo double, hi double, total double, weight double"

# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _pooled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The blocks of each part, given in score order, with neighbours that fall pooled into one."""
    part, stack = None, []

    def blocks(rows: list) -> Iterator[pd.DataFrame]:
        for at in range(0, len(rows), OUT_ROWS):
            yield pd.DataFrame([(part, *row) for row in rows[at:at + OUT_ROWS]],
                               columns=["part", "lo", "hi", "total", "weight"])

    for batch in batches:
        for at, lo, hi, total, weight in batch[["part", "lo", "hi", "total", "weight"]].itertuples(index=False, name=None):
            if at != part:
                yield from blocks(stack)
                part, stack = at, []
            while stack and stack[-1][2] * weight >= total * stack[-1][3]:
                low, _, t, w = stack.pop()
                lo, total, weight = low, t + total, w + weight
            stack.append((lo, hi, total, weight))
    yield from blocks(stack)


def monotone_steps(scored: DataFrame, score: str, label: str, ranges: int | None = None) -> DataFrame:
    """(lo, hi, value, weight): the steps of the non-decreasing fit of the label on the score, of non-null rows.

    Rows merge per score; scores are range partitioned; each range pools its violators, and FAN
    neighbouring ranges at a time are pooled again until one range is left. Pooled blocks stay pooled
    at every level, so the result is that of one pass over all scores. A task holds the blocks it
    keeps, of the last step no more than the fitted steps.
    """
    merged = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull()) \
        .groupBy(F.col(score).cast("double").alias("lo")).agg(
            F.sum(F.col(label).cast("double")).alias("total"), F.count(F.lit(1)).cast("double").alias("weight"))
    ranged = merged.repartitionByRange(*([ranges] if ranges else []), "lo")
    level = stored(ranged.select(F.spark_partition_id().cast("long").alias("part"), "lo", F.col("lo").alias("hi"),
                                 "total", "weight"), "isotonic-scores")
    parts = (level.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        level = stored(level.repartition("part").sortWithinPartitions("part", "lo").mapInPandas(_pooled, _SCHEMA),
                       "isotonic-blocks")
        if parts == 1:
            return level.select("lo", "hi", (F.col("total") / F.col("weight")).alias("value"), "weight")
        level, parts = level.withColumn("part", F.floor(F.col("part") / FAN)), -(-parts // FAN)
