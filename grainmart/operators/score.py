"""Batch scoring and keyed lookups."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainmart.functions.scalar import outcome_label, risk_tier

SPANS = 64  # ranges of ids that a lookup hands to the scan


def lookup(mart: DataFrame, id_col: str, ids: Sequence) -> DataFrame:
    """The rows of a short list of ids; the filter reaches the Parquet scan."""
    return mart.filter(F.col(id_col).isin(*ids))


def lookup_requests(mart: DataFrame, requests: DataFrame, id_col: str) -> DataFrame:
    """One row per requested id with its mart columns and whether it was found.

    Requests may be many: repeated ids are merged and Spark picks the joins from the real sizes.
    A semi join comes first, so that few requests can be broadcast to the mart instead of
    shuffling it; the left join then meets only the rows found. Ranges around the ids asked for reach
    the scan, which skips the files and row groups of a mart sorted by id that hold none of them.
    """
    wanted = requests.select(id_col).distinct()
    near = mart.filter(within_spans(id_col, id_spans(wanted, id_col))) if _whole(mart, wanted, id_col) else mart
    found = near.join(wanted, id_col, "left_semi").withColumn("found", F.lit(True))
    return wanted.join(found, id_col, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def _whole(mart: DataFrame, requests: DataFrame, id_col: str) -> bool:
    return all(isinstance(df.schema[id_col].dataType, T.IntegralType) for df in (mart, requests))


def id_spans(requests: DataFrame, id_col: str, spans: int = SPANS) -> list[tuple[int, int]]:
    """At most so many ranges that hold all non-null ids, cut where slices of the id range hold none.

    The range from the least to the largest id is cut into equal slices and each slice gives the least
    and largest id in it: two passes of partial aggregates over the requests, whose number has no bound.
    """
    low, high = requests.agg(F.min(id_col).cast("bigint"), F.max(id_col).cast("bigint")).first()
    if low is None:
        return []
    width = -(-(high - low + 1) // spans)
    at = F.col(id_col).cast("decimal(38,0)") - F.lit(low).cast("decimal(38,0)")
    place = F.least(F.floor(at / F.lit(width).cast("decimal(38,0)")).cast("int"), F.lit(spans - 1))
    ends = (requests.filter(F.col(id_col).isNotNull()).groupBy(place.alias("slice"))
            .agg(F.min(id_col).alias("low"), F.max(id_col).alias("high")))
    return sorted((r["low"], r["high"]) for r in ends.collect())


def within_spans(id_col: str, spans: Sequence[tuple[int, int]]) -> Column:
    """Whether an id lies in one of the ranges; false without any."""
    return reduce(Column.__or__, (F.col(id_col).between(a, b) for a, b in spans), F.lit(False))


def absent_ids(mart: DataFrame, requests: DataFrame, id_col: str) -> DataFrame:
    return requests.select(id_col).distinct().join(mart.select(id_col), id_col, "left_anti")


def require_present(mart: DataFrame, id_col: str, ids: Sequence) -> DataFrame:
    """As ``lookup``, but an unknown id is an error."""
    rows = lookup(mart, id_col, ids)
    known = {r[0] for r in rows.select(id_col).distinct().collect()}
    unknown = [i for i in ids if i not in known]
    if unknown:
        raise ValueError(f"{id_col} not found in the mart: {unknown}")
    return rows


def score_records(
    scored: DataFrame, id_col: str, split_col: str, label_col: str, *keep: str
) -> DataFrame:
    """Id, split flag, nullable actual label, probability, risk tier and outcome text."""
    return scored.select(
        id_col, split_col, F.col(label_col).cast("int").alias("actual_target"), "probability",
        risk_tier("probability").alias("risk_tier"),
        outcome_label(label_col).alias("actual_outcome"), *keep,
    )
