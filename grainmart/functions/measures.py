"""Measures of a rollup. Each is an aggregate expression with the name of its output column."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from grainmart.functions.sqltext import ident


@dataclass(frozen=True)
class Measure:
    """``zero_default``: an entity without any history gets 0 rather than null."""

    name: str
    sql: str
    zero_default: bool = False

    def column(self) -> Column:
        return F.expr(f"{self.sql} AS {ident(self.name)}")

    def or_zero(self) -> "Measure":
        return replace(self, zero_default=True)


def row_count(name: str) -> Measure:
    return Measure(name, "count(1)")


def distinct_count(name: str, column: str) -> Measure:
    return Measure(name, f"count(DISTINCT {column})")


def count_where(name: str, condition: str) -> Measure:
    """Rows where the condition is true; null and false both count as zero."""
    return Measure(name, f"count_if({condition})")


def rate_where(name: str, condition: str) -> Measure:
    """Share of all rows where the condition is true; a null condition stays in the denominator."""
    return Measure(name, f"avg(CASE WHEN {condition} THEN 1D ELSE 0D END)")


def average(name: str, column: str) -> Measure:
    return Measure(name, f"avg({column})")


def minimum(name: str, column: str) -> Measure:
    return Measure(name, f"min({column})")


def maximum(name: str, column: str) -> Measure:
    return Measure(name, f"max({column})")


def total(name: str, column: str) -> Measure:
    """Sum over non-null values; null when there are none."""
    return Measure(name, f"sum({column})")


def ratio_of_totals(name: str, numerator: str, denominator: str) -> Measure:
    """Sum over sum, null unless the denominator's sum is positive."""
    return Measure(
        name,
        f"CASE WHEN sum({denominator}) > 0 "
        f"THEN CAST(sum({numerator}) AS DOUBLE) / CAST(sum({denominator}) AS DOUBLE) END",
    )
