"""Row-level cleaning expressions. All are plain Columns, so they stay in generated code."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from grainmart.config import LOW_RISK_BELOW, MEDIUM_RISK_BELOW

# The "not applicable" marker in day offsets, and the days in a year.
NOT_APPLICABLE_DAYS = 365243
DAYS_PER_YEAR = 365.25

ColumnLike = Column | str


def as_column(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


def guarded_ratio(numerator: ColumnLike, denominator: ColumnLike) -> Column:
    """numerator / denominator where the denominator is positive, else null."""
    den = as_column(denominator).cast("double")
    return F.when(den > 0, as_column(numerator).cast("double") / den)


def without_sentinel(value: ColumnLike, sentinel: int = NOT_APPLICABLE_DAYS) -> Column:
    """The value, or null where it is the sentinel."""
    return F.nullif(as_column(value), F.lit(sentinel))


def is_sentinel(value: ColumnLike, sentinel: int = NOT_APPLICABLE_DAYS) -> Column:
    """True at the sentinel; false elsewhere, null included."""
    return as_column(value).eqNullSafe(F.lit(sentinel))


def days_since(offset: ColumnLike) -> Column:
    """A negative day offset as a positive number of days."""
    return -as_column(offset)


def years_since(offset: ColumnLike) -> Column:
    """A negative day offset as a positive number of years, in double arithmetic."""
    return -as_column(offset).cast("double") / F.lit(DAYS_PER_YEAR)


def offset_difference(later: ColumnLike, earlier: ColumnLike) -> Column:
    return as_column(later) - as_column(earlier)


def strict_sum(values: Iterable[ColumnLike]) -> Column:
    """Sum that is null as soon as one addend is null."""
    return reduce(add, [as_column(v) for v in values])


def zero_filled_mean(values: Sequence[ColumnLike]) -> Column:
    """Mean over all columns, a null counting as zero."""
    filled = [F.coalesce(as_column(v).cast("double"), F.lit(0.0)) for v in values]
    return reduce(add, filled) / F.lit(float(len(filled)))


def missing_share(values: Sequence[ColumnLike]) -> Column:
    """Share of the columns that are null in this row."""
    flags = [as_column(v).isNull().cast("double") for v in values]
    return reduce(add, flags) / F.lit(float(len(flags)))


def is_one_of(value: ColumnLike, members: Sequence) -> Column:
    """Membership as a boolean that is never null."""
    return F.coalesce(as_column(value).isin(*members), F.lit(False))


def digit_or_null(value: ColumnLike) -> Column:
    """A single-digit string as an integer, anything else as null."""
    text = as_column(value)
    return F.when(text.rlike("^[0-9]$"), text.try_cast("int"))


def typed_null(type_name: str) -> Column:
    return F.lit(None).cast(type_name)


def normalise_nan(value: ColumnLike) -> Column:
    """NaN as null, so that only one kind of missing value exists downstream."""
    return F.nanvl(as_column(value), typed_null("double"))


def risk_tier(
    probability: ColumnLike, low: float = LOW_RISK_BELOW, medium: float = MEDIUM_RISK_BELOW
) -> Column:
    p = as_column(probability)
    return F.when(p < low, "Low").when(p < medium, "Medium").when(p.isNotNull(), "High")


def outcome_label(label: ColumnLike) -> Column:
    y = as_column(label)
    return F.when(y == 1, "Default").when(y == 0, "No default").otherwise("Unknown (scoring set)")


def rendered(value: ColumnLike) -> Column:
    """A value of any type as text for a contribution record; null stays null."""
    return as_column(value).cast("string")
