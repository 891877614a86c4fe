"""Range and domain rules of customer records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ebbtide.schemas import DOMAINS, RANGES


def out_of_range(column: str, value: Column | None = None) -> Column:
    """True where the value is outside its range; NULL where it is missing."""
    low, high = RANGES[column]
    value = F.col(column) if value is None else value
    bad = value < low
    return bad if high is None else bad | (value > high)


def surely_invalid(column: str, value: Column | None = None) -> Column:
    """Invalid for certain: a missing value is kept (the cleaning rule)."""
    return F.coalesce(out_of_range(column, value), F.lit(False))


def surely_valid() -> Column:
    """All ranges hold for certain: a missing value is dropped (the ingest rule)."""
    valid = F.lit(True)
    for column in RANGES:
        valid = valid & F.coalesce(~out_of_range(column), F.lit(False))
    return valid


def violations() -> Column:
    """Names of the columns that break their domain; NULL breaks none."""
    broken = [
        F.when(F.col(column).isNotNull() & ~F.col(column).isin(allowed), F.lit(column))
        for column, allowed in DOMAINS.items()
    ]
    return F.array_compact(F.array(*broken))


def any_violation() -> Column:
    broken = F.lit(False)
    for column, allowed in DOMAINS.items():
        broken = broken | (F.col(column).isNotNull() & ~F.col(column).isin(allowed))
    return broken
