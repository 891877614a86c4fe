"""Display formats. Values are rounded before they are formatted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def grouped_integer(value: Column) -> Column:
    return F.format_number(value, 0)


def fixed(value: Column, digits: int) -> Column:
    """No thousands separators."""
    return F.format_string(f"%.{digits}f", F.round(value.cast("double"), digits))


def percent_text(value: Column, digits: int = 2) -> Column:
    return F.concat(fixed(value, digits), F.lit("%"))


def rupees(value: Column, digits: int = 2) -> Column:
    return F.concat(F.lit("₹"), F.format_number(F.round(value, digits), digits))
