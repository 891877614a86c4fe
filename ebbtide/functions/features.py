"""Engineered customer features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENGINEERED = [
    "balance_to_salary_ratio",
    "balance_per_product",
    "is_high_product_risk",
    "is_inactive_and_older",
    "is_active_and_young",
]


def _flag(condition: Column) -> Column:
    """1 where the condition is true, 0 where it is false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def engineered_columns() -> dict[str, Column]:
    balance, products = F.col("balance"), F.col("num_products")
    age, active = F.col("age"), F.col("is_active_member")
    return {
        # a zero divisor gives NULL, which the imputer fills
        "balance_to_salary_ratio": F.try_divide(balance, F.col("estimated_salary") + 1.0),
        "balance_per_product": F.try_divide(balance, products),
        "is_high_product_risk": _flag(products >= 3),
        "is_inactive_and_older": _flag((age >= 45) & (active == 0)),
        "is_active_and_young": _flag((age < 35) & (active == 1)),
    }


def add_engineered_features(df: DataFrame) -> DataFrame:
    return df.withColumns(engineered_columns())
