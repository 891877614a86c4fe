"""Joins whose small side is broadcast only after its size is known."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20  # of the whole broadcast side


def row_bytes(df: DataFrame) -> int:
    """About what a row takes in memory, by its types."""
    return 16 + sum(48 if f.dataType.typeName() == "string" else 8 for f in df.schema)


def fits(df: DataFrame, most_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a broadcast of df stays within the bytes. Rows are counted where they lie: every task
    sends one number."""
    return df.count() * row_bytes(df) <= most_bytes


def join_checked(big: DataFrame, small: DataFrame, on: list[str], how: str, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join without shuffling the big side when the small one is proven small.

    Pass a persisted `small`: it is counted first and read again by the join. When it is
    too large the join is left to the planner, whose adaptive skew handling splits hot keys.
    """
    return big.join(F.broadcast(small) if fits(small, most_bytes) else small, on, how)


def with_segment_summary(fact: DataFrame, summary: DataFrame, key: str, prefix: str) -> DataFrame:
    """Relate each fact row to the summary row of its segment (one to many).

    A summary has a row per segment, far fewer than the fact; the planner decides by its bytes.
    """
    renamed = summary.select(key, *[F.col(c).alias(f"{prefix}{c}") for c in summary.columns if c != key])
    return fact.join(renamed, [key], "left")
