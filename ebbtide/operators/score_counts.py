"""Counts of the prediction log that are kept up to date instead of counted again.

The counts have a row per model version, day, risk level and ten-percent bin. Counts of two parts of
a log add up to those of both, so a new part costs its own rows and the small table, never the log.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.operators.reports import bin_of

KEYS = ["model_version", "day", "risk_level", "bin"]
SCORE_COUNTS = T.StructType([
    T.StructField("model_version", T.StringType()),
    T.StructField("day", T.DateType()),
    T.StructField("risk_level", T.StringType()),
    T.StructField("bin", T.IntegerType()),
    T.StructField("predictions", T.LongType()),
    T.StructField("keyed", T.LongType()),
])


def counts_of(log: DataFrame) -> DataFrame:
    """Counts of a part of the log: rows, and rows that have an id."""
    keyed = log.withColumn("bin", bin_of(F.col("churn_probability")))
    return keyed.groupBy(KEYS).agg(F.count("*").alias("predictions"), F.count("prediction_id").alias("keyed"))


def merged(counts: DataFrame, more: DataFrame) -> DataFrame:
    """Counts of both parts."""
    both = counts.select(SCORE_COUNTS.fieldNames()).unionByName(more.select(SCORE_COUNTS.fieldNames()))
    return both.groupBy(KEYS).agg(*[F.sum(c).alias(c) for c in ("predictions", "keyed")])


def between(counts: DataFrame, first_day: date | None = None, last_day: date | None = None) -> DataFrame:
    """Counts of some days; an open end lets everything through."""
    if first_day:
        counts = counts.where(F.col("day") >= F.lit(first_day))
    if last_day:
        counts = counts.where(F.col("day") <= F.lit(last_day))
    return counts


def high_risk_count(counts: DataFrame) -> DataFrame:
    high = F.sum(F.when(F.col("risk_level") == "High", F.col("keyed")))
    return counts.agg(F.coalesce(high, F.lit(0)).alias("high_risk_customers"))


def risk_distribution(counts: DataFrame) -> DataFrame:
    return counts.groupBy("risk_level").agg(F.sum("predictions").alias("predictions"))


def probability_histogram(counts: DataFrame) -> DataFrame:
    return counts.groupBy("bin").agg(F.sum("predictions").alias("predictions"))
