"""Drift of recent scores against the observed churn rate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.formats import percent_text

# Fixed values of the drift check.
RECENT_ROWS = 100
MIN_ROWS = 10
THRESHOLD = 0.05
FALLBACK_RATE = 0.2037


def latest(customers: DataFrame, n: int = RECENT_ROWS, key: str = "customer_id") -> DataFrame:
    """The rows with the highest keys: a top-k per task, then of those."""
    return customers.orderBy(F.desc(key)).limit(n)


def score_drift(recent: DataFrame, customers: DataFrame, percent_column: str = "churn_probability") -> DataFrame:
    """Compare the mean score of recent rows (in percent) with the churn rate of all customers."""
    observed = customers.agg(F.avg("exited").alias("rate")).scalar()
    baseline = F.coalesce(F.nullif(observed, F.lit(0.0)), F.lit(FALLBACK_RATE))
    one = recent.agg(F.count("*").alias("recent_rows"), F.avg(F.col(percent_column) / 100).alias("mean"))
    enough = F.col("recent_rows") >= MIN_ROWS
    one = one.withColumns({
        "recent_mean": F.when(enough, F.col("mean")).otherwise(0.0),
        "baseline_rate": baseline,
        "drift": F.when(enough, F.abs(F.col("mean") - baseline)).otherwise(0.0),
    })
    return one.select(
        "recent_rows",
        F.round("recent_mean", 6).alias("recent_mean"),
        F.round("baseline_rate", 6).alias("baseline_rate"),
        F.round("drift", 6).alias("drift"),
        (F.col("drift") > THRESHOLD).alias("drift_warning"),
        percent_text(F.col("drift") * 100).alias("drift_pct"),
    )
