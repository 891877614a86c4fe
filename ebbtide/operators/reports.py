"""Churn reports, KPIs and BI measures: one grouped aggregate each, few rows out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions import bands, formats
from ebbtide.schemas import SCORING_COLUMNS


def rows() -> Column:
    return F.count("*")


def churned() -> Column:
    return F.sum("exited")


def rate_pct(mean: Column) -> Column:
    return F.round(mean * 100, 2)


@dataclass(frozen=True)
class Report:
    """A churn report: its segment column, the key it groups by and the order of its rows.

    Key and order are functions since a column needs a running session.
    """

    segment: str
    key: Callable[[], Column]
    order: Callable[[], list[Column]] = list

    def _finish(self, grouped: DataFrame) -> DataFrame:
        order = self.order()
        return grouped.orderBy(*order) if order else grouped

    def of(self, customers: DataFrame) -> DataFrame:
        return self._finish(
            customers.groupBy(self.key().alias(self.segment)).agg(
                rows().alias("total_customers"),
                churned().alias("churned_customers"),
                rate_pct(F.avg("exited")).alias("churn_rate_pct"),
            )
        )

    def of_cube(self, cube: DataFrame) -> DataFrame:
        """The same report rolled up from a segment cube."""
        return self._finish(
            cube.groupBy(self.key().alias(self.segment)).agg(
                F.sum("n").alias("total_customers"),
                F.sum("churned").alias("churned_customers"),
                rate_pct(F.try_divide(F.sum("churned"), F.sum("n_exited"))).alias("churn_rate_pct"),
            )
        )


def _plain(column: str) -> Callable[[], Column]:
    return lambda: F.col(column)


def _ascending(column: str) -> Callable[[], list[Column]]:
    return lambda: [F.asc(column)]


def _in_band_order(column: str, labels: list[str]) -> Callable[[], list[Column]]:
    return lambda: [bands.position_in(column, labels)]


AGE_LABELS = [label for label, _ in bands.AGE_BANDS]
QUALITY_LABELS = bands.credit_band_labels(with_quality=True)

CHURN_BY_GEOGRAPHY = Report(
    "geography", _plain("geography"), lambda: [F.desc("churn_rate_pct"), F.asc("geography")]
)
CHURN_BY_AGE_GROUP = Report("age_group", bands.age_group, _in_band_order("age_group", AGE_LABELS))
CHURN_BY_PRODUCTS = Report("num_products", _plain("num_products"), _ascending("num_products"))
CHURN_BY_CREDIT_BAND = Report(
    "credit_score_range",
    lambda: bands.credit_band(with_quality=True),
    _in_band_order("credit_score_range", QUALITY_LABELS),
)
CHURN_BY_ACTIVE = Report("is_active_member", _plain("is_active_member"))
CHURN_BY_TENURE = Report("tenure_years", _plain("tenure"), _ascending("tenure_years"))
CHURN_BY_GENDER = Report("gender", _plain("gender"))
GEOGRAPHY_SUMMARY = Report("geography", _plain("geography"))
AGE_SUMMARY = Report("age_group", bands.age_group)
PRODUCT_SUMMARY = Report("num_products", _plain("num_products"))
CREDIT_SCORE_SUMMARY = Report("credit_score_range", bands.credit_band)


def balance_by_exited(customers: DataFrame) -> DataFrame:
    return customers.groupBy("exited").agg(
        rows().alias("total_customers"), F.round(F.avg("balance"), 2).alias("avg_balance")
    )


def balance_by_exited_of_cube(cube: DataFrame) -> DataFrame:
    return cube.groupBy("exited").agg(
        F.sum("n").alias("total_customers"),
        F.round(F.try_divide(F.sum("sum_balance"), F.sum("n_balance")), 2).alias("avg_balance"),
    )


def segment_cube(customers: DataFrame) -> DataFrame:
    """One pass over the customers that all segment reports can be rolled up from.

    A cell keeps a credit score inside its band (the lowest score the band holds), so the
    band expressions of the reports work on cells as they do on rows.
    """
    edges = [edge for _, edge in bands.CREDIT_BANDS if edge]
    score = F.col("credit_score")
    floor_score = F.lit(0)
    for edge in edges:
        floor_score = F.when(score < edge, floor_score).otherwise(F.lit(edge))
    floor_score = F.when(score.isNotNull(), floor_score)
    floor_age = F.lit(0)
    for edge in [edge for _, edge in bands.AGE_BANDS if edge]:
        floor_age = F.when(F.col("age") < edge, floor_age).otherwise(F.lit(edge))
    floor_age = F.when(F.col("age").isNotNull(), floor_age)
    keys = [
        F.col("geography"),
        F.col("gender"),
        floor_age.alias("age"),
        F.col("num_products"),
        floor_score.alias("credit_score"),
        F.col("is_active_member"),
        F.col("tenure"),
        F.col("exited"),
    ]
    return customers.groupBy(*keys).agg(
        rows().alias("n"),
        F.count("exited").alias("n_exited"),
        churned().alias("churned"),
        F.count("balance").alias("n_balance"),
        F.sum("balance").alias("sum_balance"),
        F.count(score).alias("n_credit_score"),
        F.sum(score).alias("sum_credit_score"),
    )


# --- dashboard -----------------------------------------------------------------------


def kpis(customers: DataFrame) -> DataFrame:
    return customers.agg(
        rows().alias("total"),
        F.round(F.avg("exited") * 100, 6).alias("churn_rate"),
        F.round(F.avg("balance"), 6).alias("avg_balance"),
        F.round(F.avg("credit_score"), 6).alias("avg_credit_score"),
    )


def kpi_cards(customers: DataFrame) -> DataFrame:
    k = kpis(customers)
    return k.select(
        formats.grouped_integer(F.col("total")).alias("total_customers"),
        formats.percent_text(F.col("churn_rate")).alias("churn_rate"),
        formats.rupees(F.col("avg_balance")).alias("avg_balance"),
        formats.fixed(F.col("avg_credit_score"), 1).alias("avg_credit_score"),
    )


def dashboard_geography(customers: DataFrame) -> DataFrame:
    return customers.groupBy("geography").agg(
        rows().alias("count"), churned().alias("churned"), rate_pct(F.avg("exited")).alias("rate")
    )


def _with_retained(counts: DataFrame) -> DataFrame:
    return counts.withColumns({
        "retained": F.col("count") - F.col("churned"),
        "rate": rate_pct(F.try_divide(F.col("churned"), F.col("count"))),
    })


def dashboard_age(customers: DataFrame) -> DataFrame:
    counts = customers.groupBy(bands.age_group().alias("age_group")).agg(rows().alias("count"), churned().alias("churned"))
    return _with_retained(counts).orderBy(bands.position_in("age_group", AGE_LABELS))


def dashboard_products(customers: DataFrame) -> DataFrame:
    counts = customers.groupBy("num_products").agg(rows().alias("count"), churned().alias("churned"))
    labelled = counts.withColumn("num_products", F.col("num_products").cast("string"))
    return _with_retained(labelled).orderBy("num_products")


def credit_band_by_exited(customers: DataFrame) -> DataFrame:
    """Retained and churned per credit band; a band without customers shows zeros."""
    band, left = bands.credit_band(), F.col("exited") != 0
    lines = []
    for label in bands.credit_band_labels():
        retained, churned_ = F.count_if((band == label) & ~left), F.count_if((band == label) & left)
        lines.append(F.struct(F.lit(label).alias("credit_range"), retained.alias("retained"), churned_.alias("churned")))
    return customers.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def exited_distribution(customers: DataFrame) -> DataFrame:
    counts = customers.groupBy("exited").agg(rows().alias("customers"))
    total = F.sum("customers").over(Window.partitionBy(F.lit(1)))  # of the two or three counts
    return counts.withColumn("pct", F.round(F.col("customers") * 100.0 / total, 2))


def geography_rate_raw(customers: DataFrame) -> DataFrame:
    return customers.groupBy("geography").agg(
        F.count("exited").alias("count"), churned().alias("sum"), F.avg("exited").alias("rate")
    )


# --- BI measures -----------------------------------------------------------------------


def _share(condition: Column) -> Column:
    """Share of the keyed rows that meet the condition, 0 when there are none."""
    keyed = F.col("customer_id").isNotNull()
    return F.coalesce(F.try_divide(F.count_if(condition & keyed), F.count("customer_id")), F.lit(0.0))


def bi_measures(customers: DataFrame) -> DataFrame:
    churn = _share(F.col("exited") == 1)
    keyed = F.col("customer_id").isNotNull()
    return customers.agg(
        F.count("customer_id").alias("total_customers"),
        F.count_if(keyed & (F.col("exited") == 1)).alias("churned_customers"),
        F.count_if(keyed & (F.col("exited") == 0)).alias("retained_customers"),
        F.round(churn, 6).alias("churn_rate"),
        F.round(1 - churn, 6).alias("retention_rate"),
        F.round(_share(F.col("is_active_member") == 1), 6).alias("active_rate"),
        F.round(F.avg("balance"), 2).alias("avg_balance"),
        F.round(F.avg("credit_score"), 6).alias("avg_credit_score"),
    )


def sliced(
    customers: DataFrame,
    geography: list[str] | None = None,
    gender: list[str] | None = None,
    age_group: list[str] | None = None,
) -> DataFrame:
    """Customers left by the slicers; an empty slicer lets everything through."""
    for column, wanted in ((F.col("geography"), geography), (F.col("gender"), gender), (bands.age_group(), age_group)):
        if wanted:
            customers = customers.where(column.isin(wanted))
    return customers


def sliced_predictions(
    predictions: DataFrame,
    risk_level: list[str] | None = None,
    geography: list[str] | None = None,
    first_day: date | None = None,
    last_day: date | None = None,
    timestamp: str = "ts",
) -> DataFrame:
    if risk_level:
        predictions = predictions.where(F.col("risk_level").isin(risk_level))
    if geography:
        predictions = predictions.where(F.col("geography").isin(geography))
    day = F.to_date(timestamp)
    if first_day:
        predictions = predictions.where(day >= F.lit(first_day))
    if last_day:
        predictions = predictions.where(day <= F.lit(last_day))
    return predictions


def drill_through(customers: DataFrame, **segment: object) -> DataFrame:
    """Detail rows of one segment, given as column=value or age_group= / credit_band=."""
    derived = {"age_group": bands.age_group(), "credit_band": bands.credit_band()}
    for key, value in segment.items():
        customers = customers.where(derived.get(key, F.col(key)) == F.lit(value))
    return customers


def customers_by_geography(customers: DataFrame) -> DataFrame:
    return customers.groupBy("geography").agg(F.count("customer_id").alias("total_customers"))


# --- prediction log ----------------------------------------------------------------------

HISTORY_COLUMNS = [*SCORING_COLUMNS, "churn_probability", "risk_level"]


def prediction_history(predictions: DataFrame, timestamp: str = "ts") -> DataFrame:
    return predictions.select("prediction_id", timestamp, *HISTORY_COLUMNS)


def high_risk(predictions: DataFrame) -> DataFrame:
    return predictions.where(F.col("risk_level") == "High")


def high_risk_count(predictions: DataFrame) -> DataFrame:
    keyed_high = F.when(F.col("risk_level") == "High", F.col("prediction_id"))
    return predictions.agg(F.count(keyed_high).alias("high_risk_customers"))


def risk_distribution(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("risk_level").agg(rows().alias("predictions"))


def bin_of(percent: Column) -> Column:
    """Number of the ten percent a probability lies in; 100 % belongs to the last."""
    return F.least(F.floor(percent / 10), F.lit(9)).cast("int")


def probability_histogram(predictions: DataFrame) -> DataFrame:
    """Counts per ten percent."""
    return predictions.groupBy(bin_of(F.col("churn_probability")).alias("bin")).agg(rows().alias("predictions"))
