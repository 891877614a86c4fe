"""Band labels and their display order as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band labels with their exclusive upper edge; the last band takes the
# rest, which includes a missing value.
AGE_BANDS = [("<30", 30), ("30-45", 45), ("45-60", 60), ("60+", None)]
CREDIT_BANDS = [("<400", 400), ("400-500", 500), ("500-600", 600), ("600-700", 700), ("700-800", 800), ("800+", None)]
CREDIT_QUALITY = ["Very Poor", "Poor", "Fair", "Good", "Very Good", "Excellent"]

# Percent below LOW is low risk, up to and including HIGH medium.
RISK_LOW, RISK_HIGH = 30.0, 60.0
RISK_BADGES = {"Low": "success", "Medium": "warning", "High": "danger"}


def _by_upper_edge(value: Column, bands: list[tuple[object, int | None]]) -> Column:
    *bounded, (rest, _) = bands
    branches = None
    for label, edge in bounded:
        hit = value < edge
        branches = F.when(hit, F.lit(label)) if branches is None else branches.when(hit, F.lit(label))
    return branches.otherwise(F.lit(rest))


def age_group(age: Column | str = "age") -> Column:
    return _by_upper_edge(F.col(age) if isinstance(age, str) else age, AGE_BANDS)


def credit_band_labels(with_quality: bool = False) -> list[str]:
    if not with_quality:
        return [label for label, _ in CREDIT_BANDS]
    return [f"{label} ({quality})" for (label, _), quality in zip(CREDIT_BANDS, CREDIT_QUALITY)]


def credit_band(score: Column | str = "credit_score", with_quality: bool = False) -> Column:
    labels = credit_band_labels(with_quality)
    edges = [edge for _, edge in CREDIT_BANDS]
    return _by_upper_edge(F.col(score) if isinstance(score, str) else score, list(zip(labels, edges)))


def position_in(label: Column | str, ordered: list[str]) -> Column:
    """1-based place of a label in its display order, for sorting."""
    return F.array_position(F.array(*[F.lit(x) for x in ordered]), F.col(label) if isinstance(label, str) else label)


def percent(probability: Column) -> Column:
    return F.round(probability * 100, 2)


def risk_level(pct: Column) -> Column:
    """Risk of a churn probability given in percent; a missing one has no risk level."""
    return F.when(pct.isNull(), F.lit(None)).when(pct < RISK_LOW, "Low").when(pct <= RISK_HIGH, "Medium").otherwise("High")


def risk_badge(risk: Column) -> Column:
    return (
        F.when(risk == "High", RISK_BADGES["High"])
        .when(risk == "Medium", RISK_BADGES["Medium"])
        .when(risk == "Low", RISK_BADGES["Low"])
    )


def gender_code(gender: Column | str = "gender") -> Column:
    g = F.col(gender) if isinstance(gender, str) else gender
    return F.when(g == "Male", 0).when(g == "Female", 1)
