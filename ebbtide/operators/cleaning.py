"""Cleaning of the raw customer file: localise, scale, fill, dedup, validate, reshape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.functions.checks import surely_invalid, surely_valid
from ebbtide.operators.ordering import exact_medians
from ebbtide.schemas import CUSTOMERS, MONEY_SCALE, RAW_TO_CUSTOMER, STATE_OF_COUNTRY

# cleaning looks at the ranges in this order; a row counts for the first one it breaks
RULES = {"age": "Age", "balance": "Balance", "credit_score": "CreditScore"}


def localize_geography(raw: DataFrame) -> DataFrame:
    """Country to state; any other country becomes NULL."""
    country = F.col("Geography")
    state = F.lit(None).cast("string")
    for name, local in STATE_OF_COUNTRY.items():
        state = F.when(country == name, local).otherwise(state)
    return raw.withColumn("Geography", state)


def scale_money(raw: DataFrame) -> DataFrame:
    return raw.withColumns({c: F.col(c) * MONEY_SCALE for c in ("Balance", "EstimatedSalary")})


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN sorts above every number, so no upper range check would mean what it says."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in floats})


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column, from one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], df.columns, "column_name", "null_count")


def _is_numeric(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def modes(df: DataFrame, columns: list[str]) -> dict[str, str | None]:
    """Most frequent non-null value of each column, the smallest on ties.

    Counted by value first, so a value that fills a third of the rows is one row per task
    in the shuffle and a column of many values never sits in one buffer.
    """
    if not columns:
        return {}
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = df.select(F.explode(pairs).alias("x")).select("x.*").where("value IS NOT NULL").groupBy("column", "value").count()
    best = counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("count"), "value")).alias("value"))
    top = {r["column"]: r["value"] for r in best.collect()}  # a row per column
    return {c: top.get(c) for c in columns}


def fit_fill_values(df: DataFrame) -> dict[str, object]:
    """Median of each numeric and mode of each other column that has NULLs."""
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]).first()
    missing = [f for f in df.schema if nulls[f.name]]
    numeric = [f.name for f in missing if _is_numeric(f)]
    fills: dict[str, object] = exact_medians(df, numeric) if numeric else {}
    fills.update(modes(df, [f.name for f in missing if not _is_numeric(f)]))
    return {c: v for c, v in fills.items() if v is not None}


def fill_missing(df: DataFrame, fills: dict[str, object] | None = None) -> DataFrame:
    """Fill NULLs over all rows, before any of them is dropped.

    A filled numeric column becomes a double, for its median may lie between two values.
    """
    fills = fit_fill_values(df) if fills is None else fills

    def filled(column: str) -> Column:
        value = F.col(column)
        return F.coalesce(value.cast("double") if isinstance(fills[column], float) else value, F.lit(fills[column]))

    return df.withColumns({c: filled(c) for c in fills})


def keep_first(df: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """First row per key. The rank filter is applied in every task before the shuffle
    (WindowGroupLimit), so a hot key sends one row per task."""
    keys = [key] if isinstance(key, str) else key
    first = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("_place", F.row_number().over(first)).where("_place = 1").drop("_place")


def duplicate_rows(df: DataFrame, key: str) -> DataFrame:
    """Every row whose key occurs more than once.

    Counts are made by key with a map-side sum; the rows are then matched by a semi join,
    whose adaptive skew handling splits a hot key, instead of a window that could not.
    """
    repeated = df.groupBy(key).count().where("count > 1").select(F.col(key).alias("_key"))
    return df.join(repeated, F.col(key).eqNullSafe(F.col("_key")), "left_semi")


def drop_out_of_range(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Drop rows that surely break a range; a missing value stays."""
    return df.where(~surely_invalid(column, F.col(name or column)))


def keep_surely_valid(df: DataFrame) -> DataFrame:
    """Keep rows that surely meet all ranges; a missing value goes."""
    return df.where(surely_valid())


def prepare(raw: DataFrame, fills: dict[str, object] | None = None) -> DataFrame:
    return fill_missing(scale_money(localize_geography(nan_to_null(raw))), fills)


def to_customers(df: DataFrame) -> DataFrame:
    """Rename, reorder and type the columns as the customers table has them."""
    renamed = df.withColumnsRenamed(RAW_TO_CUSTOMER)
    return renamed.select([F.col(f.name).cast(f.dataType) for f in CUSTOMERS])


def clean_customers(raw: DataFrame, fills: dict[str, object] | None = None) -> DataFrame:
    """The whole chain: the raw file in, the customers table out."""
    df = keep_first(prepare(raw, fills), "CustomerId", "RowNumber")
    for column, name in RULES.items():
        df = drop_out_of_range(df, column, name)
    return to_customers(df)


def cleaning_report(raw: DataFrame, fills: dict[str, object] | None = None) -> DataFrame:
    """Row counts of the chain by outcome, from one pass after the fill.

    The first row of a key is told from the others by its count and the outcome of its
    minimum, so nothing but one row per key is shuffled.
    """
    df = prepare(raw, fills)
    outcome = F.lit("final")
    for column, name in reversed(RULES.items()):
        outcome = F.when(surely_invalid(column, F.col(name)), f"invalid_{column}").otherwise(outcome)
    marked = df.select("CustomerId", "RowNumber", outcome.alias("outcome"))
    per_key = marked.groupBy("CustomerId").agg(
        F.count("*").alias("n"), F.min(F.struct("RowNumber", "outcome")).alias("first")
    )
    totals = per_key.agg(
        F.sum("n").alias("initial"),
        F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("duplicate"),
        *[F.count_if(F.col("first.outcome") == f"invalid_{c}").alias(f"invalid_{c}") for c in RULES],
        F.count_if(F.col("first.outcome") == "final").alias("final"),
    ).withColumn("removed", F.col("initial") - F.col("final"))
    return totals.unpivot([], totals.columns, "counter", "row_count")
