"""Fitted preprocessing: impute, scale, one-hot, assemble."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.features import add_engineered_features
from ebbtide.operators.ordering import exact_medians, grouped_medians

# What is fed to the models, in this order.
NUMERIC = [
    "credit_score",
    "age",
    "tenure",
    "balance",
    "num_products",
    "estimated_salary",
    "balance_to_salary_ratio",
    "balance_per_product",
]
CATEGORICAL = ["geography", "gender"]
BINARY = [
    "has_credit_card",
    "is_active_member",
    "is_high_product_risk",
    "is_inactive_and_older",
    "is_active_and_young",
]


class EngineeredFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds the engineered columns."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return add_engineered_features(dataset)


def value_counts(df: DataFrame, columns: list[str], by: Iterable[str] = ()) -> DataFrame:
    """column, value, count of several columns, by more columns if asked; one pass, summed before it is shuffled."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return df.select(*by, F.explode(pairs).alias("x")).select(*by, "x.*").where("value IS NOT NULL").groupBy("column", "value", *by).count()


def modes(counts: DataFrame) -> dict[str, str]:
    """By column the smallest of the most frequent values; a column without values is missing."""
    best = counts.groupBy("column").agg(F.min_by("value", F.struct(-F.col("count"), "value")).alias("value"))
    return {r["column"]: r["value"] for r in best.collect()}  # a row per column


def categories(counts: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """The values of the columns that are encoded: each becomes a feature of every row, so the list
    is as long as the model's vectors are."""
    found: dict[str, list[str]] = {c: [] for c in columns}
    for row in counts.where(F.col("column").isin(columns)).select("column", "value").collect():
        found[row["column"]].append(row["value"])
    return {c: sorted(v) for c, v in found.items()}


def imputed_numeric(column: str, median: float | None) -> Column:
    return F.coalesce(F.col(column).cast("double"), F.lit(median))


def fit_medians(df: DataFrame) -> dict[str, float | None]:
    return exact_medians(df, NUMERIC)


def fit_scales(df: DataFrame, medians: dict[str, float | None]) -> dict[str, tuple[float, float]]:
    """Mean and population standard deviation after imputation; a constant column is divided by 1."""
    aggregates = []
    for c in NUMERIC:
        value = imputed_numeric(c, medians[c])
        aggregates += [F.avg(value).alias(f"m_{c}"), F.stddev_pop(value).alias(f"s_{c}")]
    row = df.agg(*aggregates).first()
    return {c: (row[f"m_{c}"] or 0.0, row[f"s_{c}"] or 1.0) for c in NUMERIC}


def fit_parts(df: DataFrame, parts: dict[int, Column], fold: str = "fold") -> dict[int, ChurnPreprocessorModel]:
    """The preprocessors of several parts of the rows, in the passes that one takes.

    parts: by number a condition on the fold column. Medians and scales of all columns and parts come from
    the same grouped passes, categories from counts per fold, which are added up by part.
    """
    own = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in parts.items()]))
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in NUMERIC])
    values = df.select(own.alias("parts"), F.explode(cells).alias("x")).select("x.*", F.explode("parts").alias("part"))
    medians = {(r["column"], r["part"]): r["median"] for r in grouped_medians(values, ["column", "part"], "value").collect()}
    rows = [(c, k, medians.get((c, k))) for c in NUMERIC for k in parts]
    imputed = values.join(F.broadcast(df.sparkSession.createDataFrame(rows, "column string, part int, median double")), ["column", "part"])
    value = F.coalesce("value", "median")
    moments = imputed.groupBy("column", "part").agg(F.avg(value).alias("m"), F.stddev_pop(value).alias("s")).collect()
    scales = {(r["column"], r["part"]): (r["m"] or 0.0, r["s"] or 1.0) for r in moments}

    per_value = value_counts(df, CATEGORICAL + BINARY, [fold]).groupBy("column", "value")
    counts = per_value.agg(*[F.sum(F.when(c, F.col("count"))).alias(f"n_{k}") for k, c in parts.items()]).persist()
    order = {k: F.struct(-F.col(f"n_{k}"), "value") for k in parts}
    best = counts.groupBy("column").agg(*[F.min_by("value", F.when(F.col(f"n_{k}") > 0, order[k])).alias(f"v_{k}") for k in parts])
    common = {(r["column"], k): r[f"v_{k}"] for r in best.collect() for k in parts}  # a row per column
    known = {k: categories(counts.where(F.col(f"n_{k}") > 0), CATEGORICAL) for k in parts}
    counts.unpersist()
    return {
        k: ChurnPreprocessorModel(json.dumps({
            "medians": {c: medians.get((c, k)) for c in NUMERIC},
            "scales": {c: scales.get((c, k), (0.0, 1.0)) for c in NUMERIC},
            "modes": {c: common.get((c, k)) for c in CATEGORICAL + BINARY},
            "categories": known[k],
        }))
        for k in parts
    }


class _Fitted(Params):
    statistics = Param(Params._dummy(), "statistics", "fitted values as JSON", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "name of the vector column", TypeConverters.toString)


class ChurnPreprocessorModel(Model, _Fitted, DefaultParamsReadable, DefaultParamsWritable):
    """Median impute and scale numbers, one-hot categories without the first, mode impute flags."""

    def __init__(self, statistics: str = "{}", outputCol: str = "features"):
        super().__init__()
        self._set(statistics=statistics, outputCol=outputCol)

    @property
    def fitted(self) -> dict:
        return json.loads(self.getOrDefault(self.statistics))

    def columns(self) -> dict[str, Column]:
        """Encoded columns by name, in feature order."""
        fitted, out = self.fitted, {}
        for c in NUMERIC:
            mean, scale = fitted["scales"][c]
            out[c] = (imputed_numeric(c, fitted["medians"][c]) - mean) / scale
        for c in CATEGORICAL:
            value = F.coalesce(F.col(c), F.lit(fitted["modes"][c]))
            for category in fitted["categories"][c][1:]:
                # a value not seen in the fit is zero everywhere
                out[f"{c}_{category}"] = F.when(value == category, 1.0).otherwise(0.0)
        for c in BINARY:
            mode = fitted["modes"][c]
            out[c] = F.coalesce(F.col(c).cast("double"), F.lit(None if mode is None else float(mode)))
        return out

    def feature_names(self) -> list[str]:
        return list(self.columns())

    def encoded(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """The kept columns and the encoded ones, as plain columns."""
        return df.select(*keep, *[c.alias(f"f_{n}") for n, c in self.columns().items()])

    def assembler(self) -> VectorAssembler:
        return VectorAssembler(
            inputCols=[f"f_{n}" for n in self.feature_names()], outputCol=self.getOrDefault(self.outputCol)
        )

    def _transform(self, dataset: DataFrame) -> DataFrame:
        wide = dataset.withColumns({f"f_{n}": c for n, c in self.columns().items()})
        return self.assembler().transform(wide).drop(*[f"f_{n}" for n in self.feature_names()])


class ChurnPreprocessor(Estimator, _Fitted, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, outputCol: str = "features"):
        super().__init__()
        self._set(outputCol=outputCol)

    def _fit(self, dataset: DataFrame) -> ChurnPreprocessorModel:
        medians = fit_medians(dataset)
        scales = fit_scales(dataset, medians)
        counts = value_counts(dataset, CATEGORICAL + BINARY).persist()
        common = modes(counts)
        statistics = {
            "medians": medians,
            "scales": scales,
            "modes": {c: common.get(c) for c in CATEGORICAL + BINARY},
            "categories": categories(counts, CATEGORICAL),
        }
        counts.unpersist()
        return ChurnPreprocessorModel(json.dumps(statistics), self.getOrDefault(self.outputCol))
