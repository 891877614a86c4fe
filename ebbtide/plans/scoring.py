"""Batch scoring: features, model, percent, risk."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions import bands
from ebbtide.operators.drift import latest, score_drift
from ebbtide.plans.registry import active, read_registry
from ebbtide.schemas import PREDICTIONS, SCORING_COLUMNS
from ebbtide.sources.batches import require_columns


def with_risk(df: DataFrame, probability: str = "probability") -> DataFrame:
    """Percent, risk level and badge of a probability column."""
    pct = df.withColumn("churn_probability", bands.percent(F.col(probability)))
    risk = pct.withColumn("risk_level", bands.risk_level(F.col("churn_probability")))
    return risk.withColumn("color_class", bands.risk_badge(F.col("risk_level")))


def score_customers(customers: DataFrame, model: PipelineModel) -> DataFrame:
    """Score customers, or a stream of them. Only map work: no shuffle."""
    require_columns(customers.columns, SCORING_COLUMNS)
    scored = model.transform(customers).withColumn("_p", vector_to_array("probability")[1])
    return with_risk(scored.select(*customers.columns, "prediction", "_p"), "_p").drop("_p")


def load_model(row: Row) -> PipelineModel:
    """Preprocessing and classifier of a registry row."""
    preprocessor = PipelineModel.load(row["preprocessor_path"])
    return PipelineModel(stages=[*preprocessor.stages, PipelineModel.load(row["model_path"])])


def load_active_model(spark: SparkSession, registry_path: str) -> PipelineModel:
    """Preprocessing and classifier of the active version, loaded once per job."""
    row = active(read_registry(spark, registry_path)).first()
    if row is None:
        raise FileNotFoundError(f"no active model in {registry_path}")
    return load_model(row)


def as_log(scored: DataFrame) -> DataFrame:
    """Rows of the prediction log: an id and a time are added to what was scored."""
    stamped = scored.withColumns({
        "prediction_id": F.expr("uuid()"),
        "timestamp": F.current_timestamp(),
    })
    return stamped.select([F.col(f.name).cast(f.dataType) for f in PREDICTIONS])


def append_predictions(scored: DataFrame, path: str) -> None:
    """Append to the log, one folder per day, so date slices read only their days."""
    as_log(scored).withColumn("day", F.to_date("timestamp")).write.mode("append").partitionBy("day").parquet(path)


def drift_of_model(customers: DataFrame, model: PipelineModel) -> DataFrame:
    """Only the latest rows are scored; the churn rate is one aggregate."""
    return score_drift(score_customers(latest(customers), model), customers)
