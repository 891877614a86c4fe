"""Scoring of a stream of requests into the prediction log.

`stream_scores` scores with one model to its end. `stream_followed` scores each micro-batch with the
version that the registry names at that time, and keeps the counts of the log beside it. A batch
writes its part of the log, its refused requests and then a snapshot of the counts, whose own commit
makes all three count: a batch that failed before leaves nothing that is seen, and a batch that is
replayed writes the same folders again, or does nothing if its snapshot is there.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.operators.score_counts import SCORE_COUNTS, counts_of, merged
from ebbtide.plans.registry import active, read_registry
from ebbtide.plans.scoring import as_log, load_model, score_customers
from ebbtide.schemas import PREDICTIONS, SCORING_COLUMNS
from ebbtide.session import names_in, path_exists, remove
from ebbtide.sources.batches import parse_scoring_json

BATCH = "score_batch"
KEPT_SNAPSHOTS = 3  # readers of an older one have been given a newer one since

LOG = T.StructType([
    *PREDICTIONS.fields,
    T.StructField("model_version", T.StringType()),
    T.StructField(BATCH, T.LongType()),
    T.StructField("day", T.DateType()),
])
REFUSED = T.StructType([
    T.StructField("request", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("refused_at", T.TimestampType()),
    T.StructField(BATCH, T.LongType()),
])


def read_requests(spark: SparkSession, folder: str, max_files: int = 1000) -> DataFrame:
    """JSON requests, one per line, from files as they arrive."""
    lines = spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(folder)
    return parse_scoring_json(lines.withColumn("request", F.col("value")))


def _accepted(requests: DataFrame) -> DataFrame:
    return requests.where("valid").drop("valid", "request")


def _refused(requests: DataFrame) -> DataFrame:
    """Requests that cannot be scored, as they came, and what they lack."""
    missing = [F.when(F.col(c).isNull(), F.lit(c)) for c in SCORING_COLUMNS]
    reason = F.concat(F.lit("no usable value: "), F.concat_ws(", ", *missing))
    return requests.where("NOT valid").select("request", reason.alias("reason"), F.current_timestamp().alias("refused_at"))


def stream_refused(requests: DataFrame, rejects: str, checkpoint: str):
    """Append the requests that cannot be scored to a table of their own."""
    return (
        _refused(requests).writeStream.format("parquet")
        .option("path", rejects)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_scores(requests: DataFrame, model: PipelineModel, log: str, checkpoint: str):
    """Append scored requests to the log; the sink's own commit log makes it exactly once."""
    scored = as_log(score_customers(_accepted(requests), model)).withColumn("day", F.to_date("timestamp"))
    return (
        scored.writeStream.format("parquet")
        .partitionBy("day")
        .option("path", log)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


class ActiveModel:
    """The registry's active model, loaded again only when another version is active."""

    def __init__(self, spark: SparkSession, registry_path: str):
        self.spark, self.registry_path = spark, registry_path
        self.version: str | None = None
        self.model: PipelineModel | None = None

    def current(self) -> tuple[str, PipelineModel]:
        row = active(read_registry(self.spark, self.registry_path)).first()
        if row is None:
            raise FileNotFoundError(f"no active model in {self.registry_path}")
        if row["version"] != self.version:
            self.model = load_model(row)
            self.version = row["version"]
        return self.version, self.model


def counted_batches(spark: SparkSession, folder: str) -> list[int]:
    """Batches that have a complete snapshot, in their order."""
    numbers = [int(n.split("=")[1]) for n in names_in(spark, f"{folder}/counts") if n.startswith(f"{BATCH}=")]
    return [n for n in sorted(numbers) if path_exists(spark, f"{folder}/counts/{BATCH}={n}/_SUCCESS")]


def read_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of all that has been scored, from the newest snapshot."""
    counted = counted_batches(spark, folder)
    if not counted:
        return spark.createDataFrame([], SCORE_COUNTS)
    return spark.read.schema(SCORE_COUNTS).parquet(f"{folder}/counts/{BATCH}={counted[-1]}")


def _read(spark: SparkSession, folder: str, name: str, schema: T.StructType) -> DataFrame:
    """Rows of the batches up to the newest snapshot."""
    counted = counted_batches(spark, folder)
    if not counted or not path_exists(spark, f"{folder}/{name}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/{name}").where(F.col(BATCH) <= counted[-1])


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    """The prediction log with model version, batch, day; a folder per risk level, so a list of high risks reads no other."""
    return _read(spark, folder, "log", LOG)


def read_refused(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "refused", REFUSED)


def score_batch(requests: DataFrame, folder: str, version: str, model: PipelineModel, batch: int) -> None:
    """Score a micro-batch of parsed requests into its own folders and add up the counts.

    Batches of a folder are numbered by one stream: another checkpoint needs another folder.
    """
    spark = requests.sparkSession
    counted = counted_batches(spark, folder)
    if counted and counted[-1] >= batch:
        return
    part = f"{folder}/log/{BATCH}={batch}"
    scored = as_log(score_customers(_accepted(requests), model))
    scored = scored.withColumns({"model_version": F.lit(version), "day": F.to_date("timestamp")})
    scored.write.mode("overwrite").partitionBy("day", "risk_level").parquet(part)
    _refused(requests).write.mode("overwrite").parquet(f"{folder}/refused/{BATCH}={batch}")
    # ids and times are drawn anew at each evaluation: what is counted is what was written
    written = spark.read.schema(LOG).option("basePath", f"{folder}/log").parquet(part)
    before = read_counts(spark, folder)
    merged(before, counts_of(written)).coalesce(1).write.mode("overwrite").parquet(f"{folder}/counts/{BATCH}={batch}")
    for old in counted[: 1 - KEPT_SNAPSHOTS]:
        remove(spark, f"{folder}/counts/{BATCH}={old}")


def stream_followed(requests: DataFrame, registry_path: str, folder: str, checkpoint: str):
    """Score requests into folder/log, refused ones into folder/refused, counts into folder/counts.

    The registry is asked once per micro-batch, so a version that becomes active while the stream
    runs scores the next one. Nothing is collected but the registry's row.
    """
    following = ActiveModel(requests.sparkSession, registry_path)

    def score(batch: DataFrame, epoch: int) -> None:
        score_batch(batch, folder, *following.current(), epoch)

    return (
        requests.writeStream.foreachBatch(score)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
