"""Ingest asks for retraining by a queue: work items are rows, claims are files created once.

An item is asked for by name, so an ingest that is replayed asks once. A worker claims all open items,
trains once for all of them, and notes the outcome. A claim whose worker is gone is taken over after a
lease, by the next attempt's number; items are done when an outcome names them.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.plans.exports import append_table
from ebbtide.plans.retrain import Outcome
from ebbtide.session import create_once, names_in, path_exists

LEASE = timedelta(hours=6)

ITEMS = T.StructType([
    T.StructField("item", T.StringType()),
    T.StructField("rows_added", T.LongType()),
    T.StructField("asked_at", T.TimestampType()),
])
CLAIMS = T.StructType([
    T.StructField("item", T.StringType()),
    T.StructField("attempt", T.LongType()),
    T.StructField("claimed_at", T.TimestampType()),
])
OUTCOMES = T.StructType([
    T.StructField("item", T.StringType()),
    T.StructField("updated", T.BooleanType()),
    T.StructField("message", T.StringType()),
    T.StructField("done_at", T.TimestampType()),
])


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def ask(spark: SparkSession, queue: str, item: str, rows_added: int, now: datetime | None = None) -> bool:
    """Ask for a retraining if rows were added; False if there were none or the item was asked for before."""
    if not rows_added or not create_once(spark, f"{queue}/_asked/{item}"):
        return False
    append_table(spark.createDataFrame([(item, rows_added, now or datetime.now())], ITEMS).coalesce(1), f"{queue}/items")
    return True


def open_items(spark: SparkSession, queue: str) -> DataFrame:
    """Items without an outcome, with the number and the time of their last claim."""
    done = _read(spark, f"{queue}/outcomes", OUTCOMES).select("item")
    claims = _read(spark, f"{queue}/claims", CLAIMS).groupBy("item").agg(F.max("attempt").alias("attempt"), F.max("claimed_at").alias("claimed_at"))
    items = _read(spark, f"{queue}/items", ITEMS).dropDuplicates(["item"])
    return items.join(done, "item", "left_anti").join(claims, "item", "left")


def claim(spark: SparkSession, queue: str, now: datetime | None = None, lease: timedelta = LEASE) -> list[str]:
    """Items that this worker has taken: open ones nobody claimed, or whose claim is older than the lease."""
    now = now or datetime.now()
    taken = []
    for row in open_items(spark, queue).orderBy("asked_at", "item").collect():  # what ingests asked for since the last training
        if row["claimed_at"] is not None and now - row["claimed_at"] < lease:
            continue
        attempt = 1 + max((int(n.rsplit("-", 1)[1]) for n in names_in(spark, f"{queue}/_claims") if n.rsplit("-", 1)[0] == row["item"] and row["attempt"]), default=0)
        if create_once(spark, f"{queue}/_claims/{row['item']}-{attempt}"):
            taken.append((row["item"], attempt, now))
    if taken:
        append_table(spark.createDataFrame(taken, CLAIMS).coalesce(1), f"{queue}/claims")
    return [item for item, *_ in taken]


def work(spark: SparkSession, queue: str, train: Callable[[], Outcome], now: datetime | None = None, **options: Any) -> Outcome | None:
    """Train once for all items this worker can claim; None if there are none.

    A training that fails leaves its claims; after the lease another worker takes them over.
    """
    items = claim(spark, queue, now, **options)
    if not items:
        return None
    outcome = train()
    rows = [(item, outcome.updated, outcome.message, now or datetime.now()) for item in items]
    append_table(spark.createDataFrame(rows, OUTCOMES).coalesce(1), f"{queue}/outcomes")
    return outcome
