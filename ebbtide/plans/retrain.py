"""Retraining: compare, tune the best, keep it if it beats the active model."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ebbtide.operators.splits import FOLDS
from ebbtide.plans import models, registry
from ebbtide.plans.exports import append_table, replace_table

# Fixed value: fewer rows are not worth a model.
MIN_TRAINING_ROWS = 100

EVENTS = T.StructType([
    T.StructField("at", T.TimestampType()),
    T.StructField("event", T.StringType()),
    T.StructField("detail", T.StringType()),
])


@dataclass
class Outcome:
    updated: bool
    message: str
    events: DataFrame
    metrics: DataFrame | None = None


def retrain(
    customers: DataFrame,
    registry_path: str,
    models_path: str,
    mode: str = registry.IF_BETTER,
    names: list[str] | None = None,
    overrides: dict[str, dict[str, Any]] | None = None,
    grids: dict[str, dict[str, list]] | None = None,
    weights: dict[str, tuple[float, ...]] | None = None,
    folds: int = FOLDS,
    now: datetime | None = None,
    events_path: str | None = None,
    metrics_path: str | None = None,
) -> Outcome:
    """`grids` and `weights` replace the values tried for a candidate, `overrides` its defaults.

    With `events_path` the events are appended to that table, with `metrics_path` the measured
    metrics replace that one.
    """
    spark = customers.sparkSession
    log: list[tuple[datetime, str, str]] = []

    def note(event: str, detail: str = "") -> None:
        log.append((now or datetime.now(), event, detail))

    def done(updated: bool, message: str, metrics: DataFrame | None = None) -> Outcome:
        events = spark.createDataFrame(log, EVENTS)
        if events_path:
            append_table(events.coalesce(1), events_path)
        if metrics_path and metrics is not None:
            replace_table(metrics.coalesce(1), metrics_path)
        return Outcome(updated, message, events, metrics)

    note("started")
    if customers.count() < MIN_TRAINING_ROWS:
        note("refused", f"fewer than {MIN_TRAINING_ROWS} rows")
        return done(False, "Insufficient data")
    frame = models.training_frame(customers, folds)
    note("loaded", f"{frame.n_total} rows in {frame.partitions} partitions")

    metrics, fitted = models.compare_models(frame, names, overrides)
    for row in metrics.collect():  # one row per candidate
        note("candidate", f"{row['Model']}: {row['ROC-AUC']:.4f}")
    order = {name: i for i, name in enumerate(fitted)}
    best = min(metrics.collect(), key=lambda r: (-r["ROC-AUC"], order[r["Model"]]))["Model"]
    note("best candidate", best)

    grid = (grids or {}).get(best)
    if grid is None and best == models.LOGISTIC:
        grid = models.RETRAIN_LOGISTIC_GRID
    tuned = models.grid_search(frame, models.CANDIDATES[best], grid, (weights or {}).get(best), folds)
    measured = models.measure(best, models.score(tuned.model, frame.test)).first()
    auc = measured["ROC-AUC"]
    note("tuned", f"test {auc:.4f}, cross-validated {tuned.cv_auc:.4f}, {tuned.parameters}")

    # every row is measured; the tuned model replaces its untuned row
    frame.release()
    kept = [r for r in metrics.collect() if r["Model"] != best]
    metrics = spark.createDataFrame([*kept, measured], metrics.schema)

    current = registry.read_registry(spark, registry_path)
    if mode == registry.IF_BETTER and not registry.is_better(current, auc):
        holder = registry.active(current).first()
        note("rejected", f"{holder['version']} stays with {holder['roc_auc']:.4f}")
        return done(False, f"Retained {holder['version']} (Candidate AUC: {auc:.4f})", metrics)
    version = registry.next_version(current).first()["version"]
    model_path, preprocessor_path = f"{models_path}/{version}/model", f"{models_path}/{version}/preprocessor"
    PipelineModel(stages=[tuned.model]).write().overwrite().save(model_path)
    frame.preprocessor.write().overwrite().save(preprocessor_path)
    registry.register(
        spark, registry_path, auc, frame.n_total, model_path, preprocessor_path, version, registry.FORCE, now
    )
    note("updated", version)
    return done(True, f"Updated to {version} (AUC: {auc:.4f})", metrics)
