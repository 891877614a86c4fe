"""Headline queries, timed once each after a warm-up; prints one JSON line.

BENCH_SF_DIR names the test tables, BENCH_CPUS the cores.
"""

from __future__ import annotations

import json
import os
import time

from ebbtide.catalog import QUERIES, frame
from ebbtide.plans import models, retrain
from ebbtide.session import local_session, shared_dir
from ebbtide.sources import derived

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "clean_customers",
    "cleaning_report",
    "churn_by_geography",
    "churn_by_age_group",
    "churn_by_products",
    "balance_by_exited",
    "churn_by_credit_band",
    "churn_by_active",
    "churn_by_tenure",
    "export_roundtrip",
    "bi_measures",
    "credit_band_by_exited",
    "correlation_matrix",
    "credit_box_stats",
    "kde_balance",
    "fact_with_geo_summary",
    "stratified_split",
    "cv_folds",
    "feature_matrix",
    "roc_auc",
    "roc_curve",
    "classification_report",
    "permutation_importance",
    "score_drift",
    "ingest_batch",
    "risk_distribution",
    "sliced_predictions",
]
FITS = {"fit_lr": models.LOGISTIC, "fit_rf": models.FOREST, "fit_svm": models.SVM, "fit_gbt": models.BOOSTED}


def main() -> None:
    spark = local_session(CPUS, "bench", **{"spark.ui.showConsoleProgress": "false"})
    for name in ("customers", "scored", "predictions", "batch_rows"):
        derived.table(spark, SF_DIR, name)
    QUERIES["churn_by_gender"](spark, SF_DIR).collect()

    seconds: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)

    for name in HEADLINE:
        timed(name, lambda: QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save())
    timed("training_frame", lambda: frame(spark, SF_DIR))
    rows = frame(spark, SF_DIR)
    for name, candidate in FITS.items():
        timed(name, lambda: models.measure(candidate, models.score(models.fit_candidate(rows, models.CANDIDATES[candidate]), rows.test)).collect())
    for name, candidate in FITS.items():
        timed(name.replace("fit", "grid_search"), lambda: models.grid_search(rows, models.CANDIDATES[candidate]))
    timed("score_customers", lambda: QUERIES["score_customers"](spark, SF_DIR).write.format("noop").mode("overwrite").save())
    folder = shared_dir(spark, f"bench-{time.time_ns()}")
    customers = derived.table(spark, SF_DIR, "customers")
    timed("retrain", lambda: retrain.retrain(customers, f"{folder}/registry", f"{folder}/models"))
    print(
        json.dumps(
            {
                "metric": "total time of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
