"""Model queries run the whole job of their operators."""

from __future__ import annotations

from types import SimpleNamespace

from pyspark.sql import Row

from ebbtide import catalog
from ebbtide.plans import models


def test_every_candidate_is_tuned_with_its_own_values(monkeypatch):
    tuned = []
    monkeypatch.setattr(catalog, "frame", lambda spark, sf: None)
    monkeypatch.setattr(models, "grid_search", lambda frame, *given, **more: tuned.append((given, more)) or SimpleNamespace(results=None))
    for name, run in catalog.QUERIES.items():
        if name.startswith("grid_search") and not name.endswith("_holds"):  # those judge the results of these
            run(None, "")
    assert sorted(given[0].name for given, _ in tuned) == sorted(models.CANDIDATES)
    assert all(len(given) == 1 and not more for given, more in tuned)


def test_retraining_tries_all(monkeypatch):
    given = {}
    monkeypatch.setattr(catalog.SparkSession, "active", lambda: None)
    monkeypatch.setattr(catalog, "scratch", lambda *a: "folder")
    monkeypatch.setattr(catalog.derived, "table", lambda *a: None)
    monkeypatch.setattr(catalog.retraining, "retrain", lambda *a, **more: given.update(more))
    catalog._retrained.__wrapped__("application", "sf")
    assert set(given) == {"events_path", "metrics_path"}


def test_importance_is_that_of_the_best_model(monkeypatch):
    metrics = SimpleNamespace()
    monkeypatch.setattr(catalog, "frame", lambda spark, sf: "frame")
    monkeypatch.setattr(models, "compare_models", lambda frame: (metrics, {models.LOGISTIC: "one", models.FOREST: "two"}))
    monkeypatch.setattr(models, "best_model", lambda m: SimpleNamespace(first=lambda: Row(Model=models.FOREST)))
    monkeypatch.setattr(models, "importance", lambda frame, model: model)
    monkeypatch.setattr(catalog.importance, "top_features", lambda found: found)
    assert catalog.permutation_importance_model(None, "") == "two"
