"""The queue between ingest and retraining: asked once, claimed by one, taken over when abandoned."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from ebbtide.plans import retrain_queue as Q
from ebbtide.plans.retrain import Outcome

NOW = datetime(2026, 1, 1)


@pytest.fixture
def queue(tmp_path):
    return str(tmp_path / "queue")


def trained(calls):
    def train():
        calls.append(1)
        return Outcome(True, "Updated to v1", None)

    return train


def test_one_training_for_all_that_was_asked(spark, queue):
    calls = []
    assert Q.work(spark, queue, trained(calls), NOW) is None
    assert not Q.ask(spark, queue, "batch-0", 0, NOW)
    assert Q.ask(spark, queue, "batch-1", 5, NOW) and Q.ask(spark, queue, "batch-2", 7, NOW)
    assert not Q.ask(spark, queue, "batch-1", 5, NOW)  # a replayed ingest
    assert Q.work(spark, queue, trained(calls), NOW).updated and calls == [1]
    assert Q.open_items(spark, queue).count() == 0 and Q.work(spark, queue, trained(calls), NOW) is None
    rows = spark.read.parquet(f"{queue}/outcomes").orderBy("item").collect()
    assert [(r["item"], r["message"]) for r in rows] == [("batch-1", "Updated to v1"), ("batch-2", "Updated to v1")]


def test_a_claimed_item_is_left_alone_until_its_lease_ends(spark, queue):
    Q.ask(spark, queue, "batch", 1, NOW)
    assert Q.claim(spark, queue, NOW) == ["batch"] and Q.claim(spark, queue, NOW + timedelta(hours=1)) == []
    later = NOW + timedelta(hours=7)
    assert Q.claim(spark, queue, later) == ["batch"] and Q.claim(spark, queue, later) == []


def test_of_two_workers_one_gets_the_item(spark, queue, monkeypatch):
    """Both see it open; the second one's file is there already."""
    Q.ask(spark, queue, "batch", 1, NOW)
    seen = Q.open_items(spark, queue).collect()
    assert Q.claim(spark, queue, NOW) == ["batch"]

    class Same:
        def orderBy(self, *_):
            return self

        def collect(self):
            return seen

    monkeypatch.setattr(Q, "open_items", lambda *_: Same())
    assert Q.claim(spark, queue, NOW) == []


def test_a_failed_training_is_not_done(spark, queue):
    Q.ask(spark, queue, "batch", 1, NOW)

    def fail():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        Q.work(spark, queue, fail, NOW)
    calls = []
    assert Q.work(spark, queue, trained(calls), NOW) is None
    assert Q.work(spark, queue, trained(calls), NOW + timedelta(days=1)).updated and calls == [1]
