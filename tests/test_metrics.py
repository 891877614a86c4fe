import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbtide.operators import drift, metrics
from ebbtide.operators.importance import permutation_importance, top_features

QUIET = dict(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, rows):
    return spark.createDataFrame(rows, "exited int, prediction int, churn_probability double")


@settings(**QUIET)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 8)), min_size=2, max_size=50))
def test_auc_is_the_share_of_ordered_pairs(spark, rows):
    df = frame(spark, [(y, 0, float(s)) for y, s in rows])
    pairs = [(p, n) for yp, p in rows if yp for yn, n in rows if not yn]
    got = metrics.roc_auc(df, ranges=5).first()[0]
    if not pairs:
        assert got is None
    else:
        assert got == pytest.approx(sum((p > n) + (p == n) / 2 for p, n in pairs) / len(pairs))


def test_metrics_of_one_class(spark):
    none = frame(spark, [(0, 0, 0.1), (0, 0, 0.2)])
    assert list(metrics.classification_metrics(none).first()) == [1.0, 0.0, 0.0, 0.0]
    missed = frame(spark, [(1, 0, 0.1), (0, 0, 0.2)])
    assert list(metrics.classification_metrics(missed).first()) == [0.5, 0.0, 0.0, 0.0]
    cells = {(r["actual"], r["predicted"]): r["n"] for r in metrics.confusion_matrix(missed).collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_report_averages(spark):
    df = frame(spark, [(1, 1, 0.9), (1, 0, 0.4), (0, 0, 0.2), (0, 1, 0.6), (0, 0, 0.1)])
    rows = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert rows["1"]["precision"] == 0.5 and rows["1"]["recall"] == 0.5 and rows["1"]["support"] == 2
    assert rows["accuracy"]["f1_score"] == 0.6 and rows["accuracy"]["support"] == 5
    assert rows["macro avg"]["recall"] == pytest.approx((0.5 + 2 / 3) / 2, abs=1e-6)
    assert rows["weighted avg"]["recall"] == pytest.approx((0.5 * 2 + 2 / 3 * 3) / 5, abs=1e-6)


def test_curve_ends_and_rises(spark):
    df = frame(spark, [(int(i % 3 == 0), 0, float(i % 7)) for i in range(60)])
    points = sorted((r["fpr"], r["tpr"]) for r in metrics.roc_curve(df, ranges=3).collect())
    assert points[0] == (0.0, 0.0) and points[-1] == (1.0, 1.0) and len(points) == 8
    area = sum((x2 - x1) * (y1 + y2) / 2 for (x1, y1), (x2, y2) in zip(points, points[1:]))
    assert area == pytest.approx(metrics.roc_auc(df).first()[0])


def test_importance_of_used_and_unused_columns(spark):
    rows = [(i, int(i % 2), i % 2, i % 5) for i in range(400)]
    df = spark.createDataFrame(rows, "customer_id long, exited int, used int, unused int")
    results = []
    for cells in (1, 7, 500):
        found = permutation_importance(
            df, ["used", "unused"], lambda d: d.withColumn("prediction", F.col("used")), repeats=4, cells=cells
        )
        got = {r["feature"]: r["importance_mean"] for r in found.collect()}
        assert got["unused"] == 0.0 and 0.35 < got["used"] < 0.65
        assert top_features(found, 1).first()["feature"] == "used"
        results.append(sorted(map(tuple, found.collect())))
    assert results[0] == results[1] == results[2]


def test_columns_of_few_values_are_scored_once_per_value(spark):
    rows = [(i, i % 3 == 0, i % 2 or None, "abc"[i % 3], float(i * 37 % 101)) for i in range(400)]
    df = spark.createDataFrame(rows, "customer_id long, exited boolean, flag long, place string, amount double")
    df = df.withColumn("exited", F.col("exited").cast("int"))
    points = F.coalesce(F.col("flag"), F.lit(0)) + F.when(F.col("place") == "a", 2).otherwise(0) + F.col("amount") / 50
    scored = []

    def predict(d):
        scored.append(d)
        return d.withColumn("prediction", (points > 2).cast("int"))

    results, sizes = [], []
    for few in (0, None, 1000):
        found = permutation_importance(df, ["flag", "place", "amount"], predict, repeats=10, few=few)
        results.append(sorted((r["feature"], round(r[1], 9), round(r[2], 9)) for r in found.collect()))
        sizes.append(sum(d.count() for d in scored))
        scored.clear()
    assert len(results[0]) == 3 and results[0] == results[1] == results[2]
    # 31 scores a row without the table; with it 1 + 10 for the amount, and the row, another flag, two other places
    assert sizes[:2] == [31 * 400, 15 * 400]


def test_a_permutation_keeps_the_values(spark):
    rows = [(i, 1, float(i)) for i in range(300)]
    df = spark.createDataFrame(rows, "customer_id long, exited int, v double")
    seen = {}

    def predict(d):
        seen["rows"] = d
        return d.withColumn("prediction", F.lit(1))

    permutation_importance(df, ["v"], predict, repeats=2, cells=3).collect()
    for repeat in (0, 1):
        values = [r["v"] for r in seen["rows"].where(f"repeat = {repeat} AND _changed = 1").collect()]
        assert sorted(values) == [float(i) for i in range(300)]


def test_drift_needs_ten_rows_and_falls_back(spark):
    few = spark.createDataFrame([(i, 1, 50.0) for i in range(9)], "customer_id int, exited int, churn_probability double")
    row = drift.score_drift(drift.latest(few), few).first()
    assert (row["drift"], row["drift_warning"], row["drift_pct"]) == (0.0, False, "0.00%")
    calm = spark.createDataFrame([(i, 0, 20.0) for i in range(200)], few.schema)
    row = drift.score_drift(drift.latest(calm), calm).first()
    assert row["recent_rows"] == 100 and row["baseline_rate"] == 0.2037 and not row["drift_warning"]
    off = spark.createDataFrame([(i, 0, 90.0) for i in range(20)], few.schema)
    assert drift.score_drift(drift.latest(off), off).first()["drift_warning"]
