"""Newton steps against Spark's own logistic regression; margins, sigmoid and scores."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ebbtide import catalog
from ebbtide.operators import blocks as B
from ebbtide.operators import linear, preprocess
from ebbtide.plans import models

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def frame(spark):
    return catalog.frame(spark, SF)


def numbers(spark, x, y, fold=None, part=B.ALL):
    fold = np.arange(len(y)) % 5 if fold is None else fold
    rows = [(part, i * 7919 + 1, float(y[i]), int(fold[i]), [float(v) for v in x[i]]) for i in range(len(y))]
    return B.to_blocks(spark.createDataFrame(rows, "part int, place long, label double, fold int, features array<double>").repartition(3))


@pytest.mark.parametrize("C", [0.01, 1.0, 100.0])
def test_coefficients_equal_those_of_spark(frame, C):
    mine = models.fit_candidate(frame, models.CANDIDATES[models.LOGISTIC], C=C)
    spark_ml = LogisticRegression(labelCol="exited", maxIter=1000, regParam=1 / (C * frame.n_train), tol=1e-14, standardization=False)
    theirs = spark_ml.fit(frame.train)
    assert mine.coefficients == pytest.approx(theirs.coefficients.toArray(), abs=1e-6)
    assert mine.intercept == pytest.approx(theirs.intercept, abs=1e-6)


def test_cross_validation_is_a_fit_per_fold_and_setting(frame):
    """Each fold's scores are those of a plain fit on the rows outside it, encoded by them alone."""
    settings = [{"C": 0.1}, {"C": 10.0}]
    got = models.CANDIDATES[models.LOGISTIC].trainer.cross_scores(frame.blocks, [1, 3], settings)
    for part in (1, 3):
        raw = frame.raw.where("split = 'train'")
        encoder = preprocess.ChurnPreprocessor().fit(raw.where(F.col("fold") != part))
        rows = encoder.transform(raw.withColumn("exited", F.col("exited").cast("double")))
        n = rows.where(F.col("fold") != part).count()
        for i, s in enumerate(settings):
            fit = LogisticRegression(labelCol="exited", maxIter=1000, regParam=1 / (s["C"] * n), tol=1e-14, standardization=False)
            scored = fit.fit(rows.where(F.col("fold") != part)).transform(rows.where(F.col("fold") == part))
            want = sorted(r[0] for r in scored.select(vector_to_array("probability")[1]).collect())
            have = sorted(r["score"] for r in got.where((F.col("part") == part) & (F.col("setting") == i)).collect())
            assert have == pytest.approx(want, abs=1e-6)


def test_statistics_of_all_parts_equal_a_fit_each(spark, customers):
    rows = preprocess.EngineeredFeatures().transform(customers).withColumn("fold", (F.col("customer_id") % 4).cast("int"))
    rows = rows.withColumns({"age": F.when(F.col("customer_id") % 7 == 0, None).otherwise(F.col("age")), "gender": F.when(F.col("fold") == 2, "Other").otherwise(F.col("gender"))})
    parts = {-1: F.col("fold") >= 0, **{k: F.col("fold") != k for k in range(4)}}
    for bound in (10_000, 20):  # the second brackets the medians in several passes
        original = preprocess.grouped_medians
        try:
            preprocess.grouped_medians = lambda *a, bound=bound: original(*a, max_values=bound)
            got = preprocess.fit_parts(rows, parts)
        finally:
            preprocess.grouped_medians = original
        for k, condition in parts.items():
            want, have = preprocess.ChurnPreprocessor().fit(rows.where(condition)).fitted, got[k].fitted
            assert have["medians"] == want["medians"] and have["modes"] == want["modes"] and have["categories"] == want["categories"]
            for c, pair in want["scales"].items():
                assert have["scales"][c] == pytest.approx(pair)


def test_a_column_without_values_has_no_median(spark):
    df = spark.createDataFrame([(0, "a", None), (1, "a", None), (0, "b", 3.0)], "fold int, g string, v double")
    from ebbtide.operators.ordering import grouped_medians

    assert [tuple(r) for r in grouped_medians(df, ["g"], "v").collect()] == [("b", 3.0)]
    assert grouped_medians(df.limit(0), ["g"], "v").collect() == []


def test_squared_hinge_solution_is_a_minimum(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] + 0.5 * rng.normal(size=400) > 0).astype(float)
    (w,) = linear.solve(numbers(spark, x, y), [linear.Problem(B.ALL, 0.7)], linear.SQUARED_HINGE)

    def objective(v):
        short = np.maximum(0, 1 - (2 * y - 1) * (x @ v[:-1] + v[-1]))
        return (short**2).sum() + 0.35 * (v[:-1] ** 2).sum()

    assert all(objective(w) <= objective(w + step) + 1e-9 for step in rng.normal(scale=1e-3, size=(200, 4)))


def test_rows_of_a_left_out_fold_have_no_part_in_their_margin(spark):
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(200, 4)), (rng.random(200) < 0.5).astype(float)
    fold = np.arange(200) % 5
    problems = [linear.Problem(B.ALL, 1.0, held_out=k) for k in range(5)]
    data = numbers(spark, x, y, fold)
    one = linear.solve(data, problems, linear.SQUARED_HINGE)
    other = linear.solve(numbers(spark, x, np.where(fold == 2, 1 - y, y), fold), problems, linear.SQUARED_HINGE)
    assert one[2] == pytest.approx(other[2]) and one[1] != pytest.approx(other[1])
    margins = [b for b in (B.block_of(r.asDict()) for r in linear.left_out_margins(data, problems, one).collect())]
    for block in margins:
        k = int(block.fold[0])
        own = np.searchsorted(np.arange(200) * 7919 + 1, block.place)
        assert (block.fold == k).all() and block.x[:, 0] == pytest.approx(np.hstack([x[own], np.ones((len(own), 1))]) @ one[k])


def test_the_sigmoid_is_calibrated(spark):
    """Labels drawn with a known probability: what the machine says about new rows is about right."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(6000, 2))
    p = 1 / (1 + np.exp(-(1.5 * x[:, 0] - x[:, 1])))
    y = (rng.random(6000) < p).astype(float)
    model = linear.KernelTrainer(7).fit(numbers(spark, x[:4000], y[:4000]), gamma=0.05, dimensions=128)
    df = spark.createDataFrame([(i, [float(a) for a in x[i]]) for i in range(4000, 6000)], "i int, f array<double>").withColumn("features", array_to_vector("f"))
    got = np.array([r[0] for r in model.transform(df).orderBy("i").select(vector_to_array("probability")[1]).collect()])
    assert np.abs(got - p[4000:]).mean() < 0.06
    for low in np.arange(0, 1, 0.2):
        own = (got >= low) & (got < low + 0.2)
        assert abs(got[own].mean() - y[4000:][own].mean()) < 0.08


def test_machines_are_saved_whole(spark, frame, tmp_path):
    for name in (models.LOGISTIC, models.SVM):
        model = models.fit_candidate(frame, models.CANDIDATES[name])
        path = str(tmp_path / name)
        PipelineModel([model]).write().save(path)
        one, two = ([tuple(r) for r in models.score(m, frame.test).orderBy("customer_id").collect()] for m in (model, PipelineModel.load(path)))
        assert one == two


def test_auc_by_setting(spark):
    rng = np.random.default_rng(4)
    rows = [(s, part, float(rng.random() < 0.3), float(np.round(rng.random(), 1 + s))) for s in range(3) for part in range(2) for _ in range(300)]
    got = B.auc_by_setting(spark.createDataFrame(rows, B.SCORES).repartition(5))
    for s in range(3):
        each = []
        for part in range(2):
            pos, neg = ([v for a, b, y, v in rows if (a, b, y) == (s, part, k)] for k in (1.0, 0.0))
            each.append(np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]))
        assert got[s] == pytest.approx(np.mean(each))


def test_sums_do_not_depend_on_who_is_first(spark):
    rng = np.random.default_rng(5)
    data = numbers(spark, rng.normal(size=(500, 80)), rng.integers(0, 2, 500)).checkpoint()
    problems = [linear.Problem(B.ALL, 1.0), linear.Problem(B.ALL, 1.0, held_out=1)]
    one, two = linear.solve(data, problems), linear.solve(data, problems)
    assert all((a == b).all() for a, b in zip(one, two, strict=True))


def test_rows_of_several_problems_are_multiplied_once(monkeypatch):
    monkeypatch.setattr(linear, "ROWS_AT_ONCE", 50)
    monkeypatch.setattr(linear, "SUMS_AT_ONCE", 3)
    rng = np.random.default_rng(5)
    z, fold = rng.normal(size=(400, 7)), rng.integers(0, 5, 400)
    has = np.column_stack([fold != k for k in range(-1, 5)]) & (rng.random((400, 1)) < 0.7)
    has[rng.random(has.shape) < 0.01] = False
    products = linear.Products(6, 7)
    for low in range(0, 400, 30):
        products.add(z[low : low + 30], has[low : low + 30])
    for rows, found in zip(has.T, products.all(), strict=True):
        assert np.allclose(found, z[rows].T @ z[rows], rtol=1e-12)


def test_shared_products_give_each_problem_its_own_sums():
    rng = np.random.default_rng(6)
    z, y = np.hstack([rng.normal(size=(300, 4)), np.ones((300, 1))]), rng.integers(0, 2, 300).astype(float)
    w, rows = rng.normal(size=(5, 3)), np.column_stack([np.arange(300) % 3 != k for k in range(3)])
    found, short = linear._hinge_terms(z, y, w, rows)
    for k in range(3):
        own, sign = z[rows[:, k]], 2 * y[rows[:, k]] - 1
        lost = np.maximum(1 - sign * (own @ w[:, k]), 0)
        assert np.allclose(found[k], [len(own), (lost**2).sum(), *(-2 * own.T @ (sign * lost))])
        assert short[rows[:, k], k].tolist() == (lost > 0).tolist() and not short[~rows[:, k], k].any()
