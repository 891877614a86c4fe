from datetime import date, datetime

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import plan_of
from ebbtide import catalog
from ebbtide.functions.features import add_engineered_features
from ebbtide.operators import preprocess, reports, score_counts, splits
from ebbtide.operators.kernel import RandomFourierFeatures
from ebbtide.plans import models, registry, retrain, scoring
from ebbtide.schemas import CUSTOMERS, MODEL_REGISTRY, PREDICTIONS, SCORING_COLUMNS
from ebbtide.streaming import scoring_stream

PERSONAS = [
    (720, "Maharashtra", "Male", 28, 4, 0.0, 2, 1, 1, 8500000.0),
    (580, "Delhi", "Female", 44, 2, 9500000.0, 1, 1, 0, 12000000.0),
    (410, "Karnataka", "Female", 52, 1, 14500000.0, 3, 0, 0, 17500000.0),
]


@pytest.fixture(scope="module")
def frame(spark):
    return catalog.frame(spark, "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def scorer(frame):
    model = models.fit_candidate(frame, models.CANDIDATES[models.LOGISTIC])
    return PipelineModel(stages=[*frame.preprocessor.stages, model])


def test_split_sizes_and_stability(customers):
    rows = splits.stratified_split(customers).groupBy("exited", "split").count().collect()
    sizes = {(r["exited"], r["split"]): r["count"] for r in rows}
    for k in (0, 1):
        n = sizes[k, "test"] + sizes[k, "train"]
        assert sizes[k, "test"] == round(0.2 * n)
    again = splits.stratified_split(customers.repartition(7))
    assert again.join(splits.stratified_split(customers).select("customer_id", F.col("split").alias("s")), "customer_id").where("split <> s").count() == 0


def test_split_is_a_projection(customers):
    assert "Exchange" not in plan_of(splits.stratified_split(customers))


def test_split_of_small_and_unlabelled_classes(spark):
    df = spark.createDataFrame([(i, None if i < 10 else 1 if i < 12 else 0) for i in range(40)], "customer_id long, exited int")
    rows = splits.stratified_split(df).where("split = 'test'").groupBy("exited").count().collect()
    assert {r["exited"]: r["count"] for r in rows} == {None: 2, 0: 6}


def test_folds_are_even_in_each_class(customers):
    counts = splits.with_folds(customers).groupBy("exited", "fold").count().collect()
    for k in (0, 1):
        sizes = [r["count"] for r in counts if r["exited"] == k]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_preprocessor_by_hand(spark, tmp_path):
    rows = [
        (1, 600.0, "Delhi", "Male", 40, 3, 10.0, 1, 1, 1, 20.0, 0),
        (2, None, "Karnataka", "Female", 50, 3, 30.0, 2, 1, 0, 20.0, 1),
        (3, 800.0, None, None, 20, 3, 50.0, 0, None, 1, 20.0, 0),
        (4, 500.0, "Delhi", "Female", 30, 3, 30.0, 1, 0, 1, 20.0, 0),
    ]
    df = add_engineered_features(spark.createDataFrame(rows, CUSTOMERS))
    model = preprocess.ChurnPreprocessor().fit(df)
    assert model.feature_names() == [
        *preprocess.NUMERIC, "geography_Karnataka", "gender_Male", *preprocess.BINARY,
    ]
    got = np.array([r[0] for r in model.transform(df).orderBy("customer_id").select(vector_to_array("features")).collect()])
    scores = np.array([600.0, 600.0, 800.0, 500.0])
    assert got[:, 0] == pytest.approx((scores - scores.mean()) / scores.std())
    assert got[:, 2] == pytest.approx([0, 0, 0, 0])  # no spread: divided by one
    per_product = np.array([10.0, 15.0, 15.0, 30.0])  # no products: the median
    assert got[:, 7] == pytest.approx((per_product - per_product.mean()) / per_product.std())
    assert got[:, 8].tolist() == [0, 1, 0, 0] and got[:, 9].tolist() == [1, 0, 0, 0]
    assert got[:, 10].tolist() == [1, 1, 1, 0]
    unseen = df.withColumn("geography", F.lit("Goa"))
    assert [r[0] for r in model.transform(unseen).select(vector_to_array("features")[8]).collect()] == [0.0] * 4
    path = str(tmp_path / "p")
    pipeline = PipelineModel(stages=[preprocess.EngineeredFeatures(), model])
    pipeline.write().overwrite().save(path)
    loaded = PipelineModel.load(path).transform(spark.createDataFrame(rows, CUSTOMERS))
    assert np.array([r[0] for r in loaded.orderBy("customer_id").select(vector_to_array("features")).collect()]) == pytest.approx(got)


def test_sixteen_features(frame):
    assert len(frame.encoder.feature_names()) == 16


def test_fourier_features_approximate_the_kernel(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(12, 4))
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x)], ["i", "features"])
    model = RandomFourierFeatures(dimensions=8000).fit(df)
    z = np.array([r[0] for r in model.transform(df).orderBy("i").select(vector_to_array("kernel")).collect()])
    gamma = 1 / (4 * x.var())
    assert float(model.getOrDefault(model.gamma)) == pytest.approx(gamma)
    exact = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - exact).max() < 0.06


def test_quality_and_persona_order(spark, frame, scorer):
    measured = models.measure("lr", models.score(scorer.stages[-1], frame.test)).first()
    assert measured["ROC-AUC"] > 0.7
    people = spark.createDataFrame([(i, *p) for i, p in enumerate(PERSONAS)], ["i", *SCORING_COLUMNS])
    scored = scoring.score_customers(people, scorer).orderBy("i").collect()
    low, medium, high = [r["churn_probability"] for r in scored]
    assert low < medium < high
    assert scored[0]["risk_level"] == "Low" and scored[2]["risk_level"] == "High"
    with pytest.raises(ValueError, match="missing required feature: age"):
        scoring.score_customers(people.drop("age"), scorer)


def test_scoring_does_not_shuffle(customers, scorer):
    assert "Exchange" not in plan_of(scoring.score_customers(customers, scorer))


def test_candidates_and_grid(frame):
    small = {models.FOREST: {"trees": 10, "max_depth": 5}, models.BOOSTED: {"trees": 5, "max_depth": 3}, models.SVM: {"dimensions": 64}}
    metrics, fitted = models.compare_models(frame, overrides=small)
    rows = metrics.collect()
    assert [r["Model"] for r in rows] == models.COMPARED and set(fitted) == set(models.COMPARED)
    assert all(0.65 < r["ROC-AUC"] < 1 for r in rows)
    best = models.best_model(metrics).first()
    assert best["ROC-AUC"] == max(r["ROC-AUC"] for r in rows)
    tuned = models.grid_search(
        frame, models.CANDIDATES[models.BOOSTED], {"trees": [2, 4], "max_depth": [2]}, weights=(1.0, 2.0), folds=5
    )
    assert tuned.results.count() == 4 and tuned.cv_auc == max(r["cv_auc"] for r in tuned.results.collect())
    assert set(tuned.parameters) == {"trees", "max_depth", "positive_weight"}


def test_folds_with_their_own_preprocessing(frame):
    own, shared = (
        models.grid_search(frame, models.CANDIDATES[models.LOGISTIC], {"C": [0.1, 1.0]}, prefit=p) for p in (False, True)
    )
    assert own.results.count() == shared.results.count() == 2 and own.cv_auc > 0.7
    assert own.cv_auc == pytest.approx(shared.cv_auc, abs=0.02)


def test_training_rows_do_not_follow_the_session(spark, customers):
    """The same rows in the same partitions and order, however they were read."""
    placed = [models._placed(customers.repartition(n).select("customer_id"), 3) for n in (1, 7)]
    parts = [[(r["p"], r["customer_id"]) for r in df.select(F.spark_partition_id().alias("p"), "customer_id").collect()] for df in placed]
    assert parts[0] == parts[1] and {p for p, _ in parts[0]} == {0, 1, 2}


def test_a_category_of_many_values_fits(spark):
    df = spark.range(5000).select(F.format_string("place %05d", "id").alias("geography"), (F.col("id") % 2).alias("flag"))
    counts = preprocess.value_counts(df.unionByName(df.limit(7)), ["geography", "flag"])
    assert len(preprocess.categories(counts, ["geography"])["geography"]) == 5000
    assert preprocess.modes(counts)["geography"] == "place 00000"


def test_importance_of_a_model(customers, frame, scorer):
    rows = models.importance(frame, scorer.stages[-1], repeats=3).collect()
    assert len(rows) == 16
    names = [r["feature"] for r in sorted(rows, key=lambda r: -r["importance_mean"])]
    assert "age" in names[:6]


def entry(spark, version, auc, active):
    return spark.createDataFrame([(version, datetime(2026, 1, 1), 10, auc, "m", "p", active)], MODEL_REGISTRY)


def test_registry_rules(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert registry.next_version(registry.read_registry(spark, path)).first()[0] == "v1"
    assert registry.register(spark, path, 0.8, 10, "m", "p", "v1")
    assert not registry.register(spark, path, 0.8, 10, "m", "p", "v2")  # equal is not better
    assert registry.register(spark, path, 0.7, 10, "m", "p", "v9", registry.FORCE)
    assert registry.register(spark, path, 0.75, 10, "m", "p", "v10")
    now = registry.read_registry(spark, path)
    assert {r["version"]: r["is_active"] for r in now.collect()} == {"v1": 0, "v9": 0, "v10": 1}
    assert registry.next_version(now).first()[0] == "v11"
    assert registry.active_card(now).first()["roc_auc"] == "0.7500"


def test_a_registry_that_cannot_be_read_is_not_empty(spark, tmp_path):
    path = tmp_path / "registry"
    assert registry.read_registry(spark, str(path)).count() == 0
    assert registry.register(spark, str(path), 0.8, 10, "m", "p", "v1")
    broken = next(path.glob("snapshot=00000001/*.parquet"))
    broken.write_bytes(b"no parquet")
    with pytest.raises(Exception):
        registry.register(spark, str(path), 0.9, 10, "m", "p", "v2")
    assert [p.name for p in path.glob("snapshot=*")] == ["snapshot=00000001"]


def test_two_writers_do_not_share_a_snapshot(spark, tmp_path):
    path = str(tmp_path / "registry")
    assert registry._claim(spark, path, 1) and not registry._claim(spark, path, 1)
    assert registry.register(spark, path, 0.8, 10, "m", "p", "v1")
    assert [p.name for p in (tmp_path / "registry").glob("snapshot=*")] == ["snapshot=00000002"]
    assert registry.read_registry(spark, path).count() == 1


def test_the_card_without_a_model(spark):
    assert tuple(registry.active_card(spark.createDataFrame([], MODEL_REGISTRY)).first()) == ("v1", "N/A", "10,000", "0.8818")


def test_retrain_accepts_then_rejects(spark, customers, tmp_path):
    small = {"names": [models.LOGISTIC], "grids": {models.LOGISTIC: {"C": [0.1, 1.0]}}, "folds": 3}
    where = (str(tmp_path / "registry"), str(tmp_path / "models"))
    kept = {"events_path": str(tmp_path / "events"), "metrics_path": str(tmp_path / "metrics")}
    first = retrain.retrain(customers, *where, **small, **kept)
    assert first.updated and first.message.startswith("Updated to v1")
    second = retrain.retrain(customers, *where, **small, **kept)
    events = spark.read.parquet(kept["events_path"])
    assert events.where("event = 'started'").count() == 2 and events.where("event = 'rejected'").count() == 1
    assert spark.read.parquet(kept["metrics_path"]).count() == 1
    assert not second.updated and second.message.startswith("Retained v1")
    assert "rejected" in [r["event"] for r in second.events.collect()]
    forced = retrain.retrain(customers, *where, mode=registry.FORCE, **small)
    assert forced.message.startswith("Updated to v2")
    model = scoring.load_active_model(spark, where[0])
    drift = scoring.drift_of_model(customers, model).first()
    assert drift["recent_rows"] == 100 and 0 < drift["recent_mean"] < 1
    log = str(tmp_path / "log")
    scoring.append_predictions(scoring.score_customers(customers, model), log)
    logged = spark.read.parquet(log)
    assert logged.drop("day").schema.names == PREDICTIONS.names and logged.select("prediction_id").distinct().count() == customers.count()


def test_retrain_needs_a_hundred_rows(customers, tmp_path):
    few = retrain.retrain(customers.limit(99), str(tmp_path / "r"), str(tmp_path / "m"))
    assert (few.updated, few.message) == (False, "Insufficient data")


def test_requests_are_scored_on_a_stream(spark, scorer, tmp_path):
    folder, log, checkpoint = tmp_path / "requests", str(tmp_path / "log"), str(tmp_path / "checkpoint")
    folder.mkdir()
    people = spark.createDataFrame(PERSONAS, SCORING_COLUMNS)
    lines = [r[0] for r in people.select(F.to_json(F.struct("*"))).collect()]

    def run():
        query = scoring_stream.stream_scores(scoring_stream.read_requests(spark, str(folder)), scorer, log, checkpoint)
        assert query.awaitTermination(120)

    (folder / "1.json").write_text("\n".join([*lines, '{"age": "x"}']) + "\n")
    run()
    assert spark.read.parquet(log).count() == 3
    (folder / "2.json").write_text(lines[2] + "\n")
    run()
    run()
    logged = spark.read.parquet(log)
    assert logged.count() == 4 and logged.where("risk_level = 'High'").count() == 2


def test_refused_requests_keep_their_reason(spark, tmp_path):
    folder, rejects = tmp_path / "requests", str(tmp_path / "rejects")
    folder.mkdir()
    people = spark.createDataFrame(PERSONAS, SCORING_COLUMNS)
    good = [r[0] for r in people.select(F.to_json(F.struct("*"))).collect()]
    (folder / "1.json").write_text("\n".join([*good, '{"age": "x", "tenure": 3}', "no json"]) + "\n")
    requests = scoring_stream.read_requests(spark, str(folder))
    assert scoring_stream.stream_refused(requests, rejects, str(tmp_path / "checkpoint")).awaitTermination(120)
    rows = {r["request"]: r["reason"] for r in spark.read.parquet(rejects).collect()}
    assert set(rows) == {'{"age": "x", "tenure": 3}', "no json"}
    assert "age" in rows['{"age": "x", "tenure": 3}'] and "tenure" not in rows['{"age": "x", "tenure": 3}']


def saved(spark, folder, frame, scorer, version, model):
    """Register a version; its files lie beside the registry."""
    PipelineModel(stages=[model]).write().overwrite().save(f"{folder}/{version}")
    frame.preprocessor.write().overwrite().save(f"{folder}/p")
    registry.register(spark, f"{folder}/registry", 0.5, 10, f"{folder}/{version}", f"{folder}/p", version, registry.FORCE)


@pytest.fixture
def followed(spark, frame, scorer, tmp_path):
    """A folder, a writer of request files, and a run of the following stream."""
    requests = tmp_path / "requests"
    requests.mkdir()
    people = spark.createDataFrame(PERSONAS, SCORING_COLUMNS)
    lines = [r[0] for r in people.select(F.to_json(F.struct("*"))).collect()]

    def ask(name, *which):
        (requests / name).write_text("\n".join(lines[i] if i >= 0 else "no json" for i in which) + "\n")

    def run():
        stream = scoring_stream.read_requests(spark, str(requests), max_files=1)
        query = scoring_stream.stream_followed(stream, f"{tmp_path}/registry", str(tmp_path), f"{tmp_path}/checkpoint")
        assert query.awaitTermination(180)

    saved(spark, tmp_path, frame, scorer, "v1", scorer.stages[-1])
    return str(tmp_path), ask, run


def kept_equal_counted(spark, folder):
    log, kept = scoring_stream.read_log(spark, folder), scoring_stream.read_counts(spark, folder)
    for of_counts, of_log in (
        (score_counts.high_risk_count, reports.high_risk_count),
        (score_counts.risk_distribution, reports.risk_distribution),
        (score_counts.probability_histogram, reports.probability_histogram),
    ):
        assert sorted(map(tuple, of_counts(kept).collect())) == sorted(map(tuple, of_log(log).collect()))


def test_counts_follow_the_log_over_batches_and_a_swap(spark, frame, scorer, followed):
    folder, ask, run = followed
    assert scoring_stream.read_log(spark, folder).count() == 0 and scoring_stream.read_counts(spark, folder).count() == 0
    for i, which in enumerate([(0, 1), (2, -1), (1, 2, 2), (0,), (2, 1)]):
        ask(f"{i}.json", *which)
    run()
    kept_equal_counted(spark, folder)
    assert len(scoring_stream.counted_batches(spark, folder)) == scoring_stream.KEPT_SNAPSHOTS
    other = models.fit_candidate(frame, models.CANDIDATES[models.LOGISTIC], C=0.001)
    saved(spark, folder, frame, scorer, "v2", other)
    ask("9.json", 0, 1, 2)
    run()
    run()  # nothing new
    kept_equal_counted(spark, folder)
    versions = {r["model_version"]: r["count"] for r in scoring_stream.read_log(spark, folder).groupBy("model_version").count().collect()}
    assert versions == {"v1": 9, "v2": 3}
    assert [r["reason"][:15] for r in scoring_stream.read_refused(spark, folder).collect()] == ["no usable value"]
    days = score_counts.between(scoring_stream.read_counts(spark, folder), first_day=date(2999, 1, 1))
    assert score_counts.high_risk_count(days).first()[0] == 0


def test_a_batch_that_failed_or_is_replayed_counts_once(spark, scorer, followed, monkeypatch):
    folder, ask, run = followed
    ask("0.json", 0, 1, 2)
    people = scoring_stream.parse_scoring_json(spark.read.text(f"{folder}/requests").withColumn("request", F.col("value")))
    monkeypatch.setattr(scoring_stream, "merged", lambda before, more: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        scoring_stream.score_batch(people, folder, "v1", scorer, 0)
    assert scoring_stream.read_log(spark, folder).count() == 0  # rows without a snapshot are not seen
    monkeypatch.undo()
    for _ in range(2):
        scoring_stream.score_batch(people, folder, "v1", scorer, 0)
        assert scoring_stream.read_log(spark, folder).count() == 3
        kept_equal_counted(spark, folder)


def test_the_list_of_high_risks_reads_its_own_folders(spark, scorer, followed):
    folder, ask, run = followed
    ask("0.json", 0, 1, 2)
    run()
    high = reports.high_risk(scoring_stream.read_log(spark, folder))
    assert high.count() == 1
    filters = plan_of(high).split("PartitionFilters: [")[1].split("]")[0]
    assert "risk_level" in filters


def test_the_model_is_loaded_once_per_version(spark, scorer, followed, monkeypatch):
    folder, ask, run = followed
    loaded = []
    monkeypatch.setattr(scoring_stream, "load_model", lambda row: loaded.append(row["version"]) or scorer)
    for i in range(3):
        ask(f"{i}.json", 0)
    run()
    assert loaded == ["v1"]
