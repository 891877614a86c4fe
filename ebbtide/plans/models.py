"""Candidate classifiers, their comparison and their tuning."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import product
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ebbtide.operators.blocks import ALL, auc_by_setting, to_blocks
from ebbtide.operators.importance import permutation_importance
from ebbtide.operators.linear import KernelTrainer, LogisticTrainer
from ebbtide.operators.metrics import classification_metrics, roc_auc
from ebbtide.operators.preprocess import ChurnPreprocessorModel, EngineeredFeatures, fit_parts
from ebbtide.operators.splits import FOLDS, split_rule, with_folds
from ebbtide.operators.trees import BoostedTrainer, ForestTrainer
from ebbtide.schemas import MODEL_METRICS
from ebbtide.session import ensure_checkpoint_dir

SEED = 42
LABEL = "exited"

LOGISTIC = "Logistic Regression"
FOREST = "Random Forest"
SVM = "SVM"
BOOSTED = "Gradient Boosting (weighted)"
BOOSTED_PLAIN = "Gradient Boosting"


@dataclass(frozen=True)
class Candidate:
    """A classifier: its trainer, what it is given by default, and the values tried in tuning.

    A trainer has fit(blocks, **setting) and cross_scores(blocks, parts, settings); see operators.blocks.
    `weights` are the weights of positive rows that are tried, for a trainer that has them.
    """

    name: str
    trainer: Any
    defaults: dict[str, Any] = field(default_factory=dict)
    grid: dict[str, list] = field(default_factory=dict)
    weights: tuple[float, ...] | None = None


# Default parameters and tuning grids of each candidate.
CANDIDATES = {
    LOGISTIC: Candidate(LOGISTIC, LogisticTrainer(), grid={"C": [0.01, 0.1, 1.0, 10.0]}),
    FOREST: Candidate(
        FOREST, ForestTrainer(SEED), grid={"trees": [100, 150], "max_depth": [8, 12, None], "min_split": [2, 5]}
    ),
    SVM: Candidate(SVM, KernelTrainer(SEED), grid={"C": [0.1, 1.0, 10.0], "gamma": ["scale", "auto"]}),
    BOOSTED: Candidate(
        BOOSTED,
        BoostedTrainer(),
        defaults={"trees": 150, "max_depth": 5, "rate": 0.05, "positive_weight": 1.5},
        grid={"trees": [100, 150], "max_depth": [4, 5], "rate": [0.05, 0.1]},
        weights=(1.0, 1.5, 2.0),
    ),
    BOOSTED_PLAIN: Candidate(
        BOOSTED_PLAIN,
        BoostedTrainer(penalty=0.0, least=0.001),
        defaults={"trees": 100, "max_depth": 5, "rate": 0.1},
        grid={"trees": [100, 150], "max_depth": [3, 5], "rate": [0.05, 0.1]},
    ),
}
RETRAIN_LOGISTIC_GRID = {"C": [0.1, 1.0, 10.0]}
COMPARED = [LOGISTIC, FOREST, SVM, BOOSTED]


@dataclass
class TrainingFrame:
    """Preprocessed rows: key, label, features, split; the fit saw training rows only.

    `blocks` holds the training rows as numbers, by part: all of them, and for each fold as what the other
    folds know encodes them.
    """

    preprocessor: PipelineModel
    rows: DataFrame
    n_train: int
    n_total: int
    partitions: int
    folds: int
    raw: DataFrame  # engineered rows with split and fold
    blocks: DataFrame

    def release(self) -> None:
        for df in (self.rows, self.raw, self.blocks):
            df.unpersist()

    @property
    def encoder(self) -> ChurnPreprocessorModel:
        return self.preprocessor.stages[-1]

    @property
    def train(self) -> DataFrame:
        return self.rows.where("split = 'train'")

    @property
    def test(self) -> DataFrame:
        return self.rows.where("split = 'test'")

    def prefit_blocks(self) -> DataFrame:
        """Blocks whose folds are all encoded by what the whole training part knows."""
        return _blocks(self.raw, dict.fromkeys(range(self.folds), self.encoder))


def _placed(df: DataFrame, partitions: int) -> DataFrame:
    """Rows placed by their key and in its order, wherever they were read."""
    return df.repartition(partitions, "customer_id").sortWithinPartitions("customer_id")


def _blocks(raw: DataFrame, encoders: dict[int, ChurnPreprocessorModel]) -> DataFrame:
    """Labelled training rows once per encoder, in one pass; a checkpoint ends their lineage."""
    parts = [
        F.struct(F.lit(part).alias("part"), F.array(*[c.cast("double") for c in e.columns().values()]).alias("features"))
        for part, e in encoders.items()
    ]
    train = raw.where((F.col("split") == "train") & F.col(LABEL).isNotNull())
    label = F.col(LABEL).cast("double").alias("label")
    wide = train.select(F.xxhash64("customer_id").alias("place"), label, "fold", F.explode(F.array(*parts)).alias("p"))
    return to_blocks(wide.select("place", "label", "fold", "p.*")).checkpoint().persist()


def training_frame(customers: DataFrame, folds: int | None = None, partitions: int | None = None) -> TrainingFrame:
    """Split, fit the preprocessors of the training part and of all folds, transform, keep what fits need.

    Rows lie in as many partitions as there are cores, unless a number is given. Trees do not depend on
    it; sums of other fits do in their last bits.
    """
    spark = customers.sparkSession
    partitions = partitions or max(4, spark.sparkContext.defaultParallelism)
    split = customers.withColumn("split", split_rule(customers, LABEL))
    train = split.where("split = 'train'")
    train = with_folds(train, LABEL, folds=folds) if folds else train.withColumn("fold", F.lit(0))
    # every step of a fit ships its lineage to the tasks; a checkpoint keeps it short
    ensure_checkpoint_dir(spark)
    both = train.unionByName(split.where("split = 'test'").withColumn("fold", F.lit(-1)))
    raw = _placed(EngineeredFeatures().transform(both), partitions).checkpoint().persist()
    counts = {r["split"]: r["count"] for r in raw.groupBy("split").count().collect()}
    conditions = {ALL: F.col("fold") >= 0, **{k: F.col("fold") != k for k in range(folds or 0)}}
    encoders = fit_parts(raw.where("split = 'train'"), conditions)
    encoder = encoders[ALL]
    label = F.col(LABEL).cast("double").alias(LABEL)
    rows = encoder.transform(raw).select("customer_id", label, "split", "fold", "features").persist()
    blocks = _blocks(raw, encoders)
    return TrainingFrame(
        PipelineModel([EngineeredFeatures(), encoder]), rows, counts.get("train", 0), sum(counts.values()), partitions, folds or 0, raw, blocks
    )


def fit_candidate(frame: TrainingFrame, candidate: Candidate, **parameters: Any) -> Model:
    return candidate.trainer.fit(frame.blocks, **{**candidate.defaults, **parameters})


def score(model: Model, rows: DataFrame) -> DataFrame:
    """Key, label, class and P(churn): all that metrics need, computed once."""
    return model.transform(rows).select(
        "customer_id", LABEL, "prediction", vector_to_array("probability")[1].alias("probability")
    )


def measure(name: str, scored: DataFrame) -> DataFrame:
    """One row of metrics. The scores are kept while they are read, so the model runs once."""
    scored = scored.persist()
    auc = roc_auc(scored, LABEL, "probability").scalar()
    columns = MODEL_METRICS.fieldNames()
    row = classification_metrics(scored, LABEL).select(F.lit(name).alias("Model"), "*", auc.alias("ROC-AUC")).select(columns).first()
    scored.unpersist()
    return scored.sparkSession.createDataFrame([row], MODEL_METRICS)


def compare_models(
    frame: TrainingFrame,
    names: list[str] | None = None,
    overrides: dict[str, dict] | None = None,
    parallelism: int = 4,
) -> tuple[DataFrame, dict[str, Model]]:
    """Measured metrics of every candidate on the test part, and the fitted models.

    Candidates are fitted side by side, so one with many small jobs does not hold up others.
    """
    names = names or COMPARED
    spark = frame.rows.sparkSession

    def run(name: str) -> tuple[Model, Row]:
        model = fit_candidate(frame, CANDIDATES[name], **(overrides or {}).get(name, {}))
        return model, measure(name, score(model, frame.test)).first()

    with ThreadPoolExecutor(min(parallelism, len(names))) as pool:
        done = list(pool.map(inheritable_thread_target(spark)(run), names))
    rows = [row for _, row in done]
    return spark.createDataFrame(rows, MODEL_METRICS), {n: model for n, (model, _) in zip(names, done)}


def best_model(metrics: DataFrame, position: str | None = None) -> DataFrame:
    """The row of the highest ROC-AUC; the first of equals, by name if no position is given."""
    return metrics.orderBy(F.desc("ROC-AUC"), F.asc(position or "Model")).limit(1)


def auc_ranking(metrics: DataFrame) -> DataFrame:
    return metrics.select("Model", "ROC-AUC").orderBy(F.desc("ROC-AUC"), "Model")


def precision_vs_recall(metrics: DataFrame) -> DataFrame:
    return metrics.select("Model", "Precision", "Recall")


@dataclass
class Tuned:
    parameters: dict[str, Any]
    cv_auc: float
    results: DataFrame
    model: Model


def grid_search(
    frame: TrainingFrame,
    candidate: Candidate,
    grid: dict[str, list] | None = None,
    weights: tuple[float, ...] | None = None,
    folds: int = FOLDS,
    prefit: bool = False,
) -> Tuned:
    """Cross-validated search by ROC-AUC over the frame's folds, then a fit on all training rows.

    All settings and folds are fitted side by side. Each fold is preprocessed by what its training rows
    alone tell; with `prefit` all share the frame's preprocessing, fitted on the whole training part.
    """
    if folds != frame.folds:
        raise ValueError(f"the training frame has {frame.folds} folds, not {folds}")
    grid = candidate.grid if grid is None else grid
    weights = candidate.weights if weights is None else weights
    weighed = [{"positive_weight": w} for w in weights] if weights else [{}]
    settings = [{**dict(zip(grid, values)), **w} for w in weighed for values in product(*grid.values())]
    blocks = frame.prefit_blocks() if prefit else frame.blocks.where(F.col("part") != ALL)
    scores = candidate.trainer.cross_scores(blocks, list(range(folds)), [{**candidate.defaults, **s} for s in settings])
    aucs = auc_by_setting(scores)
    results = [(s, aucs[i]) for i, s in enumerate(settings)]
    parameters, cv_auc = max(results, key=lambda r: r[1])  # the first of equals
    if prefit:
        blocks.unpersist()
    spark = frame.rows.sparkSession
    table = spark.createDataFrame([(str(p), float(mean)) for p, mean in results], "parameters string, cv_auc double")
    return Tuned(parameters, float(cv_auc), table, fit_candidate(frame, candidate, **parameters))


def importance(frame: TrainingFrame, model: Model, **options: Any) -> DataFrame:
    """Permutation importance of the encoded columns on the test part."""
    names = frame.encoder.feature_names()
    values = vector_to_array("features")
    test = frame.test.select("customer_id", LABEL, *[values[i].alias(f"f_{n}") for i, n in enumerate(names)])
    assembler = frame.encoder.assembler()
    found = permutation_importance(
        test, [f"f_{n}" for n in names], lambda df: model.transform(assembler.transform(df)), LABEL, **options
    )
    return found.withColumn("feature", F.regexp_replace("feature", "^f_", ""))
