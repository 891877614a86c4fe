"""Every query by name, over the derived tables of a test folder."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import cache, partial, reduce

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions.checks import surely_invalid, surely_valid, violations
from ebbtide.functions.features import ENGINEERED, add_engineered_features
from ebbtide.operators import cleaning, drift, eda, importance, ingest, joins, metrics, preprocess, reports, score_counts, sparse_encode, splits
from ebbtide.plans import exports, models, registry, retrain_queue, scoring
from ebbtide.plans import retrain as retraining
from ebbtide.schemas import CHURN_RAW, CUSTOMER_COLUMNS, MODEL_REGISTRY, RAW_TO_CUSTOMER, SCORING_COLUMNS
from ebbtide.session import shared_dir
from ebbtide.sources import batches, derived
from ebbtide.streaming import ingest_stream, scoring_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def on(table: str, transform: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: transform(derived.table(spark, sf, table))


def scratch(spark: SparkSession, sf: str, name: str) -> str:
    return shared_dir(spark, sf.strip("/").replace("/", "_"), name)


def gaps_as_double(df: DataFrame, column: str = "CreditScore") -> DataFrame:
    """Whole numbers with gaps differ between engines on the way out; doubles do not."""
    return df.withColumn(column, F.col(column).cast("double"))


# --- sources and sinks -------------------------------------------------------------------

QUERIES["scan_customers"] = on("customers", lambda df: df)


@query
def scan_raw(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch(spark, sf, "churn_raw_csv")
    exports.write_csv(derived.table(spark, sf, "churn_raw"), path)
    return gaps_as_double(spark.read.schema(CHURN_RAW).option("header", True).csv(path))


@query
def parse_scoring_json(spark: SparkSession, sf: str) -> DataFrame:
    customers = derived.table(spark, sf, "customers")
    fields = [c for c in CUSTOMER_COLUMNS if c not in ("customer_id", "exited")]
    # every other record sends its age as text, some lack a salary
    record = [F.col(c) for c in fields if c not in ("age", "estimated_salary")]
    odd = F.col("customer_id") % 2 == 1
    numbers = F.to_json(F.struct(*record, "age", "estimated_salary"))
    texts = F.to_json(F.struct(*record, F.col("age").cast("string").alias("age"), "estimated_salary"))
    partial = F.to_json(F.struct(*record, "age"))
    value = F.when(F.col("customer_id") % 10 == 7, partial).when(odd, texts).otherwise(numbers)
    return batches.parse_scoring_json(customers.select("customer_id", value.alias("value")))


def _read_reports(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    schema = "segment string, total_customers long, churned_customers long, churn_rate_pct double"
    parts = [
        spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(f"{folder}/{n}")
        .select(F.lit(n).alias("report"), "*")
        for n in names
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


@query
def export_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch(spark, sf, "exports")
    names = exports.export_reports(derived.table(spark, sf, "customers"), folder)
    return _read_reports(spark, folder, [n for n in names if n != "balance_churn"])


@query
def bi_exports(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch(spark, sf, "bi")
    customers = derived.table(spark, sf, "customers")
    names = exports.export_bi(customers, folder)
    master = spark.read.schema(customers.schema).option("header", True).csv(f"{folder}/churn_master")
    counted = master.agg(
        F.lit("churn_master").alias("report"),
        F.lit("all").alias("segment"),
        F.count("*").alias("total_customers"),
        F.sum("exited").alias("churned_customers"),
        reports.rate_pct(F.avg("exited")).alias("churn_rate_pct"),
    )
    return _read_reports(spark, folder, [n for n in names if n.endswith("_summary")]).unionByName(counted)


QUERIES["prediction_history"] = on("predictions", reports.prediction_history)
QUERIES["check_violations"] = on(
    "batch_rows",
    lambda df: df.select("file_name", "rn", F.array_join(violations(), ",").alias("violations")).where("violations <> ''"),
)

# --- projections and validation ------------------------------------------------------------


@query
def normalize_batch(spark: SparkSession, sf: str) -> DataFrame:
    raw = derived.table(spark, sf, "churn_raw")
    odd_case = raw.select(*[F.col(c).alias(c.upper() if i % 2 else c) for i, c in enumerate(reversed(raw.columns))])
    return gaps_as_double(batches.normalize_batch(odd_case), "credit_score")


QUERIES["localize_geography"] = on("churn_raw", lambda df: cleaning.localize_geography(df).select("RowNumber", "Geography"))
QUERIES["scale_money"] = on("churn_raw", lambda df: cleaning.scale_money(df).select("RowNumber", "Balance", "EstimatedSalary"))
QUERIES["features"] = on("customers", lambda df: add_engineered_features(df).select("customer_id", *ENGINEERED))
QUERIES["risk_bands"] = on(
    "scored",
    lambda df: scoring.with_risk(df.withColumn("p", F.col("churn_probability") / 100), "p").select(
        "customer_id", "churn_probability", "risk_level", "color_class"
    ),
)
QUERIES["kpi_formatted"] = on("customers", reports.kpi_cards)
for _column, _raw, _key in (("age", "Age", "age"), ("balance", "Balance", "balance"), ("credit_score", "CreditScore", "credit")):
    QUERIES[f"validate_{_key}"] = on(
        "churn_raw",
        lambda df, c=_column, r=_raw: cleaning.drop_out_of_range(gaps_as_double(df), c, r).select("RowNumber", r),
    )


@query
def range_validations(spark: SparkSession, sf: str) -> DataFrame:
    df = derived.table(spark, sf, "churn_raw").withColumnsRenamed(RAW_TO_CUSTOMER)
    invalid = surely_invalid("age") | surely_invalid("balance") | surely_invalid("credit_score")
    return df.select("RowNumber", (~invalid).alias("kept_by_cleaning"), surely_valid().alias("kept_by_ingest"))


# --- cleaning ------------------------------------------------------------------------------

QUERIES["null_counts"] = on("churn_raw", lambda df: cleaning.null_counts(cleaning.localize_geography(df)))
QUERIES["fill_missing"] = on("churn_raw", cleaning.prepare)
QUERIES["duplicate_rows"] = on("churn_raw", lambda df: gaps_as_double(cleaning.duplicate_rows(df, "CustomerId")))
QUERIES["dedup_keep_first"] = on("churn_raw", lambda df: gaps_as_double(cleaning.keep_first(df, "CustomerId", "RowNumber")))
QUERIES["cleaning_report"] = on("churn_raw", cleaning.cleaning_report)
QUERIES["clean_customers"] = on("churn_raw", cleaning.clean_customers)

# --- joins -----------------------------------------------------------------------------------


@query
def new_records_anti(spark: SparkSession, sf: str) -> DataFrame:
    rows = derived.table(spark, sf, "batch_rows")
    return ingest.new_records(rows, derived.table(spark, sf, "customers")).select("file_name", "rn", "customer_id")


@query
def fact_with_geo_summary(spark: SparkSession, sf: str) -> DataFrame:
    customers = derived.table(spark, sf, "customers")
    summary = reports.GEOGRAPHY_SUMMARY.of(customers)
    fact = customers.select("customer_id", "geography", "exited")
    return joins.with_segment_summary(fact, summary, "geography", "geo_")


@query
def fact_with_product_summary(spark: SparkSession, sf: str) -> DataFrame:
    customers = derived.table(spark, sf, "customers")
    summary = reports.PRODUCT_SUMMARY.of(customers)
    fact = customers.select("customer_id", "num_products", "exited")
    return joins.with_segment_summary(fact, summary, "num_products", "product_")


# --- reports -----------------------------------------------------------------------------------

for _name, _report in {
    "churn_by_geography": reports.CHURN_BY_GEOGRAPHY,
    "churn_by_age_group": reports.CHURN_BY_AGE_GROUP,
    "churn_by_products": reports.CHURN_BY_PRODUCTS,
    "churn_by_credit_band": reports.CHURN_BY_CREDIT_BAND,
    "credit_score_summary": reports.CREDIT_SCORE_SUMMARY,
    "churn_by_active": reports.CHURN_BY_ACTIVE,
    "churn_by_tenure": reports.CHURN_BY_TENURE,
    "churn_by_gender": reports.CHURN_BY_GENDER,
}.items():
    QUERIES[_name] = on("customers", _report.of)
QUERIES["balance_by_exited"] = on("customers", reports.balance_by_exited)
QUERIES["kpis"] = on("customers", reports.kpis)
QUERIES["dashboard_geography"] = on("customers", reports.dashboard_geography)
QUERIES["dashboard_age"] = on("customers", reports.dashboard_age)
QUERIES["dashboard_products"] = on("customers", reports.dashboard_products)
QUERIES["credit_band_by_exited"] = on("customers", reports.credit_band_by_exited)
QUERIES["exited_distribution"] = on("customers", reports.exited_distribution)
QUERIES["geography_rate_raw"] = on(
    "customers", lambda df: reports.geography_rate_raw(df).withColumn("rate", F.round("rate", 6))
)
QUERIES["bi_measures"] = on("customers", reports.bi_measures)
QUERIES["customers_by_geography"] = on("customers", reports.customers_by_geography)
QUERIES["sliced_kpis"] = on(
    "customers",
    lambda df: reports.bi_measures(
        reports.sliced(df, geography=["Maharashtra", "Delhi"], gender=["Female"], age_group=["30-45", "45-60"])
    ),
)
QUERIES["drill_through"] = on(
    "customers", lambda df: reports.drill_through(df, geography="Karnataka", age_group="45-60", credit_band="600-700")
)
QUERIES["high_risk_customers"] = on("predictions", lambda df: reports.prediction_history(reports.high_risk(df)))
QUERIES["high_risk_count"] = on("predictions", reports.high_risk_count)
QUERIES["risk_distribution"] = on("predictions", reports.risk_distribution)
QUERIES["probability_histogram"] = on("predictions", reports.probability_histogram)


@query
def sliced_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return reports.sliced_predictions(
        reports.prediction_history(derived.table(spark, sf, "predictions")),
        risk_level=["High", "Medium"],
        geography=["Karnataka"],
        first_day=date(2024, 1, 5),
        last_day=date(2024, 1, 20),
    )


# --- exploration ---------------------------------------------------------------------------------

QUERIES["correlation_matrix"] = on("customers", eda.correlation_matrix)
QUERIES["credit_box_stats"] = on("customers", eda.box_stats)
QUERIES["credit_outliers"] = on(
    "customers", lambda df: eda.outliers(df).select("customer_id", "credit_score", "exited")
)
QUERIES["products_outliers"] = on(
    "customers", lambda df: eda.outliers(df, "num_products").select("customer_id", "num_products", "exited")
)
QUERIES["kde_age"] = on(
    "customers",
    lambda df: eda.kde(df, "age").withColumns({"x": F.round("x", 3), "density": F.round("density", 8)}),
)
QUERIES["kde_balance"] = on(
    "customers",
    lambda df: eda.kde(df, "balance").withColumns({"x": F.round("x", 1), "density": F.round(F.col("density") * 1e6, 8)}),
)
QUERIES["balance_histogram"] = on("customers", lambda df: eda.histogram(df, "balance", 1_000_000))
QUERIES["salary_balance_bins"] = on("customers", lambda df: eda.salary_balance_bins(df, 2_000_000, 1_000_000))
QUERIES["latest_100"] = on("customers", drift.latest)

# --- preprocessing -----------------------------------------------------------------------------


def _unfilled(raw: DataFrame) -> DataFrame:
    """Customers before any fill or filter, with their engineered columns."""
    return add_engineered_features(cleaning.to_customers(cleaning.scale_money(cleaning.localize_geography(raw))))


@query
def impute_numeric(spark: SparkSession, sf: str) -> DataFrame:
    df = _unfilled(derived.table(spark, sf, "churn_raw"))
    medians = preprocess.fit_medians(df)
    imputed = [preprocess.imputed_numeric(c, medians[c]).alias(c) for c in preprocess.NUMERIC]
    return df.select("customer_id", *imputed)


@query
def scale_numeric(spark: SparkSession, sf: str) -> DataFrame:
    df = _unfilled(derived.table(spark, sf, "churn_raw"))
    medians = preprocess.fit_medians(df)
    scales = preprocess.fit_scales(df, medians)
    scaled = [
        F.round((preprocess.imputed_numeric(c, medians[c]) - scales[c][0]) / scales[c][1], 6).alias(c)
        for c in preprocess.NUMERIC
    ]
    return df.select("customer_id", *scaled)


@query
def impute_mode(spark: SparkSession, sf: str) -> DataFrame:
    df = _unfilled(derived.table(spark, sf, "churn_raw"))
    columns = preprocess.CATEGORICAL + preprocess.BINARY
    modes = preprocess.modes(preprocess.value_counts(df, columns))
    return df.select("customer_id", *[F.coalesce(F.col(c).cast("string"), F.lit(modes.get(c))).alias(c) for c in columns])


def _encoded(spark: SparkSession, sf: str) -> tuple[DataFrame, preprocess.ChurnPreprocessorModel]:
    df = splits.stratified_split(add_engineered_features(derived.table(spark, sf, "customers")))
    return df, preprocess.ChurnPreprocessor().fit(df.where("split = 'train'"))


@query
def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    df = _unfilled(derived.table(spark, sf, "churn_raw"))
    encoder = preprocess.ChurnPreprocessor().fit(df)
    hot = [c.alias(n) for n, c in encoder.columns().items() if n.startswith(("geography_", "gender_"))]
    return df.select("customer_id", *hot)


@query
def feature_matrix(spark: SparkSession, sf: str) -> DataFrame:
    df, encoder = _encoded(spark, sf)
    wide = encoder.encoded(df, ["customer_id", "split"])
    return wide.select("customer_id", "split", *[F.round(c, 6).alias(c) for c in wide.columns if c.startswith("f_")])


@query
def sparse_features(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that have each feature of a sparse encoding, surnames among them, counted over the vectors."""
    raw = derived.table(spark, sf, "churn_raw")
    folder = scratch(spark, sf, f"sparse-{datetime.now():%Y%m%d%H%M%S%f}")
    fitted = sparse_encode.fit_dictionary(raw, ["Surname", "Geography", "Gender"], folder)
    encoded = sparse_encode.encode(raw.select("Surname", "Geography", "Gender"), fitted)
    held = vector_to_array(Summarizer.numNonZeros(F.col("features")))
    counted = encoded.agg(held.alias("n")).select(F.posexplode("n").alias("position", "n"))
    named = fitted.features().join(counted, "position")
    return named.select("column", "value", F.col("position").cast("long").alias("position"), F.col("n").cast("long").alias("n"))


QUERIES["stratified_split"] = on("customers", lambda df: splits.stratified_split(df).select("customer_id", "split"))
QUERIES["cv_folds"] = on("customers", lambda df: splits.with_folds(df).select("customer_id", "fold"))

# --- metrics -------------------------------------------------------------------------------------

QUERIES["classification_metrics"] = on("scored", metrics.classification_metrics)
QUERIES["confusion_matrix"] = on("scored", metrics.confusion_matrix)
QUERIES["classification_report"] = on("scored", metrics.classification_report)
QUERIES["roc_auc"] = on("scored", lambda df: metrics.roc_auc(df).withColumn("roc_auc", F.round("roc_auc", 6)))
QUERIES["roc_curve"] = on(
    "scored", lambda df: metrics.roc_curve(df).withColumns({"fpr": F.round("fpr", 6), "tpr": F.round("tpr", 6)})
)


@query
def score_drift(spark: SparkSession, sf: str) -> DataFrame:
    scored = derived.table(spark, sf, "scored")
    return drift.score_drift(drift.latest(scored), scored)


def _points() -> Column:
    """The closed-form score of `scored`, in per mille."""
    return F.expr(
        "LEAST(999, GREATEST(1, (age-18)*8 + 150*(1-is_active_member)"
        " + CASE WHEN num_products = 2 THEN 0 WHEN num_products = 1 THEN 120 ELSE 300 END"
        " + CASE WHEN geography = 'Karnataka' THEN 100 ELSE 0 END))"
    )


@query
def permutation_importance(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["age", "is_active_member", "num_products", "geography", "tenure"]
    found = importance.permutation_importance(
        derived.table(spark, sf, "customers"),
        columns,
        lambda df: df.withColumn("prediction", F.when(_points() >= 500, 1).otherwise(0)),
    )
    return found.withColumns({c: F.round(c, 6) for c in ("importance_mean", "importance_std")})


def _rule_candidates(scored: DataFrame) -> dict[str, DataFrame]:
    """Closed-form scores that stand in for fitted candidates."""
    rules = {
        "activity": (1 - F.col("is_active_member")) * 60.0,
        "age": F.col("age") * 1.0,
        "combined": F.col("churn_probability"),
    }
    return {
        name: scored.select(
            models.LABEL, F.when(p >= 50, 1).otherwise(0).alias("prediction"), p.cast("double").alias("probability")
        )
        for name, p in rules.items()
    }


def _rule_metrics(scored: DataFrame) -> DataFrame:
    measured = [models.measure(name, df) for name, df in _rule_candidates(scored).items()]
    table = measured[0]
    for part in measured[1:]:
        table = table.unionByName(part)
    return table.withColumn("ROC-AUC", F.round("ROC-AUC", 6))


QUERIES["measured_rules"] = on("scored", _rule_metrics)
QUERIES["best_model"] = on("scored", lambda df: models.best_model(_rule_metrics(df)))
QUERIES["auc_ranking"] = on("scored", lambda df: models.auc_ranking(_rule_metrics(df)))
QUERIES["precision_vs_recall"] = on("scored", lambda df: models.precision_vs_recall(_rule_metrics(df)))



@query
def metrics_table(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics as training stores them: the table is replaced, the BI copy is a CSV."""
    folder = scratch(spark, sf, "metrics")
    measured = _rule_metrics(derived.table(spark, sf, "scored"))
    exports.replace_table(measured, f"{folder}/model_metrics")
    stored = spark.read.parquet(f"{folder}/model_metrics")
    exports.write_csv(stored, f"{folder}/bi/model_metrics", single=True)
    copy = spark.read.schema(stored.schema).option("header", True).csv(f"{folder}/bi/model_metrics")
    return stored.withColumn("place", F.lit("table")).unionByName(copy.withColumn("place", F.lit("bi")))


@query
def saved_splits(spark: SparkSession, sf: str) -> DataFrame:
    """The split as it is saved for later runs, a folder per part."""
    folder = scratch(spark, sf, "splits")
    exports.save_splits(splits.stratified_split(derived.table(spark, sf, "customers")), folder)
    return spark.read.parquet(folder).select("customer_id", "exited", "split")


# --- registry ------------------------------------------------------------------------------------

QUERIES["next_version"] = on("registry", registry.next_version)
QUERIES["registry_active"] = on("registry", registry.active)
QUERIES["registry_card"] = on("registry", registry.active_card)
QUERIES["registry_card_without_model"] = on("registry", lambda df: registry.active_card(df.where("is_active > 1")))


@query
def registry_update(spark: SparkSession, sf: str) -> DataFrame:
    """A version trained on all customers is added and activated."""
    current = derived.table(spark, sf, "registry")
    scored = derived.table(spark, sf, "scored")
    size = scored.agg(F.count("*").alias("dataset_size"))
    auc = metrics.roc_auc(scored).select(F.round("roc_auc", 6)).scalar()
    version = registry.next_version(current).scalar()
    entry = size.select(
        version.alias("version"),
        F.lit(datetime(2026, 2, 1)).alias("training_date"),
        "dataset_size",
        auc.alias("roc_auc"),
        F.concat(F.lit("models/"), version, F.lit("/model")).alias("model_path"),
        F.concat(F.lit("models/"), version, F.lit("/preprocessor")).alias("preprocessor_path"),
        F.lit(1).alias("is_active"),
    )
    return registry.registered(current.select(MODEL_REGISTRY.fieldNames()), entry)


# --- ingest ----------------------------------------------------------------------------------------


def _ingested(spark: SparkSession, sf: str, mode: str) -> ingest.IngestResult:
    return ingest.ingest_batch(derived.table(spark, sf, "batch_rows"), derived.table(spark, sf, "customers"), mode)


@query
def ingest_batch(spark: SparkSession, sf: str) -> DataFrame:
    return _ingested(spark, sf, ingest.REJECT_FILE).rows


@query
def ingest_batch_drop_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _ingested(spark, sf, ingest.DROP_ROWS).rows


@cache
def _indexed(application: str, sf: str) -> str:
    """The customers as a table of batches with their index: a base, and a batch per other state."""
    spark = SparkSession.active()
    folder = scratch(spark, sf, f"indexed-{datetime.now():%Y%m%d%H%M%S%f}")
    customers = derived.table(spark, sf, "customers").select(CUSTOMER_COLUMNS)
    state = F.coalesce("geography", F.lit("Maharashtra"))
    ingest_stream.create_table(customers.where(state == "Maharashtra"), folder)
    for name in ("Karnataka", "Delhi"):
        ingest_stream.append_batch(customers.where(state == name), folder, name)
    return folder


@query
def new_records_by_index(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the batch files whose id no batch of the table has; only batches that may have one are opened."""
    table = _indexed(spark.sparkContext.applicationId, sf)
    rows = derived.table(spark, sf, "batch_rows")
    known = ingest_stream.rows_for(spark, table, [ingest_stream.FIRST, *ingest_stream.committed(spark, table)])
    return ingest.new_records(rows, known).select("file_name", "rn", "customer_id")


@query
def ingest_summary(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.ingest_summary(_ingested(spark, sf, ingest.REJECT_FILE).files)


# --- models ----------------------------------------------------------------------------------------


@cache
def _frame(application: str, sf: str) -> models.TrainingFrame:
    spark = SparkSession.active()
    return models.training_frame(derived.table(spark, sf, "customers"), folds=splits.FOLDS)


def frame(spark: SparkSession, sf: str) -> models.TrainingFrame:
    """The training frame of a folder, built and kept once per application."""
    return _frame(spark.sparkContext.applicationId, sf)


def _model_query(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        f = frame(spark, sf)
        return models.measure(name, models.score(models.fit_candidate(f, models.CANDIDATES[name]), f.test))

    return run


QUERIES["model_lr"] = _model_query(models.LOGISTIC)
QUERIES["model_rf"] = _model_query(models.FOREST)
QUERIES["model_svm"] = _model_query(models.SVM)
QUERIES["model_gbt"] = _model_query(models.BOOSTED)
QUERIES["model_gbt_plain"] = _model_query(models.BOOSTED_PLAIN)


@query
def model_comparison(spark: SparkSession, sf: str) -> DataFrame:
    return models.compare_models(frame(spark, sf))[0]


@cache
def _retrained(application: str, sf: str) -> tuple[str, retraining.Outcome]:
    spark = SparkSession.active()
    folder = scratch(spark, sf, f"retrain-{datetime.now():%Y%m%d%H%M%S%f}")
    outcome = retraining.retrain(
        derived.table(spark, sf, "customers"),
        f"{folder}/registry",
        f"{folder}/models",
        events_path=f"{folder}/events",
        metrics_path=f"{folder}/model_metrics",
    )
    return folder, outcome


def retrained(spark: SparkSession, sf: str) -> str:
    """A folder with registry, models, events and metrics of one retraining per application."""
    return _retrained(spark.sparkContext.applicationId, sf)[0]


@query
def retrain(spark: SparkSession, sf: str) -> DataFrame:
    """Events of a retraining over all candidates, from the table it appended them to."""
    return spark.read.schema(retraining.EVENTS).parquet(f"{retrained(spark, sf)}/events")


@query
def retrain_events(spark: SparkSession, sf: str) -> DataFrame:
    """How often each event was stored, and the rows the training says it loaded."""
    events = retrain(spark, sf)
    loaded = F.when(F.col("event") == "loaded", F.regexp_extract("detail", r"^(\d+) rows", 1).cast("long"))
    return events.groupBy("event").agg(F.count("*").alias("n"), F.max(loaded).cast("double").alias("dataset_size"))


@cache
def _ingested_and_retrained(application: str, sf: str) -> str:
    """A folder with table, log, queue and registry: batch files were ingested, and what they asked for was done."""
    spark = SparkSession.active()
    folder = scratch(spark, sf, f"queue-{datetime.now():%Y%m%d%H%M%S%f}")
    batch = derived.table(spark, sf, "batch_rows")
    names = [r["file_name"] for r in batch.select("file_name").distinct().collect()]  # a row per file
    for name in names:
        own = batch.where(F.col("file_name") == name).orderBy("rn").select(CUSTOMER_COLUMNS).coalesce(1)
        own.write.option("header", True).csv(f"{folder}/in/{name}")
    customers = derived.table(spark, sf, "customers")
    ingest_stream.create_table(customers.select(CUSTOMER_COLUMNS), f"{folder}/table")
    ask = partial(retrain_queue.ask, spark, f"{folder}/queue")
    paths = sorted(path for name in names for path in batches.find_files(spark, f"{folder}/in/{name}"))
    ingest_stream.ingest_files(spark, paths, f"{folder}/table", f"{folder}/log", "run", on_rows_added=ask)

    def train() -> retraining.Outcome:
        return retraining.retrain(ingest_stream.read_table(spark, f"{folder}/table"), f"{folder}/registry", f"{folder}/models", events_path=f"{folder}/events")

    retrain_queue.work(spark, f"{folder}/queue", train)
    return folder


@query
def ingest_then_retrain(spark: SparkSession, sf: str) -> DataFrame:
    """The registry row that came of ingested files: its version, the rows it knows, and what was asked for."""
    folder = _ingested_and_retrained(spark.sparkContext.applicationId, sf)
    asked = spark.read.schema(retrain_queue.ITEMS).parquet(f"{folder}/queue/items").agg(F.sum("rows_added").alias("rows_added"))
    outcomes = spark.read.schema(retrain_queue.OUTCOMES).parquet(f"{folder}/queue/outcomes").agg(F.count("*").alias("outcomes"))
    current = registry.active(registry.read_registry(spark, f"{folder}/registry")).select("version", "dataset_size")
    return current.crossJoin(asked).crossJoin(outcomes)  # one row each


def _active_scorer(spark: SparkSession, sf: str) -> PipelineModel:
    """The active model of the registry that the retraining wrote."""
    return scoring.load_active_model(spark, f"{retrained(spark, sf)}/registry")


@query
def score_customers(spark: SparkSession, sf: str) -> DataFrame:
    customers = derived.table(spark, sf, "customers")
    scored = scoring.score_customers(customers, _active_scorer(spark, sf))
    return scored.select("customer_id", "churn_probability", "risk_level", "color_class")


@query
def scored_customers_hold(spark: SparkSession, sf: str) -> DataFrame:
    """What must be true of every score: a percentage, its band, and the band's badge."""
    p = F.col("churn_probability")
    band = F.when(p < 30, "Low").when(p <= 60, "Medium").otherwise("High")
    scored = score_customers(spark, sf)
    return scored.select("customer_id", p.between(0, 100).alias("is_percent"), (F.col("risk_level") == band).alias("is_band"))


@query
def logged_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of the active model, appended to the log and read back with all its columns."""
    folder = scratch(spark, sf, f"log-{datetime.now():%Y%m%d%H%M%S%f}")
    customers = derived.table(spark, sf, "customers")
    scoring.append_predictions(scoring.score_customers(customers, _active_scorer(spark, sf)), folder)
    # the log has whole credit scores, which engines round differently
    inputs = [c for c in CUSTOMER_COLUMNS if c not in ("customer_id", "exited", "credit_score")]
    return spark.read.parquet(folder).groupBy(*inputs).agg(F.count("*").alias("n"))


@query
def model_drift(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.drift_of_model(derived.table(spark, sf, "customers"), _active_scorer(spark, sf))


@query
def model_drift_basis(spark: SparkSession, sf: str) -> DataFrame:
    return model_drift(spark, sf).select("recent_rows", F.round("baseline_rate", 6).alias("baseline_rate"))


@cache
def _followed(application: str, sf: str) -> str:
    """A folder into which all customers were scored as requests; the active model changed on the way."""
    spark = SparkSession.active()
    folder = scratch(spark, sf, f"followed-{datetime.now():%Y%m%d%H%M%S%f}")
    f = frame(spark, sf)
    f.preprocessor.write().overwrite().save(f"{folder}/models/preprocessor")
    asked = derived.table(spark, sf, "customers").withColumn("value", F.to_json(F.struct(*SCORING_COLUMNS)))
    first = F.col("geography").eqNullSafe("Maharashtra")
    for version, c, part in (("v1", 1.0, first), ("v2", 0.01, ~first)):
        fitted = models.fit_candidate(f, models.CANDIDATES[models.LOGISTIC], C=c)
        PipelineModel(stages=[fitted]).write().overwrite().save(f"{folder}/models/{version}")
        paths = (f"{folder}/models/{version}", f"{folder}/models/preprocessor")
        registry.register(spark, f"{folder}/registry", 0.0, f.n_total, *paths, version, registry.FORCE)
        asked.where(part).select("value").write.mode("append").text(f"{folder}/requests")
        requests = scoring_stream.read_requests(spark, f"{folder}/requests", max_files=2)
        running = scoring_stream.stream_followed(requests, f"{folder}/registry", folder, f"{folder}/checkpoint")
        running.awaitTermination()
    return folder


@query
def followed_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions per version, and whether the counts kept beside the log are those of the whole log."""
    folder = _followed(spark.sparkContext.applicationId, sf)
    kept, log = scoring_stream.read_counts(spark, folder), scoring_stream.read_log(spark, folder)
    counted = score_counts.counts_of(log)
    columns = [F.col(c) for c in kept.columns]
    # both have a row per version, day, level and bin
    sides = kept.select(F.struct(*columns).alias("x")).unionByName(counted.select(F.struct(*columns).alias("x")))
    same = sides.groupBy("x").agg(F.count("*").alias("n")).groupBy("x.model_version").agg(F.min(F.col("n") == 2).alias("counts_hold"))
    return kept.groupBy("model_version").agg(F.sum("predictions").alias("predictions")).join(same, "model_version")


@query
def followed_high_risks(spark: SparkSession, sf: str) -> DataFrame:
    """The list of high risks and the number kept for it, which follow from the scores of the log."""
    folder = _followed(spark.sparkContext.applicationId, sf)
    log = scoring_stream.read_log(spark, folder)
    listed = reports.high_risk(log).agg(F.count("*").alias("n"))
    over = log.agg(F.count_if(F.col("churn_probability") > 60).alias("over"))
    kept = score_counts.high_risk_count(scoring_stream.read_counts(spark, folder))
    one = listed.crossJoin(over).crossJoin(kept)  # a row each
    return one.select((F.col("n") == F.col("over")).alias("list_holds"), (F.col("n") == F.col("high_risk_customers")).alias("count_holds"))


@query
def permutation_importance_model(spark: SparkSession, sf: str) -> DataFrame:
    f = frame(spark, sf)
    metrics, fitted = models.compare_models(f)
    model = fitted[models.best_model(metrics).first()["Model"]]
    return importance.top_features(models.importance(f, model))


def _grid_search_query(name: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return models.grid_search(frame(spark, sf), models.CANDIDATES[name]).results

    return run


QUERIES["grid_search"] = _grid_search_query(models.LOGISTIC)
QUERIES["grid_search_rf"] = _grid_search_query(models.FOREST)
QUERIES["grid_search_svm"] = _grid_search_query(models.SVM)
QUERIES["grid_search_gbt"] = _grid_search_query(models.BOOSTED)
QUERIES["grid_search_gbt_plain"] = _grid_search_query(models.BOOSTED_PLAIN)


def _grid_holds(name: str) -> Query:
    """What must be true of a grid's results, as one row."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        share = F.min(F.col("cv_auc").between(0, 1)).alias("are_shares")
        better = (F.max("cv_auc") > 0.5).alias("better_than_chance")
        return QUERIES[name](spark, sf).agg(F.count("*").alias("settings"), share, better)

    return run


def _model_holds(name: str) -> Query:
    """What must be true of a model's metrics: shares, and an F1 that follows from precision and recall."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        shares = [F.col(c).between(0, 1) for c in ("Accuracy", "Precision", "Recall", "F1-Score", "ROC-AUC")]
        both = F.col("Precision") + F.col("Recall")
        f1 = F.coalesce(F.try_divide(2 * F.col("Precision") * F.col("Recall"), both), F.lit(0.0))
        return QUERIES[name](spark, sf).select(
            F.col("Model").alias("model"),
            reduce(lambda a, b: a & b, shares).alias("are_shares"),
            (F.abs(f1 - F.col("F1-Score")) < 0.0003).alias("f1_follows"),  # all are rounded to four places
        )

    return run


for _name in ("grid_search", "grid_search_rf", "grid_search_svm", "grid_search_gbt", "grid_search_gbt_plain"):
    QUERIES[f"{_name}_holds"] = _grid_holds(_name)
for _name in ("model_lr", "model_rf", "model_svm", "model_gbt", "model_gbt_plain"):
    QUERIES[f"{_name}_holds"] = _model_holds(_name)


@query
def logistic_optimum(spark: SparkSession, sf: str) -> DataFrame:
    """The gradient of the penalised loss at the fitted coefficients, summed over the training rows."""
    f = frame(spark, sf)
    model = models.fit_candidate(f, models.CANDIDATES[models.LOGISTIC])
    values = vector_to_array("features")
    scored = model.transform(f.train).select(vector_to_array("probability")[1].alias("p"), "exited", values.alias("x"))
    wrong = F.col("p") - F.col("exited")
    sums = scored.agg(*[F.sum(wrong * F.col("x")[i]).alias(f"g{i}") for i in range(len(model.coefficients))], F.sum(wrong).alias("g"), F.count("*").alias("n"))
    each = [(F.col(f"g{i}") + float(w)) / F.col("n") for i, w in enumerate(model.coefficients)] + [F.col("g") / F.col("n")]
    zero = reduce(lambda a, b: a & b, [F.abs(c) < 1e-8 for c in each])
    return sums.select(F.lit(len(each)).cast("long").alias("components"), zero.alias("all_zero"))
