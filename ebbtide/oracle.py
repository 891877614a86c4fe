"""Plain SQL of each query, for the checking engine over the same Parquet tables."""

from __future__ import annotations

import re
from itertools import combinations

from ebbtide.operators.eda import CORRELATED
from ebbtide.operators.preprocess import BINARY, CATEGORICAL, NUMERIC
from ebbtide.schemas import CUSTOMER_COLUMNS, RAW_TO_CUSTOMER
from ebbtide.sources import derived

# derived tables in the order of their dependence
TABLES = {
    "churn_raw": derived.CHURN_RAW_SQL,
    "customers": derived.CUSTOMERS_SQL,
    "scored": derived.SCORED_SQL,
    "predictions": derived.PREDICTIONS_SQL,
    "batch_rows": derived.BATCH_ROWS_SQL,
    "registry": derived.REGISTRY_SQL,
}
NEEDS = {
    "churn_raw": [],
    "customers": ["churn_raw"],
    "scored": ["customers"],
    "predictions": ["scored"],
    "batch_rows": ["churn_raw"],
    "registry": ["scored"],
}


def with_tables(sql: str, extra: dict[str, str] | None = None) -> str:
    """Put the derived tables that a text names, and those they need, in front of it."""
    body = "\n".join([*(extra or {}).values(), sql])
    wanted: set[str] = set()

    def need(name: str) -> None:
        if name not in wanted:
            wanted.add(name)
            for other in NEEDS[name]:
                need(other)

    for name in TABLES:
        if re.search(rf"\b{name}\b", body):
            need(name)
    chain = [f"{n} AS ({t})" for n, t in TABLES.items() if n in wanted]
    chain += [f"{n} AS ({t})" for n, t in (extra or {}).items()]
    return f"WITH {', '.join(chain)} {sql}" if chain else sql


ORACLES: dict[str, str] = {}


def oracle(name: str, sql: str, **extra: str) -> None:
    ORACLES[name] = with_tables(sql, extra)


AGE_GROUP = "CASE WHEN age < 30 THEN '<30' WHEN age < 45 THEN '30-45' WHEN age < 60 THEN '45-60' ELSE '60+' END"
CREDIT_BAND = (
    "CASE WHEN credit_score < 400 THEN '<400' WHEN credit_score < 500 THEN '400-500' WHEN credit_score < 600 THEN "
    "'500-600' WHEN credit_score < 700 THEN '600-700' WHEN credit_score < 800 THEN '700-800' ELSE '800+' END"
)
CREDIT_BAND_LONG = (
    "CASE WHEN credit_score < 400 THEN '<400 (Very Poor)' WHEN credit_score < 500 THEN '400-500 (Poor)' "
    "WHEN credit_score < 600 THEN '500-600 (Fair)' WHEN credit_score < 700 THEN '600-700 (Good)' "
    "WHEN credit_score < 800 THEN '700-800 (Very Good)' ELSE '800+ (Excellent)' END"
)
COUNTS = "COUNT(*) AS total_customers, CAST(SUM(exited) AS BIGINT) AS churned_customers, ROUND(AVG(exited) * 100, 2) AS churn_rate_pct"


def by(key: str, name: str, source: str = "customers") -> str:
    return f"SELECT {key} AS {name}, {COUNTS} FROM {source} GROUP BY 1"


# --- sources and sinks

oracle("scan_customers", "SELECT * FROM customers")
AS_DOUBLE = "* REPLACE (CAST(CreditScore AS DOUBLE) AS CreditScore)"
oracle("scan_raw", f"SELECT {AS_DOUBLE} FROM churn_raw")
oracle(
    "parse_scoring_json",
    """SELECT customer_id, CAST(TRUNC(credit_score) AS INTEGER) AS credit_score, geography, gender,
      CAST(age AS INTEGER) AS age, CAST(tenure AS INTEGER) AS tenure, balance, num_products, has_credit_card,
      is_active_member, CASE WHEN customer_id % 10 = 7 THEN NULL ELSE estimated_salary END AS estimated_salary,
      customer_id % 10 <> 7 AS valid FROM customers""",
)
_LONG = {
    "geography_churn": "geography",
    "age_churn": AGE_GROUP,
    "product_churn": "CAST(num_products AS VARCHAR)",
    "credit_score_churn": CREDIT_BAND_LONG,
    "active_member_churn": "CAST(is_active_member AS VARCHAR)",
    "tenure_churn": "CAST(tenure AS VARCHAR)",
}
oracle(
    "export_roundtrip",
    " UNION ALL ".join(f"SELECT '{n}' AS report, * FROM ({by(k, 'segment')}) t" for n, k in _LONG.items()),
)
_SUMMARIES = {
    "geography_summary": "geography",
    "age_summary": AGE_GROUP,
    "product_summary": "CAST(num_products AS VARCHAR)",
    "credit_score_summary": CREDIT_BAND,
    "churn_master": "'all'",
}
oracle(
    "bi_exports",
    " UNION ALL ".join(f"SELECT '{n}' AS report, * FROM ({by(k, 'segment')}) t" for n, k in _SUMMARIES.items()),
)
HISTORY = (
    "prediction_id, ts, credit_score, geography, gender, age, tenure, balance, num_products, has_credit_card, "
    "is_active_member, estimated_salary, churn_probability, risk_level"
)
oracle("prediction_history", f"SELECT {HISTORY} FROM predictions")
oracle(
    "check_violations",
    """SELECT * FROM (SELECT file_name, rn, CONCAT_WS(',',
        CASE WHEN geography NOT IN ('Maharashtra', 'Karnataka', 'Delhi') THEN 'geography' END,
        CASE WHEN gender NOT IN ('Male', 'Female') THEN 'gender' END,
        CASE WHEN has_credit_card NOT IN (0, 1) THEN 'has_credit_card' END,
        CASE WHEN is_active_member NOT IN (0, 1) THEN 'is_active_member' END,
        CASE WHEN exited NOT IN (0, 1) THEN 'exited' END) AS violations FROM batch_rows) t WHERE violations <> ''""",
)

# --- projections and validation

oracle(
    "normalize_batch",
    "SELECT * REPLACE (CAST(credit_score AS DOUBLE) AS credit_score) FROM (SELECT "
    + ", ".join(f"{raw} AS {name}" for raw, name in RAW_TO_CUSTOMER.items())
    + " FROM churn_raw) t",
)
STATE = "CASE Geography WHEN 'France' THEN 'Maharashtra' WHEN 'Germany' THEN 'Karnataka' WHEN 'Spain' THEN 'Delhi' END"
oracle("localize_geography", f"SELECT RowNumber, {STATE} AS Geography FROM churn_raw")
oracle("scale_money", "SELECT RowNumber, Balance*100 AS Balance, EstimatedSalary*100 AS EstimatedSalary FROM churn_raw")
ENGINEERED = """balance / NULLIF(estimated_salary + 1.0, 0) AS balance_to_salary_ratio,
  balance / NULLIF(num_products, 0) AS balance_per_product,
  CASE WHEN num_products >= 3 THEN 1 ELSE 0 END AS is_high_product_risk,
  CASE WHEN age >= 45 AND is_active_member = 0 THEN 1 ELSE 0 END AS is_inactive_and_older,
  CASE WHEN age < 35 AND is_active_member = 1 THEN 1 ELSE 0 END AS is_active_and_young"""
oracle("features", f"SELECT customer_id, {ENGINEERED} FROM customers")
oracle(
    "risk_bands",
    """SELECT customer_id, churn_probability,
      CASE WHEN churn_probability < 30 THEN 'Low' WHEN churn_probability <= 60 THEN 'Medium' ELSE 'High' END AS risk_level,
      CASE WHEN churn_probability < 30 THEN 'success' WHEN churn_probability <= 60 THEN 'warning' ELSE 'danger' END AS color_class
      FROM scored""",
)
oracle(
    "kpi_formatted",
    """SELECT FORMAT('{:,}', COUNT(*)) AS total_customers,
      PRINTF('%.2f', ROUND(AVG(exited) * 100, 2)) || '%' AS churn_rate,
      '₹' || FORMAT('{:,.2f}', ROUND(AVG(balance), 2)) AS avg_balance,
      PRINTF('%.1f', ROUND(AVG(credit_score), 1)) AS avg_credit_score FROM customers""",
)
BAD_AGE = "COALESCE(Age < 18 OR Age > 100, FALSE)"
BAD_BALANCE = "COALESCE(Balance < 0, FALSE)"
BAD_SCORE = "COALESCE(CreditScore < 300 OR CreditScore > 850, FALSE)"
oracle("validate_age", f"SELECT RowNumber, Age FROM churn_raw WHERE NOT {BAD_AGE}")
oracle("validate_balance", f"SELECT RowNumber, Balance FROM churn_raw WHERE NOT {BAD_BALANCE}")
oracle("validate_credit", f"SELECT RowNumber, CAST(CreditScore AS DOUBLE) AS CreditScore FROM churn_raw WHERE NOT {BAD_SCORE}")
oracle(
    "range_validations",
    f"""SELECT RowNumber, NOT ({BAD_AGE} OR {BAD_BALANCE} OR {BAD_SCORE}) AS kept_by_cleaning,
      COALESCE(Age BETWEEN 18 AND 100, FALSE) AND COALESCE(Balance >= 0, FALSE)
        AND COALESCE(CreditScore BETWEEN 300 AND 850, FALSE) AS kept_by_ingest FROM churn_raw""",
)

# --- cleaning

RAW_COLUMNS = [
    "RowNumber", "CustomerId", "Surname", "CreditScore", "Geography", "Gender", "Age", "Tenure", "Balance",
    "NumOfProducts", "HasCrCard", "IsActiveMember", "EstimatedSalary", "Exited",
]
_local = f"SELECT * REPLACE ({STATE} AS Geography) FROM churn_raw"
oracle(
    "null_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count FROM localised" for c in RAW_COLUMNS
    ),
    localised=_local,
)
_filled = """SELECT * REPLACE (
    COALESCE(CAST(CreditScore AS DOUBLE), (SELECT MEDIAN(CreditScore) FROM localised)) AS CreditScore,
    COALESCE(Geography, (SELECT Geography FROM localised WHERE Geography IS NOT NULL
      GROUP BY Geography ORDER BY COUNT(*) DESC, Geography LIMIT 1)) AS Geography,
    Balance * 100 AS Balance, EstimatedSalary * 100 AS EstimatedSalary) FROM localised"""
oracle("fill_missing", "SELECT * FROM filled", localised=_local, filled=_filled)
oracle(
    "duplicate_rows",
    f"SELECT {AS_DOUBLE} FROM churn_raw WHERE CustomerId IN (SELECT CustomerId FROM churn_raw GROUP BY CustomerId HAVING COUNT(*) > 1)",
)
_FIRST = "SELECT * FROM {0} QUALIFY ROW_NUMBER() OVER (PARTITION BY CustomerId ORDER BY RowNumber) = 1"
oracle("dedup_keep_first", f"SELECT {AS_DOUBLE} FROM ({_FIRST.format('churn_raw')}) t")
oracle(
    "cleaning_report",
    """SELECT 'initial' AS counter, (SELECT COUNT(*) FROM filled) AS row_count
      UNION ALL SELECT 'duplicate', CAST(COALESCE(SUM(n), 0) AS BIGINT) FROM
        (SELECT COUNT(*) AS n FROM filled GROUP BY CustomerId HAVING COUNT(*) > 1) d
      UNION ALL SELECT 'invalid_age', COUNT(*) FROM firsts WHERE why = 1
      UNION ALL SELECT 'invalid_balance', COUNT(*) FROM firsts WHERE why = 2
      UNION ALL SELECT 'invalid_credit_score', COUNT(*) FROM firsts WHERE why = 3
      UNION ALL SELECT 'final', COUNT(*) FROM firsts WHERE why = 0
      UNION ALL SELECT 'removed', (SELECT COUNT(*) FROM filled) - COUNT(*) FROM firsts WHERE why = 0""",
    localised=_local,
    filled=_filled,
    firsts=f"""SELECT *, CASE WHEN {BAD_AGE} THEN 1 WHEN {BAD_BALANCE} THEN 2 WHEN {BAD_SCORE} THEN 3 ELSE 0 END AS why
      FROM ({_FIRST.format("filled")}) t""",
)
oracle("clean_customers", "SELECT * FROM customers")

# --- joins

oracle(
    "new_records_anti",
    "SELECT file_name, rn, customer_id FROM batch_rows WHERE customer_id NOT IN (SELECT customer_id FROM customers)",
)
oracle(
    "new_records_by_index",
    "SELECT file_name, rn, customer_id FROM batch_rows WHERE customer_id NOT IN (SELECT customer_id FROM customers)",
)
for _key, _prefix, _name in (("geography", "geo_", "fact_with_geo_summary"), ("num_products", "product_", "fact_with_product_summary")):
    oracle(
        _name,
        f"""SELECT c.customer_id, c.{_key}, c.exited, s.total_customers AS {_prefix}total_customers,
          s.churned_customers AS {_prefix}churned_customers, s.churn_rate_pct AS {_prefix}churn_rate_pct
          FROM customers c LEFT JOIN ({by(_key, _key)}) s ON s.{_key} = c.{_key}""",
    )

# --- reports

oracle("churn_by_geography", by("geography", "geography"))
oracle("churn_by_age_group", by(AGE_GROUP, "age_group"))
oracle("churn_by_products", by("num_products", "num_products"))
oracle("churn_by_credit_band", by(CREDIT_BAND_LONG, "credit_score_range"))
oracle("credit_score_summary", by(CREDIT_BAND, "credit_score_range"))
oracle("churn_by_active", by("is_active_member", "is_active_member"))
oracle("churn_by_tenure", by("tenure", "tenure_years"))
oracle("churn_by_gender", by("gender", "gender"))
oracle(
    "balance_by_exited",
    "SELECT exited, COUNT(*) AS total_customers, ROUND(AVG(balance), 2) AS avg_balance FROM customers GROUP BY exited",
)
oracle(
    "kpis",
    """SELECT COUNT(*) AS total, ROUND(AVG(exited) * 100, 6) AS churn_rate, ROUND(AVG(balance), 6) AS avg_balance,
      ROUND(AVG(credit_score), 6) AS avg_credit_score FROM customers""",
)
oracle(
    "dashboard_geography",
    """SELECT geography, COUNT(*) AS count, CAST(SUM(exited) AS BIGINT) AS churned,
      ROUND(AVG(exited) * 100, 2) AS rate FROM customers GROUP BY geography""",
)
_RETAINED = """COUNT(*) AS count, CAST(SUM(exited) AS BIGINT) AS churned, CAST(COUNT(*) - SUM(exited) AS BIGINT) AS retained,
  ROUND(SUM(exited) / COUNT(*) * 100, 2) AS rate"""
oracle("dashboard_age", f"SELECT {AGE_GROUP} AS age_group, {_RETAINED} FROM customers GROUP BY 1")
oracle("dashboard_products", f"SELECT CAST(num_products AS VARCHAR) AS num_products, {_RETAINED} FROM customers GROUP BY 1")
oracle(
    "credit_band_by_exited",
    f"""SELECT b.credit_range, CAST(COALESCE(SUM(CASE WHEN c.exited = 0 THEN 1 END), 0) AS BIGINT) AS retained,
      CAST(COALESCE(SUM(CASE WHEN c.exited <> 0 THEN 1 END), 0) AS BIGINT) AS churned
      FROM (VALUES ('<400'), ('400-500'), ('500-600'), ('600-700'), ('700-800'), ('800+')) b(credit_range)
      LEFT JOIN (SELECT {CREDIT_BAND} AS r, exited FROM customers) c ON c.r = b.credit_range GROUP BY b.credit_range""",
)
oracle(
    "exited_distribution",
    """SELECT exited, COUNT(*) AS customers, ROUND(COUNT(*) * 100.0E0 / (SELECT COUNT(*) FROM customers), 2) AS pct
      FROM customers GROUP BY exited""",
)
oracle(
    "geography_rate_raw",
    """SELECT geography, COUNT(exited) AS count, CAST(SUM(exited) AS BIGINT) AS sum, ROUND(AVG(exited), 6) AS rate
      FROM customers GROUP BY geography""",
)


def measures(where: str = "TRUE") -> str:
    share = "COALESCE(SUM(CASE WHEN {0} AND customer_id IS NOT NULL THEN 1 ELSE 0 END) / NULLIF(COUNT(customer_id), 0), 0.0E0)"
    churn = share.format("exited = 1")
    count = "CAST(COALESCE(SUM(CASE WHEN exited = {0} THEN 1 ELSE 0 END), 0) AS BIGINT)"
    return f"""SELECT COUNT(customer_id) AS total_customers, {count.format(1)} AS churned_customers,
      {count.format(0)} AS retained_customers, ROUND({churn}, 6) AS churn_rate, ROUND(1 - {churn}, 6) AS retention_rate,
      ROUND({share.format('is_active_member = 1')}, 6) AS active_rate, ROUND(AVG(balance), 2) AS avg_balance,
      ROUND(AVG(credit_score), 6) AS avg_credit_score FROM customers WHERE {where}"""


oracle("bi_measures", measures())
oracle(
    "sliced_kpis",
    measures("geography IN ('Maharashtra', 'Delhi') AND gender = 'Female' AND age >= 30 AND age < 60"),
)
oracle("customers_by_geography", "SELECT geography, COUNT(customer_id) AS total_customers FROM customers GROUP BY geography")
oracle(
    "drill_through",
    """SELECT * FROM customers WHERE geography = 'Karnataka' AND age >= 45 AND age < 60
      AND credit_score >= 600 AND credit_score < 700""",
)
oracle("high_risk_customers", f"SELECT {HISTORY} FROM predictions WHERE risk_level = 'High'")
oracle("high_risk_count", "SELECT COUNT(*) AS high_risk_customers FROM predictions WHERE risk_level = 'High'")
oracle("risk_distribution", "SELECT risk_level, COUNT(*) AS predictions FROM predictions GROUP BY risk_level")
oracle(
    "probability_histogram",
    "SELECT CAST(LEAST(FLOOR(churn_probability / 10), 9) AS INTEGER) AS bin, COUNT(*) AS predictions FROM predictions GROUP BY 1",
)
oracle(
    "sliced_predictions",
    f"""SELECT {HISTORY} FROM predictions WHERE risk_level IN ('High', 'Medium') AND geography = 'Karnataka'
      AND CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
)

# --- exploration

_value = {c: (f"CASE gender WHEN 'Male' THEN 0 WHEN 'Female' THEN 1 END" if c == "gender" else c) for c in CORRELATED}
_cells = [f"SELECT '{c}' AS column_a, '{c}' AS column_b, 1.0E0 AS correlation" for c in CORRELATED]
for _a, _b in combinations(CORRELATED, 2):
    _r = f"(SELECT ROUND(CORR({_value[_a]}, {_value[_b]}), 6) FROM customers)"
    _cells += [f"SELECT '{_a}', '{_b}', {_r}", f"SELECT '{_b}', '{_a}', {_r}"]
oracle("correlation_matrix", " UNION ALL ".join(_cells))
_fences = """SELECT exited, QUANTILE_CONT(credit_score, 0.25) AS q1, QUANTILE_CONT(credit_score, 0.5) AS median,
  QUANTILE_CONT(credit_score, 0.75) AS q3 FROM customers GROUP BY exited"""
_IN = "c.credit_score BETWEEN f.q1 - 1.5E0 * (f.q3 - f.q1) AND f.q3 + 1.5E0 * (f.q3 - f.q1)"
oracle(
    "credit_box_stats",
    f"""SELECT c.exited, COUNT(*) AS n, f.q1, f.median, f.q3, MIN(CASE WHEN {_IN} THEN c.credit_score END) AS whisker_low,
      MAX(CASE WHEN {_IN} THEN c.credit_score END) AS whisker_high,
      CAST(SUM(CASE WHEN {_IN} THEN 0 ELSE 1 END) AS BIGINT) AS outliers
      FROM customers c JOIN fences f ON f.exited = c.exited GROUP BY c.exited, f.q1, f.median, f.q3""",
    fences=_fences,
)
oracle(
    "credit_outliers",
    f"SELECT c.customer_id, c.credit_score, c.exited FROM customers c JOIN fences f ON f.exited = c.exited WHERE NOT ({_IN})",
    fences=_fences,
)
oracle(
    "products_outliers",
    f"""SELECT c.customer_id, c.num_products, c.exited FROM customers c JOIN fences f ON f.exited = c.exited
      WHERE NOT ({_IN.replace("credit_score", "num_products")})""",
    fences=_fences.replace("credit_score", "num_products"),
)


def density(value: str, digits: int, factor: str) -> None:
    oracle(
        f"kde_{value}",
        f"""SELECT g.exited, g.point, ROUND(g.x, {digits}) AS x,
          ROUND(SUM(v.c * EXP(-0.5E0 * POWER((g.x - v.v) / g.h, 2))) / (g.n * g.h * SQRT(2 * PI())) * {factor}, 8) AS density
          FROM grid g JOIN vals v ON v.exited = g.exited GROUP BY g.exited, g.point, g.x, g.n, g.h""",
        shape=f"""SELECT exited, CAST(COUNT({value}) AS DOUBLE) AS n, STDDEV_SAMP({value}) * POWER(COUNT({value}), -0.2E0) AS h,
          MIN({value}) AS lo, MAX({value}) AS hi FROM customers GROUP BY exited""",
        grid="""SELECT exited, n, h, CAST(p AS INTEGER) AS point, lo - 3 * h + p * ((hi + 3 * h - (lo - 3 * h)) / 199) AS x
          FROM shape, RANGE(200) t(p)""",
        vals=f"SELECT exited, {value} AS v, COUNT(*) AS c FROM customers GROUP BY exited, {value}",
    )


density("age", 3, "1.0E0")
density("balance", 1, "1.0E6")
oracle(
    "balance_histogram",
    "SELECT CAST(FLOOR(balance / 1000000) * 1000000 AS BIGINT) AS bin_start, COUNT(*) AS customers FROM customers GROUP BY 1",
)
oracle(
    "salary_balance_bins",
    """SELECT CAST(FLOOR(estimated_salary / 2000000) * 2000000 AS BIGINT) AS salary_bin,
      CAST(FLOOR(balance / 1000000) * 1000000 AS BIGINT) AS balance_bin, exited, COUNT(*) AS customers
      FROM customers GROUP BY 1, 2, 3""",
)
oracle("latest_100", "SELECT * FROM customers ORDER BY customer_id DESC LIMIT 100")

# --- preprocessing

_unfilled = f"""SELECT *, {ENGINEERED} FROM (SELECT CustomerId AS customer_id, CAST(CreditScore AS DOUBLE) AS credit_score,
    {STATE} AS geography, Gender AS gender, Age AS age, Tenure AS tenure, Balance*100 AS balance,
    NumOfProducts AS num_products, HasCrCard AS has_credit_card, IsActiveMember AS is_active_member,
    EstimatedSalary*100 AS estimated_salary, Exited AS exited FROM churn_raw) t"""
_imputed = "SELECT customer_id, " + ", ".join(
    f"COALESCE(CAST({c} AS DOUBLE), (SELECT CAST(MEDIAN({c}) AS DOUBLE) FROM unfilled)) AS {c}" for c in NUMERIC
) + " FROM unfilled"
oracle("impute_numeric", "SELECT * FROM imputed", unfilled=_unfilled, imputed=_imputed)
oracle(
    "scale_numeric",
    "SELECT customer_id, "
    + ", ".join(f"ROUND(({c} - AVG({c}) OVER ()) / COALESCE(NULLIF(STDDEV_POP({c}) OVER (), 0), 1), 6) AS {c}" for c in NUMERIC)
    + " FROM imputed",
    unfilled=_unfilled,
    imputed=_imputed,
)


def mode_of(column: str, source: str) -> str:
    return f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY COUNT(*) DESC, {column} LIMIT 1)"


oracle(
    "impute_mode",
    "SELECT customer_id, "
    + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), CAST({mode_of(c, 'unfilled')} AS VARCHAR)) AS {c}" for c in CATEGORICAL + BINARY)
    + " FROM unfilled",
    unfilled=_unfilled,
)
_HOT = {"geography_Karnataka": "g = 'Karnataka'", "geography_Maharashtra": "g = 'Maharashtra'", "gender_Male": "s = 'Male'"}
oracle(
    "one_hot",
    "SELECT customer_id, "
    + ", ".join(f"CASE WHEN {c} THEN 1.0E0 ELSE 0.0E0 END AS {n}" for n, c in _HOT.items())
    + f""" FROM (SELECT customer_id, COALESCE(geography, {mode_of('geography', 'unfilled')}) AS g,
      COALESCE(gender, {mode_of('gender', 'unfilled')}) AS s FROM unfilled) t""",
    unfilled=_unfilled,
)
_ranked = """SELECT *, ROW_NUMBER() OVER (PARTITION BY exited ORDER BY MD5('42-' || customer_id), customer_id) AS r,
  COUNT(*) OVER (PARTITION BY exited) AS n FROM customers"""
_split = f"SELECT *, CASE WHEN r <= ROUND(0.2E0 * n) THEN 'test' ELSE 'train' END AS split, {ENGINEERED} FROM ranked"
oracle("stratified_split", "SELECT customer_id, split FROM parts", ranked=_ranked, parts=_split)
oracle("saved_splits", "SELECT customer_id, exited, split FROM parts", ranked=_ranked, parts=_split)
oracle("cv_folds", "SELECT customer_id, CAST((r - 1) % 5 AS INTEGER) AS fold FROM ranked", ranked=_ranked)
# the cleaned table has no gaps, so imputing leaves the columns as they are
oracle(
    "feature_matrix",
    "SELECT customer_id, split, "
    + ", ".join(
        f"ROUND((COALESCE({c}, (SELECT MEDIAN({c}) FROM fitted)) - (SELECT AVG({c}) FROM fitted)) / (SELECT STDDEV_POP({c}) FROM fitted), 6) AS f_{c}"
        for c in NUMERIC
    )
    + ", "
    + ", ".join(
        f"CASE WHEN {c} THEN 1.0E0 ELSE 0.0E0 END AS f_{n}"
        for n, c in {
            "geography_Karnataka": "geography = 'Karnataka'",
            "geography_Maharashtra": "geography = 'Maharashtra'",
            "gender_Male": "gender = 'Male'",
        }.items()
    )
    + ", "
    + ", ".join(f"CAST({c} AS DOUBLE) AS f_{c}" for c in BINARY)
    + " FROM parts",
    ranked=_ranked,
    parts=_split,
    fitted="SELECT * FROM parts WHERE split = 'train'",
)

# --- metrics


def confusion(source: str, label: str = "exited") -> str:
    return f"""SELECT CAST(SUM(CASE WHEN {label} = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS tp,
      CAST(SUM(CASE WHEN {label} = 0 AND prediction = 1 THEN 1 ELSE 0 END) AS DOUBLE) AS fp,
      CAST(SUM(CASE WHEN {label} = 1 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS fn,
      CAST(SUM(CASE WHEN {label} = 0 AND prediction = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tn FROM {source}"""


QUALITY = """ROUND((tp + tn) / (tp + tn + fp + fn), 4) AS "Accuracy",
  ROUND(COALESCE(tp / NULLIF(tp + fp, 0), 0), 4) AS "Precision", ROUND(COALESCE(tp / NULLIF(tp + fn, 0), 0), 4) AS "Recall",
  ROUND(COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0), 4) AS "F1-Score" """
oracle("classification_metrics", f"SELECT {QUALITY} FROM m", m=confusion("scored"))
oracle(
    "confusion_matrix",
    """SELECT g.actual, g.predicted, COUNT(s.exited) AS n FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) g(actual, predicted)
      LEFT JOIN scored s ON s.exited = g.actual AND s.prediction = g.predicted GROUP BY g.actual, g.predicted""",
)
oracle(
    "classification_report",
    """SELECT '0' AS class, ROUND(p0, 6) AS precision, ROUND(r0, 6) AS recall, ROUND(f0, 6) AS f1_score, CAST(s0 AS BIGINT) AS support FROM q
      UNION ALL SELECT '1', ROUND(p1, 6), ROUND(r1, 6), ROUND(f1, 6), CAST(s1 AS BIGINT) FROM q
      UNION ALL SELECT 'accuracy', ROUND(acc, 6), ROUND(acc, 6), ROUND(acc, 6), CAST(s0 + s1 AS BIGINT) FROM q
      UNION ALL SELECT 'macro avg', ROUND((p0 + p1) / 2, 6), ROUND((r0 + r1) / 2, 6), ROUND((f0 + f1) / 2, 6), CAST(s0 + s1 AS BIGINT) FROM q
      UNION ALL SELECT 'weighted avg', ROUND((p0 * s0 + p1 * s1) / (s0 + s1), 6), ROUND((r0 * s0 + r1 * s1) / (s0 + s1), 6),
        ROUND((f0 * s0 + f1 * s1) / (s0 + s1), 6), CAST(s0 + s1 AS BIGINT) FROM q""",
    m=confusion("scored"),
    q="""SELECT COALESCE(tn / NULLIF(tn + fn, 0), 0) AS p0, tn / (tn + fp) AS r0, COALESCE(2 * tn / NULLIF(2 * tn + fn + fp, 0), 0) AS f0,
      COALESCE(tp / NULLIF(tp + fp, 0), 0) AS p1, tp / (tp + fn) AS r1, COALESCE(2 * tp / NULLIF(2 * tp + fp + fn, 0), 0) AS f1,
      tn + fp AS s0, tp + fn AS s1, (tp + tn) / (tp + tn + fp + fn) AS acc FROM m""",
)


def auc(source: str, score: str) -> str:
    return f"""SELECT (SUM(CASE WHEN exited = 1 THEN ar ELSE 0 END) - SUM(exited) * (SUM(exited) + 1) / 2.0E0)
      / (CAST(SUM(exited) AS DOUBLE) * (COUNT(*) - SUM(exited))) FROM (SELECT exited,
      RANK() OVER (ORDER BY {score}) + (COUNT(*) OVER (PARTITION BY {score}) - 1) / 2.0E0 AS ar FROM {source}) r"""


oracle("roc_auc", f"SELECT ROUND(({auc('scored', 'churn_probability')}), 6) AS roc_auc")
oracle(
    "roc_curve",
    """SELECT ROUND(SUM(n) OVER o / SUM(n) OVER (), 6) AS fpr, ROUND(SUM(p) OVER o / SUM(p) OVER (), 6) AS tpr, threshold
      FROM (SELECT churn_probability AS threshold, CAST(SUM(exited) AS DOUBLE) AS p, CAST(COUNT(*) - SUM(exited) AS DOUBLE) AS n
        FROM scored GROUP BY churn_probability) t WINDOW o AS (ORDER BY threshold DESC)
      UNION ALL SELECT 0.0E0, 0.0E0, CAST('inf' AS DOUBLE)""",
)


def drift_of(sql: str) -> str:
    return f"""SELECT n AS recent_rows, ROUND(m, 6) AS recent_mean, ROUND(b, 6) AS baseline_rate, ROUND(ABS(m - b), 6) AS drift,
      ABS(m - b) > 0.05 AS drift_warning, PRINTF('%.2f', ROUND(ABS(m - b) * 100, 2)) || '%' AS drift_pct FROM ({sql}) t"""


oracle(
    "score_drift",
    drift_of(
        """SELECT COUNT(*) AS n, AVG(churn_probability / 100) AS m, COALESCE(NULLIF((SELECT AVG(exited) FROM scored), 0), 0.2037) AS b
      FROM (SELECT * FROM scored ORDER BY customer_id DESC LIMIT 100) l"""
    ),
)
POINTS = """LEAST(999, GREATEST(1, ({age}-18)*8 + 150*(1-{is_active_member})
  + CASE WHEN {num_products} = 2 THEN 0 WHEN {num_products} = 1 THEN 120 ELSE 300 END
  + CASE WHEN {geography} = 'Karnataka' THEN 100 ELSE 0 END))"""
_permuted = ["age", "is_active_member", "num_products", "geography", "tenure"]


def _hit(changed: str | None) -> str:
    names = {c: (f"p_{c}" if c == changed else c) for c in _permuted}
    return f"AVG(CASE WHEN (CASE WHEN {POINTS.format(**names)} >= 500 THEN 1 ELSE 0 END) = exited THEN 1 ELSE 0 END)"


oracle(
    "permutation_importance",
    "SELECT feature, ROUND(AVG(base - acc), 6) AS importance_mean, ROUND(STDDEV_POP(base - acc), 6) AS importance_std FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, rep, {_hit(None)} AS base, {_hit(c)} AS acc FROM paired GROUP BY rep" for c in _permuted)
    + ") t GROUP BY feature",
    drawn="SELECT c.*, rep, MD5('42-' || rep || '-' || customer_id) AS h FROM customers c, RANGE(10) t(rep)",
    paired="SELECT *, "
    + ", ".join(f"COALESCE(LEAD({c}) OVER o, FIRST_VALUE({c}) OVER o) AS p_{c}" for c in _permuted)
    + " FROM drawn WINDOW o AS (PARTITION BY rep ORDER BY h, customer_id)",
)
_rules = {
    "activity": "(1 - is_active_member) * 60.0E0",
    "age": "age * 1.0E0",
    "combined": "churn_probability",
}
_candidates = {
    f"c_{n}": f"SELECT exited, {p} AS probability, CASE WHEN {p} >= 50 THEN 1 ELSE 0 END AS prediction FROM scored"
    for n, p in _rules.items()
}
_measured = {
    **_candidates,
    **{f"m_{n}": confusion(f"c_{n}") for n in _rules},
    "measured": " UNION ALL ".join(
        f"""SELECT '{n}' AS "Model", {QUALITY}, ROUND(({auc(f'c_{n}', 'probability')}), 6) AS "ROC-AUC" FROM m_{n}""" for n in _rules
    ),
}
oracle("measured_rules", "SELECT * FROM measured", **_measured)
oracle("metrics_table", "SELECT *, 'table' AS place FROM measured UNION ALL SELECT *, 'bi' FROM measured", **_measured)
oracle("best_model", 'SELECT * FROM measured ORDER BY "ROC-AUC" DESC, "Model" LIMIT 1', **_measured)
oracle("auc_ranking", 'SELECT "Model", "ROC-AUC" FROM measured', **_measured)
oracle("precision_vs_recall", 'SELECT "Model", "Precision", "Recall" FROM measured', **_measured)

# --- registry

_NEXT = "SELECT 'v' || (MAX(CAST(REPLACE(version, 'v', '') AS INTEGER)) + 1) FROM registry"
oracle("next_version", f"SELECT ({_NEXT}) AS version")
oracle("registry_active", "SELECT * FROM registry WHERE is_active = 1")
oracle(
    "registry_card",
    """SELECT version, STRFTIME(training_date, '%Y-%m-%d %H:%M:%S') AS training_date, FORMAT('{:,}', dataset_size) AS dataset_size,
      PRINTF('%.4f', ROUND(roc_auc, 4)) AS roc_auc FROM registry WHERE is_active = 1""",
)
oracle(
    "registry_card_without_model",
    "SELECT 'v1' AS version, 'N/A' AS training_date, '10,000' AS dataset_size, '0.8818' AS roc_auc",
)
oracle(
    "registry_update",
    f"""SELECT * REPLACE (0 AS is_active) FROM registry UNION ALL
      SELECT ({_NEXT}), TIMESTAMP '2026-02-01 00:00:00', (SELECT COUNT(*) FROM scored),
        ROUND(({auc('scored', 'churn_probability')}), 6), 'models/' || ({_NEXT}) || '/model',
        'models/' || ({_NEXT}) || '/preprocessor', 1""",
)

# --- ingest: four files in the order of their names

_flagged = """SELECT u.*, COALESCE(age BETWEEN 18 AND 100, FALSE) AND COALESCE(balance >= 0, FALSE)
    AND COALESCE(credit_score BETWEEN 300 AND 850, FALSE) AS ok,
  geography NOT IN ('Maharashtra', 'Karnataka', 'Delhi') AS bad
  FROM (SELECT * FROM batch_rows QUALIFY ROW_NUMBER() OVER (PARTITION BY file_name, customer_id ORDER BY rn) = 1) u
  WHERE customer_id NOT IN (SELECT customer_id FROM customers)"""
_CHECKED = "SELECT * FROM flagged WHERE ok AND file_name NOT IN (SELECT file_name FROM flagged WHERE ok AND bad)"


def _accepted(number: int) -> str:
    """Ids of file `number` if none of them came with an earlier accepted file."""
    name = f"f{number}.csv"
    earlier = " UNION ALL ".join(f"SELECT customer_id FROM a{i}" for i in range(1, number)) or "SELECT NULL WHERE FALSE"
    return f"""SELECT * FROM checked WHERE file_name = '{name}' AND NOT EXISTS (SELECT 1 FROM checked c
      WHERE c.file_name = '{name}' AND c.customer_id IN ({earlier}))"""


_steps = {"flagged": _flagged, "checked": _CHECKED} | {f"a{i}": _accepted(i) for i in range(1, 5)}
_ROWS = ", ".join(["file_name", *CUSTOMER_COLUMNS])
_taken = " UNION ALL ".join(f"SELECT * FROM a{i}" for i in range(1, 5))
oracle("ingest_batch", f"SELECT {_ROWS} FROM ({_taken}) t", **_steps)
oracle(
    "ingest_batch_drop_rows",
    f"SELECT {_ROWS} FROM checked QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY file_name) = 1",
    flagged=_flagged,
    checked=_CHECKED,
)
oracle(
    "ingest_summary",
    """SELECT * FROM per_file UNION ALL SELECT 'TOTAL', 'total', CAST(SUM(unique_rows) AS BIGINT), CAST(SUM(new_rows) AS BIGINT),
      CAST(SUM(out_of_range_rows) AS BIGINT), CAST(SUM(written_rows) AS BIGINT) FROM per_file""",
    **_steps,
    taken=_taken,
    per_file="""SELECT b.file_name, CASE WHEN MAX(CASE WHEN f.ok AND f.bad THEN 1 ELSE 0 END) = 1 THEN 'check_violation'
        WHEN COUNT(CASE WHEN f.ok THEN 1 END) = 0 THEN 'no_new_rows'
        WHEN b.file_name IN (SELECT file_name FROM taken) THEN 'ingested' ELSE 'duplicate_ids' END AS status,
      COUNT(*) AS unique_rows, COUNT(f.customer_id) AS new_rows, COUNT(CASE WHEN NOT f.ok THEN 1 END) AS out_of_range_rows,
      (SELECT COUNT(*) FROM taken t WHERE t.file_name = b.file_name) AS written_rows
      FROM (SELECT DISTINCT file_name, customer_id FROM batch_rows) b
      LEFT JOIN flagged f ON f.file_name = b.file_name AND f.customer_id = b.customer_id GROUP BY b.file_name""",
)

# --- models: what SQL can know of them

oracle(
    "retrain_events",
    """SELECT * FROM (VALUES ('started', 1), ('loaded', 1), ('candidate', 4), ('best candidate', 1), ('tuned', 1), ('updated', 1)) e(event, n)
      LEFT JOIN (SELECT 'loaded' AS event, CAST(COUNT(*) AS DOUBLE) AS dataset_size FROM customers) s USING (event)""",
)
oracle("scored_customers_hold", "SELECT customer_id, TRUE AS is_percent, TRUE AS is_band FROM customers")
_INPUTS = "geography, gender, age, tenure, balance, num_products, has_credit_card, is_active_member, estimated_salary"
oracle("logged_predictions", f"SELECT {_INPUTS}, COUNT(*) AS n FROM customers GROUP BY {_INPUTS}")
oracle("model_drift_basis", "SELECT LEAST(COUNT(*), 100) AS recent_rows, ROUND(AVG(exited), 6) AS baseline_rate FROM customers")
oracle(
    "ingest_then_retrain",
    """SELECT 'v1' AS version, (SELECT COUNT(*) FROM customers) + (SELECT COUNT(*) FROM taken) AS dataset_size,
      (SELECT COUNT(*) FROM taken) AS rows_added, 1 AS outcomes""",
    **_steps,
    taken=_taken,
)

oracle(
    "followed_stream",
    """SELECT CASE WHEN geography = 'Maharashtra' THEN 'v1' ELSE 'v2' END AS model_version,
      COUNT(*) AS predictions, TRUE AS counts_hold
    FROM customers GROUP BY 1""",
)
oracle("followed_high_risks", "SELECT TRUE AS list_holds, TRUE AS count_holds")

# a feature per category but the first of its column; rows without one count as the most frequent
oracle(
    "sparse_features",
    """SELECT * FROM (WITH v AS (
      SELECT 0 AS o, 'Surname' AS c, Surname AS x FROM churn_raw
      UNION ALL SELECT 1, 'Geography', Geography FROM churn_raw
      UNION ALL SELECT 2, 'Gender', Gender FROM churn_raw),
    k AS (SELECT o, c, x, COUNT(*) AS n FROM v WHERE x IS NOT NULL GROUP BY o, c, x),
    g AS (SELECT o, c, COUNT(*) AS gaps FROM v WHERE x IS NULL GROUP BY o, c),
    p AS (SELECT o, c, x, n, ROW_NUMBER() OVER (PARTITION BY o ORDER BY x) AS place, ROW_NUMBER() OVER (PARTITION BY o ORDER BY n DESC, x) AS common FROM k)
    SELECT p.c AS "column", x AS value, ROW_NUMBER() OVER (ORDER BY p.o, place) - 1 AS position,
      n + CASE WHEN common = 1 THEN COALESCE(gaps, 0) ELSE 0 END AS n
    FROM p LEFT JOIN g ON g.o = p.o WHERE place > 1) AS features""",
)

# grids: a row per setting, every ROC-AUC a share of pairs, and the best is no chance
for _name, _settings in {"grid_search": 4, "grid_search_rf": 12, "grid_search_svm": 6, "grid_search_gbt": 24, "grid_search_gbt_plain": 8}.items():
    oracle(f"{_name}_holds", f"SELECT CAST({_settings} AS BIGINT) AS settings, TRUE AS are_shares, TRUE AS better_than_chance")
for _name, _model in {
    "model_lr": "Logistic Regression",
    "model_rf": "Random Forest",
    "model_svm": "SVM",
    "model_gbt": "Gradient Boosting (weighted)",
    "model_gbt_plain": "Gradient Boosting",
}.items():
    oracle(f"{_name}_holds", f"SELECT '{_model}' AS model, TRUE AS are_shares, TRUE AS f1_follows")
# the logistic fit is the minimum: every component of the gradient is zero
oracle("logistic_optimum", "SELECT CAST(17 AS BIGINT) AS components, TRUE AS all_zero")
