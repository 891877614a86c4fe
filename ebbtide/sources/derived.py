"""Customer tables derived from the TPC-H-like test tables.

The text of each table runs unchanged on Spark and, as a WITH chain, on the checking
engine. Spark's own `customers` does not come from the text: it is the result of the
cleaning chain, which the text then checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ebbtide.operators.cleaning import clean_customers
from ebbtide.session import shared_dir

# The derivation that test tables and expected results are built on.
CHURN_RAW_SQL = """
WITH h AS (
  SELECT c_custkey AS k, c_acctbal AS bal, c_nationkey AS nk, c_name AS nm,
    (c_custkey*c_custkey*31 + c_custkey*977 + 101) % 10007 AS h1,
    (c_custkey*c_custkey*57 + c_custkey*613 + 211) % 10009 AS h2,
    (c_custkey*c_custkey*73 + c_custkey*389 + 307) % 10037 AS h3,
    (c_custkey*c_custkey*91 + c_custkey*251 + 401) % 10039 AS h4,
    (c_custkey*c_custkey*17 + c_custkey*863 + 503) % 10061 AS h5
  FROM customer),
f AS (
  SELECT k, nm, 350 + (h1*7 + h2) % 501 AS cs,
    CASE WHEN nk % 4 < 2 THEN 'France' WHEN nk % 4 = 2 THEN 'Germany' ELSE 'Spain' END AS geo,
    CASE WHEN h2 % 100 < 54 THEN 'Male' ELSE 'Female' END AS gen,
    18 + (h3 % 31) + (h4 % 29) AS age, h4 % 11 AS ten,
    CASE WHEN bal >= 0 AND h5 % 100 < 30 THEN 0.0E0 ELSE bal * 15 END AS balance,
    CASE WHEN h1 % 100 < 51 THEN 1 WHEN h1 % 100 < 95 THEN 2 WHEN h1 % 100 < 99 THEN 3 ELSE 4 END AS np,
    CASE WHEN h3 % 100 < 71 THEN 1 ELSE 0 END AS cc,
    CASE WHEN h5 % 1000 < 510 THEN 1 ELSE 0 END AS act,
    CAST(10000 + (h2*h3) % 190000 AS DOUBLE) AS sal,
    (h1 + h2 + h3*3 + h4*5 + h5*7) % 1000 AS u
  FROM h),
r AS (
  SELECT *, -230 + 7*(age-37) + CASE geo WHEN 'Germany' THEN 85 WHEN 'Spain' THEN 5 ELSE 0 END
    + CASE gen WHEN 'Female' THEN 30 ELSE 0 END - 100*act
    + CASE np WHEN 1 THEN 25 WHEN 2 THEN -120 WHEN 3 THEN 185 ELSE 295 END
    + CASE WHEN cs < 400 THEN 150 WHEN cs < 500 THEN 40 WHEN cs < 600 THEN 10 ELSE 0 END AS z
  FROM f)
SELECT k+1 AS RowNumber, k+15600000 AS CustomerId, nm AS Surname,
  CASE WHEN k % 41 = 7 THEN NULL ELSE cs END AS CreditScore,
  CASE WHEN k % 43 = 9 THEN NULL ELSE geo END AS Geography, gen AS Gender,
  CASE WHEN k % 97 = 5 THEN 16 ELSE age END AS Age, ten AS Tenure, balance AS Balance,
  np AS NumOfProducts, cc AS HasCrCard, act AS IsActiveMember, sal AS EstimatedSalary,
  CASE WHEN u < CASE WHEN z <= -300 THEN 40 WHEN z <= -200 THEN 100 WHEN z <= -100 THEN 200
     WHEN z <= 0 THEN 400 WHEN z <= 100 THEN 620 WHEN z <= 200 THEN 800 ELSE 950 END THEN 1 ELSE 0 END AS Exited
FROM r
UNION ALL
SELECT k+1000001, k+15600000, nm, 850, geo, gen, age, ten, balance, np, cc, act, sal, 1 FROM r WHERE k % 50 = 3
"""

CUSTOMERS_SQL = """
WITH m AS (SELECT RowNumber AS rn, CustomerId AS customer_id, CreditScore AS cs0,
   CASE Geography WHEN 'France' THEN 'Maharashtra' WHEN 'Germany' THEN 'Karnataka' WHEN 'Spain' THEN 'Delhi' END AS g0,
   Gender AS gender, Age AS age, Tenure AS tenure, Balance*100 AS balance, NumOfProducts AS num_products,
   HasCrCard AS has_credit_card, IsActiveMember AS is_active_member, EstimatedSalary*100 AS estimated_salary, Exited AS exited
   FROM churn_raw),
s AS (SELECT MEDIAN(cs0) AS med FROM m),
md AS (SELECT g0 AS gm FROM (SELECT g0, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, g0) AS r
       FROM m WHERE g0 IS NOT NULL GROUP BY g0) t WHERE r = 1),
d AS (SELECT m.*, COALESCE(cs0, med) AS credit_score, COALESCE(g0, gm) AS geography,
        ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY rn) AS rr FROM m CROSS JOIN s CROSS JOIN md)
SELECT customer_id, CAST(credit_score AS DOUBLE) AS credit_score, geography, gender, age, tenure, balance,
  num_products, has_credit_card, is_active_member, estimated_salary, exited
FROM d WHERE rr = 1 AND age BETWEEN 18 AND 100 AND balance >= 0 AND credit_score BETWEEN 300 AND 850
"""

SCORED_SQL = """
SELECT *, pm / 10.0E0 AS churn_probability, CASE WHEN pm >= 500 THEN 1 ELSE 0 END AS prediction FROM (
  SELECT *, LEAST(999, GREATEST(1, (age-18)*8 + 150*(1-is_active_member)
    + CASE WHEN num_products = 2 THEN 0 WHEN num_products = 1 THEN 120 ELSE 300 END
    + CASE WHEN geography = 'Karnataka' THEN 100 ELSE 0 END)) AS pm FROM customers) t
"""

PREDICTIONS_SQL = """
SELECT e.event_id AS prediction_id, e.ts AS ts, s.customer_id, s.credit_score, s.geography, s.gender, s.age,
  s.tenure, s.balance, s.num_products,
  s.has_credit_card, s.is_active_member, s.estimated_salary, s.churn_probability,
  CASE WHEN s.churn_probability < 30.0 THEN 'Low' WHEN s.churn_probability <= 60.0 THEN 'Medium' ELSE 'High' END AS risk_level
FROM events e JOIN scored s ON s.customer_id = 15600000 + e.user_id
"""

# Four incoming files over the whole raw table: f1 is new but for known ids, f2 shares ids
# with f1, f3 shares ids with f2 only, f4 holds states outside the domain.
BATCH_ROWS_SQL = """
SELECT CASE RowNumber % 4 WHEN 0 THEN 'f1.csv' WHEN 1 THEN 'f2.csv' WHEN 2 THEN 'f3.csv' ELSE 'f4.csv' END AS file_name,
  RowNumber AS rn,
  CASE WHEN RowNumber % 3 = 0 THEN CustomerId
    WHEN RowNumber % 4 = 0 OR RowNumber % 8 = 1 THEN 9900000000 + RowNumber - RowNumber % 8
    WHEN RowNumber % 4 = 3 THEN 9920000000 + RowNumber
    ELSE 9910000000 + RowNumber - RowNumber % 8 END AS customer_id,
  COALESCE(CreditScore, 200) AS credit_score,
  CASE WHEN RowNumber % 4 = 3 THEN Geography WHEN Geography = 'France' THEN 'Maharashtra'
    WHEN Geography = 'Germany' THEN 'Karnataka' ELSE 'Delhi' END AS geography,
  Gender AS gender, Age AS age, Tenure AS tenure, Balance*100 AS balance, NumOfProducts AS num_products,
  HasCrCard AS has_credit_card, IsActiveMember AS is_active_member, EstimatedSalary*100 AS estimated_salary, Exited AS exited
FROM churn_raw
"""

# A registry and candidate scores that follow from the customers, one version per tenure year.
REGISTRY_SQL = """
SELECT CONCAT('v', CAST(tenure + 1 AS STRING)) AS version,
  CAST('2026-01-01 00:00:00' AS TIMESTAMP) AS training_date, COUNT(*) AS dataset_size,
  FLOOR(SUM(pm) * 10.0E0 / COUNT(*)) / 1.0E4 AS roc_auc,
  CONCAT('models/v', CAST(tenure + 1 AS STRING), '/model') AS model_path,
  CONCAT('models/v', CAST(tenure + 1 AS STRING), '/preprocessor') AS preprocessor_path,
  CASE WHEN tenure = 4 THEN 1 ELSE 0 END AS is_active
FROM scored GROUP BY tenure
"""

_written: dict[tuple[str, str, str], str] = {}


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _build(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "churn_raw":
        return spark.sql(CHURN_RAW_SQL.replace("FROM customer", "FROM {customer}"), customer=source(spark, sf_dir, "customer"))
    if name == "customers":
        return clean_customers(table(spark, sf_dir, "churn_raw"))
    if name == "scored":
        return spark.sql(SCORED_SQL.replace("FROM customers", "FROM {customers}"), customers=table(spark, sf_dir, "customers"))
    if name == "predictions":
        return spark.sql(
            PREDICTIONS_SQL.replace("FROM events e JOIN scored s", "FROM {events} e JOIN {scored} s"),
            events=source(spark, sf_dir, "events"),
            scored=table(spark, sf_dir, "scored"),
        )
    if name == "batch_rows":
        return spark.sql(
            BATCH_ROWS_SQL.replace("FROM churn_raw", "FROM {churn_raw}"),
            churn_raw=table(spark, sf_dir, "churn_raw"),
        )
    if name == "registry":
        return spark.sql(REGISTRY_SQL.replace("FROM scored", "FROM {scored}"), scored=table(spark, sf_dir, "scored"))
    raise KeyError(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table, written once per application and read from there afterwards."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = shared_dir(spark, sf_dir.strip("/").replace("/", "_"), f"{name}.parquet")
        _build(spark, sf_dir, name).write.mode("overwrite").parquet(path)
        _written[key] = path
    return spark.read.parquet(_written[key])
