from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan_of
from ebbtide.operators import cleaning
from ebbtide.schemas import CHURN_RAW, CUSTOMERS

GOOD = (1, 10, "A", 600, "France", "Male", 40, 3, 10.0, 1, 1, 1, 20.0, 0)


def raw(spark, *changes):
    names = CHURN_RAW.fieldNames()
    rows = []
    for i, change in enumerate(changes, 1):
        row = dict(zip(names, GOOD)) | {"RowNumber": i, "CustomerId": 100 + i} | change
        rows.append(tuple(row[n] for n in names))
    return spark.createDataFrame(rows, CHURN_RAW)


def test_unknown_country_becomes_the_mode(spark):
    df = raw(spark, {}, {"Geography": "Spain"}, {"Geography": "Spain"}, {"Geography": "Italy"})
    got = [r["geography"] for r in cleaning.clean_customers(df).orderBy("customer_id").collect()]
    assert got == ["Maharashtra", "Delhi", "Delhi", "Delhi"]


def test_mode_takes_the_smallest_on_ties(spark):
    df = raw(spark, {"Surname": "b"}, {"Surname": "a"}, {"Surname": None})
    assert cleaning.fit_fill_values(df) == {"Surname": "a"}


def test_median_fill_over_all_rows_before_dedup(spark):
    df = raw(spark, {"CreditScore": 500}, {"CreditScore": 601}, {"CreditScore": None},
             {"CustomerId": 101, "CreditScore": 700, "RowNumber": 9})
    rows = {r["customer_id"]: r["credit_score"] for r in cleaning.clean_customers(df).collect()}
    assert rows == {101: 500.0, 102: 601.0, 103: 601.0}
    even = raw(spark, {"CreditScore": 500}, {"CreditScore": 601}, {"CreditScore": None})
    assert cleaning.fit_fill_values(even) == {"CreditScore": 550.5}


def test_nan_is_treated_as_missing(spark):
    df = raw(spark, {"Balance": float("nan")}, {"Balance": 4.0}, {"Balance": 6.0})
    assert cleaning.clean_customers(df).where("customer_id = 101").first()["balance"] == 500.0


def test_first_occurrence_wins_even_if_invalid(spark):
    df = raw(spark, {"CustomerId": 7, "Age": 17}, {"CustomerId": 7, "Age": 50}, {"Balance": -0.5}, {"CreditScore": 900})
    assert cleaning.clean_customers(df).count() == 0
    report = {r["counter"]: r["row_count"] for r in cleaning.cleaning_report(df).collect()}
    assert report == {
        "initial": 4, "duplicate": 2, "invalid_age": 1, "invalid_balance": 1, "invalid_credit_score": 1, "final": 0, "removed": 4,
    }


def test_schema_of_customers(spark):
    assert cleaning.clean_customers(raw(spark, {})).schema == CUSTOMERS


def test_null_counts(spark):
    df = raw(spark, {"Surname": None}, {"Surname": None, "Age": None})
    counts = {r["column_name"]: r["null_count"] for r in cleaning.null_counts(df).collect()}
    assert counts["Surname"] == 2 and counts["Age"] == 1 and counts["Gender"] == 0 and len(counts) == 14


def test_dedup_limits_each_key_before_the_shuffle(spark):
    plan = plan_of(cleaning.keep_first(raw(spark, {}), "CustomerId", "RowNumber"))
    partial = plan[plan.rindex("Exchange"):]
    assert "WindowGroupLimit" in partial, plan


def test_duplicates_with_a_null_key(spark):
    df = raw(spark, {"CustomerId": None}, {"CustomerId": None}, {})
    assert cleaning.duplicate_rows(df, "CustomerId").count() == 2


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 1000)), min_size=1, max_size=40))
def test_keep_first_is_idempotent_and_keeps_the_minimum(spark, rows):
    df = spark.createDataFrame(rows, "k int, o int")
    once = cleaning.keep_first(df, "k", "o")
    got = {r["k"]: r["o"] for r in once.collect()}
    assert got == {k: min(o for kk, o in rows if kk == k) for k, _ in rows}
    assert cleaning.keep_first(once, "k", "o").count() == len(got)


def test_validation_rules_differ_on_nulls(spark):
    df = raw(spark, {"Age": None}, {"Age": 10}, {}).withColumnsRenamed({"Age": "age", "Balance": "balance", "CreditScore": "credit_score"})
    assert cleaning.drop_out_of_range(df, "age").count() == 2
    assert cleaning.keep_surely_valid(df).count() == 1
    assert df.where(F.col("age").isNull()).count() == 1
