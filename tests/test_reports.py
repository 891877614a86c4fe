import math

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from ebbtide.operators import eda, joins, reports
from ebbtide.plans import exports
from ebbtide.schemas import CUSTOMERS

ALL = [
    reports.CHURN_BY_GEOGRAPHY, reports.CHURN_BY_AGE_GROUP, reports.CHURN_BY_PRODUCTS, reports.CHURN_BY_CREDIT_BAND,
    reports.CHURN_BY_ACTIVE, reports.CHURN_BY_TENURE, reports.CHURN_BY_GENDER, reports.CREDIT_SCORE_SUMMARY,
]


def test_totals_add_up(customers):
    n, churned = customers.agg(F.count("*"), F.sum("exited")).first()
    for report in ALL:
        rows = report.of(customers).collect()
        assert sum(r["total_customers"] for r in rows) == n
        assert sum(r["churned_customers"] for r in rows) == churned


def test_cube_gives_the_same_reports(spark, customers):
    gaps = spark.createDataFrame(
        [(1, None, None, "Male", None, None, None, None, 0, 1, 1.0, 1), (2, 399.5, "Delhi", None, 61, 3, 2.0, 1, 0, 0, 1.0, None)],
        CUSTOMERS,
    )
    both = customers.unionByName(gaps)
    cube = reports.segment_cube(both).persist()
    for report in ALL:
        assert report.of_cube(cube).collect() == report.of(both).collect() or sorted(
            map(str, report.of_cube(cube).collect())
        ) == sorted(map(str, report.of(both).collect()))
    direct = {r["exited"]: r["avg_balance"] for r in reports.balance_by_exited(both).collect()}
    rolled = {r["exited"]: r["avg_balance"] for r in reports.balance_by_exited_of_cube(cube).collect()}
    assert direct == rolled


def test_band_order(customers):
    ages = [r[0] for r in reports.CHURN_BY_AGE_GROUP.of(customers).collect()]
    assert ages == [a for a in reports.AGE_LABELS if a in ages]
    rates = [r["churn_rate_pct"] for r in reports.CHURN_BY_GEOGRAPHY.of(customers).collect()]
    assert rates == sorted(rates, reverse=True)


def test_empty_bins_show_zero(spark):
    one = spark.createDataFrame([(1, 650.0, "Delhi", "Male", 40, 1, 1.0, 1, 1, 1, 1.0, 1)], CUSTOMERS)
    rows = [tuple(r) for r in reports.credit_band_by_exited(one).collect()]
    assert rows == [("<400", 0, 0), ("400-500", 0, 0), ("500-600", 0, 0), ("600-700", 0, 1), ("700-800", 0, 0), ("800+", 0, 0)]


def test_measures_of_an_empty_table(spark):
    row = reports.bi_measures(spark.createDataFrame([], CUSTOMERS)).first()
    assert (row["total_customers"], row["churn_rate"], row["retention_rate"], row["active_rate"]) == (0, 0.0, 1.0, 0.0)


def test_a_report_reads_two_columns_in_one_shuffle(customers):
    plan = plan_of(reports.CHURN_BY_ACTIVE.of(customers))
    schema = plan[plan.index("ReadSchema"):]
    assert schema.count(":") == 3 and "is_active_member" in schema and "exited" in schema
    assert plan.count("Exchange") == 1


def test_slices_reach_the_scan(customers):
    plan = plan_of(reports.sliced(customers, geography=["Delhi"], gender=["Male"]).select("customer_id"))
    pushed = plan[plan.index("PushedFilters"):plan.index("ReadSchema")]
    assert "geography" in pushed and "gender" in pushed


def test_segment_join_does_not_shuffle_the_fact(customers):
    fact = customers.select("customer_id", "geography")
    joined = joins.with_segment_summary(fact, reports.GEOGRAPHY_SUMMARY.of(customers), "geography", "s_")
    joined.collect()
    plan = plan_of(joined)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_exports_are_written_with_headers(spark, customers, tmp_path):
    names = exports.export_reports(customers, str(tmp_path))
    assert len(names) == 7
    back = spark.read.option("header", True).csv(str(tmp_path / "balance_churn"))
    assert back.columns == ["exited", "total_customers", "avg_balance"] and back.count() == 2
    exports.export_bi(customers, str(tmp_path / "bi"))
    assert spark.read.option("header", True).csv(str(tmp_path / "bi" / "churn_master")).count() == customers.count()


def test_history_and_table_sinks(spark, tmp_path):
    df = spark.range(3)
    path = str(tmp_path / "t")
    exports.replace_table(df, path)
    exports.append_table(df, path)
    assert spark.read.parquet(path).count() == 6
    exports.replace_table(df, path)
    assert spark.read.parquet(path).count() == 3
    exports.export_history(df, str(tmp_path / "h"))
    assert spark.read.option("header", True).csv(str(tmp_path / "h")).count() == 3


def test_box_of_a_small_sample(spark):
    rows = [(float(v), 0) for v in [1, 2, 3, 4, 100]] + [(5.0, 1)]
    df = spark.createDataFrame(rows, "credit_score double, exited int")
    box = {r["exited"]: r for r in eda.box_stats(df).collect()}
    assert (box[0]["q1"], box[0]["median"], box[0]["q3"]) == (2.0, 3.0, 4.0)
    assert (box[0]["whisker_low"], box[0]["whisker_high"], box[0]["outliers"]) == (1.0, 4.0, 1)
    assert [r["credit_score"] for r in eda.outliers(df).collect()] == [100.0]


def test_density_integrates_to_one(customers):
    rows = eda.kde(customers, "age").where("exited = 0").orderBy("x").collect()
    assert len(rows) == 200
    area = sum((b["x"] - a["x"]) * (a["density"] + b["density"]) / 2 for a, b in zip(rows, rows[1:]))
    assert area == pytest.approx(1.0, abs=0.01)


def test_correlation_of_a_constant_and_of_gaps(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0)], "a double, b double, c double")
    got = {(r[0], r[1]): r[2] for r in eda.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == got["b", "a"] == 1.0 and got["a", "a"] == 1.0
    assert got["c", "c"] is None and (got["a", "c"] is None or math.isnan(got["a", "c"]))
    assert len(got) == 9


def test_probability_of_hundred_percent_is_in_the_last_bin(spark):
    df = spark.createDataFrame([(100.0,), (99.0,), (0.0,), (9.99,), (10.0,)], "churn_probability double")
    assert {r[0]: r[1] for r in reports.probability_histogram(df).collect()} == {0: 2, 1: 1, 9: 2}
