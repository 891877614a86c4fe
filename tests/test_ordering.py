import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ebbtide.operators.joins import join_checked
from ebbtide.operators.ordering import exact_medians, exact_quantiles, running_totals

QUIET = dict(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.mark.parametrize("max_values", [1_000_000, 50])
def test_quantiles_of_many_values(spark, max_values):
    rng = random.Random(3)
    values = [rng.gauss(0, 1e6) for _ in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = exact_quantiles(df, {"v": F.col("v")}, [0.0, 0.25, 0.5, 0.75, 1.0], max_values)["v"]
    assert got == pytest.approx(np.quantile(values, [0, 0.25, 0.5, 0.75, 1.0]).tolist(), rel=1e-12)


def test_quantiles_with_a_third_of_the_rows_on_one_value(spark):
    rng = random.Random(4)
    values = [0.0] * 10_000 + [rng.random() for _ in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = exact_quantiles(df, {"v": F.col("v")}, [0.2, 1 / 3, 0.5], max_values=100)["v"]
    assert got == pytest.approx(np.quantile(values, [0.2, 1 / 3, 0.5]).tolist(), rel=1e-12)


def test_median_of_nothing(spark):
    df = spark.createDataFrame([(None, 1)], "a double, b int")
    assert exact_medians(df, ["a", "b"]) == {"a": None, "b": 1.0}


@settings(**QUIET)
@given(st.lists(st.integers(-20, 20), min_size=1, max_size=30))
def test_median_matches_numpy(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    assert exact_medians(df, ["v"])["v"] == pytest.approx(float(np.median(values)))


@settings(**QUIET)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 3)), min_size=1, max_size=60), st.booleans())
def test_running_totals_match_brute_force(spark, rows, descending):
    df = spark.createDataFrame([(float(k), n) for k, n in rows], "k double, n int")
    got = running_totals(df, "k", {"n": F.sum("n")}, descending, ranges=4)
    got = {r["k"]: (r["n"], r["cum_n"]) for r in got.collect()}
    keys = {float(k) for k, _ in rows}
    before = (lambda a, b: a >= b) if descending else (lambda a, b: a <= b)
    assert got == {
        k: (sum(n for kk, n in rows if kk == k), sum(n for kk, n in rows if before(kk, k))) for k in keys
    }


def test_join_checked_broadcasts_only_what_fits(spark):
    from conftest import plan_of

    big = spark.range(1000).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k").persist()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few, many = join_checked(big, small, ["k"], "inner", 10 * 24), join_checked(big, small, ["k"], "inner", 9 * 24)
        assert "BroadcastHashJoin" in plan_of(few)
        assert "BroadcastHashJoin" not in plan_of(many)
        assert few.count() == many.count() == 10
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
