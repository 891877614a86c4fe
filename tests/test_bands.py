from pyspark.sql import functions as F

from ebbtide.functions import bands, checks
from ebbtide.functions.features import ENGINEERED, add_engineered_features
from ebbtide.plans.scoring import with_risk


def labels(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_age_band_edges(spark):
    got = labels(spark, [18, 29, 30, 44, 45, 59, 60, 100, None], "long", bands.age_group("v"))
    assert got == ["<30", "<30", "30-45", "30-45", "45-60", "45-60", "60+", "60+", "60+"]


def test_credit_band_edges(spark):
    scores = [300.0, 399.0, 400.0, 499.5, 500.0, 600.0, 700.0, 799.0, 800.0, None]
    got = labels(spark, scores, "double", bands.credit_band("v"))
    assert got == [
        "<400", "<400", "400-500", "400-500", "500-600", "600-700", "700-800", "700-800", "800+", "800+",
    ]
    named = labels(spark, [399.0, 850.0], "double", bands.credit_band("v", with_quality=True))
    assert named == ["<400 (Very Poor)", "800+ (Excellent)"]


def test_risk_is_taken_from_the_rounded_percent(spark):
    p = [0.2999, 0.29996, 0.30, 0.60, 0.60004, 0.6001, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(p)], "i int, p double")
    rows = with_risk(df, "p").orderBy("i").collect()
    assert [r["churn_probability"] for r in rows] == [29.99, 30.0, 30.0, 60.0, 60.0, 60.01, None]
    assert [r["risk_level"] for r in rows] == ["Low", "Medium", "Medium", "Medium", "Medium", "High", None]
    assert [r["color_class"] for r in rows] == ["success", "warning", "warning", "warning", "warning", "danger", None]


def test_engineered_features_with_gaps(spark):
    df = spark.createDataFrame(
        [(100.0, 49.0, 0, 45, 0), (100.0, -1.0, 3, 34, 1), (None, 9.0, None, None, None)],
        "balance double, estimated_salary double, num_products int, age int, is_active_member int",
    )
    rows = [tuple(r) for r in add_engineered_features(df).select(*ENGINEERED).collect()]
    assert rows[0] == (2.0, None, 0, 1, 0)
    assert rows[1] == (None, 100.0 / 3, 1, 0, 1)
    assert rows[2] == (None, None, 0, 0, 0)


def test_null_passes_domains_but_not_the_strict_range(spark):
    df = spark.createDataFrame(
        [("Delhi", "Male", 1, 0, 1, 20, 0.0, 300.0), (None, None, None, None, None, None, 1.0, 500.0),
         ("Goa", "male", 2, 0, 1, 17, -1.0, 851.0)],
        "geography string, gender string, has_credit_card int, is_active_member int, exited int,"
        " age int, balance double, credit_score double",
    )
    rows = df.select(
        checks.violations().alias("v"), checks.any_violation().alias("any"), checks.surely_valid().alias("valid"),
        *[checks.surely_invalid(c).alias(c) for c in ("age", "balance", "credit_score")],
    ).collect()
    assert [list(r["v"]) for r in rows] == [[], [], ["geography", "gender", "has_credit_card"]]
    assert [r["any"] for r in rows] == [False, False, True]
    assert [r["valid"] for r in rows] == [True, False, False]
    assert [r["age"] for r in rows] == [False, False, True]
    assert [r["balance"] for r in rows] == [False, False, True]


def test_gender_code(spark):
    assert labels(spark, ["Male", "Female", "x", None], "string", bands.gender_code("v")) == [0, 1, None, None]


def test_position_in(spark):
    assert labels(spark, ["b", "a"], "string", bands.position_in(F.col("v"), ["a", "b"])) == [2, 1]
