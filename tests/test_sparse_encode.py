import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import plan_of
from ebbtide.operators import joins, preprocess, sparse_encode

ROWS = [(1, "b", "x", 0.5), (2, "a", "x", 1.5), (3, None, "x", 2.5), (4, "c", "x", 3.5), (5, "b", None, 4.5)]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "id long, place string, same string, v double")


def vectors(encoded):
    return {r["id"]: r["a"] for r in encoded.select("id", vector_to_array("features").alias("a")).collect()}


def test_order_dropped_first_nulls_and_unknown_values(spark, rows, tmp_path):
    fitted = sparse_encode.fit_dictionary(rows, ["place", "same"], str(tmp_path / "d"))
    assert fitted.sizes == {"place": 3, "same": 1} and fitted.modes == {"place": "b", "same": "x"}
    assert fitted.encoded == ["place"]  # a single category is dropped, and with it the column
    assert {(r["value"], r["position"]) for r in fitted.features().collect()} == {("b", 0), ("c", 1)}
    more = rows.unionByName(spark.createDataFrame([(6, "new", "x", 0.0)], rows.schema))
    encoded = sparse_encode.encode(more, fitted, ["v"])
    assert encoded.columns == [*rows.columns, "features"]
    assert vectors(encoded) == {1: [0.5, 1, 0], 2: [1.5, 0, 0], 3: [2.5, 1, 0], 4: [3.5, 0, 1], 5: [4.5, 1, 0], 6: [0, 0, 0]}


def test_the_same_as_an_expression_per_category(spark, customers, tmp_path):
    fitted = sparse_encode.fit_dictionary(customers, preprocess.CATEGORICAL, str(tmp_path / "d"))
    sparse = sparse_encode.encode(customers, fitted).select("customer_id", vector_to_array("features").alias("a"))
    counts = preprocess.value_counts(customers, preprocess.CATEGORICAL)
    known, common = preprocess.categories(counts, preprocess.CATEGORICAL), preprocess.modes(counts)
    flags = [F.when(F.coalesce(F.col(c), F.lit(common[c])) == v, 1.0).otherwise(0.0) for c in preprocess.CATEGORICAL for v in known[c][1:]]
    dense = customers.select("customer_id", F.array(*flags).alias("a"))
    assert sparse.count() == customers.count()
    assert sparse.exceptAll(dense).count() == 0


def test_the_plan_does_not_grow_with_the_categories(spark, tmp_path):
    def plan(n):
        df = spark.range(n).select("id", F.format_string("place %06d", "id").alias("place"))
        fitted = sparse_encode.fit_dictionary(df, ["place"], str(tmp_path / f"d{n}"))
        encoded = sparse_encode.encode(df, fitted)
        last = encoded.where(F.col("id") == n - 1).first()["features"]
        assert (last.size, list(last.indices)) == (n - 1, [n - 2])  # one number is stored, not n
        return len(plan_of(encoded).splitlines())

    assert plan(5) == plan(50_000)


def test_places_are_gapless_and_in_order_over_ranges(spark, tmp_path):
    df = spark.range(3000).select(F.format_string("%04d", F.col("id") * 7 % 3000).alias("a"), F.format_string("%02d", F.col("id") % 30).alias("b"))
    table = sparse_encode.fit_dictionary(df, ["a", "b"], str(tmp_path / "d")).table
    for column, n in (("a", 3000), ("b", 30)):
        found = table.where(F.col("column") == column).orderBy("value").select("place").collect()
        assert [r["place"] for r in found] == list(range(n))


def test_a_large_dictionary_is_joined_by_shuffling(spark, rows, tmp_path, monkeypatch):
    fitted = sparse_encode.fit_dictionary(rows, ["place"], str(tmp_path / "d"))
    expected = vectors(sparse_encode.encode(rows, fitted))
    monkeypatch.setattr(joins, "fits", lambda df, most_bytes=0: False)
    assert vectors(sparse_encode.encode(rows, fitted)) == expected


def test_an_empty_table_and_a_column_of_nulls(spark, rows, tmp_path):
    empty = sparse_encode.fit_dictionary(rows.limit(0), ["place"], str(tmp_path / "e"))
    assert empty.encoded == [] and vectors(sparse_encode.encode(rows, empty, ["v"]))[1] == [0.5]
    nulls = rows.withColumn("place", F.lit(None).cast("string"))
    fitted = sparse_encode.fit_dictionary(rows, ["place"], str(tmp_path / "d"))
    assert vectors(sparse_encode.encode(nulls, fitted))[2] == [1, 0]
