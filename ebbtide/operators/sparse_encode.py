"""One-hot encoding of columns with many categories: a fitted dictionary that is joined in, and sparse vectors.

`preprocess` writes a column expression per category, which suits a handful. Here the dictionary is a
table, so the plan of an encoding is the same for three categories as for many thousands. The encoding is
the same, too: categories in order, the first dropped, nulls as the most frequent, unknown values zero.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.operators.joins import join_checked
from ebbtide.operators.preprocess import modes, value_counts


@dataclass
class Dictionary:
    """Categories of some columns. `table`: column, value, place (from 0, in the order of the values)."""

    table: DataFrame
    columns: list[str]
    sizes: dict[str, int]
    modes: dict[str, str]

    @property
    def encoded(self) -> list[str]:
        """Columns that give features: one with a single category, or none, gives no feature."""
        return [c for c in self.columns if self.sizes.get(c, 0) > 1]

    def features(self) -> DataFrame:
        """column, value, position in the assembled vector of every category that has a feature."""
        first, rows = 0, []
        for c in self.encoded:
            rows.append((c, first))
            first += self.sizes[c] - 1
        starts = self.table.sparkSession.createDataFrame(rows, "column string, start long")
        placed = self.table.where("place > 0").join(F.broadcast(starts), "column")  # a row per column
        return placed.select("column", "value", (F.col("start") + F.col("place") - 1).alias("position"))


def fit_dictionary(df: DataFrame, columns: list[str], path: str) -> Dictionary:
    """Categories of the columns, their numbers and the most frequent ones; stored under path.

    Values are counted in one pass. They are numbered without a sort in one task: ranges of the order are
    stored with their number, counted within, and tied together by their sizes, a row per range and column.
    """
    spark = df.sparkSession
    counts = value_counts(df, columns).persist()
    ranged = counts.select("column", "value").repartitionByRange("column", "value")
    # what range a value fell into is written down: sampled bounds may differ the next time
    ranged.withColumn("range_no", F.spark_partition_id()).write.mode("overwrite").parquet(f"{path}/ranges")
    common = modes(counts)
    counts.unpersist()
    ranges = spark.read.schema("column string, value string, range_no int").parquet(f"{path}/ranges")
    along = Window.partitionBy("column").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before")
    starts = ranges.groupBy("column", "range_no").agg(F.count("*").alias("n")).select("column", "range_no", before)
    within = Window.partitionBy("column", "range_no").orderBy("value")
    placed = ranges.withColumn("_row", F.row_number().over(within)).join(F.broadcast(starts), ["column", "range_no"])
    placed = placed.select("column", "value", (F.col("before") + F.col("_row") - 1).alias("place"))
    placed.write.mode("overwrite").parquet(f"{path}/dictionary")
    table = spark.read.schema("column string, value string, place long").parquet(f"{path}/dictionary")
    sizes = {r["column"]: r["n"] for r in table.groupBy("column").agg(F.count("*").alias("n")).collect()}
    return Dictionary(table, list(columns), sizes, common)


def _index(df: DataFrame, dictionary: Dictionary, column: str) -> DataFrame:
    """Add `<column>_index`: the category's feature; the dropped category and unknown values have the last one,
    which the encoder drops."""
    none = dictionary.sizes[column] - 1
    own = dictionary.table.where(F.col("column") == column).select(F.col("value").alias("_value"), F.col("place").alias("_place"))
    asked = df.withColumn("_value", F.coalesce(F.col(column).cast("string"), F.lit(dictionary.modes.get(column))))
    joined = join_checked(asked, own, ["_value"], "left")
    index = F.when(F.col("_place") > 0, F.col("_place") - 1).otherwise(none).cast("double")
    nominal = {"ml_attr": {"type": "nominal", "name": f"{column}_index", "num_vals": none + 1}}
    return joined.withColumn("_index", index).select(*df.columns, F.col("_index").alias(f"{column}_index", metadata=nominal))


def encode(df: DataFrame, dictionary: Dictionary, numeric: list[str] | None = None, output: str = "features") -> DataFrame:
    """df with a sparse vector of the numeric columns, as they are, and the columns of the dictionary.

    The dictionary is joined by a checked broadcast, or by shuffling where it is too large; hot categories
    are then left to the skew handling of the planner. The order of rows is not kept.
    """
    columns = dictionary.encoded
    for column in columns:
        df = _index(df, dictionary, column)
    vectors = []
    if columns:
        vectors = [f"{c}_vector" for c in columns]
        # the sizes are in the columns' metadata, so nothing is read to fit it
        encoder = OneHotEncoder(inputCols=[f"{c}_index" for c in columns], outputCols=vectors, dropLast=True)
        df = encoder.fit(df).transform(df)
    assembled = VectorAssembler(inputCols=[*(numeric or []), *vectors], outputCol=output).transform(df)
    return assembled.drop(*vectors, *[f"{c}_index" for c in columns])
