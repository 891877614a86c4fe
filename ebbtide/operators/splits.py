"""Reproducible stratified split and folds, ranked by md5 of the key within each class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.operators.ordering import HASH_DIGITS, hash_order

SEED = 42
TEST_FRACTION = 0.2
FOLDS = 5


def _hashed(df: DataFrame, label: str, key: str, seed: int) -> DataFrame:
    """Class (0, 1 or -1 for none) and hash bucket of each row: 3 * 16^4 cells at most."""
    class_of = F.when(F.col(label) == 1, 1).when(F.col(label) == 0, 0).otherwise(-1)
    hashed = df.withColumns({"_class": class_of, "_hash": hash_order(key, seed)})
    return hashed.withColumn("_bucket", F.substring("_hash", 1, HASH_DIGITS))


def _cells(hashed: DataFrame) -> DataFrame:
    """Rows per (class, bucket) and the rows of the class that come before."""
    before = Window.partitionBy("_class").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = hashed.groupBy("_class", "_bucket").agg(F.count("*").alias("_n"))
    return counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))


def split_rule(
    df: DataFrame, label: str = "exited", key: str = "customer_id", fraction: float = TEST_FRACTION, seed: int = SEED
) -> Column:
    """An expression that is 'test' for the first round(fraction * n) rows of each class.

    Only the bucket that holds a class's last test row is sorted, a 16^4th of the class.
    The rule is then a comparison with one hash per class: the table is never shuffled.
    """
    hashed = _hashed(df.select(key, label), label, key, seed)
    cells = _cells(hashed)
    size = F.sum("_n").over(Window.partitionBy("_class"))
    wanted = F.round(F.lit(fraction) * size, 0).cast("long")
    last = (
        cells.withColumn("_wanted", wanted)
        .where((F.col("_before") < F.col("_wanted")) & (F.col("_wanted") <= F.col("_before") + F.col("_n")))
        .select("_class", "_bucket", (F.col("_wanted") - F.col("_before")).alias("_place"))
    ).collect()  # one row per class, three at most
    in_last = F.lit(False)
    place = F.lit(None).cast("long")
    for row in last:
        here = (F.col("_class") == row["_class"]) & (F.col("_bucket") == row["_bucket"])
        in_last = in_last | here
        place = F.when(here, F.lit(row["_place"])).otherwise(place)
    ranked = hashed.where(in_last).withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_class").orderBy("_hash", key))
    )
    bounds = ranked.where(F.col("_rank") == place).select("_class", "_hash", F.col(key).alias("_key")).collect()
    # the last test row of the row's class, compared in the order (hash, key)
    hash_bound, key_bound = F.lit(None).cast("string"), F.lit(None).cast(df.schema[key].dataType)
    for row in bounds:
        in_class = F.col(label) == row["_class"] if row["_class"] >= 0 else ~F.coalesce(F.col(label).isin(0, 1), F.lit(False))
        hash_bound = F.when(in_class, F.lit(row["_hash"])).otherwise(hash_bound)
        key_bound = F.when(in_class, F.lit(row["_key"])).otherwise(key_bound)
    mine = F.struct(hash_order(key, seed).alias("h"), F.col(key).alias("k"))
    last_test = F.struct(hash_bound.alias("h"), key_bound.cast(df.schema[key].dataType).alias("k"))
    return F.when(hash_bound.isNotNull() & (mine <= last_test), "test").otherwise("train")


def stratified_split(df: DataFrame, label: str = "exited", key: str = "customer_id", **options) -> DataFrame:
    return df.withColumn("split", split_rule(df, label, key, **options))


def with_folds(
    df: DataFrame, label: str = "exited", key: str = "customer_id", folds: int = FOLDS, seed: int = SEED
) -> DataFrame:
    """Add `fold`: rank within the class, modulo the number of folds.

    A row's rank is its place in its bucket plus the rows of earlier buckets, so no task
    sees more than one bucket of a class. The offsets are bounded by the number of cells.
    """
    hashed = _hashed(df, label, key, seed)
    offsets = F.broadcast(_cells(hashed.select("_class", "_bucket")).select("_class", "_bucket", "_before"))
    in_bucket = F.row_number().over(Window.partitionBy("_class", "_bucket").orderBy("_hash", key))
    ranked = hashed.withColumn("_place", in_bucket).join(offsets, ["_class", "_bucket"])
    fold = ((F.col("_before") + F.col("_place") - 1) % folds).cast("int")
    return ranked.withColumn("fold", fold).drop("_class", "_hash", "_bucket", "_place", "_before")
