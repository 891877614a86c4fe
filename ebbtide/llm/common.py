"""What the operators share: reading tables and keeping intermediate ones in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def normalized(text: Column) -> Column:
    """Lower case, letters and digits only, one blank between words and at both ends."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\p{M}]+", " ")), F.lit(" "))


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new path under the folder all executors share."""
    return shared_dir(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, name: str, compression: str = "lz4") -> DataFrame:
    """The rows, written to the shared folder and read from there: a lost executor loses none of them.

    The written table has a known size, so joins with it are planned by size.
    """
    path = fresh_dir(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a stored table that no later step reads."""
    spark = df.sparkSession
    jvm = spark._jvm
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if "/llm/" not in folder:
            raise ValueError(f"not an intermediate table: {folder}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches: Iterator[pa.RecordBatch], column: int, most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts hold about most_bytes together; a longer text comes alone."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        first = held = 0
        for row, size in enumerate(sizes):
            if row > first and held + size > most_bytes:
                yield batch.slice(first, row - first)
                first, held = row, 0
            held += size
        if first < batch.num_rows:
            yield batch.slice(first)


def _few(keys: DataFrame, most_bytes: int, row_bytes: int = 64) -> bool:
    """Whether a hash relation of the rows (a number each, unless row_bytes says more) stays within most_bytes."""
    return keys.count() * row_bytes <= most_bytes


def in_order(df: DataFrame, rows: int, each: int, *columns: str) -> DataFrame:
    """df sorted by the columns over all its partitions, about `each` of its rows (so many in all) in one.

    The rows alone decide the number of tasks, so what a task reads does not grow with the table. Every
    task has one range of the order: its rows go on in the tasks beside it only.
    """
    return df.repartitionByRange(max(1, -(-rows // each)), *columns).sortWithinPartitions(*columns)


def only_keys(df: DataFrame, keys: DataFrame, key: str, most_bytes: int = 32 << 20) -> DataFrame:
    """Rows of df whose key is among the keys (one column of whole numbers, stored before).

    The keys are counted where they lie; up to most_bytes of them are broadcast, more are joined by
    shuffling both sides.
    """
    slim = keys.select(key)
    return df.join(F.broadcast(slim) if _few(keys, most_bytes) else slim.distinct().hint("shuffle_merge"), key, "left_semi")


def without_keys(df: DataFrame, keys: DataFrame, key: str, most_bytes: int = 32 << 20) -> DataFrame:
    """The other rows, by the same rules; rows without a key stay."""
    slim = keys.select(key)
    return df.join(F.broadcast(slim) if _few(keys, most_bytes) else slim.distinct().hint("shuffle_merge"), key, "left_anti")


def beside(df: DataFrame, rows: DataFrame, condition: Column, row_bytes: int, most_bytes: int = 32 << 20) -> DataFrame:
    """df with what a stored table has for each row, if anything; broadcast if it is small."""
    return df.join(F.broadcast(rows) if _few(rows, most_bytes, row_bytes) else rows, condition, "left")
