"""Which partitions of a table may hold some ids: a key range and a Bloom filter per partition, as tables.

A filter is a table of 64-bit words. An id sets four bits of one word, both chosen by its hash, so a
lookup is an equality join on the word's number. The number of words is a power of two that follows
from the partition's rows, about KEYS_PER_WORD ids a word: two bytes an id, under two in a hundred ids
held by mistake, none missed. Ranges are compared first; only the filters of partitions whose range
the asked ids touch are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.operators.joins import join_checked

KEYS_PER_WORD = 4
MOST_LEVELS = 40  # the hash's other 24 bits choose the bits of a word
INTERVALS = 1000  # of the asked ids, compared with the partitions' ranges

PARTITION = "ingest_batch"
RANGES = T.StructType([
    T.StructField("level", T.IntegerType()),
    T.StructField("first_id", T.LongType()),
    T.StructField("last_id", T.LongType()),
    T.StructField(PARTITION, T.StringType()),
])
WORDS = T.StructType([
    T.StructField("level", T.IntegerType()),
    T.StructField("word", T.LongType()),
    T.StructField("bits", T.LongType()),
    T.StructField(PARTITION, T.StringType()),
])


def _place(key: str, level: Column) -> tuple[Column, Column]:
    """Number of an id's word among 2^level, and the bits it sets there."""
    hashed = F.xxhash64(F.col(key).cast("long"))
    word = hashed.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), level) - 1)
    bits = F.lit(0).cast("long")
    for shift in range(MOST_LEVELS, 64, 6):
        number = F.shiftrightunsigned(hashed, shift).bitwiseAND(63).cast("int")
        bits = bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), number))
    return word, bits


def level_for(rows: int) -> int:
    """The power of two of a filter's words."""
    return min(MOST_LEVELS, (-(-max(rows, 1) // KEYS_PER_WORD) - 1).bit_length())


def build(ids: DataFrame, key: str = "customer_id") -> tuple[DataFrame, DataFrame]:
    """Range and filter of one partition's ids, without PARTITION. Rows without an id are left out:
    they equal none. A partition without ids has neither."""
    ids = ids.select(F.col(key).cast("long").alias(key)).where(F.col(key).isNotNull())
    ends = ids.agg(F.count("*").alias("rows"), F.min(key).alias("first_id"), F.max(key).alias("last_id")).first()
    level = level_for(ends["rows"])
    word, bits = _place(key, F.lit(level))
    words = ids.select(word.alias("word"), bits.alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    schema = T.StructType(RANGES.fields[:3])
    ranges = [(level, ends["first_id"], ends["last_id"])] if ends["rows"] else []
    return ids.sparkSession.createDataFrame(ranges, schema), words.select(F.lit(level).alias("level"), "word", "bits")


def intervals(asked: DataFrame, key: str = "customer_id") -> DataFrame:
    """At most INTERVALS ranges that hold all asked ids."""
    ends = asked.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    low, high = ends["lo"] or 0, ends["hi"] or 0
    width = (high - low) // INTERVALS + 1
    # a spread beyond 64 bits has no difference that fits: one interval then
    part = (F.col(key).cast("long") - low) / width if high - low < 1 << 53 else F.lit(0)
    own = asked.where(F.col(key).isNotNull()).groupBy(F.floor(part).alias("part"))
    return own.agg(F.min(key).cast("long").alias("first_asked"), F.max(key).cast("long").alias("last_asked"))


def holders(asked: DataFrame, ranges: DataFrame, words: DataFrame, key: str = "customer_id") -> list[str]:
    """Names of the partitions that may hold an asked id; ones that do are always among them.

    asked: distinct ids, persisted by the caller. ranges has a row per partition; names are what the
    driver lists anyway. The filters' words are joined with the asked ids' words, by a checked broadcast
    of the latter.
    """
    touched = (F.col("first_id") <= F.col("last_asked")) & (F.col("last_id") >= F.col("first_asked"))
    near = ranges.join(F.broadcast(intervals(asked, key)), touched, "left_semi").collect()  # INTERVALS rows at most are broadcast
    if not near:
        return []
    levels = F.explode(F.array(*[F.lit(level) for level in sorted({r["level"] for r in near})]))  # at most MOST_LEVELS
    probes = asked.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), levels.alias("level"))
    word, bits = _place("id", F.col("level"))
    probes = probes.select("id", "level", word.alias("word"), bits.alias("wanted")).persist()
    own = words.where(F.col(PARTITION).isin([r[PARTITION] for r in near]))
    found = join_checked(own, probes, ["level", "word"], "inner").where(F.col("bits").bitwiseAND(F.col("wanted")) == F.col("wanted"))
    # a row per partition
    in_range = found.join(F.broadcast(ranges.drop("level")), PARTITION).where("id BETWEEN first_id AND last_id")
    names = sorted(r[PARTITION] for r in in_range.select(PARTITION).distinct().collect())
    probes.unpersist()
    return names
