"""Sorted rows in blocks, a tree of summaries over the blocks, and the pairs of blocks worth joining.

Blocks lie in one order within each root. FAN neighbours form a node, FAN nodes the next, up to one
node per root. Pairs are found from the top: each kept pair of nodes gives the pairs of their children,
and those that the caller's bound rules out are skipped. All steps are joins on (root, node), in which
a pair meets FAN x FAN children at most, so no root's blocks are ever paired all with all.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import stored

FAN = 16


def _level(below: DataFrame, merges: dict[str, Callable]) -> DataFrame:
    parent = F.expr(f"node div {FAN}").alias("node")
    return below.groupBy("root", parent).agg(*[merge(c).alias(c) for c, merge in merges.items()])


def block_pairs(blocks: DataFrame, merges: dict[str, Callable], may_join: Callable[[Callable, Callable], Column]) -> DataFrame:
    """root, a, b: pairs of block numbers (a <= b) that no bound rules out.

    blocks: root, part (of the order), seq (in the part) and the columns in merges, each with the
    aggregate that sums it up. may_join gets two functions from a column's name to the left and right
    node's column.
    """
    ends = blocks.agg(F.max("part").alias("part"), F.max("seq").alias("seq")).first()
    if ends["seq"] is None:
        names = "root {}, a_part int, a_seq long, b_part int, b_seq long".format(blocks.schema["root"].dataType.simpleString())
        return blocks.sparkSession.createDataFrame([], names)
    span = FAN
    while span <= ends["seq"]:
        span *= FAN
    columns: Sequence[str] = list(merges)
    level = stored(blocks.select("root", block_number(span).alias("node"), *columns), "nodes")
    levels, last = [level], (ends["part"] + 1) * span
    while last > 1:
        level = stored(_level(level, merges), "nodes")
        levels.append(level)
        last = -(-last // FAN)
    pairs = levels[-1].select("root", F.col("node").alias("a"), F.col("node").alias("b"))
    for level in reversed(levels[:-1]):
        left = level.select("root", F.expr(f"node div {FAN}").alias("a"), F.col("node").alias("a2"), *[F.col(c).alias(f"l_{c}") for c in columns])
        right = level.select("root", F.expr(f"node div {FAN}").alias("b"), F.col("node").alias("b2"), *[F.col(c).alias(f"r_{c}") for c in columns])
        joined = pairs.join(left, ["root", "a"]).join(right, ["root", "b"])
        kept = joined.where((F.col("a2") <= F.col("b2")) & may_join(lambda c: F.col(f"l_{c}"), lambda c: F.col(f"r_{c}")))
        pairs = stored(kept.select("root", F.col("a2").alias("a"), F.col("b2").alias("b")), "pairs")
    return pairs.select("root", F.expr(f"a div {span}").cast("int").alias("a_part"), F.expr(f"a % {span}").alias("a_seq"), F.expr(f"b div {span}").cast("int").alias("b_part"), F.expr(f"b % {span}").alias("b_seq"))


def block_number(span: int) -> Column:
    return (F.col("part").cast("long") * span + F.col("seq")).cast("long")


def with_payloads(pairs: DataFrame, blocks: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each pair with both blocks' columns, as a_<column> and b_<column>."""
    for side in "ab":
        own = blocks.select("root", *[F.col(c).alias(f"{side}_{c}") for c in ("part", "seq", *columns)])
        pairs = pairs.join(own, ["root", f"{side}_part", f"{side}_seq"])
    return pairs
