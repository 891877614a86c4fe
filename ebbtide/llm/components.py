"""Connected components of a table of links, by alternating large and small stars.

Each task first replaces the links it holds by stars of its own, so long chains and dense groups
shrink before anything is shuffled. Then every round ties each node's larger neighbours to its
smallest (large star) and each node and its smaller neighbours to the smallest (small star), until
all links form separate stars around the smallest node of each component. Links are kept in the shared folder between
rounds, so a lost executor costs one round at most.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import discard, stored


TASK_LINKS = 100_000  # links of a task are joined at once


class Union:
    """Groups of whole numbers; each is named by its smallest member."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        root = x
        while (above := up.get(root, root)) != root:
            root = above
        while x != root:
            up[x], x = root, up.get(x, x)
        return root

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        self.up.setdefault(min(a, b), min(a, b))
        return True


def _local_stars(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    union = Union()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            union.join(a, b)
    pairs = [(x, r) for x in union.up if (r := union.find(x)) != x]
    for first in range(0, len(pairs), 100_000):
        part = pairs[first : first + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in part], pa.int64()) for i in (0, 1)], names=["a", "b"])


def _mixed(pairs: DataFrame) -> bool:
    """Whether some node has two links upwards, or one and a link from below: then stars are not apart."""
    ends = pairs.select(F.col("a").alias("node"), F.lit(1).alias("up")).unionByName(pairs.select(F.col("b").alias("node"), F.lit(0).alias("up")))
    roles = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.count("*").alias("all"))
    return bool(roles.where("ups > 1 OR (ups = 1 AND all > 1)").take(1))


def components(links: DataFrame) -> DataFrame:
    """node, component of every node that has a link; links: two columns of whole numbers.

    Links to itself and those with a null end are ignored. No link, no row.
    """
    a, b = links.columns
    pairs = links.select(F.greatest(a, b).cast("long").alias("a"), F.least(a, b).cast("long").alias("b"))
    pairs = stored(pairs.where("a > b AND a IS NOT NULL AND b IS NOT NULL"), "links")
    tasks = -(-pairs.count() // TASK_LINKS)
    pairs = stored(pairs.coalesce(max(1, tasks)).mapInArrow(_local_stars, "a long, b long"), "links")
    while tasks > 1 and _mixed(pairs):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b").distinct()
        small_least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(small_least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = stored(small.unionByName(small_least.select("a", F.col("m").alias("b"))).distinct(), "links")
        discard(pairs)
        pairs = after
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
