"""K-d tree sharding: cut the corpus at weighted medians until each leaf holds its share of bytes.

Each node is cut along the dimension in which it is widest, at the key below which the wanted part of
its bytes lies. The cut is found by histograms: a job sums the bytes of at most BUCKETS key ranges per
node, the range with the wanted rank is cut finer by the next job, and the driver sees only these sums.
All nodes of a level share their jobs, so the number of jobs depends on the depth, not on the rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import shuffle_partitions, stored

BUCKETS = 4096  # sums per node and job that the driver sees
BITS = 31
SCALE = (1 << BITS) - 1
ROW_OVERHEAD = 8


@dataclass
class Node:
    first: int  # its first shard
    leaves: int
    dim: int = 0
    cut: int | None = None  # rows with smaller keys go left
    left: Node | None = None
    right: Node | None = None

    def leaf(self, keys: Sequence[np.ndarray]) -> np.ndarray:
        """The first shard of the end of the tree in which each row lies."""
        if self.cut is None:
            return np.full(len(keys[0]), self.first)
        left = keys[self.dim] < self.cut
        out = np.empty(len(left), dtype=np.int64)
        out[left] = self.left.leaf([k[left] for k in keys])
        out[~left] = self.right.leaf([k[~left] for k in keys])
        return out

    def ends(self) -> list[Node]:
        return [self] if self.cut is None else self.left.ends() + self.right.ends()


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def _unit(value: Column, low: float, high: float) -> Column:
    """A value's place in its dimension, 0 to SCALE; without a value, 0."""
    if high <= low:
        return F.lit(0).cast("long")
    part = (value - F.lit(low)) / F.lit(high - low)
    return F.coalesce(F.floor(F.greatest(F.lit(0.0), F.least(F.lit(1.0), part)) * F.lit(float(SCALE))), F.lit(0)).cast("long")


def _columns(batch: pa.RecordBatch, dims: int) -> tuple[list[np.ndarray], np.ndarray]:
    return [batch.column(f"k{d}").to_numpy() for d in range(dims)], batch.column("size").to_numpy()


def _spans(rows: DataFrame, root: Node, dims: int) -> dict[int, dict]:
    """Bytes, lowest and highest keys of every node that is still to be cut."""
    todo = [n.first for n in root.ends() if n.leaves > 1]
    schema = "node long, total long, " + ", ".join(f"lo{d} long, hi{d} long" for d in range(dims))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, size = _columns(batch, dims)
            leaf = root.leaf(keys)
            out = []
            for node in todo:
                if (here := leaf == node).any():
                    out.append([node, int(size[here].sum()), *(int(f(k[here])) for k in keys for f in (np.min, np.max))])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=[c.split(" ")[0] for c in schema.split(", ")])

    parts = rows.select("size", *[f"k{d}" for d in range(dims)]).mapInArrow(run, schema).groupBy("node")
    ends = [f(f"{n}{d}").alias(f"{n}{d}") for d in range(dims) for n, f in (("lo", F.min), ("hi", F.max))]
    return {r["node"]: r.asDict() for r in parts.agg(F.sum("total").alias("total"), *ends).collect()}


def _histogram(rows: DataFrame, root: Node, dims: int, ranges: dict[int, tuple[int, int, int, int]]) -> dict[int, list[tuple[int, int]]]:
    """Bytes by bucket; ranges has dimension, lowest key, end and bucket width by node."""
    names = ["node", "bucket", "size"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, size = _columns(batch, dims)
            leaf = root.leaf(keys)
            for node, (dim, low, high, width) in ranges.items():
                here = (leaf == node) & (keys[dim] >= low) & (keys[dim] < high)
                buckets, place = np.unique((keys[dim][here] - low) // width, return_inverse=True)
                sums = np.zeros(len(buckets), dtype=np.int64)
                np.add.at(sums, place, size[here])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(buckets), node)), pa.array(buckets), pa.array(sums)], names=names)

    found = rows.select("size", *[f"k{d}" for d in range(dims)]).mapInArrow(run, "node long, bucket long, size long")
    by_node: dict[int, list[tuple[int, int]]] = {n: [] for n in ranges}
    for r in found.groupBy("node", "bucket").agg(F.sum("size").alias("size")).collect():
        by_node[r["node"]].append((r["bucket"], r["size"]))
    return {n: sorted(sums) for n, sums in by_node.items()}


def _grow(rows: DataFrame, root: Node, dims: int, tolerance: float) -> Node:
    while any(n.leaves > 1 for n in root.ends()):
        stats = _spans(rows, root, dims)
        nodes, search = {}, {}
        for node in root.ends():
            if node.leaves > 1:
                r = stats.get(node.first)
                nodes[node.first] = node
                if r is None:  # no rows: any cut will do
                    search[node.first] = [0, 0, 0, 0, 0]
                    continue
                spread = [(r[f"hi{d}"] >> BITS) - (r[f"lo{d}"] >> BITS) for d in range(dims)]
                node.dim = max(range(dims), key=lambda d: (spread[d], -d))
                search[node.first] = [r[f"lo{node.dim}"], r[f"hi{node.dim}"] + 1, 0, r["total"] * (node.leaves // 2) / node.leaves, r["total"]]
        _narrow(rows, root, dims, nodes, search, tolerance)
        for first, node in nodes.items():
            half = node.leaves // 2
            node.left, node.right, node.cut = Node(first, half), Node(first + half, node.leaves - half), search[first][0]
    return root


def _narrow(rows: DataFrame, root: Node, dims: int, nodes: dict[int, Node], search: dict[int, list], tolerance: float) -> None:
    """Move each node's low bound to its cut. search: low, end, bytes below low, wanted bytes, all bytes."""
    while active := [n for n, (low, high, *_) in search.items() if high - low > 1]:
        ranges = {n: (nodes[n].dim, search[n][0], search[n][1], -(-(search[n][1] - search[n][0]) // BUCKETS)) for n in active}
        for n, sums in _histogram(rows, root, dims, ranges).items():
            low, high, below, part, total = search[n]
            width = ranges[n][3]
            search[n] = [high, high, below, part, total]
            for bucket, size in sums:
                if below + size > part:
                    left, right = low + bucket * width, low + (bucket + 1) * width
                    if width > 1 and size > tolerance * total:
                        search[n] = [left, right, below, part, total]
                    else:  # the nearer edge
                        near = left if part - below <= below + size - part else right
                        search[n] = [near, near, below, part, total]
                    break
                below += size


def shard_by_kd_tree(
    df: DataFrame,
    shards: int,
    key: str = "doc_id",
    text: str = "text",
    numbers: Sequence[str] = ("doc_id", "n_chars"),
    names: Sequence[str] = ("lang", "source"),
    tolerance: float = 0.0002,
) -> DataFrame:
    """One row per row of df: key, size (UTF-8 bytes of the text and 8), text_crc32, shard, slot.

    Dimensions are the number columns and the name columns (by a hash of the name); a missing value
    counts as the lowest. Rows with equal values in a dimension are told apart by a hash of their key
    and their text, so a cut can pass through any number of equal values and a source that holds a
    third of all rows is divided like any other. Rows equal in key and text stay together. A cut
    misses its share by at most `tolerance` of the node's bytes or one group of such rows.
    Slots number the rows of a shard from 0 without gaps. An empty table gives no rows; other columns
    are not read.
    """
    spark = df.sparkSession
    numbers, names = [c for c in numbers if c in df.columns], [c for c in names if c in df.columns]
    measures = [F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(numbers)]
    measures += [F.crc32(F.coalesce(F.col(c).cast("string"), F.lit("")).cast("binary")).cast("double").alias(f"v{i}") for i, c in enumerate(names, len(numbers))]
    size = utf8_bytes(F.col(text)) + F.lit(ROW_OVERHEAD)
    crc = F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))
    tie = F.xxhash64(F.col(key), crc)
    slim = df.select(F.col(key).alias("key"), size.alias("size"), crc.alias("text_crc32"), tie.alias("tie"), *measures)
    dims = len(measures)
    finite = [F.when(F.isnan(f"v{d}") | (F.abs(f"v{d}") == float("inf")), None).otherwise(F.col(f"v{d}")) for d in range(dims)]
    ends = slim.agg(*[f(finite[d]).alias(f"{n}{d}") for d in range(dims) for n, f in (("lo", F.min), ("hi", F.max))]).first()
    low31 = F.col("tie").bitwiseAND(SCALE)
    keys = [(_unit(finite[d], ends[f"lo{d}"] or 0.0, ends[f"hi{d}"] or 0.0) * F.lit(1 << BITS) + low31).alias(f"k{d}") for d in range(dims)]
    rows = stored(slim.select("key", "size", "text_crc32", "tie", *keys), "kd-rows")
    tree = _grow(rows, Node(0, shards), dims, tolerance)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = pa.array(tree.leaf(_columns(batch, dims)[0]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], leaf], names=["key", "size", "text_crc32", "tie", "shard"])

    kind = rows.schema["key"].dataType.simpleString()
    placed = rows.mapInArrow(place, f"key {kind}, size long, text_crc32 long, tie long, shard int")
    return _slots(placed, shuffle_partitions(spark)).withColumnRenamed("key", key)


def _slots(placed: DataFrame, parts: int) -> DataFrame:
    """Number the rows of each shard: within hash parts, after the counts of the parts before."""
    placed = placed.withColumn("part", F.pmod(F.hash("tie", F.lit(17)), F.lit(parts)))
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    rank = F.row_number().over(Window.partitionBy("shard", "part").orderBy("key", "tie")) - 1
    numbered = placed.withColumn("rank", rank)
    # starts has shards x parts rows at most
    joined = numbered.join(F.broadcast(starts), ["shard", "part"])
    return joined.select("key", "size", "text_crc32", "shard", (F.col("start") + F.col("rank")).cast("long").alias("slot"))
