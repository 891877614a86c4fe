"""Epsilon grid order join: links between vectors of one label whose cosine reaches a threshold.

On the unit sphere a cosine of at least c is a distance of at most eps = sqrt(2 - 2c). Vectors are
sorted by the cells, of side eps, in which their leading principal coordinates lie, cut into blocks of
neighbours in this order, and the sequence is joined with itself recursively: intervals whose
boxes in the principal coordinates are farther apart than eps are skipped (block_tree). The blocks of
the pairs that remain meet in tasks, which multiply them in double precision.

Equal vectors count once, with their number, so a vector that a third of all rows hold costs one row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.block_tree import block_pairs, with_payloads
from ebbtide.llm.common import in_order, stored
from ebbtide.llm.components import components

LEAST_COSINE = 0.98
DIMS = 8  # leading principal coordinates in the order and the boxes
BLOCK_ROWS = 1024
MARGIN = 1e-9


def _vectors(batch: pa.RecordBatch, column: int) -> Iterator[np.ndarray | None]:
    """Each row's vector in double precision, or None if nothing can be compared with it."""
    for value in batch.column(column):
        if value.values is None or value.values.null_count or not len(value.values):
            yield None
            continue
        vector = value.values.to_numpy(zero_copy_only=False).astype(np.float64)
        yield vector if np.isfinite(vector).all() and vector.any() else None


def _keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, data = [], []
        for vector in _vectors(batch, 2):
            raw = None if vector is None else (vector + 0.0).tobytes()  # one zero, not two
            keys.append(None if raw is None else hashlib.blake2b(raw, digest_size=16).digest())
            data.append(raw)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary()), pa.array(data, pa.binary())], names=["id", "label", "key", "data"])


def _principal(vectors: DataFrame) -> dict[int, np.ndarray]:
    """The leading principal directions, for each length of vectors; from sums over all of them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                v = np.frombuffer(raw)
                u = np.append(v / np.linalg.norm(v), 1.0)
                if len(v) not in sums:
                    sums[len(v)] = np.zeros((len(u), len(u)))
                sums[len(v)] += np.outer(u, u)
        for size, total in sums.items():
            flat = total.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(flat), size)), pa.array(np.arange(len(flat))), pa.array(flat)], names=["size", "place", "total"])

    rows = vectors.select("data").mapInArrow(run, "size long, place long, total double")
    got = rows.groupBy("size", "place").agg(F.sum("total").alias("total")).toArrow()
    sizes, places, totals = (got[c].to_numpy() for c in ("size", "place", "total"))
    out = {}
    for size in np.unique(sizes):
        flat = np.zeros((size + 1) ** 2)
        flat[places[sizes == size]] = totals[sizes == size]
        gram = flat.reshape(size + 1, size + 1)
        mean = gram[-1, :-1] / gram[-1, -1]
        _, directions = np.linalg.eigh(gram[:-1, :-1] / gram[-1, -1] - np.outer(mean, mean))
        out[int(size)] = directions[:, ::-1][:, :DIMS]
    return out


def _coordinates(vectors: DataFrame, directions: dict[int, np.ndarray], eps: float) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            roots, places, cells = [], [], []
            for label, raw in zip(batch.column("label").to_pylist(), batch.column("data").to_pylist(), strict=True):
                v = np.frombuffer(raw)
                at = np.zeros(DIMS)
                own = (v / np.linalg.norm(v)) @ directions[len(v)]
                at[: len(own)] = own
                roots.append(f"{label}/{len(v)}")
                places.append(at.tolist())
                cells.append(np.floor(at / eps).astype(np.int32).tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(roots, pa.string()), batch.column("id"), batch.column("copies"), batch.column("data"), pa.array(places, pa.list_(pa.float64())), pa.array(cells, pa.list_(pa.int32()))],
                names=["root", "id", "copies", "data", "place", "cell"],
            )

    return vectors.select("label", "id", "copies", "data").mapInArrow(run, "root string, id long, copies long, data binary, place array<double>, cell array<int>")


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order to blocks of at most BLOCK_ROWS of one root."""
    part, seq, held, root = TaskContext.get().partitionId(), 0, [], None

    def block() -> pa.RecordBatch:
        places = np.array([h[3] for h in held])
        row = [root, part, seq, np.array([h[0] for h in held], dtype=np.int64).tobytes(), np.array([h[1] for h in held], dtype=np.int64).tobytes(), b"".join(h[2] for h in held), *places.min(axis=0), *places.max(axis=0)]
        types = [pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), *[pa.float64()] * (2 * DIMS)]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], names=BLOCK_NAMES)

    for batch in batches:
        for r, *row in zip(*(batch.column(c).to_pylist() for c in ("root", "id", "copies", "data", "place")), strict=True):
            if held and (r != root or len(held) == BLOCK_ROWS):
                yield block()
                seq += 1
                held = []
            root = r
            held.append(row)
    if held:
        yield block()


BLOCK_NAMES = ["root", "part", "seq", "ids", "copies", "data", *[f"lo{d}" for d in range(DIMS)], *[f"hi{d}" for d in range(DIMS)]]
BLOCK = "root string, part int, seq long, ids binary, copies binary, data binary, " + ", ".join([f"lo{d} double" for d in range(DIMS)] + [f"hi{d} double" for d in range(DIMS)])


def _links(least: float):
    """For pairs of blocks: each vector's links in the other block, and a vector it is connected with."""

    def exact(a: np.ndarray, b: np.ndarray) -> bool:
        return np.dot(a, b) / (np.sqrt(np.dot(a, a)) * np.sqrt(np.dot(b, b))) >= least

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda name: batch.column(name)[i].as_py()  # noqa: E731, B023
                same = (get("a_part"), get("a_seq")) == (get("b_part"), get("b_seq"))
                ids, copies, vectors = ([np.frombuffer(get(f"{s}_{c}"), t) for s in "ab"] for c, t in (("ids", np.int64), ("copies", np.int64), ("data", np.float64)))
                a, b = (v.reshape(len(x), -1) for v, x in zip(vectors, ids, strict=True))
                unit = [v / np.linalg.norm(v, axis=1, keepdims=True) for v in (a, b)]
                cosine = unit[0] @ unit[1].T
                hit = cosine >= least
                for x, y in zip(*np.nonzero(np.abs(cosine - least) < MARGIN), strict=True):
                    hit[x, y] = exact(a[x], b[y])
                if same:
                    np.fill_diagonal(hit, False)
                if not hit.any():
                    continue
                near = [np.array(x) for x in ids]  # the smallest vector reached so far
                while True:
                    before = near[0].copy(), near[1].copy()
                    near[0] = np.minimum(near[0], np.where(hit, near[1], np.iinfo(np.int64).max).min(axis=1))
                    near[1] = np.minimum(near[1], np.where(hit.T, near[0], np.iinfo(np.int64).max).min(axis=1))
                    if all((x == y).all() for x, y in zip(before, near, strict=True)):
                        break
                out = [(ids[0], hit @ copies[1], near[0])]
                if not same:
                    out.append((ids[1], hit.T @ copies[0], near[1]))
                own, links, to = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(x[links > 0]) for x in (own, links, to)], names=["id", "links", "near"])

    return run


def near_vectors(df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", least_cosine: float = LEAST_COSINE) -> DataFrame:
    """key, n_links, component_id, kept for every row.

    Only vectors of equal label and length are compared. Rows with a null key or label, or with a
    vector that is null, empty, zero or holds a null or a number that is not finite, have no links.
    A row's links are the other rows it reaches the threshold with, equal ones included; rows that
    share a key are one node of the components. An empty table gives no rows; other columns are not
    read.
    """
    slim = df.select(F.col(key).cast("long").alias("id"), F.col(label).cast("string").alias("label"), F.col(vector).alias("vector"))
    rows = stored(slim.mapInArrow(_keyed, "id long, label string, key binary, data binary"), "vectors")
    usable = rows.where("id IS NOT NULL AND label IS NOT NULL AND key IS NOT NULL")
    classes = usable.groupBy("label", "key").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("data").alias("data"))
    classes = stored(classes, "vector-classes")
    eps = float(np.sqrt(2 - 2 * least_cosine))
    placed = _coordinates(classes, _principal(classes), eps)
    order = in_order(placed, classes.count(), 4 * BLOCK_ROWS, "root", "cell", "id")
    blocks = stored(order.mapInArrow(_cut, BLOCK), "vector-blocks")

    def may_join(left, right):
        gap = F.lit(0.0)
        for d in range(DIMS):
            apart = F.greatest(left(f"lo{d}") - right(f"hi{d}"), right(f"lo{d}") - left(f"hi{d}"), F.lit(0.0))
            gap = gap + apart * apart
        return gap <= F.lit(eps * eps + MARGIN)

    merges = {f"lo{d}": F.min for d in range(DIMS)} | {f"hi{d}": F.max for d in range(DIMS)}
    pairs = block_pairs(blocks, merges, may_join)
    met = with_payloads(pairs, blocks, ["ids", "copies", "data"])
    found = stored(met.mapInArrow(_links(least_cosine), "id long, links long, near long"), "vector-links")
    connected = components(found.where("id <> near").select("id", "near"))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    known = classes.select("label", "key", "id", "copies").join(counts, "id", "left")
    known = known.join(connected.withColumnRenamed("node", "id"), "id", "left")
    known = known.select("label", "key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = rows.select("id", "label", "key").join(stored(known, "vector-result"), ["label", "key"], "left")
    lone = F.col("id").isNull()
    out = out.select(
        F.col("id").alias(key),
        F.when(lone, 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        F.when(~lone, F.coalesce("component_id", "id")).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(True)))
