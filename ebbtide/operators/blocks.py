"""Training rows as numeric blocks that tasks read without a copy, and scores by setting.

A block holds some rows of one part. A part is one way to encode the training rows: part k of a
cross-validation knows only the rows outside fold k, ALL knows every training row. An iterative fit
reads the blocks once per step.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ALL = -1  # the part of all training rows
NO_FOLD = -1

SCHEMA = "part int, n long, x binary, y binary, fold binary, place binary"
SCORES = "setting int, part int, label double, score double"
CHUNK = 4096  # numbers in a piece of a partial sum
BUCKETS = 1024  # ranges of scores that are ranked by themselves


@dataclass
class Block:
    part: int
    x: np.ndarray  # rows x features
    y: np.ndarray  # 0 or 1
    fold: np.ndarray
    place: np.ndarray  # hash of each row's key

    @property
    def held_out(self) -> np.ndarray:
        return self.fold == self.part if self.part != ALL else np.zeros(len(self.y), dtype=bool)


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one by one; their bytes stay in the batch and are not copied."""
    for batch in batches:
        for at in range(batch.num_rows):
            cells = ((name, column[at]) for name, column in zip(batch.schema.names, batch.columns, strict=True))
            yield {name: cell.as_buffer() if pa.types.is_binary(cell.type) else cell.as_py() for name, cell in cells}


def read(batches: Iterable[pa.RecordBatch], kind: type = np.float64) -> Iterator[Block]:
    for row in rows_of(batches):
        yield block_of(row, kind)


def block_of(row: dict, kind: type = np.float64) -> Block:
    n = row["n"]
    return Block(
        row["part"],
        np.frombuffer(row["x"], dtype=kind).reshape(n, -1),
        np.frombuffer(row["y"], dtype=np.float64),
        np.frombuffer(row["fold"], dtype=np.int32),
        np.frombuffer(row["place"], dtype=np.uint64),
    )


def to_blocks(rows: DataFrame) -> DataFrame:
    """Blocks of rows with part, place (long), label (double), fold and features (array of doubles)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pa.compute.unique(batch.column(0)).to_pylist():
                own = batch.filter(pa.compute.equal(batch.column(0), part))
                x = pa.compute.fill_null(own.column(4).flatten(), 0.0).to_numpy(zero_copy_only=False)
                columns = [own.column(2).to_numpy(zero_copy_only=False), own.column(3).to_numpy(zero_copy_only=False).astype(np.int32), own.column(1).to_numpy()]
                cells = [part, own.num_rows, np.ascontiguousarray(x).tobytes(), *[c.tobytes() for c in columns]]
                types = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, types, strict=True)], names=["part", "n", "x", "y", "fold", "place"])

    return rows.select("part", "place", "label", "fold", "features").mapInArrow(run, SCHEMA)


def summed(blocks: DataFrame, parts: Callable[[Iterator[Block]], Iterator[tuple[int, np.ndarray]]]) -> dict[int, np.ndarray]:
    """By number the sum over all tasks of the vectors that `parts` gives for a task's blocks.

    The vectors travel in pieces, so no task holds more than a piece of each task at once; they are added
    in the order of the tasks, whoever is done first.
    """

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for number, vector in parts(read(batches)):
            for piece in range(0, len(vector), CHUNK):
                cells = [[number], [piece], [task], [vector[piece : piece + CHUNK].tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, (pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["number", "piece", "task", "sums"])

    def total(table: pa.Table) -> pa.Table:
        ordered = table.sort_by("task")
        found = np.sum([np.frombuffer(s) for s in ordered["sums"].to_pylist()], axis=0)
        return ordered.slice(0, 1).select(["number", "piece"]).append_column("sums", pa.array([found.tobytes()], pa.binary()))

    pieces = blocks.mapInArrow(partial, "number int, piece long, task long, sums binary")
    rows = pieces.groupBy("number", "piece").applyInArrow(total, "number int, piece long, sums binary").collect()
    out: dict[int, list] = {}
    for row in sorted(rows, key=lambda r: (r["number"], r["piece"])):
        out.setdefault(row["number"], []).append(np.frombuffer(row["sums"]))
    return {number: np.concatenate(found) for number, found in out.items()}


def counts(blocks: DataFrame) -> dict[int, int]:
    """Rows of each part."""
    return {r["part"]: r["n"] for r in blocks.groupBy("part").agg(F.sum("n").alias("n")).collect()}


def score_batch(setting: int, part: int, label: np.ndarray, score: np.ndarray) -> pa.RecordBatch:
    n = len(label)
    columns = [pa.array(np.full(n, setting, dtype=np.int32)), pa.array(np.full(n, part, dtype=np.int32)), pa.array(label), pa.array(score)]
    return pa.RecordBatch.from_arrays(columns, names=["setting", "part", "label", "score"])


def auc_by_setting(scores: DataFrame) -> dict[int, float]:
    """Exact ROC-AUC of every setting, the mean over its parts; ties count half. Scores are from 0 to 1.

    Rows are summed by score first. A window ranks one bucket of one part; the buckets of a part are
    tied together by their totals.
    """
    own = ["setting", "part"]
    sums = [F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")]
    bucket = F.floor(F.col("score") * BUCKETS).alias("bucket")
    per_score = scores.groupBy(*own, bucket, "score").agg(*sums)
    below = Window.partitionBy(*own, "bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    wins = F.col("pos") * (F.coalesce(F.sum("neg").over(below), F.lit(0)) + F.col("neg") / 2.0)
    per_bucket = per_score.withColumn("wins", wins).groupBy(*own, "bucket").agg(*[F.sum(c).alias(c) for c in ("wins", "pos", "neg")])
    earlier = Window.partitionBy(*own).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    tied = per_bucket.withColumn("before", F.coalesce(F.sum("neg").over(earlier), F.lit(0)))
    won = F.sum(F.col("wins") + F.col("pos") * F.col("before"))
    auc = tied.groupBy(*own).agg(F.try_divide(won, F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))
    return {r["setting"]: r["auc"] for r in auc.groupBy("setting").agg(F.avg("auc").alias("auc")).collect()}
