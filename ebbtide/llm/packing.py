"""Packing: token ids of documents into windows of fixed length, by bounded-space best fit.

Every task keeps `open_windows` windows. A piece goes where it leaves the least room; if it fits
nowhere, the fullest window is emitted and a new one opened. What is open at the end of a partition is
merged with the leftovers of the partitions of its group, and what is left of a group is emitted.
"""

from __future__ import annotations

import base64
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import slices, stored

WINDOW = 1024
OPEN_WINDOWS = 256
GROUP = 16  # partitions whose leftovers are merged in one task
END_ID = 0
VOCABULARY, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"

PIECE = "window long, closed boolean, row_key {key}, start long, length long, doc_tokens long, offset long, ids binary"


class Encoder:
    """Ids as the vocabulary file's tokenizer gives them, without added special tokens.

    The rank file holds the same merges and gives the same ids several times faster; a text with the
    string of a special token goes through the vocabulary file itself.
    """

    def __init__(self, vocabulary: str, ranks: str):
        self.slow = tokenizers.Tokenizer.from_file(vocabulary)
        self.special = [str(t) for t in self.slow.get_added_tokens_decoder().values() for t in [t.content]]
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            found = self.slow.encode(text, add_special_tokens=False).ids
        else:
            found = self.fast.encode_ordinary(text)
        return np.array(found, dtype="<u4")


class BestFit:
    """Open windows by their room. Each is a list of what was put in it."""

    def __init__(self, size: int, most_open: int):
        self.size, self.most_open = size, most_open
        self.rooms: list[tuple[int, int]] = []  # room, number: sorted
        self.held: dict[int, list] = {}
        self.opened = 0

    def put(self, length: int, item) -> list | None:
        """Place an item shorter than a window; returns a window to emit, with its items."""
        out = None
        at = bisect_left(self.rooms, (length, -1))
        if at == len(self.rooms):
            if len(self.rooms) == self.most_open:
                out = self.held.pop(self.rooms.pop(0)[1])
            number, self.opened, room = self.opened, self.opened + 1, self.size
            self.held[number] = []
        else:
            room, number = self.rooms.pop(at)
        self.held[number].append((self.size - room, item))
        if room == length:  # full; no other was emitted, for a new window has more room than any item needs
            return self.held.pop(number)
        insort(self.rooms, (room - length, number))
        return out

    def left(self) -> Iterator[list]:
        for _, number in self.rooms:
            yield self.held[number]


def pack(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    vocabulary: str | None = None,
    ranks: str | None = None,
) -> DataFrame:
    """Pieces of documents in windows: key, start, length, doc_tokens, sequence_id, offset, ids.

    A document is its ids and one END_ID; a null or empty text is END_ID alone. A document longer than
    a window is cut into whole windows and a rest; shorter ones stay whole. ids holds little-endian
    unsigned 32-bit numbers. Repeated rows are packed as often as they occur, rows without a key too;
    an empty table gives no rows. Other columns are not read.
    """
    vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)
    ranks = ranks or public_tokenizers.path(RANKS)
    slim = df.select(F.col(key).alias("row_key"), F.col(text).cast("string").alias("text"))
    kind = slim.schema["row_key"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = Encoder(vocabulary, ranks), TaskContext.get().partitionId()
        open_, base, emitted = BestFit(window, open_windows), part << 32, 0
        rows: list[tuple] = []

        def flush(pieces: list, closed: bool) -> None:
            nonlocal emitted
            for offset, (doc, start, ids, total) in pieces:
                rows.append((base + emitted, closed, doc, start, len(ids), total, offset, ids.tobytes()))
            emitted += 1

        for batch in slices(batches, 1):
            for doc, value in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                ids = np.append(encoder.ids(value), np.uint32(END_ID)) if value else np.array([END_ID], dtype="<u4")
                total = len(ids)
                rest = total % window
                for start in range(0, total - rest, window):
                    flush([(0, (doc, start, ids[start : start + window], total))], True)
                if rest:
                    out = open_.put(rest, (doc, total - rest, ids[total - rest :], total))
                    if out is not None:
                        flush(out, True)
            if rows:
                yield table(rows)
                rows = []
        for pieces in open_.left():
            flush(pieces, False)
        if rows:
            yield table(rows)

    names = [c.strip().split(" ")[0] for c in PIECE.split(",")]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        types = [pa.int64(), pa.bool_(), columns[2][0].type, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        columns[2] = [k.as_py() for k in columns[2]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    pieces = stored(slim.mapInArrow(run, PIECE.format(key=kind)), "packed", "zstd")
    out = [F.col("row_key").alias(key), "start", "length", "doc_tokens", F.col("window").alias("sequence_id"), "offset", "ids"]
    closed = pieces.where("closed").select(*out)
    return closed.unionByName(_merge(pieces.where("NOT closed"), window).select(*out))


def _merge(left: DataFrame, size: int) -> DataFrame:
    """Put the leftovers of GROUP partitions together, the fullest first, each where it fits best."""

    def merge(fills: pd.DataFrame) -> pd.DataFrame:
        order = fills.sort_values(["fill", "window"], ascending=[False, True])
        fit, moves = BestFit(size, len(order) + 1), []
        done = [fit.put(int(fill), int(window)) for window, fill in zip(order["window"], order["fill"], strict=True)]
        for members in [*filter(None, done), *fit.left()]:
            moves += [(window, members[0][1], shift) for shift, window in members]
        return pd.DataFrame(moves, columns=["window", "into", "shift"])

    fills = left.groupBy("window").agg(F.sum("length").alias("fill"))
    task = F.floor(F.shiftright("window", 32) / GROUP).alias("task")
    moves = fills.groupBy(task).applyInPandas(merge, "window long, into long, shift long")
    moved = left.join(moves, "window")
    return moved.withColumn("offset", F.col("offset") + F.col("shift")).withColumn("window", F.col("into"))
