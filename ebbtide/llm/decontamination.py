"""Benchmark decontamination: fuzzy occurrences of test items in documents.

An item of m characters may differ in e = floor(m * error_rate) of them (insertions, deletions,
replacements). Cut into e + 1 pieces, one piece at least must occur unchanged wherever the item does
(pigeonhole). An Aho-Corasick automaton finds the pieces of all items in one pass over a document;
where one is found, Myers' bit-parallel distance decides about the text around it.

Items are a query set: they are dealt to blocks of at most block_bytes, and all documents are searched
once per block, so what is sent to the tasks has a fixed bound.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import normalized, slices

ERROR_RATE = 0.06
BLOCK_BYTES = 4 << 20


class Myers:
    """Edit distance of a pattern to the best end in a text, one machine step per character."""

    def __init__(self, pattern: str):
        self.size = len(pattern)
        self.masks: dict[str, int] = {}
        for i, c in enumerate(pattern):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def best(self, text: str, anchored: bool = False) -> tuple[int, int]:
        """Least distance of the pattern to a part of the text, and where the first such part ends.

        anchored: the part has to begin where the text does.
        """
        full, top, masks = (1 << self.size) - 1, 1 << self.size - 1, self.masks
        up, down, score = full, 0, self.size
        best, end, first = score, 0, int(anchored)
        for i, c in enumerate(text, 1):
            eq = masks.get(c, 0)
            xv = eq | down
            xh = (((eq & up) + up) ^ up) | eq
            ph = down | ~(xh | up) & full
            mh = up & xh
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
            ph = ph << 1 & full | first
            mh = mh << 1 & full
            up = mh | ~(xv | ph) & full
            down = ph & xv
            if score < best:
                best, end = score, i
        return best, end


@dataclass(frozen=True)
class Match:
    item: int
    distance: int
    budget: int
    start: int
    end: int


class Matcher:
    def __init__(self, items: list[tuple[object, str]], error_rate: float):
        self.items = [(i, text, int(len(text) * error_rate)) for i, text in items if text.strip()]
        self.patterns = [(Myers(text), Myers(text[::-1])) for _, text, _ in self.items]
        places: dict[str, list[tuple[int, int]]] = {}
        for n, (_, text, budget) in enumerate(self.items):
            for k in range(budget + 1):
                first, last = len(text) * k // (budget + 1), len(text) * (k + 1) // (budget + 1)
                places.setdefault(text[first:last], []).append((n, first))
        self.pieces = ahocorasick.Automaton()
        for piece, where in places.items():
            self.pieces.add_word(piece, (len(piece), where))
        if places:
            self.pieces.make_automaton()

    def matches(self, text: str) -> list[Match]:
        """The best occurrence of every item that occurs; of equally good ones the first."""
        if not self.items:
            return []
        windows: dict[int, list[tuple[int, int]]] = {}
        for last, (size, where) in self.pieces.iter(text):
            for n, offset in where:
                _, item, budget = self.items[n]
                begin = last + 1 - size - offset
                windows.setdefault(n, []).append((max(0, begin - budget), min(len(text), begin + len(item) + budget)))
        out = []
        for n, spans in windows.items():
            _, item, budget = self.items[n]
            best = None
            for first, stop in self._joined(spans):
                distance, end = self.patterns[n][0].best(text[first:stop])
                if distance <= budget and (best is None or distance < best.distance):
                    back = text[max(first, first + end - len(item) - budget) : first + end][::-1]
                    _, length = self.patterns[n][1].best(back, anchored=True)
                    best = Match(n, distance, budget, first + end - length, first + end)
            if best is not None:
                out.append(best)
        return out

    @staticmethod
    def _joined(spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
        """Overlapping windows as one, so that an occurrence is checked once."""
        spans.sort()
        first, stop = spans[0]
        for a, b in spans[1:]:
            if a > stop:
                yield first, stop
                first, stop = a, b
            stop = max(stop, b)
        yield first, stop


def _blocks(benchmark: DataFrame, item_key: str, text: str, block_bytes: int) -> Iterator[list[tuple[object, str]]]:
    """Items in blocks of about block_bytes; a longer item is a block of its own."""
    items = benchmark.select(F.col(item_key).alias("item"), normalized(F.col(text)).alias("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // block_bytes)
    block = F.pmod(F.xxhash64("item", "text"), F.lit(max(1, count)))
    for number in range(count):
        yield [(r["item"], r["text"]) for r in items.where(block == number).orderBy("item", "text").collect()]


def find_leaks(
    df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", error_rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """key, item, distance, budget, match_start, match_end: each item that occurs in a document.

    Places are characters of the normalized text. A null or empty text holds nothing, and a null item
    or one without a letter or digit occurs nowhere. Repeated items and documents are each reported.
    Items too short for an error are found as whole words only. No items or no documents, no rows.
    Other columns are not read.
    """
    slim = df.select(F.col(key).alias("key"), normalized(F.col(text)).alias("text")).where("text IS NOT NULL")
    kind, item_kind = slim.schema["key"].dataType.simpleString(), benchmark.schema[item_key].dataType.simpleString()
    schema = f"`{key}` {kind}, `{item_key}` {item_kind}, distance int, budget int, match_start long, match_end long"
    out = None
    for items in _blocks(benchmark, item_key, item_text, block_bytes):

        def run(batches: Iterable[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items, error_rate)
            for batch in slices(batches, 1, 4 << 20):
                docs, rows = [], []
                for i, value in enumerate(batch.column(1).to_pylist()):
                    for m in matcher.matches(value):
                        docs.append(i)
                        rows.append((matcher.items[m.item][0], m.distance, m.budget, m.start, m.end))
                if rows:
                    columns = list(zip(*rows, strict=True))
                    types = [None, pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(docs)), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]],
                        names=[key, item_key, "distance", "budget", "match_start", "match_end"],
                    )

        found = slim.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return df.sparkSession.createDataFrame([], schema) if out is None else out


def without_leaks(
    df: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text",
    error_rate: float = ERROR_RATE, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents, with all their columns, in which no item occurs; by the rules of find_leaks."""
    columns = df.columns
    for items in _blocks(benchmark, item_key, item_text, block_bytes):

        def run(batches: Iterable[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items, error_rate)
            place = len(columns)
            for batch in slices(batches, place, 4 << 20):
                clean = [value is None or not matcher.matches(value) for value in batch.column(place).to_pylist()]
                kept = batch.filter(pa.array(clean))
                yield pa.RecordBatch.from_arrays(kept.columns[:place], schema=pa.schema(list(kept.schema)[:place]))

        df = df.select(*[df[f"`{c}`"] for c in columns], normalized(df[text]).alias("normalized text")).mapInArrow(run, df.schema)
    return df
