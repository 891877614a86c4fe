"""Words and shingles of texts as 64-bit numbers, by numpy over the UTF-8 bytes of a batch.

A word is a run of bytes other than 0x20 and 0x09-0x0D; A-Z count as a-z. A word's number is a
polynomial of its bytes modulo 2^64, mixed; a shingle's is a polynomial of its words' numbers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

SEGMENT = 1 << 20  # bytes worked on at once; longer only for a single word
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
STEP = 0xC2B2AE3D27D4EB4F | 1

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over the whole number; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, factor in (("up", BASE), ("down", INVERSE)):
                factors = np.full(n, factor, dtype=np.uint64)
                factors[0] = 1
                setattr(self, name, np.cumprod(factors, dtype=np.uint64))
        return self.up, self.down


_POWERS = _Powers()


@dataclass
class Words:
    """Words of several texts in order: number, text, and byte span within all texts joined."""

    hash: np.ndarray
    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # of each text, and the end
    heads: dict[int, np.ndarray]  # by length: numbers of the words' first bytes, 0 for words not longer

    def of(self, doc: int) -> slice:
        return slice(self.first[doc], self.first[doc + 1])


def _segment(data: np.ndarray, breaks: np.ndarray, heads: Sequence[int]) -> tuple[np.ndarray, ...]:
    """Starts, ends, numbers and heads of the words; a word also ends at a break."""
    blank = BLANK[data]
    before = np.empty(len(data), dtype=bool)
    before[0], before[1:] = True, blank[:-1]
    after = np.empty(len(data), dtype=bool)
    after[-1], after[:-1] = True, blank[1:]
    inside = breaks[(breaks > 0) & (breaks < len(data))]
    before[inside], after[inside - 1] = True, True
    start = np.flatnonzero(before & ~blank)
    end = np.flatnonzero(after & ~blank) + 1
    up, down = _POWERS.to(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((LOWER[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    number = (sums[end] - sums[start]) * down[start]
    out = [start, end, mix(number + (end - start).astype(np.uint64))]
    for size in heads:
        stop = np.minimum(start + size, end)
        out.append(np.where(end - start > size, mix((sums[stop] - sums[start]) * down[start] - np.uint64(size)), np.uint64(0)))
    return tuple(out)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts joined, and where each begins and the last ends; a null text is empty."""
    column = pa.compute.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(data: np.ndarray, offsets: np.ndarray, heads: Sequence[int] = ()) -> Words:
    found = []
    at = 0
    while at < len(data):
        stop = min(len(data), at + SEGMENT)
        if stop < len(data):  # end at a text's end or a blank
            text_end = offsets[np.searchsorted(offsets, stop, side="right") - 1]
            blanks = np.flatnonzero(BLANK[data[at:stop]])
            inner = at + blanks[-1] + 1 if len(blanks) else at
            stop = max(text_end, inner)
            if stop <= at:  # one word longer than a segment
                rest = np.flatnonzero(BLANK[data[at:]])
                ends_at = offsets[offsets > at]
                stop = min(ends_at[0], at + rest[0] + 1 if len(rest) else len(data))
        s, e, *numbers = _segment(data[at:stop], offsets - at, heads)
        found.append((s + at, e + at, *numbers))
        at = stop
    if not found:
        found = [tuple(np.zeros(0, dtype=np.int64 if i < 2 else np.uint64) for i in range(3 + len(heads)))]
    start, end, number, *tops = (np.concatenate(part) for part in zip(*found, strict=True))
    first = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(number, doc, start, end, first, dict(zip(heads, tops, strict=True)))


def grams(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all runs of `size` words of one text, and the index of each run's first word."""
    n = len(words.hash) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total *= np.uint64(STEP)
        total += words.hash[k : n + k]
    at = np.flatnonzero(words.doc[:n] == words.doc[size - 1 :])
    return mix(total[at]), at


def shingle_sets(words: Words, size: int) -> Iterator[np.ndarray]:
    """The sorted different shingles of each text; a shorter text's words are one shingle."""
    numbers, at = grams(words, size)
    bounds = np.searchsorted(at, words.first)
    for doc in range(len(words.first) - 1):
        if bounds[doc] < bounds[doc + 1]:
            yield np.unique(numbers[bounds[doc] : bounds[doc + 1]])
            continue
        own = words.hash[words.of(doc)]
        if not len(own):
            yield own
            continue
        total = np.uint64(len(own))
        with np.errstate(over="ignore"):
            for h in own:
                total = total * np.uint64(STEP) + h
        yield mix(np.array([total], dtype=np.uint64))
