"""Periodic runs of words: a suffix automaton whose link tree is accessed as a link-cut tree.

The automaton of a text's words has one state per set of end places. Its suffix links form a tree; the path
from the state of a prefix to the root holds all suffixes of the prefix. A link-cut tree keeps on every
state where its words last ended: appending word i accesses the prefix's state, which recolours its path
to i. The path then falls into segments by the colours it had before. If the deepest state of a segment
has L words and the colour p, the last L words before i ended at p already, d = i - p words ago: the last
L + d words have the period d, and no smaller one, for p is the last place. With L >= d that is a square;
where L + d reaches the length asked for it is the run's part up to i, which is then extended to the right.

Only stretches of words that lie in windows which the text holds twice can be part of a run. They are found
by numbers of the windows, and each stretch has an automaton of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import slices
from ebbtide.llm.repeats import covered, repeated_windows

LEAST_WORDS = 24
LEAST_PERIODS = 3

RUNS = "row_key {key}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class SuffixAutomaton:
    """States of a sequence of words: suffix link and longest length of each, and every prefix's state.

    State 0 is the root. A word is a whole number.
    """

    def __init__(self, words: Sequence[int]):
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        self.prefix: list[int] = []
        follow: list[dict[int, int]] = [{}]
        link, length = self.link, self.length
        last = 0
        for word in words:
            state = len(link)
            follow.append({})
            length.append(length[last] + 1)
            link.append(0)
            at = last
            while at >= 0 and word not in (steps := follow[at]):
                steps[word] = state
                at = link[at]
            if at >= 0:
                target = follow[at][word]
                if length[target] == length[at] + 1:
                    link[state] = target
                else:  # the shorter words of the target end here too: they become a state of their own
                    split = len(link)
                    follow.append(follow[target].copy())
                    length.append(length[at] + 1)
                    link.append(link[target])
                    while at >= 0 and follow[at].get(word) == target:
                        follow[at][word] = split
                        at = link[at]
                    link[target] = link[state] = split
            self.prefix.append(state)
            last = state


class LinkCutTree:
    """A rooted tree in preferred paths, each a splay tree by depth with one colour.

    Node 0 is the root and has no colour: it stands for none in all lists.
    """

    def __init__(self, parents: Sequence[int]):
        self.up = list(parents)  # in a splay tree the parent; at its root the node above the path
        self.up[0] = 0
        self.left = [0] * len(self.up)  # less deep
        self.right = [0] * len(self.up)
        self.colour = [-1] * len(self.up)  # of the path, at the root of its splay tree

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        y = up[x]
        z = up[y]
        if z:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x
        up[x] = z
        if left[y] == x:
            child = left[y] = right[x]
            right[x] = y
        else:
            child = right[y] = left[x]
            left[x] = y
        if child:
            up[child] = y
        up[y] = x

    def _splay(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        y = up[x]
        while y and (left[y] == x or right[y] == x):
            z = up[y]
            if z and (left[z] == y or right[z] == y):
                top = z
                self._rotate(y if (left[y] == x) == (left[z] == y) else x)
            else:
                top = y
            self.colour[x] = self.colour[top]  # the last top is the root, which knows the colour
            self._rotate(x)
            y = up[x]

    def access(self, node: int, colour: int) -> list[tuple[int, int]]:
        """Colour the path from the node to the root; the deepest node and old colour of each segment on it."""
        up, right, colours = self.up, self.right, self.colour
        segments = []
        below, x = 0, node
        while x:
            self._splay(x)
            old = colours[x]
            if old >= 0:
                segments.append((x, old))
            deeper = right[x]
            if deeper:  # stays behind as a path of its own
                colours[deeper] = old
            right[x] = below
            below, x = x, up[x]
        if below:
            colours[below] = colour
        return segments


def runs_of(words: Sequence[int], least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """start, length, period of every run of at least least_words words and least_periods periods."""
    automaton = SuffixAutomaton(words)
    tree = LinkCutTree(automaton.link)
    length, prefix, n = automaton.length, automaton.prefix, len(words)
    found: dict[tuple[int, int], int] = {}
    for i in range(n):
        for state, last in tree.access(prefix[i], i):
            period = i - last
            whole = length[state] + period
            if whole >= least_words and whole >= least_periods * period:
                start = i + 1 - whole
                if (start, period) not in found:
                    end = i + 1
                    while end < n and words[end] == words[end - period]:
                        end += 1
                    found[start, period] = end - start
    return sorted((start, size, period) for (start, period), size in found.items())


def text_runs(words: Sequence[bytes], least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> list[tuple[int, int, int]]:
    """Runs of a text's words, by start and period.

    The first least_words * (1 - 1 / least_periods) words or more of a run stand a period further on again,
    and so do those that begin at each word up to as many before its end: windows of that size, each twice
    in the text, cover the run.
    """
    window = max(1, least_words - least_words // least_periods)
    starts = repeated_windows(words, window, exact=False)
    if not starts.any():
        return []
    marks = np.concatenate([[False], covered(starts, window, len(words)), [False]])
    bounds = np.flatnonzero(marks[1:] != marks[:-1]).reshape(-1, 2)
    out = []
    for first, end in bounds.tolist():
        if end - first < least_words:
            continue
        own: dict[bytes, int] = {}
        ids = [own.setdefault(w, len(own)) for w in words[first:end]]
        out += [(first + start, size, period) for start, size, period in runs_of(ids, least_words, least_periods)]
    return sorted(out, key=lambda run: (run[0], run[2]))


def without_repeats(words: Sequence[bytes], runs: Iterable[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run contains after its first period."""
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    for start, size, period in runs:
        steps[start + period] += 1
        steps[start + size] -= 1
    dropped = np.cumsum(steps)
    return [w for w, d in zip(words, dropped.tolist()) if not d]


def periodic_runs(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_words: int = LEAST_WORDS,
    least_periods: int = LEAST_PERIODS,
    rewrite: Callable[[Any, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """Per row: its key, n_words, all runs by start and period, and the text with each run cut to one period.

    A run is a stretch of words with smallest period q, of at least least_words words and least_periods * q,
    that cannot be longer. Words are bytes between blanks (0x20, 0x09-0x0D); the text that is left joins
    them by one blank. `rewrite` may replace a row's words, by its key, before they are searched. Texts are
    searched whole, however long. A null text has no words, like an empty one: no runs, an empty text.
    Repeated rows and rows without a key are searched one by one; an empty table gives no rows. Other
    columns are not read.
    """
    slim = df.select(F.col(key).alias("row_key"), F.col(text).cast("string").alias("text"))
    kind = slim.schema["row_key"].dataType.simpleString()
    runs_type = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            counts, runs, left = [], [], []
            for row, value in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist(), strict=True):
                words = (value or b"").split()
                if rewrite is not None:
                    words = rewrite(row, words)
                own = text_runs(words, least_words, least_periods)
                counts.append(len(words))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                left.append(b" ".join(without_repeats(words, own) if own else words))
            collapsed = pa.array(left, pa.large_binary()).cast(pa.large_string()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(runs, runs_type), collapsed], names=["row_key", "n_words", "runs", "collapsed"])

    return slim.mapInArrow(run, RUNS.format(key=kind)).withColumnRenamed("row_key", key)
