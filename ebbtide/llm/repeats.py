"""Runs of words that occur more than once in one text."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from ebbtide.llm.words import STEP


def numbers_of(words: Sequence[bytes]) -> np.ndarray:
    """One 64-bit number per word: equal words have equal ones."""
    return np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)


def _differ(words: Sequence[bytes], size: int, order: np.ndarray, same: np.ndarray) -> bool:
    """Whether some neighbours in the order with the same number are different windows."""
    own: dict[bytes, int] = {}
    ids = np.fromiter((own.setdefault(w, len(own)) for w in words), dtype=np.int64, count=len(words))
    a, b = order[:-1][same], order[1:][same]
    return any((ids[a + k] != ids[b + k]).any() for k in range(size))


def repeated_windows(words: Sequence[bytes], size: int, numbers: np.ndarray | None = None, exact: bool = True) -> np.ndarray:
    """For every window of `size` words whether the text has the same window elsewhere too.

    Windows are compared by a 64-bit number first; unless `exact` is waived, those with equal numbers
    are then compared word by word. Equal windows are never missed.
    """
    count = len(words) - size + 1
    if count < 2:
        return np.zeros(max(count, 0), dtype=bool)
    own = numbers_of(words) if numbers is None else numbers
    total = np.zeros(count, dtype=np.uint64)
    for k in range(size):
        total *= np.uint64(STEP)
        total += own[k : count + k]
    ranked = np.sort(total)
    same = ranked[1:] == ranked[:-1]
    out = np.zeros(count, dtype=bool)
    if not same.any():
        return out
    order = np.argsort(total, kind="stable")
    if exact and _differ(words, size, order, same):  # two windows share a number by chance
        places: dict[tuple[bytes, ...], list[int]] = {}
        for at in range(count):
            places.setdefault(tuple(words[at : at + size]), []).append(at)
        for starts in places.values():
            out[starts] = len(starts) > 1
        return out
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def covered(starts: np.ndarray, size: int, count: int) -> np.ndarray:
    """Which of `count` words lie in a window, of `size` words, that begins at a marked place."""
    steps = np.zeros(count + 1, dtype=np.int64)
    at = np.flatnonzero(starts)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + size, -1)
    return np.cumsum(steps)[:count] > 0
