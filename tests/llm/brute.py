"""Slow and plain versions of the operators, for small tables."""

from __future__ import annotations

import re
from itertools import combinations

AZ = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[bytes]:
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(AZ))


def shingles(text: str | None, size: int = 5) -> frozenset:
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def groups(nodes, links) -> dict:
    """The smallest node that each reaches."""
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in up}


def near(texts: dict) -> dict:
    sets = {i: shingles(t) for i, t in texts.items()}
    links = []
    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
            links.append((a, b))
    return groups(sets, links)


def edit_distance_in(pattern: str, text: str) -> int:
    """Least distance of the pattern to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, c in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (p != c))
    return min(row)


def repeated_words(texts: dict, least: int) -> dict[int, set[int]]:
    """Places of words in runs of `least` that an earlier text has."""
    seen, out = set(), {}
    for i in sorted(texts):
        w = words(texts[i])
        runs = [tuple(w[k : k + least]) for k in range(len(w) - least + 1)]
        found = {k + j for k, r in enumerate(runs) if r in seen for j in range(least)}
        if found:
            out[i] = found
        seen.update(runs)
    return out
