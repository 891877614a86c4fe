"""Runs of the automaton against comparison of all periods."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from conftest import SF_SMALL
from corpora import no_docs, odd_docs, odd_texts  # noqa: F401
from ebbtide.llm import periodic_runs as pr
from ebbtide.llm.common import table
from ebbtide.llm.queries import QUERIES


def brute(words, least=24, periods=3):
    numbers: dict = {}
    a = np.array([numbers.setdefault(w, len(numbers)) for w in words])
    out = []
    for q in range(1, len(a) // periods + 1):
        same = np.concatenate([[0], (a[q:] == a[:-q]).astype(int), [0]])
        for start, end in zip(np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1), strict=True):
            size = int(end - start + q)
            part = a[start : start + size]
            if size >= max(least, periods * q) and not any((part[r:] == part[:-r]).all() for r in range(1, q)):
                out.append((int(start), size, q))
    return sorted(out, key=lambda run: (run[0], run[2]))


def left(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in dropped]


@pytest.mark.parametrize("seed", range(40))
def test_runs_equal_brute_force(seed):
    draw = random.Random(seed)
    for _ in range(15):
        n, letters = draw.randint(0, 160), draw.choice([1, 2, 3, 20])
        words = [b"%d" % draw.randrange(letters) for _ in range(n)]
        if n > 30 and draw.random() < 0.6:
            a = draw.randrange(n)
            p = 1 + (n - a) // draw.randint(3, 10)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        if draw.random() < 0.3:
            words = words * 2
        for least, periods in ((24, 3), (6, 3), (6, 2), (12, 4)):
            got = pr.text_runs(words, least, periods)
            assert got == brute(words, least, periods)
            assert pr.without_repeats(words, got) == left(words, got)


def test_long_texts_of_one_word_and_of_two():
    assert pr.text_runs([b"a"] * 50_000) == [(0, 50_000, 1)]
    one, two = [b"a"], [b"a", b"b"]
    while len(two) < 3_000:  # Fibonacci words are full of runs
        one, two = two, two + one
    assert pr.text_runs(two) == brute(two)


def test_link_cut_tree_knows_the_last_colours():
    draw = random.Random(1)
    parents = [-1] + [draw.randrange(i) for i in range(1, 300)]
    tree, last = pr.LinkCutTree(parents), [-1] * 300
    for colour in range(2_000):
        node = draw.randrange(1, 300)
        want, at, before = [], node, -1
        while at:  # segments from the node up; the deepest node of each
            if last[at] != before and last[at] >= 0:
                want.append((at, last[at]))
            before = last[at]
            at = parents[at]
        assert tree.access(node, colour) == want
        at = node
        while at:
            last[at], at = colour, parents[at]


def test_odd_table(spark, odd_docs, odd_texts):  # noqa: F811
    got = pr.periodic_runs(odd_docs).collect()
    assert len(got) == odd_docs.count()
    for row in got:
        words = (odd_texts.get(row["doc_id"], "no key but a text") or "").encode().split()
        runs = brute(words) if len(words) < 2_000 else pr.text_runs(words)
        assert [tuple(r) for r in row["runs"]] == runs and row["n_words"] == len(words)
        assert row["collapsed"] == b" ".join(left(words, runs)).decode()


def test_no_rows(spark, no_docs):  # noqa: F811
    assert pr.periodic_runs(no_docs).collect() == []


def test_query_equals_brute_force(spark):
    got = {r["doc_id"]: r for r in QUERIES["op13_periodic_runs"](spark, SF_SMALL).collect()}
    docs = table(spark, SF_SMALL, "documents").collect()
    assert len(got) == len(docs)
    for doc in docs:
        words = (doc["text"] or "").encode().split()
        h, n = zlib.crc32(str(doc["doc_id"]).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = brute(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        row = got[doc["doc_id"]]
        assert row["n_runs"] == len(runs)
        assert (row["start"], row["length"], row["period"]) == (best or (None,) * 3)
        assert row["exponent_milli"] == (best and 1000 * best[1] // best[2])
        assert row["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(b" ".join(left(words, runs))).hexdigest()
