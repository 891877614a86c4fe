"""Shared passages and benchmark items against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from corpora import no_docs, odd_docs, odd_texts, prose, variant  # noqa: F401
from ebbtide.llm import collinear_chains as C
from ebbtide.llm import decontamination as D
from ebbtide.llm.common import normalized


def covered(rows) -> dict[int, set[int]]:
    out: dict[int, set[int]] = {}
    for r in rows:
        out.setdefault(r["doc"], set()).update(range(r["start"], r["stop"]))
    return out


def test_every_long_repeat_is_found(odd_docs, odd_texts):
    rows = C.shared_passages(odd_docs).collect()
    got = covered(rows)
    for doc, places in brute.repeated_words(odd_texts, C.LEAST_WORDS).items():
        assert places <= got.get(doc, set()), doc
    assert 13 in got and not {5, 6, 7, 8, 9, 10, 11, 12, 14, 15} & set(got) and not set(range(40, 60)) & set(got)
    assert all(r["partner"] < r["doc"] and r["identity"] >= C.LEAST_IDENTITY for r in rows)


def test_a_passage_of_many_documents(spark, monkeypatch):
    """Small partitions and runs: the occurrences of each seed lie in several."""
    monkeypatch.setattr(C, "LONGEST_RUN", 20)
    passage = prose(7, 70)
    texts = {i: f"{prose(3000 + i, 40)} {variant(passage, 31 + i % 5)} {prose(4000 + i, 40)}" for i in range(120)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(6)
    rows = C.shared_passages(df).collect()
    got = covered(rows)
    assert set(got) == set(range(1, 120))
    assert all(len(p & set(range(40, 110))) >= 60 and len(p) < 80 for p in got.values())
    assert len(rows) < 400


def test_a_passage_whose_parts_stand_in_other_documents(spark):
    """The first and the nearest document with each seed have 40 words of 80; one between has all."""
    w = prose(70, 80).split()
    parts = [w[:40], w[40:], w, w[:40], w[40:], w]
    texts = {i: f"{prose(5000 + i, 30)} {' '.join(p)} {prose(6000 + i, 30)}" for i, p in enumerate(parts, 1)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = covered(C.shared_passages(df).collect())
    want = brute.repeated_words(texts, C.LEAST_WORDS)
    assert set(want) == {6} and want[6] >= set(range(30, 110))
    assert want[6] <= got[6] and set(got) == {6}


def parted_texts() -> dict[int, str]:
    """The first and the nearest two documents with each part have 40 words of 80; one between has all, the last all but for changes."""
    w = prose(70, 80).split()
    changed = variant(" ".join(w), 11).split()
    parts = [w[:40], w[40:], w, w[:40], w[40:], w[:40], w[40:], changed]
    return {i: f"{prose(5000 + i, 30)} {' '.join(p)} {prose(6000 + i, 30)}" for i, p in enumerate(parts, 1)}


def test_a_changed_passage_whose_parts_stand_in_other_documents(spark, monkeypatch):
    texts = parted_texts()
    assert not brute.repeated_words(texts, C.LEAST_WORDS)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    rows = C.shared_passages(df).collect()
    assert [(r["doc"], r["partner"]) for r in rows] == [(8, 3)]
    assert set(range(30, 107)) <= covered(rows)[8] <= set(range(25, 115))
    # occurrences of a seed in several blocks
    monkeypatch.setattr(C, "BLOCK", 2)
    assert sorted(C.shared_passages(df).collect()) == sorted(rows)


def test_no_likely_pair_is_missed():
    """Against the counts of all pairs, also where runs share codes."""
    rng = np.random.default_rng(2)
    width = 2 * C.DRIFT + 30
    for codes in (C.CODES, 16):
        for _ in range(10):
            runs = rng.integers(0, 60, (40, width)).astype(np.uint64)
            doc = rng.permutation(40).astype(np.int64)
            own, other = np.arange(0, 40, 2), np.arange(40)
            with pytest.MonkeyPatch.context() as m:
                m.setattr(C, "CODES", codes)
                m.setattr(C, "ROWS", 7)
                got = {p for i, j in C.likely_pairs(doc, own, other, runs, 20) for p in zip(i.tolist(), j.tolist(), strict=True)}
            inner = [Counter(x for x in r[C.DRIFT : width - C.DRIFT].tolist() if x) for r in runs]
            want = {(i, j) for i in own.tolist() for j in other.tolist() if doc[j] < doc[i] and (inner[i] & Counter(runs[j].tolist())).total() >= 20}
            assert want and (want == got if codes == C.CODES else want <= got)


def test_what_cannot_align_has_no_passage():
    rng = random.Random(9)
    aligned = 0
    for _ in range(300):
        a = np.array([rng.randrange(300) for _ in range(90)], dtype=np.uint32)
        b = a.copy()
        for i in rng.sample(range(90), rng.randrange(0, 40)):
            b[i] = 1000 + i
        same = [i for i in range(90 - C.SEED) if (a[i : i + C.SEED] == b[i : i + C.SEED]).all()]
        if not same:
            continue
        found = C.align(a, b, [(same[0], same[0], same[-1])], 50, 0.8)
        aligned += bool(found)
        assert C.can_align(a, b, 50, 0.8) or not found
    assert aligned
    assert not C.can_align(a, a + np.uint32(5000), 50, 0.8) and not C.can_align(a[:40], a[:40], 50, 0.8)


def test_passages_with_changes(spark):
    """Of 60 words with one in ten changed, or fewer, nine in ten passages are found, wherever the changes lie."""
    rng, texts, planted = random.Random(5), {}, {}
    for even in (True, False):
        for every in (10, 12, 15, 20, 30):
            for _ in range(40):
                passage = prose(rng.randrange(1 << 30), 60).split()
                other = list(passage)
                for i in range(rng.randrange(every), 60, every) if even else rng.sample(range(60), 60 // every):
                    other[i] = f"x{rng.randrange(1 << 30)}"
                doc = len(texts) + 1
                for i, words in enumerate((passage, other)):
                    texts[doc + i] = f"{prose(rng.randrange(1 << 30), 50)} {' '.join(words)} {prose(rng.randrange(1 << 30), 40)}"
                planted[doc + 1] = (even, every)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    rows = C.shared_passages(df).collect()
    got = covered(rows)
    assert set(got) <= set(planted)
    assert all(r["partner"] == r["doc"] - 1 for r in rows)
    for kind in set(planted.values()):
        docs = [d for d, k in planted.items() if k == kind]
        assert sum(d in got for d in docs) >= 0.9 * len(docs), kind
    # nothing beyond the passage, but for chance
    assert all(places <= set(range(45, 115)) for places in got.values())


def test_extension_is_the_best_beginning():
    """Against the distances of all beginnings of both lists."""
    rng = random.Random(3)
    for _ in range(60):
        a = [rng.randrange(40) for _ in range(rng.randrange(0, 30))]
        b = list(a)
        for _ in range(rng.randrange(0, 3)):
            if b:
                place = rng.randrange(len(b))
                b[place : place + 1] = rng.choice(([], [99], [b[place], 98]))
        b = b[: rng.randrange(len(b) + 1)] + [200 + i for i in range(rng.randrange(8))]
        i, j, edits = C.extended(a, b, 4.0)
        gain = lambda x, y: min(x, y) - 4.0 * C.edit_distance(np.array(a[:x]), np.array(b[:y]))
        assert gain(i, j) == max(gain(x, y) for x in range(len(a) + 1) for y in range(len(b) + 1))
        assert edits == C.edit_distance(np.array(a[:i]), np.array(b[:j]))


def test_a_chain_of_two_passages_is_divided():
    a = np.arange(160, dtype=np.uint32)
    b = np.concatenate([a[:55], np.arange(1000, 1050, dtype=np.uint32), a[105:]])
    both = [(0, 0, 55 - C.SEED), (105, 105, 160 - C.SEED)]
    assert C.align(a, b, both, 50, 0.8) == {(0, 55, 0, 55, 0), (105, 160, 105, 160, 0)}


def test_runs_of_one_word_are_repeats(spark):
    texts = {1: "la " * 300, 2: prose(71, 20) + " la" * 150, 3: "la " * 60 + prose(72, 60) + " la" * 200, 4: prose(73, 10) + " la" * 130 + " " + prose(72, 55)}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(2)
    got = covered(C.shared_passages(df).collect())
    for doc, places in brute.repeated_words(texts, C.LEAST_WORDS).items():
        assert places <= got.get(doc, set()), doc


def test_nothing_to_share(no_docs):
    assert C.shared_passages(no_docs).count() == 0
    assert C.cut_passages(no_docs, C.shared_passages(no_docs)).count() == 0


def test_cut_leaves_first_occurrences_and_other_words(odd_docs, odd_texts):
    cut = C.cut_passages(odd_docs, C.shared_passages(odd_docs))
    assert cut.columns == odd_docs.columns
    rows = {r["doc_id"]: r for r in cut.collect()}
    assert rows[0]["text"] == odd_texts[0] and 1 not in rows and 2 not in rows
    assert rows[13]["text"].split()[:70] == odd_texts[13].split()[:70] and len(rows[13]["text"].split()) < 180
    assert rows[13]["n_chars"] == len(rows[13]["text"])
    assert rows[5]["text"] is None and rows[6]["text"] == "" and rows[7]["text"] == odd_texts[7] and None in rows
    left = {i: r["text"] for i, r in rows.items() if i is not None}
    assert not brute.repeated_words(left, C.LEAST_WORDS)


def test_chain_skips_a_stray_match():
    x = np.array([0, 5, 10, 12, 40, 45, 50])
    y = np.array([100, 105, 110, 900, 142, 147, 152])
    best = C.chains(x, y)[0]
    assert best == [(0, 100, 10), (40, 142, 50)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=8), st.lists(st.integers(0, 3), max_size=8))
def test_word_edits(a, b):
    row = list(range(len(b) + 1))
    for i, p in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, c in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (p != c))
    assert C.edit_distance(np.array(a, dtype=np.uint32), np.array(b, dtype=np.uint32)) == row[-1]


@settings(max_examples=150, deadline=None)
@given(st.text("abc", min_size=1, max_size=70), st.text("abc", max_size=90))
def test_myers_distance(pattern, text):
    best, end = D.Myers(pattern).best(text)
    assert best == min(len(pattern), brute.edit_distance_in(pattern, text))
    assert brute.edit_distance_in(pattern, text[:end]) == best


def mutated(text: str, edits: int, seed: int) -> str:
    draw, out = random.Random(seed), list(text)
    for _ in range(edits):
        at = draw.randrange(len(out))
        kind = draw.randrange(3)
        out[at : at + (kind > 0)] = draw.choice("xyz") if kind < 2 else ""
    return "".join(out)


def test_leaks_are_those_of_brute_force(spark):
    items = {i: prose(500 + i, 12 + i) for i in range(8)} | {8: "", 9: None, 10: "?!", 11: "word", 12: prose(500, 12)}
    texts = {i: f"{prose(i, 30)} {mutated(items[i % 8], i // 8, i)} {prose(90 + i, 30)}" for i in range(64)}
    texts |= {64: None, 65: "", 66: "a sword is no word", 67: "swords"}
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts.items()] + [(3, texts[3], "y")], "doc_id long, text string, item_id string").repartition(3)
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    plain = lambda df, key: [(r["k"], r["n"]) for r in df.select(df[key].alias("k"), normalized(df["text"]).alias("n")).collect()]
    want = {}
    for item, pattern in plain(bench, "item_id"):
        for doc, text in plain(docs, "doc_id"):
            if pattern and pattern.strip() and text is not None and (d := brute.edit_distance_in(pattern, text)) <= int(len(pattern) * D.ERROR_RATE):
                want[doc, item] = d
    got = D.find_leaks(docs, bench).collect()
    assert {(r["doc_id"], r["item_id"]): r["distance"] for r in got} == want
    assert (66, 11) in want and (67, 11) not in want and len(got) == len(want) + len([k for k in want if k[0] == 3])
    clean = D.without_leaks(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(set(texts) - {d for d, _ in want})
    # blocks of items give the same
    parts = D.find_leaks(docs, bench, block_bytes=300).collect()
    assert sorted(parts) == sorted(got)
    assert D.find_leaks(docs, bench.limit(0)).count() == 0 and D.find_leaks(docs.limit(0), bench).count() == 0
    assert D.without_leaks(docs, bench.limit(0)).count() == docs.count()
