from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from ebbtide.llm import words as W

TEXT = st.text(st.sampled_from("abAB é数\t\n . \U0001f600"), max_size=60)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=6))
def test_words_and_shingles_are_those_of_plain_python(texts):
    found = W.words_of(*W.text_bytes(pa.array(texts, pa.string())), heads=(2,))
    numbers: dict[bytes, int] = {}
    for i, text in enumerate(texts):
        own = found.hash[found.of(i)]
        plain = brute.words(text)
        assert len(own) == len(plain)
        for h, w in zip(own.tolist(), plain, strict=True):
            assert numbers.setdefault(w, h) == h
    assert len(set(numbers.values())) == len(numbers)
    sets = list(W.shingle_sets(found, 5))
    assert [len(s) for s in sets] == [len(brute.shingles(t)) for t in texts]
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert len(np.intersect1d(sets[i], sets[j])) == len(brute.shingles(a) & brute.shingles(b))


def test_segments_do_not_change_the_words(monkeypatch):
    texts = ["one two  three " * 20, "", "x" * 50, "a b", None, "tail"]
    whole = W.words_of(*W.text_bytes(pa.array(texts)))
    monkeypatch.setattr(W, "SEGMENT", 16)
    parts = W.words_of(*W.text_bytes(pa.array(texts)))
    assert (whole.hash == parts.hash).all() and (whole.start == parts.start).all() and (whole.end == parts.end).all()


def test_a_slice_of_a_batch_has_its_own_texts():
    column = pa.array(["first text", "second", None, "third one"]).slice(1)
    data, offsets = W.text_bytes(column)
    assert data.tobytes() == b"secondthird one" and offsets.tolist() == [0, 6, 6, 15]
