"""Groups and counts of aligned tokens against a walk over the byte offsets."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from conftest import SF_SMALL
from corpora import no_docs, odd_docs, odd_texts  # noqa: F401
from ebbtide.llm import token_alignment as ta
from ebbtide.llm.common import table
from ebbtide.llm.queries import QUERIES


class Plain:
    """Token bytes by the vocabulary files themselves."""

    def __init__(self):
        self.a = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        shown = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b >= 174]
        signs = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        self.a_bytes = {i: bytes(signs[c] for c in t) if set(t) <= set(signs) else b"" for t, i in self.a.get_vocab().items()}

    def b_bytes(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text: str | None) -> list[tuple[list[int], list[int]]]:
        if not text:
            return []
        a, b, whole = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text), (" " + text).encode()
        bytes_a, bytes_b = [self.a_bytes[i] for i in a], [self.b_bytes(i) for i in b]
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            return []
        out, group, i, j, at_a, at_b = [], ([], []), 0, 0, 0, 0
        while i < len(a) or j < len(b):
            if at_a <= at_b:
                group[0].append(a[i])
                at_a, i = at_a + len(bytes_a[i]), i + 1
            else:
                group[1].append(b[j])
                at_b, j = at_b + len(bytes_b[j]), j + 1
            if at_a == at_b:
                out.append(group)
                group = ([], [])
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


def shown(groups) -> str:
    return ";".join("|".join(",".join(map(str, side)) for side in group) for group in groups)


def expected(plain: Plain, texts: list[str | None]) -> list[tuple]:
    aligned = [plain.groups(t) for t in texts]
    links = [[(a[-1], b[-1]) for a, b in groups] for groups in aligned]
    counts = collections.Counter(x for own in links for x in own)
    most: dict[int, int] = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    return [
        (
            sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(own),
            sum(counts[x] == most[x[1]] for x in own), sum(counts[x] for x in own), shown(groups),
        )
        for groups, own in zip(aligned, links, strict=True)
    ]


SPECIAL = [
    None, "", " ", "a", " a", "a  b\t\tc\r\n", "a▁b", "<s> x </s> <unk> <0x41> <|endoftext|>", "été 数据 \U0001f600\U0001f600 cafés", "\x00\x01\x7f", "x" * 3_000,
    "ab" * 4_000, "\U0001f468‍\U0001f469‍\U0001f467" * 50, "the cat, the cat, the hat", "﻿word", "1234567 89 3.14159",
]


def rows(df):
    return {r["doc_id"]: tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")) for r in df.collect()}


def test_special_texts(spark, plain):
    df = spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id long, text string").repartition(3)
    assert rows(ta.score_alignment(df)) == dict(enumerate(expected(plain, SPECIAL)))


def test_counts_joined_by_shuffling_are_the_same(spark, plain):
    df = spark.createDataFrame(list(enumerate(SPECIAL * 3)), "doc_id long, text string").repartition(5)
    assert rows(ta.score_alignment(df, broadcast_bytes=0)) == rows(ta.score_alignment(df)) == dict(enumerate(expected(plain, SPECIAL * 3)))


def test_odd_table(spark, plain, odd_docs, odd_texts):  # noqa: F811
    ids = [r["doc_id"] for r in odd_docs.collect()]
    want = expected(plain, [odd_texts.get(i, "no key but a text") for i in ids])
    got = ta.score_alignment(odd_docs)
    columns = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    assert sorted((str(r["doc_id"]), *[r[c] for c in columns]) for r in got.collect()) == sorted((str(i), *w) for i, w in zip(ids, want, strict=True))


def test_no_rows(spark, no_docs):  # noqa: F811
    assert ta.score_alignment(no_docs).collect() == []


def test_pointers_reach_the_end_of_each_group():
    draw = random.Random(3)
    for _ in range(200):
        n = draw.randint(1, 200)
        ends = [np.array(sorted({*draw.sample(range(1, n + 1), draw.randint(1, n)), n})) for _ in range(2)]
        both = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
        last = np.searchsorted(ends[1], both)
        for side, got in zip(ends, ta.terminals(*ends), strict=True):
            assert got.tolist() == last[np.searchsorted(both, side)].tolist()


def test_query_equals_brute_force(spark, plain):
    docs = table(spark, SF_SMALL, "documents").collect()
    want = expected(plain, [d["text"] for d in docs])
    got = {tuple(r) for r in QUERIES["op12_token_alignment"](spark, SF_SMALL).collect()}
    assert got == {(d["doc_id"], *w[:6], w[6] and hashlib.sha256(w[6].encode()).hexdigest()) for d, w in zip(docs, want, strict=True)}
