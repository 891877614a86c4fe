"""Documents with all that is odd, as fixtures that the test modules import."""

from __future__ import annotations

import random

import pytest

#: A column whose name an operator may use itself.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, key string, doc string, root string"


def prose(seed: int, count: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice(("ba", "no", "ti", "re", "su", "mo")) for _ in range(draw.randint(1, 4))) for _ in range(count))


def variant(text: str, every: int) -> str:
    w = text.split()
    return " ".join("changed" if i % every == every - 1 else x for i, x in enumerate(w))


@pytest.fixture(scope="session")
def odd_texts() -> dict[int, str | None]:
    base = prose(1, 300)
    texts = {0: base, 1: base, 2: base.upper(), 3: variant(base, 60), 4: variant(base, 9), 5: None, 6: "", 7: " \t\n", 8: "one two", 9: "ONE  two"}
    texts |= {10: prose(2, 20_000), 11: prose(3, 4), 12: "x" * 100_000, 13: prose(4, 80) + " " + " ".join(base.split()[100:170]) + " " + prose(5, 80), 14: "été ÉTÉ 数据 \U0001f600", 15: "!!! ..."}
    texts |= {20 + i: variant(prose(1, 300), 50 + i) for i in range(15)}
    texts |= {40 + i: prose(100 + i, 60) + " the same closing line of all these pages" for i in range(20)}
    return texts


@pytest.fixture(scope="session")
def odd_docs(spark, odd_texts):
    rows = [(i, t, None if i % 3 else "en", None, None if t is None else len(t), "s", "k", "d", "r") for i, t in odd_texts.items()]
    rows += [rows[3], (None, "no key but a text", None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
