"""The cascade's verdicts, its order, and the measures it reports."""

from __future__ import annotations

import collections
import re

import numpy as np
import pytest

from corpora import no_docs, odd_docs, odd_texts  # noqa: F401
from ebbtide.llm import quality_cascade as qc
from ebbtide.llm.repeats import repeated_windows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
REPORT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_letterless", "n_exclamations", "n_lines"]


def plain(text: str | None) -> dict[str, int]:
    text = text or ""
    words = WORD.findall(text)
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": sum(line in lines[:i] for i, line in enumerate(lines)),
        "n_repeat_words": len(inside),
        "n_letterless": sum(not re.search(r"[A-Za-z\x80-\U0010ffff]", w) for w in words),
        "n_exclamations": text.count("!"),
        "n_lines": len(lines),
    }


SPECIAL = [
    None, "", "  \n", "a b\nc\n\na b\na b \n", "\x85one\x1ctwo three four", "| | # ## 12 34 a1 é 数据", "no\x00thing\x0bbut\x0cwords",
    "it is the same line of ten words again and again\n" * 3 + "then something else comes and makes it longer by these words",
    " ".join(map(str, range(50))), "x" * 200_000, "w " * 30_000, "!!! " * 30, "ok! " * 25, "ab " * 21,
]


@pytest.mark.parametrize("text", SPECIAL, ids=range(len(SPECIAL)))
def test_measures_equal_the_plain_ones(text):
    m = qc.Measures((text or "").encode())
    assert {name: m[name] for name in REPORT} == plain(text)


def rejected(text: str | None) -> bool:
    values = plain(text)
    return any(rule.rejects(*[values[name] for name in rule.measures]) for rule in qc.RULES)


def test_every_row_is_judged_whole(spark, odd_docs, odd_texts):  # noqa: F811
    got = qc.judge_quality(odd_docs, report=REPORT[:5]).collect()
    assert len(got) == odd_docs.count()
    for row in got:
        text = odd_texts.get(row["doc_id"], "no key but a text")
        values = plain(text)
        assert [row[name] for name in REPORT[:5]] == [values[name] for name in REPORT[:5]]
        assert row["kept"] == (not rejected(text)) == (row["rejected_by"] is None)


def test_the_order_changes_no_verdict(spark):
    df = spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id long, text string").repartition(3)
    free = qc.Plan(tuple(reversed(qc.RULES)), (0.0,) * len(qc.RULES), (0.0,) * len(qc.RULES), 0)
    one = {r["doc_id"]: r["kept"] for r in qc.judge_quality(df).collect()}
    two = {r["doc_id"]: r["kept"] for r in qc.judge_quality(df, plan=free).collect()}
    assert one == two == {i: not rejected(text) for i, text in enumerate(SPECIAL)}


def test_no_rows(spark, no_docs):  # noqa: F811
    assert qc.judge_quality(no_docs, report=["n_words"]).collect() == []
    assert qc.plan_cascade(no_docs).sampled == 0


def test_next_comes_the_rule_with_most_rejections_per_second():
    rules = [qc.Rule(name, (name,), bool) for name in "abcd"]
    rejects = np.zeros((100, 4), dtype=bool)
    rejects[:40, 0] = True  # a: 40 for 4 seconds
    rejects[:30, 1] = True  # b: 30 for 1 second, all of them a's too
    rejects[40:45, 2] = True  # c: 5 for 1 second
    plan = qc.order_rules(rules, rejects, dict(a=4.0, b=1.0, c=1.0, d=0.5))
    assert [r.name for r in plan.rules] == ["b", "c", "a", "d"]
    assert plan.rejected == (0.3, 5 / 70, 10 / 65, 0.0)
    # what is reported anyway costs nothing, so its rule is asked first
    assert [r.name for r in qc.order_rules(rules, rejects, dict(a=4.0, b=1.0, c=1.0, d=0.5), paid=["a"]).rules][0] == "a"


def test_a_measure_is_taken_once_and_only_if_asked_for():
    m = qc.Measures(b"one two")
    plan = qc.Plan(qc.RULES, (), (), 0)
    assert plan.rejecting(m) is qc.FEW_WORDS and set(m.taken) == {"n_words"}


def test_the_sample_is_bounded_and_takes_a_text_once(spark):
    df = spark.createDataFrame([(i, "the same hot text") for i in range(300)] + [(i, f"text {i}") for i in range(300, 340)], "doc_id long, text string")
    assert qc.plan_cascade(df, sample_texts=1000).sampled == 41
    assert qc.plan_cascade(df, sample_texts=5).sampled <= 5


def test_windows_with_one_number_are_told_apart():
    words = [b"a", b"b", b"a", b"c", b"a", b"b", b"d"]
    same = np.zeros(len(words), dtype=np.uint64)  # every window has the same number
    assert repeated_windows(words, 2, same).tolist() == [True, False, False, False, True, False]
    assert repeated_windows(words[:1], 2).tolist() == [] and repeated_windows(words[:2], 2).tolist() == [False]
