"""Quality rules as a short-circuit cascade: what rejects most for its cost is asked first.

A rule needs measures of a text and rejects by their values. Measures are taken when a rule first asks
for them, so a text that an early rule rejects never pays for the later ones. A bounded sample tells what
each measure costs and what each rule rejects; the order is then built greedily: next comes the rule with
the most rejections per second among the sampled texts that the rules before it let pass, where measures
already taken are free. The order changes the work only, never a verdict: a text is kept if no rule
rejects it.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import slices
from ebbtide.llm.repeats import covered, repeated_windows

SAMPLE_TEXTS = 2000  # distinct texts, at most, that costs and rejections are estimated on
REPEAT_WINDOW = 8

BLANKS = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
WITHOUT_LETTER = re.compile(rb"(?:^|(?<=[ \t\n\r\x0b\x0c]))[^A-Za-z\x80-\xff \t\n\r\x0b\x0c]+(?=[ \t\n\r\x0b\x0c]|$)")


class Measures:
    """Measures of one text, each taken once and only if asked for."""

    def __init__(self, text: bytes):
        self.text = text
        self.taken: dict[str, int] = {}
        self._words: list[bytes] | None = None

    def __getitem__(self, name: str) -> int:
        if name not in self.taken:
            self.taken[name] = MEASURES[name](self)
        return self.taken[name]

    def words(self) -> list[bytes]:
        if self._words is None:
            self._words = self.text.split()  # bytes are split at exactly the blanks above
        return self._words


def _code_points(data: bytes) -> int:
    return len(data.decode("utf-8", "replace"))


def _lines(text: bytes) -> list[bytes]:
    return [line for line in text.split(b"\n") if line.strip(BLANKS)]


def _duplicate_lines(m: Measures) -> int:
    lines = _lines(m.text)
    return len(lines) - len(set(lines))


def _repeat_words(m: Measures) -> int:
    starts = repeated_windows(m.words(), REPEAT_WINDOW)
    return int(covered(starts, REPEAT_WINDOW, m["n_words"]).sum()) if starts.any() else 0


#: By name: how a measure is taken.
MEASURES: dict[str, Callable[[Measures], int]] = {
    "n_words": lambda m: len(m.words()),
    "word_chars": lambda m: _code_points(m.text.translate(None, BLANKS)),
    "n_symbols": lambda m: len(m.text) - len(m.text.translate(None, SYMBOLS)),
    "n_exclamations": lambda m: m.text.count(b"!"),
    "n_lines": lambda m: len(_lines(m.text)),
    "n_dup_lines": _duplicate_lines,
    "n_repeat_words": _repeat_words,
    "n_letterless": lambda m: len(WITHOUT_LETTER.findall(m.text)),
}


@dataclass(frozen=True)
class Rule:
    """Rejects a text by the values of its measures, given in their order."""

    name: str
    measures: tuple[str, ...]
    rejects: Callable[..., bool]


FEW_WORDS = Rule("few_words", ("n_words",), lambda words: words < 20)
REPETITION = Rule("repetition", ("n_repeat_words", "n_words"), lambda repeated, words: 100 * repeated > 30 * words)
BASE = (FEW_WORDS, REPETITION)
RULES = (
    *BASE,
    Rule("symbols", ("n_symbols", "n_words"), lambda symbols, words: 10 * symbols > words),
    Rule("exclamations", ("n_exclamations", "n_words"), lambda marks, words: 10 * marks > 3 * words),
    Rule("duplicate_lines", ("n_dup_lines", "n_lines"), lambda repeated, lines: 2 * repeated > lines),
    Rule("short_words", ("word_chars", "n_words"), lambda chars, words: chars < 2 * words),
    Rule("long_words", ("word_chars", "n_words"), lambda chars, words: chars > 15 * words),
    Rule("letterless", ("n_letterless", "n_words"), lambda letterless, words: 5 * letterless > 2 * words),
)


@dataclass(frozen=True)
class Plan:
    """Rules in the order they are asked, and what the sample said about each."""

    rules: tuple[Rule, ...]
    seconds: tuple[float, ...]  # per text that reaches the rule
    rejected: tuple[float, ...]  # share of the texts that reach it
    sampled: int

    def rejecting(self, m: Measures) -> Rule | None:
        """The first rule that rejects; the later ones are not asked."""
        for rule in self.rules:
            if rule.rejects(*[m[name] for name in rule.measures]):
                return rule
        return None


def order_rules(rules: Sequence[Rule], rejects: np.ndarray, seconds: dict[str, float], paid: Iterable[str] = ()) -> Plan:
    """rejects: sampled texts x rules. seconds: of each measure per text; those in `paid` are taken anyway.

    Rules without a rejection come last, the cheapest first; ties go by the order given.
    """
    left, taken = list(range(len(rules))), set(paid)
    alive = np.ones(len(rejects), dtype=bool)
    order, costs, shares = [], [], []
    while left:
        reach = max(1, int(alive.sum()))

        def standing(i: int) -> tuple[float, float, int]:
            cost = sum(seconds.get(name, 0.0) for name in set(rules[i].measures) - taken) + 1e-9
            return (-(rejects[alive, i].sum() / reach) / cost, cost, i)

        best = min(left, key=standing)
        _, cost, _ = standing(best)
        order.append(rules[best])
        costs.append(cost)
        shares.append(float(rejects[alive, best].sum() / reach))
        taken |= set(rules[best].measures)
        alive &= ~rejects[:, best]
        left.remove(best)
    return Plan(tuple(order), tuple(costs), tuple(shares), len(rejects))


def _probe(rules: Sequence[Rule]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Every rule on every text of a batch: rejections and the seconds of each measure."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = sorted({name for rule in rules for name in rule.measures})
        for batch in batches:
            rows = []
            for text in batch.column(0).cast(pa.large_binary()).to_pylist():
                m, spent = Measures(text or b""), []
                m.words()  # every text pays for its words
                for name in names:
                    start = time.thread_time()
                    m[name]
                    spent.append(time.thread_time() - start)
                rows.append(([r.rejects(*[m[n] for n in r.measures]) for r in rules], spent))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows]) for i in (0, 1)], names=["rejects", "seconds"])

    return run


def plan_cascade(df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_texts: int = SAMPLE_TEXTS, paid: Iterable[str] = ()) -> Plan:
    """The order of the rules for the texts of df, from at most `sample_texts` different ones.

    The sample takes texts by their hash, each once however often it occurs. What reaches the driver is
    a few numbers per sampled text. An empty table keeps the order of cost alone.
    """
    texts = df.select(F.col(text).cast("string").alias("text"))
    number = F.xxhash64("text")
    count = texts.count()
    picked = texts.where(F.pmod(number, F.lit(max(1, count // sample_texts))) == 0).groupBy(number.alias("number")).agg(F.first("text").alias("text"))
    found = picked.limit(sample_texts).select("text").mapInArrow(_probe(rules), "rejects array<boolean>, seconds array<double>").collect()
    names = sorted({name for rule in rules for name in rule.measures})
    rejects = np.array([r["rejects"] for r in found], dtype=bool).reshape(-1, len(rules))
    spent = np.array([r["seconds"] for r in found]).reshape(-1, len(names))
    return order_rules(rules, rejects, dict(zip(names, spent.mean(axis=0) if len(spent) else np.zeros(len(names)), strict=True)), paid)


def judge_quality(
    df: DataFrame,
    rules: Sequence[Rule] = RULES,
    report: Sequence[str] = (),
    key: str = "doc_id",
    text: str = "text",
    plan: Plan | None = None,
) -> DataFrame:
    """key, kept, rejected_by and the measures to report, for every row.

    Every text is judged whole. A null text has no words, like an empty one; both are judged by the same
    rules (with RULES: too few words). Rows are judged one by one, so repeated rows and rows without a key
    each get their own, equal texts the same verdict; an empty table gives no rows. Other columns are not
    read. rejected_by names the first rule, in the plan's order, that rejects (null if kept). Measures in
    `report` are taken for every text, rejected or not, and count as paid when the order is planned.
    """
    asked = plan or plan_cascade(df, rules, text, paid=report)
    slim = df.select(F.col(key).alias("row_key"), F.col(text).cast("string").alias("text"))
    kind = slim.schema["row_key"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            verdicts, values = [], [[] for _ in report]
            for value in batch.column(1).cast(pa.large_binary()).to_pylist():
                m = Measures(value or b"")
                rule = asked.rejecting(m)
                verdicts.append(rule.name if rule else None)
                for at, name in enumerate(report):
                    values[at].append(m[name])
            by = pa.array(verdicts, pa.string())
            columns = [batch.column(0), pa.compute.is_null(by), by, *[pa.array(v, pa.int64()) for v in values]]
            yield pa.RecordBatch.from_arrays(columns, names=["row_key", "kept", "rejected_by", *report])

    judged = slim.mapInArrow(run, f"row_key {kind}, kept boolean, rejected_by string" + "".join(f", `{name}` long" for name in report))
    return judged.withColumnRenamed("row_key", key)
