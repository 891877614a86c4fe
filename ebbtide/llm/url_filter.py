"""URL filter: allow and block rules first, a weighted vocabulary for the rest.

An Aho-Corasick automaton finds every term of the vocabulary in one pass over the lower-cased URL.
A hit counts if no letter or digit (a-z, 0-9) stands beside it. One strict term, or `soft_limit`
different soft terms, block a URL that no rule decides.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALPHANUMERIC = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")

STRICT_TERMS = ("porn", "porno", "xxx", "hentai", "camgirls", "casino", "sportsbook", "viagra", "cialis", "warez", "keygen")
SOFT_TERMS = ("adult", "nude", "sex", "sexy", "escort", "dating", "bet", "poker", "slots", "jackpot", "bonus", "loan", "payday", "pills", "torrent", "crack", "ads", "tracker")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class UrlPolicy:
    """What decides a URL; all parts travel to the tasks and are small lists the user wrote."""

    rules: Sequence[Rule] = ()
    strict: Sequence[str] = STRICT_TERMS
    soft: Sequence[str] = SOFT_TERMS
    soft_limit: int = 2


@dataclass
class Judge:
    policy: UrlPolicy
    by_host: dict[str, list[Rule]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        for rule in self.policy.rules:
            self.by_host.setdefault(rule.host, []).append(rule)
        self.terms = ahocorasick.Automaton()
        for soft, terms in ((True, self.policy.soft), (False, self.policy.strict)):  # strict wins if a term is both
            for term in terms:
                self.terms.add_word(term.translate(LOWER), (term.translate(LOWER), soft))
        if len(self.terms):
            self.terms.make_automaton()

    def parts(self, url: str | None) -> tuple[str, str]:
        """Host and path; both empty without a URL or a scheme."""
        _, mark, rest = (url or "").partition("://")
        if not mark:
            return "", ""
        end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
        host, tail = rest[:end].translate(LOWER), rest[end:]
        stop = min((i for i in map(tail.find, "?#") if i >= 0), default=len(tail))
        return host, tail[:stop]

    def rule(self, host: str, path: str) -> Rule | None:
        """The longest rule that fits; of equally long ones a block, then the first by name."""
        found, domain = [], host
        while True:
            found += [r for r in self.by_host.get(domain, ()) if path.startswith(r.path)]
            _, dot, domain = domain.partition(".")
            if not dot:
                break
        return min(found, key=lambda r: (-len(r.name), r.verdict != BLOCK, r.name), default=None)

    def hits(self, url: str | None) -> tuple[list[str], list[str]]:
        """Different strict and soft terms that stand alone in the URL."""
        text = (url or "").translate(LOWER)
        strict, soft = set(), set()
        if len(self.terms):
            for last, (term, is_soft) in self.terms.iter(text):
                before, after = last - len(term), last + 1
                if (before < 0 or text[before] not in ALPHANUMERIC) and (after == len(text) or text[after] not in ALPHANUMERIC):
                    (soft if is_soft else strict).add(term)
        return sorted(strict), sorted(soft)

    def of(self, url: str | None) -> tuple[str, str, str | None, str, list[str], list[str]]:
        host, path = self.parts(url)
        strict, soft = self.hits(url)
        rule = self.rule(host, path)
        if rule is not None:
            return host, path, rule.name, rule.verdict, strict, soft
        rejected = bool(strict) or len(soft) >= self.policy.soft_limit
        return host, path, None, BLOCK if rejected else ALLOW, strict, soft


OUT = ("host", "path", "rule", "verdict", "strict_hits", "soft_hits")


def judge_urls(df: DataFrame, policy: UrlPolicy, key: str = "page_id", url: str = "url") -> DataFrame:
    """One row per row of df: its key, host, path, rule, verdict and the terms found.

    A null URL, or one without ://, has an empty host and path, fits no rule and is judged by its
    terms alone (a null one is allowed). Repeated rows give repeated results, an empty table none.
    Only the key and the URL are read; other columns, whatever their names, play no part.
    """
    slim = df.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"))
    kind = slim.schema["key"].dataType.simpleString()
    schema = f"`{key}` {kind}, host string, path string, rule string, verdict string, strict_hits array<string>, soft_hits array<string>"
    arrow = [pa.string()] * 4 + [pa.list_(pa.string())] * 2

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(policy)
        for batch in batches:
            found = [judge.of(u) for u in batch.column(1).to_pylist()]
            columns = [pa.array([f[i] for f in found], t) for i, t in enumerate(arrow)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[key, *OUT])

    return slim.mapInArrow(run, schema)
