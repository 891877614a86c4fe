"""Toxicity: a linear classifier that is penalised where swapping identity terms changes its score.

Features are the words of a text and their first bytes, hashed; each counts once. The logistic loss
over labelled rows gets two terms: a ridge, and the squared change of the score between a row and its
counterfactuals. A counterfactual replaces every identity term of the row by another of its group; a
row without such terms gets one put before it, so that naming a group alone does not move the score.
Scores are computed batch by batch in the tasks, over whole texts and without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import normalized, slices
from ebbtide.llm.words import Words, text_bytes, words_of

FEATURES = 1 << 20
HEADS = (4, 5, 6, 7)
SAMPLE_ROWS = 8000  # bound of the labelled rows a model is fitted on; all of them if there are fewer
KEEP_FEATURES = 16_384
LEAST_ROWS = 4  # of a feature in the sample

#: Terms of a group can stand for each other in a sentence.
IDENTITY_GROUPS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("frauen", "männer"),
    ("femmes", "hommes"),
    ("mujeres", "hombres"),
)


def features_of(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Text number and feature of every word and of every head of one."""
    docs, found = [words.doc], [words.hash]
    for head in words.heads.values():
        long = head != 0
        docs.append(words.doc[long])
        found.append(head[long])
    return np.concatenate(docs), (np.concatenate(found) & np.uint64(FEATURES - 1)).astype(np.int64)


def _different(docs: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.unique(docs.astype(np.int64) * FEATURES + features)
    return pairs // FEATURES, pairs % FEATURES


class Swapper:
    """The counterfactuals of a text."""

    def __init__(self, groups: Sequence[Sequence[str]]):
        self.group = {t: g for g in groups for t in g}
        self.terms = sorted(self.group)
        self.pattern = re.compile(r"(?<!\w)(" + "|".join(map(re.escape, sorted(self.terms, key=len, reverse=True))) + r")(?!\w)", re.IGNORECASE)

    def of(self, text: str, seed: int) -> str:
        def other(match: re.Match) -> str:
            group = self.group[match[0].lower()]
            place = group.index(match[0].lower())
            return group[(place + 1 + seed % (len(group) - 1)) % len(group)]

        swapped, count = self.pattern.subn(other, text)
        return swapped if count else f"{self.terms[seed % len(self.terms)]} {text}"


@dataclass
class ToxicityModel:
    weights: np.ndarray  # of all features; 0 for most
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        words = words_of(*text_bytes(column), HEADS)
        docs, features = features_of(words)
        used = self.weights[features] != 0
        docs, features = _different(docs[used], features[used])
        total = np.bincount(docs, weights=self.weights[features], minlength=len(column)) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _sample(labels: DataFrame, key: str, label: str, rows: int) -> DataFrame:
    """At most about `rows` labelled keys, half of them of each label where there are enough; a key
    labelled both ways counts as toxic."""
    one = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(key).alias("key")).agg(F.max(label).cast("int").alias("label"))
    counts = {r["label"]: r["n"] for r in one.groupBy("label").agg(F.count("*").alias("n")).collect()}
    few = min(counts.get(0, 0), counts.get(1, 0), rows // 2)
    wanted = {v: min(n, max(rows // 2, rows - few)) for v, n in counts.items()}
    place = F.shiftrightunsigned(F.xxhash64("key", F.lit(7)), 11) / float(1 << 53)
    parts = [(F.col("label") == v) & (place < wanted[v] / n) for v, n in counts.items()]
    keep = F.lit(False)
    for part in parts:
        keep = keep | part
    return one.where(keep)


def fit_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    groups: Sequence[Sequence[str]] = IDENTITY_GROUPS,
    sample_rows: int = SAMPLE_ROWS,
    ridge: float = 0.02,
    swap_penalty: float = 1.0,
    steps: int = 300,
) -> ToxicityModel:
    """Fit on at most sample_rows of the labelled rows, chosen by a hash of their key.

    Rows with a null key or a label other than 0 and 1 teach nothing. Without rows the model scores
    0.5 everywhere, with rows of one label it scores near that label.
    """
    chosen = _sample(labels, key, label, sample_rows)
    # the sample is bounded by sample_rows
    rows = documents.select(F.col(key).alias("key"), normalized(F.col(text)).alias("text")).join(F.broadcast(chosen), "key")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        swapper = Swapper(groups)
        for batch in slices(batches, 1):
            texts, keys = batch.column(1), batch.column(0).to_pylist()
            swaps = [swapper.of(t or "", hash(k)) for t, k in zip(texts.to_pylist(), keys, strict=True)]
            out = []
            for column in (texts, pa.array(swaps, pa.string())):
                docs, found = _different(*features_of(words_of(*text_bytes(column), HEADS)))
                bounds = np.searchsorted(docs, np.arange(len(column) + 1))
                out.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(found.astype(np.int32))))
            yield pa.RecordBatch.from_arrays([batch.column(2), *out], names=["label", "own", "swapped"])

    got = rows.mapInArrow(run, "label int, own array<int>, swapped array<int>").toArrow()
    return _fit(got, ridge, swap_penalty, steps)


def _csr(column: pa.ChunkedArray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lists = column.combine_chunks()
    docs = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    at = place[lists.values.to_numpy()]
    return docs[at >= 0], at[at >= 0]


def _fit(got: pa.Table, ridge: float, swap_penalty: float, steps: int) -> ToxicityModel:
    y = got["label"].to_numpy().astype(np.float64)
    n = len(y)
    if not n:
        return ToxicityModel(np.zeros(FEATURES), 0.0)
    lists = got["own"].combine_chunks()
    all_docs, values = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy())), lists.values.to_numpy()
    seen = np.bincount(values, minlength=FEATURES)
    toxic = np.bincount(values, weights=y[all_docs], minlength=FEATURES)
    # how far the toxic share of a feature's rows is from that of all rows
    rate = y.mean()
    gap = np.abs(toxic - seen * rate) / np.sqrt(seen * rate * (1 - rate) + 1e-9)
    gap[seen < LEAST_ROWS] = -1
    keep = np.argsort(-gap, kind="stable")[:KEEP_FEATURES]
    keep = np.sort(keep[gap[keep] >= 0])
    place = np.full(FEATURES, -1)
    place[keep] = np.arange(len(keep))
    docs, cols = _csr(got["own"], place)
    other_docs, other_cols = _csr(got["swapped"], place)
    balance = np.where(y == 1, 0.5 / max(rate, 1e-9), 0.5 / max(1 - rate, 1e-9)) if 0 < rate < 1 else np.ones(n)
    dims = len(keep)

    def product(d: np.ndarray, c: np.ndarray, w: np.ndarray) -> np.ndarray:
        return np.bincount(d, weights=w[c], minlength=n)

    def back(d: np.ndarray, c: np.ndarray, r: np.ndarray) -> np.ndarray:
        return np.bincount(c, weights=r[d], minlength=dims)

    w, bias = np.zeros(dims), 0.0
    m, v, mb, vb = np.zeros(dims), np.zeros(dims), 0.0, 0.0
    for step in range(1, steps + 1):  # Adam over all rows
        z = product(docs, cols, w)
        error = balance * (1 / (1 + np.exp(-np.clip(z + bias, -30, 30))) - y) / n
        change = 2 * swap_penalty * (z - product(other_docs, other_cols, w)) / n
        gradient = back(docs, cols, error + change) - back(other_docs, other_cols, change) + ridge * w / np.sqrt(n)
        rate_now = 0.05 * (1 - step / (steps + 1))
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        mb, vb = 0.9 * mb + 0.1 * error.sum(), 0.99 * vb + 0.01 * error.sum() ** 2
        w -= rate_now * m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        bias -= rate_now * mb / (1 - 0.9**step) / (np.sqrt(vb / (1 - 0.99**step)) + 1e-8)
    w[np.abs(w) < 0.01] = 0
    weights = np.zeros(FEATURES)
    weights[keep] = w
    return ToxicityModel(weights, float(bias))


def _scored(df: DataFrame, model: ToxicityModel, text: str, least: float | None) -> DataFrame:
    """All columns and the score; with least, only rows that score less, without the score."""
    columns = df.columns
    used = np.flatnonzero(model.weights)
    parts = (used, model.weights[used], model.bias)  # small, unlike the table

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(FEATURES)
        weights[parts[0]] = parts[1]
        own = ToxicityModel(weights, parts[2])
        place = len(columns)
        for batch in slices(batches, place):
            scores = own.scores(batch.column(place))
            fields = list(batch.schema)[:place]
            if least is None:
                yield pa.RecordBatch.from_arrays([*batch.columns[:place], pa.array(scores)], schema=pa.schema([*fields, pa.field("score", pa.float64())]))
            else:
                kept = batch.filter(pa.array(scores < least))
                yield pa.RecordBatch.from_arrays(kept.columns[:place], schema=pa.schema(fields))

    wide = df.select(*[df[f"`{c}`"] for c in columns], normalized(df[text]).alias("text to score"))
    schema = df.schema if least is not None else df.select("*", F.lit(0.0).alias("score")).schema
    return wide.mapInArrow(run, schema)


def score_toxicity(df: DataFrame, model: ToxicityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and score of every row; null and empty texts get the score of no words at all.

    Repeated rows give repeated results, an empty table none; other columns are not read.
    """
    slim = df.select(F.col(key).alias("row key"), F.col(text).alias("row text"))
    return _scored(slim, model, "row text", None).select(F.col("`row key`").alias(key), "score")


def drop_toxic(df: DataFrame, model: ToxicityModel, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows, with all their columns, that score under `least`."""
    return _scored(df, model, text, least)
