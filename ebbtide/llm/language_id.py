"""Language identification with error-correcting output codes.

Each language has a codeword of bits; for each bit a linear classifier over hashed byte trigrams
predicts which half of the languages a text belongs to. Decoding sums, for every codeword, the
logistic losses of the bits, each weighted by how well its classifier does, and takes the nearest
codeword. A text whose two nearest codewords are about as near is flagged as ambiguous.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import slices
from ebbtide.llm.words import LOWER, text_bytes

DIMS = 4096
SAMPLE_ROWS = 4000  # bound of the rows a model is fitted on, shared evenly among the languages
UNKNOWN = "und"

#: ASCII letters in lower case and all bytes of longer characters stay; the rest separates words.
LETTERS = np.where((LOWER >= 97) & (LOWER <= 122) | (np.arange(256) >= 128), LOWER, 32).astype(np.uint32)


def codewords(count: int) -> np.ndarray:
    """A row of -1 and 1 per language.

    Up to 6 languages every different split is a bit; for more, bits are drawn by a fixed seed and
    the codes kept whose nearest rows are farthest apart.
    """
    if count <= 6:
        splits = [s for s in itertools.product((-1, 1), repeat=count) if s[0] == 1 and -1 in s]
        return np.array(splits, dtype=np.float64).T if splits else np.ones((count, 1))
    bits, rng = 8 * int(np.ceil(np.log2(count))), np.random.default_rng(11)
    drawn = (np.where(rng.random((count, bits)) < 0.5, -1.0, 1.0) for _ in range(50))
    near = lambda code: min(int((code[i] != code[j]).sum()) for i, j in itertools.combinations(range(count), 2))
    return max(drawn, key=near)


def trigram_counts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, bucket and count of the trigrams of every text, which is taken with a blank at
    both ends; trigrams of blanks alone are left out."""
    padded = pa.compute.binary_join_element_wise(pa.scalar("", pa.large_string()), pa.compute.fill_null(column.cast(pa.large_string()), ""), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
    data, offsets = text_bytes(padded)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    letters = LETTERS[data]
    code = letters[:-2] | letters[1:-1] << np.uint32(8) | letters[2:] << np.uint32(16)
    valid = code != np.uint32(0x202020)
    # the last two places of a text reach into the next one
    ends = np.concatenate([offsets[1:] - 1, offsets[1:] - 2])
    ends = ends[(ends >= 0) & (ends < len(valid))]
    valid[ends] = False
    docs = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:-2][valid]
    buckets = ((code[valid] * np.uint32(0x9E3779B1)) >> np.uint32(20)).astype(np.int64)
    if len(offsets) - 1 <= 4096:
        table = np.bincount(docs * DIMS + buckets, minlength=(len(offsets) - 1) * DIMS)
        cells = np.flatnonzero(table)
        return cells // DIMS, cells % DIMS, table[cells]
    cells, counts = np.unique(docs * DIMS + buckets, return_counts=True)
    return cells // DIMS, cells % DIMS, counts


def _values(docs: np.ndarray, counts: np.ndarray, rows: int) -> np.ndarray:
    """Square roots of the counts, each text scaled to length 1."""
    norm = np.sqrt(np.bincount(docs, weights=counts, minlength=rows))
    return np.sqrt(counts) / norm[docs]


@dataclass
class LanguageModel:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # a row per bucket, a column per bit
    bias: np.ndarray
    bit_weights: np.ndarray

    def margins(self, column: pa.Array) -> np.ndarray:
        docs, buckets, counts = trigram_counts(column)
        values = _values(docs, counts, len(column))
        out = np.empty((len(column), len(self.bias)))
        for bit in range(len(self.bias)):
            out[:, bit] = np.bincount(docs, weights=values * self.weights[buckets, bit], minlength=len(column))
        return out + self.bias

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest language, its share of belief, and the lead over the second in loss per bit."""
        loss = np.stack([(np.logaddexp(0, -margins * row) * self.bit_weights).sum(axis=1) for row in self.code], axis=1)
        order = np.argsort(loss, axis=1, kind="stable")
        best = order[:, 0]
        belief = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        score = belief[np.arange(len(best)), best] / belief.sum(axis=1)
        if loss.shape[1] == 1:
            return best, score, np.full(len(best), np.inf)
        lead = loss[np.arange(len(best)), order[:, 1]] - loss[np.arange(len(best)), best]
        return best, score, lead / self.bit_weights.sum()


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def fit_language_model(df: DataFrame, text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS, seed: str = "text", steps: int = 200) -> LanguageModel | None:
    """Fit on about sample_rows different texts, chosen by a hash of the text, the same number per language.

    Copies of a text teach once per language, however many there are: the bound holds for a text that a
    third of the rows has, too. Numbers of different texts are estimates, off by a few in a hundred. Texts of
    any length count whole. Rows without a language or without text teach nothing; None if no row is left.
    """
    rows = df.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("text", 0.02).alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    share = max(1, sample_rows // len(languages))
    place = F.shiftrightunsigned(F.xxhash64("text", F.lit(3)), 11) / float(1 << 53)
    keep = F.lit(False)
    for name in languages:
        keep = keep | ((F.col("lang") == name) & (place < min(1.0, share / counts[name])))

    got = _sampled(rows.where(keep)).toArrow().sort_by([("mark", "ascending"), ("lang", "ascending")])
    return _fit(got, languages, steps)


def _sampled(rows: DataFrame) -> DataFrame:
    """mark, lang, buckets, counts of every different text and language of the rows: text, lang.

    A task leaves out what it has had before it counts anything, so copies reach the shuffle once a task.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        had: set[tuple[int, str]] = set()  # of the sampled texts
        for batch in slices(batches, 0):
            first = []
            for row, pair in enumerate(zip(batch.column(2).to_pylist(), batch.column(1).to_pylist(), strict=True)):
                if pair not in had:
                    had.add(pair)
                    first.append(row)
            if not first:
                continue
            batch = batch.take(pa.array(first))
            docs, buckets, n = trigram_counts(batch.column(0))
            values = _values(docs, n, batch.num_rows).astype(np.float32)
            bounds = pa.array(np.searchsorted(docs, np.arange(batch.num_rows + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(bounds, pa.array(x)) for x in (buckets.astype(np.int16), values)]
            yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(1), *lists], names=["mark", "lang", "buckets", "counts"])

    marked = rows.select("text", "lang", F.xxhash64("text").alias("mark"))
    return marked.mapInArrow(run, "mark long, lang string, buckets array<short>, counts array<float>").dropDuplicates(["mark", "lang"])


def _fit(got: pa.Table, languages: list[str], steps: int) -> LanguageModel:
    code = codewords(len(languages))
    number = {name: i for i, name in enumerate(languages)}
    label = np.array([number[x] for x in got["lang"].to_pylist()], dtype=np.int64)
    n, bits = len(label), code.shape[1]
    x = np.zeros((n, DIMS), dtype=np.float32)
    lists = got["buckets"].combine_chunks()
    x[np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy())), lists.values.to_numpy()] = got["counts"].combine_chunks().values.to_numpy()
    target = code[label].astype(np.float32)
    seen = np.bincount(label, minlength=len(languages))
    each = (1 / (np.maximum(seen, 1)[label] * (seen > 0).sum())).astype(np.float32)[:, None] if n else np.zeros((0, 1), np.float32)
    w, bias = np.zeros((DIMS, bits), dtype=np.float32), np.zeros(bits, dtype=np.float32)
    m, v = np.zeros((DIMS + 1, bits), np.float32), np.zeros((DIMS + 1, bits), np.float32)
    for step in range(1, steps + 1):
        margin = target * (x @ w + bias)
        slope = -target * each / (1 + np.exp(np.clip(margin, -30, 30)))
        gradient = np.vstack([x.T @ slope + 1e-6 * w, slope.sum(axis=0)])
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        move = 0.3 * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        w, bias = w - move[:-1], bias - move[-1]
    wrong = ((target * (x @ w + bias) <= 0) * each).sum(axis=0) if n else np.zeros(bits)
    bit_weights = np.maximum(1 - 2 * wrong, 0.01).astype(np.float64)
    return LanguageModel(languages, code, w.astype(np.float64), bias.astype(np.float64), bit_weights)


def identify_language(df: DataFrame, model: LanguageModel | None, key: str = "doc_id", text: str = "text", ambiguous_under: float = 0.5) -> DataFrame:
    """key, lang_pred, score, ambiguous of every row, from its whole text.

    A null text or one without a letter is `und` with score 0, as is every text if there is no model.
    Repeated rows give repeated results, an empty table none; other columns are not read.
    """
    slim = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = slim.schema["key"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            known = np.array([model is not None and has_letter(t) for t in batch.column(1).to_pylist()], dtype=bool)
            names, scores, flags = np.full(batch.num_rows, UNKNOWN, dtype=object), np.zeros(batch.num_rows), np.ones(batch.num_rows, dtype=bool)
            if known.any():
                best, score, lead = model.decode(model.margins(batch.column(1)))
                names[known] = np.array(model.languages, dtype=object)[best[known]]
                scores[known], flags[known] = score[known], lead[known] < ambiguous_under
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores), pa.array(flags)], names=[key, "lang_pred", "score", "ambiguous"])

    return slim.mapInArrow(run, f"`{key}` {kind}, lang_pred string, score double, ambiguous boolean")
