"""Aligning the tokens of two tokenizers by pointer jumping.

Both tokenizers cut the same bytes. Every token points to its farthest-right overlapping token of the other
tokenizer, if that one ends further right or, for a token of A, at the same byte; else to itself. Following
the pointers ends at the token of B that ends where a token of A ends too, the last of their group. The
pointers of all tokens of many texts are doubled at once (next = next[next]) until none changes, in steps
that are logarithmic in the length of the longest chain; the terminal token is the group's label.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.common import slices, stored

RANKS, PIECES = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
BROADCAST_BYTES = 32 << 20
COUNT_ROW_BYTES = 64  # of a pair's count in a hash relation

TEXT, DIGEST = "text", "sha256"
ALIGNED = "row long, row_key {key}, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"


class ByteTokens:
    """A: byte-level tokens of a blank and the text, by the rank file of the vocabulary.

    No special token is known to it, so their strings in a text are plain text.
    """

    def __init__(self, ranks: str):
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.coder = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.bytes: list[bytes] = [b""] * (max(table.values()) + 1)
        for token, number in table.items():
            self.bytes[number] = token

    def ids(self, text: str) -> list[int]:
        return self.coder.encode_ordinary(" " + text)


class PieceTokens:
    """B: pieces of the text, before which the tokenizer itself puts a blank."""

    def __init__(self, model: str):
        self.coder = sentencepiece.SentencePieceProcessor(model_file=model)
        size = self.coder.get_piece_size()
        self.bytes = [self._bytes(i, self.coder.id_to_piece(i)) for i in range(size)]

    def _bytes(self, number: int, piece: str) -> bytes:
        return bytes([int(piece[3:-1], 16)]) if self.coder.is_byte(number) else piece.replace("▁", " ").encode()

    def ids(self, text: str) -> list[int]:
        return self.coder.encode(text)


def terminals(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of A and of B the index of the token of B that ends its group.

    The ends increase and both reach the same last one; texts may lie one behind the other. No token is empty.
    """
    n = len(end_a)
    over_a = np.searchsorted(end_b, end_a)  # the last token of B that begins before the end of A's
    over_b = np.searchsorted(end_a, end_b)
    at = np.arange(n + len(end_b))
    follow = at.copy()
    follow[:n] = n + over_a  # it ends there or further right
    further = end_a[over_b] > end_b
    follow[n:][further] = over_b[further]
    while True:
        after = follow[follow]
        if np.array_equal(after, follow):
            return follow[:n] - n, follow[n:] - n
        follow = after



class _Writer:
    """Groups as text, `a1,a2|b1;a3|b2,b3`: every token's number with what follows it, in order."""

    def __init__(self, a: ByteTokens, b: PieceTokens):
        numbers = [[str(i) for i in range(len(t.bytes))] for t in (a, b)]
        parts = [f"{i}{mark}" for own, marks in zip(numbers, (",|", ",;"), strict=True) for mark in marks for i in own]
        self.parts = np.array(parts, dtype=object)
        n, m = map(len, numbers)
        self.within_a, self.last_a, self.within_b, self.last_b = 0, n, 2 * n, 2 * n + m

    def codes(self, a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> np.ndarray:
        """Parts of all tokens, group by group, A's before B's."""
        ends_a = np.append(group_a[1:] != group_a[:-1], True)
        ends_b = np.append(group_b[1:] != group_b[:-1], True)
        out = np.empty(len(a) + len(b), dtype=np.int64)
        # a token comes after those of its side before it and after the other side's of earlier groups
        out[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = a + np.where(ends_a, self.last_a, self.within_a)
        out[np.arange(len(b)) + np.searchsorted(group_a, group_b, side="right")] = b + np.where(ends_b, self.last_b, self.within_b)
        return out

    def text(self, codes: np.ndarray) -> str:
        return "".join(self.parts[codes].tolist())[:-1]


def _align(a: ByteTokens, b: PieceTokens, writer: _Writer, size_a: np.ndarray, size_b: np.ndarray, texts: list[str | None], digest: bool) -> dict[str, list]:
    ids_a, ids_b = [], []
    for text in texts:
        one, two = (a.ids(text), b.ids(text)) if text else ((), ())
        if text:
            whole = (" " + text).encode()
            if b"".join([a.bytes[i] for i in one]) != whole or b"".join([b.bytes[i] for i in two]) != whole:
                one, two = (), ()
        ids_a.append(one)
        ids_b.append(two)
    count_a, count_b = (np.array([len(x) for x in side], dtype=np.int64) for side in (ids_a, ids_b))
    flat_a, flat_b = (np.array([i for x in side for i in x], dtype=np.int64) for side in (ids_a, ids_b))
    first_a, first_b = (np.concatenate([[0], np.cumsum(c)]) for c in (count_a, count_b))
    group_a, group_b = terminals(np.cumsum(size_a[flat_a]), np.cumsum(size_b[flat_b])) if len(flat_a) else (flat_a, flat_b)
    last_a = np.flatnonzero(np.append(group_a[1:] != group_a[:-1], True)) if len(flat_a) else flat_a
    pair = flat_a[last_a] << 32 | flat_b[group_a[last_a]]  # of each group, the tokens that end it
    owner = np.searchsorted(first_a, last_a, side="right") - 1
    order = np.lexsort((pair, owner))
    pair, owner = pair[order], owner[order]
    new = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (owner[1:] != owner[:-1])])) if len(pair) else owner
    times = np.diff(np.append(new, len(pair)))
    pair, owner, places = pair[new], owner[new], np.bincount(owner, minlength=len(texts))
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
    codes = writer.codes(flat_a, flat_b, group_a, group_b) if len(flat_a) else flat_a
    lists = []
    for i in range(len(texts)):
        shown = writer.text(codes[first_a[i] + first_b[i] : first_a[i + 1] + first_b[i + 1]]) if count_a[i] else ""
        lists.append(hashlib.sha256(shown.encode()).hexdigest() if digest and shown else shown)
    nested = (pa.ListArray.from_arrays(pa.array(cuts), pa.array(values)) for values in (pair, times))
    return dict(zip(["n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"], [pa.array(count_a), pa.array(count_b), pa.array(places), pa.array(places), pa.array(lists, pa.string()), *nested], strict=True))


def align_tokens(
    df: DataFrame, key: str = "doc_id", text: str = "text", ranks: str | None = None, pieces: str | None = None, groups: str = TEXT
) -> DataFrame:
    """Per row: its key, n_a, n_b, n_groups, n_links, groups, and its different pairs of linked ids with their times.

    A token of A and one of B are linked if they end at the same byte; a pair is A's id times 2^32 plus B's.
    `groups` is the alignment as text, or with groups=DIGEST its SHA-256. Texts are aligned whole, many at a
    time. Null and empty texts, and those whose tokens do not join to a blank and the text again, have no
    tokens: zeros, an empty string, no pairs. Repeated rows and rows without a key are aligned one by one; an
    empty table gives no rows. Other columns are not read.
    """
    ranks = ranks or public_tokenizers.path(RANKS)
    pieces = pieces or public_tokenizers.path(PIECES)
    slim = df.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("row_key"), F.col(text).cast("string").alias("text"))
    kind = slim.schema["row_key"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = ByteTokens(ranks), PieceTokens(pieces)
        writer = _Writer(a, b)
        sizes = [np.array([len(t) for t in side.bytes], dtype=np.int64) for side in (a, b)]
        for batch in slices(batches, 2):
            found = _align(a, b, writer, *sizes, batch.column(2).to_pylist(), groups == DIGEST)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *found.values()], names=["row", "row_key", *found])

    return slim.mapInArrow(run, ALIGNED.format(key=kind)).withColumnRenamed("row_key", key)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, count, best: how many links of all rows hold a pair, and whether no other A id has more with its B id.

    Pairs are summed in every task before they are sent, so a pair that is everywhere sends one row per task.
    """
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).groupBy(F.col("p.pairs").alias("pair"))
    counts = each.agg(F.sum("p.times").alias("count"))
    # for one id of B there are at most as many rows as A has ids
    most = F.max("count").over(Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))))
    return counts.select("pair", "count", (F.col("count") == most).alias("best"))


def score_alignment(df: DataFrame, key: str = "doc_id", text: str = "text", broadcast_bytes: int = BROADCAST_BYTES, **options: str) -> DataFrame:
    """align_tokens without its pairs, and by all rows' links n_best, count_sum.

    n_best: links whose pair's count is the highest of their B id, ties included; count_sum: counts summed
    over the links. The counts are broadcast up to broadcast_bytes; more are joined by shuffling.
    """
    aligned = stored(align_tokens(df, key, text, **options), "aligned", "zstd")
    counts = stored(pair_counts(aligned), "pair-counts")
    small = counts.count() * COUNT_ROW_BYTES <= broadcast_bytes
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))
    joined = links.join(F.broadcast(counts) if small else counts.hint("merge"), "pair")
    sums = joined.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
    whole = aligned.drop("pairs", "times").join(sums, "row", "left").drop("row")

    def number(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0)).cast("long").alias(name)

    return whole.select(key, "n_a", "n_b", "n_groups", "n_links", number("n_best"), number("count_sum"), "groups")
