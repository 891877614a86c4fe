"""N-gram Jaccard join by signature trees.

A document is the set of its shingles. Its signature is a bitmap in which every shingle sets one bit,
and the size of the set. A node of a signature tree holds the OR of its documents' bitmaps, the range
of their sizes, and the most shingles any of them has beyond its bits; these bound the overlap of any
document below one node with any below another. Two trees (or one with itself) are traversed together
and a pair of nodes is left as soon as the bound is too small for the threshold.

One tree over a corpus cannot prune: the OR of a few hundred documents has all bits set. So each
shingle that could make two documents alike is the root of a tree: with shingles in a fixed order,
two sets of the wanted similarity share one among the first |x| - ceil(t |x|) + 1 of each (their
prefixes). The order puts shingles that are frequent in a sample last, so few roots have many
documents; it changes the work, not the result.

First only each document's first shingle is a root, and documents with the same root are compared
by their sets. This finds most links. Then all prefix shingles are roots, but only those under which
different components meet, and only pairs of different components are compared, first one pair per
document, in the end all; what passes the bitmaps is checked by the sets. The components are therefore those of all links, though copies and
near copies in large groups are not compared all with all.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.block_tree import block_pairs, with_payloads
from ebbtide.llm.common import beside, discard, in_order, only_keys, slices, stored, without_keys
from ebbtide.llm.components import Union, components
from ebbtide.llm.words import shingle_sets, text_bytes, words_of

SHINGLE = 5
PERCENT = 80  # least similarity
BITS = 2048
COARSE = 8  # 64-bit words of a block's bitmap, the document's folded
FAN = 8
BLOCK = 256
ORDER_SAMPLE = 20_000  # documents looked at for frequent shingles
FREQUENT_FROM = 4  # documents of the sample

SET_ROWS = 5_000  # rows with sets that a task may hold the blocks of
MAP_ROWS = 20_000  # rows with bitmaps
ROOT_ROWS = 500_000  # rows of a root and a document
ROWS_AT_ONCE = 128  # of an Arrow batch, as Python objects
PAIRS_AT_ONCE = 8_192  # pairs of bitmaps that are compared at once

WORDS = BITS // 64


@dataclass
class Tree:
    """Levels from the documents up to one node: bitmaps, size ranges, shingles beyond the bits."""

    maps: list[np.ndarray]
    low: list[np.ndarray]
    high: list[np.ndarray]
    slack: list[np.ndarray]

    @classmethod
    def over(cls, maps: np.ndarray, sizes: np.ndarray) -> Tree:
        tree = cls([maps], [sizes], [sizes], [sizes - np.bitwise_count(maps).sum(axis=1).astype(np.int64)])
        while len(tree.maps[-1]) > 1:
            starts = np.arange(0, len(tree.maps[-1]), FAN)
            tree.maps.append(np.bitwise_or.reduceat(tree.maps[-1], starts, axis=0))
            tree.low.append(np.minimum.reduceat(tree.low[-1], starts))
            tree.high.append(np.maximum.reduceat(tree.high[-1], starts))
            tree.slack.append(np.maximum.reduceat(tree.slack[-1], starts))
        return tree

    def rise(self, depth: int) -> Tree:
        """The same tree with single nodes above until it has so many levels."""
        more = depth - len(self.maps)
        return self if more <= 0 else Tree(*[levels + [levels[-1]] * more for levels in (self.maps, self.low, self.high, self.slack)])


def meet(a: Tree, b: Tree, same: bool, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of both trees whose signatures allow the similarity, by dual traversal."""
    depth = max(len(a.maps), len(b.maps))
    a, b = a.rise(depth), b.rise(depth)
    i, j = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
    for level in range(depth - 1, -1, -1):
        common = _common_bits(a.maps[level], b.maps[level], i, j)
        low_a, low_b, high_a, high_b = a.low[level][i], b.low[level][j], a.high[level][i], b.high[level][j]
        most = np.minimum(np.minimum(high_a, high_b), common + np.minimum(a.slack[level][i], b.slack[level][j]))
        keep = (most * (100 + percent) >= percent * (low_a + low_b)) & (100 * high_a >= percent * low_b) & (100 * high_b >= percent * low_a)
        i, j = i[keep], j[keep]
        if level == 0 or not len(i):
            break
        i, j = _children(i, len(a.maps[level]), len(a.maps[level - 1])), _children(j, len(b.maps[level]), len(b.maps[level - 1]))
        i, j = np.repeat(i, j.shape[1], axis=1).ravel(), np.tile(j, (1, i.shape[1])).ravel()
        keep = (i >= 0) & (j >= 0) & ((i <= j) if same else True)
        i, j = i[keep], j[keep]
    if same:
        i, j = i[i != j], j[i != j]
    return i, j


def _common_bits(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Bits that a[i] and b[j] share, pair by pair."""
    out = np.empty(len(i), dtype=np.int64)
    for at in range(0, len(i), PAIRS_AT_ONCE):
        own = slice(at, at + PAIRS_AT_ONCE)
        out[own] = np.bitwise_count(a[i[own]] & b[j[own]]).sum(axis=1)
    return out


def _children(nodes: np.ndarray, above: int, below: int) -> np.ndarray:
    """Numbers of each node's children, -1 where there is none."""
    if above == below:
        return nodes[:, None]
    out = nodes[:, None] * FAN + np.arange(FAN)
    out[out >= below] = -1
    return out


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def prefix_length(size: int, percent: int) -> int:
    return size - -(-size * percent // 100) + 1


def bitmap(numbers: np.ndarray, size: int = BITS) -> bytes:
    """A power of two of bits; the lower half and the upper half of a longer one make the shorter."""
    bits = np.zeros(size, dtype=bool)
    bits[(numbers >> np.uint64(20)).astype(np.int64) & (size - 1)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def wide_bitmap(numbers: np.ndarray) -> bytes:
    """Two bits or more for every shingle, so that long documents are told apart, too."""
    return bitmap(numbers, max(BITS, 1 << int(2 * len(numbers) - 1).bit_length()))


def wide_maps_allow(x: bytes, y: bytes, size_x: int, size_y: int, percent: int) -> bool:
    a, b = (np.frombuffer(m, dtype=np.uint64) for m in (x, y))
    while len(a) != len(b):
        if len(a) < len(b):
            b = b[: len(b) // 2] | b[len(b) // 2 :]
        else:
            a = a[: len(a) // 2] | a[len(a) // 2 :]
    common, own_a, own_b = (int(np.bitwise_count(m).sum()) for m in (a & b, a, b))
    most = min(size_x, size_y, common + min(size_x - own_a, size_y - own_b))
    return most * (100 + percent) >= percent * (size_x + size_y)


def frequent_shingles(df: DataFrame, text: str, shingle: int, sample: int = ORDER_SAMPLE) -> np.ndarray:
    """Shingles of at least FREQUENT_FROM documents of a sample by a hash of the text, sorted."""
    total = df.count()
    place = F.shiftrightunsigned(F.xxhash64(text, F.lit(5)), 11) / float(1 << 53)
    few = df.select(F.col(text).alias("text")).where(place < min(1.0, sample / max(total, 1))).distinct()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            sets = list(shingle_sets(words_of(*text_bytes(batch.column(0))), shingle))
            numbers, counts = np.unique(np.concatenate(sets), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(numbers.view(np.int64)), pa.array(counts.astype(np.int32))], names=["s", "n"])

    counts = few.mapInArrow(run, "s long, n int").groupBy("s").agg(F.sum("n").alias("n"))
    return np.sort(counts.where(F.col("n") >= FREQUENT_FROM).select("s").toArrow()["s"].to_numpy().astype(np.int64).view(np.uint64))


def sketch(df: DataFrame, key: str, text: str, shingle: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """doc, n, class marks s1 and s2, bitmap and prefix of every row, from its whole text."""
    slim = df.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            sizes, s1, s2, maps, prefixes = [], [], [], [], []
            for numbers in shingle_sets(words_of(*text_bytes(batch.column(1))), shingle):
                sizes.append(len(numbers))
                s1.append(int(numbers.sum(dtype=np.uint64).view(np.int64)) if len(numbers) else 0)
                s2.append(int(np.bitwise_xor.reduce(numbers * np.uint64(0x9E3779B97F4A7C15) ^ numbers >> np.uint64(29)).view(np.int64)) if len(numbers) else 0)
                maps.append(bitmap(numbers))
                length = prefix_length(len(numbers), percent) if len(numbers) else 0
                prefixes.append(_ordered(numbers, frequent)[:length].view(np.int64))
            bounds = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(prefixes)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()), pa.array(maps, pa.binary()), lists], names=["doc", "n", "s1", "s2", "map", "prefix"])

    return slim.mapInArrow(run, "doc long, n long, s1 long, s2 long, map binary, prefix array<long>")


def _ordered(numbers: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """A sorted set in the order of the prefixes: frequent shingles last."""
    if not len(frequent) or not len(numbers):
        return numbers
    late = frequent[np.minimum(np.searchsorted(frequent, numbers), len(frequent) - 1)] == numbers
    return np.concatenate([numbers[~late], numbers[late]])


def _sets(df: DataFrame, key: str, text: str, wanted: DataFrame, shingle: int, frequent: np.ndarray) -> DataFrame:
    """root (the first shingle), doc, n, map, sorted set and wide map of the wanted documents (a stored column doc)."""
    slim = df.select(F.col(key).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            docs, rows = batch.column(0).to_pylist(), []
            for doc, numbers in zip(docs, shingle_sets(words_of(*text_bytes(batch.column(1))), shingle), strict=True):
                if len(numbers):
                    rows.append((int(_ordered(numbers, frequent)[0].view(np.int64)), doc, len(numbers), bitmap(numbers), numbers.tobytes(), wide_bitmap(numbers)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate([*ROW_TYPES, pa.binary()])], names=[*LINK_NAMES[2:], "wide"])

    return only_keys(slim, wanted, "doc").mapInArrow(run, "root long, doc long, n long, map binary, shingles binary, wide binary")


def _runs(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[tuple[int, list[tuple], bool]]:
    """Rows in order of their root as blocks of one root; True if the root may have more blocks."""
    held, root, first, opened = [], None, True, False
    parts = (batch.slice(at, ROWS_AT_ONCE) for batch in batches for at in range(0, batch.num_rows, ROWS_AT_ONCE))
    for part in parts:
        for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
            if held and row[0] != root:
                yield root, held, opened or first
                held, opened, first = [], False, False
            elif len(held) == most:
                yield root, held, True
                held, opened = [], True
            root = row[0]
            held.append(row)
    if held:
        yield root, held, True  # the next partition may go on with it


def _maps(rows: list[tuple], place: int) -> np.ndarray:
    return np.frombuffer(b"".join(r[place] for r in rows), dtype=np.uint64).reshape(len(rows), WORDS)


def _first_links(percent: int):
    """Links between documents of one root, by their sets; and one document of each group of a root
    that has more blocks, to be compared with the other blocks'."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for root, rows, more in _runs(batches, BLOCK):
            union, links = Union(), []
            if len(rows) > 1:
                tree = Tree.over(_maps(rows, 3), np.array([r[2] for r in rows], dtype=np.int64))
                sets = [np.frombuffer(r[4], dtype=np.uint64) for r in rows]
                for i, j in zip(*(x.tolist() for x in meet(tree, tree, True, percent)), strict=True):
                    if union.find(i) != union.find(j) and similar(sets[i], sets[j], percent):
                        union.join(i, j)
                        links.append((rows[i][1], rows[j][1]))
            if links:
                yield _links_batch(links)
            if more:
                left = [r for i, r in enumerate(rows) if union.find(i) == i]
                yield pa.RecordBatch.from_arrays([pa.nulls(len(left), pa.int64())] * 2 + [pa.array([r[c] for r in left], t) for c, t in enumerate(ROW_TYPES)], names=LINK_NAMES)

    return run


ROW_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
LINK_NAMES = ["a", "b", "root", "doc", "n", "map", "shingles"]
LINK = "a long, b long, root long, doc long, n long, map binary, shingles binary"


def _links_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    ends = [pa.array([p[i] for p in links], pa.int64()) for i in (0, 1)]
    return pa.RecordBatch.from_arrays([*ends, *[pa.nulls(len(links), t) for t in ROW_TYPES]], names=LINK_NAMES)


def _several(rows: DataFrame, column: str) -> DataFrame:
    """Roots under which the column takes more than one value."""
    ends = rows.groupBy("root").agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    return ends.where("lo < hi").select("root")


def _by_first_shingle(df: DataFrame, key: str, text: str, classes: DataFrame, shingle: int, percent: int, frequent: np.ndarray) -> DataFrame:
    roots = classes.select(F.col("prefix")[0].alias("root"), "doc")
    wanted = stored(roots.join(_several(roots, "doc"), "root", "left_semi").select("doc"), "rooted")
    rows, count = _sets(df, key, text, wanted, shingle, frequent).drop("wide"), wanted.count()
    found, left = None, None
    while True:
        order = in_order(rows, count, SET_ROWS, "root", "n", "doc")
        out = stored(order.mapInArrow(_first_links(percent), LINK), "first-links")
        links = out.where("a IS NOT NULL").select("a", "b")
        found = links if found is None else found.unionByName(links)
        rest = out.where("root IS NOT NULL").select("root", "doc", "n", "map", "shingles")
        rest = rest.join(_several(rest, "doc"), "root", "left_semi")
        before, rest = (rows if left is not None else wanted), stored(rest, "first-left")
        discard(before)
        count = rest.count()
        # groups that do not shrink are left to the second step
        if count == 0 or (left is not None and 2 * count > left):
            return found
        rows, left = rest, count


def _meeting(percent: int):
    """Of rows root, doc, shift, mark in order of their root, those that can have a link under it.

    shift is the component less the document; mark is twice the size, and one more if the root is
    among the document's first |x| - ceil(2t / (1 + t) |x|) + 1 shingles: of two similar sets that
    share a root, that holds for the smaller one and some root. Roots with few documents are looked at
    pair by pair; a root with more is passed on if it has different components or goes on elsewhere.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, ...] | None = None
        going_on = None  # the root of the first rows, or one of which rows were passed on

        def out(columns: tuple[np.ndarray, ...], last: bool) -> Iterator[pa.RecordBatch]:
            root, doc, shift, mark = columns
            if not len(root):
                return
            component = doc + shift
            starts = np.flatnonzero(np.concatenate([[True], root[1:] != root[:-1]]))
            lengths = np.diff(np.append(starts, len(root)))
            open_ = root == going_on
            if last:
                open_ |= root == root[-1]
            large = np.repeat((lengths > FAN) & (np.minimum.reduceat(component, starts) < np.maximum.reduceat(component, starts)), lengths)
            keep = open_ | large
            for step in range(1, FAN):
                i = np.flatnonzero(root[step:] == root[:-step])
                if not len(i):
                    break
                i = i[_sizes_allow(mark[i], mark[i + step], percent) & (component[i] != component[i + step])]
                small = np.repeat(lengths <= FAN, lengths)[i]
                keep[i[small]] = keep[i[small] + step] = True
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], names=["root", "doc", "shift", "mark"])

        for batch in batches:
            if not batch.num_rows:
                continue
            new = tuple(c.to_numpy() for c in batch.columns)
            columns = new if held is None else tuple(np.concatenate(x) for x in zip(held, new, strict=True))
            if going_on is None:
                going_on = columns[0][0]
            tail = int(np.searchsorted(columns[0], columns[0][-1]))
            if len(columns[0]) - tail > 10_000:
                yield from out(columns, True)
                going_on, held = columns[0][-1], None
            else:
                yield from out(tuple(c[:tail] for c in columns), False)
                held = tuple(c[tail:] for c in columns)
        if held is not None:
            yield from out(held, True)

    return run


def _sizes_allow(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets with these marks that share a root there can be similar."""
    x, y = a >> 1, b >> 1
    ratio = (100 * x >= percent * y) & (100 * y >= percent * x)
    return ratio & (((a & 1) == 1) & (x <= y) | ((b & 1) == 1) & (y <= x))


def short_prefix_length(size: int, percent: int) -> int:
    return size - -(-2 * percent * size // (100 + percent)) + 1


def _roots_of_few(root: np.ndarray) -> np.ndarray:
    """Whether the rows' root has at most FAN rows, and neither begins nor ends the batch."""
    starts = np.flatnonzero(np.concatenate([[True], root[1:] != root[:-1]]))
    lengths = np.diff(np.append(starts, len(root)))
    few = lengths <= FAN
    few[[0, -1]] = False
    return np.repeat(few, lengths)


def _few_met(batch: pa.RecordBatch, percent: int, nearest: bool) -> pa.RecordBatch | None:
    """Pairs under roots that are one node with its documents: their signatures are compared at once."""
    if not batch.num_rows:
        return None
    root, doc, mark, component = (batch.column(c).to_numpy() for c in ("root", "doc", "mark", "component"))
    maps = np.frombuffer(b"".join(batch.column("map").to_pylist()), dtype=np.uint64).reshape(-1, WORDS)
    sizes = mark >> 1
    slack = sizes - np.bitwise_count(maps).sum(axis=1).astype(np.int64)
    ends = []
    for step in range(1, FAN):
        i = np.flatnonzero(root[step:] == root[:-step])
        if not len(i):
            break
        j = i + step
        keep = _sizes_allow(mark[i], mark[j], percent) & (component[i] != component[j])
        i, j = i[keep], j[keep]
        most = np.minimum(np.minimum(sizes[i], sizes[j]), _common_bits(maps, maps, i, j) + np.minimum(slack[i], slack[j]))
        near = most * (100 + percent) >= percent * (sizes[i] + sizes[j])
        ends.append((doc[i[near]], doc[j[near]]))
    if not ends:
        return None
    a, b = (np.concatenate(e) for e in zip(*ends, strict=True))
    return _met_batch(a, b, nearest) if len(a) else None


def _met_batch(x: np.ndarray, y: np.ndarray, nearest: bool) -> pa.RecordBatch:
    """Pairs as rows; with nearest, only one of each document with smaller ones."""
    a, b = np.minimum(x, y), np.maximum(x, y)
    if nearest:
        order = np.lexsort((a, b))
        first = order[np.flatnonzero(np.concatenate([[True], b[order][1:] != b[order][:-1]]))]
        a, b = a[first], b[first]
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *[pa.nulls(len(a), t) for t in BLOCK_TYPES]], names=MET_NAMES)


def _trees(percent: int, nearest: bool):
    """Rows root, doc, mark, map, component in order: pairs that may be similar and have different
    components, and blocks with their summaries of roots that have several blocks. With nearest, each
    document is paired with one smaller one of its block at most."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0

        def larger() -> Iterator[pa.RecordBatch]:
            """Rows that _few_met does not deal with; it yields the others' pairs to `met`."""
            for batch in batches:
                if batch.num_rows:
                    few = _roots_of_few(batch.column("root").to_numpy())
                    met.append(_few_met(batch.filter(pa.array(few)), percent, nearest))
                    yield batch.filter(pa.array(~few))

        met: list[pa.RecordBatch | None] = []
        for root, rows, more in _runs(larger(), BLOCK):
            yield from filter(None, met)
            met.clear()
            if len(rows) == 1 and not more:
                continue
            docs, sizes, parts = (np.array([r[c] for r in rows], dtype=np.int64) for c in (1, 2, 4))
            sizes >>= 1
            maps = _maps(rows, 3)
            if nearest or not more:
                tree = Tree.over(maps, sizes)
                i, j = meet(tree, tree, True, percent)
                apart = parts[i] != parts[j]
                if apart.any():
                    yield _met_batch(docs[i[apart]], docs[j[apart]], nearest)
            if not more:
                continue
            coarse = np.bitwise_or.reduce(maps.reshape(len(rows), -1, COARSE), axis=1)
            slack = int((sizes - np.bitwise_count(coarse).sum(axis=1)).max())
            whole = np.bitwise_or.reduce(coarse, axis=0).view(np.int64).tolist()
            row = [None, None, root, part, seq, docs.tobytes(), sizes.tobytes(), parts.tobytes(), maps.tobytes(), int(sizes.min()), int(sizes.max()), slack, int(parts.min()), int(parts.max()), *whole]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, [pa.int64(), pa.int64(), *BLOCK_TYPES], strict=True)], names=MET_NAMES)
            seq += 1
        yield from filter(None, met)

    return run


SUMMARY = ["lo_n", "hi_n", "slack", "lo_part", "hi_part", *[f"w{i}" for i in range(COARSE)]]
BLOCK_NAMES = ["root", "part", "seq", "docs", "sizes", "parts", "maps", *SUMMARY]
MET_NAMES = ["a", "b", *BLOCK_NAMES]
BLOCK_TYPES = [pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 4, *[pa.int64()] * len(SUMMARY)]
BLOCK_SCHEMA = "root long, part int, seq long, docs binary, sizes binary, parts binary, maps binary, " + ", ".join(f"{c} long" for c in SUMMARY)


def _candidates(percent: int, nearest: bool):
    """Pairs of documents of different components that the signatures of two blocks allow. With nearest,
    one pair for each component of the second of two different blocks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(at, 1).to_pylist()[0] for at in range(batch.num_rows)):
                same = (row["a_part"], row["a_seq"]) == (row["b_part"], row["b_seq"])
                sides = {s: [np.frombuffer(row[f"{s}_{c}"], dtype=np.int64) for c in ("docs", "sizes", "parts")] for s in "ab"}
                trees = [Tree.over(np.frombuffer(row[f"{s}_maps"], dtype=np.uint64).reshape(-1, WORDS), sides[s][1]) for s in "ab"]
                i, j = meet(trees[0], trees[0] if same else trees[1], same, percent)
                apart = sides["a"][2][i] != sides["b"][2][j]
                if nearest:
                    if same:
                        continue
                    first = np.unique(sides["b"][2][j[apart]], return_index=True)[1]
                    i, j, apart = i[apart][first], j[apart][first], slice(None)
                a, b = sides["a"][0][i[apart]], sides["b"][0][j[apart]]
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return run


def _by_all_prefixes(
    df: DataFrame, key: str, text: str, classes: DataFrame, parts: DataFrame, shingle: int, percent: int, frequent: np.ndarray
) -> DataFrame:
    known = _with_components(classes, parts)
    count = classes.agg(F.sum(F.size("prefix"))).first()[0] or 0
    short = F.col("n") - F.ceil(F.lit(2 * percent) * F.col("n") / (100 + percent)).cast("long") + 2  # one more, should the division round
    rooted = known.select("doc", (F.col("component") - F.col("doc")).alias("shift"), "n", short.alias("short"), F.posexplode("prefix").alias("at", "root"))
    rooted = rooted.select("root", "doc", "shift", (F.col("n") * 2 + (F.col("at") < F.col("short")).cast("long")).alias("mark"))
    order = in_order(rooted, count, ROOT_ROWS, "root", "doc")
    shared = stored(order.mapInArrow(_meeting(percent), "root long, doc long, shift long, mark long"), "shared").drop("shift")
    links = parts.select(F.col("node").alias("a"), F.col("component").alias("b"))
    # two rounds over one pair per document or component join what is left of large groups, so that the
    # last one, over all pairs, meets few that are connected anyway
    for nearest in (True, True, False):
        apart = _with_components(shared, parts)
        before, shared = shared, stored(apart.join(_several(apart, "component"), "root", "left_semi"), "shared")
        discard(before)
        rows_left = shared.count()
        if not rows_left:  # no root has two components: nothing is left to find
            return parts
        documents = stored(shared.select("doc").distinct(), "shared-documents")
        maps = only_keys(classes.select("doc", "map"), documents, "doc")
        rows = shared.join(maps, "doc").select("root", "doc", "mark", "map", "component")
        order = in_order(rows, rows_left, MAP_ROWS, "root", "mark", "doc")
        met = stored(order.mapInArrow(_trees(percent, nearest), f"a long, b long, {BLOCK_SCHEMA}"), "met")
        across = _across_blocks(met.where("root IS NOT NULL").drop("a", "b"), percent, nearest)
        found = met.where("a IS NOT NULL").select("a", "b").unionByName(across)
        found = found.groupBy("b").agg(F.min("a").alias("a")).select("a", "b") if nearest else found.distinct()
        candidates = stored(found, "candidates")
        more = _checked(df, key, text, candidates, shingle, percent, frequent)
        known_parts, parts = parts, stored(components(links.unionByName(more)), "parts")
        for done in (documents, met, candidates, more, known_parts):
            discard(done)
        links = parts.select(F.col("node").alias("a"), F.col("component").alias("b"))
        shared = shared.drop("component")
    return parts


def _with_components(rows: DataFrame, parts: DataFrame) -> DataFrame:
    wide = beside(rows, parts, rows["doc"] == parts["node"], 16)
    return wide.select(*[rows[c] for c in rows.columns], F.coalesce(parts["component"], rows["doc"]).alias("component"))


def _across_blocks(blocks: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """Pairs of roots with several blocks, from the blocks whose summaries allow one."""

    def may_join(left, right):
        common = F.lit(0).cast("long")
        for i in range(COARSE):
            common = common + F.bit_count(left(f"w{i}").bitwiseAND(right(f"w{i}")))
        most = F.least(left("hi_n"), right("hi_n"), common + F.least(left("slack"), right("slack")))
        sizes = (left("hi_n") * 100 >= right("lo_n") * percent) & (right("hi_n") * 100 >= left("lo_n") * percent)
        one = (left("lo_part") == left("hi_part")) & (right("lo_part") == right("hi_part")) & (left("lo_part") == right("lo_part"))
        return sizes & ~one & (most * (100 + percent) >= (left("lo_n") + right("lo_n")) * percent)

    merges = {"lo_n": F.min, "hi_n": F.max, "slack": F.max, "lo_part": F.min, "hi_part": F.max} | {f"w{i}": F.bit_or for i in range(COARSE)}
    pairs = with_payloads(block_pairs(blocks, merges, may_join), blocks, ["docs", "sizes", "parts", "maps"])
    return pairs.mapInArrow(_candidates(percent, nearest), "a long, b long")


def _checked(df: DataFrame, key: str, text: str, found: DataFrame, shingle: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """The pairs of documents a, b that are similar, by their sets."""
    wanted = stored(found.select(F.explode(F.array("a", "b")).alias("doc")).distinct(), "candidate-documents")
    sets = stored(_sets(df, key, text, wanted, shingle, frequent).select("doc", "n", "shingles", "wide").dropDuplicates(["doc"]), "candidate-sets")

    def keep_if(test):
        def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kept = batch.filter(pa.array([test(*(batch.column(c)[i].as_py() for c in range(2, batch.num_columns))) for i in range(batch.num_rows)], pa.bool_()))
                yield pa.RecordBatch.from_arrays(kept.columns[:2], names=["a", "b"])

        return check

    def with_both(pairs: DataFrame, *columns: str) -> DataFrame:
        for side in "ab":
            pairs = pairs.join(sets.select(F.col("doc").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in columns]), side)
        return pairs.select("a", "b", *[f"{side}_{c}" for c in columns for side in "ab"])

    def maps_allow(x: bytes, y: bytes, size_x: int, size_y: int) -> bool:
        return wide_maps_allow(x, y, size_x, size_y, percent)

    def sets_similar(x: bytes, y: bytes) -> bool:
        return similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)

    # signatures with bits enough for long documents first: they are a sixteenth of the sets or less
    near = stored(with_both(found, "wide", "n").mapInArrow(keep_if(maps_allow), "a long, b long"), "near-pairs")
    out = stored(with_both(near, "shingles").mapInArrow(keep_if(sets_similar), "a long, b long"), "more-links")
    for done in (wanted, sets, near):
        discard(done)
    return out


def near_documents(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """key, n_shingles, component_id for every row.

    Two documents are linked if their sets' similarity is at least percent / 100; components are those
    of all links. A null or empty text, or one of blanks alone, has no shingle and no link; fewer than
    `shingle` words are one shingle together. Equal sets are one class, so copies cost nothing beyond
    their own row. Rows that share a key are one document in the components; a row without a key has
    no link and no component. An empty table gives no rows; other columns are not read.
    """
    frequent = frequent_shingles(df, text, shingle)
    rows = stored(sketch(df, key, text, shingle, percent, frequent), "sketches")
    marks = ["n", "s1", "s2"]
    usable = rows.where("n > 0 AND doc IS NOT NULL")
    first = stored(usable.groupBy(*marks).agg(F.min("doc").alias("first"), F.max("doc").alias("last")), "classes")
    copies = usable.select("doc", *marks).join(first.where("first < last").select("first", *marks), marks).where("doc > first").select("doc")
    copies = stored(without_keys(copies, first.select(F.col("first").alias("doc")), "doc"), "copies")
    classes = without_keys(usable.select("doc", "n", "map", "prefix"), copies, "doc")
    links = _by_first_shingle(df, key, text, classes, shingle, percent, frequent)
    parts = stored(components(links), "parts")
    parts = _by_all_prefixes(df, key, text, classes, parts, shingle, percent, frequent)
    first = first.select(F.col("first").alias("doc"), *marks)
    # a document with several texts stands in several classes
    own = rows.select("doc", *marks).where("n > 0 AND doc IS NOT NULL").join(first.withColumnRenamed("doc", "first"), marks)
    twice = own.where("doc <> first").select(F.col("doc").alias("a"), F.col("first").alias("b"))
    several = rows.where("doc IS NOT NULL").groupBy("doc").agg(F.min("s1").alias("lo"), F.max("s1").alias("hi")).where("lo < hi").select(F.col("doc").alias("a"))
    twice = twice.join(several, "a", "left_semi")
    whole = components(parts.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(twice))
    named = first.join(whole.withColumnRenamed("node", "doc"), "doc", "left").select(*marks, F.coalesce("component", "doc").alias("component"))
    out = rows.select("doc", *marks).join(stored(named, "named"), marks, "left")
    component = F.when(F.col("doc").isNotNull(), F.coalesce(F.least("component", "doc"), F.col("doc")))
    return out.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"))


def drop_near_documents(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents, with all their columns, of which no earlier one is in the same component.

    Of rows that share a key one stays. Rows without a key all stay.
    """
    near = stored(near_documents(df, key, text, shingle, percent), "near-documents")
    gone = stored(near.where(F.col(key) != F.col("component_id")).select(key), "near-gone")
    kept = without_keys(df, gone, key)
    repeated = stored(near.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(key), "repeated")
    if not repeated.take(1):
        return kept
    return without_keys(kept, repeated, key).unionByName(only_keys(kept, repeated, key).dropDuplicates([key]).select(*df.columns))
