"""Signature trees, components and the grid order join against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from corpora import no_docs, odd_docs, odd_texts, prose, variant  # noqa: F401
from ebbtide.llm import grid_order_join, signature_tree
from ebbtide.llm.common import in_order
from ebbtide.llm.components import components


def of(df):
    return {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in df.collect()}


def test_components_of_odd_texts(odd_docs, odd_texts):
    want = brute.near(odd_texts)
    got = of(signature_tree.near_documents(odd_docs))
    assert got.pop((None, 1)) is None
    assert got == {(i, len(brute.shingles(t))): want[i] for i, t in odd_texts.items()}


def test_an_empty_table_has_no_components(no_docs):
    assert signature_tree.near_documents(no_docs).count() == 0


@pytest.mark.parametrize("block", [4, 256])
def test_large_groups_over_several_blocks(spark, monkeypatch, block):
    """Chains of variants, copies, and a line in all texts; small blocks make every root span several."""
    monkeypatch.setattr(signature_tree, "BLOCK", block)
    texts = {}
    for g in range(6):
        base = prose(1000 + g, 120 + 30 * g)
        for v in range(12):
            texts[len(texts)] = base if v < 3 else variant(base, 25 + v * 3)
    draw = random.Random(3)
    for g in range(4):  # each like the one before, but not like the first
        w = prose(2000 + g, 150).split()
        for _ in range(8):
            w[draw.randrange(150)] = f"new{draw.random()}"
            w[draw.randrange(150)] = f"new{draw.random()}"
            texts[len(texts)] = " ".join(w)
    texts = {i: t + " one line that stands below every text here" for i, t in texts.items()}
    df = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string").repartition(5)
    assert {i: c for (i, _), c in of(signature_tree.near_documents(df)).items()} == brute.near(texts)


@pytest.fixture
def many_ranges(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "48")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


def test_a_task_has_one_range_of_the_order(spark, many_ranges):
    rows = spark.range(48_000).selectExpr("id % 997 AS root", "id AS doc").repartition(6)
    order = in_order(rows, 48_000, 8_000, "root", "doc")
    ends = order.groupBy(F.spark_partition_id().alias("task")).agg(F.min(F.struct("root", "doc")).alias("lo"), F.max(F.struct("root", "doc")).alias("hi"))
    ends = sorted((tuple(r["lo"]), tuple(r["hi"])) for r in ends.collect())
    assert 1 < len(ends) <= 6
    assert all(hi < lo for (_, hi), (lo, _) in zip(ends, ends[1:]))


def test_traversal_keeps_every_similar_pair():
    draw = np.random.default_rng(5)
    sets = [np.unique(draw.integers(0, 2**63, 60).astype(np.uint64)) for _ in range(30)]
    for s in list(sets):
        other = s.copy()
        other[:3] = draw.integers(0, 2**63, 3).astype(np.uint64)
        sets.append(np.unique(other))
    maps = np.frombuffer(b"".join(map(signature_tree.bitmap, sets)), dtype=np.uint64).reshape(len(sets), -1)
    tree = signature_tree.Tree.over(maps, np.array([len(s) for s in sets]))
    met = set(zip(*(x.tolist() for x in signature_tree.meet(tree, tree, True, 80)), strict=True))
    alike = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if signature_tree.similar(sets[i], sets[j], 80)}
    assert len(alike) >= 30 and alike <= met and len(met) < 200


def test_one_document_of_each_group_stays(odd_docs, odd_texts, no_docs):
    kept = signature_tree.drop_near_documents(odd_docs)
    want = brute.near(odd_texts)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id IS NOT NULL").collect()) == sorted(i for i in odd_texts if want[i] == i)
    assert kept.where("doc_id IS NULL").count() == 1
    assert signature_tree.drop_near_documents(no_docs).count() == 0


def test_components_of_chains_stars_and_nothing(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(100)] + [(5, 5), (7, None)]
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    got = {r["node"]: r["component"] for r in components(df).collect()}
    want = brute.groups({x for p in links for x in p if x is not None}, [p for p in links if None not in p and p[0] != p[1]])
    assert got == {n: c for n, c in want.items()}
    assert components(df.limit(0)).count() == 0


def vectors():
    draw = np.random.default_rng(1)
    rows = []
    for label in (0, 1, None):
        centre = draw.normal(size=12)
        for i in range(60):
            v = centre + draw.normal(size=12) * (0.02 if i < 25 else 0.12 if i < 45 else 3)
            rows.append([v.astype(np.float32).tolist(), label])
        rows += [[rows[-1][0], label], [(np.array(rows[-2][0]) * 2).tolist(), label]]
    rows += [[None, 0], [[], 0], [[0.0] * 12, 0], [[float("nan")] + [1.0] * 11, 0], [[None] + [1.0] * 11, 0], [[float("inf")] * 12, 1], [[1.0, 2.0], 0], [[2.0, 4.0], 0]]
    return [(i, v, label, "x") for i, (v, label) in enumerate(rows)]


@pytest.mark.parametrize("block", [5, 1024])
def test_links_of_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(grid_order_join, "BLOCK_ROWS", block)
    rows = vectors()
    rows.append(rows[0])  # repeated: a second row with the same key
    df = spark.createDataFrame([*rows, (None, rows[0][1], 0, "x")], "vec_id long, embedding array<float>, label int, id string").repartition(4)
    usable = [(i, np.array(v, dtype=np.float64), label) for i, v, label, _ in rows if label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links, count = [], {i: 0 for i, *_ in rows}
    for i, a, la in usable:
        met = [j for j, b, lb in usable if la == lb and len(a) == len(b) and a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= 0.98]
        links += [(i, j) for j in met]
        count[i] = len(met) - 1
    want = brute.groups({i for i, *_ in rows}, links)
    got = grid_order_join.near_vectors(df).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        if r["vec_id"] is None:
            assert r["n_links"] == 0 and r["component_id"] is None and r["kept"]
        else:
            assert (r["n_links"], r["component_id"], r["kept"]) == (count[r["vec_id"]], want[r["vec_id"]], want[r["vec_id"]] == r["vec_id"]), r
    assert grid_order_join.near_vectors(df.limit(0)).count() == 0
