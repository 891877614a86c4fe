"""WARC files, shards, URL verdicts and packed windows."""

from __future__ import annotations

import hashlib
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import tokenizers
from pyspark.sql import functions as F

from corpora import no_docs, odd_docs, odd_texts  # noqa: F401
from ebbtide.llm import kd_sharding, packing, url_filter, warc

PAGES = "page_id long, url string, html string, key string, shard string"


def pages(spark):
    big, other = "<p>" + "shared text " * 30, "<p>" + "another page " * 5000
    rows = [(i, f"http://a.example/{i}?q=1 2", big if i % 3 == 0 else f"<p>{i} " + "x" * i * 40, "k", "s") for i in range(60)]
    rows += [(60, None, None, None, None), (61, "", "", None, None), (62, "http://x/\r\nEvil: 1", "short", None, None), (63, "é", "short", None, None), (64, "u", other, None, None), (65, "u", other, None, None)]
    rows += [rows[64], rows[1], (None, "n", big, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, PAGES), rows


def files(path):
    return {f.name: hashlib.sha256(f.read_bytes()).hexdigest() for f in Path(path).glob("*.warc.gz")}


def test_round_trip_and_equal_files(spark, tmp_path):
    df, rows = pages(spark)
    manifests = []
    for n, parts in enumerate((1, 7)):
        manifest = warc.write_warc(df.repartition(parts), str(tmp_path / str(n)), shard_bytes=20_000, roll_bytes=700)
        manifests.append({r["name"]: r["sha256"] for r in manifest.collect()})
    assert manifests[0] == manifests[1] == files(tmp_path / "0") == files(tmp_path / "1") and len(manifests[0]) > 10
    assert not list((tmp_path / "0" / "_temporary").rglob("*.warc.gz"))
    got = warc.read_warc(spark, str(tmp_path / "0")).collect()
    assert len(got) == len(rows) and len({r["record_id"] for r in got if r["page_id"] is not None}) == len(rows) - 2
    firsts = {}
    for page, _, html, *_ in rows:
        if page is not None:
            firsts[html] = min(page, firsts.get(html, page))
    texts = {p: h or "" for p, _, h, *_ in rows if p is not None}
    seen = set()
    for r in sorted(got, key=lambda r: (r["file"], r["position"])):
        page = r["page_id"]
        if page is None:
            assert r["record_type"] == "response"
            continue
        payload = texts[page].encode()
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), hashlib.sha256(payload).hexdigest())
        repeat = len(payload) >= 100 and (page != firsts[texts[page]] or page in seen)
        assert (r["record_type"], r["refers_to"]) == (("revisit", firsts[texts[page]]) if repeat else ("response", None))
        assert r["payload"] == (None if repeat else payload)
        seen.add(page)
    assert all("\r" not in (r["target_uri"] or "") and "\n" not in (r["target_uri"] or "") for r in got)


def test_no_pages(spark, tmp_path):
    assert warc.write_warc(spark.createDataFrame([], PAGES), str(tmp_path / "w")).count() == 0
    assert warc.read_warc(spark, str(tmp_path / "w")).count() == 0


def test_a_damaged_file_is_not_read(spark, tmp_path):
    import pytest

    df, _ = pages(spark)
    warc.write_warc(df, str(tmp_path / "w"))
    file = next((tmp_path / "w").glob("*.warc.gz"))
    file.write_bytes(file.read_bytes()[:-10])
    with pytest.raises(Exception, match="manifest"):
        warc.read_warc(spark, str(tmp_path / "w")).count()


def test_bounds_of_crowded_keys(spark):
    sizes = spark.createDataFrame([(i, 10) for i in range(1000)] + [(10**15 + i, 10) for i in range(1000)] + [(-(10**17), 10)], "key long, size long")
    bounds = [-(10**18), *warc.shard_bounds(sizes, 1000), 10**18]
    keys = [r["key"] for r in sizes.collect()]
    counts = [sum(a <= k < b for k in keys) for a, b in zip(bounds, bounds[1:], strict=False)]
    assert sum(counts) == 2001 and max(counts) <= 101 and len(counts) <= 25


def test_shards_are_even_and_slots_gapless(spark, odd_docs, no_docs):
    many = spark.range(3000).select("id", F.repeat(F.lit("ab"), (F.col("id") % 97).cast("int")).alias("text"), F.lit("one source").alias("source"), (F.col("id") % 2).alias("n_chars"))
    placed = kd_sharding.shard_by_kd_tree(many, 24, key="id", numbers=("n_chars",)).collect()
    total = sum(r["size"] for r in placed)
    sums = [sum(r["size"] for r in placed if r["shard"] == s) for s in range(24)]
    assert max(sums) < 1.02 * total / 24 and min(sums) > 0.98 * total / 24
    for df, shards in ((odd_docs, 5), (odd_docs, 1)):
        rows = kd_sharding.shard_by_kd_tree(df, shards).collect()
        assert len(rows) == df.count()
        texts = {r["doc_id"]: r["text"] or "" for r in df.collect()}
        for r in rows:
            raw = texts[r["doc_id"]].encode()
            assert r["size"] == len(raw) + 8 and r["text_crc32"] == zlib.crc32(raw) and 0 <= r["shard"] < shards
        for s in range(shards):
            slots = sorted(r["slot"] for r in rows if r["shard"] == s)
            assert slots == list(range(len(slots)))
    assert kd_sharding.shard_by_kd_tree(no_docs, 24).count() == 0


def test_urls(spark):
    policy = url_filter.UrlPolicy((url_filter.Rule("allow", "org", "/"), url_filter.Rule("block", "example.org", "/es/")), strict=("casino",), soft=("bet", "bonus"))
    want = {
        "http://a.example.org/es/1": ("a.example.org", "/es/1", "example.org/es/", "block"),
        "http://A.Example.ORG/casino": ("a.example.org", "/casino", "org/", "allow"),
        "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "http://x.com/casino": ("x.com", "/casino", None, "block"),
        "http://x.com/casinos/betting": ("x.com", "/casinos/betting", None, "allow"),
        "http://x.com/bet?bet=bet": ("x.com", "/bet", None, "allow"),
        "http://x.com/BET/bonus#a": ("x.com", "/BET/bonus", None, "block"),
        "http://org": ("org", "", None, "allow"),
        "casino-bet": ("", "", None, "block"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://x.com/" + "a" * 100_000 + "/casino": ("x.com", "/" + "a" * 100_000 + "/casino", None, "block"),
    }
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(want)] + [(None, None, None)], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge_urls(df, policy).collect()}
    assert got.pop(None) == want[None]
    assert list(got[i] for i in range(len(want))) == list(want.values())
    assert url_filter.judge_urls(df.limit(0), policy).count() == 0


def test_windows_hold_every_id_once(spark, odd_docs, odd_texts, no_docs):
    slow = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {**odd_texts, None: "no key but a text", 99: "text with <|endoftext|> inside"}
    df = odd_docs.unionByName(spark.createDataFrame([(99, texts[99], *[None] * 7)], odd_docs.schema))
    rows = packing.pack(df, open_windows=4).collect()
    pieces, windows = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        windows.setdefault(r["sequence_id"], []).append(r)
    for doc, text in texts.items():
        want = [*slow.encode(text or "", add_special_tokens=False).ids, 0]
        times = 2 if doc == 3 else 1
        own = sorted(pieces.pop(doc), key=lambda r: r["start"])
        assert sum(r["length"] for r in own) == times * len(want) and all(r["doc_tokens"] == len(want) for r in own)
        for r in own:
            assert np.frombuffer(r["ids"], "<u4").tolist() == want[r["start"] : r["start"] + r["length"]]
    assert not pieces
    for held in windows.values():
        at = 0
        for r in sorted(held, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= packing.WINDOW
    assert packing.pack(no_docs).count() == 0


def test_fast_ids_are_the_slow_ones():
    encoder = packing.Encoder(public_tokenizers.path(packing.VOCABULARY), public_tokenizers.path(packing.RANKS))
    for text in ("it's  we'll\n\n x", "été 数据 \U0001f600‍", "  lead and tail  ", "\t\r\n", "a" * 3000, "1234567890 ١٢٣", "  x", "I'M DON'T"):
        assert encoder.ids(text).tolist() == encoder.slow.encode(text, add_special_tokens=False).ids
