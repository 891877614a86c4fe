"""A deterministic sharded WARC writer, and the reader of what it wrote.

Records are ordered by key and dealt to shards whose bounds follow from a histogram of the payload
bytes over the keys, so the same table gives the same files however Spark divides it. A task sorts
its shards, writes gzip members, starts a new file when one has reached its compressed size, and
writes under a name of its own attempt. Spark's own commit decides which attempts count: their files
are listed in a manifest, renamed to their final names, and readable once the final manifest is there.
"""

from __future__ import annotations

import hashlib
import re
import urllib.parse
import zlib
from collections.abc import Iterable, Iterator
from uuid import UUID

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm.common import shuffle_partitions

SHARD_BYTES = 16 << 20  # payload bytes of a shard
ROLL_BYTES = 8 << 20  # compressed bytes after which a file ends
REVISIT_FROM = 100  # shorter payloads are always written out
DATE = "2026-01-01T00:00:00Z"
SOFTWARE = "ebbtide"
BUCKETS = 1 << 16

MANIFEST = "shard int, sequence int, temporary string, name string, records long, bytes long, sha256 string"
READ = "file string, position long, record_id string, record_type string, target_uri string, page_id long, refers_to long, payload_bytes long, payload_digest string, payload binary"


def record_id(key: int | None, digest: str, copy: int) -> str:
    """A name that follows from the key, the payload and the number among repeated rows."""
    name = hashlib.sha256(f"{key}|{digest}|{copy}".encode()).digest()[:16]
    return f"<urn:uuid:{UUID(bytes=name, version=5)}>"


def header_value(text: str) -> str:
    """A URL without line breaks, controls or blanks, so that it cannot end its header line."""
    return urllib.parse.quote(text, safe="!#$%&'()*+,/:;=?@[]~-._")


def record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in [("WARC-Type", kind), *fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """One gzip member; it holds no time and no name."""
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def page_record(key: int | None, url: str | None, payload: bytes, refers_to: int | None, copy: int) -> bytes:
    digest = hashlib.sha256(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [("WARC-Record-ID", record_id(key, digest, copy)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", header_value(url)))
    if key is not None:
        fields.append(("X-Page-Id", str(key)))
    fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(refers_to, digest, 0)),
            ("X-Refers-To-Page-Id", str(refers_to)),
        ]
    return record("revisit" if refers_to is not None else "response", fields, block)


def file_head(name: str) -> bytes:
    info = f"software: {SOFTWARE}\r\nformat: WARC File Format 1.1\r\n".encode()
    fields = [("WARC-Record-ID", record_id(None, name, 0)), ("WARC-Date", DATE), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")]
    return record("warcinfo", fields, info)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record, one gzip member at a time."""
    while data:
        inflate = zlib.decompressobj(31)
        raw = inflate.decompress(data) + inflate.flush()
        data = inflate.unused_data
        head, _, rest = raw.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        yield fields, rest[: int(fields["Content-Length"])]


def shard_bounds(sizes: DataFrame, shard_bytes: int) -> list[int]:
    """The smallest keys of all shards but the first. sizes: key, size.

    A histogram of BUCKETS key ranges; ranges that hold more than a shard are divided again.
    """
    ends = sizes.agg(F.min("key").alias("lo"), F.max("key").alias("hi")).first()
    if ends["lo"] is None:
        return []
    done: list[tuple[int, int]] = []  # first key, bytes
    todo = [(ends["lo"], ends["hi"] + 1)]
    while todo:
        low, high = todo.pop()
        width = -(-(high - low) // BUCKETS)
        part = sizes.where((F.col("key") >= low) & (F.col("key") < high))
        sums = part.groupBy(((F.col("key") - low) / width).cast("long").alias("b") if high - low < 1 << 50 else F.expr(f"(key - {low}L) div {width}L").alias("b"))
        for r in sums.agg(F.sum("size").alias("size")).collect():
            first = low + r["b"] * width
            if r["size"] > shard_bytes and width > 1:
                todo.append((first, first + width))
            else:
                done.append((first, r["size"]))
    bounds, held = [], 0
    for first, size in sorted(done):
        if held and held + size > shard_bytes:
            bounds.append(first)
            held = 0
        held += size
    return bounds


class ShardWriter:
    """Files of one shard, under the temporary names of one attempt."""

    def __init__(self, store: fs.FileSystem, root: str, shard: int, attempt: str, roll_bytes: int):
        self.store, self.root, self.shard, self.attempt, self.roll_bytes = store, root, shard, attempt, roll_bytes
        self.sequence, self.out, self.rows = 0, None, []
        store.create_dir(f"{root}/_temporary/{attempt}")

    def add(self, data: bytes) -> None:
        if self.out is not None and self.size >= self.roll_bytes:
            self.close()
        if self.out is None:
            self.name = f"part-{self.shard:06d}-{self.sequence:05d}.warc.gz"
            self.path = f"{self.root}/_temporary/{self.attempt}/{self.name}"
            self.out, self.size, self.records, self.hash = self.store.open_output_stream(self.path, compression=None), 0, 0, hashlib.sha256()
            self._write(member(file_head(self.name)))
        self._write(member(data))
        self.records += 1

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.hash.update(data)
        self.size += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.rows.append((self.shard, self.sequence, self.path, self.name, self.records, self.size, self.hash.hexdigest()))
            self.sequence, self.out = self.sequence + 1, None


def first_pages(pages: DataFrame, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """key, digest, refers_to of the pages whose payload an earlier page has; pages: key, payload."""
    digests = pages.select("key", F.sha2(F.col("payload"), 256).alias("digest"), F.length("payload").alias("size"))
    digests = digests.where((F.col("size") >= revisit_from) & F.col("key").isNotNull())
    firsts = digests.groupBy("digest").agg(F.min("key").alias("refers_to"), F.max("key").alias("last"))
    firsts = firsts.where("last > refers_to").select("digest", "refers_to")
    return digests.join(firsts, "digest").where("key > refers_to").select("key", "digest", "refers_to")


def write_warc(
    df: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    shard_bytes: int = SHARD_BYTES,
    roll_bytes: int = ROLL_BYTES,
    revisit_from: int = REVISIT_FROM,
) -> DataFrame:
    """Write a record per row under path; returns the manifest, also stored as path/_manifest.

    A null payload counts as empty, a null URL gets no target header, a row without a key is a
    response that no other refers to. Of repeated rows (same key and payload) the first is written as
    its page is, the others revisit it if the payload is long enough. Very long pages make their file
    end after them. An empty table gives an empty manifest. Other columns are not read.
    """
    spark = df.sparkSession
    payload = F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary")
    pages = df.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    bounds = shard_bounds(pages.select(F.coalesce("key", F.lit(0)).alias("key"), (F.length("payload") + 500).alias("size")), shard_bytes)
    links = first_pages(pages, revisit_from)
    rows = links.select("key", F.lit(0).alias("kind"), "digest", "refers_to", F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"))
    rows = rows.unionByName(pages.select("key", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("digest"), F.lit(None).cast("long").alias("refers_to"), "url", "payload"))
    firsts, count = np.array(bounds, dtype=np.int64), len(bounds) + 1

    @F.pandas_udf("int")
    def shard_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(firsts, keys.to_numpy(), side="right").astype(np.int32))

    # a task writes one shard or a run of them, one after the other
    tasks = min(count, 16 * shuffle_partitions(spark))
    dealt = rows.withColumn("shard", shard_of(F.coalesce("key", F.lit(0))))
    dealt = dealt.repartitionById(tasks, F.floor(F.col("shard").cast("long") * tasks / count).cast("int"))
    ordered = dealt.sortWithinPartitions("shard", F.coalesce("key", F.lit(0)), F.col("key").isNotNull(), "kind", "payload")

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(path)
        task = TaskContext.get()
        attempt = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        writer, here, known, seen = None, object(), {}, {}
        rows: list[tuple] = []
        for batch in batches:
            for i in range(batch.num_rows):
                shard, row_key, kind, digest, refers, address, data = (batch.column(c)[i].as_py() for c in ("shard", "key", "kind", "digest", "refers_to", "url", "payload"))
                if writer is None or writer.shard != shard:
                    if writer is not None:
                        writer.close()
                        rows += writer.rows
                    writer = ShardWriter(store, root, shard, attempt, roll_bytes)
                if row_key != here:
                    here, known, seen = row_key, {}, {}
                if kind == 0:
                    known[digest] = refers
                    continue
                mark = hashlib.sha256(data).hexdigest()
                copy = seen.get(mark, 0)
                seen[mark] = copy + 1
                refers = known.get(mark)
                if refers is None and copy and row_key is not None and len(data) >= revisit_from:
                    refers = row_key
                writer.add(page_record(row_key, address, data, refers, copy))
        if writer is not None:
            writer.close()
            rows += writer.rows
        if rows:
            types = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
            names = [c.split(" ")[0] for c in MANIFEST.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    ordered.mapInArrow(write, MANIFEST).write.parquet(f"{path}/_attempts")
    spark.read.schema(MANIFEST).parquet(f"{path}/_attempts").mapInArrow(_commit(path), MANIFEST).write.parquet(f"{path}/_manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/_manifest")


def _commit(path: str):
    def rename(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(path)
        for batch in batches:
            for temporary, name in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                # a task that is run again finds its files renamed
                if store.get_file_info(temporary).type != fs.FileType.NotFound:
                    store.move(temporary, f"{root}/{name}")
                elif store.get_file_info(f"{root}/{name}").type == fs.FileType.NotFound:
                    raise FileNotFoundError(temporary)
            yield batch

    return rename


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every page record of a committed archive, in the READ schema.

    Payload sizes and digests of responses are taken from the payload itself, and a payload that
    does not fit its header's digest raises ValueError; revisits have them in their headers. A file
    of another size than in the manifest raises, too.
    """
    manifest = spark.read.schema(MANIFEST).parquet(f"{path}/_manifest").select("name", "bytes")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(path)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    listed = files.join(manifest, "name").select("name", "bytes", "content")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name, size, content = batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), batch.column(2)[i].as_py()
                if len(content) != size:
                    raise ValueError(f"{name} holds {len(content)} bytes, its manifest says {size}")
                yield from _records(name, content)

    return listed.mapInArrow(read, READ)


READ_NAMES = [c.split(" ")[0] for c in READ.split(", ")]
READ_TYPES = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]


def _records(name: str, content: bytes) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), READ_TYPES, strict=True)], names=READ_NAMES)

    for position, (fields, block) in enumerate(parse(content)):
        kind = fields["WARC-Type"]
        if kind == "warcinfo":
            continue
        http, _, payload = block.partition(b"\r\n\r\n")
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
        if kind == "response":
            size = len(payload)
            if hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"{name}, record {position}: the payload does not fit its digest")
        else:
            size, payload = int(re.search(rb"Content-Length: (\d+)", http)[1]), None
        number = lambda field: int(fields[field]) if field in fields else None
        rows.append((name, position, fields["WARC-Record-ID"], kind, fields.get("WARC-Target-URI"), number("X-Page-Id"), number("X-Refers-To-Page-Id"), size, digest, payload))
        held += len(payload or b"")
        if held > 4 << 20:
            yield batch()
            rows, held = [], 0
    if rows:
        yield batch()
