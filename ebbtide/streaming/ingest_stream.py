"""Folder ingest: a file stream discovers files, each micro-batch is decided as a whole.

The table is a folder of Parquet partitions, one per ingest batch, and so is the file log.
A batch writes its rows, then its log entries, then one marker in the table's folder. Only what
has a marker counts, in the table as in the log: a batch that failed before leaves nothing
behind that is seen, and a batch that is replayed after its marker does nothing.

Beside the rows lie the key range and a Bloom filter of each batch (operators.id_index), written
before its marker: a batch of files opens only the partitions that may hold one of its ids. A
partition without them, of an older table, is always opened.

A run may take several batches. Files are decided as if all were one batch, whatever number of
files a batch has: ids that the run itself has added so far are not known ids but ids of
earlier files.
"""

from __future__ import annotations

from collections.abc import Callable, Collection
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.operators import id_index
from ebbtide.operators.ingest import DONE, MISSING_COLUMNS, REJECT_FILE, ingest_batch
from ebbtide.schemas import CUSTOMER_COLUMNS, CUSTOMERS
from ebbtide.session import create_once, names_in, path_exists
from ebbtide.sources.batches import find_files, read_files

BATCH = "ingest_batch"
FIRST = "base"
MARKERS = "_committed"  # folders that readers of the table skip
INDEX = "_index"

FILE_LOG = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("unique_rows", T.LongType()),
    T.StructField("new_rows", T.LongType()),
    T.StructField("out_of_range_rows", T.LongType()),
    T.StructField("written_rows", T.LongType()),
    T.StructField("reason", T.StringType()),
    T.StructField("decided_at", T.TimestampType()),
])

BINARY_FILE = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    with_batch = T.StructType([*schema.fields, T.StructField(BATCH, T.StringType())])
    if not path_exists(spark, path):  # a table that is there but cannot be read raises
        return spark.createDataFrame([], with_batch)
    return spark.read.schema(with_batch).parquet(path)


def _write_rows(rows: DataFrame, table: str, batch: str) -> None:
    """Rows of a batch and their index. Both count once the batch does."""
    spark = rows.sparkSession
    rows.write.mode("overwrite").parquet(f"{table}/{BATCH}={batch}")
    written = spark.read.schema(rows.schema).parquet(f"{table}/{BATCH}={batch}")
    ranges, words = id_index.build(written)
    words.write.mode("overwrite").parquet(f"{table}/{INDEX}/words/{BATCH}={batch}")
    ranges.coalesce(1).write.mode("overwrite").parquet(f"{table}/{INDEX}/ranges/{BATCH}={batch}")


def create_table(customers: DataFrame, table: str) -> None:
    _write_rows(customers, table, FIRST)


def append_batch(customers: DataFrame, table: str, batch: str) -> None:
    """Add rows whose ids the table does not have, as a batch of their own."""
    _write_rows(customers.select(CUSTOMER_COLUMNS), table, batch)
    create_once(customers.sparkSession, f"{table}/{MARKERS}/{batch}")


def committed(spark: SparkSession, table: str) -> list[str]:
    """Names of the batches that count."""
    return names_in(spark, f"{table}/{MARKERS}")


def _counted(spark: SparkSession, table: str) -> DataFrame:
    """Customers of the table with their batch."""
    return _read(spark, table, CUSTOMERS).where(F.col(BATCH).isin([FIRST, *committed(spark, table)]))


def batches_for(spark: SparkSession, table: str, asked: DataFrame, batches: Collection[str]) -> list[str]:
    """Those of the batches that may hold an asked id."""
    here = F.col(BATCH).isin(list(batches))
    ranges = _read_index(spark, table, "ranges", id_index.RANGES).where(here)
    indexed = {r[BATCH] for r in ranges.select(BATCH).collect()}  # a row per batch
    found = id_index.holders(asked, ranges, _read_index(spark, table, "words", id_index.WORDS))
    return sorted({*found, *(set(batches) - indexed)})


def _read_index(spark: SparkSession, table: str, part: str, schema: T.StructType) -> DataFrame:
    path = f"{table}/{INDEX}/{part}"
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def rows_for(spark: SparkSession, table: str, batches: Collection[str]) -> Callable[[DataFrame], DataFrame]:
    """What gives the rows of the batches that may have one of the asked ids."""

    def rows(asked: DataFrame) -> DataFrame:
        return _read(spark, table, CUSTOMERS).where(F.col(BATCH).isin(batches_for(spark, table, asked, batches)))

    return rows


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return _counted(spark, table).select(CUSTOMER_COLUMNS)


def read_log(spark: SparkSession, log: str, table: str) -> DataFrame:
    """Decisions of the batches that the table counts."""
    return _read(spark, log, FILE_LOG).where(F.col(BATCH).isin(committed(spark, table)))


def latest_status(log: DataFrame) -> DataFrame:
    """The last decision about each file."""
    return log.groupBy("file_name").agg(F.max_by("status", "decided_at").alias("status"))


def ingest_files(
    spark: SparkSession,
    paths: list[str],
    table: str,
    log: str,
    batch: str,
    mode: str = REJECT_FILE,
    archive: str | None = None,
    now: datetime | None = None,
    on_rows_added: Callable[[str, int], None] | None = None,
    earlier: Collection[str] = (),
) -> DataFrame:
    """Decide about the files, append what was accepted, log it, archive files that are done.

    `earlier` names the batches of the same run before this one. A batch that counts already is
    not done again: its log entries are returned. on_rows_added is told the batch and its rows, once
    or, after a failure, again: retrain_queue.ask takes a name once.
    """
    now = now or datetime.now()
    if batch in committed(spark, table):
        logged = read_log(spark, log, table).where(F.col(BATCH) == batch).drop(BATCH)
        added = logged.agg(F.coalesce(F.sum("written_rows"), F.lit(0))).first()[0]
        if added and on_rows_added:  # the run may have broken off before it was told
            on_rows_added(batch, added)
        return logged
    before = [name for name in (FIRST, *committed(spark, table)) if name not in earlier]
    existing = rows_for(spark, table, before)
    claimed = rows_for(spark, table, list(earlier)) if earlier else None
    rows, refused = read_files(spark, paths)
    entries = [(path, MISSING_COLUMNS, 0, 0, 0, 0, reason, now) for path, reason in refused.items()]
    added, with_header = 0, set()
    if rows is not None:
        result = ingest_batch(rows, existing, mode, claimed)
        decided = result.files.collect()  # one row per file
        added = sum(f["written_rows"] for f in decided)
        with_header = {f["file_name"] for f in decided}
        entries += [(*f, None, now) for f in decided]
        if added:
            _write_rows(result.rows.select(CUSTOMER_COLUMNS), table, batch)
        result.release()
    # a file of nothing but a header has no row to be counted by
    entries += [
        (p, DONE[1], 0, 0, 0, 0, None, now) for p in paths if p not in refused and p not in with_header
    ]
    logged = spark.createDataFrame(entries, FILE_LOG)
    logged.coalesce(1).write.mode("overwrite").parquet(f"{log}/{BATCH}={batch}")
    create_once(spark, f"{table}/{MARKERS}/{batch}")
    if archive:
        done = [e[0] for e in entries if e[1] in DONE]
        archive_files(spark, done, archive, now)
    if added and on_rows_added:
        on_rows_added(batch, added)
    return logged


def archive_files(spark: SparkSession, paths: list[str], archive: str, now: datetime) -> None:
    """Move done files away, with the time in their name. The log, not the move, says what is done."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(archive)
    system = target.getFileSystem(conf)
    system.mkdirs(target)
    stamp = now.strftime("%Y%m%d_%H%M%S")
    for path in paths:
        stem, dot, suffix = path.rsplit("/", 1)[-1].rpartition(".")
        source = jvm.org.apache.hadoop.fs.Path(path)
        if system.exists(source):
            system.rename(source, jvm.org.apache.hadoop.fs.Path(target, f"{stem}_{stamp}{dot}{suffix}"))


def open_files(spark: SparkSession, folder: str, log: str, table: str) -> list[str]:
    """Files of the folder that no run is done with; a rejected file is tried again."""
    found = find_files(spark, folder)
    listed = spark.createDataFrame([(path,) for path in found], "file_name string")
    decided = latest_status(read_log(spark, log, table).join(listed, "file_name", "left_semi"))
    done = {r["file_name"] for r in decided.where(F.col("status").isin(DONE)).collect()}  # among the listed ones
    return [path for path in found if path not in done]


def ingest_folder(
    spark: SparkSession, folder: str, table: str, log: str, batch: str, max_files: int = 1000, **options
) -> DataFrame | None:
    """A run over all open files of the folder, max_files at a time; None if there are none.

    What the driver and the plans hold follows max_files, not the folder; what is decided does not. A
    run of the same name that was broken off goes on behind its last batch that counts.
    """
    paths, logged = open_files(spark, folder, log, table), None
    run = [name for name in committed(spark, table) if name.startswith(f"{batch}-")]
    tried = _tried(spark, log, table, run)
    paths = [p for p in paths if p not in tried]
    for first in range(0, len(paths), max_files):
        name = f"{batch}-{len(run):06d}"
        part = ingest_files(spark, paths[first : first + max_files], table, log, name, earlier=run, **options)
        run.append(name)
        logged = part if logged is None else logged.unionByName(part)
    return logged


def _tried(spark: SparkSession, log: str, table: str, run: list[str]) -> set[str]:
    """Files that the run has decided about, in whatever way."""
    if not run:
        return set()
    return {r["file_name"] for r in read_log(spark, log, table).where(F.col(BATCH).isin(run)).select("file_name").collect()}


def stream_folder(
    spark: SparkSession,
    folder: str,
    table: str,
    log: str,
    checkpoint: str,
    max_files: int = 1000,
    **options,
):
    """Start a run over the files that are new since the last one.

    The stream carries paths only: `content` is pruned and files are read by header in the
    micro-batch, since a streaming CSV schema would bind columns by position.
    """
    found = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("pathGlobFilter", "*.[cC][sS][vV]")
        .option("maxFilesPerTrigger", max_files)
        .load(folder)
        .select("path")
    )

    run: list[str] = []  # batches of this run

    def decide(batch: DataFrame, epoch: int) -> None:
        paths = sorted(r["path"] for r in batch.collect())  # at most max_files
        if paths:
            name = f"stream-{epoch:08d}"
            ingest_files(batch.sparkSession, paths, table, log, name, earlier=tuple(run), **options)
            run.append(name)

    return (
        found.writeStream.foreachBatch(decide)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
