"""Incoming record files: which rows of which files go into the customers table.

A file is taken or left as a whole. Files are looked at together, in the order of their
names: nothing here runs once per file.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions.checks import any_violation, surely_valid
from ebbtide.operators.cleaning import keep_first
from ebbtide.operators.joins import join_checked
from ebbtide.schemas import CUSTOMER_COLUMNS

INGESTED = "ingested"
NO_NEW_ROWS = "no_new_rows"
CHECK_VIOLATION = "check_violation"
DUPLICATE_IDS = "duplicate_ids"
UNPARSABLE = "unparsable"
MISSING_COLUMNS = "missing_columns"

DONE = [INGESTED, NO_NEW_ROWS]  # such a file is archived, any other stays where it is

REJECT_FILE = "reject_file"  # an id that an earlier file of the run added rejects the whole file
DROP_ROWS = "drop_rows"  # only the rows with such ids are dropped


@dataclass
class IngestResult:
    rows: DataFrame  # file_name and the customer columns of what is to be appended
    files: DataFrame  # one row per file: counts and status
    kept: list[DataFrame] = field(default_factory=list)  # what is persisted while `rows` is in use

    def release(self) -> None:
        for df in self.kept:
            df.unpersist()


#: the table's rows, or what gives those that may have one of the asked ids (a column of distinct, persisted ones)
Known = DataFrame | Callable[[DataFrame], DataFrame]


def _known(existing: Known, asked: DataFrame, key: str) -> DataFrame:
    """The asked ids that the table has."""
    rows = existing if isinstance(existing, DataFrame) else existing(asked)
    return join_checked(rows.select(key), asked, [key], "left_semi")


def new_records(batch: DataFrame, existing: Known, key: str = "customer_id", kept: list[DataFrame] | None = None) -> DataFrame:
    """Rows whose key the table does not have.

    The big table is reduced to the few keys the batch asks about, by a broadcast of those
    keys as long as they fit, so its key column is read once and not shuffled. A table with an
    index (operators.id_index) is given as a function of the asked keys, and only partitions that
    may hold them are read.
    """
    asked = batch.select(key).distinct()
    if kept is not None:
        kept.append(asked.persist())
    return batch.join(_known(existing, asked, key), key, "left_anti")


def _in(files: set[str]) -> Column:
    return F.col("file_name").isin(sorted(files)) if files else F.lit(False)


def _settle_clashes(valid: DataFrame, files: list[str]) -> tuple[set[str], set[str]]:
    """Accepted and rejected files when a shared id lets only the first accepted file through.

    One job finds which files share an id with which earlier ones: a row per pair of files of the
    run, however many ids they share. In the order of their names a file is then accepted if no
    earlier accepted file shares an id with it.
    """
    shared = (
        valid.groupBy("customer_id")
        .agg(F.array_sort(F.collect_set("file_name")).alias("files"))  # a set of files, not of rows
        .where(F.size("files") > 1)
        .select("files")
        .distinct()
    )
    placed = shared.select("files", F.posexplode("files").alias("place", "file_name")).where("place > 0")
    earlier = F.explode(F.slice("files", 1, F.col("place"))).alias("earlier")
    sharers: dict[str, set[str]] = {}
    for row in placed.select("file_name", earlier).distinct().collect():
        sharers.setdefault(row["file_name"], set()).add(row["earlier"])
    accepted: set[str] = set()
    for name in sorted(files):
        if accepted.isdisjoint(sharers.get(name, ())):
            accepted.add(name)
    return accepted, set(files) - accepted


def ingest_batch(rows: DataFrame, existing: Known, mode: str = REJECT_FILE, claimed: Known | None = None) -> IngestResult:
    """Decide about files of parsed rows.

    `claimed` has the ids (a column customer_id) that earlier files of the same run added: a file that
    shares one is treated as it would be if those files were among `rows`, before it.

    `rows` has file_name, rn (the place in the file) and the customer columns, and may have
    a boolean `unparsable`. Order inside a file: dedup, drop known ids, then ranges; the
    domain check looks at what would be written.
    """
    if mode not in (REJECT_FILE, DROP_ROWS):
        raise ValueError(f"unknown mode {mode!r}")
    spark = rows.sparkSession
    if "unparsable" not in rows.columns:
        rows = rows.withColumn("unparsable", F.lit(False))
    kept_frames: list[DataFrame] = []
    unique = keep_first(rows, ["file_name", "customer_id"], "rn").persist()
    fresh = (
        new_records(unique, existing, kept=kept_frames)
        .withColumns({"in_range": surely_valid(), "violates": any_violation()})
        .persist()
    )
    kept_frames += [unique, fresh]
    # file names are few: they were listed by the driver
    read = rows.groupBy("file_name").agg(F.bool_or("unparsable").alias("unparsable"))
    seen = unique.groupBy("file_name").agg(F.count("*").alias("unique_rows"))
    kept = fresh.groupBy("file_name").agg(
        F.count("*").alias("new_rows"),
        F.count_if("in_range").alias("valid_rows"),
        F.count_if(F.col("in_range") & F.col("violates")).alias("violations"),
    )
    counted = read.join(seen, "file_name").join(kept, "file_name", "left").na.fill(0).collect()

    status: dict[str, str] = {}
    for f in counted:
        if f["new_rows"] and f["unparsable"]:
            status[f["file_name"]] = UNPARSABLE
        elif f["violations"]:
            status[f["file_name"]] = CHECK_VIOLATION
        elif not f["valid_rows"]:
            status[f["file_name"]] = NO_NEW_ROWS
    late: DataFrame | None = None
    if claimed is not None:
        open_ids = fresh.where("in_range").select("file_name", "customer_id")
        # the rows of the batch are few beside the table: what is shared is looked up from their side
        asked = open_ids.select("customer_id").distinct().persist()
        late = open_ids.join(_known(claimed, asked, "customer_id"), "customer_id", "left_semi").persist()
        kept_frames += [asked, late]
    candidates = sorted(f["file_name"] for f in counted if f["file_name"] not in status)
    if late is not None and mode == REJECT_FILE:
        too_late = {r["file_name"] for r in late.select("file_name").distinct().collect()} & set(candidates)
        status.update(dict.fromkeys(too_late, DUPLICATE_IDS))
        candidates = [name for name in candidates if name not in too_late]
    valid = fresh.where(F.col("in_range") & _in(set(candidates))).select("file_name", *CUSTOMER_COLUMNS)

    if mode == REJECT_FILE:
        accepted, rejected = _settle_clashes(valid.select("file_name", "customer_id"), candidates)
        status.update(dict.fromkeys(accepted, INGESTED))
        status.update(dict.fromkeys(rejected, DUPLICATE_IDS))
        taken = valid.where(_in(accepted))
        written = {f["file_name"]: f["valid_rows"] for f in counted}
    else:
        if late is not None:
            valid = valid.join(late.select("customer_id").distinct(), "customer_id", "left_anti").select(valid.columns)
        taken = keep_first(valid, "customer_id", "file_name").persist()
        kept_frames.append(taken)
        status.update(dict.fromkeys(candidates, INGESTED))
        written = {r["file_name"]: r["count"] for r in taken.groupBy("file_name").count().collect()}
    report = [
        (
            f["file_name"],
            status[f["file_name"]],
            f["unique_rows"],
            f["new_rows"],
            f["new_rows"] - f["valid_rows"],
            written.get(f["file_name"], 0) if status[f["file_name"]] == INGESTED else 0,
        )
        for f in sorted(counted, key=lambda f: f["file_name"])
    ]
    files = spark.createDataFrame(
        report,
        "file_name string, status string, unique_rows long, new_rows long, out_of_range_rows long, written_rows long",
    )
    return IngestResult(taken, files, kept_frames)


def ingest_summary(files: DataFrame) -> DataFrame:
    """Counts per file and in total."""
    counts = ["unique_rows", "new_rows", "out_of_range_rows", "written_rows"]
    total = files.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts])
    return files.unionByName(total.select(F.lit("TOTAL").alias("file_name"), F.lit("total").alias("status"), *counts))
