"""Batch files of customer records: header mapping, schema gate, parsing."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.schemas import CUSTOMER_COLUMNS, CUSTOMERS, HEADER_ALIASES, SCORING


class HeaderError(ValueError):
    """The header does not give each customer column exactly once."""


def map_header(columns: list[str]) -> dict[str, str]:
    """Customer column -> column of the file, letter case aside."""
    found: dict[str, str] = {}
    for column in columns:
        name = HEADER_ALIASES.get(column.strip().lower())
        if name is None:
            continue
        if name in found:
            raise HeaderError(f"two columns for {name}: {found[name]}, {column}")
        found[name] = column
    missing = [c for c in CUSTOMER_COLUMNS if c not in found]
    if missing:
        raise HeaderError(f"missing columns: {', '.join(missing)}")
    return found


def require_columns(columns: list[str], required: list[str]) -> None:
    for column in required:
        if column not in columns:
            raise ValueError(f"missing required feature: {column}")


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def normalize_batch(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Select and name the customer columns of a frame with any accepted header."""
    header = map_header([c for c in df.columns if c not in (keep or [])])
    return df.select(*(keep or []), *[_quoted(header[c]).alias(c) for c in CUSTOMER_COLUMNS])


def _number(text: Column, data_type: T.DataType) -> Column:
    """Read a number; '40.0' is a whole number too, anything else becomes NULL."""
    number = F.nanvl(text.try_cast("double"), F.lit(None))
    if isinstance(data_type, T.DoubleType):
        return number
    exact = text.try_cast(data_type)
    return F.coalesce(exact, number.try_cast(data_type))


def parse_batch(strings: DataFrame, keep: list[str]) -> DataFrame:
    """Type the columns; `unparsable` marks rows with text where a number belongs, or no id."""
    typed, bad = [], F.col("customer_id").isNull()
    for field in CUSTOMERS:
        if isinstance(field.dataType, T.StringType):
            typed.append(F.col(field.name))
            continue
        number = _number(F.trim(field.name), field.dataType)
        typed.append(number.alias(field.name))
        bad = bad | (F.col(field.name).isNotNull() & number.isNull())
    return strings.select(*keep, *typed, bad.alias("unparsable"))


def find_files(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the CSV files in a folder, any letter case of the suffix; contents are not read."""
    listed = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.[cC][sS][vV]").load(folder).select("path")
    )
    return sorted(r["path"] for r in listed.collect())


def plain_path(uri: Column) -> Column:
    """The path of a file URI as a listing gives it: not percent-encoded, one slash after file:."""
    decoded = F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def _headers(spark: SparkSession, paths: list[str]) -> dict[str, tuple[str, ...]]:
    """Column names of every file, from the first line of each, by one job for all of them."""
    lines = spark.read.text(paths).select(
        plain_path(F.col("_metadata.file_path")).alias("path"), "value", F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"),
    )
    # one line per file and task is shuffled
    first = lines.where("start = 0").groupBy("path").agg(F.min_by("value", "id").alias("line"))
    found = {r["path"]: r["line"] for r in first.collect()}  # a line per file of the batch
    return {path: tuple(next(csv.reader([found[path]]), ())) for path in paths if path in found}


def read_files(spark: SparkSession, paths: list[str]) -> tuple[DataFrame | None, dict[str, str]]:
    """Parsed rows of the files that pass the schema gate, and why others do not.

    Files with the same header are read together. Columns go by name within each file.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    refused: dict[str, str] = {}
    headers = _headers(spark, paths)
    for path in paths:
        header = headers.get(path, ())
        try:
            map_header(list(header))
            by_header.setdefault(header, []).append(path)
        except HeaderError as error:
            refused[path] = str(error)
    parts = []
    for header, same in by_header.items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
        read = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("multiLine", True).csv(same)
        # quoted values may hold line breaks, so a file is read by one task; row ids order its rows
        placed = read.select(
            "*",
            plain_path(F.col("_metadata.file_path")).alias("file_name"),
            F.col("_metadata.file_block_start").alias("_start"),
            F.monotonically_increasing_id().alias("_id"),
        )
        placed = placed.withColumn("rn", F.struct("_start", "_id")).drop("_start", "_id")
        parts.append(parse_batch(normalize_batch(placed, ["file_name", "rn"]), ["file_name", "rn"]))
    if not parts:
        return None, refused
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows, refused


def parse_scoring_json(df: DataFrame, column: str = "value") -> DataFrame:
    """Scoring records from JSON text. Numbers may come as text; a record that lacks one,
    or has text where a number belongs, is not `valid`."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in SCORING])
    record = df.withColumn("_r", F.from_json(column, texts))
    fields, valid = [], F.lit(True)
    for field in SCORING:
        text = F.col(f"_r.{field.name}")
        value = text if isinstance(field.dataType, T.StringType) else _number(F.trim(text), field.dataType)
        fields.append(value.alias(field.name))
        if not isinstance(field.dataType, T.StringType):
            valid = valid & value.isNotNull()
    keep = [c for c in df.columns if c != column]
    return record.select(*keep, *fields, valid.alias("valid"))
