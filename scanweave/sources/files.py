"""Scan files: discovery in dated folders and readers for each kind."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.text import strip_dot
from ..schemas import CORRUPT, DNS_PAIRS, DNS_RECORD, PARSED_CERTS

_DATE = r"(\d{4}-\d{2}-\d{2})"


def _decoded(path: Column) -> Column:
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _path() -> Column:
    return _decoded(F.col("_metadata.file_path"))


def _folder(path: Column) -> Column:
    return F.regexp_extract(path, r"\A(.*)/[^/]*\z", 1)


def scan_date(path: Column) -> Column:
    """First date in the folder part of a path; null where there is none, an error
    for a date that does not exist."""
    return F.to_date(F.nullif(F.regexp_extract(_folder(path), _DATE, 1), F.lit("")))


def source_name(path: Column) -> Column:
    """Name of the folder a file lies in."""
    # Taken from every row: a pattern that looks for the end would try each place of the path.
    folder = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.when(path.contains("/"), folder).otherwise("")


def folder_key(path: Column) -> Column:
    """Tells folders of one name apart: a hash of the whole path of a file's folder."""
    return F.lower(F.hex(F.xxhash64(_folder(path))))


def file_key(path: Column) -> Column:
    return F.lower(F.hex(F.xxhash64(path)))


def _origin(path: Column) -> list[Column]:
    return [
        scan_date(path).alias("scan_date"), source_name(path).alias("source"),
        folder_key(path).alias("scan"), file_key(path).alias("file"),
    ]


def record_type(path: Column) -> Column:
    name = F.substring_index(path, "/", -1)
    return F.when(name.contains("AAAA"), "AAAA").otherwise("A")


def list_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(path, length, modified, scan_date, source, scan, file)`` of the files in the folders,
    files and globs of ``paths``. They are only listed, nothing is opened."""
    listed = spark.read.format("binaryFile").load(list(paths))
    size = ["length", F.col("modificationTime").alias("modified")]
    return listed.select("path", *size, *_origin(F.col("path")))


def discover(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """``(path, length, modified, kind, scan_date, source, scan, file, type)`` of the scan files in
    ``folders``.

    Files in a folder without a date have a null ``scan_date``; files of no known
    kind are left out. ``type`` is set for DNS pair files.
    """
    name = F.regexp_extract("path", r"[^/]*\z", 0)
    scan = F.nullif(F.regexp_extract(name, r"\A(hosts|http|certs)\.csv(?:\.\w+)?\z", 1), F.lit(""))
    kind = F.coalesce(scan, F.when(name.contains(".ipdomain"), "dns"))
    return list_files(spark, folders).select(
        "path",
        "length",
        "modified",
        kind.alias("kind"),
        "scan_date",
        "source",
        "scan",
        "file",
        F.when(kind == "dns", record_type(F.col("path"))).alias("type"),
    ).where(F.col("kind").isNotNull())


def read_delimited(
    spark: SparkSession,
    paths: Sequence[str],
    schema: str | None = None,
    *,
    header: bool = True,
    multiline: bool = True,
) -> DataFrame:
    """CSV files with doubled quotes, as ``_corrupt``, the columns, ``scan_date``,
    ``source``, ``scan``, ``file`` and ``type`` from each file's path.

    The header must equal the schema. Without a schema all columns are text and
    named by the header. A row that does not fit has its text in ``_corrupt``,
    see ``good_rows``. A multiline file is one task, several files run side by
    side; pass ``multiline=False`` to split files whose fields hold no newline.
    """
    reader = spark.read.options(
        header=header, multiLine=multiline, quote='"', escape='"', inferSchema=False
    )
    if schema is None:
        columns = reader.csv(list(paths)).schema
    else:
        columns = T.StructType.fromDDL(schema)
    corrupt = T.StructField(CORRUPT, T.StringType())
    rows = reader.options(
        enforceSchema=not header, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT
    ).schema(T.StructType([*columns.fields, corrupt]))
    # Spark converts only the columns a query asks for, and a bad value in another
    # one would go unnoticed. This condition always holds and asks for all.
    every = F.hash(*(c.name for c in columns.fields)) >= F.lit(-(2**31))
    path = _path()
    return rows.csv(list(paths)).where(every).select(
        CORRUPT,
        *(c.name for c in columns.fields),
        *_origin(path),
        record_type(path).alias("type"),
    )


def headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """Column names of CSV files by path, in one job. Each file (each part of a large one) is a
    task of its own, which reads one line and returns."""
    if not paths:
        return {}
    apart = spark.newSession()  # its settings are its own
    apart.conf.set("spark.sql.files.openCostInBytes", apart.conf.get("spark.sql.files.maxPartitionBytes"))
    apart.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    start = F.col("_metadata.file_block_start").alias("start")
    # Python's early return does not end the scan: later lines would all be sent to it.
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("row")
    lines = apart.read.text(list(paths)).select(F.col("_metadata.file_path").alias("_at"), "value", start, row)
    lines = lines.where("row = 0").select(_decoded(F.col("_at")).alias("path"), "value", "start")
    lines = lines.mapInArrow(_first_line, "path string, value string").collect()  # one row per file
    found = {}
    for path, line in lines:
        if line.count('"') % 2:  # a name goes on in the next line: read the first record
            found[path] = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"').columns
        else:
            found[path] = next(csv.reader([line.removeprefix("\ufeff")]), [])
    return found


def _first_line(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            if batch.column("start")[0].as_py() == 0:
                yield batch.slice(0, 1).select(["path", "value"])
            return


def read_parsed_certs(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Certificate files that were parsed elsewhere. The names are JSON text there;
    JSON ``null`` is a null list."""
    rows = read_delimited(spark, paths, PARSED_CERTS).drop("type")
    return rows.withColumn("altNames", F.from_json("altNames", "array<string>"))


def read_dns_pairs(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Pair files without a header: ``_corrupt, ip, domain``, where they are from and ``type``."""
    return read_delimited(spark, paths, DNS_PAIRS, header=False, multiline=False)


def read_dns_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """JSON lines of DNS records: ``_corrupt, name, answers`` and where they are from."""
    rows = spark.read.schema(f"{DNS_RECORD}, {CORRUPT} string").json(
        list(paths), mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT
    )
    path = _path()
    return rows.select(
        CORRUPT,
        "name",
        F.col("data.answers").alias("answers"),
        *_origin(path),
    )


def good_rows(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_rows(rows: DataFrame) -> DataFrame:
    """``(scan_date, source, scan, file, reason, payload)`` of the rows that did not fit."""
    bad = rows.where(F.col(CORRUPT).isNotNull())
    return bad.select(*_origin_of(rows), F.lit("malformed row").alias("reason"), F.col(CORRUPT).alias("payload"))


def _origin_of(rows: DataFrame) -> list[str]:
    return [c for c in ("scan_date", "source", "scan", "file") if c in rows.columns]


def usable_records(records: DataFrame) -> DataFrame:
    """DNS records that could be read and have a name."""
    return records.where(F.col(CORRUPT).isNull() & F.col("name").isNotNull()).drop(CORRUPT)


def unusable_records(records: DataFrame) -> DataFrame:
    """``(scan_date, source, scan, file, reason, payload)`` of the lines that are no DNS record."""
    reason = F.when(F.col(CORRUPT).isNotNull(), "malformed line").otherwise("no name")
    payload = F.coalesce(F.col(CORRUPT), F.to_json(F.struct("answers")))
    bad = records.where(F.col(CORRUPT).isNotNull() | F.col("name").isNull())
    return bad.select(*_origin_of(records), reason.alias("reason"), payload.alias("payload"))


def clean_names(rows: DataFrame, column: str) -> DataFrame:
    """Host names of a scan without their final dot."""
    return rows.withColumn(column, strip_dot(F.col(column)))
