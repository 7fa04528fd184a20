"""Dated snapshot tables: each file is ingested once into its own partition.

A partition is named by date, folder name, a hash of the folder's path and a hash of the
file's path. So a file that comes late to a known folder is new, and neither folders
of one name nor files of one folder replace each other. The manifest of a table has path,
size and time of every file that is in it: a file that was replaced is read again.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..operators.certs import with_attributes, with_der
from ..operators.dns import answer_errors, long_aliases, resolve_cnames
from ..schemas import CORRUPT, HOSTS, PARSED_CERTS
from ..workspace import exists, materialize, remove, scratch_dir
from . import files

SCAN = ("scan_date", "source", "scan")
SNAPSHOT = (*SCAN, "file")
DNS_SNAPSHOT = (*SNAPSHOT, "type")


def write_snapshot(rows: DataFrame, table: str, partition_by: Sequence[str] = SNAPSHOT) -> dict:
    """Write rows into their partitions, replacing these and no others.

    Returns ``{"rows": n, "rejected": m}``, counted while writing. Every input
    file belongs to one partition, so tasks write without a shuffle; a single
    big file becomes a single big Parquet file, which later scans split again.
    """
    counted = Observation()
    rejected = F.col(CORRUPT) if CORRUPT in rows.columns else F.lit(None)
    rows = rows.observe(
        counted, F.count(F.lit(1)).alias("rows"), F.count(rejected).alias("rejected")
    )
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(table)
    return counted.get


def _manifest(table: str) -> str:
    return f"{table}/_files"  # readers of the table skip names with an underscore


_NOTED = ("path", "length", "modified")


def pending(found: DataFrame, table: str) -> DataFrame:
    """Those files of ``found`` that are not in ``table`` yet as they are now: new ones, and ones
    that were replaced under their name. The table's manifest is joined, in Spark."""
    spark = found.sparkSession
    if not exists(spark, _manifest(table)):
        return found
    done = spark.read.parquet(_manifest(table)).select(*_NOTED)
    return found.join(done, on=list(_NOTED), how="left_anti")


def note_files(files: DataFrame, table: str) -> None:
    """Note in the manifest of ``table`` that ``files`` (as by ``pending``) are in it, as they were
    when they were listed. This comes last: a run that dies before is repeated whole."""
    files.select(*_NOTED).coalesce(1).write.mode("append").parquet(_manifest(table))


def read_snapshot(
    spark: SparkSession, table: str, columns: str | None = None, dates: Sequence[str] = ()
) -> DataFrame:
    """Good rows of a snapshot table; ``dates`` prunes to some scan dates.

    With ``columns`` (DDL text) the files' own schemas are not looked at: columns
    that older scans do not have are null, and a table not written yet is empty. Without,
    the schemas of all files are merged, which reads all their footers.
    """
    rows = _stored(spark, table, columns, dates)
    return files.good_rows(rows) if CORRUPT in rows.columns else rows


def read_rejects(spark: SparkSession, table: str) -> DataFrame:
    return files.bad_rows(_stored(spark, table, None, ()))


def _stored(
    spark: SparkSession, table: str, columns: str | None, dates: Sequence[str]
) -> DataFrame:
    if columns:
        schema = f"{columns}, {CORRUPT} string, scan_date date, source string, scan string, file string"
        if not exists(spark, table):
            return spark.createDataFrame([], schema)
        rows = spark.read.schema(schema).parquet(table)
    else:
        # Names of folders are text, also those that look like numbers.
        names = {"scan_date": "date", "type": "string", **dict.fromkeys(SNAPSHOT[1:], "string")}
        found = spark.read.option("mergeSchema", True).parquet(table).schema
        schema = ", ".join(f"`{c.name}` {names.get(c.name, c.dataType.simpleString())}" for c in found)
        rows = spark.read.schema(schema).parquet(table)
    rows = rows.withColumn("scan_date", F.to_date("scan_date"))
    return rows.where(F.col("scan_date").isin(*map(date.fromisoformat, dates))) if dates else rows


def _paths(found: DataFrame) -> list[str]:
    return [row.path for row in found.select("path").distinct().collect()]


def ingest_scans(spark: SparkSession, folders: Sequence[str], store: str) -> dict[str, dict]:
    """Bring all new and replaced scan files of ``folders`` into ``store`` and return row counts.

    Writes the tables ``hosts``, ``http``, ``certs`` and ``dns``, and ``cert_bodies`` with what was
    read from each different certificate. Folders without a date are skipped. A TLS scan
    without certificates is an error. A certificate file may hold PEM text or, told by its
    header, attributes that were parsed elsewhere.
    """
    found = files.discover(spark, folders).where(F.col("scan_date").isNotNull())
    kinds = found.groupBy(*SCAN).agg(F.collect_set("kind").alias("kinds"))
    tls = F.array_contains("kinds", "hosts")
    lacking = kinds.where(tls & ~F.array_contains("kinds", "certs")).collect()
    if lacking:
        raise FileNotFoundError(f"no certificates in {sorted(r.source for r in lacking)}")
    scans = found.join(kinds.where(tls).select(*SCAN), on=list(SCAN), how="left_semi")

    counts: dict[str, dict] = {}

    def add(kind: str, written: dict) -> None:
        counts[kind] = {k: n + counts.get(kind, {}).get(k, 0) for k, n in written.items()}

    for kind in ("hosts", "http", "certs", "dns"):
        table = f"{store}/{kind}"
        rows = found if kind == "dns" else scans
        # The list is stored: what is noted in the end is what was read, not what is there by then.
        listed = scratch_dir(spark, f"new-{kind}")
        new = materialize(pending(rows.where(F.col("kind") == kind), table), listed)
        paths = _paths(new)
        if kind == "hosts" and paths:
            add(kind, write_snapshot(files.read_delimited(spark, paths, HOSTS).drop("type"), table))
        elif kind == "dns" and paths:
            add(kind, write_snapshot(files.read_dns_pairs(spark, paths), table, DNS_SNAPSHOT))
        elif paths:
            for names, group in _alike(spark, paths):
                if kind == "http":
                    add(kind, write_snapshot(files.read_delimited(spark, group).drop("type"), table))
                elif "cert" not in names and set(_PARSED_NAMES) <= set(names):
                    add(kind, write_snapshot(files.read_parsed_certs(spark, group), table))
                else:
                    for name, written in _ingest_certs(files.read_delimited(spark, group).drop("type"), store).items():
                        add(name, written)
        if paths:
            note_files(new, table)
        remove(spark, listed)
    return counts


_PARSED_NAMES = [c.split()[0] for c in PARSED_CERTS.split(", ")]


def _alike(spark: SparkSession, paths: Sequence[str]) -> list[tuple[tuple[str, ...], list[str]]]:
    """Files grouped by their header, since scans of different age differ in columns."""
    groups: dict[tuple[str, ...], list[str]] = {}
    names = files.headers(spark, paths)
    for path in paths:
        groups.setdefault(tuple(names.get(path, ())), []).append(path)
    return list(groups.items())


def _ingest_certs(rows: DataFrame, store: str) -> dict[str, dict]:
    """Store raw certificate rows with what their certificates say; text without one is corrupt.

    The same certificates come back in every scan. They are known by the hash of their
    bytes, which Spark computes: only those that ``cert_bodies`` does not have are parsed. A
    file is read by one task, so its rows are dealt out evenly before any work on them.
    """
    spark, bodies = rows.sparkSession, f"{store}/cert_bodies"
    for column in ("cert", "system_cert_store"):
        if column not in rows.columns:
            raise ValueError(f"the certificate file has no column {column}")
    typed = {c: F.expr(f"try_cast({c} AS int)") for c in ("id", "system_cert_store") if c in rows.columns}
    raw = with_der(rows.withColumns(typed).hint("rebalance"))
    path = scratch_dir(spark, "raw-certs")
    raw = materialize(raw, path)

    new = raw.where(F.col("_key").isNotNull()).select("_key", "_der")
    if exists(spark, bodies):
        new = new.join(spark.read.parquet(bodies).select("_key"), "_key", "left_anti")
    parsed = Observation()
    new = new.dropDuplicates(["_key"]).withColumn("_name", F.col("_key"))
    fresh = with_attributes(new).withColumnRenamed("_name", "_key").observe(parsed, F.count(F.lit(1)).alias("rows"))
    fresh.write.mode("append").parquet(bodies)

    known = spark.read.schema(fresh.schema).parquet(bodies)
    attributes = [c for c in known.columns if c != "_key"]
    passed = [c for c in raw.columns if c not in ("_der", "_key", "cert")]
    narrow = raw.select(*passed, "_key")
    # A file's good rows are brought together again, so that its partition has few files.
    good = narrow.join(known.where(F.col("sha256").isNotNull()), "_key").select(*passed, *attributes)
    unread = known.where(F.col("sha256").isNull()).select("_key")
    text = F.coalesce(F.col(CORRUPT), F.col("cert"), F.lit(""))
    bad = raw.join(unread, "_key", "left_semi").unionByName(raw.where(F.col("_key").isNull()))
    bad = bad.withColumn(CORRUPT, text).select(*passed)
    every = good.unionByName(bad, allowMissingColumns=True).hint("rebalance", *SNAPSHOT)
    counts = {"certs": write_snapshot(every, f"{store}/certs"), "cert_bodies": {"rows": parsed.get.get("rows") or 0}}
    remove(spark, path)
    return counts


def ingest_dns_records(
    spark: SparkSession, paths: Sequence[str], store: str, *, max_hops: int | None = None
) -> dict[str, dict]:
    """Resolve new and replaced JSON line files into the ``dns`` and ``dns_errors`` tables of ``store``.

    The lines are parsed once, into a table of records; pairs and errors are two narrow
    passes over its new partitions. With ``max_hops``, aliases beyond so many hops are error
    rows. What is done is noted last, in the manifest of ``dns_records``: a run that dies before
    is repeated, and writes the same partitions.
    """
    table = f"{store}/dns_records"
    listed = scratch_dir(spark, "new-records")
    new = materialize(pending(files.list_files(spark, paths), table), listed)
    found = _paths(new)
    if not found:
        remove(spark, listed)
        return {}
    counts = write_snapshot(files.read_dns_records(spark, found), table)
    stored = _stored(spark, table, None, ()).join(new.select("file").distinct(), "file", "left_semi")
    keep, usable = list(SNAPSHOT), files.usable_records(stored)
    pairs = resolve_cnames(usable, keep=keep, max_hops=max_hops)
    # The table has one layout, whether its rows come from pair files or from records.
    pairs = pairs.withColumn(CORRUPT, F.lit(None).cast("string"))
    errors = [files.unusable_records(stored), answer_errors(usable, keep=keep)]
    if max_hops is not None:
        errors.append(long_aliases(usable, keep=keep, max_hops=max_hops))
    counts = {
        "dns_records": counts,
        "dns": write_snapshot(pairs, f"{store}/dns", DNS_SNAPSHOT),
        "dns_errors": write_snapshot(reduce(DataFrame.unionByName, errors), f"{store}/dns_errors"),
    }
    note_files(new, table)
    remove(spark, listed)
    return counts
