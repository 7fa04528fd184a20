"""Output of vertex and edge tables, as Parquet or as CSV for bulk import."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from ..workspace import is_complete

# Spark's writer would strip blanks at both ends of a text.
_CSV = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}

# Column names of the import format.
_HEADER = {
    "id": ":ID",
    "src": ":START_ID",
    "dst": ":END_ID",
    "scan_date": "scan_date:date",
    "scan_dates": "scan_date:date[]",
    "server_name_indicators": "server_name_indicators:string[]",
    "locations": "locations:string[]",
    "basicConstraints": "basicConstraints:boolean",
    "isCa": "isCa:boolean",
    "valid": "valid:boolean",
    "inDegree": "inDegree:int",
    "outDegree": "outDegree:int",
    "numAltNames": "numAltNames:int",
}
_LISTS = ("scan_dates", "server_name_indicators", "locations")


def graph_header(columns: Iterable[str]) -> list[str]:
    """Typed names of the import header; unknown columns keep theirs."""
    return [_HEADER.get(c, c) for c in columns]


def flatten_lists(df: DataFrame) -> DataFrame:
    """List columns as text, joined with semicolons."""
    joined = {c: F.concat_ws(";", F.col(c)) for c in _LISTS if c in df.columns}
    return df.withColumns(joined) if joined else df


def export_csv(df: DataFrame, path: str, *, compression: str = "none") -> None:
    """Write ``<path>/header`` (one row) and ``<path>/rows`` (many files).

    An import names the header file and all row files; nothing is gathered into
    one file or on one machine.
    """
    options = {**_CSV, "compression": compression}
    names = graph_header(df.columns)
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    header = df.sparkSession.createDataFrame([tuple(names)], schema).coalesce(1)
    header.write.mode("overwrite").csv(f"{path}/header", **options)
    flatten_lists(df).write.mode("overwrite").csv(f"{path}/rows", **options)


def write_graph_table(
    df: DataFrame,
    path: str,
    *,
    kind: str = "parquet",
    partitions: int | None = None,
    resume: bool = False,
) -> None:
    """Store one vertex or edge table, range clustered by its ids."""
    if kind not in ("parquet", "csv"):
        raise ValueError(f"unknown output type {kind}")
    done = f"{path}/rows" if kind == "csv" else path
    if resume and is_complete(df.sparkSession, done):
        return
    if kind == "csv":
        export_csv(df, path)
        return
    keys = ["id"] if "id" in df.columns else ["src", "dst"]
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *keys)
    ranged.write.mode("overwrite").parquet(path)


def write_dns_pairs(pairs: DataFrame, path: str, *, compression: str = "none") -> None:
    """Resolved pairs as headerless ``ip,domain`` files per scan date and record type."""
    rows = pairs.select("ip", "domain", "scan_date", "type")
    writer = rows.write.mode("overwrite").partitionBy("scan_date", "type")
    writer.csv(path, **_CSV, compression=compression)
