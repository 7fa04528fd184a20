"""Round trips through scan files, snapshot tables and exports."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from scanweave.schemas import GRAPH_COLUMNS, HOSTS, PARSED_CERTS
from scanweave.sinks.graph import export_csv
from scanweave.sources.files import bad_rows, good_rows, list_files, read_delimited
from scanweave.sources.snapshots import (
    ingest_scans,
    note_files,
    pending,
    read_rejects,
    read_snapshot,
    write_snapshot,
)
from scanweave.workspace import materialize, scratch_dir

from . import edges
from .base import table


def csv_roundtrip(spark, folder):
    path = f"{scratch_dir(spark, 'csv')}/2024-01-02-docs"
    rows = table(spark, folder, "documents").select("doc_id", "text", "lang")
    rows.write.csv(
        path, header=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return good_rows(read_delimited(spark, [path], "doc_id bigint, text string, lang string")).select(
        "doc_id", "text", "lang"
    )


# Every third customer's line is too short, every fifth one's number is none.
_LINE = """CASE WHEN c_custkey % 3 = 0 THEN concat('', c_custkey)
    WHEN c_custkey % 5 = 0 THEN concat('x', c_custkey, ',', c_name)
    WHEN c_custkey % 7 = 0 THEN concat(',', c_name)
    ELSE concat('', c_custkey, ',', c_name) END"""
_BAD = "c_custkey % 3 = 0 OR c_custkey % 5 = 0"


def _lines(spark, folder):
    path = f"{scratch_dir(spark, 'lines')}/2024-01-02-lines"
    table(spark, folder, "customer").selectExpr(f"{_LINE} AS value").write.text(path)
    return read_delimited(spark, [path], "id int, name string", header=False)


def malformed_rows_dropped(spark, folder):
    return good_rows(_lines(spark, folder)).select("id", "name")


def malformed_rows_kept(spark, folder):
    rows = bad_rows(_lines(spark, folder)).select("scan_date", "reason", "payload")
    return rows.withColumn("payload", F.trim("payload"))


def _daily_files(spark, folder):
    path = scratch_dir(spark, "events")
    rows = table(spark, folder, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    rows = rows.select("event_id", "user_id", "event_type", "props", "day")
    rows.write.partitionBy("day").csv(path, header=True, quote='"', escape='"')
    return [f"{path}/day=*"]


_EVENT = "event_id bigint, user_id bigint, event_type string, props string"


def _ingest(spark, folder):
    """Ingest half of the event types' files, then all: the second pass adds nothing twice."""
    files = list_files(spark, _daily_files(spark, folder))
    store = f"{scratch_dir(spark, 'store')}/events"
    for found in (files.where(F.dayofmonth("scan_date") <= 15), files):
        new = materialize(pending(found, store), scratch_dir(spark, "new"))
        paths = [r.path for r in new.select("path").collect()]
        if paths:
            write_snapshot(read_delimited(spark, paths, _EVENT).drop("type"), store)
            note_files(new, store)
    return store


def _place(spark, rows, path, **options):
    """Write rows as the one CSV file ``path``, as a scanner leaves it."""
    part = scratch_dir(spark, "part")
    rows.coalesce(1).write.csv(part, quote='"', escape='"', emptyValue="", **options)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    target = hadoop(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    fs.delete(target, False)
    fs.rename(fs.globStatus(hadoop(f"{part}/part-*"))[0].getPath(), target)


_HOST_VALUES = {
    "id": "CAST(c_custkey AS INT)", "ip": "concat('10.0.', c_custkey % 200, '.', c_nationkey)", "port": "443",
    "server_name": "concat('c', c_custkey, '.example.com.')", "cert_hash": "sha2(c_name, 256)", "cert_valid": "c_custkey % 2",
    "cipher": "concat('a \"quoted\" ', c_mktsegment)",
}
_CERT_VALUES = {
    "id": "CAST(c_custkey AS INT)", "system_cert_store": "0", "sha1": "sha1(c_name)", "sha256": "sha2(c_name, 256)", "subject": "c_name",
    "issuer": "c_mktsegment", "notBefore": "'2024-01-01T00:00:00Z'", "notAfter": "'2025-01-01T00:00:00Z'", "basicConstraints": "'true'",
    "isCa": "'false'", "sha256PubKey": "'k'", "numAltNames": "1", "altNames": "concat('[\"c', c_custkey, '.example.com\"]')",
}


def _columns(ddl, values):
    return [f"{values.get(c.split()[0], 'CAST(NULL AS STRING)')} AS {c.split()[0]}" for c in ddl.split(", ")]


def scan_ingest(spark, folder):
    """Two runs over scan folders: between them a DNS file comes late, another one and an
    HTTP file are replaced. Hosts are compressed, certificates were parsed elsewhere."""
    customer, orders = table(spark, folder, "customer"), table(spark, folder, "orders")
    root, store = scratch_dir(spark, "in"), scratch_dir(spark, "store")
    tls, dns = f"{root}/2024-01-02-tls", f"{root}/2024-01-03-dns"
    _place(spark, customer.selectExpr(*_columns(HOSTS, _HOST_VALUES)), f"{tls}/hosts.csv.gz", header=True, compression="gzip")
    _place(spark, customer.selectExpr(*_columns(PARSED_CERTS, _CERT_VALUES)), f"{tls}/certs.csv", header=True)
    for run in (1, 2):
        http = customer.selectExpr("c_custkey AS id", f"concat('https://r{run}.example.org/', c_custkey) AS Location")
        _place(spark, http, f"{tls}/http.csv", header=True)
        pairs = orders.selectExpr("concat('10.1.', o_custkey % 200, '.1') AS ip", f"concat('o', o_orderkey, '.r{run}.example.com') AS domain")
        _place(spark, pairs.where(f"o_orderkey % 2 = {run - 1}"), f"{dns}/resolved-A.ipdomain")
        if run == 2:
            _place(spark, pairs.where("o_orderkey % 3 = 0"), f"{dns}/late-AAAA.ipdomain")
        ingest_scans(spark, [tls, dns], store)
    parts = [
        read_snapshot(spark, f"{store}/hosts", GRAPH_COLUMNS["hosts"]).selectExpr("'hosts' AS kind", "scan_date", "source", "ip AS a", "server_name AS b"),
        read_snapshot(spark, f"{store}/http", GRAPH_COLUMNS["http"]).selectExpr("'http'", "scan_date", "source", "id", "Location"),
        read_snapshot(spark, f"{store}/certs", GRAPH_COLUMNS["certs"]).selectExpr("'certs'", "scan_date", "source", "sha256", "altNames[0]"),
        read_snapshot(spark, f"{store}/dns", f"{GRAPH_COLUMNS['dns']}, type string").selectExpr("concat('dns ', type)", "scan_date", "source", "ip", "domain"),
    ]
    return reduce(DataFrame.union, parts)


def snapshot_ingest(spark, folder):
    rows = read_snapshot(spark, _ingest(spark, folder))
    return rows.select("event_id", "user_id", "event_type", "props", "scan_date", "source")


def snapshot_rejects(spark, folder):
    """Rows of the text lines that did not fit, read back from the stored snapshot."""
    store = f"{scratch_dir(spark, 'store')}/lines"
    write_snapshot(_lines(spark, folder).drop("type"), store)
    return read_rejects(spark, store).select("scan_date", "source", "reason", F.trim("payload").alias("payload"))


def graph_csv(spark, folder):
    """Folded edges with numeric ends, exported and read back under the typed header."""
    rows = edges._folded(spark, folder).select(
        F.substr("from", F.lit(3)).cast("long").alias("src"),
        F.substr("to", F.lit(3)).cast("long").alias("dst"),
        "scan_dates",
        "server_name_indicators",
        "valid",
    )
    path = scratch_dir(spark, "export")
    export_csv(rows, path)
    options = {"quote": '"', "escape": '"'}
    names = spark.read.csv(f"{path}/header", **options).first()
    body = spark.read.schema("a bigint, b bigint, c string, d string, e string").csv(f"{path}/rows", **options)
    return body.toDF(*names)


CATALOG = {
    "csv_roundtrip": (csv_roundtrip, "SELECT doc_id, text, lang FROM documents"),
    "malformed_rows_dropped": (
        malformed_rows_dropped,
        f"""SELECT CASE WHEN c_custkey % 7 <> 0 THEN CAST(c_custkey AS INT) END AS id, c_name AS name
        FROM customer WHERE NOT ({_BAD})""",
    ),
    "malformed_rows_kept": (
        malformed_rows_kept,
        f"""SELECT DATE '2024-01-02' AS scan_date, 'malformed row' AS reason, {_LINE} AS payload
        FROM customer WHERE {_BAD}""",
    ),
    "snapshot_ingest": (
        snapshot_ingest,
        """SELECT event_id, user_id, event_type, props, CAST(ts AS DATE) AS scan_date,
          concat('day=', strftime(ts, '%Y-%m-%d')) AS source FROM events""",
    ),
    "scan_ingest": (
        scan_ingest,
        """SELECT 'hosts' AS kind, DATE '2024-01-02' AS scan_date, '2024-01-02-tls' AS source,
          concat('10.0.', c_custkey % 200, '.', c_nationkey) AS a, concat('c', c_custkey, '.example.com.') AS b FROM customer
        UNION ALL SELECT 'http', DATE '2024-01-02', '2024-01-02-tls', c_custkey::VARCHAR, concat('https://r2.example.org/', c_custkey) FROM customer
        UNION ALL SELECT 'certs', DATE '2024-01-02', '2024-01-02-tls', sha256(c_name), concat('c', c_custkey, '.example.com') FROM customer
        UNION ALL SELECT concat('dns ', t), DATE '2024-01-03', '2024-01-03-dns', concat('10.1.', o_custkey % 200, '.1'),
          concat('o', o_orderkey, '.r2.example.com') FROM orders, (VALUES ('A'), ('AAAA')) v(t)
          WHERE CASE t WHEN 'A' THEN o_orderkey % 2 = 1 ELSE o_orderkey % 3 = 0 END""",
    ),
    "snapshot_rejects": (
        snapshot_rejects,
        f"""SELECT DATE '2024-01-02' AS scan_date, '2024-01-02-lines' AS source, 'malformed row' AS reason,
          {_LINE} AS payload FROM customer WHERE {_BAD}""",
    ),
    "graph_csv": (
        graph_csv,
        f"""WITH {edges._FOLDED} SELECT CAST("from"[3:] AS BIGINT) AS ":START_ID", CAST("to"[3:] AS BIGINT) AS ":END_ID",
          scan_dates AS "scan_date:date[]", server_name_indicators AS "server_name_indicators:string[]",
          CAST(valid AS VARCHAR) AS "valid:boolean" FROM folded""",
    ),
}
