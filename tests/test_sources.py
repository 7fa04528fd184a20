"""Scan files on disk: discovery, strict reading, ingest without repeats."""

import csv
import gzip
import json
import subprocess
from datetime import date
from pathlib import Path

import pytest
import zstandard
from pyspark.sql import functions as F

from scanweave.plans.graph import run
from scanweave.schemas import HOSTS, PARSED_CERTS
from scanweave.sources import files
from scanweave.sources.snapshots import (
    ingest_dns_records,
    ingest_scans,
    pending,
    read_rejects,
    read_snapshot,
)
from scanweave.sinks.graph import write_graph_table

FIXTURES = Path(__file__).parent / "fixtures"
HOST_COLUMNS = [c.split()[0] for c in HOSTS.split(", ")]


def write_csv(path, header, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="") as out:
        writer = csv.writer(out)
        if header:
            writer.writerow(header)
        writer.writerows(rows)


def host(id_, ip, name, cert, valid):
    row = dict.fromkeys(HOST_COLUMNS, "") | {
        "id": id_, "ip": ip, "port": 443, "server_name": name, "cert_hash": cert, "cert_valid": valid, "cipher": 'a "quoted"\nname',
    }
    return [row[c] for c in HOST_COLUMNS]


def sha256(name):
    done = subprocess.run(
        ["openssl", "x509", "-in", FIXTURES / f"{name}.pem", "-noout", "-fingerprint", "-sha256"],
        capture_output=True, text=True, check=True,
    )
    return done.stdout.strip().split("=")[1].replace(":", "").lower()


@pytest.fixture
def scans(tmp_path):
    root = tmp_path / "in"
    tls = root / "2023-05-30-tls"
    write_csv(
        tls / "hosts.csv", HOST_COLUMNS,
        [host(1, "192.0.2.1", "www.example.com.", sha256("san"), 1), host("x", "192.0.2.2", "b.example.com", "c", 1), [7]],
    )
    write_csv(tls / "http.csv", ["id", "Server", "Location"], [["1", "s", "https://example.org/a b"], ["2", "s", ""]])
    pem = {n: (FIXTURES / f"{n}.pem").read_text() for n in ("san", "utf8")}
    write_csv(tls / "certs.csv", ["id", "cert", "system_cert_store"], [[1, pem["san"], 0], [2, "no cert", 0], [3, pem["utf8"], 1]])
    dns = root / "2023-05-31-dns"
    write_csv(dns / "resolved-A.ipdomain", None, [["192.0.2.1", "example.com."]])
    text = "2001:db8::1,example.org\n"
    (dns / "resolved-AAAA.ipdomain.zst").write_bytes(zstandard.compress(text.encode()))
    (dns / "notes.txt").write_text("not a scan")
    undated = root / "undated"
    write_csv(undated / "resolved-A.ipdomain", None, [["192.0.2.200", "lost.example.com"]])
    return [str(tls), str(dns), str(undated)]


def test_discover(spark, scans):
    got = {(Path(r.path).name, r.kind, r.scan_date, r.source, r.type) for r in files.discover(spark, scans).collect()}
    assert got == {
        ("hosts.csv", "hosts", date(2023, 5, 30), "2023-05-30-tls", None),
        ("http.csv", "http", date(2023, 5, 30), "2023-05-30-tls", None),
        ("certs.csv", "certs", date(2023, 5, 30), "2023-05-30-tls", None),
        ("resolved-A.ipdomain", "dns", date(2023, 5, 31), "2023-05-31-dns", "A"),
        ("resolved-AAAA.ipdomain.zst", "dns", date(2023, 5, 31), "2023-05-31-dns", "AAAA"),
        ("resolved-A.ipdomain", "dns", None, "undated", "A"),
    }


def test_impossible_date(spark, tmp_path):
    folder = tmp_path / "2023-13-45-dns"
    write_csv(folder / "resolved-A.ipdomain", None, [["a", "b"]])
    with pytest.raises(Exception, match="2023-13-45"):
        files.discover(spark, [str(folder)]).collect()


def test_ingest(spark, scans, tmp_path):
    store = str(tmp_path / "store")
    counts = ingest_scans(spark, scans, store)
    assert counts == {
        "hosts": {"rows": 3, "rejected": 2},
        "http": {"rows": 2, "rejected": 0},
        "certs": {"rows": 3, "rejected": 1},
        "cert_bodies": {"rows": 2},
        "dns": {"rows": 2, "rejected": 0},
    }
    hosts = read_snapshot(spark, f"{store}/hosts").collect()
    assert [(r.id, r.ip, r.cipher, r.scan_date, r.source) for r in hosts] == [
        (1, "192.0.2.1", 'a "quoted"\nname', date(2023, 5, 30), "2023-05-30-tls")
    ]
    assert read_rejects(spark, f"{store}/hosts").count() == 2
    certs = {r.id: r for r in read_snapshot(spark, f"{store}/certs").drop("notBefore", "notAfter").collect()}
    assert certs[1].sha256 == sha256("san") and certs[1].altNames == ["www.example.com", "*.example.com"]
    assert (certs[3].numAltNames, certs[3].system_cert_store) == (0, 1)
    assert [r.payload for r in read_rejects(spark, f"{store}/certs").collect()] == ["no cert"]
    dns = {(r.type, r.ip, r.domain) for r in read_snapshot(spark, f"{store}/dns").collect()}
    assert dns == {("A", "192.0.2.1", "example.com."), ("AAAA", "2001:db8::1", "example.org")}
    assert read_snapshot(spark, f"{store}/dns", dates=["2023-05-30"]).count() == 0

    # Nothing is new now, then one more scan is.
    assert ingest_scans(spark, scans, store) == {}
    more = Path(scans[1]).parent / "2023-06-07-dns"
    write_csv(more / "resolved-A.ipdomain", None, [["192.0.2.9", "c.example.com"]])
    assert ingest_scans(spark, [*scans, str(more)], store) == {"dns": {"rows": 1, "rejected": 0}}
    assert read_snapshot(spark, f"{store}/dns").count() == 3


def test_the_same_certificates_are_parsed_once(spark, scans, tmp_path):
    store = str(tmp_path / "store")
    assert ingest_scans(spark, scans, store)["cert_bodies"] == {"rows": 2}
    tls = next(s for s in map(Path, scans) if s.name.endswith("tls"))
    later = tls.parent / "2023-07-30-tls"
    later.mkdir()
    for name in ("hosts.csv", "certs.csv"):
        (later / name).write_bytes((tls / name).read_bytes())
    counts = ingest_scans(spark, [*scans, str(later)], store)
    assert counts["certs"] == {"rows": 3, "rejected": 1} and counts["cert_bodies"] == {"rows": 0}
    both = read_snapshot(spark, f"{store}/certs").drop("notBefore", "notAfter", "scan_date", "source", "scan", "file").collect()
    assert len(both) == 4 and len({str(r) for r in both}) == 2
    assert read_rejects(spark, f"{store}/certs").count() == 2


def test_unreadable_bytes_are_corrupt(spark, tmp_path):
    folder, store = tmp_path / "2024-01-01-tls", str(tmp_path / "store")
    write_csv(folder / "hosts.csv", HOST_COLUMNS, [host(1, "192.0.2.1", "a.example.com", "c", 1)])
    pem = "-----BEGIN CERTIFICATE-----\nAAAA\n-----END CERTIFICATE-----\n"
    write_csv(folder / "certs.csv", ["id", "cert", "system_cert_store"], [[1, pem, 0], [2, pem, 0], [3, "", 0]])
    assert ingest_scans(spark, [str(folder)], store)["certs"] == {"rows": 3, "rejected": 3}
    assert sorted(r.payload for r in read_rejects(spark, f"{store}/certs").collect()) == ["", pem, pem]
    assert read_snapshot(spark, f"{store}/certs").count() == 0


def test_a_replaced_file_is_read_again(spark, tmp_path):
    folder, store = tmp_path / "2024-01-01-dns", str(tmp_path / "store")
    write_csv(folder / "resolved-A.ipdomain", None, [["192.0.2.1", "one.example.com"], ["192.0.2.2", "two.example.com"]])
    write_csv(folder / "other-A.ipdomain", None, [["192.0.2.3", "three.example.com"]])
    assert ingest_scans(spark, [str(folder)], store)["dns"]["rows"] == 3
    write_csv(folder / "resolved-A.ipdomain", None, [["192.0.2.9", "nine.example.com"]])
    assert ingest_scans(spark, [str(folder)], store)["dns"]["rows"] == 1
    assert {r.ip for r in read_snapshot(spark, f"{store}/dns").collect()} == {"192.0.2.9", "192.0.2.3"}
    assert ingest_scans(spark, [str(folder)], store) == {}


def test_certificates_parsed_elsewhere_are_ingested(spark, tmp_path):
    store = str(tmp_path / "store")
    folder = tmp_path / "2023-05-30-tls"
    write_csv(folder / "hosts.csv", HOST_COLUMNS, [host(1, "192.0.2.1", "a.example.com", "c", 1)])
    names = [c.split()[0] for c in PARSED_CERTS.split(", ")]
    row = [1, 0, "s1", "s256", "CN=a", "CN=b", "2024-01-01T10:30:00Z", "2025-01-01T00:00:00Z", "true", "false", "key", 1]
    write_csv(folder / "certs.csv", names, [[*row, '["a.example.com"]'], ["x", *row[1:], "null"]])
    assert ingest_scans(spark, [str(folder)], store)["certs"] == {"rows": 2, "rejected": 1}
    (cert,) = read_snapshot(spark, f"{store}/certs").collect()
    assert (cert.sha256, cert.altNames, cert.source) == ("s256", ["a.example.com"], "2023-05-30-tls")


def test_headers_in_one_job(spark, tmp_path):
    paths = {}
    for i in range(12):
        path = tmp_path / f"2024-01-{i + 1:02}" / "http.csv"
        write_csv(path, ["id", f"name, {i}", 'quoted "x"'] + (["two\nlines"] if i == 3 else []), [[k, "v" * 50] for k in range(500)])
        paths[f"file:{path}"] = ["id", f"name, {i}", 'quoted "x"'] + (["two\nlines"] if i == 3 else [])
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "z.csv.gz").write_bytes(gzip.compress("\ufeffa,b\n1,2\n".encode()))
    found = files.headers(spark, [*paths, str(tmp_path / "empty.csv"), str(tmp_path / "z.csv.gz")])
    assert {p.split(str(tmp_path))[1]: c for p, c in found.items()} == {
        **{p.split(str(tmp_path))[1]: c for p, c in paths.items()}, "/z.csv.gz": ["a", "b"],
    }
    tracker = spark.sparkContext.statusTracker()
    few = [p for p in paths if not p.endswith("04/http.csv")]
    jobs = []
    for some in (few[:2], few):
        group = f"headers of {len(some)}"
        spark.sparkContext.setJobGroup(group, group)
        files.headers(spark, some)
        jobs.append(len(tracker.getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]


def test_certificates_are_mandatory(spark, scans, tmp_path):
    bare = tmp_path / "in" / "2023-06-30-tls"
    write_csv(bare / "hosts.csv", HOST_COLUMNS, [host(1, "192.0.2.1", "a.example.com", "c", 1)])
    with pytest.raises(FileNotFoundError, match="2023-06-30-tls"):
        ingest_scans(spark, [*scans, str(bare)], str(tmp_path / "store"))


def test_header_must_fit(spark, tmp_path):
    path = tmp_path / "2023-05-30" / "hosts.csv"
    write_csv(path, ["ip", "id"], [["a", 1]])
    with pytest.raises(Exception, match="CSV header does not conform"):
        files.read_delimited(spark, [str(path)], "id int, ip string").collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        files.read_delimited(spark, [str(path) + ".gone"], "id int, ip string").collect()


def test_projection_does_not_change_what_is_malformed(spark, tmp_path):
    path = tmp_path / "2023-05-30" / "rows.csv"
    write_csv(path, ["id", "name"], [["x", "bad"], ["", "no id"], ["1", "good"], ["2"]])
    df = files.good_rows(files.read_delimited(spark, [str(path)], "id int, name string"))
    assert sorted(r.name for r in df.select("name").collect()) == ["good", "no id"]
    assert df.count() == 2
    bad = files.bad_rows(files.read_delimited(spark, [str(path)], "id int, name string"))
    assert sorted(r.payload.strip() for r in bad.collect()) == ["2", "x,bad"]


@pytest.mark.parametrize("suffix, pack", [("", bytes), (".gz", gzip.compress), (".zst", zstandard.compress)])
def test_compressed_text(spark, tmp_path, suffix, pack):
    folder = tmp_path / "a+b 2023-05-30"
    folder.mkdir()
    (folder / f"rows.csv{suffix}").write_bytes(pack(b'id,name\n1,"two\nlines"\n'))
    (row,) = files.read_delimited(spark, [str(folder)], "id int, name string").collect()
    assert (row.name, row.scan_date, row.source) == ("two\nlines", date(2023, 5, 30), "a+b 2023-05-30")


def test_dns_records(spark, tmp_path):
    folder = tmp_path / "2023-05-30-json"
    folder.mkdir()

    def record(name, *answers):
        listed = [dict(zip(("name", "type", "data"), a.split(" "))) for a in answers]
        return json.dumps({"name": name, "data": {"answers": listed}})

    lines = [
        record("a.", "a. CNAME b.", "b. A 1.1.1.1", "a. TXT t"),
        '{"name": "b."}', '{"name": "c.", "data": {}}', "no json", '{"data": {"answers": []}}',
    ]
    (folder / "out.json").write_text("\n".join(lines))
    store = str(tmp_path / "store")
    counts = ingest_dns_records(spark, [str(folder)], store)
    assert counts["dns"]["rows"] == 2 and counts["dns_errors"]["rows"] == 3
    dns = read_snapshot(spark, f"{store}/dns")
    assert {(r.ip, r.domain, r.type, str(r.scan_date)) for r in dns.collect()} == {
        ("1.1.1.1", "a", "A", "2023-05-30"), ("1.1.1.1", "b", "A", "2023-05-30"),
    }
    errors = read_snapshot(spark, f"{store}/dns_errors")
    assert {r.reason for r in errors.collect()} == {"malformed line", "no name", "unknown type"}
    assert ingest_dns_records(spark, [str(folder)], store) == {}

    later = tmp_path / "2023-06-30-json"
    later.mkdir()
    (later / "out.json").write_text(record("d.", "d. AAAA ::1"))
    assert ingest_dns_records(spark, [str(folder), str(later)], store)["dns"]["rows"] == 1
    assert dns.sparkSession.read.parquet(f"{store}/dns").count() == 3


def test_pending_without_a_table(spark, scans, tmp_path):
    found = files.discover(spark, scans)
    assert pending(found, str(tmp_path / "none")).count() == found.count()


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_run(spark, scans, rules, tmp_path, kind):
    out = str(tmp_path / "out")
    tables = run(spark, scans, str(tmp_path / "store"), out, kind=kind, rules=rules)
    domains = {r.domain_name for r in tables["domains"].collect()}
    assert domains == {"www.example.com", "*.example.com", "example.com", "example.org"}
    assert tables["redirects"].count() == 1
    found = spark.read.parquet(f"{out}/domains") if kind == "parquet" else spark.read.csv(f"{out}/domains/rows")
    assert found.count() == 4


def test_unknown_output(spark, tmp_path):
    with pytest.raises(ValueError):
        write_graph_table(spark.range(1), str(tmp_path / "x"), kind="orc")
    write_graph_table(spark.range(4), str(tmp_path / "y"), partitions=2)
    write_graph_table(spark.range(9), str(tmp_path / "y"), resume=True)
    assert spark.read.parquet(str(tmp_path / "y")).count() == 4


def test_scans_of_different_age(spark, scans, rules, tmp_path):
    older = tmp_path / "in" / "2022-01-01-tls"
    write_csv(older / "hosts.csv", HOST_COLUMNS, [host(1, "192.0.2.1", "www.example.com", sha256("san"), 0)])
    write_csv(older / "http.csv", ["id", "Location"], [["1", "https://old.example.org/"]])
    write_csv(older / "certs.csv", ["system_cert_store", "cert"], [[0, (FIXTURES / "san.pem").read_text()]])
    store = str(tmp_path / "store")
    # No DNS scan at all, and two layouts of the other files.
    tables = run(spark, [scans[0], str(older)], store, str(tmp_path / "out"), rules=rules)
    assert read_snapshot(spark, f"{store}/http", "id string, Server string").count() == 3
    assert tables["redirects"].count() == 2 and tables["ip_addresses"].count() == 1
    (row,) = tables["returns"].collect()
    assert (len(row.scan_dates), row.valid) == (2, True)
    one = run(spark, [], store, str(tmp_path / "one"), rules=rules, dates=["2022-01-01"])
    assert one["redirects"].count() == 1 and one["returns"].first().valid is False


def test_parsed_certificates(spark, tmp_path):
    path = tmp_path / "2023-05-30-tls" / "parsed.csv"
    names = [c.split()[0] for c in PARSED_CERTS.split(", ")]
    row = [1, 0, "s1", "s256", "CN=a", "CN=b", "2024-01-01T10:30:00Z", "0001-01-01T00:00:00Z", "true", "false", "key", 1]
    write_csv(path, names, [[*row, '["a.example.com"]'], [*row, "null"], ["x", *row[1:], "null"]])
    got = files.good_rows(files.read_parsed_certs(spark, [str(path)]))
    stamps = {c: F.col(c).cast("string") for c in ("notBefore", "notAfter")}
    one, two = got.withColumns(stamps).collect()
    assert (one.altNames, two.altNames) == (["a.example.com"], None)
    assert (one.notBefore, one.isCa, one.basicConstraints) == ("2024-01-01 10:30:00", False, True)
    write_csv(path, names[:-1], [row])
    with pytest.raises(Exception, match="header"):
        files.read_parsed_certs(spark, [str(path)]).collect()


def test_a_late_file_and_equal_folder_names_lose_nothing(spark, tmp_path):
    store = str(tmp_path / "store")
    first, second = (tmp_path / x / "2024-01-01-dns" for x in "ab")
    write_csv(first / "resolved-A.ipdomain", None, [["192.0.2.1", "one.example.com"]])
    assert ingest_scans(spark, [str(first)], store)["dns"]["rows"] == 1
    write_csv(first / "late-A.ipdomain", None, [["192.0.2.2", "two.example.com"]])
    write_csv(second / "resolved-A.ipdomain", None, [["192.0.2.3", "three.example.com"]])
    both = [str(first), str(second)]
    assert ingest_scans(spark, both, store)["dns"]["rows"] == 2
    assert ingest_scans(spark, both, store) == {}
    rows = read_snapshot(spark, f"{store}/dns").collect()
    assert {r.ip for r in rows} == {"192.0.2.1", "192.0.2.2", "192.0.2.3"} and len({r.scan for r in rows}) == 2


def test_header_layouts_in_one_folder_and_a_folder_that_looks_like_a_number(spark, tmp_path):
    store = str(tmp_path / "store")
    folder = tmp_path / "2024-01-01" / "007"
    write_csv(folder / "hosts.csv", HOST_COLUMNS, [host(1, "192.0.2.1", "a.example.com", "c", 1)])
    write_csv(folder / "certs.csv", ["id", "cert", "system_cert_store"], [[1, "no cert", 0]])
    write_csv(folder / "http.csv", ["id", "Location"], [["1", "/x"]])
    folder.joinpath("http.csv.gz").write_bytes(gzip.compress(b"id,Server,Location\n2,s,/y\n"))
    assert ingest_scans(spark, [str(folder)], store)["http"]["rows"] == 2
    rows = read_snapshot(spark, f"{store}/http", "id string, Location string").collect()
    assert {(r.id, r.Location, r.source) for r in rows} == {("1", "/x", "007"), ("2", "/y", "007")}
    assert {r.source for r in read_snapshot(spark, f"{store}/hosts").collect()} == {"007"}
    assert ingest_scans(spark, [str(folder)], store) == {}


def test_dns_origins_stand_beside_each_other_and_a_broken_run_is_repeated(spark, tmp_path, monkeypatch):
    from scanweave.sources import snapshots

    store, folder = str(tmp_path / "store"), tmp_path / "2024-01-01" / "007"
    write_csv(folder / "resolved-A.ipdomain", None, [["192.0.2.1", "a.example.com"], ["only one field"]])
    assert ingest_scans(spark, [str(folder)], store)["dns"] == {"rows": 2, "rejected": 1}
    answers = [{"name": "b.", "type": "A", "data": "192.0.2.2"}]
    folder.joinpath("out.json").write_text(json.dumps({"name": "b.", "data": {"answers": answers}}))
    write = snapshots.write_snapshot

    def dies(rows, table, *by):
        if table.endswith("/dns"):
            raise RuntimeError("gone")
        return write(rows, table, *by)

    records = [str(folder / "out.json")]
    monkeypatch.setattr(snapshots, "write_snapshot", dies)
    with pytest.raises(RuntimeError, match="gone"):
        ingest_dns_records(spark, records, store)
    monkeypatch.undo()
    assert ingest_dns_records(spark, records, store)["dns"]["rows"] == 1
    assert ingest_dns_records(spark, records, store) == {}
    assert {r.ip for r in read_snapshot(spark, f"{store}/dns").collect()} == {"192.0.2.1", "192.0.2.2"}
    assert read_rejects(spark, f"{store}/dns").count() == 1


def test_exports_keep_blanks(spark, tmp_path):
    from scanweave.sinks.graph import export_csv

    texts = ["  lead and trail  ", "", " ", 'a "b", c']
    export_csv(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, name string"), str(tmp_path))
    options = {"quote": '"', "escape": '"', "emptyValue": ""}
    back = spark.read.schema("id long, name string").csv(f"{tmp_path}/rows", **options)
    assert {r.id: r.name or "" for r in back.collect()} == dict(enumerate(texts))


def test_names_in_paths(spark):
    from scanweave.sources.files import record_type, source_name

    paths = ["file:/a/2024-01-02-dns/resolved-AAAA.x", "/AAAA/x", "/x", "x", "/a//x", "b/x-A", "/a/b/", ""]
    rows = spark.createDataFrame([(p,) for p in paths], "p string")
    got = rows.select("p", source_name(F.col("p")).alias("s"), record_type(F.col("p")).alias("t")).collect()
    assert [(r.s, r.t) for r in got] == [
        ("2024-01-02-dns", "AAAA"), ("AAAA", "A"), ("", "A"), ("", "A"), ("", "A"), ("b", "A"), ("b", "A"), ("", "A")
    ]
    # Rows take these from their path: nothing there may search from every place of it.
    shown = rows.select(source_name(F.col("p")), record_type(F.col("p")))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in shown


def test_headers_of_long_files(spark, tmp_path):
    from scanweave.sources import files

    for name, header in (("a", "id,Location"), ("b", '"x, y",z'), ("c", "only")):
        (tmp_path / f"{name}.csv").write_text("\n".join([header, *(f"{i},v" for i in range(5000))]) + "\n")
    paths = [f"file:{tmp_path}/{n}.csv" for n in "abc"]
    want = {"a": ["id", "Location"], "b": ["x, y", "z"], "c": ["only"]}
    assert {p[-5]: names for p, names in files.headers(spark, paths).items()} == want
