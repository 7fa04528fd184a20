"""The small hand-made graph, from scan files to all eleven tables."""

import csv
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from scanweave.plans.graph import EDGES, VERTICES, build_graph, read_counters
from scanweave.sinks.graph import export_csv, graph_header

D1, D2 = "2023-05-30", "2023-06-06"
C1, C2 = "1" * 64, "2" * 64


@pytest.fixture(scope="module")
def scans(spark):
    hosts = [
        (D1, "tls", 1, "192.0.2.1", "www.example.co.uk.", C1, 1),
        (D1, "tls", 2, "192.0.2.2", "example.org", C2, 0),
        (D1, "tls", 3, "192.0.2.3", None, C2, None),
        (D2, "tls", 1, "192.0.2.1", "www.example.co.uk", C1, 0),
    ]
    http = [
        (D1, "tls", "1", "https://example.org/a b?x=%41"),
        (D1, "tls", "2", "/relative"),
        (D1, "tls", "no number", "https://example.org/"),
        (D1, "other", "2", "https://example.org/other"),
        (D2, "tls", "1", None),
    ]
    names = {C1: ["www.example.co.uk", "*.example.co.uk", "192.0.2.9"], C2: None, "3" * 10: ["dropped.example.org"]}
    certs = [("tls", h, f"sha1 of {h[0]}", f"CN={h[0]}", "CN=ca", n and len(n) or 0, n) for h, n in names.items()]
    dns = [
        (D1, "A", "192.0.2.1", "example.co.uk."),
        (D2, "AAAA", "2001:db8::1", "example.org"),
        (D2, "A", "not-an-ip", "example.org"),
        (D2, "A", "192.0.2.7", "co.uk"),
    ]
    date_ = F.to_date("scan_date").alias("scan_date")

    def frame(rows, ddl):
        df = spark.createDataFrame(rows, ddl)
        return df.withColumn("scan_date", F.to_date("scan_date")) if "scan_date" in df.columns else df

    certs = frame(certs, "source string, sha256 string, sha1 string, subject string, issuer string, numAltNames int, altNames array<string>")
    stamp = F.lit("2023-01-01").cast("timestamp")
    return {
        "hosts": frame(hosts, "scan_date string, source string, id int, ip string, server_name string, cert_hash string, cert_valid int"),
        "http": frame(http, "scan_date string, source string, id string, Location string"),
        "certs": certs.withColumns({"notBefore": stamp, "notAfter": stamp}),
        "dns": frame(dns, "scan_date string, type string, ip string, domain string"),
    }


@pytest.fixture(scope="module")
def graph(spark, scans, rules, tmp_path_factory):
    return build_graph(**scans, out=str(tmp_path_factory.mktemp("graph")), rules=rules)


def labels(graph):
    names = {}
    for table, column in zip(VERTICES, ("sha256", "domain_name", "ip")):
        names |= {r.id: r[column] for r in graph[table].collect()}
    return names


def edges(graph, table):
    names = labels(graph)
    out = {}
    for r in graph[table].collect():
        row = r.asDict()
        key = (names[row.pop("src")], names[row.pop("dst")])
        assert key not in out
        out[key] = tuple(row.values())
    return out


def days(*texts):
    return [date.fromisoformat(t) for t in texts]


def test_vertices(graph):
    assert {r.domain_name for r in graph["domains"].collect()} == {
        "www.example.co.uk", "example.co.uk", "*.example.co.uk", "example.org",
    }
    assert {r.ip for r in graph["ip_addresses"].collect()} == {
        "192.0.2.1", "192.0.2.2", "192.0.2.3", "192.0.2.7", "192.0.2.9", "2001:db8::1",
    }
    assert {r.sha256 for r in graph["certs"].collect()} == {C1, C2}
    assert graph["certs"].columns == [
        "id", "sha1", "sha256", "subject", "issuer", "notBefore", "notAfter", "numAltNames", "inDegree", "outDegree",
    ]
    assert sorted(labels(graph)) == list(range(12))


def test_edges(graph):
    assert edges(graph, "returns") == {
        ("192.0.2.1", C1): (days(D1, D2), ["www.example.co.uk"], True),
        ("192.0.2.2", C2): (days(D1), ["example.org"], False),
        ("192.0.2.3", C2): (days(D1), [], None),
    }
    assert edges(graph, "resolves") == {
        ("www.example.co.uk", "192.0.2.1"): (days(D1, D2), True),
        ("example.org", "192.0.2.2"): (days(D1), False),
        ("example.co.uk", "192.0.2.1"): (days(D1), None),
        ("example.org", "2001:db8::1"): (days(D2), None),
    }
    assert set(edges(graph, "contains")) == {
        (C1, "www.example.co.uk"), (C1, "*.example.co.uk"), (C1, "192.0.2.9"),
    }
    assert edges(graph, "redirects") == {
        ("www.example.co.uk", "example.org"): (days(D1), True, ["https://example.org/a%20b?x=%2541"]),
    }
    assert set(edges(graph, "subdomain_of")) == {
        ("www.example.co.uk", "example.co.uk"), ("*.example.co.uk", "example.co.uk"),
    }
    assert set(edges(graph, "subject_to")) == {(b, a) for a, b in edges(graph, "contains")}
    assert edges(graph, "assigned_to") == {(C1, "192.0.2.1"): (days(D1, D2),)}
    assert edges(graph, "serves") == {("192.0.2.1", "www.example.co.uk"): (days(D1, D2),)}


def test_degrees(graph):
    got = {}
    for table, column in zip(VERTICES, ("sha256", "domain_name", "ip")):
        got |= {r[column]: (r.inDegree, r.outDegree) for r in graph[table].collect()}
    assert got == {
        C1: (4, 4), C2: (2, None), "*.example.co.uk": (1, 2), "example.co.uk": (2, 1),
        "example.org": (1, 2), "www.example.co.uk": (2, 4), "192.0.2.1": (3, 2),
        "192.0.2.2": (1, 1), "192.0.2.3": (None, 1), "192.0.2.7": (None, None),
        "192.0.2.9": (1, 1), "2001:db8::1": (1, None),
    }


def test_schemas(graph):
    for name in EDGES:
        fields = {f.name: f.dataType.simpleString() for f in graph[name].schema}
        assert (fields["src"], fields["dst"]) == ("bigint", "bigint")
    assert graph["returns"].columns == ["src", "dst", "scan_dates", "server_name_indicators", "valid"]
    assert graph["redirects"].columns == ["src", "dst", "scan_dates", "valid", "locations"]
    assert graph["assigned_to"].columns == ["src", "dst", "scan_dates"]
    assert graph["contains"].columns == ["src", "dst"]


def test_sources_can_match_each_other(spark, scans, rules, tmp_path):
    loose = build_graph(**scans, out=str(tmp_path), rules=rules, match_source=False)
    assert set(edges(loose, "redirects")) == {
        ("www.example.co.uk", "example.org"), ("example.org", "example.org"),
    }


def texts_of(tables):
    return {n: sorted(map(str, t.collect())) for n, t in tables.items()}


def written(spark, folder):
    files = spark.read.format("binaryFile").load(f"{folder}/*").where("path NOT LIKE '%/counters/%'")
    return {r.path for r in files.select("path").collect() if "part-" in r.path}


def test_resume_looks_at_its_input(spark, scans, rules, tmp_path):
    store = {n: t.write.parquet(str(tmp_path / n)) or spark.read.parquet(str(tmp_path / n)) for n, t in scans.items()}
    folders = {"out": str(tmp_path / "out"), "work": str(tmp_path / "work")}
    first = texts_of(build_graph(**store, **folders, rules=rules))
    steps, tables = written(spark, folders["work"]), written(spark, folders["out"])
    assert texts_of(build_graph(**store, **folders, rules=rules, resume=True)) == first
    assert written(spark, folders["work"]) == steps and written(spark, folders["out"]) == tables
    # One more DNS scan: what does not depend on it stays, the graph is the new one.
    scans["dns"].selectExpr("concat('new.', domain) AS domain", "ip", "scan_date").write.mode("append").parquet(str(tmp_path / "dns"))
    store["dns"] = spark.read.parquet(str(tmp_path / "dns"))
    again = texts_of(build_graph(**store, **folders, rules=rules, resume=True))
    assert again == texts_of(build_graph(**store, out=str(tmp_path / "fresh"), rules=rules)) != first
    kept = {p.split("/")[-2] for p in written(spark, folders["work"]) & steps}
    assert kept >= {"alt_names", "redirect_hosts", "returns_keys"} and not kept & {"resolves_keys", "ids"}
    nothing = {n: t.limit(0) for n, t in scans.items()}
    assert not any(texts_of(build_graph(**nothing, **folders, rules=rules, resume=True)).values())


def test_layout_and_members_do_not_change_the_graph(spark, scans, rules, graph, tmp_path):
    plain = texts_of(graph)
    for k, options in enumerate(({"cluster": False}, {"partitions": 3}, {"members": True})):
        tables = build_graph(**scans, out=str(tmp_path / str(k)), rules=rules, **options)
        assert texts_of(tables) == plain
    members = spark.read.parquet(str(tmp_path / "2" / "returns_members"))
    lists = graph["returns"].selectExpr("src", "dst", "explode(server_name_indicators) AS server_name_indicator", "valid")
    assert members.columns == lists.columns
    assert {tuple(r)[:3] for r in members.collect()} == {tuple(r)[:3] for r in lists.collect()}
    moved = spark.read.parquet(str(tmp_path / "2" / "redirects_members"))
    assert moved.columns == ["src", "dst", "location", "valid"] and moved.count() == 1


def test_counters(spark, scans, rules, tmp_path):
    tables = build_graph(**scans, out=str(tmp_path), rules=rules)
    counted = dict(map(tuple, read_counters(spark, str(tmp_path)).collect()))
    names = {"domains": "domains_table", "ip_addresses": "ip_addresses_table"}
    assert {n: counted[names.get(n, n)] for n in tables} == {n: t.count() for n, t in tables.items()}
    assert counted["ids"] == counted["numbered"] == 12 and counted["returns_keys"] == 3


def test_steps_are_small(spark, scans, rules, tmp_path):
    build_graph(**scans, out=str(tmp_path / "out"), work=str(tmp_path / "work"), rules=rules)
    keys = spark.read.parquet(str(tmp_path / "work" / "returns_keys"))
    assert {len(r.to) for r in keys.collect()} == {35} and keys.count() == 3
    files = written(spark, str(tmp_path / "work")) | written(spark, str(tmp_path / "out"))
    assert files and all(".zstd." in f for f in files)


def read_export(path):
    rows = []
    for part in sorted(Path(path, "rows").glob("part-*")):
        with open(part, newline="") as text:
            rows += list(csv.reader(text))
    (header,) = Path(path, "header").glob("part-*")
    return header.read_text().strip().split(","), rows


def test_export(graph, tmp_path):
    export_csv(graph["returns"], str(tmp_path / "returns"))
    header, rows = read_export(tmp_path / "returns")
    assert header == [":START_ID", ":END_ID", "scan_date:date[]", "server_name_indicators:string[]", "valid:boolean"]
    names = {str(k): v for k, v in labels(graph).items()}
    got = {(names[a], names[b]): rest for a, b, *rest in rows}
    assert got[("192.0.2.1", C1)] == [f"{D1};{D2}", "www.example.co.uk", "true"]
    assert got[("192.0.2.3", C2)] == [D1, "", ""]


def test_header():
    assert graph_header(["id", "sha256", "notBefore", "numAltNames", "inDegree", "outDegree"]) == [
        ":ID", "sha256", "notBefore", "numAltNames:int", "inDegree:int", "outDegree:int",
    ]
    assert graph_header(["scan_date", "isCa", "basicConstraints", "locations"]) == [
        "scan_date:date", "isCa:boolean", "basicConstraints:boolean", "locations:string[]",
    ]


def test_steps_go_once_they_are_read(spark, scans, rules, graph, tmp_path, monkeypatch):
    from scanweave.plans import graph as plan

    released, release = [], plan.release_steps
    monkeypatch.setattr(plan, "scratch_dir", lambda spark, label: str(tmp_path / "work"))
    monkeypatch.setattr(plan, "release_steps", lambda spark: (released.append(1), release(spark)))
    for k, options in enumerate(({}, {"members": True})):
        tables = build_graph(**scans, out=str(tmp_path / str(k)), rules=rules, **options)
        assert texts_of(tables) == texts_of(graph)
        assert not [p for p in (tmp_path / "work").rglob("part-*")]
    assert len(released) > 30  # before every step


def test_some_redirects(spark, scans, monkeypatch):
    from scanweave.plans import graph as plan

    hosts = scans["hosts"].where("id = 1")
    http = scans["http"].withColumn("redirect_host", F.lit("example.org"))
    every = sorted(map(str, plan.redirect_observations(http, hosts).collect()))
    assert every and set(map(str, plan._some_redirects(http, hosts, match_source=True).collect())) <= set(every)
    monkeypatch.setattr(plan, "_SEEN", 1)
    assert sorted(map(str, plan._some_redirects(http, hosts, match_source=True).collect())) == every
