"""Certificate attributes, against values printed by the openssl command line."""

import base64
import hashlib
import re
import subprocess
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from scanweave.operators.certs import name_text, parse_certificates, parsed, rejected, with_certificate
from scanweave.operators.x509 import arranged

FIXTURES = Path(__file__).parent / "fixtures"


def pem(name):
    return (FIXTURES / f"{name}.pem").read_text()


def parse(spark, texts):
    rows = [(i, t, i % 2) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "id int, cert string, system_cert_store int")
    text = {c: F.col(c).cast("string") for c in ("notBefore", "notAfter")}
    return {r.id: r for r in parse_certificates(df).withColumns(text).collect()}


def openssl(text, *options):
    done = subprocess.run(
        ["openssl", "x509", "-noout", *options], input=text, text=True, capture_output=True, check=True
    )
    return done.stdout.strip()


def stamp(text, option):
    value = openssl(text, option).split("=", 1)[1]
    return datetime.strptime(value, "%b %d %H:%M:%S %Y GMT").strftime("%Y-%m-%d %H:%M:%S")


def test_names_and_alternative_names(spark):
    got = parse(spark, [pem("san"), pem("utf8"), pem("cr"), pem("iponly")])
    assert got[0].subject == 'CN=www.example.com,ST=Some\\, State,OU=one+OU=two,O=A\\+B \\"Corp\\",C=US'
    assert got[0].altNames == ["www.example.com", "*.example.com"]
    assert (got[0].numAltNames, got[0].isCa, got[0].basicConstraints) == (2, True, True)
    # Unknown attributes come last, in reverse, as the DER of their value.
    assert got[1].subject == (
        "CN=\\#1 host\\ ,L=Köln,O=Bücher,C=DE,0.9.2342.19200300.100.1.25=#13076578616d706c65,"
        "1.2.840.113549.1.9.1=#0c076140622e636f6d"
    )
    assert (got[1].isCa, got[1].altNames, got[1].numAltNames) == (False, None, 0)
    assert got[2].subject == "CN=a\\rb,O=x"
    assert got[2].subject == got[2].issuer
    assert got[3].altNames is None
    assert (got[3].notBefore, got[3].notAfter) == ("2049-01-01 00:00:00", "2060-01-01 00:00:00")
    assert got[1].system_cert_store == 1


def test_roots_agree_with_openssl(spark):
    texts = re.findall(r"-----BEGIN.*?END CERTIFICATE-----\n", pem("roots"), re.S)
    got = parse(spark, texts)
    assert len(texts) == len(got) == 12
    for i, text in enumerate(texts):
        der = base64.b64decode("".join(text.splitlines()[1:-1]))
        assert got[i].sha1 == hashlib.sha1(der).hexdigest()
        assert got[i].sha256 == hashlib.sha256(der).hexdigest()
        key = base64.b64decode("".join(openssl(text, "-pubkey").splitlines()[1:-1]))
        assert got[i].sha256PubKey == hashlib.sha256(key).hexdigest()
        assert got[i].notBefore == stamp(text, "-startdate")
        assert got[i].notAfter == stamp(text, "-enddate")
        assert got[i].isCa is True
        theirs = openssl(text, "-subject", "-nameopt", "RFC2253,-esc_msb").split("=", 1)[1]
        known = {p for p in re.split(r"(?<!\\),", got[i].subject) if "=#" not in p}
        # Ours groups attributes by kind: compare them as a set.
        assert {p for k in known for p in re.split(r"(?<!\\)\+(?=OU=)", k)} <= set(
            re.split(r"(?<!\\),", theirs.replace("serialNumber=", "SERIALNUMBER="))
        )


def bad_rows():
    good = pem("iponly")
    lines = good.splitlines()
    body = "".join(lines[1:-1])
    cut = base64.b64encode(base64.b64decode(body)[:-10]).decode()
    longer = base64.b64encode(base64.b64decode(body) + b"\0").decode()
    wrap = "-----BEGIN CERTIFICATE-----\n{}\n-----END CERTIFICATE-----\n".format
    return [
        None,
        "",
        "no pem at all",
        good.replace("CERTIFICATE", "PRIVATE KEY"),
        good.replace(lines[0], lines[0] + "\nProc-Type: 4,ENCRYPTED\n"),
        wrap(cut),
        wrap(longer),
        wrap(body[:-3]),
        wrap("!!!!"),
        wrap(""),
        good.replace("END CERTIFICATE", "END OTHER"),
    ]


@pytest.mark.parametrize("prefix", ["", "text before\n"])
def test_bad_rows_are_kept_apart(spark, prefix):
    texts = [*bad_rows(), prefix + pem("san"), "-----BEGIN X-----\n!\n-----END X-----\n" + pem("cr")]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, cert string")
    annotated = with_certificate(df)
    good = len(bad_rows())
    assert sorted(r.id for r in parsed(annotated).select("id").collect()) == [good, good + 1]
    assert rejected(annotated).count() == good
    assert "cert" not in annotated.columns


def test_python_sees_each_row_once(spark):
    df = spark.createDataFrame([(1, pem("san"))], "id int, cert string")
    plan = parse_certificates(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    # Two calls (kind and body of the blocks), not two per use of the result.
    assert plan.count("regexp_extract_all") == 2


def test_name_text(spark):
    cases = {
        (("2.5.4.3", " "),): "CN=\\ ",
        (("2.5.4.3", "  "),): "CN=\\ \\ ",
        (("2.5.4.3", "#a;b\\c "),): "CN=\\#a\\;b\\\\c\\ ",
        (("2.5.4.3", "first"), ("2.5.4.3", "last")): "CN=last",
        (("2.5.4.3", ""), ("2.5.4.5", "7")): "SERIALNUMBER=7",
        (("2.5.4.10", ""), ("2.5.4.6", "US")): "O=,C=US",
        (("1.2.3", "a"), ("1.2.4", "*"), ("2.5.4.6", "US")): "C=US,1.2.4=#0c012a,1.2.3=#130161",
        (("1.2.3", "x" * 130),): "1.2.3=#138182" + "78" * 130,
        (("1.2.3", "é" * 150),): "1.2.3=#0c82012c" + "c3a9" * 150,
        (("1.2.3", "x" * 70000),): "1.2.3=#1383011170" + "78" * 70000,
        (("2.5.4.3", "é "),): "CN=é\\ ",
        (): "",
    }
    rows = [(i, arranged(list(case))) for i, case in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, name array<struct<sep: string, label: string, text: string>>")
    got = {r.i: r.t for r in df.select("i", name_text(F.col("name")).alias("t")).collect()}
    assert list(cases.values()) == [got[i] for i in range(len(cases))]
