"""Certificates: DER built for every customer as hex text, then parsed."""

from pyspark.sql import functions as F

from scanweave.operators.certs import parse_certificates

from .base import table

# A value is a list of (SQL text or None, hex) pieces and its length in bytes. Fields
# have a fixed width, so all lengths are known before any row is.


def _bytes(hex_text):
    return [(None, hex_text)], len(hex_text) // 2


def _field(sql, width):
    return [(sql, None)], width


def _tlv(tag, *values):
    pieces = [p for v, _ in values for p in v]
    size = sum(n for _, n in values)
    head = f"{tag:02X}" + (f"{size:02X}" if size < 128 else f"82{size:04X}")
    return [(None, head), *pieces], len(head) // 2 + size


def _attribute(oid, tag, value):
    return _tlv(0x31, _tlv(0x30, _bytes("0603" + oid), _tlv(tag, value)))


def _algorithm():
    return _tlv(0x30, _bytes("06082A8648CE3D040302"))


_NATION = "lpad(CAST(c_nationkey AS VARCHAR(3)), 2, '0')"
_SEGMENT = "rpad(c_mktsegment, 12, 'x')"
_KEY = "lpad(CAST(c_custkey AS VARCHAR(9)), 9, '0')"
_DAY = "concat(lpad(CAST(1 + c_custkey % 12 AS VARCHAR(2)), 2, '0'), lpad(CAST(1 + c_custkey % 28 AS VARCHAR(2)), 2, '0'))"
_C, _O, _CN, _OU = "550406", "55040A", "550403", "55040B"

_SUBJECT = _tlv(
    0x30,
    _attribute(_C, 0x13, _field(_NATION, 2)),
    _attribute(_O, 0x0C, _field(f"concat({_SEGMENT}, ', Inc')", 17)),
    _attribute(_OU, 0x0C, _field(_NATION, 2)),
    _attribute(_OU, 0x0C, _field("'Öl'", 3)),
    _attribute(_CN, 0x0C, _field("c_name", 18)),
)
_ISSUER = _tlv(0x30, _attribute(_CN, 0x13, _field(f"concat('CA ', {_NATION})", 5)))
_SPKI = _tlv(0x30, _algorithm(), _tlv(0x03, _bytes("00"), _field(_KEY, 9)))
_ALT_NAMES = _tlv(
    0x30,
    _tlv(0x82, _field(f"concat('w', {_KEY}, '.example.com')", 22)),
    _tlv(0x87, _bytes("C0000201")),
    _tlv(0x82, _field(f"concat('*.n', {_NATION}, '.example.org')", 17)),
)
_EXTENSIONS = _tlv(
    0xA3,
    _tlv(
        0x30,
        _tlv(0x30, _bytes("0603551D13"), _bytes("0101FF"), _tlv(0x04, _bytes("30030101FF"))),
        _tlv(0x30, _bytes("0603551D11"), _tlv(0x04, _ALT_NAMES)),
    ),
)
_TBS = _tlv(
    0x30,
    _bytes("A003020102"),
    _bytes("020101"),
    _algorithm(),
    _ISSUER,
    _tlv(
        0x30,
        _tlv(0x17, _field(f"concat('24', {_DAY}, '103000Z')", 13)),
        _tlv(0x18, _field(f"concat('2050', {_DAY}, '103000Z')", 15)),
    ),
    _SUBJECT,
    _SPKI,
    _EXTENSIONS,
)
_CERT = _tlv(0x30, _TBS, _algorithm(), _bytes("03020000"))


def _hex_sql(value):
    """One SQL text for both engines; neighbouring constants are joined."""
    out, constant = [], ""
    for sql, fixed in value[0]:
        if fixed is not None:
            constant += fixed
            continue
        out += [f"'{constant}'", f"hex({sql})"]
        constant = ""
    return f"concat({', '.join(out)}, '{constant}')"


# Every tenth certificate is cut short, every eleventh is another kind of block.
_CUT, _OTHER = "c_custkey % 10 = 3", "c_custkey % 11 = 4"


def cert_table(spark, folder):
    rows = table(spark, folder, "customer").selectExpr(
        "CAST(c_custkey AS INT) AS id",
        "CAST(c_custkey % 2 AS INT) AS system_cert_store",
        f"CASE WHEN {_OTHER} THEN 'PUBLIC KEY' ELSE 'CERTIFICATE' END AS kind",
        f"CASE WHEN {_CUT} THEN substr({_hex_sql(_CERT)}, 1, 400) ELSE {_hex_sql(_CERT)} END AS der",
    )
    body = F.regexp_replace(F.base64(F.unhex("der")), r"(.{64})", "$1\n")
    pem = F.concat(
        F.lit("-----BEGIN "), "kind", F.lit("-----\n"), body, F.lit("\n-----END "), "kind", F.lit("-----\n")
    )
    parsed = parse_certificates(rows.select("id", pem.alias("cert"), "system_cert_store"))
    return parsed.withColumns(
        {
            c: F.date_format(F.to_utc_timestamp(c, F.current_timezone()), "yyyy-MM-dd HH:mm:ss")
            for c in ("notBefore", "notAfter")
        }
    ).withColumns(
        {
            "altNames": F.concat_ws(";", "altNames"),
        }
    )


_DASHED_DAY = f"concat(substr({_DAY}, 1, 2), '-', substr({_DAY}, 3, 2), ' 10:30:00')"

CATALOG = {
    "cert_table": (
        cert_table,
        f"""SELECT CAST(c_custkey AS INT) AS id, CAST(c_custkey % 2 AS INT) AS system_cert_store,
          sha1(unhex({_hex_sql(_CERT)})) AS sha1, sha256(unhex({_hex_sql(_CERT)})) AS sha256,
          concat('CN=', c_name, ',OU=', {_NATION}, '+OU=Öl,O=', {_SEGMENT}, '\\, Inc,C=', {_NATION}) AS subject,
          concat('CN=CA ', {_NATION}) AS issuer,
          concat('2024-', {_DASHED_DAY}) AS "notBefore", concat('2050-', {_DASHED_DAY}) AS "notAfter",
          true AS "basicConstraints", true AS "isCa",
          sha256(unhex({_hex_sql(_SPKI)})) AS "sha256PubKey", CAST(2 AS INT) AS "numAltNames",
          concat('w', {_KEY}, '.example.com;*.n', {_NATION}, '.example.org') AS "altNames"
        FROM customer WHERE NOT ({_CUT}) AND NOT ({_OTHER})""",
    ),
}
