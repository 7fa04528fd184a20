"""PEM text to certificate attributes."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import from_arrow_type

from .x509 import fields

_NAME = pa.list_(
    pa.struct([("sep", pa.string()), ("label", pa.string()), ("text", pa.string())])
)
_ARROW = pa.struct(
    [
        ("subject", _NAME),
        ("issuer", _NAME),
        ("notBefore", pa.timestamp("us", "UTC")),
        ("notAfter", pa.timestamp("us", "UTC")),
        ("basicConstraints", pa.bool_()),
        ("isCa", pa.bool_()),
        ("publicKey", pa.binary()),
        ("altNames", pa.list_(pa.string())),
    ]
)

_BLOCK = r"(?ms)^-----BEGIN ([^\n]*?)-----[ \t\r]*\n(.*?)^-----END \1-----[ \t\r]*$"


def _parse(der: pa.Array) -> pa.Array:
    return pa.array([fields(v) if v is not None else None for v in der.to_pylist()], _ARROW)


# Called non-deterministic so that a filter on its result is not pushed below it,
# where it would run a second time.
_fields = F.arrow_udf(_parse, from_arrow_type(_ARROW)).asNondeterministic()


def _first_block(pem: Column) -> Column:
    """First PEM block that can be decoded, as ``(kind, headers, der)``."""
    blocks = F.arrays_zip(
        F.regexp_extract_all(pem, F.lit(_BLOCK), 1).alias("kind"),
        F.regexp_extract_all(pem, F.lit(_BLOCK), 2).alias("body"),
    )
    opened = F.transform(
        blocks,
        lambda b: F.struct(
            b["kind"].alias("kind"),
            b["body"].contains(":").alias("headers"),
            F.try_to_binary(F.regexp_replace(b["body"], r"\s", ""), F.lit("base64")).alias("der"),
        ),
    )
    return F.get(F.filter(opened, lambda b: b["headers"] | b["der"].isNotNull()), F.lit(0))


def _escaped(text: Column) -> Column:
    return F.regexp_replace(text, r'([,+"\\<>;]|\A[ #]|(?!\A) \z)', r"\\$1")


def _der_string(text: Column) -> Column:
    """Hex of a text as a DER string, printable if its characters allow it."""
    size = F.octet_length(text)
    plain = text.rlike(r"\A[A-Za-z0-9 '()+,\-./:=?]*\z")
    length = (
        F.when(size < 128, F.lpad(F.hex(size), 2, "0"))
        .when(size < 256, F.concat(F.lit("81"), F.lpad(F.hex(size), 2, "0")))
        .when(size < 65536, F.concat(F.lit("82"), F.lpad(F.hex(size), 4, "0")))
        .otherwise(F.concat(F.lit("83"), F.lpad(F.hex(size), 6, "0")))
    )
    return F.lower(F.concat(F.when(plain, "13").otherwise("0c"), length, F.hex(text)))


def name_text(name: Column) -> Column:
    """RFC 2253 style text of an arranged name. An attribute without a label of its
    own shows its value as DER. A carriage return becomes ``\\r``."""

    def shown(part: Column) -> Column:
        value = F.when(
            part["label"].contains("."), F.concat(F.lit("#"), _der_string(part["text"]))
        ).otherwise(_escaped(part["text"]))
        return F.concat(part["sep"], part["label"], F.lit("="), value)

    text = F.substr(F.array_join(F.transform(name, shown), ""), F.lit(2))
    return F.replace(text, F.lit("\r"), F.lit("\\r"))


def with_der(df: DataFrame, pem: str = "cert") -> DataFrame:
    """Add ``_der``, the bytes of the certificate in the PEM column (null if there is none), and
    ``_key``, their SHA-256: the name under which a certificate is known in all scans."""
    # One column after the other: each is computed once, however often it is used.
    rows = df.withColumn("_block", _first_block(F.col(pem)))
    usable = (F.col("_block.kind") == "CERTIFICATE") & ~F.col("_block.headers")
    rows = rows.withColumn("_der", F.when(usable, F.col("_block.der"))).drop("_block")
    return rows.withColumn("_key", F.sha2("_der", 256))


def with_attributes(df: DataFrame) -> DataFrame:
    """``df`` without ``_der`` and ``_key``, with the attributes appended; they are null, the hash
    too, where the bytes are no certificate. Only the bytes go through Python, in Arrow batches."""
    passed = [c for c in df.columns if c not in ("_der", "_key")]
    rows = df.withColumn("_x", _fields("_der"))
    known = F.col("_x").isNotNull()
    names = F.col("_x.altNames")
    return rows.select(
        *passed,
        F.when(known, F.sha1("_der")).alias("sha1"),
        F.when(known, F.col("_key")).alias("sha256"),
        name_text(F.col("_x.subject")).alias("subject"),
        name_text(F.col("_x.issuer")).alias("issuer"),
        *(F.col(f"_x.{c}") for c in ("notBefore", "notAfter")),
        *(F.col(f"_x.{c}") for c in ("basicConstraints", "isCa")),
        F.sha2("_x.publicKey", 256).alias("sha256PubKey"),
        F.when(known, F.when(names.isNull(), 0).otherwise(F.size(names))).alias("numAltNames"),
        names.alias("altNames"),
    )


def with_certificate(df: DataFrame, pem: str = "cert") -> DataFrame:
    """``df`` without its PEM column and with the attributes appended.

    Rows that hold no readable certificate stay, with a null ``sha256``, so one
    pass serves both ``parsed`` and ``rejected``. Decoding and hashing are Spark
    expressions; only the DER bytes go through Python, in Arrow batches.
    """
    rows = with_attributes(with_der(df, pem))
    text = F.when(F.col("sha256").isNull(), F.coalesce(F.col(pem), F.lit("")))
    return rows.withColumn("_rejected", text).drop(pem)


def parsed(certificates: DataFrame) -> DataFrame:
    return certificates.where(F.col("_rejected").isNull()).drop("_rejected")


def rejected(certificates: DataFrame) -> DataFrame:
    rows = certificates.where(F.col("_rejected").isNotNull())
    return rows.select(F.lit("no certificate").alias("reason"), F.col("_rejected").alias("payload"))


def parse_certificates(df: DataFrame, pem: str = "cert") -> DataFrame:
    return parsed(with_certificate(df, pem))
